"""C: correlated layer. Also I11, I12 and C13 on the wide gold base."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import correlated as co
from ..operators import levels
from ..session import materialize
from ..sources import records
from .base import DIMS, Data, cte, frac, query, r6
from .level_queries import dsum

# Every derived row gets the source path such a document would have had.
_RESULT_PATH = "'resultados/votacao_secao_' || ano || '_' || lower(replace(uf, ' ', '_')) || '.jsonl'"
_PEOPLE_PATH = "'eleitorado/perfil_eleitor_secao_' || ano || '_' || lower(replace(uf, ' ', '_')) || '.jsonl'"


def gold_parts(d: Data):
    votes = d.results.withColumns({"arquivo_origem": F.expr(_RESULT_PATH), "validos": F.col("validos_estimados"), "aggregation_mode": F.lit("spark")})
    people = d.electorate.withColumns(
        {
            "arquivo_origem": F.expr(_PEOPLE_PATH), "comparecimento": F.col("comparecimento_estimado"),
            "abstencao": F.col("abstencao_estimado"), "aggregation_mode": F.lit("spark"),
        }
    )
    return votes, people


def gold(d: Data):
    return records.merge_gold_sources(gold_parts(d))


def metadata(d: Data):
    """One metadata row per source the data would have come from."""
    seen = d.electorate.select("ano", "uf").distinct()
    paths = seen.select(F.explode(F.array(F.expr(_RESULT_PATH), F.expr(_PEOPLE_PATH))).alias("arquivo_origem"))
    kind = F.element_at(F.split("arquivo_origem", "/"), 1)
    subject = F.when(kind == "resultados", "votacao_secao").otherwise("perfil_eleitor_secao")
    return paths.withColumns({"dominio_documento": kind, "assunto_documento": subject, "tipo_arquivo_json": F.lit("dados")})


def _written(d: Data) -> Data:
    """The same inputs, of which joined rows, and the base made of them, are written once for their several readers."""
    out = Data(d.spark, d.folder)
    out.results = materialize(d.results.drop("nr_votavel"), "results", free=True)  # which neither gold rows nor the base have
    out.electorate = materialize(d.electorate, "electorate", free=True)
    out.base = materialize(out.base, "base", free=True)
    return out


def annotated(d: Data):
    return co.annotate_gold(gold(d), metadata(d))


_GK = ["ano", "uf", "cd_municipio", "nm_municipio", "zona", "secao", "local_votacao", "bairro", "turno", "cargo", "partido", "candidato", "ideologia", "coalizao", *DIMS]
_KEYS = ", ".join(_GK)
_METRICS = ["votos", "eleitorado", "comparecimento", "abstencao", "brancos", "nulos", "validos", "linhas_origem"]
_BLANK = ", ".join(f"'' as {x}" for x in ("local_votacao", "bairro", "ideologia", "coalizao"))
cte("gold_rows", f"""
  select ano, uf, cd_municipio, nm_municipio, zona, secao, {_BLANK}, turno, cargo, partido, candidato, {', '.join(f"'' as {x}" for x in DIMS)},
    {_RESULT_PATH} as arquivo_origem, votos, 0 as eleitorado, 0 as comparecimento, 0 as abstencao, brancos, nulos, validos_estimados as validos, 1 as linhas_origem from results
  union all by name
  select ano, uf, cd_municipio, nm_municipio, zona, secao, {_BLANK}, '' as turno, '' as cargo, '' as partido, '' as candidato, {', '.join(DIMS)},
    {_PEOPLE_PATH} as arquivo_origem, 0 as votos, eleitorado, comparecimento_estimado as comparecimento, abstencao_estimado as abstencao, 0 as brancos, 0 as nulos, 0 as validos, 1 as linhas_origem from electorate""")


def gold_sql(keys, source="gold_rows"):
    return f"""
  select *, pc as pct_comparecimento, pa as pct_abstencao, votos / nullif(sum(votos) over (partition by ano, uf, cd_municipio, turno, cargo), 0) as share_votos_grupo from (
    select *, comparecimento_estimado / nullif(eleitorado, 0) as pc, abstencao_estimado / nullif(eleitorado, 0) as pa from (
      select *, case when abstencao > 0 then abstencao else greatest(eleitorado - comparecimento_estimado, 0) end as abstencao_estimado from (
        select *, case when comparecimento > 0 then comparecimento else validos_estimados + brancos + nulos end as comparecimento_estimado from (
          select *, case when validos > 0 then validos else votos end as validos_estimados from (
            select {keys}, {dsum(_METRICS)} from {source} group by {keys})))))"""


_GOLD_OUT = f"* exclude (pc, pa, pct_comparecimento, pct_abstencao, share_votos_grupo), {r6('pc')} as pct_comparecimento, {r6('pa')} as pct_abstencao, {r6('share_votos_grupo')} as share_votos_grupo"
cte("gold", gold_sql(_KEYS + ", arquivo_origem"))


@query("I11_gold_base_aggregate", f"select {_KEYS}, {dsum(_METRICS)} from gold_rows group by {_KEYS}")
def i11(d):
    votes, people = gold_parts(d)
    rows = records.conform_gold(votes).unionByName(records.conform_gold(people))
    return records.gold_base_aggregate(rows)


@query("I12_derive_turnout_metrics", f"select {_GOLD_OUT} from ({gold_sql(_KEYS)})")
def i12(d):
    votes, people = gold_parts(d)
    rows = records.conform_gold(votes).unionByName(records.conform_gold(people))
    return records.derive_turnout_metrics(records.gold_base_aggregate(rows))


@query("C13_merge_gold_sources", f"select {_GOLD_OUT}, 'spark' as aggregation_mode from gold")
def c13(d):
    return gold(d)


_CODE = "concat_ws('|', nullif(cd_municipio, ''), nullif(zona, ''), nullif(secao, ''))"
cte("annotated", f"""
  select * exclude (pc, pa), ano as ano_correlacao, cd_municipio as codigo_municipio, concat_ws('|', nullif(cd_municipio, ''), nullif(zona, '')) as codigo_zona_eleitoral,
    {_CODE} as codigo_setor_eleitoral, ano || '|' || {_CODE} as codigo_correlacao_setor_ano,
    split_part(arquivo_origem, '/', 1) as dominio_documento,
    case when split_part(arquivo_origem, '/', 1) = 'resultados' then 'votacao_secao' else 'perfil_eleitor_secao' end as assunto_documento,
    regexp_replace(split_part(arquivo_origem, '/', 2), '\\.jsonl$', '') as subtitulo_arquivo,
    split_part(arquivo_origem, '/', 1) = 'resultados' or votos > 0 or validos_estimados > 0 as eh_resultado,
    split_part(arquivo_origem, '/', 1) = 'eleitorado' or eleitorado > 0 as eh_eleitorado,
    partido <> '' or candidato <> '' as eh_candidato from gold""")
_SHOW = "codigo_municipio, codigo_zona_eleitoral, codigo_setor_eleitoral, codigo_correlacao_setor_ano, dominio_documento, assunto_documento, subtitulo_arquivo, familia_dado, eh_resultado, eh_eleitorado, eh_candidato"


@query("C1_annotate_gold", f"""
  select {_SHOW}, count(*) as linhas, cast(sum(votos) as double) as votos, cast(sum(eleitorado) as double) as eleitorado from (
    select *, case when eh_resultado then 'resultado' when eh_eleitorado then 'eleitorado' when eh_candidato then 'candidato' else 'outros' end as familia_dado from annotated) group by {_SHOW}""")
def c1(d):
    keys = [x.strip() for x in _SHOW.split(",")]
    return annotated(d).groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas"), F.sum("votos").alias("votos"), F.sum("eleitorado").alias("eleitorado"))


_SK = ", ".join(co.SECTOR_KEYS)
_names = {x: x.replace("perfil_", "") for x in DIMS}
cte("sectors", f"""
  select *, greatest(m, coalesce(eleitorado_total_dimensao_max, 0)) as eleitorado_setor from (
    select *, greatest({', '.join(f'eleitorado_total_dim_{n}' for n in _names.values())}) as eleitorado_total_dimensao_max from (
      select {_SK}, max(eleitorado) as m, max(comparecimento_estimado) as comparecimento_setor, max(abstencao_estimado) as abstencao_setor, sum(brancos) as brancos_setor,
        sum(nulos) as nulos_setor, sum(linhas_origem) as linhas_origem_eleitorado, {', '.join(f"sum(case when trim({x}) <> '' then eleitorado end) as eleitorado_total_dim_{n}" for x, n in _names.items())},
        string_agg(distinct arquivo_origem, ' | ' order by arquivo_origem) as arquivos_eleitorado, string_agg(distinct subtitulo_arquivo, ' | ' order by subtitulo_arquivo) as subtitulos_eleitorado
      from annotated where eh_eleitorado group by {_SK}))""")
cte("sector_profiles", f"""
  select *, row_number() over (partition by {_SK}, dimensao_perfil order by e desc, valor_perfil) as rn, e / nullif(sum(e) over (partition by {_SK}, dimensao_perfil), 0) as s from (
    {' union all '.join(f"select {_SK}, '{n}' as dimensao_perfil, {x} as valor_perfil, sum(eleitorado) as e from annotated where eh_eleitorado and trim({x}) <> '' and lower({x}) not in ('sem valor', 'sem_valor') group by {_SK}, {x}" for x, n in _names.items())})""")


@query("C2_electorate_sector", f"""
  select * exclude (m), {frac('comparecimento_setor', 'eleitorado_setor')} as pct_comparecimento_setor, {frac('abstencao_setor', 'eleitorado_setor')} as pct_abstencao_setor from sectors""",
       drop=("perfil_predominante_setor",))
def c2(d):
    return co.electorate_sector(annotated(d))


@query("C3_profile_sector", f"select {_SK}, dimensao_perfil, valor_perfil, e as eleitorado_perfil_setor, rn as rank_perfil_setor, {r6('s')} as share_perfil_setor from sector_profiles")
def c3(d):
    return co.profile_sector(annotated(d))


_CK = ", ".join(co.CONTEST_KEYS)
_SUM6 = ["votos", "brancos", "nulos", "validos_estimados", "comparecimento_estimado", "abstencao_estimado"]
cte("sector_results", f"""
  select *, row_number() over (partition by {_CK} order by votos desc, entidade, partido, candidato) as rank_entidade_setor, votos / nullif(sum(votos) over (partition by {_CK}), 0) as s from (
    select {_CK}, partido, candidato, ideologia, coalizao, candidato || ' | ' || partido as entidade, {dsum(_SUM6)}, cast(sum(linhas_origem) as double) as linhas_origem_resultado
    from annotated where eh_resultado group by all)""")


@query("C4_results_sector_entity", f"select * exclude (s), {r6('s')} as share_votos_setor, case when rank_entidade_setor = 1 then entidade else '' end as vencedor_setor from sector_results")
def c4(d):
    return co.results_sector_entity(annotated(d))


cte("catalogue", """
  select ano_correlacao, ano, uf, cargo, turno, partido, candidato, ideologia, coalizao, cast(sum(linhas_origem) as double) as linhas_origem_candidato,
    string_agg(distinct arquivo_origem, ' | ' order by arquivo_origem) as arquivos_candidato, string_agg(distinct subtitulo_arquivo, ' | ' order by subtitulo_arquivo) as subtitulos_candidato,
    string_agg(distinct dominio_documento, ' | ' order by dominio_documento) as dominios_candidato, string_agg(distinct assunto_documento, ' | ' order by assunto_documento) as assuntos_candidato
  from annotated where eh_candidato group by all""")


@query("C5_candidate_catalogue", "select * from catalogue")
def c5(d):
    return co.candidate_catalogue(annotated(d))


def layers(d: Data):
    a = materialize(annotated(d), "annotated")  # read by every layer
    return a, co.results_sector_entity(a), co.electorate_sector(a), co.candidate_catalogue(a)


_SJ = ", ".join(co.SECTOR_JOIN)


@query("C6_correlated_base", f"""
  select r.* exclude (s, comparecimento_estimado, abstencao_estimado), {r6('r.s')} as share_votos_setor, case when rank_entidade_setor = 1 then entidade else '' end as vencedor_setor,
    e.eleitorado_setor, e.comparecimento_setor, e.abstencao_setor, {frac('e.comparecimento_setor', 'e.eleitorado_setor')} as pct_comparecimento_setor,
    {frac('e.abstencao_setor', 'e.eleitorado_setor')} as pct_abstencao_setor, e.arquivos_eleitorado, e.subtitulos_eleitorado, c.arquivos_candidato, c.subtitulos_candidato,
    c.dominios_candidato, c.assuntos_candidato, c.linhas_origem_candidato, c.candidato is not null as candidato_presente_catalogo, coalesce(e.eleitorado_setor, 0) as eleitorado,
    case when r.comparecimento_estimado > 0 then r.comparecimento_estimado else coalesce(e.comparecimento_setor, 0) end as comparecimento_estimado,
    case when r.abstencao_estimado > 0 then r.abstencao_estimado else coalesce(e.abstencao_setor, 0) end as abstencao_estimado
  from sector_results r left join sectors e using ({_SJ})
  left join (select * from (select *, row_number() over (partition by ano_correlacao, cargo, partido, candidato order by uf, turno) as rn from catalogue) where rn = 1) c
  using (ano_correlacao, cargo, partido, candidato)""", drop=("perfil_predominante_setor", "base_correlacao"))
def c6(d):
    _, r, e, c = layers(d)
    return co.correlated_base(r, e, c)


@query("C7_sector_summary", f"""
  select s.*, e.eleitorado_setor, e.comparecimento_setor, e.abstencao_setor, {frac('e.comparecimento_setor', 'e.eleitorado_setor')} as pct_comparecimento_setor,
    {frac('e.abstencao_setor', 'e.eleitorado_setor')} as pct_abstencao_setor
  from (select {_CK}, {dsum(_SUM6)}, max(case when rank_entidade_setor = 1 then entidade end) as vencedor_setor, max(case when rank_entidade_setor = 1 then partido end) as partido_vencedor_setor,
    max(case when rank_entidade_setor = 1 then candidato end) as candidato_vencedor_setor, max(case when rank_entidade_setor = 1 then votos end) as votos_vencedor_setor,
    {r6('max(case when rank_entidade_setor = 1 then s end)')} as share_vencedor_setor from sector_results group by {_CK}) s left join sectors e using ({_SJ})""", drop=("perfil_predominante_setor",))
def c7(d):
    a = materialize(annotated(d), "annotated")  # read by both layers, several times
    return co.sector_summary(co.results_sector_entity(a), co.electorate_sector(a))


@query("C8_year_stats", """
  select ano_correlacao as ano, * exclude (ano_correlacao) from
    (select ano_correlacao, count(*) as linhas_gold_anotado, count(distinct arquivo_origem) as arquivos_origem, count(distinct uf) as ufs, count(distinct cd_municipio) as municipios,
       count(distinct codigo_setor_eleitoral) as setores_eleitorais from annotated group by 1)
  join (select ano_correlacao, count(*) as linhas_base_correlacionada, count(*) as linhas_resultado_entidade, sum(votos) as votos_total_resultados from sector_results group by 1) using (ano_correlacao)
  join (select ano_correlacao, count(*) as linhas_eleitorado_setor, sum(eleitorado_setor) as eleitorado_total_setores from sectors group by 1) using (ano_correlacao)
  join (select ano_correlacao, count(*) as linhas_catalogo_candidato, count(distinct candidato) as candidatos, count(distinct partido) as partidos from catalogue group by 1) using (ano_correlacao)""")
def c8(d):
    a, r, e, c = layers(d)
    return co.year_stats(a, r, e, c, co.correlated_base(r, e, c))


def corr_sql(pairs: str, scope: str, names: dict[str, str], min_rows: int) -> str:
    return f"""
  with pr as ({pairs}),
  rk as (select *, rank() over (partition by {scope} order by v1) + (count(*) over (partition by {scope}, v1) - 1) / 2.0 as r1,
                rank() over (partition by {scope} order by v2) + (count(*) over (partition by {scope}, v2) - 1) / 2.0 as r2 from pr where v1 is not null and v2 is not null),
  c as (select {scope}, count(*) as n, case when min(v1) < max(v1) and min(v2) < max(v2) then corr(v1, v2) end as pearson,
    case when min(r1) < max(r1) and min(r2) < max(r2) then corr(r1, r2) end as spearman from rk group by {scope} having count(*) >= {min_rows})
  select {', '.join(f'{x} as {n}' for x, n in names.items())} from c"""


cte("c_temporal", corr_sql(
    " union all ".join(f"select '{m}' as metrica, a.ano_num as p1, b.ano_num as p2, a.{m} as v1, b.{m} as v2 from municipal a join municipal b using (uf, cd_municipio, cargo, turno) where a.ano_num < b.ano_num" for m in co.TEMPORAL_METRICS),
    "metrica, p1, p2", {"metrica": "metrica", "p1": "ano_1", "p2": "ano_2", "n": "n", "pearson": "pearson", "spearman": "spearman"}, 5))
cte("c_entities", corr_sql(
    "select cast(a.ano as integer) as p1, cast(b.ano as integer) as p2, a.share as v1, b.share as v2 from tl_entities a join tl_entities b using (cargo, turno, entidade) where cast(a.ano as integer) < cast(b.ano as integer)",
    "p1, p2", {"p1": "ano_1", "p2": "ano_2", "n": "n_entidades", "pearson": "pearson_share", "spearman": "spearman_share"}, 3))


@query("C9_temporal_correlation", f"select metrica, ano_1, ano_2, n, {r6('pearson')} as pearson, {r6('spearman')} as spearman, {r6('abs(pearson)')} as abs_pearson, 'mesma_metrica_entre_anos' as tipo from c_temporal")
def c9(d):
    return co.temporal_correlation(levels.consolidate_municipal(d.base))


@query("C10_entity_share_correlation", f"select ano_1, ano_2, n_entidades, {r6('pearson_share')} as pearson_share, {r6('spearman_share')} as spearman_share, {r6('abs(pearson_share)')} as abs_pearson_share from c_entities")
def c10(d):
    return co.entity_share_correlation(levels.timelines_full(d.base)["timeline_entidades"])


cte("inventory", """
  select arquivo_origem, string_agg(distinct ano, ', ' order by ano) as anos_detectados_conteudo, regexp_extract(arquivo_origem, '((19|20)\\d{2})', 1) as anos_detectados_nome,
    min(cast(ano as integer)) as ano_min, max(cast(ano as integer)) as ano_max, count(distinct ano) as qtd_anos, count(distinct nullif(uf, '')) as ufs,
    count(distinct nullif(cd_municipio, '')) as municipios, coalesce(string_agg(distinct nullif(cargo, ''), ', ' order by nullif(cargo, '')), '') as cargos, count(*) as linhas_gold, sum(votos) as votos_soma
  from gold group by arquivo_origem""")


@query("C11_file_inventory", "select * exclude (votos_soma) from inventory")
def c11(d):
    return co.file_inventory(gold(d))


_YEARS = [str(y) for y in range(1995, 2002)]


@query("C11_file_year_matrix", "select arquivo_origem, " + ", ".join(f"cast(contains(anos_detectados_conteudo, '{y}') as bigint) as \"{y}\"" for y in _YEARS) + " from inventory")
def c11m(d):
    return co.file_year_matrix(co.file_inventory(gold(d)), _YEARS)


@query("C12_traceability", "select * exclude (anos_detectados_nome, qtd_anos, anos_detectados_conteudo), anos_detectados_conteudo as anos_usados from inventory", drop=("uso_na_simulacao",))
def c12(d):
    return co.traceability(gold(d))


@query("C14_evidence_table", """
  select 'cobertura_temporal' as tipo, 'anos_detectados' as evidencia, string_agg(distinct ano, ', ' order by ano) as v, cast(null as double) as valor_num from gold
  union all (select 'correlacao_temporal', metrica || ' ' || ano_1 || '→' || ano_2, null, """ + r6("pearson") + """ from c_temporal order by round(abs(pearson), 6) desc nulls last, n desc, metrica, ano_1, ano_2 limit 20)
  union all (select 'correlacao_entidades', ano_1 || '→' || ano_2, null, """ + r6("pearson_share") + """ from c_entities order by round(abs(pearson_share), 6) desc nulls last, n_entidades desc, ano_1, ano_2 limit 15)""")
def c14(d):
    d = _written(d)
    out = co.evidence_table(
        co.file_inventory(gold(d)), co.temporal_correlation(levels.consolidate_municipal(d.base)),
        co.entity_share_correlation(levels.timelines_full(d.base)["timeline_entidades"]),
    )
    listed = F.col("tipo") == "cobertura_temporal"
    return out.select("tipo", "evidencia", F.when(listed, F.col("valor")).alias("v"), F.when(~listed, F.col("valor").try_cast("double")).alias("valor_num"))

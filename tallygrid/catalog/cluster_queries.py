"""K4-K19 and V20.  Descriptions are checked on a stable hash clustering; fits by invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import behaviour as be
from ..operators import clustering as cl
from ..operators import kmeans_sweep as sweeps
from ..operators.hash_clusters import stable_bucket
from ..plans import serving as sv
from ..session import materialize
from .base import CONTEST, DIM_LIST, DIMS, Data, cte, ok, query, r6

_K = "ano, uf, cd_municipio, zona, secao, nm_municipio, cargo, turno"
_CODE = "cd_municipio || '|' || zona || '|' || secao"
_COLS = ["regiao", "uf", "cargo", *DIMS, "partido_vencedor_setor", "vencedor_setor"]


def sectors(d: Data) -> DataFrame:
    return cl.sector_cluster_base(d.base)


def hashed(d: Data) -> DataFrame:
    return sectors(d).withColumn("cluster", stable_bucket(F.col("codigo_setor_eleitoral"), 5))


cte("sector_base", f"""
  with t as (select {_K}, sum(votos) as votos_total_setor, max(eleitorado) as eleitorado_cluster, max(comparecimento_estimado) as comparecimento_cluster, max(abstencao_estimado) as abstencao_cluster,
    {', '.join(f"max(case when {ok(x)} then {x} else '' end) as {x}" for x in DIMS)} from base group by {_K}),
  l as (select {_K}, entidade as vencedor_setor, partido as partido_vencedor_setor, candidato as candidato_vencedor_setor, votos as votos_vencedor_setor from (
    select *, row_number() over (partition by {_K} order by votos desc, entidade, partido, candidato) as rn from base) where rn = 1)
  select *, ano as ano_correlacao, votos_vencedor_setor / votos_total_setor as sv, abstencao_cluster / nullif(eleitorado_cluster, 0) as pa, comparecimento_cluster / nullif(eleitorado_cluster, 0) as pc,
    {_CODE} as codigo_setor_eleitoral, 'Sem regiao' as regiao, uf || '|' || cd_municipio as municipio_grupo, cast('0x' || substr(md5({_CODE}), 1, 8) as bigint) % 5 as cluster,
    greatest(1, ceil((row_number() over (order by votos_total_setor, md5(concat_ws('|', {_K}))) - 1) * 4.0 / (count(*) over () - 1))) as q from t join l using ({_K})""")


@query("K9_sector_cluster_base", f"""select {_K}, votos_total_setor, eleitorado_cluster, vencedor_setor, partido_vencedor_setor, candidato_vencedor_setor, {r6('sv')} as share_vencedor_setor, {r6('pa')} as pct_abstencao_cluster,
  {r6('pc')} as pct_comparecimento_cluster, regiao, municipio_grupo, case q when 1 then 'votos_baixo' when 2 then 'votos_medio_baixo' when 3 then 'votos_medio_alto' else 'votos_alto' end as faixa_votos_setor,
  case when pa is null then 'abstencao_sem_valor' when pa < 0.12 then 'abstencao_baixo' when pa <= 0.25 then 'abstencao_medio' else 'abstencao_alto' end as faixa_abstencao_setor from sector_base""")
def k9(d):
    return sectors(d).select(*[c.strip() for c in _K.split(",")], "votos_total_setor", "eleitorado_cluster", "vencedor_setor", "partido_vencedor_setor", "candidato_vencedor_setor",
                             "share_vencedor_setor", "pct_abstencao_cluster", "pct_comparecimento_cluster", "regiao", "municipio_grupo", "faixa_votos_setor", "faixa_abstencao_setor")


@query("K4_token_features", "select cargo, turno, 2 as qtd_tokens, count(*) as n from results group by all")
def k4(d):
    rows = cl.token_features(d.results.select("cargo", "turno", F.lit("#NULO#").alias("vazio")), ["cargo", "turno", "vazio"], 64)
    return rows.groupBy("cargo", "turno", F.size("tokens").alias("qtd_tokens")).agg(F.count(F.lit(1)).alias("n"))


_TOKENS = ", ".join([f"case when {ok(c)} then {c} else '' end" for c in ("regiao", "cargo", "turno", *DIMS)])


def elbow(d: Data):
    rows = cl.sector_cluster_base(d.base).withColumn("tokens", cl.tokens(cl.voter_columns()))
    numbered = materialize(rows.select("tokens", sweeps.token_numbers("tokens", 2048).alias("numbers")), "numbers")
    return numbered, *cl.kmeans_elbow(numbered, 2, 8)


@query("K5_kmeans_elbow", f"""select count(*) as linhas, count(distinct ({_TOKENS}, q, case when pa is null then 0 when pa < 0.12 then 1 when pa <= 0.25 then 2 else 3 end,
  case when pc is null then 0 when pc < 0.65 then 1 when pc <= 0.82 then 2 else 3 end, municipio_grupo)) as combinacoes, 7 as qtd_k, true as custo_cai from sector_base""")
def k5(d):
    """Rows, distinct token sets and fits; that each further cluster lowers the cost."""
    numbered, _, _, costs = elbow(d)
    falls = all(b < a for (_, a), (_, b) in zip(costs, costs[1:], strict=False))
    return numbered.agg(F.count(F.lit(1)).alias("linhas"), F.countDistinct("tokens").alias("combinacoes")).withColumns({"qtd_k": F.lit(len(costs)), "custo_cai": F.lit(falls)})


@query("K5_kmeans_costs")
def k5c(d):
    """(k, custo, escolhido) of the operator's own range; checked against a plain version in the tests."""
    _, _, best, costs = elbow(d)
    return d.spark.createDataFrame([(k, float(c), k == best) for k, c in costs], "k int, custo double, escolhido boolean")


_IN_RANGE = "true as no_intervalo"


def assigned(out: DataFrame, *sums: str) -> DataFrame:
    """What every fit must satisfy: each row in a cluster below the chosen k, nothing lost."""
    inside = F.min((F.col("cluster") >= 0) & (F.col("cluster") < F.col("k_escolhido"))).alias("no_intervalo")
    return out.agg(F.count(F.lit(1)).alias("linhas"), F.count("cluster").alias("atribuidas"), inside, *[F.sum(c).alias(c) for c in sums])


def by_cluster(out: DataFrame, votes: str) -> DataFrame:
    return out.groupBy("cluster", F.col("k_escolhido").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum(votes).alias("votos"))


@query("K6_kmeans_sample_train", f"select count(*) as linhas, count(*) as atribuidas, {_IN_RANGE}, cast(sum(votos_total_setor) as double) as votos_total_setor from sector_base where " + " or ".join(ok(x) for x in DIMS))
def k6(d):
    return assigned(cl.cluster_sectors(sectors(d), True, train_limit=50_000), "votos_total_setor")


@query("K6_sector_clusters")
def k6c(d):
    return by_cluster(cl.cluster_sectors(sectors(d)), "votos_total_setor")


_SOME = " or ".join(ok(x) for x in DIMS)
_LED = f"(select {CONTEST}, {DIM_LIST}, max(v) as v from (select {CONTEST}, {DIM_LIST}, partido, sum(votos) as v from base group by all) where {_SOME} group by all)"


@query("K7_cluster_profiles", f"select count(*) as linhas, count(*) as atribuidas, {_IN_RANGE}, cast(sum(v) as double) as votos_entidade_dominante from {_LED}")
def k7(d):
    return assigned(cl.cluster_profiles(d.base, True), "votos_entidade_dominante")


@query("K7_cluster_profiles_clusters")
def k7c(d):
    return by_cluster(cl.cluster_profiles(d.base, True), "votos_entidade_dominante")


@query("K7_cluster_profiles_voters_only", f"select count(*) as linhas, count(*) as atribuidas, {_IN_RANGE} from {_LED}")
def k7v(d):
    return assigned(cl.cluster_profiles(d.base, False))


@query("K8_cluster_behaviour", f"""
  select count(*) as linhas, count(*) as atribuidas, {_IN_RANGE}, cast(sum(v) as double) as votos
  from (select ano, cargo, turno, uf, cd_municipio, nm_municipio, zona, secao, {DIM_LIST}, sum(votos) as v from panel where {_SOME} group by all)""")
def k8(d):
    return assigned(cl.cluster_behaviour(be.behaviour_panel(d.base)), "votos")


@query("K8_cluster_behaviour_clusters")
def k8c(d):
    return by_cluster(cl.cluster_behaviour(be.behaviour_panel(d.base)), "votos")


@query("K10_cap_categories", "select case when candidato_vencedor_setor in (select candidato_vencedor_setor from sector_base group by 1 order by count(*) desc, candidato_vencedor_setor limit 20) then candidato_vencedor_setor else '' end as v, count(*) as n from sector_base group by 1")
def k10(d):
    out = cl.cap_categories(sectors(d), ["candidato_vencedor_setor"], {"candidato_vencedor_setor": 20})
    return out.groupBy(F.col("candidato_vencedor_setor").alias("v")).agg(F.count(F.lit(1)).alias("n"))


@query("K11_useful_rows", "select count(*) as n from sector_base where " + " or ".join(ok(x) for x in DIMS))
def k11(d):
    columns = [*cl.voter_columns(), *cl.WINNERS]
    return cl.useful_rows(sectors(d), columns, True).agg(F.count(F.lit(1)).alias("n"))


_RATES = f"{r6('avg(pa)')} as abstencao_media, {r6('avg(pc)')} as comparecimento_medio"


@query("K12_cluster_summary", f"""
  select t.*, {', '.join(f"{c}.v as {c}_dominante, {r6(f'{c}.n / t.qtd_linhas')} as {c}_dominante_share" for c in _COLS)} from (
    select cluster, count(distinct codigo_setor_eleitoral) as qtd_setores, count(distinct uf) as qtd_ufs, count(distinct cd_municipio) as qtd_municipios, sum(votos_total_setor) as votos_total_cluster,
      {r6('avg(pa)')} as abstencao_media_cluster, {r6('avg(pc)')} as comparecimento_medio_cluster, count(*) as qtd_linhas from sector_base group by cluster) t
  {' '.join(f"left join (select * from (select cluster, {c} as v, count(*) as n, row_number() over (partition by cluster order by count(*) desc, {c}) as rn from sector_base where {ok(c)} group by cluster, {c}) where rn = 1) {c} on {c}.cluster = t.cluster" for c in _COLS)}""")
def k12(d):
    return cl.cluster_summary(hashed(d), _COLS)


_DISC = " union all ".join(f"select cluster, '{c}' as campo_discriminado, {c} as valor_discriminado, count(*) as qtd_no_cluster from sector_base where {ok(c)} group by cluster, {c}" for c in _COLS)
cte("discriminants", f"""
  select *, qtd_no_cluster / r as sc, al / t as sg from (select *, sum(qtd_no_cluster) over (partition by campo_discriminado, valor_discriminado) as al,
    row_number() over (partition by cluster, campo_discriminado order by qtd_no_cluster desc, valor_discriminado) as rn from ({_DISC}))
  join (select cluster, count(*) as r from sector_base group by cluster) using (cluster), (select count(*) as t from sector_base) where rn <= 8""")


@query("K13_cluster_discriminants", f"select cluster, campo_discriminado, valor_discriminado, qtd_no_cluster, {r6('sc')} as share_no_cluster, {r6('sg')} as share_global, {r6('sc / sg')} as lift_vs_global from discriminants", drop=("campo_discriminado_legivel",))
def k13(d):
    return cl.cluster_discriminants(hashed(d), _COLS)


@query("V20_cluster_discriminant_view", f"select cluster, campo_discriminado, valor_discriminado, {r6('sc / sg')} as lift_vs_global from discriminants order by round(sc / sg, 6) desc, campo_discriminado, cluster, round(sc / sg, 9), valor_discriminado limit 30")
def v20(d):
    return sv.cluster_discriminant_view(cl.cluster_discriminants(hashed(d), _COLS))


def _table_sql(keys):
    return f"""select *, {r6('qtd_setores / sum(qtd_setores) over (partition by cluster)')} as share_setores_no_cluster from (
      select cluster, {keys}, count(distinct codigo_setor_eleitoral) as qtd_setores, sum(votos_total_setor) as votos_total, {_RATES} from sector_base group by cluster, {keys})"""


@query("K14_cluster_year_region", _table_sql("ano_correlacao, regiao, uf"))
def k14(d):
    return cl.cluster_year_region(hashed(d))


@query("K15_cluster_municipalities", _table_sql("uf, cd_municipio, nm_municipio, regiao"))
def k15(d):
    return cl.cluster_municipalities(hashed(d))


@query("K16_cluster_entities", f"select * exclude (abstencao_media, comparecimento_medio) from (select *, row_number() over (partition by cluster order by qtd_setores desc, vencedor_setor) as rank from ({_table_sql('vencedor_setor')})) where rank <= 15")
def k16(d):
    return cl.cluster_entities(hashed(d))


cte("cluster_proj", """
  with y as (select cluster, cargo, turno, cast(ano as integer) as y, vencedor_setor, sum(votos_total_setor) as v from sector_base group by all),
  s as (select *, v / sum(v) over (partition by cluster, cargo, turno, y) as share from y),
  w as (select *, lag(share) over x as ps, lag(y) over x as py, lead(y) over x as ny from s window x as (partition by cluster, cargo, turno, vencedor_setor order by y)),
  p as (select *, coalesce((share - ps) / greatest(y - py, 1), 0) as swing, greatest(2026 - y, 0) as anos from w where ny is null),
  r as (select *, greatest(0.000001, share + swing * anos) as raw from p)
  select *, raw / sum(raw) over (partition by cluster, cargo, turno) as pred from r""")


@query("K17_cluster_projection", f"""select cluster, cargo, turno, vencedor_setor, y as ano_base, {r6('share')} as share_base_cluster, {r6('swing')} as swing_anual_cluster, anos as anos_ate_2026, {r6('raw')} as share_previsto_2026_raw, {r6('pred')} as share_previsto_2026,
  row_number() over (partition by cluster, cargo, turno order by round(pred, 9) desc, vencedor_setor) as rank_pred_2026_cluster from cluster_proj""")
def k17(d):
    return cl.cluster_projection(hashed(d))


def _dominant_sql(c: str) -> str:
    return f"(select cluster, v from (select cluster, {c} as v, row_number() over (partition by cluster order by count(*) desc, {c}) as rn from sector_base where {ok(c)} group by cluster, {c}) where rn = 1)"


_TRAITS = [f"{before} || {value}.v" if i == 0 else f"{before} || lower({value}.v)" for i, (before, value) in enumerate(zip(["'na faixa '", "''", "'com '", "''", "'de raca/cor '"], DIMS, strict=True))]


@query("K18_cluster_personas", f"""
  with b as (select cluster, vencedor_setor, pred from (select *, row_number() over (partition by cluster order by round(pred, 9) desc, vencedor_setor) as rn from (
      select *, row_number() over (partition by cluster, cargo, turno order by round(pred, 9) desc, vencedor_setor) as rk from cluster_proj) where rk = 1) where rn = 1)
  select t.cluster, b.vencedor_setor as entidade_prevista_2026, {r6('b.pred')} as share_entidade_prevista_2026,
    'Eleitor ' || concat_ws(', ', {', '.join(_TRAITS)}) || coalesce(', mais presente em ' || nullif(concat_ws(' / ', regiao.v, uf.v), ''), '')
      || '. Esse grupo tende a se aproximar de ' || b.vencedor_setor || '.' as pessoa_do_cluster
  from (select distinct cluster from sector_base) t left join b using (cluster) {' '.join(f"left join {_dominant_sql(c)} {c} on {c}.cluster = t.cluster" for c in ("regiao", "uf", *DIMS))}""")
def k18(d):
    rows = hashed(d)
    return cl.cluster_personas(cl.cluster_summary(rows, _COLS), cl.cluster_projection(rows)).select("cluster", "pessoa_do_cluster", "entidade_prevista_2026", "share_entidade_prevista_2026")


def panel_clusters(d: Data):
    rates = ("share_voto_no_perfil_secao", "taxa_abstencao_perfil_secao", "taxa_comparecimento_perfil_secao")
    panel = materialize(be.behaviour_panel(d.base).drop(*rates), "panel")  # read for its units and its votes
    unit = ["ano", "cargo", "turno", "uf", "cd_municipio", "nm_municipio", "zona", "secao"]
    return panel, panel.select(*unit).distinct().withColumn("cluster", stable_bucket(F.concat_ws("|", "cd_municipio", "zona", "secao"), 4)), unit


cte("panel_k", f"select *, cast('0x' || substr(md5({_CODE}), 1, 8) as bigint) % 4 as cluster from panel")


@query("K19_cluster_interpretation", f"""
  select cluster, sum(votos) as total_votos_cluster, arg_max(entidade_voto, -rk) as entidade_mais_associada, {r6('max(lead_v) / sum(votos)')} as share_entidade_no_cluster from (
    select p.*, l.rk, l.v as lead_v, l.entidade_voto as le from panel_k p join (select cluster, entidade_voto, sum(votos) as v, row_number() over (partition by cluster order by sum(votos) desc, entidade_voto) as rk from panel_k group by cluster, entidade_voto) l using (cluster, entidade_voto)
  ) group by cluster""".replace("arg_max(entidade_voto, -rk)", "min(case when rk = 1 then entidade_voto end)").replace("max(lead_v)", "max(case when rk = 1 then lead_v end)"))
def k19(d):
    panel, clustered, unit = panel_clusters(d)
    out = cl.cluster_interpretation(clustered, panel, unit)
    return out.select("cluster", "total_votos_cluster", "entidade_mais_associada", "share_entidade_no_cluster")


@query("K19_cluster_interpretation_full")
def k19full(d):
    panel, clustered, unit = panel_clusters(d)
    return cl.cluster_interpretation(clustered, panel, unit)


@query("V27_top_states_per_cluster", "select cluster, uf, qtd, rank from (select *, row_number() over (partition by cluster order by qtd desc, uf) as rank from (select cluster, uf, count(*) as qtd from sector_base group by all)) where rank <= 5")
def v27c(d):
    return sv.top_states_per_cluster(hashed(d))

"""L, K1-K3 and H1-H8: level tables, hash clusters and column counts."""

from __future__ import annotations

from functools import cache

from ..operators import hash_clusters, histograms, levels, proxy, sections
from .base import ANY_DIM, COMBO, CONTEST, DIM_LABELS, DIM_LIST, DIMS, SECTION, Data, cte, frac, ok, query, r6

LEVELS = ("municipio", "estado", "brasil")
TURN = ("eleitorado", "comparecimento_estimado", "abstencao_estimado")
BALLOTS = ("votos", "brancos", "nulos", "validos_estimados")


def place(level: str) -> tuple[str, str]:
    """Select list and grouping columns of a level."""
    return {
        "brasil": ("'brasil' as nivel, ano, '' as uf, '' as cd_municipio, '' as nm_municipio", "ano"),
        "estado": ("'estado' as nivel, ano, uf, '' as cd_municipio, '' as nm_municipio", "ano, uf"),
        "municipio": ("'municipio' as nivel, ano, uf, cd_municipio, max(nm_municipio) as nm_municipio", "ano, uf, cd_municipio"),
    }[level]


def dsum(names) -> str:
    return ", ".join(f"cast(sum({n}) as double) as {n}" for n in names)


RATES = f"{frac('abstencao_estimado', 'eleitorado')} as abstencao_media, {frac('comparecimento_estimado', 'eleitorado')} as comparecimento_medio"

# ---- L1, L2 ---------------------------------------------------------------------------


def _summary(section_table: str) -> str:
    return f"""
  select 'municipio' as nivel, 1 as qtd_municipios, ano, uf, cd_municipio, nm_municipio, cargo, turno, qtd_secoes,
         eleitorado, comparecimento_estimado, abstencao_estimado, coalesce(votos, 0) as votos,
         coalesce(brancos, 0) as brancos, coalesce(nulos, 0) as nulos,
         coalesce(validos_estimados, votos, 0) as validos_estimados, cast(0 as double) as votos_vencedor, {RATES}
  from (select ano, uf, cd_municipio, max(nm_municipio) as nm_municipio, count(distinct zona || '|' || secao) as qtd_secoes,
               {dsum(TURN)} from {section_table} group by ano, uf, cd_municipio) e
  left join (select ano, uf, cd_municipio, cargo, turno, {dsum(BALLOTS)} from results group by all) r
  using (ano, uf, cd_municipio)"""


cte("e_max", f"select {SECTION}, max(nm_municipio) as nm_municipio, " + ", ".join(f"cast(max({m}) as double) as {m}" for m in TURN) + f" from electorate group by {SECTION}")
cte("l_summary", _summary("e_section"))


@query("L1_summary_municipality", "select * from l_summary")
def l1(d):
    return levels.summary_municipality(d.electorate, d.results)


@query("L1_summary_municipality_largest_cell", _summary("e_max"))
def l1max(d):
    return levels.summary_municipality(d.electorate, d.results, rule="max")


@query("L1_summary_full_outer", f"""
  with r as (select {CONTEST}, max(nm_municipio) as nm, {dsum(BALLOTS)} from results group by {CONTEST}),
  j as (select * exclude (cargo, turno), coalesce(cargo, '') as cargo, coalesce(turno, '') as turno from e_section full outer join r using ({SECTION}))
  select *, {RATES} from (
    select 'municipio' as nivel, 1 as qtd_municipios, ano, uf, cd_municipio, max(coalesce(nm_municipio, nm)) as nm_municipio, cargo, turno,
           count(distinct zona || '|' || secao) as qtd_secoes,
           {', '.join(f'cast(sum(coalesce({m}, 0)) as double) as {m}' for m in TURN + BALLOTS)}
    from j group by ano, uf, cd_municipio, cargo, turno)""")
def l1outer(d):
    return levels.summary_from_sections(d.electorate, d.results)


@query("L1_summary_from_winners", f"""
  with w as (select {CONTEST}, nm_municipio, max(v) as votos_vencedor, sum(v) as votos from (
    select {CONTEST}, nm_municipio, partido, candidato, nr_votavel, cast(sum(votos) as double) as v from results where votos > 0 group by all) group by all),
  g as (select ano, uf, cd_municipio, max(w.nm_municipio) as nm_municipio, cargo, turno, count(distinct zona || '|' || secao) as qtd_secoes,
    sum(eleitorado) as eleitorado, sum(votos) as votos, sum(votos_vencedor) as votos_vencedor
    from w left join e_section using ({SECTION}) group by ano, uf, cd_municipio, cargo, turno),
  f as (select 'municipio' as nivel, 1 as qtd_municipios, *, eleitorado - votos as abstencao_estimado, votos as comparecimento_estimado,
    cast(0 as double) as brancos, cast(0 as double) as nulos, votos as validos_estimados from g)
  select *, {RATES} from f""")
def l1winners(d):
    return levels.summary_from_winners(sections.section_winner_profile(d.results, d.electorate))


def _rollup_sql(level):
    loc, group = place(level)
    return f"""
  select *, {RATES} from (select {loc}, cargo, turno, cast(sum(qtd_municipios) as bigint) as qtd_municipios,
    cast(sum(qtd_secoes) as bigint) as qtd_secoes, {dsum(TURN + BALLOTS)} from l_summary group by {group}, cargo, turno)"""


def _register_summary(level):
    @query(f"L2_summary_{level}", _rollup_sql(level))
    def run(d):
        return levels.summary_rollup(levels.summary_municipality(d.electorate, d.results), level)


# ---- L3, L4, L5, L6 -------------------------------------------------------------------

cte("l_profiles", f"""
  select ano, uf, cd_municipio, max(nm_municipio) as nm_municipio, {DIM_LIST}, {COMBO} as perfil_combinado, {dsum(TURN)}
  from electorate where {ANY_DIM} and eleitorado > 0 group by ano, uf, cd_municipio, {DIM_LIST}""")


@cache
def profile_sql(level):
    loc, group = place(level)
    return f"""
  select *, eleitorado as qtd_eleitores_perfil, eleitorado as histograma_qtd_pessoas,
         {r6(f'eleitorado / sum(eleitorado) over (partition by {group})')} as share_perfil,
         row_number() over (partition by {group} order by eleitorado desc, perfil_combinado, {', '.join(DIMS[::-1])}) as rank_perfil_ano,
         {frac('comparecimento_estimado', 'eleitorado')} as taxa_comparecimento_perfil,
         {frac('abstencao_estimado', 'eleitorado')} as taxa_abstencao_perfil
  from (select {loc}, {DIM_LIST}, perfil_combinado, {dsum(TURN)} from l_profiles where {ok('perfil_combinado')}
        group by {group}, {DIM_LIST}, perfil_combinado)"""


def profile_table(d: Data, level: str):
    return levels.profile_level(levels.profile_totals(d.electorate), level)


cte("l_parties", f"""select ano, uf, cd_municipio, max(nm_municipio) as nm_municipio, cargo, turno, partido as entidade,
  'partido' as tipo_entidade, {dsum(BALLOTS)} from results where {ok('partido')} and votos > 0 group by ano, uf, cd_municipio, cargo, turno, partido""")
cte("l_names", f"""select ano, uf, cd_municipio, max(nm_municipio) as nm_municipio, cargo, turno, candidato as entidade,
  'candidato' as tipo_entidade, {dsum(BALLOTS)} from results where {ok('candidato')} and votos > 0 group by ano, uf, cd_municipio, cargo, turno, candidato""")


def results_sql(level, source="l_parties", top=50):
    loc, group = place(level)
    scope = f"{group}, cargo, turno"
    return f"""
  select * exclude (share_raw), {r6('share_raw')} as share_votos,
         case when rank_entidade = 1 then 'vencedor' else 'nao_vencedor' end as resultado_eleitoral,
         case when rank_entidade = 1 then 'ganhou' else 'perdeu' end as resultado_grupo,
         votos_lider - votos as margem_votos_para_lider, {frac('(votos_lider - votos)', 'votos_total_disputa')} as margem_share_para_lider
  from (select *, votos / sum(votos) over (partition by {scope}) as share_raw,
               sum(votos) over (partition by {scope}) as votos_total_disputa, max(votos) over (partition by {scope}) as votos_lider,
               row_number() over (partition by {scope} order by votos desc, entidade) as rank_entidade
        from (select {loc}, cargo, turno, entidade, tipo_entidade, {dsum(BALLOTS)} from {source} group by {scope}, entidade, tipo_entidade))
  where rank_entidade <= {top}"""


def results_table(d: Data, level: str, entity: str = "partido", top: int | None = 50):
    return levels.results_level(levels.result_totals(d.results, entity), level, top=top)


def _register_profile(level):
    prefix = "L3_profile" if level == "municipio" else "L4_profile"

    @query(f"{prefix}_{level}", profile_sql(level), drop=("descricao",))
    def run(d):
        return profile_table(d, level)


def _register_results(level, entity):
    prefix = "L5_results" if level == "municipio" else "L6_results"
    source = "l_parties" if entity == "partido" else "l_names"

    @query(f"{prefix}_{level}_{entity}", results_sql(level, source), drop=("interpretacao_resultado",))
    def run(d):
        return results_table(d, level, entity)


for _level in LEVELS:
    if _level != "municipio":
        _register_summary(_level)
    _register_profile(_level)
    for _entity in ("partido", "candidato"):
        _register_results(_level, _entity)

cte("l_cut", f"select * from ({results_sql('municipio', 'l_parties', 10)})")


@query("L6_results_estado_from_cut", results_sql("estado", "l_cut"), drop=("interpretacao_resultado",))
def l6cut(d):
    return levels.results_rollup(results_table(d, "municipio", top=10), "estado")


# ---- L7 - L13 -------------------------------------------------------------------------

cte("p_parts", f"""
  with s as (select {CONTEST}, partido as entidade, cast(sum(votos) as double) as v from results where {ok('partido')} and votos > 0 group by {CONTEST}, partido),
  h as (select *, v / sum(v) over (partition by {CONTEST}) as share_secao from s),
  p as (select {SECTION}, max(nm_municipio) as nm_municipio, {COMBO} as perfil_combinado, cast(sum(eleitorado) as double) as e from electorate group by {SECTION}, {COMBO})
  select ano, uf, cd_municipio, max(nm_municipio) as nm_municipio, cargo, turno, entidade, perfil_combinado, sum(e * share_secao) as votos_proxy
  from p join h using ({SECTION}) where {ok('perfil_combinado')} group by ano, uf, cd_municipio, cargo, turno, entidade, perfil_combinado""")


def parts(d: Data, entity="partido"):
    return proxy.proxy_parts(d.electorate, d.results, entity)


@query("L7_proxy_parts", f"select * exclude (votos_proxy), {r6('votos_proxy')} as votos_proxy from p_parts")
def l7(d):
    return parts(d)


@cache
def entity_profile_sql(level, top=10, r6=r6):
    """r6=str leaves values unrounded for use as a source."""
    loc, group = place(level)
    scope = f"{group}, cargo, turno"
    return f"""
  with c as (select {loc}, cargo, turno, entidade, perfil_combinado, sum(votos_proxy) as votos from p_parts where votos_proxy > 0 group by {scope}, entidade, perfil_combinado),
  t as (select {scope}, entidade, sum(votos) as tot from c group by {scope}, entidade),
  e as (select *, row_number() over (partition by {scope} order by round(tot, 6) desc, entidade) as rank_entidade, max(tot) over (partition by {scope}) as lider from t),
  f as (select c.*, e.tot, e.rank_entidade, e.lider,
    row_number() over (partition by {', '.join('c.' + x.strip() for x in scope.split(','))}, c.entidade order by round(votos, 6) desc, perfil_combinado) as rank_perfil_entidade_ano
    from c join e using ({scope}, entidade))
  select nivel, ano, uf, cd_municipio, nm_municipio, cargo, turno, entidade, perfil_combinado, 'partido' as tipo_entidade, rank_entidade, rank_perfil_entidade_ano,
    {r6('votos')} as votos, {r6('tot')} as votos_entidade_total, {r6('lider')} as votos_lider, {r6('votos / tot')} as share_perfil_na_entidade,
    case when rank_entidade = 1 then 'vencedor' else 'nao_vencedor' end as resultado_eleitoral, {r6('lider - tot')} as margem_votos_para_lider
  from f where rank_perfil_entidade_ano <= {top}"""


def entity_profile_table(d: Data, level: str, top: int | None = 10):
    if top is None:
        return proxy.profile_entity_level(parts(d), level, top=None)
    return proxy.leading_profiles(d.electorate, d.results, [level], top=top)[0]


def _register_entity_profile(level):
    prefix = "L8_profile_entity" if level == "municipio" else "L9_profile_entity"

    @query(f"{prefix}_{level}", entity_profile_sql(level), drop=("descricao",))
    def run(d):
        return entity_profile_table(d, level)


for _level in LEVELS:
    _register_entity_profile(_level)

_ALL = " union all ".join(
    f"select {place(lv)[0]}, cargo, turno, entidade, perfil_combinado, sum(votos_proxy) as votos from p_parts group by {place(lv)[1]}, cargo, turno, entidade, perfil_combinado"
    for lv in LEVELS
)
_ES = "nivel, ano, uf, cd_municipio, cargo, turno, entidade"


@query("L10_profile_entity_all_levels", f"""
  select * exclude (votos, s), {r6('votos')} as votos, {r6('s')} as share_perfil_na_entidade, 'partido' as tipo_entidade from (
    select *, votos / sum(votos) over (partition by {_ES}) as s,
           row_number() over (partition by {_ES} order by round(votos, 6) desc, perfil_combinado) as rank_perfil_entidade_ano from ({_ALL}))
  where rank_perfil_entidade_ano <= 10""")
def l10(d):
    return proxy.leading_profiles_all_levels(d.electorate, d.results)


_TOP_ALL = " union all ".join(
    f"select {place(lv)[0]}, perfil_combinado, cast(sum(e) as double) as eleitorado from v group by {place(lv)[1]}, perfil_combinado" for lv in LEVELS
)


@query("L11_top_profiles_all_levels", f"""
  with v as (select ano, uf, cd_municipio, max(nm_municipio) as nm_municipio, {COMBO} as perfil_combinado, sum(eleitorado) as e from electorate group by ano, uf, cd_municipio, {COMBO})
  select * exclude (s), {r6('s')} as share_perfil from (
    select *, eleitorado / sum(eleitorado) over (partition by nivel, ano, uf, cd_municipio) as s,
           row_number() over (partition by nivel, ano, uf, cd_municipio order by eleitorado desc, perfil_combinado) as rank_perfil_ano from ({_TOP_ALL}))
  where rank_perfil_ano <= 10""", drop=("descricao",))
def l11(d):
    return levels.top_profiles_all_levels(d.electorate)


_PT = "nivel, ano, uf, cd_municipio, nm_municipio, perfil_combinado, eleitorado, share_perfil, rank_perfil_ano"


@query("L12_top_profiles_union", " union all ".join(f"select {_PT} from ({profile_sql(lv)}) where rank_perfil_ano <= 10" for lv in LEVELS), drop=("descricao",))
def l12(d):
    return levels.top_profiles_union([profile_table(d, lv) for lv in LEVELS])


_PE = "nivel, ano, uf, cd_municipio, nm_municipio, cargo, turno, entidade, perfil_combinado, votos, share_perfil_na_entidade, rank_perfil_entidade_ano, tipo_entidade"


@query("L13_profile_entity_union", " union all ".join(f"select {_PE} from ({entity_profile_sql(lv)})" for lv in LEVELS), drop=("descricao",))
def l13(d):
    return proxy.profile_entity_union(proxy.leading_profiles(d.electorate, d.results, LEVELS))


# ---- L14 - L20 ------------------------------------------------------------------------

cte("l_period", f"""
  select ano, dimensao_perfil, valor_perfil, eleitorado, eleitorado / sum(eleitorado) over (partition by ano, dimensao_perfil) as s,
         row_number() over (partition by ano, dimensao_perfil order by eleitorado desc, valor_perfil) as rank_dimensao_ano
  from ({' union all '.join(f"select ano, '{x.replace('perfil_', '')}' as dimensao_perfil, {x} as valor_perfil, cast(sum(eleitorado) as double) as eleitorado from electorate where {ok(x)} group by ano, {x}" for x in DIMS)})""")


@query("L14_profile_by_period", f"select * exclude (s), {r6('s')} as share_eleitorado_ano from l_period")
def l14(d):
    return levels.profile_by_period(d.electorate)


for _name, _scope in {"municipal": ["uf", "cd_municipio", "nm_municipio"], "uf": ["uf"], "nacional": []}.items():
    _cols = ", ".join(["ano", *_scope])

    def _register_timeline(name=_name, scope=_scope, cols=_cols):
        @query(f"L15_timeline_{name}", f"select {cols}, {dsum(TURN)}, 'timeline_{name}' as tipo_timeline from e_section group by {cols}")
        def run(d):
            return levels.timeline(d.electorate, scope, f"timeline_{name}")

        @query(f"L16_timeline_from_summary_{name}", f"select {cols}, {dsum(TURN)}, 'timeline_{name}' as tipo_timeline from l_summary group by {cols}")
        def run16(d):
            return levels.timelines_from_summary(levels.summary_municipality(d.electorate, d.results))[f"timeline_{name}"]

    _register_timeline()


@query("L17_municipal_portrait", f"""
  select *, {RATES} from (select ano, uf, cd_municipio, nm_municipio, {dsum(TURN + BALLOTS)}, cast(sum(qtd_secoes) as bigint) as qtd_secoes
  from l_summary group by ano, uf, cd_municipio, nm_municipio)""")
def l17(d):
    return levels.municipal_portrait(levels.summary_municipality(d.electorate, d.results))


@query("L17_electorate_portrait", f"""
  select e.*, coalesce(r.votos, 0) as votos from (select ano, uf, cd_municipio, nm_municipio, {dsum(TURN)} from e_section group by all) e
  left join (select ano, uf, cd_municipio, nm_municipio, cast(sum(votos) as double) as votos from results group by all) r using (ano, uf, cd_municipio, nm_municipio)""")
def l17b(d):
    return levels.electorate_portrait(d.electorate, d.results)


@query("L18_candidate_profile", f"""
  select ano, uf, cd_municipio, nm_municipio, cargo, partido, candidato, {COMBO} as perfil_candidato, count(*) as qtd_registros_candidato
  from candidates where {ok('candidato')} group by all""")
def l18(d):
    return levels.candidate_profile(d.candidates)


_M = ("votos", "eleitorado", "comparecimento_estimado", "abstencao_estimado", "brancos", "nulos", "validos_estimados")
_MC = "ano, uf, cd_municipio, nm_municipio, cargo, turno"
_B = tuple(m for m in _M if m not in TURN)
# Head counts once per section contest, from the electorate.
cte("contest_heads", f"""
  select * from (select {CONTEST}, max(nm_municipio) as nm_municipio from results where votos > 0 group by {CONTEST})
  left join (select {SECTION}, eleitorado, comparecimento_estimado, abstencao_estimado from e_section) using ({SECTION})""")
cte("municipal", f"""
  with e as (select {_MC}, partido as entidade, {dsum(_B)} from base group by {_MC}, partido),
  k as (select *, row_number() over (partition by {_MC} order by votos desc, entidade) as rk from e),
  p as (select {_MC}, max(case when rk = 1 then entidade end) as lider, max(case when rk = 1 then votos end) as votos_lider,
        max(case when rk = 2 then entidade end) as segundo, max(case when rk = 2 then votos end) as votos_segundo from k group by {_MC}),
  m as (select * from (select {_MC}, {dsum(_B)} from e group by {_MC}) join (select {_MC}, {dsum(TURN)} from contest_heads group by {_MC}) using ({_MC})),
  q as (select *, comparecimento_estimado / nullif(eleitorado, 0) as pct_comparecimento, abstencao_estimado / nullif(eleitorado, 0) as pct_abstencao,
        (coalesce(votos_lider, 0) - coalesce(votos_segundo, 0)) / nullif(votos, 0) as margem_lider, cast(ano as integer) as ano_num from m left join p using ({_MC}))
  select *, 1 - least(greatest(margem_lider, 0), 1) as competitividade from q""")


def _lags():
    out = []
    for m in ("votos", "eleitorado", "pct_comparecimento", "pct_abstencao", "competitividade"):
        lag = f"lag({m}) over w"
        out += [f"{r6(lag)} as {m}_lag", f"{r6(f'{m} - {lag}')} as {m}_delta", f"{r6(f'({m} - {lag}) / nullif(abs({lag}), 0)')} as {m}_delta_pct"]
    return ", ".join(out)


@query("L19_consolidate_municipal", f"""
  select * exclude (pct_comparecimento, pct_abstencao, margem_lider, competitividade), {r6('pct_comparecimento')} as pct_comparecimento,
    {r6('pct_abstencao')} as pct_abstencao, {r6('margem_lider')} as margem_lider, {r6('competitividade')} as competitividade, {_lags()}
  from municipal window w as (partition by uf, cd_municipio, cargo, turno order by ano_num)""")
def l19(d):
    return levels.consolidate_municipal(d.base)


for _name, _cols in {"nacional": "ano, cargo, turno", "uf": "ano, uf, cargo, turno"}.items():

    def _register_full(name=_name, cols=_cols):
        @query(f"L20_timeline_{name}", f"""
  select *, {frac('comparecimento_estimado', 'eleitorado')} as pct_comparecimento, {frac('abstencao_estimado', 'eleitorado')} as pct_abstencao
  from (select {cols}, {dsum(_B)} from base group by {cols}) join (select {cols}, {dsum(TURN)} from contest_heads group by {cols}) using ({cols})""")
        def run(d):
            return levels.timelines_full(d.base)[f"timeline_{name}"]

    _register_full()

cte("tl_entities", """select *, votos / sum(votos) over (partition by ano, cargo, turno) as share
  from (select ano, cargo, turno, partido as entidade, sum(votos) as votos from base group by all)""")


@query("L20_timeline_entidades", f"select * exclude (share), {r6('share')} as share from tl_entities")
def l20(d):
    return levels.timelines_full(d.base)["timeline_entidades"]


# ---- K1 - K3 --------------------------------------------------------------------------

K = 6


def bucket(x):
    return f"cast('0x' || substr(md5({x}), 1, 8) as bigint) % {K}"


cte("k_profiles", f"""
  select 'municipio' as nivel, ano, uf, cd_municipio, nm_municipio, {DIM_LIST}, perfil_combinado, '' as partido, eleitorado, cast(0 as double) as votos_proxy,
         {bucket('perfil_combinado')} as cluster_id, 'eleitores_discretos' as cluster_tipo, 'DiscreteProfileHash' as algoritmo_cluster,
         'sexo_genero, escolaridade, estado_civil, faixa_etaria, raca_cor' as tipo_features_cluster
  from (select ano, uf, cd_municipio, max(nm_municipio) as nm_municipio, {DIM_LIST}, {COMBO} as perfil_combinado, cast(sum(eleitorado) as double) as eleitorado
        from electorate where eleitorado > 0 group by ano, uf, cd_municipio, {DIM_LIST}) where {ok('perfil_combinado')}""")
cte("k_parties", f"""
  select 'municipio' as nivel, ano, uf, cd_municipio, max(nm_municipio) as nm_municipio, {', '.join(f"'' as {x}" for x in DIMS)}, perfil_combinado, entidade as partido,
         cast(0 as double) as eleitorado, sum(votos_proxy) as votos_proxy, {bucket("perfil_combinado || '|' || entidade")} as cluster_id,
         'eleitores_resultado_discreto' as cluster_tipo, 'DiscreteProfilePartyHash' as algoritmo_cluster, 'perfil_eleitor_discreto + partido' as tipo_features_cluster
  from p_parts where votos_proxy > 0 group by ano, uf, cd_municipio, perfil_combinado, entidade""")


def persona_sql(source, scope, weight, r6=r6):
    extra = f"{r6('peso_cluster')} as peso_cluster," if weight == "peso_cluster" else ""
    drop = ", peso_cluster" if weight == "peso_cluster" else ""
    return f"""
  select * exclude (s, eleitorado, votos_proxy{drop}), {extra} {r6('eleitorado')} as eleitorado, {r6('votos_proxy')} as votos_proxy, {r6('s')} as share_cluster from (
    select *, {weight} / nullif(sum({weight}) over (partition by {scope}), 0) as s,
           row_number() over (partition by {scope}, cluster_id order by round({weight}, 6) desc, perfil_combinado, partido, {DIM_LIST}) as rank_persona_cluster from {source})
  where rank_persona_cluster <= 5"""


def k_table(d: Data, kind: str, top: int | None = 5):
    if kind == "eleitores":
        return hash_clusters.hash_clusters_profile(d.electorate, K, top=top)
    return hash_clusters.hash_clusters_profile_entity(parts(d), K, top=top)


def k_buckets(d: Data, kind: str):
    if kind == "eleitores":
        return hash_clusters.profile_bucket_totals(d.electorate, K)
    return hash_clusters.profile_party_bucket_totals(parts(d), K)


@query("K1_hash_clusters_profile", persona_sql("k_profiles", "ano, uf, cd_municipio", "eleitorado"), drop=("descricao",))
def k1(d):
    return k_table(d, "eleitores")


@query("K2_hash_clusters_profile_entity", persona_sql("k_parties", "ano, uf, cd_municipio", "votos_proxy"), drop=("descricao",))
def k2(d):
    return k_table(d, "resultado")


def k3_sql(kind, level, r6=r6):
    loc, group = place(level)
    source = "k_profiles" if kind == "eleitores" else "k_parties"
    keys = f"cluster_id, cluster_tipo, {DIM_LIST}, perfil_combinado, partido, algoritmo_cluster, tipo_features_cluster"
    inner = f"""(select *, greatest(eleitorado, votos_proxy) as peso_cluster from (select {loc}, {keys}, sum(eleitorado) as eleitorado, sum(votos_proxy) as votos_proxy
      from {source} group by {group}, {keys}))"""
    return persona_sql(inner, f"{group}, cluster_tipo", "peso_cluster", r6)


for _kind in ("eleitores", "resultado"):
    for _level in ("estado", "brasil"):

        def _register_k3(kind=_kind, level=_level):
            @query(f"K3_cluster_rollup_{kind}_{level}", k3_sql(kind, level), drop=("descricao",))
            def run(d):
                return hash_clusters.cluster_rollup(k_buckets(d, kind), level)

        _register_k3()

# ---- H1 - H8 --------------------------------------------------------------------------


def hist_sql(source: str, ids: str, dims: dict[str, str], measures: dict[str, str], weight: str, scope: str, dim: str, value: str, ties: str, bars: str, extra: str = "", top: int = 200, r6=r6) -> str:
    """dims: dimension name -> value expression; measures: name -> expression."""
    union = " union all ".join(
        f"select {ids}, '{n}' as {dim}, {x} as {value}, {', '.join(f'{e} as {m}' for m, e in measures.items())} from ({source})" for n, x in dims.items()
    )
    total = ", ".join(f"sum({m}) as {m}" for m in measures)
    names = ", ".join(r6(m) + f" as {m}" if m != "qtd_registros" else f"cast({m} as bigint) as {m}" for m in measures)
    return f"""
  select * exclude (s, {', '.join(measures)}), {names}, {r6('s')} as share_histograma{extra},
    case when {dim} in ({bars}) then 'barra' else 'pizza_barra' end as grafico_sugerido from (
    select *, {weight} / sum({weight}) over (partition by {scope}, {dim}) as s,
      row_number() over (partition by {scope}, {dim} order by round({weight}, 6) desc, {ties}) as rank_histograma
    from (select {ids}, {dim}, {value}, {total} from ({union}) where {ok(value)} group by all) where {weight} > 0)
  where rank_histograma <= {top}"""


_PLACE = "nivel, ano, uf, cd_municipio, nm_municipio"
_SCOPE = "nivel, ano, uf, cd_municipio"


def _part(label):
    return f"nullif(trim(regexp_extract(perfil_combinado, '{label}=([^;]+)', 1)), '')"


_WIDE = {"perfil_combinado": "perfil_combinado", **{n: f"coalesce(case when {ok(c)} then {c} end, {_part(n)}, '')" for c, n in zip(DIMS, DIM_LABELS)}}
_FROM_COMBO = {"perfil_combinado": "perfil_combinado", **{n: f"coalesce({_part(n)}, '')" for n in DIM_LABELS}}
_RATES_H = f", {frac('comparecimento_estimado', 'qtd_pessoas')} as taxa_comparecimento, {frac('abstencao_estimado', 'qtd_pessoas')} as taxa_abstencao, 'perfil_eleitor' as tipo_histograma"


def h1_sql(level, r6=r6):
    return hist_sql(profile_sql(level), _PLACE, _WIDE, {"qtd_pessoas": "eleitorado", "comparecimento_estimado": "comparecimento_estimado", "abstencao_estimado": "abstencao_estimado"},
                    "qtd_pessoas", _SCOPE, "dimensao_perfil", "valor_perfil", "valor_perfil", "'perfil_combinado'", _RATES_H, r6=r6)


_RDIMS = {
    "entidade": "entidade", "cargo": "cargo", "turno": "turno", "resultado_eleitoral": "resultado_eleitoral", "resultado_grupo": "resultado_grupo",
    "faixa_rank": "case when rank_entidade = 1 then 'rank_1_lider' when rank_entidade <= 5 then 'rank_2_a_5' when rank_entidade <= 10 then 'rank_6_a_10' else 'rank_11_a_50' end",
    "faixa_share_votos": "case when share_votos >= 0.50 then '50% ou mais' when share_votos >= 0.30 then '30% a 49,9%' when share_votos >= 0.10 then '10% a 29,9%' when share_votos > 0 then 'menos de 10%' else '' end",
}


def h3_sql(level, source="l_parties", top=50):
    return hist_sql(results_sql(level, source, top), _PLACE + ", cargo, turno, tipo_entidade", _RDIMS,
                    {"qtd_votos": "votos", "brancos": "brancos", "nulos": "nulos", "validos_estimados": "validos_estimados", "qtd_registros": "1"},
                    "qtd_votos", _SCOPE + ", tipo_entidade", "dimensao_resultado", "valor_resultado", "valor_resultado, cargo, turno", "'entidade', 'cargo'")


def h5_sql(level, r6=r6):
    return hist_sql(entity_profile_sql(level, r6=str), _PLACE + ", cargo, turno, tipo_entidade, entidade, resultado_eleitoral", _FROM_COMBO, {"qtd_votos": "votos"},
                    "qtd_votos", _SCOPE + ", cargo, turno, tipo_entidade, entidade", "dimensao_perfil", "valor_perfil", "valor_perfil, resultado_eleitoral", "'perfil_combinado'", ", 'perfil_partido' as tipo_histograma", r6=r6)


def h7_sql(kind, level, r6=r6):
    if level == "municipio":
        source = persona_sql("k_profiles" if kind == "eleitores" else "k_parties", "ano, uf, cd_municipio", "eleitorado" if kind == "eleitores" else "votos_proxy", str)
    else:
        source = k3_sql(kind, level, str)
    return hist_sql(source, _PLACE + ", cluster_id, cluster_tipo, partido", _WIDE, {"qtd_pessoas": "greatest(eleitorado, votos_proxy)"},
                    "qtd_pessoas", _SCOPE + ", cluster_id", "dimensao_perfil", "valor_perfil", "valor_perfil, cluster_tipo, partido", "'perfil_combinado'", f", '{kind}' as tipo_histograma", r6=r6)


for _level in LEVELS:

    def _register_hist(level=_level):
        @query(f"H1_hist_profile_{level}", h1_sql(level))
        def h1(d):
            return histograms.hist_profile(profile_table(d, level))

        for entity, source in (("partido", "l_parties"), ("candidato", "l_names")):

            @query(f"H3_hist_results_{level}_{entity}", h3_sql(level, source))
            def h3(d, entity=entity):
                return histograms.hist_results(results_table(d, level, entity))

        @query(f"H5_hist_profile_entity_{level}", h5_sql(level))
        def h5(d):
            return histograms.hist_profile_entity(entity_profile_table(d, level))

        for kind in ("eleitores", "resultado"):

            @query(f"H7_hist_clusters_{kind}_{level}", h7_sql(kind, level))
            def h7(d, kind=kind):
                clusters = k_table(d, kind) if level == "municipio" else hash_clusters.cluster_rollup(k_buckets(d, kind), level)
                return histograms.hist_clusters(clusters, kind)

    _register_hist()


def _reroll(sql_municipal, level, keys, measures):
    """SQL of a municipal histogram re-summed to a level, as a source for hist-style ranking."""
    loc, group = place(level)
    return f"select {loc}, {keys}, {', '.join(f'sum({m}) as {m}' for m in measures)} from ({sql_municipal}) group by {group}, {keys}"


def _reroll_sql(inner, weight, scope, dim, ties, bars, measures, extra=""):
    names = ", ".join(r6(m) + f" as {m}" if m != "qtd_registros" else f"cast({m} as bigint) as {m}" for m in measures)
    return f"""
  select * exclude (s, {', '.join(measures)}), {names}, {r6('s')} as share_histograma{extra},
    case when {dim} in ({bars}) then 'barra' else 'pizza_barra' end as grafico_sugerido from (
    select *, {weight} / sum({weight}) over (partition by {scope}, {dim}) as s,
      row_number() over (partition by {scope}, {dim} order by round({weight}, 6) desc, {ties}) as rank_histograma from ({inner}))
  where rank_histograma <= 200"""


for _level in ("estado", "brasil"):

    def _register_reroll(level=_level):
        people = ["qtd_pessoas", "comparecimento_estimado", "abstencao_estimado"]
        rates = f", {frac('comparecimento_estimado', 'qtd_pessoas')} as taxa_comparecimento, {frac('abstencao_estimado', 'qtd_pessoas')} as taxa_abstencao"

        @query(f"H2_hist_profile_rollup_{level}", _reroll_sql(
            _reroll(h1_sql("municipio"), level, "tipo_histograma, dimensao_perfil, valor_perfil", people),
            "qtd_pessoas", _SCOPE, "dimensao_perfil", "valor_perfil", "'perfil_combinado'", people, rates))
        def h2(d):
            return histograms.hist_profile_rollup(histograms.hist_profile(profile_table(d, "municipio")), level)

        votes = ["qtd_votos", "brancos", "nulos", "validos_estimados", "qtd_registros"]

        @query(f"H4_hist_results_rollup_{level}", _reroll_sql(
            _reroll(h3_sql("municipio"), level, "cargo, turno, tipo_entidade, dimensao_resultado, valor_resultado", votes),
            "qtd_votos", _SCOPE + ", tipo_entidade", "dimensao_resultado", "valor_resultado, cargo, turno", "'entidade', 'cargo'", votes))
        def h4(d):
            return histograms.hist_results_rollup(histograms.hist_results(results_table(d, "municipio")), level)

        @query(f"H6_hist_profile_entity_rollup_{level}", _reroll_sql(
            _reroll(h5_sql("municipio", str), level, "cargo, turno, tipo_entidade, entidade, resultado_eleitoral, tipo_histograma, dimensao_perfil, valor_perfil", ["qtd_votos"]),
            "qtd_votos", _SCOPE + ", cargo, turno, tipo_entidade, entidade", "dimensao_perfil", "valor_perfil, resultado_eleitoral", "'perfil_combinado'", ["qtd_votos"]))
        def h6(d):
            return histograms.hist_profile_entity_rollup(histograms.hist_profile_entity(entity_profile_table(d, "municipio")), level)

        for kind in ("eleitores", "resultado"):

            @query(f"H8_hist_clusters_rollup_{kind}_{level}", _reroll_sql(
                _reroll(h7_sql(kind, "municipio", str), level, "tipo_histograma, cluster_id, cluster_tipo, partido, dimensao_perfil, valor_perfil", ["qtd_pessoas"]),
                "qtd_pessoas", _SCOPE + ", cluster_id", "dimensao_perfil", "valor_perfil, cluster_tipo, partido", "'perfil_combinado'", ["qtd_pessoas"]))
            def h8(d, kind=kind):
                return histograms.hist_clusters_rollup(histograms.hist_clusters(k_table(d, kind), kind), level)

    _register_reroll()

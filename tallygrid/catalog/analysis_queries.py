"""A and B: electoral analyses and behaviour."""

from __future__ import annotations

from ..operators import analyses as an
from ..operators import behaviour as be
from ..operators import sections
from .base import COMBO, CONTEST, DIM_LIST, DIMS, SECTION, cte, frac, ok, query, r6
from .level_queries import LEVELS, place

D4 = ", ".join(DIMS[:4])
AC = "ano, cargo, turno"
PC = "ano, uf, cd_municipio, cargo, turno"


@query("A1_electorate_profiles", f"""
  select *, {frac('votos', 't')} as share_no_perfil, {frac('abstencao_estimado', 'eleitorado')} as taxa_abstencao_perfil
  from (select *, sum(votos) over (partition by {AC}, {D4}) as t from (
    select {AC}, {', '.join(f"coalesce({x}, '') as {x}" for x in DIMS[:4])}, entidade, sum(votos) as votos, sum(eleitorado) as eleitorado,
      sum(comparecimento_estimado) as comparecimento_estimado, sum(abstencao_estimado) as abstencao_estimado
    from (select {CONTEST}, {D4}, partido as entidade, sum(votos) as votos from base group by all) v
    left join (select {SECTION}, eleitorado, comparecimento_estimado, abstencao_estimado from e_section) e using ({SECTION}) group by all))""".replace("select *, cast", "select * exclude (t), cast", 1))
def a1(d):
    return an.electorate_profiles(d.base)


cte("a_year", " union all ".join(f"select ano, '{x.replace('perfil_', '')}' as dimensao_perfil, {x} as valor_perfil, cast(sum(eleitorado) as double) as eleitorado from electorate where eleitorado > 0 and trim({x}) <> '' group by ano, {x}" for x in DIMS))
cte("a_year_ranked", """select *, eleitorado / sum(eleitorado) over (partition by ano, dimensao_perfil) as s,
  row_number() over (partition by ano, dimensao_perfil order by eleitorado desc, valor_perfil) as rank_dimensao_ano from a_year""")


@query("A2_profile_by_year", f"select * exclude (s), {r6('s')} as share_eleitorado_ano from a_year_ranked")
def a2(d):
    return an.profile_by_year(d.electorate)


def association_sql(entity, world):
    source = "k where rk <= 3" if world == "top" else "k"
    people = " union all ".join(f"select {SECTION}, '{x.replace('perfil_', '')}' as dimensao_perfil, {x} as valor_perfil, cast(sum(eleitorado) as double) as e from electorate where eleitorado > 0 and trim({x}) <> '' group by all" for x in DIMS)
    return f"""
  with v as (select {CONTEST}, {entity} as entidade, cast(sum(votos) as double) as votos from results where votos > 0 and trim({entity}) <> '' group by {CONTEST}, {entity}),
  k as (select *, votos / sum(votos) over (partition by {CONTEST}) as s, row_number() over (partition by {CONTEST} order by votos desc, entidade) as rk from v),
  g as (select *, gv / sum(gv) over (partition by {AC}) as share_global_entidade from (select {AC}, entidade, sum(votos) as gv from {source} group by {AC}, entidade)),
  p as ({people}),
  x as (select {AC}, dimensao_perfil, valor_perfil, entidade, sum(e * s) as proxy from p join (select * from k where rk <= 3) using ({SECTION}) group by {AC}, dimensao_perfil, valor_perfil, entidade),
  n as (select ano, dimensao_perfil, valor_perfil, sum(e) as eleitorado_perfil_recorte from p group by ano, dimensao_perfil, valor_perfil)
  select {AC}, dimensao_perfil, valor_perfil, entidade, proxy, eleitorado_perfil_recorte, share_global_entidade, proxy / eleitorado_perfil_recorte as sp,
         proxy / eleitorado_perfil_recorte / share_global_entidade as lift
  from x join n using (ano, dimensao_perfil, valor_perfil) join g using ({AC}, entidade)"""


def association_out(entity, world, extra=""):
    return f"""select {AC}, dimensao_perfil, valor_perfil, entidade, {r6('proxy')} as votos_proxy_perfil_entidade, eleitorado_perfil_recorte,
    {r6('share_global_entidade')} as share_global_entidade, {r6('sp')} as share_proxy_no_perfil, {r6('lift')} as lift_perfil_entidade_proxy{extra}
    from ({association_sql(entity, world)})"""


@query("A3_profile_vote_association", association_out("partido", "all"))
def a3(d):
    return an.profile_vote_association(d.results, d.electorate)


@query("A3_profile_vote_association_top_global", association_out("partido", "top"))
def a3top(d):
    return an.profile_vote_association(d.results, d.electorate, global_from="top")


@query("A4_result_electorate_correlation", " union all ".join(association_out(e, "all", f", '{e}' as tipo_entidade") for e in ("partido", "candidato")))
def a4(d):
    return an.result_electorate_correlation(d.results, d.electorate)


cte("a_trend", f"""select *, votos / sum(votos) over (partition by {AC}) as share, cast(ano as integer) as ano_num
  from (select {AC}, partido as entidade, cast(sum(votos) as double) as votos from results group by {AC}, partido)""")


@query("A5_vote_trends", f"""
  select * exclude (share), {r6('share')} as share, lag(votos) over w as votos_lag, {r6('lag(share) over w')} as share_lag, votos - lag(votos) over w as delta_votos,
    {r6('share - lag(share) over w')} as delta_share, {r6('(votos - lag(votos) over w) / nullif(abs(lag(votos) over w), 0)')} as crescimento_votos_pct,
    case when share - lag(share) over w > 0 then 'crescimento' when share - lag(share) over w < 0 then 'queda' else 'estavel/sem_lag' end as curva
  from a_trend window w as (partition by cargo, turno, entidade order by ano_num)""")
def a5(d):
    return an.vote_trends(d.results)


def pattern_sql(source, key, measure, share, rank, n, extra=""):
    k = f", {key}" if key else ""
    union = " union all ".join(f"select {place(lv)[0]}{k}, perfil_combinado, sum({measure}) as {measure} from ({source}) group by {place(lv)[1]}{k}, perfil_combinado" for lv in LEVELS)
    scope = f"nivel, ano, uf, cd_municipio{k}"
    lag_s, lag_m = "lag(s) over w", f"lag({measure}) over w"
    return f"""
  select * exclude (s), {r6('s')} as {share}, {r6(lag_s)} as {share}_ano_anterior, {r6(f's - {lag_s}')} as {share}_delta, {lag_m} as {measure}_ano_anterior,
    {measure} - {lag_m} as {measure}_delta{extra},
    case when s - {lag_s} > 0.02 then 'crescimento' when s - {lag_s} < -0.02 then 'queda' else 'estavel/sem historico' end as padrao_temporal
  from (select *, {measure} / sum({measure}) over (partition by {scope}) as s, cast(ano as integer) as ano_num,
               row_number() over (partition by {scope} order by round({measure}, 6) desc, perfil_combinado) as {rank} from ({union}))
  where {rank} <= {n} window w as (partition by nivel, uf, cd_municipio{k}, perfil_combinado order by ano_num)"""


_E_COMBO = f"select ano, uf, cd_municipio, nm_municipio, {COMBO} as perfil_combinado, cast(eleitorado as double) as eleitorado from electorate where {ok(COMBO)}"
_B_COMBO = f"select ano, uf, cd_municipio, nm_municipio, partido as entidade, {COMBO} as perfil_combinado, votos from base where {ok(COMBO)}"


@query("A6_annual_profile_patterns", pattern_sql(_E_COMBO, "", "eleitorado", "share_perfil", "rank_perfil_ano", 10))
def a6(d):
    return an.annual_profile_patterns(d.electorate)


@query("A7_annual_entity_profile_patterns", pattern_sql(_B_COMBO, "entidade", "votos", "share_perfil_na_entidade", "rank_perfil_entidade_ano", 10, ", 'partido' as tipo_entidade"))
def a7(d):
    return an.annual_entity_profile_patterns(d.base)


@query("A8_top_profiles_by_scope", pattern_sql(_E_COMBO, "", "eleitorado", "share_perfil", "rank_perfil_ano", 10,
       ", case nivel when 'brasil' then 'Federacao' when 'estado' then uf else nm_municipio end as escopo"), drop=("descricao",))
def a8(d):
    return an.top_profiles_by_scope(d.electorate)


@query("A9_party_identification", f"""
  select * exclude (t), {frac('votos', 't')} as share_partidario, false as ideologia_disponivel_no_dado, false as coalizao_disponivel_no_dado
  from (select *, sum(votos) over (partition by {PC}) as t from (select {PC}, partido, cast(sum(votos) as double) as votos from results group by {PC}, partido))""")
def a9(d):
    return an.party_identification(d.results)


def dominant_sql(keys, source, weight, dims=DIMS, blank="SEM_VALOR", cond="true"):
    """One CTE-free select per dimension joined by key: value and weight of the heaviest value."""
    parts = []
    for x in dims:
        value = f"coalesce(nullif(trim({x}), ''), '{blank}')" if blank is not None else x
        where = cond if blank is not None else f"{cond} and trim(coalesce({x}, '')) <> ''"
        parts.append(f"""(select {keys}, v as {x}_v, w as {x}_w, s as {x}_s from (select *, w / nullif(sum(w) over (partition by {keys}), 0) as s,
          row_number() over (partition by {keys} order by w desc, v) as rn from (select {keys}, {value} as v, sum({weight}) as w from {source} where {where} group by {keys}, v)) where rn = 1)""")
    return parts


def _voter_sql(keys, entity):
    joins = " ".join(f"left join {p} using ({keys})" for p in dominant_sql(keys, "base", "votos"))
    cols = ", ".join(f"{x}_v as {x}_dominante, {frac(f'{x}_w', 't')} as {x}_share_no_{entity}" for x in DIMS)
    return f"select {keys}, t as votos_{entity}, {cols}, '{entity}' as tipo_entidade, {entity} as entidade from (select {keys}, sum(votos) as t from base group by {keys}) {joins}"


for _entity in ("partido", "candidato"):

    def _register_voter(entity=_entity):
        @query(f"A10_entity_voter_profile_{entity}", _voter_sql(f"{AC}, {entity}", entity), drop=(f"pessoa_do_{entity}",))
        def run(d):
            return an.entity_voter_profile(d.base, entity)

    _register_voter()

_CK = f"{AC}, partido, candidato"


def _names_sql(column, out):
    return f"""(select {_CK}, string_agg(x, '; ' order by rn) as {out} from (select *, row_number() over (partition by {_CK} order by w desc, x) as rn from
      (select {_CK}, {column} as x, sum(votos) as w from base group by {_CK}, {column})) where rn <= 5 group by {_CK})"""


@query("A11_candidate_with_electorate", f"""
  select {_CK}, t as votos_candidato, {', '.join(f'{x}_v as {x}_eleitorado_associado' for x in DIMS)}, 'candidato' as tipo_entidade, candidato as entidade, ufs_principais, municipios_principais
  from (select {_CK}, sum(votos) as t from base group by {_CK}) {' '.join(f'left join {p} using ({_CK})' for p in dominant_sql(_CK, 'base', 'votos'))}
  left join {_names_sql('uf', 'ufs_principais')} using ({_CK}) left join {_names_sql('nm_municipio', 'municipios_principais')} using ({_CK})""", drop=("pessoa_do_candidato",))
def a11(d):
    return an.candidate_with_electorate(d.base)


cte("a_place", f"""select *, votos / sum(votos) over (partition by {PC}) as share, cast(ano as integer) as y
  from (select {PC}, partido as entidade, cast(sum(votos) as double) as votos from results group by {PC}, partido)""")


@query("A12_rejection_proxy", f"select * exclude (share, y), {r6('share')} as share, {r6('1 - share')} as proxy_rejeicao_territorial from a_place")
def a12(d):
    return an.rejection_proxy(d.results)


@query("A13_crystallisation", f"""
  select uf, cd_municipio, cargo, turno, entidade, n as anos_observados, v as votos_total, {r6('m')} as share_medio, {r6('sd')} as share_std,
    case when n > 1 then {r6('m * (1 - least(greatest(coalesce(sd, 0), 0), 1))')} end as indice_cristalizacao
  from (select uf, cd_municipio, cargo, turno, entidade, avg(share) as m, stddev_samp(share) as sd, count(share) as n, sum(votos) as v from a_place group by all)""")
def a13(d):
    return an.crystallisation(d.results)


def transfer_sql(extra=""):
    return f"""
  select * exclude (sc), {r6('sc')} as score_coocorrencia, {r6(f'sc / sum(sc) over (partition by ano_origem, ano_destino{extra}, entidade_origem)')} as transferencia_proxy
  from (select a.y as ano_origem, b.y as ano_destino{extra}, a.entidade as entidade_origem, b.entidade as entidade_destino, sum(a.share * b.share) as sc
        from a_place a join a_place b using (uf, cd_municipio, cargo, turno) where a.y < b.y group by all)"""


@query("A14_transfer_matrix", transfer_sql())
def a14(d):
    return an.transfer_matrix(d.results)


@query("A14_transfer_matrix_by_contest", transfer_sql(", cargo, turno"))
def a14c(d):
    return an.transfer_matrix(d.results, contest_in_scope=True)


@query("A15_strategic_vote", f"""
  with t as (select {PC}, cast(ano as integer) as ano_num, sum(case when rk <= 2 then share end) as top2, coalesce(sum(case when share < 0.05 then share end), 0) as menor, count(distinct entidade) as entidades
    from (select *, row_number() over (partition by {PC} order by share desc, entidade) as rk from a_place) group by {PC})
  select {PC}, ano_num, entidades, {r6('top2')} as top2_share, {r6('menor')} as menor_share, {r6('lag(top2) over w')} as top2_share_lag, {r6('lag(menor) over w')} as menor_share_lag,
    {r6('(top2 - lag(top2) over w) + (lag(menor) over w - menor)')} as indicador_voto_util_proxy
  from t window w as (partition by uf, cd_municipio, cargo, turno order by ano_num)""")
def a15(d):
    return an.strategic_vote(d.results)


_WIN = f"""(select *, share_v - coalesce(lead(share_v) over (partition by {CONTEST} order by rk), 0) as margem from (
    select *, votos / sum(votos) over (partition by {CONTEST}) as share_v, row_number() over (partition by {CONTEST} order by votos desc, entidade) as rk
    from (select {CONTEST}, partido as entidade, sum(votos) as votos from base group by {CONTEST}, partido)))"""


@query("A17_qa_facts", f"""
  select 'perfil_dominante' as fato, ano || '|' || dimensao_perfil || '|' || valor_perfil as chave, {r6('s')} as valor from a_year_ranked where rank_dimensao_ano = 1
  union all (select 'maior_lift', concat_ws('|', {AC}, dimensao_perfil, valor_perfil, entidade), {r6('lift')} from ({association_sql('partido', 'all')})
    order by round(lift, 6) desc, {AC}, dimensao_perfil, valor_perfil, entidade limit 12)
  union all (select 'vencedor_recorrente', entidade, cast(count(*) as double) from {_WIN} where rk = 1 group by entidade order by count(*) desc, entidade limit 8)
  union all select 'resumo_vitorias', 'recortes', cast(count(*) as double) from {_WIN} where rk = 1
  union all select 'resumo_vitorias', 'share_medio_vencedor', {r6('avg(share_v)')} from {_WIN} where rk = 1
  union all select 'resumo_vitorias', 'margem_media', {r6('avg(margem)')} from {_WIN} where rk = 1
  union all select 'resumo_vitorias', 'vitorias_apertadas', cast(count(*) as double) from {_WIN} where rk = 1 and margem < 0.03""")
def a17(d):
    return an.qa_facts(d.electorate, an.profile_vote_association(d.results, d.electorate), sections.section_results_ranked(d.base))


# ---- B --------------------------------------------------------------------------------

_U = f"{AC}, uf, cd_municipio, nm_municipio, zona, secao, {DIM_LIST}"
cte("panel", f"""
  select *, votos / nullif(sum(votos) over (partition by {_U}), 0) as sh from (
    select {AC}, uf, cd_municipio, nm_municipio, zona, secao, {', '.join(f"coalesce({x}, '') as {x}" for x in DIMS)}, partido, candidato, candidato || ' | ' || partido as entidade_voto,
      sum(votos) as votos, max(eleitorado) as eleitorado, sum(comparecimento_estimado) as comparecimento_estimado, sum(abstencao_estimado) as abstencao_estimado,
      sum(brancos) as brancos, sum(nulos) as nulos from base group by all)""")
_PR = f"{frac('abstencao_estimado', 'eleitorado')} as taxa_abstencao_perfil_secao, {frac('comparecimento_estimado', 'eleitorado')} as taxa_comparecimento_perfil_secao"


@query("B1_behaviour_panel", f"select * exclude (sh), {r6('sh')} as share_voto_no_perfil_secao, {_PR} from panel")
def b1(d):
    return be.behaviour_panel(d.base)


@query("B2_who_votes_for_whom", f"""
  select {_U}, entidade_voto as entidade_dominante, partido, candidato, votos as votos_entidade_dominante, {r6('sh')} as share_entidade_dominante, {_PR}
  from (select *, row_number() over (partition by {_U} order by votos desc, entidade_voto) as rn from panel) where rn = 1""")
def b2(d):
    return be.who_votes_for_whom(be.behaviour_panel(d.base))


@query("B3_profile_affinity", f"""
  select p.* exclude (s), {r6('s')} as share_entidade_no_perfil, {r6('g')} as share_global_entidade, {r6('s / g')} as lift_perfil_entidade from (
    select *, votos / sum(votos) over (partition by {AC}, {DIM_LIST}) as s from (select {AC}, {DIM_LIST}, entidade_voto, sum(votos) as votos from panel group by all)) p
  join (select {AC}, entidade_voto, v / sum(v) over (partition by {AC}) as g from (select {AC}, entidade_voto, sum(votos) as v from panel group by all)) using ({AC}, entidade_voto)""")
def b3(d):
    return be.profile_affinity(be.behaviour_panel(d.base))


@query("B4_behaviour_matrix_totals", f"""
  select {_U}, max(eleitorado) as eleitorado, sum(votos) as votos, {frac('max(a)', 'max(eleitorado)')} as taxa_abstencao, {frac('max(c)', 'max(eleitorado)')} as taxa_comparecimento, {r6('1.0')} as soma_shares
  from (select {_U}, case when entidade_voto in (select entidade_voto from panel group by 1 order by sum(votos) desc, entidade_voto limit 25) then entidade_voto else 'x' end as e,
          sum(votos) as votos, max(eleitorado) as eleitorado, max(abstencao_estimado) as a, max(comparecimento_estimado) as c from panel group by all) group by {_U}""")
def b4(d):
    from pyspark.sql import functions as F

    matrix = be.behaviour_matrix(be.behaviour_panel(d.base), max_entities=25)
    unit = [c.strip() for c in _U.split(",")]
    fixed = [*unit, "eleitorado", "votos", "taxa_abstencao", "taxa_comparecimento"]
    entities = [c for c in matrix.columns if c not in fixed]
    total = sum((F.col(f"`{c}`") for c in entities), F.lit(0.0))
    return matrix.select(*fixed, total.alias("soma_shares"))


_FIXED = f'{_U}, eleitorado, votos, taxa_abstencao, taxa_comparecimento, "OUTRAS_ENTIDADES"'


@query("B4_behaviour_matrix", f"""
  with w as (select {_U}, entidade_voto as e, sum(votos) as votos, max(eleitorado) as el, max(abstencao_estimado) as a, max(comparecimento_estimado) as c from panel group by all),
  t as (select {_U}, max(el) as eleitorado, sum(votos) as votos, {frac('max(a)', 'max(el)')} as taxa_abstencao, {frac('max(c)', 'max(el)')} as taxa_comparecimento, 0::double as "OUTRAS_ENTIDADES" from w group by {_U}),
  s as (select t.*, w.e, w.votos / nullif(t.votos, 0) as share from w join t using ({_U}))
  select {_FIXED}, {r6('coalesce(columns(* exclude (' + _FIXED + ')), 0)')} from (pivot s on e using sum(share) group by {_FIXED})""")
def b4full(d):
    return be.behaviour_matrix(be.behaviour_panel(d.base))

"""M: projection, backtest and party tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import projection as pr
from ..session import materialize
from .base import DIMS, Data, cte, frac, ok, query, r6
from .correlated_queries import corr_sql
from .analysis_queries import dominant_sql
from .level_queries import LEVELS, place

# The star adapter has no polling-place or district columns.
UNIT = "uf, cd_municipio, nm_municipio, zona, secao, cargo, turno"


def model(d: Data, office: str | None = None):
    return pr.model_base(d.base, "partido", office)


def model_sql(where="true"):
    return f"""
  select *, votos / nullif(sum(votos) over (partition by ano, {UNIT}), 0) as share, cast(ano as integer) as ano_num from (
    select ano, {UNIT}, partido as entidade, sum(votos) as votos, max(eleitorado) as eleitorado, max(comparecimento_estimado) as comparecimento_estimado,
      max(abstencao_estimado) as abstencao_estimado from base where {where} group by all)"""


cte("model", model_sql())


@query("M1_model_base", f"select * exclude (share), {r6('share')} as share from model")
def m1(d):
    return model(d)


@query("M1_model_base_office", f"select * exclude (share), {r6('share')} as share from ({model_sql(chr(34) + 'cargo' + chr(34) + ' like ' + chr(39) + '%PROMO%' + chr(39))})")
def m1o(d):
    return model(d, "promo")


@query("M1_model_base_office_unmatched", f"select * exclude (share), {r6('share')} as share from model")
def m1u(d):
    return model(d, "no such office")


@query("M2_backtest", f"""
  select b.ano_num as base_year, r.ano_num as target_year, count(*) as n, {r6('avg(abs(b.share - r.share))')} as mae_share, {r6('sqrt(avg((b.share - r.share) * (b.share - r.share)))')} as rmse_share
  from model r join (select y, lag(y) over (order by y) as p from (select distinct ano_num as y from model)) s on r.ano_num = s.y
  join model b on b.ano_num = s.p and {' and '.join(f'r.{c.strip()} = b.{c.strip()}' for c in UNIT.split(','))} and r.entidade = b.entidade group by 1, 2""")
def m2(d):
    return pr.backtest(model(d))


cte("m_conf", f"""
  select coalesce(least(greatest(avg(case when n >= 10 then abs(spearman) end), 0.05), 0.95), 0.35) as confianca from (""" + corr_sql(
    f"select a.ano_num as p1, b.ano_num as p2, a.share as v1, b.share as v2 from model a join model b using ({UNIT}, entidade) where a.ano_num < b.ano_num",
    "p1, p2", {"n": "n", "spearman": "spearman"}, 0) + ")")


@query("M3_temporal_confidence", f"select {r6('confianca')} as confianca from m_conf")
def m3(d):
    return pr.temporal_confidence(model(d))


cte("swings", f"""
  select *, share - share_lag as swing, ano_num - ano_lag as anos_delta, case when ano_num > ano_lag then (share - share_lag) / (ano_num - ano_lag) end as swing_anual from (
    select *, lag(share) over w as share_lag, lag(ano_num) over w as ano_lag from model window w as (partition by {UNIT}, entidade order by ano_num))""")


@query("M4_historical_swing", f"select * exclude (share, share_lag, swing, swing_anual), {r6('share')} as share, {r6('share_lag')} as share_lag, {r6('swing')} as swing, {r6('swing_anual')} as swing_anual from swings")
def m4(d):
    return pr.historical_swing(model(d))


_SCEN = ", ".join(f"('{s.name}', {s.trend_weight}, {s.turnout_shift})" for s in pr.SCENARIOS)
cte("prepared", """
  select m.*, coalesce(s.mean, 0) as swing_anual_estimado, c.confianca as confianca_temporal_modelo, least(greatest(1.60 - c.confianca, 0.70), 1.80) as sigma_multiplicador_temporal,
    coalesce(s.std, 0.035) * least(greatest(1.60 - c.confianca, 0.70), 1.80) as sigma_estimado, least(greatest(2026 - ano_num, 0), 12) as anos
  from model m left join (select cargo, turno, entidade, avg(swing_anual) as mean, stddev_samp(swing_anual) as std from swings where swing_anual is not null group by all) s using (cargo, turno, entidade), m_conf c
  where ano_num = (select max(ano_num) from model)""")
cte("scen", f"""
  select *, share_pred * coalesce(eleitorado, 0) * turnout as votos_pred from (
    select *, raw / sum(raw) over (partition by cenario, {UNIT}) as share_pred,
      least(greatest(least(greatest(coalesce(comparecimento_estimado / nullif(eleitorado, 0), 0.75), 0.30), 0.98) + shift, 0.30), 0.98) as turnout from (
      select p.*, x.cenario, x.shift, greatest(coalesce(share, 0) + cast(x.w as double) * swing_anual_estimado * anos, 0.000001) as raw
      from prepared p, (values {_SCEN}) x(cenario, w, shift)))""")


def prepared(d: Data):
    # The model feeds the latest rows, the swings and the confidence: written once, read thrice.
    return pr.projection_base(materialize(model(d), "model"))


def projected(d: Data):
    return pr.scenario_projection(prepared(d))


@query("M5_scenario_projection", f"""
  select ano, ano_num, {UNIT}, entidade, cenario, eleitorado, {', '.join(f'{r6(a)} as {b}' for a, b in {'share': 'share', 'share_pred': 'share_pred_2026', 'turnout': 'pct_comparecimento_pred', 'votos_pred': 'votos_pred_2026', 'swing_anual_estimado': 'swing_anual_estimado', 'sigma_estimado': 'sigma_estimado', 'confianca_temporal_modelo': 'confianca_temporal_modelo', 'sigma_multiplicador_temporal': 'sigma_multiplicador_temporal'}.items())}
  from scen""")
def m5(d):
    return projected(d)


@query("M6_scenario_national", f"""
  select cenario, cargo, turno, entidade, {r6('v')} as votos_pred_2026, eleitorado, {r6('v / sum(v) over (partition by cenario, cargo, turno)')} as share_nacional_pred_2026
  from (select cenario, cargo, turno, entidade, sum(votos_pred) as v, sum(eleitorado) as eleitorado from scen group by all)""")
def m6(d):
    return pr.scenario_national(projected(d))


_NOISE = ", ".join(f"('{s.name}', {s.trend_weight}, {s.turnout_shift}, {s.noise})" for s in pr.SCENARIOS)


def _uniform_sql(start: int) -> str:
    return f"((cast('0x' || substr(md5(key), {start}, 13) as bigint) + 0.5::double) / 4503599627370496)"


def _turned_sql(start: str, step: float) -> str:
    """Value r of the sequence from `start`."""
    x = f"({start} + r * {step!r}::double)"
    return f"greatest({x} - floor({x}), 1e-12::double)"


@query("M7_uncertainty_bands")
def m7(d):
    """3000 replicates, as the operator has by default; SQL draws 200 of the same sequence below."""
    return pr.uncertainty_bands(prepared(d))


@query("M7_uncertainty_bands_200", f"""
  with k as (
    select p.*, x.*, concat_ws('|', '42', {UNIT}) || '|' || cenario || '|' || entidade as key,
      least(greatest(least(greatest(coalesce(comparecimento_estimado / nullif(eleitorado, 0), 0.75), 0.30), 0.98) + shift, 0.30), 0.98) as turnout
    from prepared p, (values {_NOISE}) x(cenario, w, shift, noise)),
  y as (select k.*, r, {_uniform_sql(1)} as a, {_uniform_sql(14)} as b from k, range(1, 201) t(r)),
  z as (select *, greatest(coalesce(share, 0) + cast(w as double) * swing_anual_estimado * anos
      + sqrt(-2 * ln({_turned_sql('a', pr.STEPS[0])})) * cos(2 * pi() * {_turned_sql('b', pr.STEPS[1])}) * (sigma_estimado * noise), 0.000001) as raw from y),
  v as (select cenario, cargo, turno, entidade, r, raw / sum(raw) over (partition by cenario, {UNIT}, r) * coalesce(eleitorado, 0) * turnout as v from z),
  t as (select cenario, cargo, turno, entidade, r, sum(v) as v from v group by all),
  h as (select *, v / sum(v) over (partition by cenario, cargo, turno, r) as share from t)
  select cenario, cargo, turno, entidade, count(*) as n_simulacoes, {r6('avg(share)')} as share_medio, {r6('quantile_cont(share, 0.05)')} as share_p05,
    {r6('quantile_cont(share, 0.5)')} as share_p50, {r6('quantile_cont(share, 0.95)')} as share_p95, {r6('stddev_pop(share)')} as share_desvio from h group by all""")
def m7_200(d):
    return pr.uncertainty_bands(prepared(d), n=200)


@query("M7_zero_noise_bands", f"""
  select cenario, cargo, turno, entidade, 8 as n_simulacoes, {', '.join(f'{r6("s")} as share_{x}' for x in ('medio', 'p05', 'p50', 'p95'))}, cast(0 as double) as share_desvio
  from (select *, v / sum(v) over (partition by cenario, cargo, turno) as s from (select cenario, cargo, turno, entidade, sum(votos_pred) as v from scen group by all))""")
def m7zero(d):
    return pr.uncertainty_bands(prepared(d).withColumn("sigma_estimado", F.lit(0.0)), n=8)


_HIST = " union all ".join(
    f"select {place(lv)[0].replace('ano,', 'ano_num,', 1)}, cargo, turno, entidade as partido, sum(votos) as votos_historicos, sum(eleitorado) as eleitorado_historico from model where {ok('entidade')} group by {place(lv)[1].replace('ano', 'ano_num', 1)}, cargo, turno, entidade"
    for lv in LEVELS
)
cte("history", f"select *, votos_historicos / nullif(sum(votos_historicos) over (partition by nivel, ano_num, uf, cd_municipio, cargo, turno), 0) as sh from ({_HIST})")


@query("M8_party_history", f"select * exclude (sh), {r6('sh')} as share_historico from history")
def m8(d):
    return pr.party_history(model(d))


def reference_sql(level):
    keys = {"brasil": "partido", "estado": "uf, partido", "municipio": "uf, cd_municipio, nm_municipio, partido"}[level]
    loc = {"brasil": "'' as uf, '' as cd_municipio, '' as nm_municipio", "estado": "uf, '' as cd_municipio, '' as nm_municipio", "municipio": "uf, cd_municipio, nm_municipio"}[level]
    joins = " ".join(f"left join {p} using ({keys})" for p in dominant_sql(keys, "weighted", "w", blank=None, cond="true"))
    cols = ", ".join(f"{x}_v as {x}_associado, {r6(f'{x}_s')} as {x}_share_associado" for x in DIMS)
    return f"""select '{level}' as nivel, {loc}, partido, votos_historicos_perfil, eleitorado_historico_perfil, {cols}
      from (select {keys}, sum(votos) as votos_historicos_perfil, sum(eleitorado) as eleitorado_historico_perfil from base where {ok('partido')} group by {keys}) {joins}"""


cte("weighted", f"""select uf, cd_municipio, nm_municipio, partido, {', '.join(f"case when lower(trim(coalesce({x}, ''))) in ('', 'sem valor', '#nulo#') then '' else {x} end as {x}" for x in DIMS)},
  case when votos > 0 then votos else coalesce(eleitorado, 0) end as w from base""")

for _level in LEVELS:

    def _register_reference(level=_level):
        @query(f"M9_party_profile_reference_{level}", reference_sql(level), drop=("perfil_eleitor_2026",))
        def run(d):
            return pr.party_profile_reference(d.base, level)

    _register_reference()

_HK = "nivel, uf, cd_municipio, nm_municipio, cargo, turno, partido"
cte("trends", f"""
  select *, last - first as delta, case when y1 > y0 then (last - first) / (y1 - y0) end as yearly from (
    select {_HK}, max(ano_num) as y1, max_by(sh, ano_num) as last, max_by(votos_historicos, ano_num) as votos_historicos_recentes, min(ano_num) as y0, min_by(sh, ano_num) as first,
      count(distinct ano_num) as qtd_anos_historicos, string_agg(cast(ano_num as varchar), ', ' order by ano_num) as anos_historicos from history group by {_HK})""")
_TRENDS = f"""{_HK}, y1 as ano_base_historico, {r6('last')} as share_historico_recente, votos_historicos_recentes, y0 as ano_inicial_historico, {r6('first')} as share_historico_inicial,
  qtd_anos_historicos, anos_historicos, {r6('delta')} as delta_share_historico, {r6('yearly')} as tendencia_anual_share,
  case when delta > 0.02 then 'crescimento' when delta < -0.02 then 'queda' else 'estavel/sem historico' end as tendencia_partido"""


@query("M10_party_trends", f"select {_TRENDS} from trends")
def m10(d):
    return pr.party_trends(pr.party_history(model(d)))


_SC = "nivel, uf, cd_municipio, nm_municipio, cargo, turno"
cte("party_corr", f"""
  with y as (select distinct {_SC}, ano_num from history), f as (select *, lead(ano_num) over (partition by {_SC} order by ano_num) as p2 from y),
  pr as (select {_SC}, f.ano_num as p1, f.p2, a.sh as v1, b.sh as v2 from f join history a using ({_SC}, ano_num) join history b using ({_SC}, partido) where b.ano_num = f.p2),
  rk as (select *, rank() over (partition by {_SC}, p1 order by v1) + (count(*) over (partition by {_SC}, p1, v1) - 1) / 2.0 as r1,
    rank() over (partition by {_SC}, p1 order by v2) + (count(*) over (partition by {_SC}, p1, v2) - 1) / 2.0 as r2 from pr),
  e as (select {_SC}, p1, p2, count(*) as n, case when min(r1) < max(r1) and min(r2) < max(r2) then corr(r1, r2) end as rho from rk group by {_SC}, p1, p2)
  select * from (select {_SC}, count(*) as qtd_anos_historicos_recorte, string_agg(cast(ano_num as varchar), ', ' order by ano_num) as anos_historicos_recorte from y group by {_SC})
  left join (select {_SC}, avg(rho) as m, string_agg(p1 || '-' || p2, ', ' order by p1) as pares from e where n >= 2 and rho is not null group by {_SC}) using ({_SC})""")
_CORR = f"""{r6('m')} as correlacao_historica_share_partidos, coalesce(pares, '') as pares_anos_correlacionados, qtd_anos_historicos_recorte, anos_historicos_recorte,
  case when abs(m) >= 0.75 then 'forte' when abs(m) >= 0.45 then 'moderada' when abs(m) >= 0.20 then 'fraca' else 'baixa/instavel' end as forca_correlacao_historica"""


@query("M11_party_historical_correlation", f"select {_SC}, {_CORR} from party_corr")
def m11(d):
    return pr.party_historical_correlation(pr.party_history(model(d)))


def party_tables(d: Data, level: str):
    m = materialize(model(d), "model")
    history = pr.party_history(m)
    return pr.party_projection(
        pr.scenario_projection(pr.projection_base(m)), level, pr.party_profile_reference(d.base, level),
        pr.party_trends(history), pr.party_historical_correlation(history),
    )


def party_projection_sql(level):
    keys = {"brasil": "", "estado": "uf, ", "municipio": "uf, cd_municipio, nm_municipio, "}[level]
    loc = {"brasil": "'' as uf, '' as cd_municipio, '' as nm_municipio", "estado": "uf, '' as cd_municipio, '' as nm_municipio", "municipio": "uf, cd_municipio, nm_municipio"}[level]
    scope = f"cenario, {keys}cargo, turno"
    return f"""
  with a as (select {scope}, entidade as partido, sum(votos_pred) as v from scen group by {scope}, entidade),
  b as (select *, sum(v) over (partition by {scope}) as tot from a),
  h as (select {scope}, sum(e) as eleitorado_total_modelado from (select cenario, {UNIT}, max(eleitorado) as e from scen group by cenario, {UNIT}) group by {scope}),
  j as (select '{level}' as nivel, cenario, {loc}, cargo, turno, partido, v, tot, eleitorado_total_modelado from b left join h using ({scope}))
  select j.* exclude (v, tot), {r6('v')} as votos_pred_2026, {r6('tot')} as votos_validos_total_modelado, {r6('v / tot')} as share_pred_2026, {r6('v / tot')} as pct_votos_partido_2026, 2026 as ano_simulado,
    p.* exclude (nivel, uf, cd_municipio, nm_municipio, partido), t.* exclude ({_HK}), c.* exclude ({_SC})
  from j left join ({reference_sql(level)}) p using (nivel, uf, cd_municipio, nm_municipio, partido) left join (select {_TRENDS} from trends) t using ({_HK})
  left join (select {_SC}, {_CORR} from party_corr) c using ({_SC})"""


for _level in LEVELS:

    def _register_party(level=_level):
        @query(f"M12_party_projection_{level}", party_projection_sql(level), drop=("perfil_eleitor_2026",))
        def run(d):
            return party_tables(d, level)

    _register_party()


@query("M13_decisive_places", f"""
  with k as (select *, row_number() over (partition by cenario, {UNIT} order by round(share_pred, 9) desc, entidade) as rk from scen),
  g as (select cenario, {UNIT}, {', '.join(f"max(case when rk = {i} then {c} end) as {c}_{n}" for i, n in ((1, 'lider'), (2, 'segundo')) for c in ('entidade', 'share_pred', 'votos_pred'))} from k group by cenario, {UNIT})
  select cenario, {UNIT}, entidade_lider as lider_pred, entidade_segundo as segundo_pred, {r6('share_pred_lider')} as share_lider_pred, {r6('votos_pred_lider')} as votos_lider_pred,
    {r6('share_pred_segundo')} as share_segundo_pred, {r6('votos_pred_segundo')} as votos_segundo_pred, {r6('share_pred_lider - coalesce(share_pred_segundo, 0)')} as margem_pred,
    {r6('(1 - least(greatest(share_pred_lider - coalesce(share_pred_segundo, 0), 0), 1)) * ln(1 + votos_pred_lider + coalesce(votos_pred_segundo, 0))')} as indice_decisivo from g""")
def m13(d):
    return pr.decisive_places(projected(d))


@query("M14_entity_contribution", f"""
  select cargo, turno, entidade, votos_base, {r6('sb')} as share_medio_base, eleitorado_base, ano_base, {r6('v')} as votos_pred_2026, {r6('sp')} as share_pred_2026,
    {r6('sw')} as swing_anual_estimado, {r6('sg')} as sigma_estimado, {r6('sp - sb')} as delta_share_medio
  from (select cargo, turno, entidade, sum(votos) as votos_base, avg(coalesce(share, 0)) as sb, sum(eleitorado) as eleitorado_base, max(ano_num) as ano_base from model where ano_num = (select max(ano_num) from model) group by all)
  full join (select cargo, turno, entidade, sum(votos_pred) as v, avg(share_pred) as sp, avg(swing_anual_estimado) as sw, avg(sigma_estimado) as sg from scen where cenario = 'base' group by all) using (cargo, turno, entidade)""")
def m14(d):
    m = materialize(model(d), "model")
    return pr.entity_contribution(m, pr.scenario_projection(pr.projection_base(m)))


@query("M15_scenario_justification", f"""
  select cenario, {r6('avg(swing_anual_estimado)')} as swing_medio, {r6('avg(sigma_estimado)')} as sigma_medio, {r6('sum(votos_pred)')} as votos_preditos from scen group by cenario""", drop=("premissa",))
def m15(d):
    return pr.scenario_justification(projected(d))

"""S and F: column functions applied to whole tables, results counted per output value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands, labels, numbers, text
from ..functions.words import REGION_STATES
from ..model import ELECTORAL
from ..operators import order_statistics as os_
from ..operators import sections
from ..sources import files
from .base import ANY_DIM, COMBO, DIMS, Data, cte, ok, query
from .level_queries import results_sql, results_table


def counted(df: DataFrame, **columns) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in columns.items()]).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def lines(d: Data) -> DataFrame:
    q = F.col("l_quantity").cast("long").cast("string")
    k = F.col("l_orderkey") % 5
    t = F.when(k == 0, F.concat(q, F.lit(".234,56"))).when(k == 1, F.concat(q, F.lit(",5"))).when(k == 2, F.concat(q, F.lit(".234"))).when(k == 3, q).otherwise("abc")
    return d.table("lineitem").select(k.alias("k"), t.alias("t"))


_Q = "cast(l_quantity as bigint)"


def _numbers_sql(cases):
    return f"select k, count(v) as lidos, cast(sum(round(v * 1000)) as bigint) as milesimos from (select l_orderkey % 5 as k, case l_orderkey % 5 {' '.join(f'when {i} then {c}' for i, c in enumerate(cases))} end as v from lineitem) group by k"


def _number_totals(d, reader):
    return lines(d).select("k", reader("t").alias("v")).groupBy("k").agg(F.count("v").alias("lidos"), F.sum(F.round(F.col("v") * 1000).cast("long")).alias("milesimos"))


@query("S1_metric", _numbers_sql(["0.0", f"{_Q} + 0.5", f"{_Q} + 0.234", _Q, "0.0"]))
def s1(d):
    return _number_totals(d, numbers.metric)


@query("S2_parse_number", _numbers_sql([f"{_Q} * 1000 + 234.56", f"{_Q} + 0.5", f"{_Q} * 1000 + 234", _Q, "null"]))
def s2(d):
    return _number_totals(d, numbers.parse_number)


@query("S3_parse_number_lenient", _numbers_sql([f"{_Q} * 1000 + 234.56", f"{_Q} + 0.5", f"{_Q} + 0.234", _Q, "null"]))
def s3(d):
    return _number_totals(d, numbers.parse_number_lenient)


_DIRTY = "case o_orderkey % 8 when 0 then '  ' when 1 then 'NaN' when 2 then '#NULO#' when 3 then 'perfil Sem Valor' when 4 then 'Codigo 12' when 5 then 'GERAL' when 6 then ' ' || o_orderpriority || ' ' else o_orderstatus end"


def dirty(d: Data) -> DataFrame:
    return d.table("orders").select(F.expr(_DIRTY).alias("t"), "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey", "o_orderdate")


@query("S4_clean_text", f"""select case when k in (0, 1) then '' else trim(t) end as safe, case when k in (0, 1, 2, 3, 5) then '' else trim(t) end as clean, case when k in (0, 1, 2, 3, 4, 5) then '' else trim(t) end as profile,
  case when k in (0, 1, 2, 3, 4, 5) then '' else trim(t) end as meaningful, count(*) as n from (select o_orderkey % 8 as k, {_DIRTY} as t from orders) group by all""")
def s4(d):
    return counted(dirty(d), safe=text.safe_text("t"), clean=text.clean_value("t"), profile=text.profile_value("t"), meaningful=text.meaningful("t"))


@query("S5_compact_code", "select cast(o_custkey as varchar) as code, count(*) as n from orders group by 1")
def s5(d):
    return counted(d.table("orders"), code=text.compact_code(F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).otherwise(F.col("o_custkey").cast("string"))))


@query("S6_discrete_value", f"select case when trim(t) = '' then 'SEM_VALOR' else trim(t) end as v, count(*) as n from (select {_DIRTY} as t from orders) group by 1")
def s6(d):
    return counted(dirty(d), v=text.discrete("t"))


@query("S7_clean_uf", "select case o_orderkey % 4 when 0 then 'SP' when 1 then 'SEM_UF' when 2 then 'RJ' else 'SEM_UF' end as uf, count(*) as n from orders group by 1")
def s7(d):
    raw = F.expr("case o_orderkey % 4 when 0 then 'sp ' when 1 then 'S1' when 2 then 'RJ' else o_orderpriority end")
    return counted(d.table("orders"), uf=text.clean_state(raw))


@query("S8_label_category", """select case o_orderkey % 6 when 0 then 'Medio completo' when 1 then 'Sem valor' when 2 then 'Codigo 77' when 3 then 'Ensino medio' when 4 then 'Superior completo' else 'Nao informado' end as grau,
  case when o_orderkey % 2 = 0 then 'Ano 1998' else 'Ano 2000' end as ano, count(*) as n from orders group by all""")
def s8(d):
    grade = F.expr("case o_orderkey % 6 when 0 then '6' when 1 then 'nan' when 2 then '77.0' when 3 then 'ENSINO_MEDIO' when 4 then '8.0' else '-1' end")
    year = F.expr("if(o_orderkey % 2 = 0, '1998', '2000.0')")
    named = labels.label_category(grade, "perfil_instrucao")
    return counted(d.table("orders"), grau=F.when(named == "Ensino Medio", "Ensino medio").otherwise(named), ano=labels.label_category(year, "ano"))


@query("S9_age_band", """select case when a < 16 then 'Codigo ' || a when a < 18 then '16 a 17 anos' when a < 21 then '18 a 20 anos' when a < 25 then '21 a 24 anos' when a >= 80 then '80 anos ou mais'
  else (a // 5 * 5) || ' a ' || (a // 5 * 5 + 4) || ' anos' end as faixa, count(*) as n from (select 10 + o_custkey % 90 as a from orders) group by 1""")
def s9(d):
    return counted(d.table("orders"), faixa=labels.age_band((10 + F.col("o_custkey") % 90).cast("string")))


@query("S10_coalesce_profile_aliases", "select case o_orderkey % 3 when 0 then 'Medio completo' when 1 then 'Superior completo' else '' end as v, count(*) as n from orders group by 1")
def s10(d):
    raw = d.table("orders").select(
        F.expr("if(o_orderkey % 3 = 0, '6', '#NULO#')").alias("DS_GRAU_INSTRUCAO"), F.expr("if(o_orderkey % 3 = 1, '8', 'nan')").alias("cd_escolaridade"))
    return counted(raw, v=labels.coalesce_profile_aliases(raw.columns, "perfil_instrucao"))


@query("S11_profile_combo", f"select {COMBO} as combo, count(*) as n from electorate group by 1")
def s11(d):
    return counted(d.electorate, combo=text.profile_combo())


@query("S12_profile_combo_extract", f"select perfil_genero as genero, case when {ok('perfil_raca_cor')} then perfil_raca_cor end as raca, count(*) as n from electorate group by all")
def s12(d):
    rows = d.electorate.select(text.profile_combo().alias("c"))
    return counted(rows, genero=text.combo_part("c", "sexo_genero"), raca=text.combo_part("c", "raca_cor"))


@query("S13_section_codes", "select cd_municipio as municipio, cd_municipio || '|' || zona as zona_, cd_municipio || '|' || zona || '|' || secao as setor, ano || '|' || cd_municipio || '|' || zona || '|' || secao as setor_ano, count(*) as n from electorate group by all")
def s13(d):
    codes = text.section_codes(year="ano")
    names = dict(zip(codes, ["municipio", "zona_", "setor", "setor_ano"]))
    return counted(d.electorate, **{names[k]: c for k, c in codes.items()})


@query("S14_choose_correlation_year", "select case o_orderkey % 3 when 0 then cast(year(o_orderdate) as varchar) when 1 then '1999' else 'ano_desconhecido' end as ano, count(*) as n from orders group by 1")
def s14(d):
    content = F.expr("if(o_orderkey % 3 = 0, concat('eleicao ', year(o_orderdate)), '')")
    name = F.expr("if(o_orderkey % 3 = 1, 'votacao_1999_sp', 'votacao')")
    return counted(d.table("orders"), ano=text.correlation_year(content, name))


_UF27 = sorted(u for s in REGION_STATES.values() for u in s)
_REGION = {u: r for r, s in REGION_STATES.items() for u in s}


@query("S16_region_of_uf", "select case o_orderkey % 28 " + " ".join(f"when {i} then '{_REGION[u]}'" for i, u in enumerate(_UF27)) + " else 'Sem regiao' end as regiao, count(*) as n from orders group by 1")
def s16(d):
    state = F.element_at(F.array(*[F.lit(u) for u in [*_UF27, "XX"]]), (F.col("o_orderkey") % 28 + 1).cast("int"))
    return counted(d.table("orders"), regiao=labels.region_of_state(state))


@query("S17_rate_band", "select case when v is null then 'x_sem_valor' when v < 0.12 then 'x_baixo' when v <= 0.25 then 'x_medio' else 'x_alto' end as faixa, count(*) as n from (select case when l_orderkey % 10 <> 0 then l_discount * 4 end as v from lineitem) group by 1")
def s17(d):
    return counted(d.table("lineitem"), faixa=bands.rate_band(F.expr("case when l_orderkey % 10 <> 0 then l_discount * 4 end"), "x", 0.12, 0.25))


@query("S18_quantile_band_3", "select case when l_extendedprice <= lo then 'p_baixo' when l_extendedprice <= hi then 'p_medio' else 'p_alto' end as faixa, count(*) as n from lineitem, (select quantile_cont(l_extendedprice, 0.33) as lo, quantile_cont(l_extendedprice, 0.66) as hi from lineitem) group by 1")
def s18(d):
    return counted(os_.quantile_band_3(d.table("lineitem").select("l_extendedprice"), "l_extendedprice", "p", "faixa"), faixa=F.col("faixa"))


cte("quarters", """select *, greatest(1, ceil((rn - 1) * 4.0 / (n - 1))) as q from (select o_orderkey, o_totalprice, row_number() over (order by v, md5(cast(o_orderkey as varchar))) as rn, count(*) over () as n
  from (select *, floor(o_totalprice / 50000) as v from orders))""")


@query("S19_quantile_band_4", "select o_orderkey, case q when 1 then 'v_baixo' when 2 then 'v_medio_baixo' when 3 then 'v_medio_alto' else 'v_alto' end as faixa from quarters")
def s19(d):
    rows = d.table("orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 50000).cast("double").alias("v"))
    return os_.quantile_band_4(rows, "v", F.col("o_orderkey"), "v", "faixa").select("o_orderkey", "faixa")


@query("S20_rank_share_bands", f"""select case when rank_entidade = 1 then 'rank_1_lider' when rank_entidade <= 5 then 'rank_2_a_5' when rank_entidade <= 10 then 'rank_6_a_10' else 'rank_11_a_50' end as posto,
  case when share_votos >= 0.5 then '50% ou mais' when share_votos >= 0.3 then '30% a 49,9%' when share_votos >= 0.1 then '10% a 29,9%' when share_votos > 0 then 'menos de 10%' else '' end as faixa, count(*) as n
  from ({results_sql('municipio')}) group by all""")
def s20(d):
    return counted(results_table(d, "municipio"), posto=bands.rank_band("rank_entidade"), faixa=bands.share_band("share_votos"))


@query("S21_labels", """select case when a = 0 and b > 0 then 'crescimento' when a = 0 then 'estável' when (b - a) / a > 0.03 then 'crescimento' when (b - a) / a < -0.03 then 'queda' else 'estável' end as tendencia,
  case when b - a > 0.02 then 'crescimento' when b - a < -0.02 then 'queda' else 'estavel/sem historico' end as delta, case when b >= 0.75 then 'forte' when b >= 0.45 then 'moderada' when b >= 0.2 then 'fraca' else 'baixa/instavel' end as forca,
  case when b >= 0.65 then 'alto' when b >= 0.4 then 'médio' else 'baixo' end as nivel, count(*) as n from (select l_discount as a, l_tax * 12 as b from lineitem) group by all""")
def s21(d):
    rows = d.table("lineitem").select(F.col("l_discount").alias("a"), (F.col("l_tax") * 12).alias("b"))
    return counted(rows, tendencia=bands.trend_label("a", "b"), delta=bands.delta_label(F.col("b") - F.col("a")), forca=bands.correlation_strength("b"), nivel=bands.crystallisation_level("b"))


@query("S25_entity_label", "select case when k = 0 then candidato || ' | ' || partido when k = 1 then candidato when k = 2 then partido else 'GERAL' end as entidade, count(*) as n from (select candidato, partido, votos % 4 as k from results) group by 1")
def s25(d):
    rows = d.results.selectExpr("if(votos % 4 in (0, 1), candidato, 'nan') as candidato", "if(votos % 4 in (0, 2), partido, '') as partido")
    return counted(rows, entidade=text.entity_label())


@query("S26_choose_entity", "select partido as entidade, count(*) as n from results group by 1")
def s26(d):
    rows = d.results.withColumn("candidato", F.lit("#NULO#"))
    return counted(rows, entidade=sections.choose_entity(rows))


@query("S27_result_text", f"select nivel, ano, cargo, turno, entidade, case when rank_entidade = 1 then 'Ganhou' else 'Perdeu' end as inicio from ({results_sql('brasil')})")
def s27(d):
    out = results_table(d, "brasil")
    return out.select("nivel", "ano", "cargo", "turno", "entidade", F.split("interpretacao_resultado", " ")[0].alias("inicio"))


@query("S28_elected_status", "select case when l_linenumber % 4 = 0 then 'eleito' when l_linenumber % 4 = 3 then 'outro' else 'nao_eleito' end as situacao, count(*) as n from lineitem group by 1")
def s28(d):
    raw = F.expr("case l_linenumber % 4 when 0 then 'ELEITO POR QP' when 1 then 'Não eleito' when 2 then 'SUPLENTE' else '2o turno' end")
    return counted(d.table("lineitem"), situacao=bands.elected_status(raw))


@query("S29_flatten_record", """select event_type as "a.b.tipo", '{"fundo":{"k":"' || json_extract_string(props, '$.k') || '"}}' as "a.b.c", count(*) as n from events group by all""")
def s29(d):
    deep = F.struct(F.struct(F.get_json_object("props", "$.k").alias("k")).alias("fundo")).alias("c")
    nested = d.table("events").select(F.struct(F.struct(F.col("event_type").alias("tipo"), deep).alias("b")).alias("a"))
    flat = files.flatten_record(nested, depth=2)
    return flat.groupBy(*[F.col(f"`{c}`") for c in flat.columns]).agg(F.count(F.lit(1)).alias("n"))


@query("F1_filter_positive", "select count(*) as n, cast(sum(votos) as bigint) as votos from results where votos > 25")
def f1(d):
    return d.results.filter(text.positive(F.col("votos") - 25)).agg(F.count(F.lit(1)).alias("n"), F.sum("votos").alias("votos"))


@query("F2_valid", f"select {ok('t')} as valido, count(*) as n from (select {_DIRTY} as t from orders) group by 1")
def f2(d):
    return counted(dirty(d), valido=text.valid("t"))


@query("F3_any_profile_valid", f"select {ANY_DIM} as valido, count(*) as n from (select {', '.join(f'case when eleitorado % 3 = 0 then {chr(39)}#NULO#{chr(39)} else {x} end as {x}' for x in DIMS)} from electorate) group by 1")
def f3(d):
    rows = d.electorate.withColumns({x: F.when(F.col("eleitorado") % 3 == 0, "#NULO#").otherwise(F.col(x)) for x in ELECTORAL.dims})
    return counted(rows, valido=text.any_profile_valid())

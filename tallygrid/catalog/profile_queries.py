"""P and H9-H12: column profiles, statistics, similarity, distributions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..operators import profiling as po
from ..operators import similarity as si
from ..operators import statistics as st
from ..session import materialize
from .base import Data, cte, query, r6
from .correlated_queries import corr_sql, gold

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
WORDS = ["l_returnflag", "l_linestatus"]
PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query("P1_column_profile_counts", " union all ".join(
    f"select '{c}' as coluna, count(*) as linhas_amostra, count({c}) as nao_nulos, count(*) - count({c}) as nulos, count(distinct {c}) as unicos, "
    f"cast({1 if c.endswith('key') else 0} as double) as numeric_ratio from orders" for c in PROFILED))
def p1(d):
    return po.column_profile(d.table("orders"), PROFILED).select("coluna", "linhas_amostra", "nao_nulos", "nulos", "unicos", "numeric_ratio")


@query("P1_column_profile")
def p1full(d):
    return po.column_profile(d.table("events"))


@query("P2_semantic_profile")
def p2(d):
    return po.semantic_profile(d.table("lineitem"))


@query("P2_semantic_profile_counts", " union all ".join(
    f"select '{c}' as coluna, count(*) as linhas, count({c}) as qtd_nao_nulos, count(distinct {c}) as qtd_unicos, count({c}) as qtd_numericos, "
    f"case when count(distinct {c}) <= 50 or count(distinct {c}) <= 0.05 * count({c}) then 'codigo_provavel_numerico' else 'numerico_analitico' end as tipo_inferido from lineitem" for c in NUMBERS))
def p2c(d):
    out = po.semantic_profile(d.table("lineitem"), NUMBERS)
    return out.select("coluna", "linhas", "qtd_nao_nulos", "qtd_unicos", "qtd_numericos", "tipo_inferido")


_DISCRETE = {"o_orderstatus": "orders", "o_orderpriority": "orders", "o_custkey": "orders"}


@query("P3_useful_discrete", " union all ".join(
    f"select '{c}' as coluna, count(distinct {c}) as qtd_categorias, {'true' if c != 'o_custkey' else 'false'} as discreto_util from {t}" for c, t in _DISCRETE.items()))
def p3(d):
    counts = po.value_counts(d.table("orders"), list(_DISCRETE))
    return po.useful_discrete(counts, list(_DISCRETE)).select("coluna", "qtd_categorias", "discreto_util")


_SHOUT = "case when v = upper(v) and v <> lower(v) and length(v) > 3 then upper(v[1]) || lower(v[2:]) else v end"


@query("P4_discrete_summary", f"""
  select campo, valor, qtd, {r6('qtd / t')} as share, rk as rank_valor, k as qtd_categorias from (
    select *, row_number() over (partition by campo order by qtd desc, valor) as rk, count(*) over (partition by campo) as k, sum(qtd) over (partition by campo) as t from (
      select campo, {_SHOUT} as valor, count(*) as qtd from (select 'p_type' as campo, p_type as v from part union all select 'p_brand', p_brand from part) group by all)) where rk <= 20""", drop=("campo_legivel",))
def p4(d):
    return po.discrete_summary(d.table("part"), columns=["p_type", "p_brand"])


_Q = {"p01": .01, "p05": .05, "p25": .25, "mediana": .5, "p75": .75, "p95": .95, "p99": .99}


@query("P5_numeric_stats", " union all ".join(
    f"select '{c}' as coluna, count({c}) as n, {r6(f'avg({c})')} as media, {r6(f'stddev_samp({c})')} as desvio, {r6(f'min({c})')} as min, {r6(f'max({c})')} as max, {r6(f'sum({c})')} as soma, "
    + ", ".join(f"{r6(f'quantile_cont({c}, {p})')} as {n}" for n, p in _Q.items()) + " from lineitem" for c in ("l_quantity", "l_discount")))
def p5(d):
    return st.numeric_stats(d.table("lineitem"), ["l_quantity", "l_discount"])


@query("P5_numeric_stats_prices", " union all ".join(
    f"select '{c}' as coluna, count({c}) as n, {r6(f'avg({c})')} as media, {r6(f'stddev_samp({c})')} as desvio, {r6(f'min({c})')} as min, {r6(f'max({c})')} as max, {r6(f'sum({c})')} as soma, "
    + ", ".join(f"{r6(f'quantile_cont({c}, {p})')} as {n}" for n, p in _Q.items()) + " from lineitem" for c in NUMBERS))
def p5b(d):
    return st.numeric_stats(d.table("lineitem"), NUMBERS)


@query("P6_pearson_pairs", " union all ".join(
    f"select '{a}' as coluna_1, '{b}' as coluna_2, {r6(f'corr({a}, {b})')} as pearson, {r6(f'abs(corr({a}, {b}))')} as abs_pearson from lineitem" for a, b in combinations(NUMBERS, 2)))
def p6(d):
    return st.pearson_pairs(d.table("lineitem"), NUMBERS)


_SP = ["l_quantity", "l_extendedprice", "l_tax"]


@query("P7_spearman_pairs", "select coluna_1, coluna_2, n, " + r6("spearman") + " as spearman, " + r6("abs(spearman)") + " as abs_spearman from (" + corr_sql(
    " union all ".join(f"select '{a}' as coluna_1, '{b}' as coluna_2, {a} as v1, {b} as v2 from lineitem" for a, b in combinations(_SP, 2)),
    "coluna_1, coluna_2", {"coluna_1": "coluna_1", "coluna_2": "coluna_2", "n": "n", "spearman": "spearman"}, 3) + ")")
def p7(d):
    return st.spearman_pairs(d.table("lineitem"), _SP)


# One column has few values: for each of them, a running count in the order of the other says how many rows lie below.
@query("P8_kendall_pairs", f"""
  with k as (select l_quantity as x, l_extendedprice as y, count(*) as n from lineitem group by all),
  v as (select q, k.x, k.n, sum(case when k.x < q then k.n else 0 end) over (partition by q order by k.y groups between unbounded preceding and 1 preceding) as below from k, (select distinct x as q from k)),
  c as (select sum(n * coalesce(below, 0)) as c from v where x = q), t as (select sum(n) as n, sum(n * (n - 1) / 2) as t from k),
  tx as (select sum(n * (n - 1) / 2) as t from (select sum(n) as n from k group by x)), ty as (select sum(n * (n - 1) / 2) as t from (select sum(n) as n from k group by y)),
  z as (select t.n as n, cast(c.c as double) as c, cast(t.n as double) * (t.n - 1) / 2 as p, tx.t as tx, ty.t as ty, t.t as txy from c, t, tx, ty)
  select 'l_quantity' as coluna_1, 'l_extendedprice' as coluna_2, cast(n as bigint) as n, c as concordantes, cast(p - tx - ty + txy - c as double) as discordantes,
    {r6('(c - (p - tx - ty + txy - c)) / sqrt((p - tx) * (p - ty))')} as kendall from z""")
def p8(d):
    return st.kendall_pairs(d.table("lineitem"), ["l_quantity", "l_extendedprice"])


# Small contingency tables make Kendall expressible: pairs of cells instead of pairs of rows.
cte("kendall_cells", "select l_discount as x, l_quantity as y, count(*) as n from lineitem group by all")


@query("P8_kendall_discrete_pair", f"""
  with cd as (select sum(case when b.y > a.y then a.n * b.n else 0 end) as c, sum(case when b.y < a.y then a.n * b.n else 0 end) as d from kendall_cells a join kendall_cells b on a.x < b.x),
  t as (select sum(n) as n from kendall_cells), tx as (select sum(n * (n - 1) / 2) as t from (select sum(n) as n from kendall_cells group by x)), ty as (select sum(n * (n - 1) / 2) as t from (select sum(n) as n from kendall_cells group by y))
  select 'l_discount' as coluna_1, 'l_quantity' as coluna_2, cast(t.n as bigint) as n, cast(c as double) as concordantes, cast(d as double) as discordantes,
    {r6('(c - d) / sqrt((cast(t.n as double) * (t.n - 1) / 2 - tx.t) * (cast(t.n as double) * (t.n - 1) / 2 - ty.t))')} as kendall from cd, t, tx, ty""")
def p8d(d):
    return st.kendall_pairs(d.table("lineitem"), ["l_discount", "l_quantity"], rows_per_range=500)


def cramer_sql(a, b, source):
    return f"""
  select '{a}' as coluna_1, '{b}' as coluna_2, {r6('sqrt(greatest(case when r = 2 and k = 2 then c2 else c1 end, 0) / n / greatest(least(r, k) - 1, 1))')} as cramers_v, n from (
    select sum((coalesce(o, 0) - ra * cb / n) ** 2 / (ra * cb / n)) as c1, sum((abs(coalesce(o, 0) - ra * cb / n) - least(0.5, abs(coalesce(o, 0) - ra * cb / n))) ** 2 / (ra * cb / n)) as c2,
      max(n) as n, count(distinct x) as r, count(distinct y) as k from (select {a} as x, cast(count(*) as double) as ra from {source} group by 1) cross join (select {b} as y, cast(count(*) as double) as cb from {source} group by 1)
      cross join (select count(*) as n from {source}) left join (select {a} as x, {b} as y, cast(count(*) as double) as o from {source} group by all) using (x, y))"""


cte("labelled", "select lang, source, n_chars, quality, toxic from documents join labels using (doc_id)")


def labelled(d: Data):
    return d.table("documents").join(d.table("labels"), "doc_id")


@query("P9_cramers_v", " union all ".join(cramer_sql(a, b, "labelled") for a, b in combinations(["lang", "source", "quality", "toxic"], 2)))
def p9(d):
    return st.cramers_v(labelled(d), ["lang", "source", "quality", "toxic"])


@query("P10_eta_squared", " union all ".join(
    f"""select '{c}' as coluna_categorica, 'n_chars' as coluna_numerica, {r6('sum(k * (m - g) ** 2) / max(t)')} as eta_squared, cast(sum(k) as bigint) as n, count(*) as qtd_categorias from (
      select {c}, count(*) as k, avg(n_chars) as m from documents group by 1) cross join (select avg(n_chars) as g, sum((n_chars - m0) ** 2) as t from documents cross join (select avg(n_chars) as m0 from documents))""" for c in ("lang", "source")))
def p10(d):
    return st.eta_squared(d.table("documents"), ["lang", "source"], ["n_chars"])


def catalogue(d: Data):
    """Profiles of tables whose names follow the electoral conventions, derived from the data."""
    votes = d.results.selectExpr(
        "ano as ANO_ELEICAO", "uf as SG_UF", "cd_municipio as CD_MUNICIPIO", "nm_municipio as NM_MUNICIPIO", "zona as NR_ZONA", "secao as NR_SECAO",
        "cargo as DS_CARGO", "partido as SG_PARTIDO", "candidato as NM_VOTAVEL", "votos as QT_VOTOS")
    people = d.electorate.selectExpr(
        "ano as ANO_ELEICAO", "uf as SG_UF", "cd_municipio as CD_MUNICIPIO", "nm_municipio as NM_MUNICIPIO", "zona as NR_ZONA", "secao as NR_SECAO",
        "perfil_genero as DS_GENERO", "eleitorado as QT_ELEITORES", "comparecimento_estimado as QT_COMPARECIMENTO")
    names = d.candidates.selectExpr("ano as ANO_ELEICAO", "uf as SG_UF", "cargo as DS_CARGO", "partido as SG_PARTIDO", "candidato as NM_CANDIDATO", "nr_candidato as NR_CANDIDATO")
    # A few rows per table, read several times by the comparisons below.
    return materialize(po.field_catalogue({"votos": votes, "eleitores": people, "candidatos": names}), "fields")


@query("P11_table_similarity")
def p11(d):
    return si.table_similarity(catalogue(d))


@query("P12_field_similarity")
def p12(d):
    return si.field_similarity(catalogue(d))


@query("P13_canonical_field_map")
def p13(d):
    fields = catalogue(d)
    return si.canonical_field_map(fields, si.field_similarity(fields))


@query("H9_plot_summary", """
  select 'categoria' as tipo_resumo, campo, valor, 'linhas_origem' as metrica, linhas_origem as total, votos, eleitorado from (""" + " union all ".join(
    f"select '{c}' as campo, {c} as valor, sum(linhas_origem) as linhas_origem, sum(votos) as votos, sum(eleitorado) as eleitorado from gold where trim({c}) <> '' and lower(trim({c})) not in ('nan', 'none', 'null', '<na>') group by {c}" for c in st.PLOT_CATEGORIES) + ") union all " + " union all ".join(
    f"select '{kind}', '{k}', {k}, '{m}', sum({m}), null, null from gold group by {k}" for k, kind in (("ano", "metrica_por_ano"), ("uf", "metrica_por_uf")) for m in st.PLOT_METRICS))
def h9(d):
    return st.plot_summary(gold(d))


@query("H9_plot_metric", " union all ".join(
    f"select '{c}' as campo, case when sum(votos) > 0 then 'votos' when sum(eleitorado) > 0 then 'eleitorado' else 'total' end as metrica from gold where trim({c}) <> '' having count(*) > 0" for c in st.PLOT_CATEGORIES))
def h9m(d):
    return st.plot_metric(st.plot_summary(gold(d)))


def bin_sql(c, lo, hi, bins):
    return f"cast(case when {c} = {hi} then {bins - 1} else floor(({c} - {lo}) / ({hi} - {lo}) * {bins}) end as bigint)"


@query("H10_numeric_histogram", " union all ".join(
    f"""select '{c}' as coluna, bin, {r6('lo + (hi - lo) / 20 * bin')} as inicio, {r6('lo + (hi - lo) / 20 * (bin + 1)')} as fim, frequencia from (
      select {bin_sql(c, 'lo', 'hi', 20)} as bin, any_value(lo) as lo, any_value(hi) as hi, count(*) as frequencia from lineitem cross join (select min({c}) as lo, max({c}) as hi from lineitem) group by 1)""" for c in NUMBERS))
def h10(d):
    return st.numeric_histogram(d.table("lineitem"), NUMBERS, bins=20)


@query("H11_density_2d", f"""
  select 'l_quantity' as coluna_1, 'l_extendedprice' as coluna_2, {bin_sql('l_quantity', 'a', 'b', 20)} as bin_1, {bin_sql('l_extendedprice', 'c', 'd', 20)} as bin_2, count(*) as frequencia
  from lineitem cross join (select min(l_quantity) as a, max(l_quantity) as b, min(l_extendedprice) as c, max(l_extendedprice) as d from lineitem) group by 3, 4""")
def h11(d):
    return st.density_2d(d.table("lineitem"), [("l_quantity", "l_extendedprice")], bins=20)


_FREQ = " union all ".join(f"select '{c}' as coluna, coalesce(nullif(trim({c}), ''), '(nulo)') as valor, count(*) as frequencia from documents group by 2" for c in ("lang", "source"))


@query("H12_category_frequency", _FREQ)
def h12(d):
    return st.category_frequency(d.table("documents"), ["lang", "source"])


@query("H12_category_summary", f"""
  select coluna, count(*) as qtd_categorias, max(case when rk = 1 then valor end) as moda, max(case when rk = 1 then frequencia end) as freq_moda,
    {r6('max(case when rk = 1 then frequencia end) / sum(frequencia)')} as pct_moda from (select *, row_number() over (partition by coluna order by frequencia desc, valor) as rk from ({_FREQ})) group by coluna""")
def h12s(d):
    return st.category_summary(st.category_frequency(d.table("documents"), ["lang", "source"]))

"""Column statistics, associations and distributions over whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..functions.text import safe_text
from ..session import materialize
from .core import join_null_safe, safe_corr, sums, top1, with_totals
from .order_statistics import ROWS_PER_RANGE, average_rank_spread, before_ranges, exact_quantiles, in_ranges, value_positions

QUANTILES = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "mediana": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
NULL_LABEL = "(nulo)"


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return numbers.unpivot([], list(columns), "coluna", "v").filter("v is not null")


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, exact quantiles, extremes and sum of every column."""
    long = _long(df, columns)
    basic = long.groupBy("coluna").agg(
        F.count("v").alias("n"), F.avg("v").alias("media"), F.coalesce(F.stddev_samp("v"), F.lit(0.0)).alias("desvio"),
        F.min("v").alias("min"), F.max("v").alias("max"), F.sum("v").alias("soma"),
    )
    return basic.join(exact_quantiles(long, ["coluna"], "v", QUANTILES), "coluna")


def _pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per input row and column pair, complete pairs only."""
    pairs = [
        F.struct(F.lit(a).alias("coluna_1"), F.lit(b).alias("coluna_2"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
        for a, b in combinations(columns, 2)
    ]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").dropna()


def pearson_pairs(df: DataFrame, columns: Sequence[str], min_rows: int = 5) -> DataFrame:
    """Pairwise correlation; all pairs come out of a single aggregate."""
    measured = []
    for a, b in combinations(columns, 2):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
        varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y)) & (F.count(x) >= min_rows)
        r = F.when(varies, ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))
        measured.append(F.struct(F.lit(a).alias("coluna_1"), F.lit(b).alias("coluna_2"), r.alias("pearson")))
    row = df.agg(F.array(*measured).alias("r"))
    out = row.select(F.explode("r").alias("r")).select("r.*").filter("pearson is not null")
    return out.withColumn("abs_pearson", F.abs("pearson"))


def spearman_pairs(df: DataFrame, columns: Sequence[str], min_rows: int = 3) -> DataFrame:
    """Rank correlation over complete pairs, ranks by range so no task sorts a column."""
    scope = ["coluna_1", "coluna_2"]
    ranked = average_rank_spread(average_rank_spread(_pairs(df, columns), scope, "x", "rx"), scope, "y", "ry")
    out = ranked.groupBy(*scope).agg(F.count(F.lit(1)).alias("n"), safe_corr("rx", "ry").alias("spearman"))
    return out.filter(F.col("n") >= min_rows).filter("spearman is not null").withColumn("abs_spearman", F.abs("spearman"))


def _concordant(cells: DataFrame, level: int, rows_per_range: int) -> DataFrame:
    """One row: pairs in which the larger y goes with the larger digit of gx at this level, equal digits above.

    Rows of a node (equal digits above) are read in the order of gy with eight running sums, one
    for each digit: what lies below a row is the sums of the smaller digits.  Nodes of any size:
    sums run inside ranges of (node, gy) and start from the node's earlier ranges.
    """
    part = cells.select(F.shiftright("gx", 3 * (level + 1)).alias("node"), F.shiftright("gx", 3 * level).bitwiseAND(7).alias("digit"), "gy", "n")
    part = part.groupBy("node", "gy", "digit").agg(F.sum("n").alias("n"))
    placed = in_ranges(part, ["node", "gy"], "__b", rows_per_range)
    held = {j: F.when(F.col("digit") == j, F.col("n")).otherwise(0) for j in range(7)}
    offsets = before_ranges(placed, ["node"], "__b", "__rows", **{f"o{j}": h for j, h in held.items()})
    smaller = Window.partitionBy("node", "__b").orderBy("gy").rangeBetween(Window.unboundedPreceding, -1)
    run = placed.withColumns({f"c{j}": F.coalesce(F.sum(h).over(smaller), F.lit(0)) for j, h in held.items()})
    run = join_null_safe(run, offsets, ["node", "__b"])
    below = sum((F.when(F.col("digit") > j, F.col(f"c{j}") + F.col(f"o{j}")).otherwise(0) for j in held), F.lit(0))
    exact = "decimal(19,0)"
    return run.agg(F.coalesce(F.sum((F.col("n").cast(exact) * below.cast(exact)).cast("decimal(38,0)")), F.lit(0)).alias("c"))


def kendall_pair(df: DataFrame, a: str, b: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Exact Kendall tau-b of two columns over the whole table, one row.

    Equal pairs are counted, and values replaced by their ranks.  Two rows with different x part at
    one octal digit of the rank of x, so concordant pairs add up over the digits, each level one
    aggregate and one pass in the order of y; the column with fewer values plays x, as that takes
    fewer levels.  Ties, and with them the discordant pairs, follow from counts.
    """
    both = df.select(F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")).dropna()
    counted = materialize(both.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")), "kendall")
    ranks = {c: value_positions(counted.select(c).distinct(), [], c, rows_per_range=rows_per_range).select(c, F.col("below").alias(f"r{c}")) for c in ("x", "y")}
    sizes = counted.agg(F.countDistinct("x").alias("x"), F.countDistinct("y").alias("y")).first()
    few, many = ("x", "y") if sizes["x"] <= sizes["y"] else ("y", "x")
    cells = counted.join(ranks["x"], "x").join(ranks["y"], "y").select(F.col(f"r{few}").alias("gx"), F.col(f"r{many}").alias("gy"), "n")
    cells = materialize(cells, "kendall-ranks")
    levels = range(max(1, -(-max(sizes[few] - 1, 1).bit_length() // 3)))
    found = [_concordant(cells, level, rows_per_range) for level in levels]
    total = found[0]
    for each in found[1:]:
        total = total.unionByName(each)
    pairs = F.col("n").cast("decimal(38,0)") * (F.col("n") - 1) / 2

    def ties(keys: Sequence[str]):
        return counted.groupBy(*keys).agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum(pairs.cast("double")), F.lit(0.0))).scalar()

    out = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).withColumns(
        {"__c": total.agg(F.sum("c").cast("double")).scalar(), "__tx": ties(["x"]), "__ty": ties(["y"]), "__txy": ties(["x", "y"]), "__p": pairs.cast("double")}
    )
    out = out.withColumn("__d", F.col("__p") - F.col("__tx") - F.col("__ty") + F.col("__txy") - F.col("__c"))
    tau = ratio(F.col("__c") - F.col("__d"), F.sqrt((F.col("__p") - F.col("__tx")) * (F.col("__p") - F.col("__ty"))))
    return out.select(
        F.lit(a).alias("coluna_1"), F.lit(b).alias("coluna_2"), F.col("n").cast("long").alias("n"),
        F.col("__c").alias("concordantes"), F.col("__d").alias("discordantes"), tau.alias("kendall"),
    )


def kendall_pairs(df: DataFrame, columns: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    parts = [kendall_pair(df, a, b, rows_per_range) for a, b in combinations(columns, 2)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _category_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(NULL_LABEL)) for c in columns}
    pairs = [
        F.struct(F.lit(a).alias("coluna_1"), F.lit(b).alias("coluna_2"), text[a].alias("a"), text[b].alias("b"))
        for a, b in combinations(columns, 2)
    ]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def cramers_v(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Association of category pairs from their contingency counts.

    Empty cells need no rows: the statistic follows from observed cells and margins.  Two by
    two tables get the continuity correction.
    """
    scope = ["coluna_1", "coluna_2"]
    cells = _category_pairs(df, columns).groupBy(*scope, "a", "b").agg(F.count(F.lit(1)).cast("double").alias("o"))
    rows = cells.groupBy(*scope, "a").agg(F.sum("o").alias("ra"))
    cols = cells.groupBy(*scope, "b").agg(F.sum("o").alias("cb"))
    row_sums = rows.groupBy(*scope).agg(F.sum("ra").alias("n"), F.count(F.lit(1)).alias("r"), F.sum(1 / F.col("ra")).alias("inv_r"))
    col_sums = cols.groupBy(*scope).agg(F.count(F.lit(1)).alias("k"), F.sum(1 / F.col("cb")).alias("inv_c"))
    joined = cells.join(rows, [*scope, "a"]).join(cols, [*scope, "b"]).join(row_sums, scope)
    gap = F.abs(F.col("o") - F.col("ra") * F.col("cb") / F.col("n"))
    stats = joined.groupBy(*scope).agg(
        F.sum(F.col("o") * F.col("o") / (F.col("ra") * F.col("cb"))).alias("q"), F.max(gap).alias("gap")
    ).join(row_sums, scope).join(col_sums, scope)
    plain = F.col("n") * (F.col("q") - 1)
    corrected = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
    two = corrected * corrected * F.col("n") * F.col("inv_r") * F.col("inv_c")
    chi2 = F.greatest(F.when((F.col("r") == 2) & (F.col("k") == 2), two).otherwise(plain), F.lit(0.0))
    size = F.greatest(F.least(F.col("r") - 1, F.col("k") - 1), F.lit(1))
    return stats.filter("r >= 2 and k >= 2").select(
        *scope, F.sqrt(chi2 / F.col("n") / size).alias("cramers_v"), F.col("n").cast("long").alias("n")
    )


def eta_squared(df: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """Between-group share of the variance of numbers by categories."""
    pairs = [
        F.struct(
            F.lit(c).alias("coluna_categorica"), F.lit(v).alias("coluna_numerica"),
            F.coalesce(F.col(c).cast("string"), F.lit(NULL_LABEL)).alias("g"), F.col(v).cast("double").alias("x"),
        )
        for c in categories for v in numbers
    ]
    scope = ["coluna_categorica", "coluna_numerica"]
    rows = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter("x is not null")
    groups = rows.groupBy(*scope, "g").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    groups = with_totals(groups, scope, total=F.sum("n"), grand=F.sum(F.col("n") * F.col("m")) / F.sum("n"))
    lift = F.col("m") - F.col("grand")
    out = groups.groupBy(*scope).agg(
        F.sum(F.col("n") * lift * lift).alias("between"), F.sum(F.col("n") * F.col("v")).alias("within"),
        F.max("total").alias("n"), F.count(F.lit(1)).alias("qtd_categorias"),
    )
    eta = ratio("between", F.col("between") + F.col("within"))
    return out.filter("n >= 3 and qtd_categorias >= 2").select(*scope, eta.alias("eta_squared"), "n", "qtd_categorias").filter("eta_squared is not null")


# ---- distributions --------------------------------------------------------------------


def _bin(value: str, low: str, high: str, bins: int):
    place = F.floor((F.col(value) - F.col(low)) / (F.col(high) - F.col(low)) * bins)
    return F.when(F.col(value) == F.col(high), bins - 1).otherwise(place).cast("int")


def numeric_histogram(df: DataFrame, columns: Sequence[str], bins: int = 60) -> DataFrame:
    """Equal-width counts per column between its extremes; the last bin is closed."""
    long = with_totals(_long(df, columns), ["coluna"], lo=F.min("v"), hi=F.max("v"), n=F.count("v"))
    kept = long.filter("n >= 3 and hi > lo")
    counted = kept.groupBy("coluna", "lo", "hi", _bin("v", "lo", "hi", bins).alias("bin")).agg(F.count(F.lit(1)).alias("frequencia"))
    width = (F.col("hi") - F.col("lo")) / bins
    return counted.select(
        "coluna", "bin", (F.col("lo") + width * F.col("bin")).alias("inicio"), (F.col("lo") + width * (F.col("bin") + 1)).alias("fim"), "frequencia"
    )


def density_2d(df: DataFrame, pairs: Sequence[tuple[str, str]], bins: int = 60) -> DataFrame:
    """Counts on a bins x bins grid for column pairs, each axis between its own extremes."""
    names = sorted({c for pair in pairs for c in pair})
    ends = df.agg(*[e for c in names for e in (F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}"))])
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in names]).withColumns({e: ends.select(e).scalar() for e in ends.columns})
    cells = [
        F.struct(
            F.lit(a).alias("coluna_1"), F.lit(b).alias("coluna_2"),
            _bin(a, f"lo_{a}", f"hi_{a}", bins).alias("bin_1"), _bin(b, f"lo_{b}", f"hi_{b}", bins).alias("bin_2"),
        )
        for a, b in pairs
    ]
    out = rows.select(F.explode(F.array(*cells)).alias("c")).select("c.*").dropna()
    return out.groupBy("coluna_1", "coluna_2", "bin_1", "bin_2").agg(F.count(F.lit(1)).alias("frequencia"))


def category_frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per value with a bucket for missing ones."""
    text = df.select(*[F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit(NULL_LABEL)).alias(c) for c in columns])
    return text.unpivot([], list(columns), "coluna", "valor").groupBy("coluna", "valor").agg(F.count(F.lit(1)).alias("frequencia"))


def category_summary(frequency: DataFrame) -> DataFrame:
    """Categories, mode and mode share per column."""
    totals = frequency.groupBy("coluna").agg(F.count(F.lit(1)).alias("qtd_categorias"), F.sum("frequencia").alias("__n"))
    mode = top1(frequency, ["coluna"], "frequencia", ["valor"]).withColumnsRenamed({"valor": "moda", "frequencia": "freq_moda"})
    return totals.join(mode, "coluna").withColumn("pct_moda", ratio("freq_moda", "__n")).drop("__n")


# Category and metric columns of the chart summary.
PLOT_CATEGORIES = [
    "ano", "uf", "cargo", "turno", "partido", "candidato", "perfil_faixa_etaria", "perfil_genero", "perfil_instrucao",
    "perfil_estado_civil", "perfil_raca_cor",
]
PLOT_METRICS = ["votos", "eleitorado", "comparecimento_estimado", "abstencao_estimado"]


def plot_summary(gold: DataFrame) -> DataFrame:
    """Rows, votes and electorate per category value; metrics per period and per state."""
    measures = ["linhas_origem", "votos", "eleitorado"]
    names = [c for c in PLOT_CATEGORIES if c in gold.columns]
    text = gold.select(*[safe_text(c).alias(c) for c in names], *measures).unpivot(measures, names, "campo", "valor")
    categories = text.filter("valor <> ''").groupBy("campo", "valor").agg(*sums(measures)).select(
        F.lit("categoria").alias("tipo_resumo"), "campo", "valor", F.lit("linhas_origem").alias("metrica"),
        F.col("linhas_origem").alias("total"), "votos", "eleitorado",
    )
    none = F.lit(None).cast("double")
    for key, kind in (("ano", "metrica_por_ano"), ("uf", "metrica_por_uf")):
        totals = gold.filter(safe_text(key) != "").groupBy(safe_text(key).alias("valor")).agg(*sums(PLOT_METRICS))
        long = totals.unpivot(["valor"], PLOT_METRICS, "metrica", "total")
        categories = categories.unionByName(
            long.select(F.lit(kind).alias("tipo_resumo"), F.lit(key).alias("campo"), "valor", "metrica", "total", none.alias("votos"), none.alias("eleitorado"))
        )
    return categories


def plot_metric(summary: DataFrame) -> DataFrame:
    """The metric each category chart uses: votes, else electorate, else rows."""
    rows = summary.filter("tipo_resumo = 'categoria'").groupBy("campo").agg(*sums(["votos", "eleitorado"]))
    choice = F.when(F.col("votos") > 0, "votos").when(F.col("eleitorado") > 0, "eleitorado").otherwise("total")
    return rows.select("campo", choice.alias("metrica"))

"""Exact ranks and quantiles over groups of any size.

A plain window would sort a whole group in one task.  Here values are first counted (ties
collapse, so a value held by a third of the rows becomes one row), then dealt into ranges of
(group, value) by Spark's range partitioner, ranked inside each range, and shifted by the rows of
the group's earlier ranges.  The number of ranges follows the counted rows, and a group gets as many
of them as it has rows, so a range never holds many more rows than `ROWS_PER_RANGE`, whatever the
table; one that fits is one range and costs no more than a plain window.  Ranges are written to the
shared folder: every branch of the plan, and every retried task, sees the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .core import join_null_safe, order_by_weight, safe_corr, with_totals

ROWS_PER_RANGE = 500_000


def in_ranges(df: DataFrame, keys: Sequence[str | Column], out: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """`df`, written to the shared folder, with the number of the range of `keys` that each row falls in; equal keys share one."""
    df = materialize(df, "ranges")
    ranges = -(-df.count() // rows_per_range)  # counted from the files' footers
    if ranges <= 1:
        return df.withColumn(out, F.lit(0))
    return materialize(df.repartitionByRange(ranges, *keys).withColumn(out, F.spark_partition_id()), "ranges")


def before_ranges(placed: DataFrame, scope: Sequence[str], out: str, total: str, **sums: Column) -> DataFrame:
    """Per group and range: sums over the group's earlier ranges, and over all of them as `total` (of the first sum).

    A group has one row per range here.
    """
    totals = placed.groupBy(*scope, out).agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    group = Window.partitionBy(*(scope or [F.lit(0)]))
    before = group.orderBy(out).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*scope, out, *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(n) for n in sums], F.sum(f"__{next(iter(sums))}").over(group).alias(total))


def value_positions(
    df: DataFrame, scope: Sequence[str], value: str, weight: Column | None = None, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Per (scope, value): `n` rows holding it, `below` rows smaller, `rows` in the scope."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*scope, value).agg(
        F.sum(F.lit(1) if weight is None else weight).cast("long").alias("n")
    )
    placed = in_ranges(counted, [*scope, value], "__b", rows_per_range)
    offsets = before_ranges(placed, scope, "__b", "rows", __offset=F.col("n"))
    inside = Window.partitionBy(*scope, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("__inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return join_null_safe(ranked, offsets, [*scope, "__b"]).select(
        *scope, value, "n", (F.col("__offset") + F.col("__inside")).alias("below"), "rows"
    )


def average_rank_spread(df: DataFrame, scope: Sequence[str], value: str, out: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Average-tie rank of every row for groups of any size."""
    positions = value_positions(df, scope, value, rows_per_range=rows_per_range)
    ranks = positions.select(*scope, value, (F.col("below") + (F.col("n") + 1) / 2).alias(out))
    return df.join(ranks, [*scope, value])


def ranked_spread(df: DataFrame, scope: Sequence[str], weight: str | Column, ties: Sequence[str], out: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Row number per group, largest weight first, for groups of any size; `top_ranked` without a cut."""
    order = order_by_weight(weight, ties)
    placed = in_ranges(df, [*scope, *order], "__b", rows_per_range)
    offsets = before_ranges(placed, scope, "__b", "__rows", __offset=F.lit(1))
    ranked = placed.withColumn("__inside", F.row_number().over(Window.partitionBy(*scope, "__b").orderBy(*order)))
    ranked = join_null_safe(ranked, offsets, [*scope, "__b"])
    return ranked.withColumn(out, (F.col("__offset") + F.col("__inside")).cast("long")).drop("__b", "__inside", "__offset", "__rows")


def pair_correlations(pairs: DataFrame, scope: Sequence[str], min_rows: int, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Pearson and Spearman of (v1, v2) per scope; at least `min_rows` pairs. Groups may be of any size."""
    pairs = materialize(pairs.dropna(subset=["v1", "v2"]).select(*scope, "v1", "v2"), "pairs")
    ranked = average_rank_spread(average_rank_spread(pairs, scope, "v1", "r1", rows_per_range), scope, "v2", "r2", rows_per_range)
    return (
        ranked.groupBy(*scope)
        .agg(
            F.count(F.lit(1)).alias("n"),
            safe_corr("v1", "v2").alias("pearson"),
            safe_corr("r1", "r2").alias("spearman"),
        )
        .filter(F.col("n") >= min_rows)
    )


def exact_quantiles(
    df: DataFrame, scope: Sequence[str], value: str, wanted: dict[str, float], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Linearly interpolated quantiles, one row per scope."""
    positions = value_positions(df, scope, value, rows_per_range=rows_per_range)
    last = F.col("rows") - 1

    def value_at(position: Column) -> Column:
        holds = (F.col("below") <= position) & (position < F.col("below") + F.col("n"))
        return F.max(F.when(holds, F.col(value)))

    parts = []
    for name, p in wanted.items():
        place = last * F.lit(p)
        parts += [
            value_at(F.floor(place)).alias(f"__lo_{name}"),
            value_at(F.ceil(place)).alias(f"__hi_{name}"),
            F.max(place - F.floor(place)).alias(f"__f_{name}"),
        ]
    found = positions.groupBy(*scope).agg(*parts)
    return found.select(
        *scope,
        *[
            (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__f_{n}")).alias(n)
            for n in wanted
        ],
    )


def row_positions(df: DataFrame, value: str, tie: Column, out: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Exact row number over the whole table, ordered by (value, md5(tie)); null for a null value.

    Ranges are cut by value and digest, so even one value held by most rows is ranked by many tasks.
    """
    ready = df.withColumn("__t", F.md5(tie.cast("string")))
    placed = in_ranges(ready.filter(F.col(value).isNotNull()), [value, "__t"], "__b", rows_per_range)
    offsets = before_ranges(placed, [], "__b", "__rows", __offset=F.lit(1))
    inside = Window.partitionBy("__b").orderBy(value, "__t")
    ranked = placed.withColumn("__inside", F.row_number().over(inside))
    ranked = ranked.join(offsets, ["__b"]).withColumn(out, F.col("__offset") + F.col("__inside"))
    missing = ready.filter(F.col(value).isNull()).withColumn(out, F.lit(None).cast("long"))
    kept = [*df.columns, out]
    return ranked.select(*kept).unionByName(missing.select(*kept))


def quantile_band_3(df: DataFrame, value: str, name: str, out: str) -> DataFrame:
    """Low / middle / high at the exact 0.33 and 0.66 quantiles of the whole column."""
    cuts = exact_quantiles(df, [], value, {"low": 0.33, "high": 0.66})
    low, high = cuts.select("low").scalar(), cuts.select("high").scalar()
    v = F.col(value)
    return df.withColumns({"__low": low, "__high": high}).withColumn(
        out,
        F.when(v.isNull(), f"{name}_sem_valor")
        .when(v <= F.col("__low"), f"{name}_baixo")
        .when(v <= F.col("__high"), f"{name}_medio")
        .otherwise(f"{name}_alto"),
    ).drop("__low", "__high")


def quantile_band_4(df: DataFrame, value: str, tie: Column, name: str, out: str) -> DataFrame:
    """Quarter of the row number; no variation when there is too little to split."""
    ranked = row_positions(df, value, tie, "__rn")
    ranked = with_totals(
        ranked, [], __n=F.count(value), __lo=F.min(value), __hi=F.max(value)
    )
    quarter = F.greatest(F.lit(1), F.ceil((F.col("__rn") - 1) * 4 / (F.col("__n") - 1)))
    flat = (F.col("__n") < 4) | (F.col("__lo") == F.col("__hi"))
    words = ["baixo", "medio_baixo", "medio_alto", "alto"]
    band = F.when(F.col(value).isNull(), f"{name}_sem_valor").when(flat, f"{name}_sem_variacao")
    for i, word in enumerate(words, 1):
        band = band.when(quarter == i, f"{name}_{word}")
    return ranked.withColumn(out, band).drop("__rn", "__n", "__lo", "__hi")

"""Building blocks: totals, shares, top-k, level roll-ups, unpivots, lags, correlations.

Two ways to relate a row to its group:

* `share_within` uses a window.  For groups that stay small whatever the data size, such
  as the entities of one section contest.
* `share_of_total` aggregates the totals and joins them back.  For groups that grow with
  the data, such as every candidate of a country: no task ever holds a whole group.

Ranking keeps only `n` rows per group on the map side before any shuffle when `n` is given
(Spark's window group limit), so a hot group costs `n` rows per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..model import ELECTORAL, Spec


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sums(names: Iterable[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def share_within(df: DataFrame, scope: Sequence[str], weight: str, out: str, total: str | None = None) -> DataFrame:
    whole = F.sum(weight).over(Window.partitionBy(*scope))
    if total:
        df = df.withColumn(total, whole)
        whole = F.col(total)
    return df.withColumn(out, ratio(weight, whole))


def totals_with_names(df: DataFrame, keys: Sequence[str], names: Sequence[str], sums: dict[str, Column], maxima: dict[str, Column]) -> DataFrame:
    """Sums and maxima per key, beside the greatest value of every name column.

    The greatest text is found by sorting.  What is sorted here are the rows that a first aggregate, with the
    names among its keys, leaves by hashing; never the input.
    """
    first = df.groupBy(*keys, *names).agg(*[F.sum(c).alias(n) for n, c in sums.items()], *[F.max(c).alias(n) for n, c in maxima.items()])
    if not names:
        return first
    return first.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names], *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxima])


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which equal nulls match; the keys of the left side stay."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def with_totals(df: DataFrame, scope: Sequence[str], **aggregates: Column) -> DataFrame:
    """Group aggregates joined back by key; one-row aggregates become scalar subqueries."""
    named = [expr.alias(name) for name, expr in aggregates.items()]
    if scope:
        return join_null_safe(df, df.groupBy(*scope).agg(*named), list(scope))
    return df.withColumns({name: df.agg(expr.alias(name)).scalar() for name, expr in aggregates.items()})


def share_of_total(df: DataFrame, scope: Sequence[str], weight: str, out: str, total: str | None = None) -> DataFrame:
    name = total or f"__{out}_total"
    df = with_totals(df, scope, **{name: F.sum(weight)}).withColumn(out, ratio(weight, name))
    return df if total else df.drop(name)


def order_by_weight(weight: str | Column, ties: Sequence[str]) -> list[Column]:
    """Largest first; ties fall back to ascending key text, so ranks are reproducible."""
    return [col(weight).desc_nulls_last(), *[F.col(t).asc() for t in ties]]


def top_ranked(
    df: DataFrame, scope: Sequence[str], weight: str | Column, ties: Sequence[str], out: str, n: int | None = None
) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*scope).orderBy(*order_by_weight(weight, ties)))
    ranked = df.withColumn(out, rank)
    if n is not None:
        ranked = ranked.filter(F.col(out) <= n)
    return ranked.withColumn(out, F.col(out).cast("long"))


def top1(df: DataFrame, scope: Sequence[str], weight: str, ties: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The heaviest row per scope as an aggregate: partial results shrink before the shuffle.

    A null weight comes last, as in `top_ranked`.
    """
    lead = F.min(F.struct(F.col(weight).isNull().alias("unknown"), (-F.col(weight)).alias("w"), *[F.col(t) for t in ties], *[F.col(k) for k in keep]))
    best = df.groupBy(*scope).agg(lead.alias("__best"))
    return best.select(
        *scope,
        (-F.col("__best.w")).alias(weight),
        *[F.col(f"__best.{c}").alias(c) for c in [*ties, *keep]],
    )


def unpivot(df: DataFrame, ids: Sequence[str], dims: dict[str, str], name: str, value: str, carry: Sequence[str]) -> DataFrame:
    """One row per (row, dimension). `dims` maps column -> dimension name."""
    picked = df.select(*ids, *carry, *[F.col(c).cast("string").alias(label) for c, label in dims.items()])
    return picked.unpivot([*ids, *carry], list(dims.values()), name, value)


def level_name(spec: Spec = ELECTORAL) -> Column:
    return (
        F.when(F.grouping(spec.place) == 0, "municipio")
        .when(F.grouping(spec.state) == 0, "estado")
        .otherwise("brasil")
    )


def by_level(
    df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], spec: Spec = ELECTORAL,
    levels: Sequence[str] = ("brasil", "estado", "municipio"),
) -> DataFrame:
    """Country, state and municipality totals from one pass with grouping sets.

    The input should already be aggregated to municipality rows: the expansion then
    multiplies a small table, and one shuffle serves every level.
    """
    place = [spec.state, spec.place]
    sets = [[spec.period, *keys, *spec.levels[level]] for level in levels]
    used = [spec.period, *keys, *[c for c in place if any(c in s for s in sets)]]
    kind = F.lit("brasil")
    if spec.state in used:
        kind = F.when(F.grouping(spec.state) == 0, "estado").otherwise(kind)
    if spec.place in used:
        kind = F.when(F.grouping(spec.place) == 0, "municipio").otherwise(kind)
    name = F.max(spec.place_name).alias("__name") if spec.place in used else F.lit("").alias("__name")
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in used]).agg(
        *aggregates, name, kind.alias("nivel")
    )
    blank = {c: F.coalesce(F.col(c), F.lit("")) if c in used else F.lit("") for c in place}
    at_place = F.when(F.col("nivel") == "municipio", F.col("__name")).otherwise("")
    return grouped.withColumns({**blank, spec.place_name: at_place}).drop("__name")


def level_location(level: str, spec: Spec = ELECTORAL) -> dict[str, Column]:
    """The location columns of one level, '' where the level does not have them."""
    has = spec.levels[level]
    return {
        "nivel": F.lit(level),
        **{c: (F.col(c) if c in has else F.lit("")) for c in (spec.state, spec.place)},
        spec.place_name: F.col(spec.place_name) if level == "municipio" else F.lit(""),
    }


def roll_up(
    df: DataFrame, level: str, keys: Sequence[str], aggregates: Sequence[Column], spec: Spec = ELECTORAL
) -> DataFrame:
    """Re-aggregate to one level, with the location columns of the other levels blanked."""
    name = [F.max(spec.place_name).alias(spec.place_name)] if level == "municipio" else []
    out = df.groupBy(*spec.level_scope(level), *keys).agg(*aggregates, *name)
    return out.withColumns(level_location(level, spec))


def previous(df: DataFrame, keys: Sequence[str], order: str, columns: dict[str, str]) -> DataFrame:
    """Value at the previous observed period. Groups hold one row per period."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({out: F.lag(source).over(w) for source, out in columns.items()})


def distinct_text(df: DataFrame, keys: Sequence[str], source: str, out: str, limit: int | None = None, separator: str = " | ") -> DataFrame:
    """The distinct values per key in text order, joined; only the first `limit` if given.

    De-duplicated before collecting; with a limit also ranked, so that at most `limit`
    values per key ever sit in one row.
    """
    values = df.filter(F.trim(F.coalesce(F.col(source), F.lit(""))) != "").select(*keys, source).distinct()
    kept = values
    if limit is not None:
        w = Window.partitionBy(*keys).orderBy(source)
        kept = values.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= limit)
    return kept.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(source)), separator).alias(out))


def text_list(source: str, separator: str = " | ") -> Column:
    """The distinct non-blank values of a group in text order, joined; null without any.

    An aggregate beside others, so the lists cost no scan of their own; partial results are
    sets, so a value is sent once per task and group.
    """
    values = F.collect_set(F.when(F.trim(F.coalesce(F.col(source), F.lit(""))) != "", F.col(source)))
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), separator))


def average_rank(df: DataFrame, scope: Sequence[str], value: str, out: str) -> DataFrame:
    """Rank with ties sharing their mean position. For bounded groups."""
    ties = F.count(F.lit(1)).over(Window.partitionBy(*scope, value))
    rank = F.rank().over(Window.partitionBy(*scope).orderBy(value))
    return df.withColumn(out, rank + (ties - 1) / 2)


def period_pairs(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """Each key's values at every earlier and later period: columns p1, p2, v1, v2."""
    left = df.select(*keys, F.col(period).alias("p1"), F.col(value).alias("v1"))
    right = df.select(*keys, F.col(period).alias("p2"), F.col(value).alias("v2"))
    return left.join(right, list(keys)).filter(F.col("p1") < F.col("p2"))


def safe_corr(a: str, b: str) -> Column:
    """Correlation, null when either side is constant."""
    varies = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    # corr() itself divides by zero on constant input, which ANSI mode rejects
    return F.when(varies, ratio(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))

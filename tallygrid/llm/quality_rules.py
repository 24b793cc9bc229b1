"""Quality rules whose cut-offs are certified on labelled documents.

Every document gets a few counts.  Each rule is a share of such counts that is high in bad
text.  For every stratum (a language with enough labels; all others together) and rule:

1. The selection fold of the labelled documents proposes a ladder of cut-offs (quantiles of
   the bad documents), ordered from lenient to strict.
2. The holdout fold tests the ladder in that order.  A step passes if, were the true rate of
   good documents rejected `limit / rules`, so few rejections had a binomial probability of
   at most `error / (strata * rules)`.  Testing stops at the first step that fails, so the
   chance that any stratum exceeds its limit is at most `error` over the whole table
   (fixed-sequence testing inside a ladder, Bonferroni across ladders), and a document's
   chance of a false rejection by all rules together is at most `limit` in every stratum.
3. Of the certified steps the selection fold picks: most bad documents rejected, a good one
   costing `good_cost` bad ones; of nearly equal steps the most lenient.

Without enough labels nothing can be certified and only the base rules reject.

Null or empty texts have no words and fail the base rules.  Null languages belong to the
common stratum.  Repeated rows are judged alike.  A document labelled twice counts as bad if
any label says so.  Extra columns are carried along, except in `measure`, whose own column
names win over clashing ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import WHITE

# Symbols counted as noise.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_top_word", "n_lines"]
RULES = {
    "symbol_share": ("n_symbols", "word_chars"),
    "upper_share": ("n_upper", "n_letters"),
    "top_word_share": ("n_top_word", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
}
COMMON = "*"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def repeat_words(ids: np.ndarray) -> int:
    """Words inside windows of eight words that occur at least twice."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    wide = ids.astype(np.uint64)
    digest = wide[:n].copy()
    for i in range(1, WINDOW):
        digest = digest * _STEP + wide[i : n + i]
    if len(np.unique(digest)) == n:  # different digests: different windows
        return 0
    code = ids.astype(np.int64)
    for step in (1, 2, 4):  # exact names of windows of 2, 4 and 8 words
        code = np.unique(code[:-step] * (len(ids) + 1) + code[step:], return_inverse=True)[1]
    twice = np.bincount(code)[code] > 1
    edge = np.zeros(len(ids) + 1, np.int32)
    edge[:n] += twice
    edge[WINDOW:] -= twice
    return int((np.cumsum(edge[:-1]) > 0).sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """The values of COUNTS for one text."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return (0,) * len(COUNTS)
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            lines += 1
            dup += line in seen
            seen.add(line)
    upper = len(data) - len(data.translate(None, _UPPER))
    return (
        len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), dup, repeat_words(ids),
        upper, upper + len(data) - len(data.translate(None, _LOWER)), int(np.bincount(ids).max()), lines,
    )


@F.arrow_udf(returnType=T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts(texts: pa.Array) -> pa.Array:
    rows = [count_text(t) for t in texts.to_pylist()]
    columns = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], COUNTS)


_counts = _counts.asNondeterministic()  # evaluated once however many columns are read from it


def measure(docs: DataFrame) -> DataFrame:
    """The documents with the columns of COUNTS and `base_failed`."""
    kept = [c for c in docs.columns if c not in (*COUNTS, "base_failed", "_counts")]
    counted = docs.select(*kept, _counts(F.col("text")).alias("_counts")).select(*kept, "_counts.*")
    return counted.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def share(rule: str) -> Column:
    part, whole = RULES[rule]
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), exact up to rounding."""
    if n <= 0:
        return 1.0
    i = np.arange(k + 1, dtype=np.float64)
    steps = np.log((n - i[:-1]) / (i[:-1] + 1)) + math.log(p / (1 - p)) if k else np.empty(0)
    logs = n * math.log1p(-p) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return min(1.0, float(np.exp(top) * np.exp(logs - top).sum()))


@dataclass
class Cutoffs:
    """Certified cut-offs by stratum; a share that reaches its cut-off rejects."""

    strata: list[str] = field(default_factory=list)
    rows: list[tuple[str, str, float, int, int]] = field(default_factory=list)  # stratum, rule, cut-off, good rejected, good tested


def _stratum(strata: list[str]) -> Column:
    return F.when(F.col("lang").isin(strata), F.col("lang")).otherwise(F.lit(COMMON)) if strata else F.lit(COMMON)


def fit(
    counted: DataFrame, labels: DataFrame, limit: float = 0.05, error: float = 0.05, good_cost: float = 10.0, max_strata: int = 64,
    steps: int = 49, selection: float = 0.3,
) -> Cutoffs:
    """Certify cut-offs from measured documents (`measure`) and labels (doc_id, quality).

    At most `max_strata` languages get a stratum of their own, those with most labels; so
    all that returns to the driver is bounded by strata * rules * steps counts.
    """
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(1000)) < int(1000 * selection)
    known = counted.where(~F.col("base_failed")).join(marks, "doc_id").select("lang", "good", fold.alias("selects"), *[share(r).alias(r) for r in RULES])
    known = materialize(known, "quality-known")
    rate = limit / len(RULES)
    enough = math.ceil(math.log(error / (len(RULES) * (max_strata + 1))) / math.log1p(-rate))
    found = (
        known.where("good and not selects and lang is not null").groupBy("lang").count().where(F.col("count") >= enough)
        .orderBy(F.desc("count"), "lang").limit(max_strata).collect()
    )
    strata = sorted(r["lang"] for r in found)
    known = known.withColumn("stratum", _stratum(strata))
    quantiles = [(i + 1) / (steps + 1) for i in range(steps)]
    proposed = known.where("selects and not good").groupBy("stratum").agg(*[F.percentile_approx(r, quantiles, 10000).alias(r) for r in RULES]).collect()
    ladders = {(p["stratum"], r): sorted({float(v) for v in p[r]}, reverse=True) for p in proposed for r in RULES}
    if not ladders:
        return Cutoffs(strata)
    spark = known.sparkSession
    steps_of = F.broadcast(spark.createDataFrame([(s, r, v) for (s, r), v in ladders.items()], "stratum string, rule string, ladder array<double>"))
    passed = F.size(F.filter("ladder", lambda c: c > F.col("value")))  # how many lenient steps the value survives
    long = known.unpivot(["stratum", "good", "selects"], list(RULES), "rule", "value").join(steps_of, ["stratum", "rule"])
    tally = long.groupBy("stratum", "rule", "good", "selects", passed.alias("step")).count().collect()
    counts = {(t["stratum"], t["rule"], t["good"], t["selects"], t["step"]): t["count"] for t in tally}
    total = {}
    for (s, r, good, selects, _), n in counts.items():
        total[s, r, good, selects] = total.get((s, r, good, selects), 0) + n
    out = Cutoffs(strata)
    for (s, r), ladder in sorted(ladders.items()):
        rejected = {k: np.cumsum([counts.get((s, r, *k, i), 0) for i in range(len(ladder))]) for k in ((True, True), (False, True), (True, False))}
        tested = total.get((s, r, True, False), 0)
        certified = 0
        for wrong in rejected[True, False]:
            if binomial_tail(int(wrong), tested, rate) > error / (len(RULES) * (len(strata) + 1)):
                break
            certified += 1
        gain = rejected[False, True][:certified] - good_cost * rejected[True, True][:certified]
        if certified and gain.max() > 0:
            best = int(np.argmax(gain >= 0.98 * gain.max()))
            out.rows.append((s, r, ladder[best], int(rejected[True, False][best]), tested))
    return out


def judge(counted: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """Measured documents with `kept`: neither the base rules nor a certified cut-off rejects."""
    rejects = F.col("base_failed")
    stratum = _stratum(cutoffs.strata)
    for rule in RULES:
        cut = F.lit(None).cast("double")
        for s, r, value, *_ in cutoffs.rows:
            if r == rule:
                cut = F.when(stratum == s, F.lit(value)).otherwise(cut)
        rejects = rejects | F.coalesce(share(rule) >= cut, F.lit(False))
    return counted.withColumn("kept", ~rejects)


def assess(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """Counts and verdict of every document, without its text."""
    counted = materialize(measure(docs.select("doc_id", "lang", "text")).drop("text"), "quality-counts")
    return judge(counted, fit(counted, labels, **parameters))


def apply(docs: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """The documents that no rule rejects, with their own columns (also where names clash)."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang")
    return judge(measure(packed), cutoffs).where("kept").select("_row.*")


def keep(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """Certify cut-offs on these documents and keep those that no rule rejects."""
    counted = materialize(measure(docs.select("doc_id", "lang", "text")).drop("text"), "quality-counts")
    return apply(docs, fit(counted, labels, **parameters))

"""Records of JSON documents that hold lists, cut by byte ranges.

Spark's text reader splits a document of any size at closing braces, so that many tasks read one
file.  What a piece means depends on all before it: whether it starts inside a string, and how many
braces and brackets are open.  Both are prefix sums, over the pieces of a range and over the ranges of
a file (a small table): quotes first, which tell what is text, then braces and brackets outside of it.
A record ends where a closing brace leaves only the list open ('array': one bracket; 'object': one
bracket in one brace).  Most pieces are whole records and stay where they were read; only the pieces
of records with inner braces are brought together.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_RANGE = ["arquivo", "_range"]
# Open braces and brackets around a record of each kind of document.
AROUND = {"array": (0, 1), "object": (1, 1)}

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]', re.S)


def _last_object(text: str) -> str | None:
    """The object that the closing brace at the end of `text` closes."""
    opened: list[int] = []
    start = None
    for m in _TOKEN.finditer(text):
        if m[0] == "{":
            opened.append(m.start())
        elif m[0] == "}":
            start = opened.pop() if opened else None
    return None if start is None else text[start:]


@F.arrow_udf(returnType=T.StringType())
def last_object(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else _last_object(t) for t in texts.to_pylist()], pa.string())


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text up to each closing brace, with its range of the file and what it opens, closes and quotes."""
    read = spark.read.option("lineSep", "}").text(path)
    rows = read.select("value", F.col("_metadata.file_path").alias("arquivo"), F.col("_metadata.file_block_start").alias("_range"), F.monotonically_increasing_id().alias("_at"))
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    rows = rows.withColumn("_parts", F.split(bare, '"', -1)).withColumn("quotes", F.size("_parts") - 1)
    for name, turn in (("outer", 0), ("inner", 1)):
        side = F.array_join(F.filter("_parts", lambda _, i: i % 2 == turn), "")
        rows = rows.withColumn(name, F.struct((_count(side, "{") - _count(side, "}")).alias("braces"), (_count(side, "[") - _count(side, "]")).alias("brackets")))
    # Written once: the sums below then read the counts alone, not the text.
    return materialize(rows.drop("_parts"), "json-pieces")


def _running(rows: DataFrame, **sums: Column) -> DataFrame:
    """Sums over all rows of a file before this one: of the ranges before, then inside the range."""
    totals = rows.groupBy(*_RANGE).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    before = Window.partitionBy("arquivo").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*_RANGE, *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = Window.partitionBy(*_RANGE).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(offsets, _RANGE).withColumns({n: F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()})
    return rows.drop(*[f"_{n}" for n in sums])


def _own_start(text: Column) -> Column:
    """Text from its first brace outside of strings."""
    return F.regexp_replace(text, r'(?s)^(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+', "")


def split_records(spark: SparkSession, path: str, shape: str = "array") -> DataFrame:
    """(arquivo, registro): the text of every object in the list (or lists) of each document, on one line."""
    braces, brackets = AROUND[shape]
    rows = _running(pieces(spark, path), quoted=F.col("quotes"))
    within = F.col("quoted") % 2 == 1
    ends_within = (F.col("quoted") + F.col("quotes")) % 2 == 1
    side = {n: F.when(within, F.col(f"inner.{n}")).otherwise(F.col(f"outer.{n}")) for n in ("braces", "brackets")}
    closed = F.when(ends_within, 0).otherwise(1)
    rows = rows.select("value", *_RANGE, "_at", ends_within.alias("_text"), (side["braces"] - closed).alias("d_braces"), side["brackets"].alias("d_brackets"))
    rows = _running(rows, braces=F.col("d_braces"), brackets=F.col("d_brackets"))
    open_braces, open_brackets = F.col("braces") + F.col("d_braces"), F.col("brackets") + F.col("d_brackets")
    ends = ~F.col("_text") & (open_braces == braces) & (open_brackets == brackets)
    rows = rows.select(
        "value", *_RANGE, "_at", ends.alias("ends"), ((F.col("braces") == braces) & (F.col("brackets") == brackets)).alias("fresh"),
        # outside of any list nothing belongs to a record, so what has been read so far can go
        (ends | (~F.col("_text") & (open_brackets == 0))).cast("int").alias("cut"),
    )
    text = F.regexp_replace(F.concat("value", F.lit("}")), r"[\r\n]+", " ")
    whole = rows.where("ends and fresh").select("arquivo", _own_start(text).alias("registro"))
    parted = _running(rows, group=F.col("cut")).where("not (ends and fresh)")
    joined = parted.groupBy("arquivo", "group").agg(F.array_sort(F.collect_list(F.struct("_range", "_at", text.alias("t")))).alias("ts"), F.max("ends").alias("ends"))
    several = joined.where("ends").select("arquivo", last_object(F.array_join("ts.t", "")).alias("registro"))
    return whole.unionByName(several).where("registro <> ''")

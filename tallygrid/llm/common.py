"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

# The white space that separates words.
WHITE = " \t\n\x0b\x0c\r"

_U = np.uint64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def crc_mod(doc_id: str, n: int) -> Column:
    """crc32 of the id written as text, modulo n (null for a null id)."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def spread(spark: SparkSession) -> int:
    """How many groups give every task of a shuffle a few of them."""
    return 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)


def small(keys: DataFrame, row_bytes: int = 128, limit: int = 64 << 20) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if its rows fit into `limit` bytes; else as it is, to be shuffled."""
    return F.broadcast(keys) if keys.count() * row_bytes <= limit else keys


def small_by_bytes(keys: DataFrame, limit: int = 64 << 20) -> DataFrame:
    """As `small`, by the bytes that the rows have as JSON."""
    size = keys.agg(F.sum(F.length(F.to_json(F.struct("*")))).alias("n")).first()["n"] or 0
    return F.broadcast(keys) if size <= limit else keys


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """`rows` with `pos`, a row's 0-based place in its group by `order` (nulls first), and `size`, the group's rows.

    No window runs over a group: rows are dealt into ranges of (group, order), sorted there and
    numbered on; a small table with a row per group and range says how many rows of the group lie
    in earlier ranges.  Ties are split too, in the order in which rows are read.
    """
    keys = [group, *order, "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = materialize(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), name)
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33))
    starts = dealt.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    own = Window.partitionBy(group)
    starts = starts.select(
        group, "_part", "_first", F.sum("_n").over(own).alias("size"),
        F.coalesce(F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    placed = dealt.join(starts, [group, "_part"])
    return placed.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")

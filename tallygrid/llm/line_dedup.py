"""Line dedup by probing sharded minimal perfect hashes.

A line's key is the line without white space at both ends, A-Z lower-cased.  Keys found in
at least `min_docs` documents lose all their lines everywhere.

1. Each text gives the 128-bit digests of its distinct keys; they are counted with partial
   aggregation, so a line of every document is one row per task.
2. Digests found twice or more are dealt into shards.  A task builds a minimal perfect hash
   per shard (levels of bit arrays: a key takes the first level where no other key of the
   shard wants its bit; its rank among set bits is its slot) and two arrays by slot: a 64-bit
   fingerprint and a 32-bit count.  An index row is one shard.
3. Documents send only digests, once per distinct text, to the shard that owns them, where
   whole batches probe the arrays.  A digest that is not in the index meets a wrong
   fingerprint or no slot.  Shards that receive more than their share (a line of a third of
   all documents) are copied, and the probes are split among the copies.
4. The digests that came back as frequent are joined to their text; texts without any stay
   untouched in the JVM.

Nothing is collected or broadcast by this module.  Null texts count as one empty line; empty
keys are never dropped.  Every row is a document, repeated rows included.  Extra columns stay.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import mix, spread

#: The largest count that an index holds; `min_docs` can't be larger.
MOST = 2**32 - 1

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)
_DIGESTS = T.ArrayType(T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())]))


def keys_of(text: str) -> list[bytes]:
    """The key of each line; an empty key for a blank line."""
    data = text.encode("utf-8", "surrogatepass").split(b"\n")
    return [line.strip().lower() for line in data]  # for bytes, both mean ASCII


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


@F.arrow_udf(returnType=_DIGESTS)
def _digests(texts: pa.Array) -> pa.Array:
    """Digests of the distinct non-empty keys of each text."""
    found: list[bytes] = []
    ends = [0]
    for text in texts.to_pylist():
        found.extend(_digest(k) for k in dict.fromkeys(keys_of(text or "")) if k)
        ends.append(len(found))
    h1, h2 = _halves(found)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(h1), pa.array(h2)], ["h1", "h2"]))


# ---- minimal perfect hash of one shard


def _places(x: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(x + _U((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % _U(size)).astype(np.int64)


def build_shard(h1: np.ndarray, h2: np.ndarray, counts: np.ndarray, room: float = 1.6) -> tuple[list[int], bytes, bytes, bytes]:
    """Level sizes, bits, fingerprints and counts of distinct keys (h1, h2)."""
    x = h1.astype(np.uint64) + _GOLDEN * h2.astype(np.uint64)
    left = np.arange(len(x))
    sizes, bits, owner = [], [], []
    while len(left):
        size = int(room * len(left)) + 8
        at = _places(x[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        got = alone[at]
        who = np.full(size, -1, np.int64)
        who[at[got]] = left[got]
        sizes.append(size)
        bits.append(alone)
        owner.append(who[alone])
        left = left[~got]
    order = np.concatenate(owner) if owner else np.empty(0, np.int64)
    packed = np.packbits(np.concatenate(bits)) if bits else np.empty(0, np.uint8)
    return sizes, packed.tobytes(), h2[order].astype("<i8").tobytes(), np.minimum(counts[order], MOST).astype("<u4").tobytes()


def probe_shard(shard: tuple, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The stored count of each key, 0 for keys that the shard doesn't hold."""
    sizes, packed, prints, counts = shard
    x = h1.astype(np.uint64) + _GOLDEN * h2.astype(np.uint64)
    bits = np.unpackbits(np.frombuffer(packed, np.uint8), count=sum(sizes)).astype(bool)
    rank = np.cumsum(bits) - 1
    prints, counts = np.frombuffer(prints, "<i8"), np.frombuffer(counts, "<u4")
    out = np.zeros(len(x), np.int64)
    left, start = np.arange(len(x)), 0
    for level, size in enumerate(sizes):
        at = start + _places(x[left], level, size)
        hit = bits[at]
        slot = rank[at[hit]]
        out[left[hit]] = np.where(prints[slot] == h2[left[hit]], counts[slot], 0)
        left, start = left[~hit], start + size
    return out


_INDEX = "shard long, sizes array<long>, bits binary, prints binary, counts binary"


def _build(group: pd.DataFrame) -> pd.DataFrame:
    parts = build_shard(group["h1"].to_numpy(), group["h2"].to_numpy(), group["n_docs"].to_numpy())
    return pd.DataFrame([(int(group["shard"].iloc[0]), *parts)], columns=["shard", "sizes", "bits", "prints", "counts"])


def index_lines(docs: DataFrame, keys_per_shard: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """The index (a row per shard) and the load of each shard (its probes to come)."""
    spark = docs.sparkSession
    lines = docs.select(F.explode(_digests(F.col("text"))).alias("k")).select("k.h1", "k.h2")
    counted = materialize(lines.groupBy("h1", "h2").agg(F.count("*").alias("n_docs")), "line-counts")
    shards = max(spread(spark), counted.count() // keys_per_shard)
    counted = counted.withColumn("shard", F.pmod(F.xxhash64("h1", "h2"), F.lit(shards)))
    index = counted.where("n_docs > 1").groupBy("shard").applyInPandas(_build, _INDEX)
    load = counted.groupBy("shard").agg(F.sum("n_docs").alias("load"))
    return materialize(index, "line-index"), materialize(load.withColumn("shards", F.lit(shards)), "line-load")


def frequent(docs: DataFrame, index: DataFrame, load: DataFrame, min_docs: int) -> DataFrame:
    """(text_key, digests of its frequent lines) for every distinct text that has any."""
    texts = docs.select(_key().alias("text_key"), _digests(F.col("text")).alias("ks")).groupBy("text_key").agg(F.first("ks").alias("ks"))
    shards = load.agg(F.max("shards")).first()[0] or 1
    usual = load.agg(F.avg("load")).first()[0] or 1.0
    copies = load.select("shard", F.greatest(F.ceil(F.col("load") / F.lit(1.5 * usual)), F.lit(1)).alias("copies"))
    held = index.join(copies, "shard").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    sent = texts.select("text_key", F.explode("ks").alias("k")).select("text_key", "k.h1", "k.h2").withColumn("shard", F.pmod(F.xxhash64("h1", "h2"), F.lit(shards)))
    sent = sent.join(copies, "shard").withColumn("copy", F.pmod(F.xxhash64("text_key"), F.col("copies"))).drop("copies")

    def ask(probes: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if probes.empty or shard.empty:
            return probes[["text_key", "h1", "h2"]][:0]
        row = shard.iloc[0]
        found = probe_shard(([int(s) for s in row["sizes"]], row["bits"], row["prints"], row["counts"]), probes["h1"].to_numpy(), probes["h2"].to_numpy())
        return probes.loc[found >= min_docs, ["text_key", "h1", "h2"]]

    hits = sent.groupBy("shard", "copy").cogroup(held.groupBy("shard", "copy")).applyInPandas(ask, "text_key binary, h1 long, h2 long")
    return hits.groupBy("text_key").agg(F.collect_list(F.struct("h1", "h2")).alias("drop"))


def _key():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def _strip(text: str, drop: set[bytes]) -> tuple[str, int]:
    lines = text.split("\n")
    stay = [line for line, k in zip(lines, keys_of(text), strict=True) if not k or _digest(k) not in drop]
    return "\n".join(stay), len(lines) - len(stay)


@F.arrow_udf(returnType=T.StructType([T.StructField("text", T.StringType()), T.StructField("n_dropped", T.LongType())]))
def _without(texts: pa.Array, drops: pa.Array) -> pa.Array:
    """Texts without the lines to drop; null where there is nothing to drop."""
    out = []
    for text, drop in zip(texts.to_pylist(), drops.to_pylist(), strict=True):
        if text is None:
            out.append((None, 0))
        else:
            both = np.array([(d["h1"], d["h2"]) for d in drop], "<i8")
            out.append(_strip(text, {row.tobytes() for row in both}))
    return pa.StructArray.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64())], ["text", "n_dropped"])


_without = _without.asNondeterministic()


def dedup_lines(docs: DataFrame, min_docs: int = 10, keys_per_shard: int = 200_000) -> DataFrame:
    """The documents with `text` without frequent lines, `n_lines` (before) and `n_dropped`.

    Own columns named n_lines or n_dropped give way to the new ones; a null text stays null.
    """
    if not 2 <= min_docs <= MOST:
        raise ValueError(f"the index holds lines of 2 to {MOST} documents")
    index, load = index_lines(docs, keys_per_shard)
    hits = materialize(frequent(docs, index, load, min_docs), "line-hits")
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    row = docs.select(F.struct(*own).alias("_own") if own else F.lit(None).alias("_own"), "text", _key().alias("text_key"))
    joined = row.join(hits, "text_key", "left")
    changed = _without(F.when(F.col("drop").isNotNull(), F.coalesce("text", F.lit(""))), F.col("drop"))
    n_lines = F.length(F.coalesce("text", F.lit(""))) - F.length(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(""))) + 1
    done = joined.select("_own", "text", n_lines.cast("long").alias("n_lines"), changed.alias("new"))
    text = F.coalesce(F.col("new.text"), F.col("text"))
    return done.select(*(["_own.*"] if own else []), text.alias("text"), "n_lines", F.col("new.n_dropped").alias("n_dropped"))


def clean(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """The documents with their own columns, frequent lines gone."""
    rest = [c for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(*rest).alias("_row"), "text")
    done = dedup_lines(packed, min_docs)
    return done.select(*[F.col("text") if c == "text" else F.col(f"_row.{c}").alias(c) for c in docs.columns])

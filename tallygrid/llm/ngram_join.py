"""Jaccard self-join on word n-grams with an R-tree over count vectors.

The shingles of a text are hashed into groups.  The number of shingles per group is a point;
the overlap of two sets is at most the sum of the smaller coordinates, so a tree whose nodes
hold the largest coordinates below them rules out whole nodes; pairs that pass are verified.

A tree over all documents would not scale: with hundreds of groups the counts of any two
unrelated texts are alike, and no box of more than a few of them is ever ruled out.  So the
same groups first deal the documents into cells that hold all pairs that can link:

* Sizes fall into bands (a factor 1.5).  Sets that link differ in at most D shingles, a bound
  of the band, so of G = D + t groups at least t are the same in both.  Each group's content
  has one digest.  Neighbouring bands meet under groups of their own.
* Two documents share a cell if they share t digests.  Digests of more than `hot` documents
  (an empty group, or one that holds only words of a very common passage) are not paired:
  a document with h of them needs only t - h shared digests that are not hot, and one with
  t or more shares a cell with all such documents with which it has one of its h - t + 1 rarest
  hot digests in common: of t that two share, the rarest is among those of either.  The commonest,
  such as those of empty groups, so tie no unlike documents together.
  So no linked pair is lost, and no more than `hot` documents are ever paired by a digest.
* A cell of up to `page` sets is searched in one task by its tree.  A larger one is dealt
  into pages; every two pages meet in a task, so no task holds more than two pages.

Inside a task, sets already connected are not compared again, so a group of near copies costs
about a verification per copy, and only connecting links leave the task.  Equal sets are
one class from the start (128-bit digest of the set); copies are never paired.

Results: one row per document with its number of shingles and the smallest doc_id it reaches.
Null and empty texts have no shingles and link to nothing.  A text with fewer words than the
width is one shingle, its whole sequence.  Rows without doc_id cannot carry a class: they get
the component of an equal set if there is one, else null.  Repeated rows get equal results;
rows of one doc_id with different texts are sets of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import mix, small, spread
from .graph import components

_U = np.uint64
_ODD = [_U(0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64) for i in range(64)]
SHINGLES = 2_500_000  # behind the digests in a task that looks for those of several sets


# ---- shingles


_CHUNK = 1 << 20  # bytes of text that are looked at at once
_LONG = 64  # bytes of a word from which on it is digested by itself
_BYTES = np.arange(256, dtype=np.uint8)
_INK = ~np.isin(_BYTES, np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
_LETTER = mix(np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint64) * _ODD[3] + _ODD[4])  # a capital's is that of its small letter


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of its inverse, modulo 2**64."""
    odd = int(_ODD[5]) | 3
    found = []
    for base in (odd, pow(odd, -1, 2**64)):
        row = np.full(_CHUNK, base, np.uint64)
        row[0] = 1
        found.append(np.multiply.accumulate(row))
    return found[0], found[1]


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of the words (capitals read as small letters), and the first byte of each; a text begins at each of `starts`.

    A word's digest is a polynomial of its bytes, read off running sums; of long words, in which patterns could
    cancel out, xxhash.  For up to `_CHUNK` bytes.
    """
    power, inverse = _powers()
    ink = np.zeros(len(data) + 2, bool)
    ink[1:-1] = _INK[data]
    first, last = ink[1:-1] & ~ink[:-2], ink[1:-1] & ~ink[2:]
    cut = starts[(starts > 0) & (starts < len(data))]
    first[cut] |= ink[1:-1][cut]
    last[cut - 1] |= ink[1:-1][cut - 1]
    first, last = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * power[: len(data)], out=sums[1:])
    ids = mix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64) * _ODD[6])
    for i in np.flatnonzero(last - first > _LONG):
        ids[i] = xxhash.xxh3_64_intdigest(data[first[i] : last[i]].tobytes().lower())
    return ids, first


def _long_text(data: np.ndarray) -> np.ndarray:
    """The words of one text of any length: cut after white space, or after a word that is longer than a chunk."""
    found, at = [], 0
    while at < len(data):
        piece = data[at : at + _CHUNK]
        if at + len(piece) < len(data):
            white = np.flatnonzero(~_INK[piece])
            if len(white):
                piece = piece[: white[-1] + 1]
            else:
                end = at + len(piece)
                while end < len(data) and not len(white := np.flatnonzero(~_INK[data[end : end + _CHUNK]])):
                    end = min(end + _CHUNK, len(data))
                end += int(white[0]) if end < len(data) else 0
                found.append(np.array([xxhash.xxh3_64_intdigest(data[at:end].tobytes().lower())], np.uint64))
                at = end
                continue
        found.append(_words(piece, np.zeros(1, np.int64))[0])
        at += len(piece)
    return np.concatenate(found)


def shingle_sets(data: np.ndarray, ends: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct 64-bit shingles of texts that lie behind one another (`ends`: where each begins, and the last ends).

    Yields for runs of texts: the shingles of all, and where those of each begin and the last end.
    """
    at, n = 0, len(ends) - 1
    while at < n:
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + _CHUNK, "right")) - 1)
        here, borders = data[ends[at] : ends[upto]], ends[at : upto + 1] - ends[at]
        if len(here) > _CHUNK:  # one text
            ids = _long_text(here)
            counts = np.array([len(ids)])
        else:
            ids, first = _words(here, borders[:-1])
            counts = np.diff(np.searchsorted(first, borders))
        yield _shingles(ids, counts, width)
        at = upto


def _shingles(ids: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    begin = np.cumsum(counts) - counts
    size = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    borders = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(borders[-1], np.uint64)
    for words in range(1, width + 1):  # a text of fewer words than the width is one shingle
        texts = np.flatnonzero(counts == words if words < width else counts >= width)
        if not len(texts):
            continue
        start = np.repeat(begin[texts] - (np.cumsum(size[texts]) - size[texts]), size[texts]) + np.arange(size[texts].sum())
        sums = np.full(len(start), words, np.uint64)
        for i in range(words):
            sums = mix(sums ^ ids[start + i]) if i < words - 1 else sums ^ ids[start + i]
        out[start - np.repeat(begin[texts], size[texts]) + np.repeat(borders[texts], size[texts])] = mix(sums)
    for i in np.flatnonzero(size > 1):
        out[borders[i] : borders[i + 1]].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[borders[:-1][size > 0]] = True
    return out[new], np.concatenate([[0], np.cumsum(new)])[borders]


def _laid_out(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes behind one another, and where each begins and the last ends."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    return np.frombuffer(b"".join(coded), np.uint8), np.concatenate([[0], np.cumsum([len(c) for c in coded], dtype=np.int64)])


def _in_place(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As `_laid_out`, of an Arrow array, without a copy."""
    texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, kind, len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8), ends


# ---- size bands and groups


@cache
def schemes(percent: int, most: int = 2**31) -> list[tuple[int, int, int, int]]:
    """(least size, greatest size, groups, shared groups of any linked pair) by scheme.

    Even schemes are bands, odd ones the sizes next to the border of two bands.
    """
    out, low = [], 1
    while low < most and len(out) < 250:
        high = max(low + 1, math.ceil(1.5 * low))
        differ = (100 - percent) * 2 * (high - 1) // (100 + percent)
        top = 100 * (high - 1) // percent
        across = (100 - percent) * (high - 1 + top) // (100 + percent)
        for least, greatest, d in ((low, high - 1, differ), (-(-percent * high // 100), top, across if top >= high else 0)):
            shared = 3 + math.ceil(0.1 * d)
            out.append((least, greatest, d + shared if d else 0, shared))
        low = high
    return out


def signatures(hashes: np.ndarray, percent: int) -> np.ndarray:
    """A digest of each group's content in every scheme of the set's size; the low byte is the scheme."""
    return signatures_of(hashes, np.array([0, len(hashes)]), percent)[0]


def signatures_of(hashes: np.ndarray, borders: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """As `signatures`, for sets that lie behind one another; and where those of each set begin and the last end."""
    least, greatest, groups, _ = np.array(schemes(percent), np.int64).T
    begin, n = borders[:-1], np.diff(borders)
    scheme = 2 * (np.searchsorted(least[::2], n, "right") - 1)[:, None] + np.array([-1, 0, 1])
    known = np.clip(scheme, 0, len(least) - 1)
    fits = (n > 0)[:, None] & (scheme == known) & (least[known] <= n[:, None]) & (n[:, None] <= greatest[known]) & (groups[known] > 0)
    fits &= (n <= greatest[known[:, 1]])[:, None]
    of, column = np.nonzero(fits)
    scheme = scheme[of, column]
    dealt, size, begin = groups[scheme], n[of], begin[of]  # of each set in each of its schemes
    if not len(of):
        return np.empty(0, np.int64), np.zeros(len(n) + 1, np.int64)
    group_at, at = np.cumsum(dealt) - dealt, np.cumsum(size) - size
    high = (hashes >> _U(32))[np.repeat(begin - at, size) + np.arange(size.sum())]
    group = ((high * np.repeat(dealt.astype(np.uint64), size)) >> _U(32)).astype(np.int64)
    held = np.bincount(group + np.repeat(group_at, size), minlength=int(dealt.sum()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ _ODD[1]), dtype=np.uint64)])
    upto = np.cumsum(held) + np.repeat(begin - at, dealt)
    content = sums[upto] - sums[upto - held]
    number = (np.arange(1, len(held) + 1) - np.repeat(group_at, dealt)).astype(np.uint64)
    digest = mix(mix(content) + number * _ODD[2] + np.repeat(np.array(_ODD)[scheme % 64], dealt))
    found = (digest & _U(2**64 - 256)) | np.repeat(scheme.astype(np.uint64), dealt)
    return found.view(np.int64), np.concatenate([[0], np.cumsum(np.bincount(of, dealt, len(n)).astype(np.int64))])


_SKETCH = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("sigs", T.ArrayType(T.LongType()))]
)


def _sketcher(width: int, percent: int):
    @F.arrow_udf(returnType=_SKETCH)
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            seen: set[bytes] = set()
            n, keys, sigs, held = [np.empty(0, np.int64)], [], [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
            for hashes, borders in shingle_sets(*_in_place(texts), width):
                own = [xxhash.xxh3_128_digest(hashes[a:b].tobytes()) for a, b in zip(borders[:-1], borders[1:])]
                fresh = np.array([not (key in seen or seen.add(key)) for key in own])  # a repeat adds nothing
                size = np.diff(borders)
                kept = np.repeat(fresh, size)
                found, at = signatures_of(hashes[kept], np.concatenate([[0], np.cumsum(size[fresh])]), percent)
                count = np.zeros(len(own), np.int64)
                count[fresh] = np.diff(at)
                n.append(size)
                keys += own
                sigs.append(found)
                held.append(count)
            both = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(held)).astype(np.int32)), pa.array(np.concatenate(sigs)))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(n)), pa.array(both[:, 0]), pa.array(both[:, 1]), lists], ["n", "k1", "k2", "sigs"])

    return sketch.asNondeterministic()


# ---- the tree


class CountTree:
    """R-tree over count vectors, packed by size and then by the most varied coordinate.

    A node holds the largest count per group below it and the smallest size.
    """

    def __init__(self, counts: np.ndarray, leaf: int = 8, fan: int = 8):
        sizes = counts.sum(1)
        slabs = max(1, math.isqrt(-(-len(counts) // leaf)))
        by_size = np.argsort(sizes, kind="stable")
        widest = int(counts.var(0).argmax()) if len(counts) else 0
        self.order = np.concatenate([s[np.argsort(counts[s, widest], kind="stable")] for s in np.array_split(by_size, slabs)])
        self.levels = [(counts[self.order], sizes[self.order], 1)]
        step = leaf
        while len(self.levels[-1][0]) > 2 * step:
            top, least, _ = self.levels[-1]
            starts = np.arange(0, len(top), step)
            self.levels.append((np.maximum.reduceat(top, starts), np.minimum.reduceat(least, starts), step))
            step = fan

    def search(self, counts: np.ndarray, percent: int) -> np.ndarray:
        """Points whose overlap with `counts` may be large enough."""
        size = int(counts.sum())
        at = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            top, least, step = self.levels[level]
            partner = np.maximum(least[at], -(-percent * size // 100))
            bound = np.minimum(top[at], counts).sum(1)
            at = at[(100 + percent) * bound >= percent * (size + partner)]
            if level:
                below = len(self.levels[level - 1][0])
                at = (at[:, None] * step + np.arange(step)).ravel()
                at = at[at < below]
        return self.order[at]


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def connect(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all sets which links connect; with `side`, only pairs of two sides are looked at."""
    if len(sets) < 2:
        return []
    dims = 1 << int(np.clip(np.log2(max(1.0, float(np.median([len(s) for s in sets])) / 4)), 4, 10))
    shift = _U(64 - int(math.log2(dims)))
    counts = np.array([np.bincount((s >> shift).astype(np.int64), minlength=dims) for s in sets], np.int32)
    tree, label, links = CountTree(counts), np.arange(len(sets)), []
    for i, own in enumerate(sets):
        near = tree.search(counts[i], percent)
        near = near[near > i] if side is None else near[side[near] != side[i]] if side[i] == 0 else near[:0]
        while len(near := near[label[near] != label[i]]):
            j, near = int(near[0]), near[1:]
            both = _overlap(own, sets[j])
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                links.append((i, j))
                label[label == label[j]] = label[i]
    return links


# ---- Spark


def sketch(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, tkey, n, k1, k2, sigs) per document, written once; tkey names the text."""
    made = docs.select("doc_id", F.xxhash64("text").alias("tkey"), _sketcher(width, percent)(F.col("text")).alias("s"))
    return materialize(made.select("doc_id", "tkey", "s.*"), "ngram-sketch")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, sig, held) of the digests that several sets hold; all rows of a digest are here."""
    read = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not read:
        return
    k, sig = (np.concatenate(c) for c in zip(*read))
    at = np.argsort(sig)
    same = sig[at[1:]] == sig[at[:-1]]
    at = at[np.append(same, False) | np.append(False, same)] if len(at) > 1 else at[:0]  # most digests are one set's alone
    k, sig = k[at], sig[at]
    at = np.lexsort((k, sig))
    k, sig = k[at], sig[at]
    new = np.append(True, (k[1:] != k[:-1]) | (sig[1:] != sig[:-1]))[: len(k)]  # equal sets count once
    k, sig = k[new], sig[new]
    _, number, held = np.unique(sig, return_inverse=True, return_counts=True)
    held = held[number]
    k, sig, held = k[held > 1], sig[held > 1], held[held > 1]
    for i in range(0, len(k), 65536):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 65536]) for c in (k, sig, held)], ["k", "sig", "held"])


def cells(sketched: DataFrame, percent: int, hot: int) -> DataFrame:
    """(k1, cell): sets that may link are in one cell."""
    scheme = F.col("sig").bitwiseAND(F.lit(255)).alias("scheme")
    needed = F.element_at(F.array(*[F.lit(s[3]) for s in schemes(percent)]), (F.col("scheme") + 1).cast("int"))
    rows = sketched.select(F.col("k1").alias("k"), F.explode("sigs").alias("sig"))
    # The digests meet once, in tasks of about a million, whatever their number: there are fewer of them than shingles.
    tasks = 1 + (sketched.agg(F.sum("n")).first()[0] or 0) // SHINGLES
    rows = materialize(rows.repartition(tasks, "sig").mapInArrow(_shared, "k long, sig long, held long"), "ngram-shared")
    cold, warm = rows.where(F.col("held") <= hot).select("k", "sig", scheme), rows.where(F.col("held") > hot).select("k", "sig", scheme, "held")
    heat = warm.groupBy("k", "scheme").agg(F.count("*").alias("heat"))
    # Two sets that link share `needed` digests; those among them that are hot are at most the hot ones of either.
    met = cold.alias("x").join(cold.alias("y"), "sig").where("x.k < y.k").groupBy(F.col("x.k").alias("a"), F.col("y.k").alias("b"), F.col("x.scheme").alias("scheme"))
    met = met.agg(F.count("*").alias("met"))
    for side in ("a", "b"):
        met = met.join(heat.select(F.col("k").alias(side), "scheme", F.col("heat").alias(f"heat_{side}")), [side, "scheme"], "left")
    cover = F.least(F.coalesce("heat_a", F.lit(0)), F.coalesce("heat_b", F.lit(0)))
    cold_links = met.where(F.col("met") + cover >= needed).select("a", "b")
    # Sets that could share only hot digests stay in the rarest of theirs.
    own = Window.partitionBy("k", "scheme")
    ranked = warm.withColumns({"heat": F.count("*").over(own), "rank": F.row_number().over(own.orderBy("held", "sig"))})
    stay = ranked.where(F.col("rank") <= F.col("heat") - needed + 1).select("k", "sig")
    hot_links = stay.join(stay.groupBy("sig").agg(F.min("k").alias("first")), "sig").select(F.col("k").alias("a"), F.col("first").alias("b"))
    return components(cold_links.unionByName(hot_links), "ngram-cells").select(F.col("node").alias("k1"), F.col("component").alias("cell"))


def _verifier(width: int, percent: int):
    def verify(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, cell in group.drop_duplicates(["rep", "tkey", "cell"]).groupby("cell", sort=False):
            keys, sets = cell["k1"].to_numpy(), []
            for hashes, borders in shingle_sets(*_laid_out(cell["text"].tolist()), width):
                sets += np.split(hashes, borders[1:-1])
            across = cell["i"].iloc[0] != cell["j"].iloc[0]
            side = (cell["page"] != cell["i"]).to_numpy().astype(int) if across else None
            found += [(int(keys[a]), int(keys[b])) for a, b in connect(sets, percent, side)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return verify


def links(docs: DataFrame, sketched: DataFrame, width: int, percent: int, hot: int, page: int) -> DataFrame:
    """Verified links (a, b) between the k1 of different sets; they connect all that links connect."""
    spark = docs.sparkSession
    classes = sketched.where("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "tkey")).alias("r"))
    member = materialize(classes.select("k1", "r.*").join(cells(sketched, percent, hot), "k1"), "ngram-members")
    sizes = member.groupBy("cell").agg(F.count("*").alias("size"))
    units = max(spread(spark), member.count() // 400)
    pages = F.ceil(F.col("size") / page)
    member = member.join(sizes, "cell").withColumn("pages", pages).withColumn("page", F.pmod(F.xxhash64("k1"), F.col("pages")))
    member = materialize(member.withColumnRenamed("doc_id", "rep").withColumnRenamed("tkey", "rkey").drop("size"), "ngram-placed")
    texts = docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text")
    placed = texts.join(small(member), (F.col("doc_id") == F.col("rep")) & (F.col("tkey") == F.col("rkey"))).drop("doc_id", "rkey")
    # A text is copied to the tasks of its page only now, so that the table that meets the texts has a row for each set.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages") - 1)))
    one = F.col("pages") == 1
    placed = placed.select(
        "rep", "tkey", "text", "k1", "cell", "page", F.when(one, F.pmod(F.xxhash64("cell"), F.lit(units))).otherwise(F.col("cell")).alias("unit"),
        F.when(one, F.lit(-1)).otherwise(F.least("page", "other")).alias("i"), F.when(one, F.lit(-1)).otherwise(F.greatest("page", "other")).alias("j"),
    )
    return placed.groupBy("unit", "i", "j").applyInPandas(_verifier(width, percent), "a long, b long")


def join(docs: DataFrame, width: int = 5, percent: int = 80, hot: int = 16, page: int = 256) -> DataFrame:
    """(doc_id, tkey, n_shingles, component_id) of every document."""
    if not 70 <= percent <= 100:
        raise ValueError("percent must be 70 to 100")
    sketched = sketch(docs.select("doc_id", "text"), width, percent)
    reached = components(links(docs.select("doc_id", "text"), sketched, width, percent, hot, page), "ngram-components")
    classes = sketched.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("own")).join(reached.withColumnRenamed("node", "k1"), "k1", "left")
    lowest = classes.where("component is not null").groupBy("component").agg(F.min("own").alias("lowest"))
    classes = classes.join(lowest, "component", "left").select("k1", "k2", F.coalesce("lowest", "own").alias("component_id"), F.lit(True).alias("any"))
    plain = sketched.select("doc_id", "tkey", "n", "k1", "k2").join(classes, ["k1", "k2"], "left")
    return plain.select("doc_id", "tkey", F.col("n").alias("n_shingles"), F.when(F.col("any"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component: that with the smallest doc_id.

    Documents without shingles or without doc_id stay, repeated rows of one document once.
    The texts are only shuffled if the rows that go don't fit into a broadcast.
    """
    found = materialize(join(docs, width, percent), "ngram-found")
    gone = materialize(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id", "tkey").distinct(), "ngram-gone")
    twice = materialize(found.groupBy("doc_id", "tkey").count().where("count > 1").select("doc_id", "tkey"), "ngram-twice")
    row = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", F.xxhash64("text").alias("tkey"))

    def meet(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = small(keys).select(F.col("doc_id").alias("_d"), F.col("tkey").alias("_t"))
        return rows.join(keys, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tkey") == F.col("_t")), how)

    stay = meet(row, gone, "left_anti")
    once, again = meet(stay, twice, "left_anti"), meet(stay, twice, "left_semi").dropDuplicates(["doc_id", "tkey"])
    return once.unionByName(again).select("_row.*")

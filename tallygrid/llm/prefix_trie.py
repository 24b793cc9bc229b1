"""Prefix trie of conversations by burst tries.

A turn is the digest of its role and text; equal conversations are one sequence with a weight.

1. Sequences start in one container under the root.  Containers whose suffixes hold more than
   `cap` turns burst: members move on by their next turn ids to containers under new heads, 1, 2,
   4 ... up to `stride` turns a round, and the heads passed become nodes by aggregation, so a first
   turn of a third of all conversations is split like any other.
2. A container that still is large but holds a single suffix is a chain: its nodes are its rows.
3. The remaining containers are dealt into shards.  A task sorts a container's suffixes and sweeps
   them with a stack into nodes and their subtree sums; a summary row goes to the container's head.
4. Summaries rise to the root round by round through the heads.
5. The ids that end in a node are numbered by ranges and joined in blocks; a running hash passes
   over the blocks.

No conversation, container or list of ids is gathered whole beyond `cap` and `stride` turns.
Turns go by `turn`, null first, ties by digest; a null role or text is an empty one; rows without
a conversation id are left out; repeated rows are turns of their own.  An empty table has no
nodes.  Other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import clear_scratch, materialize
from .common import ranked, spread

_WORD = r"[^\x20\x09-\x0D]+"


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, size, tid, words): turns numbered from 0 within their conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    tid = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    words = F.regexp_count(text, F.lit(_WORD)).cast("long")
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", tid.alias("tid"), words.alias("words"))
    return ranked(rows, "conv_id", ["turn", "tid"], "trie-turns").select("conv_id", "pos", "size", "tid", "words")


def rebuild(numbered: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns are those of their family's first one: rows (c, d, tid, words), and all ids (c)."""
    c = F.col("conv_id")
    h = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(heads))
    base = c - c % family
    starts = numbered.where("pos = 0").select("conv_id", "size")
    lent = numbered.where(F.col("pos") < heads - 1).select(F.col("conv_id").alias("base"), "pos", "tid", "words")
    first = starts.select("conv_id", base.alias("base"), h.alias("h")).join(lent, "base").where("pos < h")
    first = first.select(F.col("conv_id").alias("c"), (F.col("pos") + 1).alias("d"), "tid", "words")
    had = starts.select(F.col("conv_id").alias("base"), F.col("size").alias("n_base"))
    own = numbered.withColumns({"base": base, "h": h}).where("pos >= h").join(had, "base", "left")
    at = F.least(F.col("h"), F.coalesce(F.col("n_base"), F.lit(0))) + F.col("pos") - F.col("h") + 1
    rest = own.select(F.col("conv_id").alias("c"), at.alias("d"), "tid", "words")
    return first.unionByName(rest), starts.select(F.col("conv_id").alias("c"))


def sequences(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences (c: smallest id, m: conversations, len), and members (c, rep) of those held by several."""
    digest = rows.groupBy("c").agg(F.bit_xor(F.xxhash64("d", "tid")).alias("f1"), F.bit_xor(F.xxhash64("tid", "d", F.lit(7))).alias("f2"), F.count("*").alias("len"))
    held = ids.join(digest, "c", "left").select("c", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("f1", "f2", "len")])
    held = materialize(held, "trie-sequences")
    found = held.groupBy("f1", "f2", "len").agg(F.min("c").alias("rep"), F.count("*").alias("m"))
    found = materialize(found, "trie-distinct")
    members = held.join(found.where("m > 1"), ["f1", "f2", "len"]).select("c", "rep")
    return found.select(F.col("rep").alias("c"), "m", "len"), members


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, text) sorted by rep and block -> SHA-256 of the texts joined by commas; only the running hash is kept."""
    now, running = None, None
    for batch in batches:
        out = []
        for rep, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if rep == now:
                running.update(b"," + text.encode())
                continue
            if running is not None:
                out.append((now, running.hexdigest()))
            now, running = rep, hashlib.sha256(text.encode())
        if out:
            yield _lists(out)
    if running is not None:
        yield _lists([(now, running.hexdigest())])


def _lists(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["rep", "ends_sha256"])


def list_digests(members: DataFrame, block: int = 256) -> DataFrame:
    """(rep, ends_sha256): the hash of each group's ids, ascending, joined by commas."""
    placed = ranked(members, "rep", ["c"], "trie-members").withColumn("block", F.floor(F.col("pos") / block))
    parts = placed.groupBy("rep", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x.cast("string")), ",").alias("text"))
    return parts.repartition("rep").sortWithinPartitions("rep", "block").select("rep", "text").mapInArrow(_hash_lists, "rep long, ends_sha256 string")


# ---- bursting


def _passed(head: Column, suffix: Column) -> Column:
    """The keys of the nodes after each turn of `suffix` (d, tid, words), below `head`."""
    start = F.struct(head.alias("k"), F.array().cast("array<binary>").alias("ks"))

    def step(done: Column, turn: Column) -> Column:
        key = F.unhex(F.md5(F.concat(done["k"], turn["tid"])))
        return F.struct(key.alias("k"), F.concat(done["ks"], F.array(key)).alias("ks"))

    return F.aggregate(suffix, start, step, lambda done: done["ks"])


def burst(rows: DataFrame, live: DataFrame, depth: int, stride: int) -> tuple[DataFrame, DataFrame]:
    """Move the members of `live` (c, m, len, head) on by `stride` turns: the nodes passed, and who is left where."""
    near = rows.where((F.col("d") > depth) & (F.col("d") <= depth + stride)).join(live, "c")
    moved = near.groupBy("c", "m", "len", "head").agg(F.array_sort(F.collect_list(F.struct("d", "tid", "words"))).alias("suffix"))
    moved = materialize(moved.withColumn("keys", _passed(F.col("head"), F.col("suffix"))).select("c", "m", "len", "head", "keys", F.col("suffix.words").alias("words")), "trie-moved")
    each = moved.select("c", "m", "len", "head", "keys", F.posexplode(F.arrays_zip("keys", "words")).alias("i", "x"))
    each = each.select(
        "c", "m", "len", "head", F.col("x.keys").alias("key"), F.col("x.words").alias("words"), (F.col("i") + depth + 1).cast("long").alias("depth"),
        F.slice("keys", 1, F.col("i") + 1).alias("anc"), F.when(F.col("i") == 0, F.col("head")).otherwise(F.get("keys", F.col("i") - 1)).alias("parent"),
    )
    nodes = each.groupBy("key").agg(
        F.sum("m").alias("n"), F.min("c").alias("c"), F.max(F.when(F.col("len") == F.col("depth"), F.col("c"))).alias("end"),
        *[F.first(x).alias(x) for x in ("parent", "head", "depth", "words", "anc")],
    )
    left = moved.where(F.col("len") > depth + stride).select("c", "m", "len", F.element_at("keys", -1).alias("head"))
    return materialize(nodes, "trie-nodes"), left


def burst_all(rows: DataFrame, seqs: DataFrame, cap: int, stride: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Node tables of every round, and the containers left: (c, m, len, head, head_c, top, lone)."""
    live = seqs.where("len > 0").select("c", "m", "len", F.lit(b"").alias("head"))
    heads = seqs.agg(F.min("c").alias("head_c")).select(F.lit(b"").alias("head"), "head_c")
    rounds, resting, depth, step = [], None, 0, 1
    while True:
        sizes = live.groupBy("head").agg(F.sum(F.col("len") - depth).alias("load"), F.count("*").alias("members")).join(heads, "head")
        kind = F.when(F.col("load") <= cap, "small").when(F.col("members") == 1, "lone").otherwise("burst")
        state = materialize(live.join(sizes.select("head", "head_c", kind.alias("kind")), "head"), "trie-live")
        rest = state.where("kind <> 'burst'").select("c", "m", "len", "head", "head_c", F.lit(depth).alias("top"), (F.col("kind") == "lone").alias("lone"))
        resting = rest if resting is None else resting.unionByName(rest)
        going = state.where("kind = 'burst'")
        if going.isEmpty():
            return rounds, resting
        nodes, live = burst(rows, going.select("c", "m", "len", "head"), depth, step)
        rounds.append(nodes)
        heads = nodes.select(F.col("key").alias("head"), F.col("c").alias("head_c"))
        depth, step = depth + step, min(2 * step, stride)


# ---- containers

_SWEPT = "head binary, conv_id long, depth long, parent long, n long, n_children long, n_leaves long, saved long, end long"


class _Node:
    __slots__ = ("tid", "depth", "words", "n", "c", "children", "leaves", "saved", "end", "up")

    def __init__(self, tid: bytes, depth: int, words: int, up: _Node | None) -> None:
        self.tid, self.depth, self.words, self.up = tid, depth, words, up
        self.n = self.children = self.leaves = self.saved = 0
        self.c, self.end = None, None

    def close(self) -> None:
        """Add what is known now to the parent."""
        self.leaves = self.leaves or 1
        self.saved += (self.n - 1) * self.words
        up = self.up
        up.n, up.children, up.leaves, up.saved = up.n + self.n, up.children + 1, up.leaves + self.leaves, up.saved + self.saved
        up.c = self.c if up.c is None else min(up.c, self.c)


def sweep(suffixes: list[tuple[list[bytes], int, int, list[int]]], top: int) -> tuple[_Node, list[_Node]]:
    """A container's nodes from its distinct suffixes (turn ids, conversation, weight, words): sorted, then a stack of open nodes."""
    head = _Node(b"", top, 0, None)
    open_nodes, nodes = [head], []
    for tids, c, m, words in sorted(suffixes):
        shared = 0
        while shared < len(tids) and shared + 1 < len(open_nodes) and open_nodes[shared + 1].tid == tids[shared]:
            shared += 1
        while len(open_nodes) > shared + 1:
            open_nodes.pop().close()
        for i in range(shared, len(tids)):
            nodes.append(_Node(tids[i], top + i + 1, words[i], open_nodes[-1]))
            open_nodes.append(nodes[-1])
        last = open_nodes[-1]
        last.n, last.end = last.n + m, c
        last.c = c if last.c is None else min(last.c, c)
    while len(open_nodes) > 1:
        open_nodes.pop().close()
    return head, nodes


def _sweep_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes of a shard's containers, and a summary row (null conv_id) for each head."""
    out: list[tuple] = []
    for head, group in rows.sort_values(["c", "d"]).groupby("head", sort=False):
        suffixes = [(g["tid"].tolist(), int(c), int(g["m"].iloc[0]), g["words"].tolist()) for c, g in group.groupby("c", sort=False)]
        above, top = int(group["head_c"].iloc[0]), int(group["top"].iloc[0])
        root, nodes = sweep(suffixes, top)
        out += [(None, x.c, x.depth, above if x.up is root else x.up.c, x.n, x.children, x.leaves, x.saved, x.end) for x in nodes]
        out.append((head, None, top, None, None, root.children, root.leaves, root.saved, None))
    names = [c.split()[0] for c in _SWEPT.split(", ")]
    return pd.DataFrame(out, columns=names).astype({c: "Int64" for c in names[1:]})


def _chains(rows: DataFrame, bucket: int = 1024) -> DataFrame:
    """Nodes and head summaries of lone suffixes, row by row; sums to the end by buckets of rows."""
    rows = rows.withColumn("b", F.floor(F.col("d") / bucket))
    whole = rows.groupBy("c", "b").agg(F.sum("words").alias("s"))
    later = whole.select("c", "b", F.coalesce(F.sum("s").over(Window.partitionBy("c").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("after"))
    inside = F.sum("words").over(Window.partitionBy("c", "b").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0))
    summed = rows.withColumn("inside", inside).join(later, ["c", "b"]).withColumn("saved", (F.col("m") - 1) * (F.col("inside") + F.col("after")))
    last, first = F.col("d") == F.col("len"), F.col("d") == F.col("top") + 1
    one = F.lit(1).cast("long")
    nodes = summed.select(
        F.lit(None).cast("binary").alias("head"), F.col("c").alias("conv_id"), F.col("d").cast("long").alias("depth"), F.when(first, F.col("head_c")).otherwise(F.col("c")).alias("parent"),
        F.col("m").alias("n"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"), "saved", F.when(last, F.col("c")).alias("end"),
    )
    none = F.lit(None).cast("long")
    tops = summed.where(first).select("head", none.alias("conv_id"), F.col("top").cast("long").alias("depth"), none.alias("parent"), none.alias("n"), one.alias("n_children"), one.alias("n_leaves"), "saved", none.alias("end"))
    return nodes.unionByName(tops)


def contain(rows: DataFrame, resting: DataFrame) -> DataFrame:
    """The nodes (and head summaries) below the heads of all containers left."""
    inside = rows.join(resting, "c").where("d > top")
    small = inside.where("not lone").withColumn("shard", F.pmod(F.xxhash64("head"), F.lit(spread(rows.sparkSession))))
    swept = small.select("shard", "head", "head_c", "top", "c", "m", "d", "tid", "words").groupBy("shard").applyInPandas(_sweep_shard, _SWEPT)
    return materialize(swept.unionByName(_chains(inside.where("lone"))), "trie-swept")


def rise(rounds: list[DataFrame], swept: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The rounds' nodes with their subtree sums, and the sums below the root (head, n_children, n_leaves, saved)."""
    done = []
    below = swept.where("conv_id is null").select("head", "n_children", "n_leaves", "saved")
    rest = below
    for nodes in reversed(rounds):
        inner = nodes.groupBy("parent").agg(F.count("*").alias("inner")).withColumnRenamed("parent", "key")
        known = below.toDF("key", "b_children", "b_leaves", "b_saved")
        own = nodes.join(inner, "key", "left").join(known, "key", "left")
        own = own.withColumn("n_children", F.coalesce("inner", F.lit(0)) + F.coalesce("b_children", F.lit(0)))
        own = own.withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(F.coalesce("b_leaves", F.lit(0))))
        own = own.withColumn("save", (F.col("n") - 1) * F.col("words") + F.coalesce("b_saved", F.lit(0)))
        own = materialize(own.select("key", "parent", "head", "anc", "c", "end", "depth", "n", "n_children", "leaf", "save"), "trie-risen")
        sums = own.select(F.explode("anc").alias("key"), "leaf", "save").groupBy("key").agg(F.sum("leaf").alias("n_leaves"), F.sum("save").alias("saved"))
        done.append(own.join(sums, "key").select("key", "parent", "c", "end", "depth", "n", "n_children", "n_leaves", "saved"))
        up = own.groupBy("head").agg(F.count(F.when(F.col("head") == F.col("parent"), 1)).alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("save").alias("saved"))
        below = materialize(up.unionByName(rest), "trie-below")
    return done[::-1], below.where(F.col("head") == F.lit(b""))


def build(conversations: DataFrame, family: int = 20, heads: int = 4, cap: int = 256, stride: int = 32) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, ids = rebuild(materialize(turns(conversations), "trie-numbered"), family, heads)
    rows, ids = materialize(rows, "trie-rebuilt"), materialize(ids, "trie-ids")
    seqs, members = sequences(rows, ids)
    kept = materialize(rows.join(seqs.select("c"), "c"), "trie-rows")
    clear_scratch(conversations.sparkSession, rows)
    rounds, resting = burst_all(kept, seqs, cap, stride)
    swept = contain(kept, resting)
    tops, top = rise(rounds, swept)

    total = ids.agg(F.count("*").alias("n"), F.min("c").alias("c")).where("n > 0")
    turnless = seqs.where("len = 0").agg(F.min("c").alias("end"))
    root = total.join(turnless, F.lit(True), "left").withColumn("head", F.lit(b"")).join(top, "head", "left")
    columns = ["conv_id", "depth", "parent", "n", "n_children", "n_leaves", "saved", "end"]
    zero = F.lit(0).cast("long")
    nodes = root.select(
        F.col("c").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent"), "n",
        F.coalesce("n_children", zero).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved", zero).alias("saved"), "end",
    )
    owners = [t.select("key", "c") for t in tops]
    roots = total.select(F.lit(b"").alias("parent"), F.col("c").alias("up"))
    for i, part in enumerate(tops):
        above = owners[i].unionByName(owners[i - 1]) if i else owners[i]
        above = above.toDF("parent", "up")
        nodes = nodes.unionByName(part.join(above if i else above.unionByName(roots), "parent").select(F.col("c").alias("conv_id"), "depth", F.col("up").alias("parent"), *columns[3:]))
    nodes = nodes.unionByName(swept.where("conv_id is not null").select(*columns))
    lists = materialize(list_digests(members), "trie-ends")
    ended = nodes.join(lists, F.col("end") == F.col("rep"), "left")
    own = F.sha2(F.coalesce(F.col("end").cast("string"), F.lit("")).cast("binary"), 256)
    return ended.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", own).alias("ends_sha256"),
    )

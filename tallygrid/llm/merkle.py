"""Merkle manifest of a table by cogrouped subtree exchange.

A row's leaf is the SHA-256 of its fields.  The leaves of a group (a source), in order, make a
tree of `arity` children a node; the subroots of all groups, in order, make another on top.

1. Leaves are hashed in the JVM and kept as 32 bytes; texts are read once and never shuffled.
2. Places within a group come from ranges and offsets (`common.ranked`), so that a group with a
   third of all rows is spread like any other.
3. Superblocks of arity ** levels consecutive nodes are reduced to a node each, round by round;
   every round leaves one node of a superblock, so there are log(rows) / log(superblock) rounds.
4. Downwards, each superblock's nodes are cogrouped with the required outer nodes: one row with
   the siblings on the way from the superblock's top to the root.  The task reduces its own nodes
   once more, joins the inner and outer siblings to a proof for each node, and folds each leaf
   with its proof back to a root.

Groups go by their text, null first, then bytewise; within a group rows go by the order column,
null first, ties by leaf, so repeated rows stand side by side and get places, proofs and result
rows of their own.  Null and empty values differ (`-` and `0:`).  Long texts are hashed whole.  An
empty table gives no rows.  Only the named columns are read: others, whatever their names, don't
matter.  Nothing is collected but the size of the largest group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import clear_scratch, materialize
from .common import ranked

#: A step of a proof: the node's place in its run, the number of siblings, then their digests; steps go upwards.
_DIGEST = 32


def leaf(*fields: Column) -> Column:
    """SHA-256 (32 bytes) of fields, each `-` if null, else byte count, `:`, value as text."""
    texts = [f.cast("string") for f in fields]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*framed).cast("binary"), 256))


def node(children: list[bytes]) -> bytes:
    """The parent of consecutive nodes: the hash of their digests as hex text."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def grow(nodes: list[bytes], arity: int, levels: int | None) -> list[list[bytes]]:
    """The nodes level by level; so many levels up, or until one node is left."""
    rows = [nodes]
    while len(rows) <= levels if levels is not None else len(rows[-1]) > 1:
        last = rows[-1]
        rows.append([node(last[i : i + arity]) for i in range(0, len(last), arity)])
    return rows


def inner_path(rows: list[list[bytes]], place: int, arity: int) -> bytes:
    """The steps from a node of the first level to the last level."""
    steps = []
    for row in rows[:-1]:
        start = place - place % arity
        run = row[start : start + arity]
        del run[place - start]
        steps.append(bytes((place - start, len(run))) + b"".join(run))
        place //= arity
    return b"".join(steps)


def siblings(path: bytes) -> list[tuple[int, list[bytes]]]:
    """(place in the run, digests of the others) of each step."""
    steps, i = [], 0
    while i < len(path):
        at, count = path[i], path[i + 1]
        steps.append((at, [path[k : k + _DIGEST] for k in range(i + 2, i + 2 + count * _DIGEST, _DIGEST)]))
        i += 2 + count * _DIGEST
    return steps


def fold(digest: bytes, path: bytes) -> bytes:
    """The root that a digest and its proof lead to."""
    for at, others in siblings(path):
        digest = node([*others[:at], digest, *others[at:]])
    return digest


def _blocks(nodes: DataFrame, block: int):
    return nodes.withColumn("block", F.floor(F.col("pos") / block)).groupBy("g", "block")


def _reducer(arity: int, levels: int) -> Callable:
    block = arity**levels

    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        size = int(group["size"].iloc[0])
        top = grow(group["h"].tolist(), arity, levels if size > block else None)[-1][0]
        return pd.DataFrame({"g": [group["g"].iloc[0]], "pos": [int(group["pos"].iloc[0]) // block], "size": [-(-size // block)], "h": [top]})

    return reduce


def _forest(leaves: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """Tables of (g, pos, size, h): the leaves, then the tops of superblocks, until each group has one node."""
    rounds, block = [leaves], arity**levels
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while largest:
        tops = _blocks(rounds[-1], block).applyInPandas(_reducer(arity, levels), "g string, pos long, size long, h binary")
        rounds.append(materialize(tops, "merkle-tops"))
        largest = -(-largest // block) if largest > block else 0
    return rounds


_OUTER = "g string, pos long, path binary, subroot binary, root binary"


def _exchange(arity: int, levels: int, out: Callable) -> Callable:
    """Cogrouped: a superblock's nodes and the row of its outer nodes."""
    block = arity**levels

    def join(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        far = outer.iloc[0]
        rows = grow(nodes["h"].tolist(), arity, levels if int(nodes["size"].iloc[0]) > block else None)
        paths = [inner_path(rows, i, arity) + far["path"] for i in range(len(nodes))]
        return out(nodes, paths, far)

    return join


def _hand_down(nodes: pd.DataFrame, paths: list[bytes], far: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"g": nodes["g"], "pos": nodes["pos"], "path": paths, "subroot": far["subroot"] or nodes["h"], "root": far["root"]})


def _descend(rounds: list[DataFrame], outer: DataFrame, arity: int, levels: int, last: Callable, schema: str) -> DataFrame:
    """From each group's top (outer: a row a group, pos 0) down to the leaves."""
    for i in range(len(rounds) - 2, -1, -1):
        nodes = _blocks(rounds[i], arity**levels)
        far = outer.withColumnRenamed("pos", "block").groupBy("g", "block")
        out, into = (last, schema) if i == 0 else (_hand_down, _OUTER)
        done = nodes.cogroup(far).applyInPandas(_exchange(arity, levels, out), into)
        outer = done if i == 0 else materialize(done, "merkle-outer")
    return outer


def _prove(nodes: pd.DataFrame, paths: list[bytes], far: pd.Series) -> pd.DataFrame:
    claims = [c if c is not None else h for c, h in zip(nodes["claim"], nodes["h"], strict=True)]
    return pd.DataFrame(
        {"g": nodes["g"], "o": nodes["o"], "leaf": nodes["h"], "subroot": far["subroot"], "root": far["root"], "path": paths, "folded_root": list(map(fold, claims, paths))}
    )


_PROVED = "g string, o string, leaf binary, subroot binary, root binary, path binary, folded_root binary"


def manifest(
    rows: DataFrame, group: str, order: str, columns: list[str], claims: dict[str, Column] | None = None, arity: int = 3, levels: int = 6
) -> DataFrame:
    """Per row: group and order column, leaf, subroot, root, path (its proof) and folded_root, all as bytes.

    `claims` replaces columns of the rows that are put to the test: folded_root is what the claimed
    row's leaf and the manifest's siblings lead to, equal to root if nothing was changed.
    `arity` is 2 to 128; a superblock holds arity ** levels nodes.
    """
    claims = claims or {}
    own, claimed = (leaf(*(each.get(c, F.col(c)) for c in columns)) for each in ({}, claims))
    kinds = dict(rows.dtypes)
    hashed = rows.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"), F.col(order).alias("o"), own.alias("h"), claimed.alias("claim"))
    hashed = materialize(hashed.withColumn("claim", F.when(F.col("claim") != F.col("h"), F.col("claim"))), "merkle-leaves")
    leaves = ranked(hashed, "g", ["o", "h"], "merkle-placed").withColumn("o", F.col("o").cast("string"))
    low = _forest(leaves, arity, levels)
    subroots = low[-1].select(F.lit("").alias("t"), "g", "h") if len(low) > 1 else leaves.select(F.lit("").alias("t"), "g", "h")
    high = ranked(subroots, "t", ["g"], "merkle-subroots").select(F.col("t").alias("g"), "pos", "size", "h", F.col("g").alias("member"))
    top = _forest(high, arity, levels)
    crown = top[-1].select("g", F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("h").alias("root"))

    def to_group(nodes: pd.DataFrame, paths: list[bytes], far: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"g": nodes["member"], "pos": 0, "path": paths, "subroot": nodes["h"], "root": far["root"]})

    outer = materialize(_descend(top, crown, arity, levels, to_group, _OUTER), "merkle-outer") if len(top) > 1 else None
    if outer is None:  # no rows
        done = leaves.select("g", "o", *[F.col("h").alias(c) for c in ("leaf", "subroot", "root", "path", "folded_root")])
    else:
        done = _descend(low, outer, arity, levels, _prove, _PROVED)
    clear_scratch(rows.sparkSession, hashed)
    source = F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).cast(kinds[group]).alias(group)
    return done.select(source, F.col("o").cast(kinds[order]).alias(order), "leaf", "subroot", "root", "path", "folded_root")


@F.pandas_udf(T.BinaryType())
def proof_digest(paths: pd.Series) -> pd.Series:
    """SHA-256 of a proof's siblings, level by level, as hex text."""
    return paths.map(lambda path: node([d for _, others in siblings(path) for d in others]))

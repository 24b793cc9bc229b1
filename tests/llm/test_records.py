"""Merkle manifest, WARC archives and conversation trie against plain versions."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import defaultdict

import frames
import pytest
from pyspark.sql import functions as F

from tallygrid.llm import merkle, prefix_trie, queries, warc

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = [*(row[c] for c in FIELDS[:-1]), text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(nodes, arity):
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([sha(*rows[-1][i : i + arity]) for i in range(0, len(rows[-1]), arity)])
    return rows


def plain_path(rows, place, arity):
    path = []
    for row in rows[:-1]:
        start = place - place % arity
        path.append((row[start:place], row[place + 1 : start + arity]))
        place //= arity
    return path


def plain_manifest(rows, arity):
    """(doc_id, leaf, subroot, root, proof, folded) of every row; newlines go from texts of even ids."""
    groups = defaultdict(list)
    for row in rows:
        text = row["text"]
        other = text.replace("\n", "") if text is not None and row["doc_id"] is not None and row["doc_id"] % 2 == 0 else text
        groups[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row, text), plain_leaf(row, other), row["doc_id"]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_levels([x[2] for x in sorted(groups[s])], arity) for s in order}
    top = plain_levels([trees[s][-1][0] for s in order], arity)
    out = []
    for k, s in enumerate(order):
        for i, (_, _, leaf, claim, doc) in enumerate(sorted(groups[s])):
            path = plain_path(trees[s], i, arity) + plain_path(top, k, arity)
            for left, right in path:
                claim = sha(*left, claim, *right)
            out.append((doc, leaf, trees[s][-1][0], top[-1][0], sha(*(h for left, right in path for h in left + right)), claim))
    return sorted(out, key=str)


def proved(docs, arity, levels):
    tampered = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle.manifest(docs, "source", "doc_id", FIELDS, {"text": tampered}, arity, levels)
    out = out.withColumn("proof", merkle.proof_digest("path"))
    names = ["leaf", "subroot", "root", "proof", "folded_root"]
    return sorted((tuple([r["doc_id"], *(bytes(r[c]).hex() for c in names)]) for r in out.collect()), key=str)


@pytest.mark.parametrize("arity,levels", [(3, 6), (3, 1), (2, 2), (5, 1)])
def test_manifest_matches_a_plain_tree(spark, arity, levels):
    rng = random.Random(arity)
    rows = [(i, rng.choice(["a\nb", "", None, "x" * 500 + "\n", "é"]), rng.choice(["en", None, ""]), rng.choice(["hot", "hot", "", None, "é", f"s{i % 7}"]), i) for i in range(170)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert proved(docs, arity, levels) == plain_manifest([r.asDict() for r in docs.collect()], arity)


def test_manifest_of_odd_rows(spark):
    docs = frames.odd(spark).withColumns({c: F.lit("own") for c in ("g", "o", "h", "pos", "size", "leaf", "root", "path", "block")})
    assert proved(docs, 3, 2) == plain_manifest([r.asDict() for r in docs.collect()], 3)
    one = docs.where("doc_id = 3")
    (row,) = proved(one, 3, 6)
    assert row[1] == row[2] == row[3] == row[5] and row[4] == sha("")
    assert proved(frames.odd(spark, empty=True), 3, 6) == []


BIG = "é" * 3000 + "WARC/1.1\r\nhello WARC/1.1"
PAGES = [
    (1, "u", None), (2, "u", "x" * 3), (3, "a\r\nb%0D", BIG), (4, None, BIG), (4, None, BIG), (None, "n", "\r\n\r\n" * 50), (9, "n", "\r\n\r\n" * 50),
    (10, "s", "x" * 3), (11, "v", "WARC/1.1\r\n" * 40), (12, "w", "WARC/1.1"), (13, "w", ""), (14, "é", frames.LONG * 20),
]


def plain_records(rows, least=100):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= least:
            first[data] = min(page, first.get(data, page))
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        again = data in first and (page is None or page > first[data])
        out.append((page, url, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None, True))
    return sorted(out, key=str)


def written_back(spark, pages, path, size):
    warc.write(pages, path, chunk_bytes=size)
    kinds = {"page": F.col("page").cast("long"), "refers_to": F.col("refers_to").cast("long")}
    return warc.read(spark, path).withColumns(kinds).select("page", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@pytest.mark.parametrize("size", [8, 9, 1000, 1 << 20])
def test_archives_come_back_whole(spark, tmp_path, size):
    rows = [r for r in PAGES if size > 100 or len(r[2] or "") < 1000]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("own") for c in ("id", "payload", "sha256", "head", "value")}).repartition(3)
    got = written_back(spark, pages, str(tmp_path / "w"), size)
    assert sorted(map(tuple, got.collect()), key=str) == plain_records(rows)


def test_small_splits_and_empty_tables(spark, tmp_path):
    rows = [(i, f"u{i}", f"page {i} " * (i % 50)) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(map(tuple, written_back(spark, pages, str(tmp_path / "w"), 64).collect()), key=str) == plain_records(rows)
    assert written_back(spark, pages.where("false"), str(tmp_path / "e"), 64).count() == 0


def test_records_are_wellformed_and_damage_shows():
    payload = memoryview(BIG.encode())
    digest = hashlib.sha256(payload).hexdigest()
    records = list(warc.chunk_records("3", "http://x/\r\n", payload, digest, None, 1000, "2000-01-01T00:00:00Z"))
    bodies = []
    for i, record in enumerate(records):
        assert record.startswith(warc.VERSION) and warc.VERSION not in record[10:] + b"\r\n\r\n"
        head, block = record.split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert int(fields["Content-Length"]) == len(block) and int(fields["WARC-Segment-Number"]) == i + 1
        assert fields["WARC-Type"] == ("continuation" if i else "response")
        bodies.append(block if i else block.split(b"\r\n\r\n", 1)[1])
    assert b"".join(bodies) == bytes(payload)

    def back(parts):
        rows = [warc.parse(memoryview(p[10:])) for p in parts]
        (batch,) = warc._stream(iter([warc.pa.RecordBatch.from_pylist(rows, warc._CHUNKS)]))
        return batch.to_pylist()

    (whole,) = back(records)
    assert whole["intact"] and whole["payload_bytes"] == len(payload) and whole["payload_digest"] == digest
    (hurt,) = back([*records[:2], records[2].replace(b"\xa9", b"\xa8", 1), *records[3:]])
    (gap,) = back([*records[:2], *records[3:]])
    assert not hurt["intact"] and not gap["intact"]
    assert not warc.parse(memoryview(records[0][10:-4]))["sound"]


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
    members, kids, sums = defaultdict(list), defaultdict(list), {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        sums[k] = (sum(sums[x][0] for x in kids[k]) or 1, (len(members[k]) - 1) * words + sum(sums[x][1] for x in kids[k]))
    out = []
    for k, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(k))
        out.append((min(who), len(k), min(members[k[:-1]]) if k else None, len(who), len(kids[k]), *sums[k], sha(ends)))
    return sorted(out, key=str)


def talks(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(-30, 70):
        if c % 20 == 0 and rng.random() < 0.4:
            continue
        for t in range(rng.choice([1, 1, 2, 3, 5, 9, 30])):
            text = rng.choice(["x", "y z", "x", None, ""]) if rng.random() < 0.4 else "x"
            rows.append((c, rng.choice([None, t, t, t]), rng.choice(["u", "a", None]) if rng.random() < 0.1 else "u", text))
    return [*rows, (None, 1, "u", "x"), (5, 1, "u", "x"), (5, 1, "u", "x"), (6, 2, "u", frames.LONG)]


@pytest.mark.parametrize("seed,cap,stride", [(0, 7, 4), (1, 60, 32), (2, 10**6, 32)])
def test_trie_matches_brute_force(spark, seed, cap, stride):
    rows = talks(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    df = df.withColumns({c: F.lit("own") for c in ("tid", "words", "pos", "size", "c", "d", "head", "m", "key")})
    got = prefix_trie.build(df, cap=cap, stride=stride)
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(rows)


def test_one_long_conversation_and_none(spark):
    rows = [(c, t, "u", f"{t} w") for c in (1, 2, 3) for t in range(1500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, prefix_trie.build(df).collect()), key=str) == plain_trie(rows)
    assert prefix_trie.build(df.where("false")).count() == 0


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_warc", "op13_conversation_prefix_trie"])
def test_queries_match_sql(spark, name):
    import oracle

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    assert oracle.difference(queries.QUERIES[name](spark, folder), oracle.connect(folder), queries.ORACLE[name]) is None

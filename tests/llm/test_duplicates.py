"""N-gram Jaccard join, components and benchmark decontamination."""

import random

import frames
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tallygrid.llm import decontaminate, graph, ngram_join


def plain_sets(texts, width):
    out = []
    for t in texts:
        words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))]
        out.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    return out


def plain_components(texts, width, percent):
    sets = plain_sets(texts, width)
    top = list(range(len(texts)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def corpus(seed, families=12, copies=14):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts = []
    for f in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 9, 12, 20, 40, 90, 200]))]
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words) + (f" {passage}" if rng.random() < 0.3 else ""))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("width,percent,hot,page", [(4, 85, 16, 256), (5, 80, 2, 4), (4, 85, 1, 3)])
def test_join_matches_brute_force(spark, width, percent, hot, page):
    texts = corpus(percent + hot) + frames.ODD
    docs = frames.documents(spark, texts).repartition(6)
    got = ngram_join.join(docs, width, percent, hot, page).orderBy("doc_id").collect()
    assert [(r["n_shingles"], r["component_id"]) for r in got] == plain_components(texts, width, percent)


def test_a_common_digest_ties_no_families(spark):
    """Families of copies that hold one very common digest, such as that of an empty group, keep cells of their own."""
    scheme, families, copies = 8, 5, 20
    needed = ngram_join.schemes(85)[scheme][3]
    rows = []
    for k in range(families * copies):
        own = [((k // copies * 100 + i + 1) << 8) | scheme for i in range(needed)]
        rows.append((k, k, 30, k, k, [*own, (10**6 << 8) | scheme]))
    sketched = spark.createDataFrame(rows, "doc_id long, tkey long, n long, k1 long, k2 long, sigs array<long>")
    found = {r["k1"]: r["cell"] for r in ngram_join.cells(sketched, 85, 16).collect()}
    assert [found[k] for k in range(families * copies)] == [k // copies * copies for k in range(families * copies)]


def test_equal_sets_make_no_digest_hot(spark):
    """Digests are counted by sets: four rows of each of two texts are two sets."""
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*base, f"x{i % 2}"])) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    sketched = ngram_join.sketch(docs, 4, 85)
    batch = sketched.selectExpr("k1", "explode(sigs) as sig").toArrow().combine_chunks().to_batches()
    held = [n for b in ngram_join._shared(iter(batch)) for n in b.column("held").to_pylist()]
    assert held and set(held) == {2}


@pytest.mark.parametrize("width", [1, 2, 4, 5])
def test_shingles_of_many_texts_at_once(width):
    rng = random.Random(width)
    texts = [None, "", " \n", "a", "A\x0bb", "É é", "x" * 64, "X" * 64 + " " + "x" * 65, "y" * 65, "Y" * 65, *frames.ODD]
    texts += ["".join(rng.choice("abAB \n\t\x00É") for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["z" * 1_100_000 + " a b c d e", "a b c " * 250_000, "k " * 5 + "q" * 2_500_000, "last one"]
    for laid in (ngram_join._laid_out(texts), ngram_join._in_place(pa.array(["before", *texts], pa.string())[1:])):
        got = []
        for hashes, borders in ngram_join.shingle_sets(*laid, width):
            got += np.split(hashes, borders[1:-1])
        wanted = plain_sets(texts, width)
        assert [len(g) for g in got] == [len(w) for w in wanted] and all((g[1:] > g[:-1]).all() for g in got)
        names = {}
        for g, w in zip(got, wanted):
            one = names.setdefault(tuple(g.tolist()), w)
            assert one == w
        assert len(names) == len({frozenset(w) for w in wanted})
        assert len(np.unique(np.concatenate(got))) == len(set().union(*wanted))


def test_signatures_of_many_sets_are_those_of_each():
    sets = [np.sort(np.random.default_rng(n).integers(0, 2**64, n, np.uint64)) for n in (0, 1, 5, 13, 14, 60, 0, 900)]
    borders = np.cumsum([0, *map(len, sets)])
    found, at = ngram_join.signatures_of(np.concatenate(sets), borders, 85)
    assert [found[a:b].tolist() for a, b in zip(at, at[1:])] == [ngram_join.signatures(s, 85).tolist() for s in sets]


def test_one_doc_id_on_two_texts(spark):
    one, two = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    rows = [(5, one), (1, one + " end"), (5, two), (2, two + " end"), (2, two + " end")]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 4, 85).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (2, 2), (2, 2), (5, 1), (5, 2)]
    columns = ["rep", "tkey", "k1", "cell", "i", "j", "page", "text"]
    group = pd.DataFrame([(d, i, 10 + i, i // 2, -1, -1, 0, t) for i, (d, t) in enumerate(rows[:4])], columns=columns)
    assert sorted(map(sorted, ngram_join._verifier(4, 85)(group).to_numpy().tolist())) == [[10, 11], [12, 13]]


def test_linked_sets_share_enough_digests():
    rng = np.random.default_rng(5)
    table = ngram_join.schemes(85)
    for _ in range(300):
        n = int(rng.integers(7, 400))
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        other = base.copy()
        for _ in range(int(rng.integers(0, 1 + n // 6))):
            other[rng.integers(len(other))] = rng.integers(0, 2**63)
        other = np.unique(other[: len(other) - int(rng.integers(0, 1 + n // 8))])
        both = len(np.intersect1d(base, other))
        if 100 * both < 85 * (len(base) + len(other) - both) or np.array_equal(base, other):
            continue
        shared = set(ngram_join.signatures(base, 85).tolist()) & set(ngram_join.signatures(other, 85).tolist())
        by_scheme = {}
        for s in shared:
            by_scheme[s & 255] = by_scheme.get(s & 255, 0) + 1
        assert any(n >= table[s][3] for s, n in by_scheme.items())


def test_tree_finds_every_close_point():
    rng = np.random.default_rng(2)
    points = rng.poisson(3, (300, 16)).astype(np.int32)
    points = np.concatenate([points, points[:60]])
    tree = ngram_join.CountTree(points)
    for q in points[::17]:
        bound = np.minimum(points, q).sum(1)
        close = (185 * bound >= 85 * (points.sum(1) + q.sum())) & (100 * np.minimum(points.sum(1), q.sum()) >= 85 * np.maximum(points.sum(1), q.sum()))
        assert set(np.flatnonzero(close)) <= set(tree.search(q, 85).tolist())


def test_keep_one_on_odd_rows(spark):
    docs = frames.odd(spark)
    out = ngram_join.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == [*[(False, i) for i in (0, 1, 2, 3, 4, 6, 7, 8)], (True, 0)]
    assert ngram_join.keep_one(frames.odd(spark, empty=True)).count() == 0


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def plain_contained(texts, items):
    """Five-word shingles; an item of fewer words is its whole sequence, sought among windows of its length."""

    def windows(words, n):
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    words_of = [[__import__("re").findall(r"[^\W_]+", (t or "").lower()) for t in group] for group in (texts, items)]
    found = set()
    for i, item in enumerate(words_of[1]):
        width = min(5, len(item))
        want = windows(item, width) if width else set()
        for d, text in enumerate(words_of[0]):
            both = len(want & windows(text, width)) if want else 0
            if want and 100 * both >= 80 * len(want):
                found.add((d, i, len(want), both))
    return found


def test_containment_matches_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 6, 12, 33, 60, 130]))) for _ in range(60)] + [None, "", "one two"]
    items.append(items[4])
    texts = []
    for _ in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 10, 300, 3000]))]
        for t in rng.sample(items[:60], 2):
            piece = t.split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                piece[rng.randrange(len(piece))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = [p.upper() + "," for p in piece]
        texts.append(" ".join(words))
    texts += frames.ODD
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = frames.documents(spark, texts).repartition(5)
    got = {tuple(r)[:4] for r in decontaminate.find(docs, bench).collect()}
    assert got == plain_contained(texts, items)
    kept = {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {d for d, *_ in got}


def test_decontamination_on_odd_rows(spark):
    docs = frames.odd(spark)
    bench = spark.createDataFrame([(1, frames.PROSE), (2, None), (None, frames.PROSE)], "item_id long, text string")
    assert decontaminate.find(docs, bench).count() == 10
    out = decontaminate.clean(docs, bench)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [0, 1, 2, 3, 6, 7, 8]
    assert decontaminate.find(frames.odd(spark, empty=True), bench).count() == 0 and decontaminate.clean(docs, bench.where("false")).count() == 12


def test_short_items_are_found_by_their_whole_sequence(spark):
    items = [(1, "Forty-Two"), (2, "blue"), (3, "red green blue sky"), (4, "..."), (5, None), (6, "red green blue sky over")]
    texts = ["the blue sky", "RED, green: blue sky", "forty two", "two forty", frames.LONG + " blue", "", None, "a red green blue sky over us", "bluesky"]
    want = set()
    for d, text in enumerate(texts):
        have = __import__("re").findall(r"[^\W_]+", (text or "").lower())
        for i, item in items:
            ws = __import__("re").findall(r"[^\W_]+", (item or "").lower())
            if ws and any(have[k : k + len(ws)] == ws for k in range(len(have))):
                want.add((d, i))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frames.documents(spark, texts)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, bench).collect()} == want
    assert {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_short_items_in_sql(spark, tmp_path):
    import duckdb
    import oracle

    from tallygrid.llm import queries

    items = spark.createDataFrame([(1, "two forty"), (2, "blue"), (3, "one two three four five six")], "item_id long, text string")
    docs = frames.documents(spark, ["two forty blue", "one two three four five six seven", None, "Blue"], extra=False)
    for name, df in (("documents", docs), ("benchmark", items)):
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert oracle.difference(queries.op3_benchmark_decontamination(spark, str(tmp_path)), con, queries.ORACLE["op3_benchmark_decontamination"]) is None

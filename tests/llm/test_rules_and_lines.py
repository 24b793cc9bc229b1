"""Quality rules and line dedup."""

import hashlib
from collections import Counter
from math import comb

import frames
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrid.llm import line_dedup, quality_rules


def plain_counts(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            inside |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


TEXTS = [*frames.ODD, "a b " * 30, "x " * 9, "x " * 7, " ".join(map(str, range(50))) + " " + " ".join(map(str, range(40, 60))), "l\nl \nl\n\n\nm\x0bm\x1cm\xa0m"]


@pytest.mark.parametrize("text", TEXTS)
def test_counts_match_brute_force(text):
    assert quality_rules.count_text(text)[:5] == plain_counts(text)


def test_binomial_tail_is_exact():
    for n, k, p in ((10, 0, 0.2), (30, 4, 0.1), (60, 60, 0.5), (25, 3, 0.9)):
        assert quality_rules.binomial_tail(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
    assert quality_rules.binomial_tail(0, 0, 0.1) == 1.0


def test_cutoffs_reject_bad_and_certify_good(spark):
    good = [f"{frames.PROSE} number {i}" for i in range(1500)]
    bad = [" ".join(f"{w}{i}###" for w in frames.PROSE.split()) for i in range(300)]
    docs = frames.documents(spark, good + bad, extra=False).repartition(4)
    labels = frames.labels(spark, [(i, int(i < 1500), 0) for i in range(1800)])
    kept = {r["doc_id"] for r in quality_rules.keep(docs, labels).collect()}
    assert kept == set(range(1500))
    few = frames.labels(spark, [(i, int(i < 1500), 0) for i in range(0, 1800, 90)])
    assert quality_rules.keep(docs, few).count() == 1800  # too few labels certify nothing


def test_rules_on_odd_rows(spark):
    docs = frames.odd(spark)
    out = quality_rules.keep(docs, frames.labels(spark, [(4, 1, 0), (4, 0, 0), (None, 1, 0), (7, None, 0)]))
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == [(False, 4), (False, 5), (False, 5), (False, 6), (False, 9), (True, 0)]
    judged = quality_rules.assess(docs, frames.labels(spark, []))
    assert judged.count() == 12 and judged.where("base_failed and kept").count() == 0
    assert quality_rules.keep(frames.odd(spark, empty=True), frames.labels(spark, [])).count() == 0


def plain_dedup(texts, least):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\v\f\r"))

    found = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        stay = [x for x in lines if found[key(x)] < least]
        out.append((len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("keys_per_shard", [1, 200_000])
def test_line_dedup_matches_brute_force(spark, keys_per_shard):
    rng = np.random.default_rng(3)
    texts = ["\n".join(f"  Line {rng.zipf(1.3) % 50}\t" if rng.random() < 0.7 else f"own {i} {j}" for j in range(rng.integers(0, 9))) for i in range(300)] + frames.ODD + frames.ODD[4:6] * 6
    docs = frames.documents(spark, texts).repartition(5)
    done = line_dedup.dedup_lines(docs, 10, keys_per_shard)
    got = done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == plain_dedup(texts, 10)


def test_line_dedup_on_odd_rows(spark):
    docs = frames.odd(spark)
    out = line_dedup.clean(docs, 2)
    assert out.columns == docs.columns and out.count() == 12
    assert out.where("doc_id = 0").first()["text"] is None and out.where("doc_id = 5").first()["text"] == ""
    assert line_dedup.clean(frames.odd(spark, empty=True)).count() == 0


def test_perfect_hash_is_minimal_and_refuses_strangers():
    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(-(2**63), 2**63 - 1, (2, 5000))
    counts = rng.integers(2, 100_000, 5000)
    shard = line_dedup.build_shard(h1, h2, counts)
    assert len(shard[2]) == 8 * 5000
    assert (line_dedup.probe_shard(shard, h1, h2) == counts).all()
    assert not line_dedup.probe_shard(shard, h1, h2 + 1).any()
    assert not line_dedup.probe_shard(line_dedup.build_shard(h1[:0], h2[:0], counts[:0]), h1, h2).any()


def test_counts_above_sixteen_bits_are_kept():
    import numpy as np

    from tallygrid.llm import line_dedup

    h1, h2, counts = np.arange(1, 6), np.arange(11, 16), np.array([2, 65_535, 65_536, 70_000, 10**9])
    shard = line_dedup.build_shard(h1, h2, counts)
    assert line_dedup.probe_shard(shard, h1, h2).tolist() == counts.tolist()

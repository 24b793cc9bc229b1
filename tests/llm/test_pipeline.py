"""The pipeline against a brute-force version, and the registry."""

import os
import random

import frames
import pytest
from test_duplicates import plain_components, plain_contained
from test_rules_and_lines import plain_counts

from tallygrid.llm.queries import MODEL, ORACLE, QUERIES

pytestmark = pytest.mark.skipif(not os.path.exists(MODEL), reason="no model file")


def brute_force(rows, items):
    """rows: (doc_id, text); base rules, lines of ten documents, near duplicates, benchmark items, ids."""
    import sentencepiece

    kept = []
    for d, t in rows:
        n, _, _, _, repeated = plain_counts(t)
        if n >= 20 and 100 * repeated <= 30 * n:
            kept.append((d, t))

    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\v\f\r"))

    found = {}
    for d, t in kept:
        for k in {key(x) for x in t.split("\n")}:
            found[k] = found.get(k, 0) + 1
    kept = [(d, "\n".join(x for x in t.split("\n") if not key(x) or found[key(x)] < 10)) for d, t in kept]
    groups = plain_components([t for _, t in kept], 5, 80)
    kept = [r for i, r in enumerate(kept) if groups[i][1] == i]
    bad = {d for d, *_ in plain_contained([t for _, t in kept], items)}
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return {d: model.encode(t) for i, (d, t) in enumerate(kept) if i not in bad}


def test_pipeline_matches_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    words = [f"{a}{b}" for a in "the of and ing tion er on".split() for b in "ra lo mi ne su".split()]

    def line(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [line(30) for _ in range(3)]
    shared = [line(12) for _ in range(3)]
    texts = []
    for i in range(90):
        parts = [line(rng.randint(3, 40)) for _ in range(rng.randint(1, 5))]
        if i % 4 == 0:
            parts.append(shared[i % 3])
        if i % 9 == 0:
            parts.append(items[i % 3])
        texts.append("\n".join(parts))
    texts += [t + " tail" for t in texts[:20]] + ["same words again " * 40, "short"]
    rows = list(enumerate(texts))
    frames.documents(spark, texts, extra=False).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    frames.labels(spark, [(i, 1, 0) for i in range(30)]).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    want = brute_force(rows, items)
    assert got == want and 0 < len(want) < len(texts) - 15


def test_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline

    docs = frames.documents(spark, frames.ODD, extra=False)
    frames.labels(spark, []).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} and set(QUERIES) | {"pipeline"} <= names
    assert set(ORACLE) <= set(entry.oracle_sql())

"""Readers by range, ranges for ranks, sampling by digest and the sweep over k, against plain versions."""

import glob
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrid.functions.text import path_year, path_years
from tallygrid.operators import clustering, kmeans_sweep, order_statistics, profiling
from tallygrid.sources import files, records, tables
from tallygrid.sources.json_ranges import split_records


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def value(rng, depth=0):
    kind = rng.random()
    if kind < 0.3:
        return rng.choice(["a", "b}c{", 'q"uo\\te', "[x", "}]", "\\", '\\"}', "nl\n}", "é}ü"])
    if kind < 0.7:
        return rng.choice([None, True, rng.randint(-5, 500)])
    if depth > 2:
        return 1.5
    if kind < 0.85:
        return {rng.choice("abc"): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]


@pytest.mark.parametrize("shape", ["array", "object"])
def test_documents_are_cut_into_records_by_range(spark, tmp_path, small_splits, shape):
    rng, want = random.Random(shape), []
    for i, n in enumerate([0, 1, 30, 300]):
        records = [{k: value(rng) for k in "abcdef"[: rng.randint(0, 6)]} for _ in range(n)]
        want += [json.dumps(r, sort_keys=True) for r in records]
        if shape == "array":
            document = [x for r in records for x in ([rng.choice([1, "x{y", [1, 2], None])] * (rng.random() < 0.1) + [r])]
        else:
            document = {"meta": rng.choice([1, {"k": {"z": [1, 2]}}, [1, [2]], "{["]), "itens": records[: n // 2], "mais": {"a": 1, "b": [[]]}, "vazia": [], "outros": records[n // 2 :], "fim": "}"}
        (tmp_path / f"{i}.json").write_text(json.dumps(document, indent=[None, 2][i % 2], ensure_ascii=i > 1))
    out = split_records(spark, str(tmp_path), shape)
    assert sorted(json.dumps(json.loads(r.registro), sort_keys=True) for r in out.collect()) == sorted(want)
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 4


def test_a_list_document_reads_like_lines(spark, tmp_path):
    rows = [{"ano": str(i % 7), "votos": i, "dados": {"x": [i]}} for i in range(500)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    out = files.read_json_records(spark, str(tmp_path / "a.json"), shape="array")
    assert out.columns == ["ANO", "DADOS", "VOTOS"]
    assert sorted((r["ANO"], r["VOTOS"]) for r in out.collect()) == sorted((r["ano"], str(r["votos"])) for r in rows)


def test_unreadable_parquet_by_its_footer(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "with space"))
    spark.range(0).coalesce(1).write.parquet(str(tmp_path / "none"))
    spark.range(300_000).coalesce(1).write.option("compression", "none").parquet(str(tmp_path / "big"))
    (big,), (good,) = glob.glob(f"{tmp_path}/big/*.parquet"), glob.glob(f"{tmp_path}/with space/*.parquet")
    (tmp_path / "cut.parquet").write_bytes(open(big, "rb").read()[:-20_000])
    (tmp_path / "length.parquet").write_bytes(open(good, "rb").read()[:-8] + b"\xff\xff\xff\x7fPAR1")
    (tmp_path / "foreign.parquet").write_bytes(b"text that ends like a table PAR1")
    found = {r["arquivo"].rsplit("/", 1)[1]: r["motivo"] for r in files.unreadable_parquet(spark, str(tmp_path), small=100_000).collect()}
    assert found == {"cut.parquet": "rodape_ilegivel", "length.parquet": "rodape_ilegivel", "foreign.parquet": "sem_inicio"}


PATHS = {
    "/a/votacao_1996/JSON/part-00000-1943abcd-1943-4abc-8def-0123456789ab-c000.json": ("1996", ["1996"]),
    "/x/decada1998/f.json": ("1998", ["1998"]), "/x_20180101/a2002.json": ("2002", ["2002"]), "cand2006.json": ("2006", ["2006"]),
    "/h/1943ab0f/y2010/z.json": ("2010", ["2010"]), "/r/2004-2000/1999.json": ("2004", ["1999", "2000", "2004"]), None: ("", []), "": ("", []),
}


def test_years_of_paths_ignore_random_names(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "p string")
    assert [(r[0], list(r[1])) for r in df.select(path_year("p"), path_years("p")).collect()] == list(PATHS.values())


def test_discovered_year_is_below_the_root(spark, tmp_path):
    root = tmp_path / "raiz_1950"
    spark.range(3).coalesce(1).write.json(f"{root}/votacao_1996/JSON")
    assert {r["ano_arquivo"] for r in files.discover_files(spark, str(root)).collect()} == {"1996"}


@pytest.mark.parametrize("rows_per_range", [7, 10**6])
def test_ranks_of_groups_of_any_size(spark, rows_per_range):
    rng = random.Random(4)
    rows = [("hot" if i % 3 else rng.choice("ab"), rng.choice([None, 5.0, 5.0, rng.random()]), f"t{i:03}") for i in range(300)]
    df = spark.createDataFrame(rows, "g string, w double, t string")
    got = {(r.g, r.t): r.rank for r in order_statistics.ranked_spread(df, ["g"], "w", ["t"], "rank", rows_per_range).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want |= {(g, r[2]): i for i, r in enumerate(order, 1)}
    assert got == want


def test_sample_ends_at_the_counted_digest(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    want = {r.k for r in df.orderBy(tables.sample_order(df, ["k"], 42), "k").limit(777).collect()}
    for bucket_rows in (1, 10, 10**6):
        got = tables.reservoir_sample(df, ["k"], high=777, bucket_rows=bucket_rows).collect()
        assert {r.k for r in got} == want and len(got) == 777


def groups(spark, n_groups, rows=400, seed=1):
    rng = random.Random(seed)
    data = [([f"{c}=g{i % n_groups}_{c}" for c in "abcd"] + [f"noise={rng.randint(0, 3)}"],) for i in range(rows)]
    return spark.createDataFrame(data, "tokens array<string>").withColumn("numbers", kmeans_sweep.token_numbers("tokens", 512))


@pytest.mark.parametrize("n_groups", [3, 5, 6])
def test_the_elbow_moves_with_the_data(spark, n_groups):
    _, best, costs = clustering.kmeans_elbow(groups(spark, n_groups), 2, 8, 512)
    assert best == n_groups and [k for k, _ in costs] == list(range(2, 9))
    assert all(b <= a for (_, a), (_, b) in zip(costs, costs[1:]))


def test_sweep_is_lloyd_and_ignores_partitions(spark):
    rows = groups(spark, 4, 300, 7).withColumn("numbers", F.array_append("numbers", F.element_at("numbers", 1)))  # a number held twice
    dense = np.zeros((300, 512))
    for i, r in enumerate(rows.collect()):
        np.add.at(dense[i], r.numbers, 1)
    models, costs = kmeans_sweep.sweep(kmeans_sweep.points(rows.repartition(1)), 2, 4, 512)
    again, same = kmeans_sweep.sweep(kmeans_sweep.points(rows.repartition(7)), 2, 4, 512)
    for k, cost in costs:
        centres = models[k]
        far = ((dense[:, None, :] - centres[None]) ** 2).sum(axis=2)
        near = far.argmin(axis=1)
        assert abs(far.min(axis=1).sum() - cost) < 1e-6 and np.array_equal(centres, again[k])
        for c in set(near):
            assert np.allclose(centres[c], dense[near == c].mean(axis=0))
        assert [r.c for r in rows.select(kmeans_sweep.nearest(centres)("numbers").alias("c")).collect()] == list(near)
    assert [k for k, _ in costs] == [k for k, _ in same]


@pytest.mark.parametrize("keys_per_block", [3, 256])
def test_products_are_summed_by_blocks(spark, keys_per_block):
    from tallygrid.operators import blocks

    rng = random.Random(5)
    left = [(s, f"k{k}", f"r{r}", rng.random()) for s in ("a", "b", None) for k in range(40) for r in range(6) if rng.random() < 0.5]
    right = [(s, f"k{k}", c, rng.choice(["x", "y"]), rng.random()) for s in ("a", "b", None) for k in range(5, 50) for c in range(3)]
    lf, rf = spark.createDataFrame(left, "s string, k string, r string, a double"), spark.createDataFrame(right, "s string, k string, c int, e string, b double")
    want = lf.join(rf, ["s", "k"]).groupBy("s", "r", "c", "e").agg(F.sum(F.col("a") * F.col("b")).alias("v"))
    got = blocks.sum_of_products(lf, rf, ["s"], ["k"], ["r"], ["c", "e"], "a", "b", "v", keys_per_block)
    plain = lambda df: sorted((*r[:4], round(r.v, 9)) for r in df.select("s", "r", "c", "e", "v").collect())
    assert plain(got) == plain(want)
    parts = blocks.partial_products(lf, rf, ["s"], ["k"], ["r"], ["c", "e"], "a", "b", "v", 256).count()
    assert parts <= 2 * 6 * 6 < lf.join(rf, ["s", "k"]).count() / 8  # rows before the sum, against those of a join
    whole = blocks.sum_of_products(lf, rf, [], ["s", "k"], ["r"], ["c", "e"], "a", "b", "v", keys_per_block)
    total = lf.join(rf, ["s", "k"]).groupBy("r", "c", "e").agg(F.sum(F.col("a") * F.col("b")).alias("v"))
    assert sorted((r.r, r.c, r.e, round(r.v, 9)) for r in whole.collect()) == sorted((r.r, r.c, r.e, round(r.v, 9)) for r in total.collect())


def test_delimited_files_of_several_encodings_take_one_job(spark, tmp_path):
    from tallygrid.sources import delimited

    names = ["São Paulo", "Açu “x”", "plain"]
    for i, (sep, encoding) in enumerate([(";", "utf-8"), ("|", "latin-1"), (";", "utf-8-sig"), (",", "cp1252"), (";", "latin-1")]):
        own = [n if encoding != "latin-1" else n.replace("“x”", "x") for n in names]
        text = "\n".join([f"nome{sep}votos", *[f"{n}{sep}{i}" for n in own], "", sep])
        (tmp_path / f"arquivo {i}.csv").write_bytes(text.encode(encoding))
    (tmp_path / "vazio.csv").write_bytes(b"")
    files = sorted(str(p) for p in tmp_path.iterdir())
    tracker, before = spark.sparkContext.statusTracker(), set(spark.sparkContext.statusTracker().getJobIdsForGroup())
    probed = delimited.probe_headers(spark, files)
    assert len(set(tracker.getJobIdsForGroup()) - before) == 1
    assert [v[2] for _, v in sorted(probed.items())] == ["UTF-8", "ISO-8859-1", "UTF-8", "windows-1252", "ISO-8859-1"]
    assert {v[:2] for v in probed.values()} == {(";", ("nome", "votos")), ("|", ("nome", "votos")), (",", ("nome", "votos"))}
    (rows,) = delimited.read_delimited_grouped(spark, files).values()
    got = sorted((r.VOTOS, r.NOME) for r in rows.collect())
    assert len(got) == 15 and {n for v, n in got if v == "3"} == set(names) and {n for v, n in got if v == "1"} == {"São Paulo", "Açu x", "plain"}


def test_name_pairs_match_all_pairs(spark):
    from difflib import SequenceMatcher

    from tallygrid.operators.similarity import matching_ratio, name_pairs

    rng = random.Random(8)
    parts = ["qt", "votos", "nm", "municipio", "cd", "eleitor", "secao", "sg", "uf", "perfil", "x", "aab", "ção"]
    names = sorted({"_".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) + rng.choice(["", "s", "_1"]) for _ in range(70)})
    df = spark.createDataFrame([(rng.choice("pq"), n) for n in names] + [("p", n) for n in names[:20]], "s string, nome string").distinct()
    scopes = {}
    for r in df.collect():
        scopes.setdefault(r.s, []).append(r.nome)
    for ratio in (0.6, 0.85):
        want = {
            (s, a, b): round(SequenceMatcher(None, a, b).ratio(), 9)
            for s, own in scopes.items() for a in own for b in own if a <= b and SequenceMatcher(None, a, b).ratio() >= ratio
        }
        assert {(r.s, r.a, r.b): round(r.similarity, 9) for r in name_pairs(df, "s", "nome", ratio).collect()} == want
    odd = spark.createDataFrame([("", ""), ("", "a"), ("abcabc", "bcabca"), ("aaa", "aaaaa")], "a string, b string")
    got = [r[0] for r in odd.select(matching_ratio(F.col("a"), F.col("b"))).collect()]
    assert np.allclose(got, [SequenceMatcher(None, *r).ratio() for r in [("", ""), ("", "a"), ("abcabc", "bcabca"), ("aaa", "aaaaa")]])


def test_written_years_are_not_joined_by_one_task_each(spark, monkeypatch):
    """A year's documents are written by the tasks that hold its rows."""
    from tallygrid.catalog import load
    from tallygrid.sources import files

    found, seen = files.discover_files, []
    monkeypatch.setattr(files, "discover_files", lambda s, root: seen.append(found(s, root)) or seen[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load()[0]["I3_discover_files"](spark, "/root/testdata/sf0.001")
        assert all(r["count"] > 1 for r in seen[0].groupBy("ano_arquivo").count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def untouched(out, folder):
    """Whether a result no longer reads the source files: their steps were written once."""
    return not any(str(folder) in f for f in out.inputFiles())


def test_column_counts_are_written_once(spark, tmp_path):
    rows = [(" a ", 1.0), ("a", -0.0), ("NaN", 2.5), (None, None), ("", 2.5)]
    spark.createDataFrame(rows, "DS_CARGO string, QT_VOTOS double").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    counts = {(r.coluna, r.valor): r.n for r in profiling.value_counts(table).collect()}
    assert counts == {("DS_CARGO", "a"): 2, ("DS_CARGO", None): 3, ("QT_VOTOS", "1.0"): 1, ("QT_VOTOS", "-0.0"): 1, ("QT_VOTOS", "2.5"): 2, ("QT_VOTOS", None): 1}
    out = profiling.column_profile(table)
    assert untouched(out, tmp_path)
    assert {(r.coluna, r.linhas_amostra, r.nao_nulos, r.unicos) for r in out.collect()} == {("DS_CARGO", 5, 2, 1), ("QT_VOTOS", 5, 4, 3)}


def test_gold_rows_are_written_once(spark, tmp_path):
    spark.createDataFrame([("1999", "A", 3.0), ("1999", "A", 1.0)], "ano string, uf string, votos double").write.parquet(str(tmp_path / "t"))
    out = records.merge_gold_sources([spark.read.parquet(str(tmp_path / "t"))])
    assert untouched(out, tmp_path)
    assert [(r.votos, r.share_votos_grupo) for r in out.collect()] == [(4.0, 1.0)]

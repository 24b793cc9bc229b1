"""Small contests worked out by hand, brute-force comparisons and invariants."""

import itertools
import math
import random

import pandas as pd
from pyspark.sql import functions as F

from tallygrid.operators import clustering, levels, order_statistics as os_, projection, proxy, sections, statistics as st
from tallygrid.sources import delimited, files, tables


def results(spark):
    rows = [
        ("2020", "SP", "1", "A", "1", "1", "Prefeito", "1", "P1", "Ana", "10", 30), ("2020", "SP", "1", "A", "1", "1", "Prefeito", "1", "P2", "Bia", "20", 30),
        ("2020", "SP", "1", "A", "1", "1", "Prefeito", "1", "P2", "Bia", "20", 0), ("2020", "SP", "1", "A", "1", "2", "Prefeito", "1", "P2", "Bia", "20", 9),
        ("2020", "RJ", "2", "B", "1", "1", "Prefeito", "1", "P1", "Ana", "10", 5), ("2024", "RJ", "2", "B", "1", "1", "Prefeito", "1", "P1", "Ana", "10", 8),
        ("2024", "RJ", "2", "B", "1", "1", "Prefeito", "1", "P2", "Bia", "20", 2),
    ]
    df = spark.createDataFrame(rows, "ano string, uf string, cd_municipio string, nm_municipio string, zona string, secao string, cargo string, turno string, partido string, candidato string, nr_votavel string, votos long")
    return df.withColumns({"brancos": F.lit(1), "nulos": F.lit(0), "validos_estimados": F.col("votos")})


def electorate(spark):
    rows = [
        ("2020", "SP", "1", "A", "1", "1", "jovem", "F", 60, 50), ("2020", "SP", "1", "A", "1", "1", "senior", "#NULO#", 40, 30),
        ("2020", "SP", "1", "A", "1", "2", "jovem", "M", 10, 9), ("2020", "RJ", "2", "B", "1", "1", "senior", "M", 20, 5),
        ("2020", "RJ", "2", "B", "1", "9", "senior", "M", 7, 7),
    ]
    df = spark.createDataFrame(rows, "ano string, uf string, cd_municipio string, nm_municipio string, zona string, secao string, perfil_faixa_etaria string, perfil_genero string, eleitorado long, comparecimento_estimado long")
    blank = {c: F.lit("") for c in ("perfil_instrucao", "perfil_estado_civil", "perfil_raca_cor")}
    return df.withColumns({**blank, "abstencao_estimado": F.col("eleitorado") - F.col("comparecimento_estimado")})


def test_tied_winner_is_first_by_name_and_zero_votes_are_ignored(spark):
    rows = {(r.ano, r.uf, r.secao): r for r in sections.section_winners(results(spark)).collect()}
    tied = rows[("2020", "SP", "1")]
    assert (tied.partido_vencedor, tied.votos_vencedor, tied.votos_total_secao, tied.share_vencedor) == ("P1", 30, 60, 0.5)
    assert len(rows) == 4


def test_section_total_rules(spark):
    def total(rule):
        rows = sections.section_electorate(electorate(spark), rule=rule).filter("uf = 'SP' and secao = '1'").collect()
        return rows[0].eleitorado

    assert (total("max"), total("sum"), total("max_or_dim_total")) == (60, 100, 100)


def test_roll_up_totals_agree(spark):
    summary = levels.summary_municipality(electorate(spark), results(spark))
    for level in ("estado", "brasil"):
        up = levels.summary_rollup(summary, level)
        assert up.agg(F.sum("votos")).first()[0] == summary.agg(F.sum("votos")).first()[0]
    outer = levels.summary_from_sections(electorate(spark), results(spark))
    assert outer.filter("ano = '2024'").agg(F.sum("votos")).first()[0] == 10
    assert outer.filter("cargo = ''").agg(F.sum("eleitorado")).first()[0] == 7


def test_results_level_margins(spark):
    rows = {r.entidade: r for r in levels.results_level(levels.result_totals(results(spark)), "brasil").filter("ano = '2020'").collect()}
    assert rows["P2"].rank_entidade == 1 and rows["P2"].votos == 39 and rows["P1"].margem_votos_para_lider == 4
    assert math.isclose(sum(r.share_votos for r in rows.values()), 1.0)


def test_proxy_conserves_people_where_votes_exist(spark):
    parts = proxy.proxy_parts(electorate(spark), results(spark)).collect()
    assert math.isclose(sum(p.votos_proxy for p in parts), 100 + 10 + 20)


def test_lag_uses_previous_observed_period_and_single_period_is_null(spark):
    model = projection.model_base(results(spark).withColumns({"eleitorado": F.lit(100.0), "comparecimento_estimado": F.lit(80.0), "abstencao_estimado": F.lit(20.0)}))
    rows = {(r.ano, r.uf, r.entidade): r for r in projection.historical_swing(model).collect() if r.secao == "1"}
    assert math.isclose(rows[("2024", "RJ", "P1")].swing_anual, (0.8 - 1.0) / 4)
    assert rows[("2024", "RJ", "P2")].swing_anual is None


def test_bands_do_not_depend_on_partitioning(spark):
    model = projection.model_base(results(spark).withColumns({"eleitorado": F.lit(100.0), "comparecimento_estimado": F.lit(80.0), "abstencao_estimado": F.lit(20.0)}))
    confidence = spark.createDataFrame([(0.5,)], "c double")
    out = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        bands = projection.uncertainty_bands(projection.projection_base(model, confidence=confidence), n=50)
        out.append(sorted((r.cenario, r.entidade, round(r.share_medio, 9), round(r.share_p05, 9)) for r in bands.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1] and len(out[0]) == 12
    assert all(0 < r[2] < 1 for r in out[0])


def skewed(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = [(i, 5.0 if rng.random() < 0.4 else round(rng.gauss(0, 3), 1), 1.0 if rng.random() < 0.35 else float(rng.randint(0, 9))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "i int, x double, y double")


def test_quantiles_and_ranks_match_pandas_under_ties(spark):
    rows, df = skewed(spark)
    frame = pd.DataFrame(rows, columns=["i", "x", "y"])
    got = os_.exact_quantiles(df, [], "x", {"a": 0.33, "b": 0.66, "c": 0.05}, rows_per_range=20).first()
    assert [round(got[k], 9) for k in "abc"] == [round(frame.x.quantile(q), 9) for q in (0.33, 0.66, 0.05)]
    ranks = {r.i: r.r for r in os_.average_rank_spread(df, [], "x", "r", rows_per_range=20).collect()}
    assert ranks == dict(zip(frame.i, frame.x.rank()))
    numbers = sorted(r.n for r in os_.row_positions(df, "x", F.col("i"), "n", rows_per_range=20).collect())
    assert numbers == list(range(1, len(rows) + 1))


def test_kendall_matches_brute_force(spark):
    rows, df = skewed(spark)
    c = d = 0
    for (_, x1, y1), (_, x2, y2) in itertools.combinations(rows, 2):
        s = (x1 - x2) * (y1 - y2)
        c, d = c + (s > 0), d + (s < 0)
    for rows_per_range in (25, 10**6):
        got = st.kendall_pair(df, "x", "y", rows_per_range).first()
        assert (got.concordantes, got.discordantes) == (c, d)


def test_spearman_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "a double, b double")
    assert st.spearman_pairs(df, ["a", "b"]).count() == 0


def test_elbow_picks_the_knee():
    assert clustering.elbow([(2, 100.0), (3, 40.0), (4, 35.0), (5, 31.0)]) == 3
    assert clustering.elbow([(2, 5.0), (3, 5.0)]) == 2


def test_every_row_gets_a_cluster(spark):
    rows = [(str(i), "a" if i % 2 else "b", "x" if i % 3 else "y") for i in range(60)]
    df = spark.createDataFrame(rows, "id string, p string, q string")
    out = clustering.cluster_rows(df, ["p", "q"], ["id"], 2, 4, 32)
    assert out.count() == 60 and out.filter("cluster is null or cluster >= k_escolhido").count() == 0


def test_json_shapes_and_quarantine(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"qt votos": "1"}\n{"qt votos": \n[1]\n\n{"qt votos": "2", "x": {"y": 1}}\n')
    good, bad = files.quarantine_bad_records(spark, str(tmp_path / "a.jsonl"))
    assert good.columns == ["QT_VOTOS", "X"] and good.count() == 2 and bad.count() == 2
    (tmp_path / "b.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert files.read_json_records(spark, str(tmp_path / "b.json"), "array").count() == 2
    (tmp_path / "c.json").write_text('{"meta": 1, "rows": [{"a": 1}, {"a": 2}, {"b": 3}]}')
    assert files.read_json_records(spark, str(tmp_path / "c.json"), "object").count() == 3


def test_delimited_groups_by_header_set(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a;b\n1;2\n;\n3\n")
    (tmp_path / "2.csv").write_text("B|A\n5|6\n")
    (tmp_path / "3.csv").write_text("c,d\n1,2\n")
    groups = delimited.read_delimited_grouped(spark, [str(tmp_path / f"{i}.csv") for i in (1, 2, 3)], lineage=True)
    rows = sorted((r.A, r.B) for r in groups[("A", "B")].collect())
    assert rows == [("1", "2"), ("3", ""), ("6", "5")]
    assert {r.campos: r.qtd_linhas for r in delimited.group_manifest(groups).collect()} == {"A,B": 3, "C,D": 1}


def test_refresh_leaves_finished_slices(spark, tmp_path):
    df = spark.createDataFrame([("2020", "SP", 1), ("2022", "SP", 2)], "ano string, uf string, v int")
    out, manifest = str(tmp_path / "o"), str(tmp_path / "m")
    tables.incremental_refresh(df.filter("ano = '2020'"), lambda r: r, out, manifest, "v1")
    tables.incremental_refresh(df, lambda r: r.withColumn("v", F.col("v") * 10), out, manifest, "v1")
    assert sorted((r.v) for r in spark.read.parquet(out).collect()) == [1, 20]


def test_leading_products_keep_what_a_rank_needs(spark):
    """Cells are cut inside a scope's only block; ranks and totals are those of all cells, also over several blocks."""
    import numpy as np

    from tallygrid.operators.blocks import leading_products, sum_of_products

    rng = np.random.default_rng(1)
    left = spark.createDataFrame([(s, k, f"p{p}", float(rng.integers(1, 9))) for s in "ab" for k in range(5) for p in range(40)], "s string, k int, p string, a double")
    right = spark.createDataFrame([(s, k, e, float(rng.random())) for s in "ab" for k in range(5) for e in "xyz"], "s string, k int, e string, b double")
    args = (left, right, ["s"], ["k"], ["p"], ["e"], "a", "b", "v")
    whole = sum_of_products(*args).collect()
    for per_block in (512, 2):
        found = leading_products(*args, "total", 3, keys_per_block=per_block).collect()
        assert len(found) < len(whole) or per_block == 2
        for s in "ab":
            for e in "xyz":
                best = sorted(((-round(r.v, 6), r.p) for r in whole if (r.s, r.e) == (s, e)))[:3]
                assert sorted(((-round(r.v, 6), r.p) for r in found if (r.s, r.e) == (s, e)))[:3] == best
                total = sum(r.v for r in whole if (r.s, r.e) == (s, e))
                assert all(abs(r.total - total) < 1e-6 for r in found if (r.s, r.e) == (s, e))


def test_negative_heads_take_the_plain_way(spark):
    """A municipality whose parts cancel out counts as in the table of parts."""
    people = electorate(spark)
    turned = people.withColumn("eleitorado", F.when(F.col("zona") == people.first()["zona"], -F.col("eleitorado")).otherwise(F.col("eleitorado")))
    assert proxy.leading_cells(turned, results(spark), ["estado"], 10) is None
    for given in (people, turned):
        parts = proxy.proxy_parts(given, results(spark))
        for level, found in zip(("municipio", "brasil"), proxy.leading_profiles(given, results(spark), ["municipio", "brasil"]), strict=True):
            keep = ["entidade", "perfil_combinado", "cargo", "turno", "rank_entidade", "rank_perfil_entidade_ano"]
            wanted = proxy.profile_entity_level(parts, level, top=10).select(*keep)
            assert sorted(map(tuple, found.select(*keep).collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)


def test_inventory_and_traceability_read_their_rows_once(spark):
    from tallygrid.operators import correlated as co

    rows = [("a_2020.json", "2020", "X", "1", "PREFEITO", 2.0), ("a_2020.json", "2018", "", "2", "", 3.0), ("a_2020.json", "2018", "Y", "2", "GOV", 0.0), ("b_2016.json", "x", None, "", None, 1.0)]
    gold = spark.createDataFrame(rows, "arquivo_origem string, ano string, uf string, cd_municipio string, cargo string, votos double")
    for out in (co.file_inventory(gold), co.traceability(gold)):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + out._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 1
    got = {r.arquivo_origem: r for r in co.traceability(gold).collect()}
    a, b = got["a_2020.json"], got["b_2016.json"]
    assert (a.anos_usados, a.ano_min, a.ano_max, a.ufs, a.municipios, a.cargos, a.linhas_gold, a.votos_soma) == ("2018, 2020", 2018, 2020, 2, 2, "GOV, PREFEITO", 3, 5.0)
    assert (b.anos_usados, b.ano_min, b.ano_max, b.ufs, b.municipios, b.cargos, b.linhas_gold, b.votos_soma) == ("", 2016, 2016, 0, 0, "", 1, 1.0)
    assert [(r.arquivo_origem, r.qtd_anos) for r in co.file_inventory(gold).orderBy("arquivo_origem").collect()] == [("a_2020.json", 2), ("b_2016.json", 0)]

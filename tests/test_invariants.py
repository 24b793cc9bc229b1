"""What must hold whatever the data: rates, head counts, null keys."""

import pytest
from pyspark.sql import functions as F

from tallygrid.catalog.base import Data
from tallygrid.operators import analyses, core, levels, projection, sections

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    return Data(spark, FOLDER)


def test_rates_stay_within_one(data):
    for table, rates in (
        (sections.section_abstention(data.base), ("taxa_abstencao", "taxa_comparecimento")),
        (sections.section_entity_results(data.base), ("taxa_abstencao", "share")),
        (analyses.electorate_profiles(data.base), ("taxa_abstencao_perfil", "share_no_perfil")),
        (levels.consolidate_municipal(data.base), ("pct_abstencao", "pct_comparecimento")),
        (levels.timelines_full(data.base)["timeline_nacional"], ("pct_abstencao", "pct_comparecimento")),
    ):
        assert table.where(" or ".join(f"{r} < 0 or {r} > 1" for r in rates)).count() == 0


def test_a_contest_never_counts_more_people_than_there_are(data):
    series = levels.timelines_full(data.base)["timeline_nacional"]
    whole = levels.timeline(data.electorate, [], "timeline_nacional").select("ano", F.col("eleitorado").alias("todos"))
    joined = series.join(whole, "ano")
    assert joined.count() == series.count() and joined.where("eleitorado > todos").count() == 0


def test_model_turnout_is_below_the_electorate(data):
    assert projection.model_base(data.base).where("comparecimento_estimado > eleitorado").count() == 0


RESULT = "ano string, uf string, cd_municipio string, nm_municipio string, zona string, secao string, cargo string, turno string, partido string, candidato string, nr_votavel string, votos double, brancos double, nulos double, validos_estimados double"
PEOPLE = "ano string, uf string, cd_municipio string, nm_municipio string, zona string, secao string, perfil_faixa_etaria string, perfil_genero string, perfil_instrucao string, perfil_estado_civil string, perfil_raca_cor string, eleitorado double, comparecimento_estimado double, abstencao_estimado double"


@pytest.fixture(scope="module")
def holed(spark):
    results = spark.createDataFrame(
        [("2000", "A", "1", "X", None, "7", None, "1", "P", "c", "1", 10.0, 0.0, 0.0, 10.0), ("2000", "A", "1", "X", "3", "7", "o", "1", "Q", "d", "2", 5.0, 0.0, 0.0, 5.0)], RESULT
    )
    people = spark.createDataFrame(
        [("2000", "A", "1", "X", None, "7", "25-34", "F", "m", "s", "b", 20.0, 15.0, 5.0), ("2000", "A", "1", "X", "3", "7", "25-34", "M", "m", "s", "b", 9.0, 9.0, 0.0)], PEOPLE
    )
    return results, people


def test_null_keys_keep_votes_and_people(holed):
    results, people = holed
    assert analyses.vote_trends(results).agg(F.sum("votos")).first()[0] == 15
    assert levels.results_level(levels.result_totals(results), "estado").agg(F.sum("votos")).first()[0] == 15
    base = sections.section_base(results, people)
    assert sorted(r["eleitorado"] for r in base.collect()) == [9, 20]
    won = sections.section_winner_profile(results, people).collect()
    assert sorted(r["eleitorado_secao"] for r in won) == [9, 20]


def test_null_weights_come_last(spark):
    df = spark.createDataFrame([("k", None, "a"), ("k", 5.0, "b"), ("n", None, "c")], "g string, w double, t string")
    assert {(r["g"], r["w"], r["t"]) for r in core.top1(df, ["g"], "w", ["t"]).collect()} == {("k", 5.0, "b"), ("n", None, "c")}


def test_unreadable_parquet_is_listed(spark, tmp_path):
    from tallygrid.sources import files

    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 not really a table")
    (tmp_path / "short.parquet").write_bytes(b"x")
    found = {r["arquivo"].rsplit("/", 1)[1]: r["motivo"] for r in files.unreadable_parquet(spark, str(tmp_path)).collect()}
    assert found == {"bad.parquet": "sem_fim", "short.parquet": "curto"}

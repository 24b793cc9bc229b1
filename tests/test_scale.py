"""Shared steps are written once, and the code of a row stays compilable."""

import re
import time

from pyspark.sql import functions as F

from tallygrid import session
from tallygrid.catalog import correlated_queries, source_queries
from tallygrid.catalog.base import Data
from tallygrid.functions.labels import age_band
from tallygrid.operators import analyses, behaviour, clustering, order_statistics, sections
from tallygrid.sources import records, silver

SMALL = "/root/testdata/sf0.001"


def untouched(out):
    return not any(SMALL in f for f in out.inputFiles())


def test_a_cluster_base_is_written_once(spark):
    calls = []
    write = clustering.materialize
    try:
        clustering.materialize = lambda df, name: calls.append((name, any("lineitem" in f for f in df.inputFiles()))) or write(df, name)
        clustering.sector_cluster_base(Data(spark, SMALL).base)
    finally:
        clustering.materialize = write
    assert [name for name, reads in calls if reads] == ["base"]  # the sectors come from the written base


def test_profile_cells_are_compilable(spark, capsys):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sections.profile_cells(Data(spark, SMALL).electorate, ["ano", "uf", "cd_municipio", "zona", "secao"]).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


def test_silver_rows_are_compilable(spark, capsys):
    d = Data(spark, SMALL)
    votes, people, candidates = (make(d) for make in (source_queries.raw_votes, source_queries.raw_people, source_queries.raw_candidates))
    results = silver.silver_results(votes)
    tables = [results, results.select("ano", "uf", "turno", "partido", "nr_votavel", "votos"), silver.silver_electorate(people), silver.silver_candidates(candidates), silver.records_to_gold_base(votes)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for table in tables:
            table.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


def test_an_age_is_read_once_and_keeps_its_band(spark):
    ages = ["16", "20,9", "21.0", " 24 ", "79", "80", "120", "121", "15", "2124", "abc", "", None]
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, a string").select("i", age_band("a").alias("b"))
    assert [r.b for r in rows.orderBy("i").collect()] == [
        "16 a 17 anos", "18 a 20 anos", "21 a 24 anos", "21 a 24 anos", "75 a 79 anos", "80 anos ou mais", "80 anos ou mais", "Codigo 121", "Codigo 15", "21 a 24 anos", "", "", ""]


def test_a_panel_is_read_twice_at_most(spark):
    rows = Data(spark, SMALL).base
    panel = behaviour.behaviour_panel(rows)
    assert untouched(behaviour.behaviour_matrix(panel, max_entities=2))
    unit = ["ano", "cargo", "turno", "uf", "cd_municipio", "nm_municipio", "zona", "secao"]
    units = panel.select(*unit).distinct().withColumn("cluster", F.lit(0))
    assert untouched(clustering.cluster_interpretation(units, panel, unit))


def test_input_rows_are_grouped_by_hashing(spark, capsys):
    d = Data(spark, SMALL)
    for grouped in (sections.section_electorate(d.electorate), sections.section_base(d.results, d.electorate)):
        grouped.explain()
        plan = capsys.readouterr().out.splitlines()
        below = [i for i, line in enumerate(plan) if "FileScan" in line]
        assert below and not any("SortAggregate" in line for line in first_aggregates(plan))


def first_aggregates(plan):
    """The aggregates nearest to each scan of a printed plan: those without another one beneath."""
    at = [(len(line) - len(line.lstrip(" :+-")), line) for line in plan]
    for i, (depth, line) in enumerate(at):
        if "Aggregate" in line:
            beneath = []
            for deeper, other in at[i + 1:]:
                if deeper <= depth:
                    break
                beneath.append(other)
            if not any("Aggregate" in other for other in beneath):
                yield line


def test_names_that_differ_in_a_section_split_no_total(spark):
    rows = [("1", "B", "x", 5, 4, 1), ("1", "A", "", 7, 5, 2), ("1", None, "x", 2, 1, 1), ("2", None, "", 3, 3, 0)]
    people = spark.createDataFrame(rows, "secao string, nm_municipio string, perfil_genero string, eleitorado long, comparecimento_estimado long, abstencao_estimado long")
    people = people.selectExpr("'1998' as ano", "'AC' as uf", "'7' as cd_municipio", "'1' as zona", "*", *[f"'' as {d}" for d in ("perfil_faixa_etaria", "perfil_instrucao", "perfil_estado_civil", "perfil_raca_cor")])
    wanted = {"max": [(7, 5, 2), (3, 3, 0)], "sum": [(14, 10, 4), (3, 3, 0)], "max_or_dim_total": [(7, 5, 2), (3, 3, 0)]}
    for rule, totals in wanted.items():
        out = sections.section_electorate(people, rule=rule).orderBy("secao").collect()
        assert [(r.nm_municipio, r.eleitorado, r.comparecimento_estimado, r.abstencao_estimado) for r in out] == [("B", *totals[0]), (None, *totals[1])]
    both = people.withColumn("eleitorado", F.col("eleitorado") + 3)  # 'x' adds up to 8 + 5, more than the largest cell
    assert [r.eleitorado for r in sections.section_electorate(both).orderBy("secao").collect()] == [13, 6]


def contest_rows(spark, tmp_path):
    """Votes and people of two sections, written; with a null office, a blank party and a row without votes."""
    votes = [("1", "A", "1", "P", "x", 6), ("1", "A", "1", "P", "x", 1), ("1", "A", "1", "Q", "y", 3), ("1", "A", "1", " ", "z", 5), ("2", "A", "1", "Q", "y", 4), ("2", None, "1", "Q", "y", 2), ("2", "A", "2", "P", "x", 0)]
    people = [("1", "F", 4), ("1", "M", 6), ("1", "M", 2), ("2", "F", 5), ("2", "", 3), ("2", "F", 0)]
    place = ["'1998' as ano", "'AC' as uf", "'7' as cd_municipio", "'N' as nm_municipio", "'1' as zona"]
    rest = [f"'' as {d}" for d in ("perfil_faixa_etaria", "perfil_instrucao", "perfil_estado_civil", "perfil_raca_cor")]
    made = {
        "votes": spark.createDataFrame(votes, "secao string, cargo string, turno string, partido string, candidato string, votos long").selectExpr(*place, "*", "0 as brancos", "1 as nulos", "votos as validos_estimados"),
        "people": spark.createDataFrame(people, "secao string, perfil_genero string, eleitorado long").selectExpr(*place, "*", *rest, "eleitorado as comparecimento_estimado", "0 as abstencao_estimado"),
    }
    for name, rows in made.items():
        rows.write.parquet(f"{tmp_path}/{name}")
    return [spark.read.parquet(f"{tmp_path}/{name}") for name in made]


def test_correlation_reads_its_inputs_once(spark, tmp_path):
    votes, people = contest_rows(spark, tmp_path)
    out = analyses.result_electorate_correlation(votes, people)
    assert not [f for f in out.inputFiles() if str(tmp_path) in f]  # what both kinds read is grouped and written
    for kind in ("partido", "candidato"):
        alone = analyses.profile_vote_association(votes, people, kind)
        same = out.filter(F.col("tipo_entidade") == kind).select(alone.columns)
        assert alone.count() and sorted(map(str, same.collect())) == sorted(map(str, alone.collect()))


def test_evidence_joins_its_rows_once(spark):
    joined, modules = [], (correlated_queries, records, order_statistics)
    write = session.materialize

    def counted(df, name, **more):
        joined.extend(name for f in df.inputFiles() if f.startswith("file:") and SMALL in f and "lineitem" in f)
        return write(df, name, **more)

    try:
        for m in modules:
            m.materialize = counted
        out = correlated_queries.c14(Data(spark, SMALL))
    finally:
        for m in modules:
            m.materialize = write
    assert joined == ["results"] and untouched(out)
    assert {r.tipo for r in out.collect()} == {"cobertura_temporal", "correlacao_temporal", "correlacao_entidades"}


def test_written_tables_leave_no_shuffle_files(spark):
    def shuffled():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {str(b) for b in (blocks.apply(i) for i in range(blocks.size())) if "shuffle" in str(b)}

    before = shuffled()
    table = session.materialize(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "freed", free=True)
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left and table.count() == 7
    assert spark.conf.get(session._CLEANUP, None) is None

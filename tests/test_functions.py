"""Hand-computed cases for the column functions."""

import pytest
from pyspark.sql import functions as F

from tallygrid.functions import bands, labels, numbers, text
from tallygrid.sources import roles


def values(spark, function, inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.v for r in rows.select("i", function("x").alias("v")).orderBy("i").collect()]


def test_three_number_readers_disagree_as_documented(spark):
    raw = ["1.234,56", "12,3", "1.234", "abc", None, " 7 ", "nan", "1d"]
    assert values(spark, numbers.metric, raw) == [0.0, 12.3, 1.234, 0.0, 0.0, 7.0, 0.0, 0.0]
    assert values(spark, numbers.parse_number, raw) == [1234.56, 12.3, 1234.0, None, None, 7.0, None, None]
    assert values(spark, numbers.parse_number_lenient, raw) == [1234.56, 12.3, 1.234, None, None, 7.0, None, None]


def test_null_words(spark):
    raw = ["#NULO#", "Sem valor", "GERAL", " ", None, "x", "algo sem valor", "Codigo 7"]
    assert values(spark, text.valid, raw) == [False, False, False, False, False, True, False, True]
    assert values(spark, text.clean_value, raw) == ["", "", "", "", "", "x", "", "Codigo 7"]
    assert values(spark, text.meaningful, raw) == ["", "", "", "", "", "x", "", ""]
    assert values(spark, text.discrete, raw[3:6]) == ["SEM_VALOR", "SEM_VALOR", "x"]
    assert values(spark, lambda c: text.valid(F.col(c)), raw) == values(spark, text.valid, raw)


def test_labels(spark):
    grade = lambda c: labels.label_category(c, "perfil_instrucao")
    assert values(spark, grade, ["6", "8.0", "77", "ENSINO MEDIO", "nan", "-1", "1-URGENTE"]) == [
        "Medio completo", "Superior completo", "Codigo 77", "Ensino Medio", "Sem valor", "Nao informado", "1-Urgente"]
    assert values(spark, lambda c: labels.label_category(c, "perfil_genero"), ["f", "F", "masc"]) == ["f", "Feminino", "Masculino"]
    assert values(spark, labels.age_band, ["16", "20", "24", "29", "80", "15", "", "1800"]) == [
        "16 a 17 anos", "18 a 20 anos", "21 a 24 anos", "25 a 29 anos", "80 anos ou mais", "Codigo 15", "", "18 anos"]
    assert len(labels.age_bands()) == 15


def test_codes_and_years(spark):
    assert values(spark, text.compact_code, ["12.0", "12.5", "a.0", " 3 "]) == ["12", "12.5", "a.0", "3"]
    assert values(spark, text.clean_state, ["sp", "S1", "SPX", None]) == ["SP", "SEM_UF", "SEM_UF", "SEM_UF"]
    assert values(spark, text.first_year, ["de 2022 a 1998", "nada", "votacao_2014.json"]) == ["1998", "", "2014"]


def test_trend_labels(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.02), (1.0, 1.1), (1.0, 0.9), (None, 1.0)], "a double, b double")
    assert [r.v for r in rows.select(bands.trend_label("a", "b").alias("v")).collect()] == [
        "estável", "crescimento", "estável", "crescimento", "queda", "sem série suficiente"]


@pytest.mark.parametrize("name, role", [
    ("ANO_ELEICAO", "ano"), ("SG_UF", "uf"), ("CD_MUNICIPIO", "cd_municipio"), ("NM_MUNICIPIO", "nm_municipio"), ("NR_ZONA", "zona"),
    ("DT_ELEICAO", "data"), ("NM_VOTAVEL", "candidato"), ("SG_PARTIDO", "partido"), ("QT_VOTOS", "votos"), ("QT_VOTOS_BRANCOS", "brancos"),
    ("QT_ELEITORES_PERFIL", "eleitorado"), ("DS_GRAU_ESCOLARIDADE", "perfil_instrucao"), ("QT_COMPARECIMENTO", "comparecimento"),
    ("NM_LOCALIDADE", "local_votacao"), ("QT_VOTOS_NULOS", "nulos"), ("X", ""),
])
def test_roles(name, role):
    assert roles.role_of(name) == role


def test_role_choice_prefers_names_over_codes(spark):
    rows = spark.createDataFrame([("13", "PT", ""), ("15", "", "MDB nome")], "NR_PARTIDO string, SG_PARTIDO string, NM_PARTIDO string")
    assert [r.v for r in rows.select(roles.resolve_role(rows.columns, "partido").alias("v")).collect()] == ["PT", "MDB nome"]


def test_numbers_and_names_take_few_looks_at_a_value(spark):
    """Each reader's expression stays small, as conditions evaluate every mention anew; the values stay as documented."""
    def size(column):
        plan = spark.range(1).select(F.lit("x").alias("x")).select(column.alias("v"))._jdf.queryExecution().analyzed().toString()
        return plan.count("x#")

    assert size(numbers.parse_number("x")) < 10
    raw = ["16", "17", "20", "24", "25", "79", "80", "120", "121", "15", "x", None, "33,9", "-5"]
    assert values(spark, labels.age_band, raw)[:8] == [
        "16 a 17 anos", "16 a 17 anos", "18 a 20 anos", "21 a 24 anos", "25 a 29 anos", "75 a 79 anos", "80 anos ou mais", "80 anos ou mais"]
    assert values(spark, labels.age_band, raw)[8:] == ["Codigo 121", "Codigo 15", "", "", "30 a 34 anos", "Codigo -5"]
    raw = ["1.234.567,8", "-1.234", "+12,5", ".5", "1e3", "1.23", "1,2,3", "1 234,5", "n/a", "12."]
    assert values(spark, numbers.parse_number, raw) == [1234567.8, -1234.0, 12.5, 0.5, 1000.0, 1.23, None, 1234.5, None, 12.0]
    assert values(spark, numbers.reads_as_number, [*raw, None]) == [True, True, True, True, True, True, False, True, False, True, False]
    names = spark.createDataFrame([("9", "", "ANA"), ("", "12", "7"), ("7", "BIA", ""), ("", "", "")], "NR_CANDIDATO string, NM_URNA_CANDIDATO string, NM_CANDIDATO string")
    assert [r.v for r in names.select(roles.resolve_role(names.columns, "candidato").alias("v")).collect()] == ["ANA", "12", "BIA", ""]

"""Star-schema tables read as contest data.

Orders play the electorate, line items the votes.  Only the needed columns reach the scans;
`nation` and `region` have a fixed size (25 and 5 rows), every other join side is left to
the planner and adaptive execution, which measure sizes before broadcasting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _text(c: Column) -> Column:
    return c.cast("string")


# Declared schemas: no footer-reading job before every query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _placed_orders(spark: SparkSession, folder: str) -> DataFrame:
    # Both sides of the order/line join are fact tables: they meet in a shuffle whatever
    # the planner's size estimate says.
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    places = table(spark, folder, "nation").join(
        F.broadcast(table(spark, folder, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")
    )


def _section_columns() -> list[Column]:
    return [
        _text(F.year("o_orderdate")).alias("ano"),
        F.col("r_name").alias("uf"),
        _text(F.col("n_nationkey")).alias("cd_municipio"),
        F.col("n_name").alias("nm_municipio"),
        _text(F.col("c_custkey") % 3).alias("zona"),
        _text(F.col("c_custkey") % 12).alias("secao"),
    ]


def results(spark: SparkSession, folder: str) -> DataFrame:
    """Votes per section, contest, party and candidate."""
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part")
    joined = (
        lines.join(_placed_orders(spark, folder).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )
    votes = F.col("l_quantity").cast("long")
    return joined.select(
        *_section_columns(),
        F.col("p_type").alias("cargo"),
        F.when(F.col("l_linenumber") <= 4, "1").otherwise("2").alias("turno"),
        F.col("p_brand").alias("partido"),
        F.col("p_name").alias("candidato"),
        _text(F.col("p_partkey")).alias("nr_votavel"),
        votes.alias("votos"),
        F.round(F.col("l_discount") * 100).cast("long").alias("brancos"),
        F.round(F.col("l_tax") * 100).cast("long").alias("nulos"),
        votes.alias("validos_estimados"),
    )


def electorate(spark: SparkSession, folder: str) -> DataFrame:
    """Head counts per section and profile cell."""
    key = F.col("o_orderkey")
    heads = 1 + key % 9
    absent = F.when(key % 9 >= 2, key % 3).otherwise(F.lit(0))
    balance = F.col("c_acctbal")
    return _placed_orders(spark, folder).select(
        *_section_columns(),
        F.when(balance < 0, "negativo")
        .when(balance < 3000, "ate 3000")
        .when(balance < 7000, "3000 a 7000")
        .otherwise("7000 ou mais")
        .alias("perfil_faixa_etaria"),
        F.col("o_orderstatus").alias("perfil_genero"),
        F.col("o_orderpriority").alias("perfil_instrucao"),
        F.col("c_mktsegment").alias("perfil_estado_civil"),
        F.when(key % 7 == 0, "#NULO#")
        .when(key % 7 == 1, "Sem valor")
        .otherwise(F.concat(F.lit("G"), _text(key % 5)))
        .alias("perfil_raca_cor"),
        heads.cast("long").alias("eleitorado"),
        (heads - absent).cast("long").alias("comparecimento_estimado"),
        absent.cast("long").alias("abstencao_estimado"),
    )


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate records: one per part sold in a place, with a profile of its own."""
    size = F.col("p_size")
    joined = (
        table(spark, folder, "lineitem")
        .join(_placed_orders(spark, folder).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return joined.select(
        *_section_columns(),
        F.col("p_type").alias("cargo"),
        F.when(F.col("l_linenumber") <= 4, "1").otherwise("2").alias("turno"),
        F.col("p_brand").alias("partido"),
        F.col("p_name").alias("candidato"),
        _text(F.col("p_partkey")).alias("nr_candidato"),
        _text(F.col("l_suppkey")).alias("sq_candidato"),
        F.when(size < 20, "jovem").otherwise("senior").alias("perfil_faixa_etaria"),
        F.when(F.col("p_partkey") % 2 == 0, "F").otherwise("M").alias("perfil_genero"),
        F.when(size % 5 == 0, "Sem valor").otherwise(F.concat(F.lit("E"), _text(size % 5))).alias("perfil_instrucao"),
        F.lit("").alias("perfil_estado_civil"),
        F.when(F.col("p_partkey") % 11 == 0, "#NULO#").otherwise("R1").alias("perfil_raca_cor"),
        F.col("l_returnflag").alias("situacao_candidatura"),
        F.when(F.col("l_linestatus") == "O", "ELEITO").otherwise("NAO ELEITO").alias("resultado_candidatura"),
    )

"""Clean a corpus: quality rules, line dedup, near duplicates, decontamination, tokens.

Each stage takes (spark, docs, folder) and returns a DataFrame; `run` writes each stage's
result as Parquet into the session's shared folder and reads it back as the next one's docs.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.llm import decontaminate, line_dedup, ngram_join, quality_rules, sentence_pieces
from tallygrid.llm.common import table
from tallygrid.llm.queries import MODEL
from tallygrid.session import materialize


#: Rows of a batch that Python workers get: documents are long, and a worker holds a batch several times over.
BATCH_ROWS = 1000


def _bounded(spark: SparkSession) -> None:
    """Small batches for the session, so that a batch of long documents fits beside the executor's heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Operator 2: documents that the rules reject go."""
    _bounded(spark)
    return quality_rules.keep(docs, table(spark, folder, "labels"))


def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Operator 6: lines of ten documents or more go; n_chars follows the text."""
    _bounded(spark)
    done = line_dedup.clean(docs)
    return done.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Operator 9: one document of each group of near duplicates stays."""
    _bounded(spark)
    return ngram_join.keep_one(docs)


def contamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, folder, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Operator 10: ids of every text, with the checks of the encoding."""
    _bounded(spark)
    coded = sentence_pieces.encode(docs, sentence_pieces.read_model(MODEL))
    return coded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "parity", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("contamination", contamination),
    ("tokens", tokens),
]

#: No SQL: the first and last stages can't be expressed in it; a test holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

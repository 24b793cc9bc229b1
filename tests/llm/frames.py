"""Small tables with the cases that every operator must stand."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i} and line{i % 97}" for i in range(4000))
PROSE = "the quick brown fox jumps over the lazy dog while seven other animals watch from the old wooden fence near a small river today"


def documents(spark, texts, langs=None, extra=True):
    """doc_id = place; with columns whose names clash with those that operators add."""
    rows = [(i, t, (langs or ["en"] * len(texts))[i], "src", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        df = df.withColumns({c: F.lit("own") for c in ("n_words", "kept", "ids", "score", "spans", "tkey", "text_key", "cell", "host", "n_dropped")})
    return df


ODD = [None, "", " \n\t", "a", PROSE, PROSE, LONG, "###\n\n###\n", "日本語 テキスト\n日本語 テキスト", PROSE.upper()]


def odd(spark, empty=False):
    df = documents(spark, ODD, ["en", None, "de", "en", "en", "en", "fr", "xx", "ja", "en"])
    null_id = df.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long"))
    df = df.unionByName(null_id).unionByName(df.where("doc_id = 5"))
    return df.where("false") if empty else df


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

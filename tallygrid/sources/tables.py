"""Writing, scanning, refreshing, slicing and sampling tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import number, parse_number_lenient
from ..functions.text import discrete, valid
from ..model import ELECTORAL, Spec
from ..operators.core import sums


def partitioned_sink(df: DataFrame, path: str, by: Sequence[str] = ("uf",), mode: str = "overwrite") -> None:
    """Parquet by partition.

    Rows are rebalanced by the partition columns: Spark splits a large value and joins small
    ones by measured bytes (the advisory partition size), so files are of like size whatever
    the skew.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).option("compression", "snappy").parquet(path)


# Fixed value: the mark by which spreadsheets know UTF-8.
BYTE_ORDER_MARK = "\ufeff"


def scan_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def csv_preview_sink(df: DataFrame, path: str, n: int = 5000) -> None:
    """A ';' preview of the first n rows (in the order of all columns) with a note and a byte-order mark; the Parquet table stays complete."""
    note = f"CSV preview limitado a {n} linhas; Parquet contem a tabela completa."
    shown = head_sample(df, n).withColumn("_csv_preview_observacao", F.lit(note))
    # The mark stands before the header, so the header is a row of its own; a single sorted partition keeps the order.
    marked = shown.select(*[F.col(c).cast("string") for c in shown.columns])
    header = df.sparkSession.createDataFrame([tuple(BYTE_ORDER_MARK * (i == 0) + c for i, c in enumerate(shown.columns))], marked.schema)
    header.unionByName(marked).coalesce(1).write.mode("overwrite").options(header="false", sep=";").csv(path)


def pending_slices(slices: DataFrame, manifest: DataFrame | None, version: str, keys: Sequence[str] = ("ano", "uf")) -> DataFrame:
    """Slices not yet finished under this schema version."""
    wanted = slices.select(*keys).distinct()
    if manifest is None:
        return wanted
    done = manifest.filter(F.col("versao") == version).select(*keys)
    return wanted.join(done, list(keys), "left_anti")


def incremental_refresh(
    source: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, manifest_path: str, version: str,
    keys: Sequence[str] = ("ano", "uf"),
) -> DataFrame:
    """Rebuild only unfinished slices; other partitions stay. Returns the slices rebuilt."""
    spark = source.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(manifest_path)
    exists = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    manifest = spark.read.parquet(manifest_path) if exists else None
    todo = pending_slices(source, manifest, version, keys)
    rows = build(source.join(todo, list(keys), "left_semi"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    todo.withColumn("versao", F.lit(version)).write.mode("append").parquet(manifest_path)
    return spark.read.parquet(manifest_path).filter(F.col("versao") == version)


def slice_filter(df: DataFrame, ufs: Sequence[str] = (), years: Sequence[str] = (), max_places: int | None = None, spec: Spec = ELECTORAL) -> DataFrame:
    """Listed states and periods; the first places of every state when a number is given."""
    if ufs:
        df = df.filter(F.upper(spec.state).isin([u.upper() for u in ufs]))
    if years:
        df = df.filter(F.col(spec.period).isin([str(y) for y in years]))
    if max_places:
        places = df.select(spec.state, spec.place).distinct()
        rank = F.row_number().over(Window.partitionBy(spec.state).orderBy(spec.place))
        kept = places.withColumn("__n", rank).filter(F.col("__n") <= max_places).drop("__n")
        df = df.join(kept, [spec.state, spec.place], "left_semi")
    return df


def list_places(electorate: DataFrame, results: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Places present in either table with row counts and summed section electorate."""
    code, name = discrete(spec.place).alias(spec.place), discrete(spec.place_name).alias(spec.place_name)
    keys = [c for c in (spec.zone, spec.section, *spec.contest) if c in electorate.columns]
    sections = electorate.filter(valid(spec.place)).select(code, name, *keys, number(electorate, "eleitorado").alias("e")).groupBy(spec.place, *keys).agg(
        F.max(spec.place_name).alias(spec.place_name), F.max("e").alias("eleitorado_estimado"), F.count(F.lit(1)).alias("linhas_total")
    )
    one = sections.groupBy(spec.place).agg(F.max(spec.place_name).alias(spec.place_name), *sums(["linhas_total", "eleitorado_estimado"]))
    two = results.filter(valid(spec.place)).select(code, name).groupBy(spec.place).agg(
        F.max(spec.place_name).alias(spec.place_name), F.count(F.lit(1)).alias("linhas_total"), F.lit(0.0).alias("eleitorado_estimado")
    )
    return one.unionByName(two).groupBy(spec.place).agg(
        F.max(F.nullif(F.col(spec.place_name), F.lit("SEM_VALOR"))).alias(spec.place_name), *sums(["linhas_total", "eleitorado_estimado"])
    )


def sample_order(df: DataFrame, keys: Sequence[str], seed: int):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def reservoir_sample(
    df: DataFrame, keys: Sequence[str], fraction: float = 1.0, low: int = 0, high: int | None = None, seed: int = 42, bucket_rows: int = 100_000
) -> DataFrame:
    """A seeded sample, between two sizes if given, the same whatever the partitioning.

    Rows go by a keyed digest.  The digest at which the sample ends is found by counting rows per
    three hex digits (4096 counts at a time), then inside the bucket where the size is reached, until
    it holds at most `bucket_rows` rows; everything below is one filter.  Only that last bucket is
    sorted.  Repeated keys share a digest and can't be told apart: any of them may be left out.
    """
    total = df.count()
    size = min(max(low, round(total * fraction)), total, total if high is None else high)
    if size == total:
        return df
    marked = df.withColumn("__digest", sample_order(df, keys, seed))
    prefix, wanted = "", size
    while wanted and len(prefix) < 30:
        inside = marked.where(F.col("__digest").startswith(prefix)) if prefix else marked
        counts = inside.groupBy(F.substring("__digest", len(prefix) + 1, 3).alias("d")).count().orderBy("d").collect()
        for row in counts:
            if row["count"] > wanted:
                prefix, bucket = prefix + row.d, row["count"]
                break
            wanted -= row["count"]
        else:
            break
        if bucket <= bucket_rows:
            break
    sure = marked.where(F.col("__digest") < prefix)
    if wanted:
        sure = sure.unionByName(marked.where(F.col("__digest").startswith(prefix)).orderBy("__digest", *keys).limit(wanted))
    return sure.drop("__digest")


def head_sample(df: DataFrame, n: int) -> DataFrame:
    """The first rows in the order of all columns, so that a rerun gives the same."""
    return df.orderBy(*df.columns).limit(n)


def analytic_projection(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Columns worth analysing: quantities as doubles, the rest as text, codes left out."""
    classes = {r.coluna: r.classe_semantica for r in profile.select("coluna", "classe_semantica", "processar_analise").filter("processar_analise").collect()}
    numeric = {"quantidade", "numerico"}
    return df.select(
        *[(parse_number_lenient(c) if classes[c] in numeric else F.col(c).cast("string")).alias(c) for c in df.columns if c in classes]
    )


def row_counts_by_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.groupBy().agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(n).alias("tabela"), "linhas") for n, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

"""JSON documents: discovery, classification, reading and quarantine."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import path_year
from ..session import materialize, scratch_path
from .json_ranges import split_records
from .roles import normalize_names

MAX_LINE_CHARS = 64 * 1024 * 1024
CORRUPT = "_corrupt_record"

# Path words of every domain, in order of precedence.
DOMAIN_WORDS = [
    ("candidatos", ["canidatos", "candidatos", "consulta_cand", "bem_candidato", "consulta_coligacao", "consulta_vagas", "motivo_cassacao"]),
    ("eleitorado", ["eleitorado", "perfil_eleitor", "transferencia_temporaria", "transf_temporaria"]),
    ("resultados", ["resultados", "votacao", "totalizacao"]),
]
# Path words of every subject, in order of precedence.
SUBJECT_WORDS = [
    ("perfil_eleitor_secao", "perfil_eleitor_secao"), ("perfil_eleitorado", "perfil_eleitorado"), ("votacao_secao", "votacao_secao"),
    ("votacao_candidato", "votacao_candidato"), ("votacao_partido", "votacao_partido"), ("consulta_cand", "consulta_candidato"),
    ("bem_candidato", "bens_candidato"), ("coligacao", "coligacao"), ("consulta_vagas", "consulta_vagas"),
    ("motivo_cassacao", "motivo_cassacao"), ("transf_temporaria|transferencia_temporaria", "transferencia_temporaria"),
]
METADATA_NAME = r"^(manifesto_.*|resumo_.*)"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, r"[/\\]"), -1)


def classify_document(path: Column | str) -> dict[str, Column]:
    """Domain, subject and kind of a document from its path; the first match wins."""
    p = F.lower(F.col(path) if isinstance(path, str) else path)
    name = file_name(p)
    is_metadata = name.rlike(METADATA_NAME)
    domain = F.when(is_metadata, "metadados_processamento").otherwise("outros")
    for label, words in reversed(DOMAIN_WORDS):
        domain = F.when(p.rlike("|".join(words)), label).otherwise(domain)
    subject = F.regexp_replace(name, r"\.[^.]*$", "")
    for pattern, label in reversed(SUBJECT_WORDS):
        subject = F.when(p.rlike(pattern), label).otherwise(subject)
    kind = F.when(is_metadata, "metadado").otherwise("dados")
    return {"dominio_documento": domain, "assunto_documento": subject, "tipo_arquivo_json": kind}


def year_from_path(path: Column | str) -> Column:
    return path_year(path)


def document_period(path: Column | str, content_year: Column) -> Column:
    """Year in the path, else the year found in the content."""
    return F.coalesce(F.nullif(path_year(path), F.lit("")), content_year)


def discover_files(spark: SparkSession, root: str, folder: str | None = "JSON") -> DataFrame:
    """Data documents below a root, with size and classification.

    Listing runs on executors; file contents are never read because the column is pruned.
    Years are looked for below the root, whose own name is no matter.
    """
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,jsonl,ndjson}")
        .load(root).select("path", "length")
    )
    name = file_name(F.col("path"))
    kept = found.filter(~name.startswith("_") & ~F.lower(name).rlike(METADATA_NAME))
    if folder:
        kept = kept.filter(F.upper(F.element_at(F.split("path", "/"), -2)) == folder.upper())
    below = F.regexp_replace("path", f"^.*?/{re.escape(root.rstrip('/').rsplit('/', 1)[-1])}/", "")
    return kept.withColumns({**classify_document("path"), "ano_arquivo": year_from_path(below)})


def _normalized(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    """All fields as text where possible; nested values keep their structure."""
    df = spark.read.option("primitivesAsString", "true").option("mode", "DROPMALFORMED").json(path)
    return T.StructType([f for f in df.schema.fields if f.name != CORRUPT])


def parse_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Text lines with the parsed record `r` and a `bad` flag (broken or over-long)."""
    schema = schema or infer_schema(spark, path)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    long_line = F.length("value") > MAX_LINE_CHARS
    record = F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = lines.select("value", F.col("_metadata.file_path").alias("arquivo"), long_line.alias("too_long"), F.when(~long_line, record).alias("r"))
    not_object = ~F.ltrim("value").startswith("{")
    return parsed.withColumn("bad", F.col("too_long") | not_object | F.col(f"r.{CORRUPT}").isNotNull())


def read_json_records(spark: SparkSession, path: str, shape: str = "lines", schema: T.StructType | None = None) -> DataFrame:
    """Records of JSON documents with normalised column names.

    shape='lines' reads one object per line and skips lines that do not parse; 'array' reads
    documents holding a list of records; 'object' documents whose list values hold them.
    Lists are cut into records by byte ranges (`json_ranges`), so one large document is read by
    many tasks; the records are written to the shared folder as lines, from where the schema, if
    none is given, and the values are read.
    """
    if shape != "lines":
        lines = scratch_path(spark, "json-records")
        split_records(spark, path, shape).select("registro").write.text(lines)
        path = lines
    schema = schema or infer_schema(spark, path)
    good = parse_lines(spark, path, schema).filter(~F.col("bad"))
    return _normalized(good.select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields]))


def quarantine_bad_records(spark: SparkSession, path: str, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, rejected lines with file, reason and the whole line)."""
    schema = schema or infer_schema(spark, path)
    parsed = parse_lines(spark, path, schema)
    good = _normalized(parsed.filter(~F.col("bad")).select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields]))
    reason = F.when(F.col("too_long"), "linha_longa").otherwise("json_invalido")
    bad = parsed.filter("bad").select("arquivo", reason.alias("motivo"), F.col("value").alias("linha"))
    return good, bad


def read_parquet_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """Parquet below a folder, leaving unreadable files out; `unreadable_parquet` lists those."""
    return spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").parquet(path)


def unreadable_parquet(spark: SparkSession, path: str, small: int = 1 << 20, pattern: str = "*.parquet") -> DataFrame:
    """(arquivo, motivo) of the files below a folder that are no whole Parquet files.

    Spark's own reader asks every file for its rows without any column, which seeks to the footer,
    checks its length and parses it; no data page is read.  Files that yield no row either have
    none or can't be read: their ends are looked at where they are `small`; a larger file without a
    row lacks a readable footer.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    listed = listed.withColumn("path", F.col("_metadata.file_path"))
    reader = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    sound = reader.schema("nenhuma string").parquet(path).select(F.col("_metadata.file_path").alias("path")).distinct()
    empty = materialize(listed.select("path", "length").join(sound, "path", "left_anti"), "parquet-suspects")
    mark = F.lit(b"PAR1")
    ends = listed.where(F.col("length") <= small).select("path", F.substring("content", 1, 4).alias("first"), F.substring("content", -4, 4).alias("last"), F.hex(F.substring("content", -8, 4)).alias("size"))
    told = empty.join(ends, "path", "left")
    # The footer's length is a little-endian number before the closing mark.
    size = F.conv(F.concat(*[F.substring("size", i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("long")
    reason = (
        F.when(F.col("length") < 12, "curto").when(F.col("length") > small, "rodape_ilegivel").when(F.col("first") != mark, "sem_inicio")
        .when(F.col("last") != mark, "sem_fim").when(size + 12 > F.col("length"), "rodape_ilegivel")
    )
    return told.select(F.col("path").alias("arquivo"), reason.alias("motivo")).where("motivo is not null")


def flatten_record(df: DataFrame, depth: int = 2, separator: str = ".") -> DataFrame:
    """Nested fields as dotted columns to a depth; anything deeper as compact JSON text."""
    columns: list[Column] = []

    def visit(field: T.StructField, source: Column, name: str, level: int) -> None:
        if isinstance(field.dataType, T.StructType) and level < depth:
            for child in field.dataType.fields:
                visit(child, source.getField(child.name), f"{name}{separator}{child.name}", level + 1)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            columns.append(F.to_json(source).alias(name))
        else:
            columns.append(source.alias(name))

    for f in df.schema.fields:
        visit(f, F.col(f"`{f.name}`"), f.name, 0)
    return df.select(*columns)

"""Delimited files unioned when they carry the same set of headers."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DELIMITERS = ";,|\t"
# The two single-byte encodings differ in bytes 80 to 9F: control characters in the one that Spark reads, letters and quotes in the other.
_CONTROLS = "".join(map(chr, range(0x80, 0xA0)))
_LETTERS = bytes(range(0x80, 0xA0)).decode("windows-1252", "replace")


def sniff(header: str) -> str:
    """The delimiter splitting the header into most columns."""
    return max(DELIMITERS, key=header.count)


def clean_header(name: str) -> str:
    return name.replace("﻿", "").strip().strip('"').strip()


def likely_encoding(lines: Sequence[bytes]) -> str:
    """The encoding in which the lines read best: UTF-8 if they are valid in it, else one of the two western single-byte ones."""
    text = b"\n".join(lines)
    try:
        text.decode("utf-8")
        return "UTF-8"
    except UnicodeDecodeError:
        # Bytes 80 to 9F are letters and quotes in the one, control characters in the other.
        return "windows-1252" if any(0x80 <= c <= 0x9F for c in text) else "ISO-8859-1"


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The header and encoding of a file, from the first batch of its first range; the rest is not read."""
    for batch in batches:
        if not batch.num_rows:
            continue
        if batch.column(2)[0].as_py() == 0:
            lines = [x or b"" for x in batch.column(0).to_pylist()]
            encoding = likely_encoding(lines)
            header = lines[0].decode(encoding, "replace").rstrip("\r")
            yield pa.RecordBatch.from_pydict({"path": [batch.column(1)[0].as_py()], "header": [header], "encoding": [encoding]})
        return


def probe_headers(spark: SparkSession, files: Sequence[str], encoding: str | None = None) -> dict[str, tuple[str, tuple[str, ...], str]]:
    """file -> (delimiter, column names, encoding), by one job over all files.

    Each task has one range of one file and stops after its first batch of lines; only those of
    first ranges tell anything.  Files without a line have one empty column.
    """
    size, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(size), spark.conf.get(cost)
    rows = spark.read.text(list(files)).select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    try:
        spark.conf.set(cost, before[0])  # as dear as a whole range, so that ranges aren't put together
        found = rows.mapInArrow(_look, "path string, header string, encoding string").collect()
    finally:
        spark.conf.set(cost, before[1])
    out = {}
    for row in found:
        delimiter = sniff(row.header)
        out[unquote(row.path)] = (delimiter, tuple(clean_header(c) for c in row.header.split(delimiter)), encoding or row.encoding)
    return out


def read_delimited_grouped(spark: SparkSession, files: Sequence[str], encoding: str | None = None, lineage: bool = False) -> dict[tuple[str, ...], DataFrame]:
    """One frame per set of upper-cased headers, whatever their order in each file.

    Files sharing delimiter, encoding (found by their first lines unless given) and exact header
    are read together; short rows are padded with '' and blank rows dropped.
    """
    variants: dict[tuple, list[str]] = defaultdict(list)
    for path, (delimiter, names, read_as) in probe_headers(spark, files, encoding).items():
        variants[(tuple(sorted(n.upper() for n in names)), delimiter, names, read_as)].append(path)
    groups: dict[tuple[str, ...], list[DataFrame]] = defaultdict(list)
    for (key, delimiter, names, read_as), paths in variants.items():
        schema = ", ".join(f"`{n.upper()}` string" for n in names)
        charset = "ISO-8859-1" if read_as == "windows-1252" else read_as
        df = spark.read.schema(schema).options(sep=delimiter, header="true", encoding=charset, mode="PERMISSIVE", enforceSchema="true").csv(paths)
        turned = [F.translate(F.col(f"`{n}`"), _CONTROLS, _LETTERS) if read_as == "windows-1252" else F.col(f"`{n}`") for n in df.columns]
        columns = [F.coalesce(c, F.lit("")).alias(n) for c, n in zip(turned, df.columns, strict=True)]
        source = [F.col("_metadata.file_name").alias("_fonte_arquivo")] if lineage else []
        rows = df.select(*columns, *source)
        filled = reduce(lambda a, b: a | b, [F.trim(f"`{n}`") != "" for n in df.columns])
        groups[key].append(rows.filter(filled))
    return {key: reduce(DataFrame.unionByName, parts) for key, parts in groups.items()}


def group_manifest(groups: dict[tuple[str, ...], DataFrame]) -> DataFrame:
    """Rows per header group."""
    parts = [
        df.groupBy().agg(F.count(F.lit(1)).alias("qtd_linhas")).select(F.lit(i).alias("grupo_id"), F.lit(",".join(key)).alias("campos"), "qtd_linhas")
        for i, (key, df) in enumerate(sorted(groups.items()), 1)
    ]
    return reduce(DataFrame.unionByName, parts)

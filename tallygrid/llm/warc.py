"""WARC archives by way of a chunked record table.

Writing: payloads are hashed piece by piece; digests that several records share name one response
(the smallest id), the others become revisits without a payload.  Each record leaves its task as
rows of (record, chunk number): a payload of over `chunk_bytes` is a response whose block is its
first chunk, and continuation records (WARC-Segment-Number) with the others, each with the digest
of the payload so far.  Rows are views of the input batch, written one after the other by
Spark's own text writer and committer, so that any Hadoop store serves, a lost task leaves
nothing behind, and no task ever builds a whole record.

Reading: archives are split at the version line (a payload that holds it is cut inside, so no
block contains it) into the chunk table.  Chunks are dealt by record and streamed in order; a
running hash per record is compared with each chunk's digest, so `intact` tells a damaged record.
Only chunks of oversized records carry their bytes through the shuffle.

A null payload is an empty one.  Null ids are written without `Page-ID` and are never the response
that others refer to; rows that repeat both id and payload share their role (all responses, or all
revisits).  An empty table gives an empty archive.  Carriage returns and line feeds of ids and urls
are percent-encoded in headers.  Other columns don't matter.  The archive's files are gzip'd whole
(one member a file), with Spark's names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import clear_scratch, materialize

# The format's version line, end of a record, and media types.
VERSION = b"WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INSIDE = re.compile(rb"WARC/1\.1(?=\r\n|\Z)")
_BATCH = 8 << 20


def _view(value: pa.Scalar) -> memoryview:
    return memoryview(value.as_buffer()) if value.is_valid else memoryview(b"")


def pieces(payload: memoryview, size: int) -> Iterator[memoryview]:
    """Views of at most `size` bytes that neither hold the version line nor end in one without its line end."""
    breaks = [m.start() + 1 for m in _INSIDE.finditer(payload)] + [len(payload)]
    start = 0
    for stop in breaks:
        while stop - start > size:
            end = start + size
            if payload[max(start, end - 8) : end] == b"WARC/1.1":
                end -= 7
            yield payload[start:end]
            start = end
        if stop > start or stop == 0:
            yield payload[start:stop]
        start = stop


def payload_digest(size: int) -> object:
    """An Arrow function: byte count and SHA-256 of a payload, taken in pieces."""

    @F.arrow_udf(returnType=T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("sha256", T.StringType())]))
    def digest(payloads: pa.Array) -> pa.Array:
        counts, hashes = [], []
        for value in payloads:
            view, running = _view(value), hashlib.sha256()
            for at in range(0, len(view), size):
                running.update(view[at : at + size])
            counts.append(len(view))
            hashes.append(running.hexdigest())
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(hashes, pa.string())], ["n_bytes", "sha256"])

    return digest


def revisits(keys: DataFrame, min_bytes: int) -> DataFrame:
    """(id, sha256, head) of records whose payload a record of smaller id has."""
    heads = keys.where(F.col("n_bytes") >= min_bytes).groupBy("sha256").agg(F.min("id").alias("head"), F.count("*").alias("n")).where("n > 1 and head is not null")
    return keys.join(heads, "sha256").where("id is null or id > head").select("id", "sha256", "head").distinct()


def record_id(page: str | None, sha256: str, chunk: int = 1) -> str:
    named = f"{'' if page is None else '=' + page}:{sha256}" + (f":{chunk}" if chunk > 1 else "")
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(named.encode()).digest())}>"


def _safe(text: str) -> str:
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if re.search(r"[%\r\n]", text) else text


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in fields if value is not None]
    return VERSION + "".join(lines).encode() + b"\r\n"


def chunk_records(page: str | None, url: str | None, payload: memoryview, sha256: str, head: str | None, size: int, date: str) -> Iterator[bytes]:
    """The WARC records of a payload, chunk by chunk, without the record end."""
    own = record_id(page, sha256)
    http = (HTTP % len(payload)).encode()
    common = [("WARC-Date", date), ("WARC-Target-URI", None if url is None else _safe(url)), ("Page-ID", None if page is None else _safe(page))]
    digest = ("WARC-Payload-Digest", f"sha256:{sha256}")
    kind = ("Content-Type", "application/http; msgtype=response")
    if head is not None:
        told = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(head, sha256)), digest, kind]
        yield _header([*told, ("Content-Length", len(http))]) + http
        return
    running, number, whole = hashlib.sha256(), 0, len(payload)
    sent = 0
    for piece in pieces(payload, size):
        number, sent = number + 1, sent + len(piece)
        first, last = number == 1, sent == whole
        so_far: list[tuple[str, object]] = []
        if not (first and last):
            running.update(piece)
            so_far = [("WARC-Segment-Number", number), ("Digest-So-Far", f"sha256:{running.hexdigest()}")]
        if first:
            yield _header([("WARC-Type", "response"), ("WARC-Record-ID", own), *common, digest, kind, *so_far, ("Content-Length", len(http) + len(piece))]) + http + piece
        else:
            told = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(page, sha256, number)), common[0], ("WARC-Segment-Origin-ID", own), *so_far]
            yield _header([*told, ("WARC-Segment-Total-Length", whole + len(http) if last else None), ("Content-Length", len(piece))]) + piece


def write(pages: DataFrame, path: str, page: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 100, chunk_bytes: int = 1 << 20, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write a record per row below `path`; payloads of `min_bytes` or more that repeat become revisits."""
    digest = payload_digest(chunk_bytes)
    bare = pages.select(F.col(page).alias("id"), F.col(url).cast("string").alias("url"), F.col(payload).cast("string").alias("payload"))
    hashed = bare.withColumn("d", digest(F.col("payload"))).select("id", "url", "payload", "d.*")
    keys = materialize(bare.select("id", digest(F.col("payload")).alias("d")).select("id", "d.*"), "warc-keys")
    again = materialize(revisits(keys, min_bytes), "warc-revisits")
    same = hashed["id"].eqNullSafe(again["id"]) & (hashed["sha256"] == again["sha256"])
    told = hashed.join(again, same, "left").select(hashed["id"].cast("string"), "url", "payload", hashed["sha256"], F.col("head").cast("string"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for i in range(batch.num_rows):
                ident, link, sha256, head = (batch.column(k)[i].as_py() for k in (0, 1, 3, 4))
                for record in chunk_records(ident, link, _view(batch.column(2)[i]), sha256, head, chunk_bytes, date):
                    out.append(record)
                    held += len(record)
                    if held >= _BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = told.mapInArrow(chunks, "value binary").select(F.col("value").cast("string"))
    rows.write.option("lineSep", END).option("compression", "gzip").text(path)
    clear_scratch(pages.sparkSession, keys, again)


CHUNKS = (
    "record string, chunk int, last boolean, record_type string, page string, url string, refers_record string, "
    "claimed string, so_far string, n_bytes long, sha256 string, data binary, sound boolean"
)
_CHUNKS = pa.schema([
    ("record", pa.string()), ("chunk", pa.int32()), ("last", pa.bool_()), ("record_type", pa.string()), ("page", pa.string()), ("url", pa.string()),
    ("refers_record", pa.string()), ("claimed", pa.string()), ("so_far", pa.string()), ("n_bytes", pa.int64()), ("sha256", pa.string()),
    ("data", pa.binary()), ("sound", pa.bool_()),
])


def _unsafe(text: str | None) -> str | None:
    return None if text is None else text.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")


def parse(record: memoryview) -> dict:
    """A row of the chunk table from what follows a version line."""
    at = re.search(rb"\r\n\r\n", record)
    if at is None:
        return {"record": None, "chunk": 1, "last": True, "record_type": "damaged", "n_bytes": 0, "sound": False}
    named = dict(line.split(": ", 1) for line in bytes(record[: at.start()]).decode().split("\r\n") if ": " in line)
    length, kind = int(named.get("Content-Length", 0)), named.get("WARC-Type")
    block = record[at.end() : at.end() + length]
    sound, first = len(block) == length, kind != "continuation"
    if first and (inner := re.search(rb"\r\n\r\n", block)):
        block = block[inner.end() :]
    segmented = "WARC-Segment-Number" in named
    return {
        "record": named.get("WARC-Record-ID") if first else named.get("WARC-Segment-Origin-ID"),
        "chunk": int(named.get("WARC-Segment-Number", 1)), "last": not segmented or "WARC-Segment-Total-Length" in named, "record_type": kind,
        "page": _unsafe(named.get("Page-ID")), "url": _unsafe(named.get("WARC-Target-URI")), "refers_record": named.get("WARC-Refers-To"),
        "claimed": named.get("WARC-Payload-Digest", "").removeprefix("sha256:") or None, "so_far": named.get("Digest-So-Far", "").removeprefix("sha256:") or None,
        "n_bytes": len(block), "sha256": None if segmented else hashlib.sha256(block).hexdigest(), "data": bytes(block) if segmented else None, "sound": sound,
    }


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of archives: a row per record and chunk number; bytes only where a record has several chunks."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for value in batch.column(0):
                out.append(parse(_view(value)))
                held += len(out[-1].get("data") or b"")
                if held >= _BATCH:
                    yield pa.RecordBatch.from_pylist(out, _CHUNKS)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, _CHUNKS)

    raw = spark.read.schema("value string").option("lineSep", VERSION.decode()).text(path)
    return raw.where("value <> ''").select(F.col("value").cast("binary")).mapInArrow(parsed, CHUNKS)


_RECORDS = pa.schema([
    ("record", pa.string()), ("record_type", pa.string()), ("page", pa.string()), ("url", pa.string()), ("refers_record", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("claimed", pa.string()), ("intact", pa.bool_()),
])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of chunks that come sorted by record and chunk number; one running hash, no bytes kept."""
    now: dict = {"record": None, "chunk": 0}
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["sha256"] is not None or row["record"] is None:  # whole in one chunk
                sound = row["sound"] and (row["record_type"] == "revisit" or row["sha256"] == row["claimed"])
                out.append({**row, "payload_bytes": row["n_bytes"], "payload_digest": row["sha256"], "intact": sound})
                continue
            if row["record"] != now["record"] or row["chunk"] == 1 != now["chunk"]:
                now = {**row, "chunk": 0, "hash": hashlib.sha256(), "n": 0, "ok": row["chunk"] == 1}
            if row["chunk"] != now["chunk"]:  # else a repeated row's copy of the same chunk
                now["hash"].update(row["data"])
                now["n"] += row["n_bytes"]
                now["ok"] = now["ok"] and row["sound"] and row["chunk"] == now["chunk"] + 1 and now["hash"].hexdigest() == row["so_far"]
                now["chunk"] = row["chunk"]
            if row["last"]:
                digest = now["hash"].hexdigest()
                out.append({**now, "payload_bytes": now["n"], "payload_digest": digest, "intact": now["ok"] and digest == now["claimed"]})
        if out:
            yield pa.RecordBatch.from_pylist([{k: r.get(k) for k in _RECORDS.names} for r in out], _RECORDS)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per record: record, record_type, page, url, payload_bytes, payload_digest, refers_to, intact.

    A revisit has its response's size and digest; it is intact if that is and has the digest claimed.
    """
    kinds = "record string, record_type string, page string, url string, refers_record string, payload_bytes long, payload_digest string, claimed string, intact boolean"
    records = read_chunks(spark, path).repartition("record").sortWithinPartitions("record", "chunk").mapInArrow(_stream, kinds)
    records = materialize(records, "warc-records")
    heads = records.where("record_type = 'response'").select(
        F.col("record").alias("refers_record"), F.col("page").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"), F.col("intact").alias("_intact"),
    ).dropDuplicates(["refers_record"])
    shown = ["record", "record_type", "page", "url", "payload_bytes", "payload_digest", "refers_to", "intact"]
    own = records.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("string")).select(*shown)
    # Records without a reference stay out of the join, where their null keys would meet in one task.
    again = records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(heads, "refers_record", "left")
    again = again.withColumns({
        "payload_bytes": F.col("_bytes"), "payload_digest": F.col("_digest"),
        "intact": F.coalesce(F.col("intact") & F.col("_intact") & (F.col("_digest") == F.col("claimed")), F.lit(False)),
    })
    return own.unionByName(again.select(*shown))

"""Quality classifier: nearest neighbours among labelled latent-semantic vectors.

1. Texts become counts of hashed byte trigrams (case and symbols kept) and of words that
   repeat the word before, damped to log(1 + n).
2. Document frequencies are counted over all documents.
3. Up to `max_labelled` labelled documents (the bound of everything that is collected or
   broadcast; taken by a hash of the id, so evenly) are the sample that the model is fitted
   on: their tf-idf rows are reduced to `rank` latent dimensions by a randomised SVD.
4. Sample vectors and projection are broadcast.  For every document, blocks of cosine
   products with all sample vectors give the `neighbours` nearest, exactly; their labels are
   weighted by a power of the similarity, and the prior counts like one faint neighbour.

Labels, language, source and id are never features.  Null and empty texts have no trigram:
their score is the prior.  Labels on unknown ids don't matter; an id labelled twice counts as
bad if any label says so.  Without labels every score is 0.5.  Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASHED = 1 << 12
WIDTH = HASHED + 1  # the last bin counts words that repeat the word before
REPEAT_WEIGHT = 3.0
_U = np.uint32


def trigram_bins(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all byte trigrams of the texts, and the number of the text of each."""
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    if len(data) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = data[:-2] | (data[1:-1] << _U(8)) | (data[2:] << _U(16))
    bins = ((code * _U(0x9E3779B1)) >> _U(20)).astype(np.int64)
    inside = owner[:-2] == owner[2:]
    return bins[inside], owner[:-2][inside]


def damped_counts(texts: list[bytes]) -> np.ndarray:
    """A row of log(1 + count) for each text."""
    bins, owner = trigram_bins(texts)
    counts = np.bincount(owner * WIDTH + bins, minlength=len(texts) * WIDTH).reshape(len(texts), WIDTH).astype(np.float32)
    for i, text in enumerate(texts):
        words = text.split()
        counts[i, HASHED] = sum(map(eq, words, islice(words, 1, None)))
    np.log1p(counts, out=counts)
    counts[:, HASHED] *= REPEAT_WEIGHT
    return counts


def _blocks(texts: list[str | None], rows: int = 512, most: int = 2_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts: at most `rows`, of `most` bytes in all or one longer."""
    start, size, block = 0, 0, []
    for i, t in enumerate(texts):
        data = (t or "").encode("utf-8", "surrogatepass")
        if block and (len(block) == rows or size + len(data) > most):
            yield start, block
            start, size, block = i, 0, []
        block.append(data)
        size += len(data)
    if block:
        yield start, block


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, rows = np.zeros(WIDTH, np.int64), 0
    for batch in batches:
        for _, block in _blocks(batch.column(0).to_pylist()):
            seen += (damped_counts(block) > 0).sum(0)
            rows += len(block)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, WIDTH)), pa.array(np.append(rows, seen))], ["bin", "n"])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per bin and in all, over the whole table."""
    rows = docs.select("text").mapInArrow(_frequencies, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    seen, total = np.zeros(WIDTH, np.int64), 0
    for r in rows:
        if r["bin"] < 0:
            total = r["n"]
        else:
            seen[r["bin"]] = r["n"]
    return seen, total


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray  # bins x rank
    vectors: np.ndarray  # sample x rank, unit length
    labels: np.ndarray
    prior: float
    neighbours: int
    power: float

    def project(self, block: list[bytes]) -> np.ndarray:
        flat = (damped_counts(block) * self.idf) @ self.axes
        return flat / np.maximum(np.linalg.norm(flat, axis=1, keepdims=True), 1e-9)

    def score(self, block: list[bytes]) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(block), self.prior)
        near = self.project(block) @ self.vectors.T
        k = min(self.neighbours, near.shape[1])
        at = np.argpartition(near, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(near, at, 1), 0).astype(np.float64) ** self.power
        faint = 1e-3
        return ((weight * self.labels[at]).sum(1) + faint * self.prior) / (weight.sum(1) + faint)


def latent_axes(rows: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors by subspace iteration (fixed seed)."""
    start = np.random.default_rng(7).standard_normal((rows.shape[1], rank + 16)).astype(np.float32)
    base = start
    for _ in range(rounds):
        base, _ = np.linalg.qr(rows.T @ (rows @ base))
    _, _, turn = np.linalg.svd(rows @ base, full_matrices=False)
    return np.ascontiguousarray((base @ turn.T)[:, :rank].astype(np.float32))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 8192, rank: int = 64, neighbours: int = 15, power: float = 30.0) -> Model:
    """Fit on labelled documents: labels (doc_id, quality) of which at most `max_labelled` are used."""
    seen, total = document_frequencies(docs)
    idf = (np.log((1 + total) / (1 + seen)) + 0.1).astype(np.float32)
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)  # at most max_labelled narrow rows: bounded for broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    got = found.select("quality", _packed(F.col("text")).alias("counts")).collect()
    if not got:
        return Model(idf, np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5, neighbours, power)
    rows = np.zeros((len(got), WIDTH), np.float32)
    for i, r in enumerate(got):
        pairs = np.frombuffer(r["counts"], np.dtype([("bin", "<u2"), ("value", "<f4")]))
        rows[i, pairs["bin"]] = pairs["value"]
    rows *= idf
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    quality = np.array([float(r["quality"] > 0) for r in got])
    axes = latent_axes(rows, min(rank, len(got)))
    flat = rows @ axes
    vectors = (flat / np.maximum(np.linalg.norm(flat, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    return Model(idf, axes, vectors, quality, float(quality.mean()), neighbours, power)


@F.arrow_udf(returnType=T.BinaryType())
def _packed(texts: pa.Array) -> pa.Array:
    """The non-zero damped counts of each text, packed."""
    out = []
    for _, block in _blocks(texts.to_pylist()):
        for row in damped_counts(block):
            at = np.flatnonzero(row)
            pairs = np.empty(len(at), np.dtype([("bin", "<u2"), ("value", "<f4")]))
            pairs["bin"], pairs["value"] = at, row[at]
            out.append(pairs.tobytes())
    return pa.array(out, pa.binary())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with `score`, from the text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(returnType=T.DoubleType())
    def run(texts: pa.Array) -> pa.Array:
        values = [sent.value.score(block) for _, block in _blocks(texts.to_pylist())]
        return pa.array(np.concatenate(values) if values else np.empty(0), pa.float64())

    return docs.withColumn("score", run.asNondeterministic()(F.col("text")))


def split_and_score(docs: DataFrame, labels: DataFrame, held_out: Column, **parameters) -> DataFrame:
    """Fit on labels of rows that aren't held out; (doc_id, held_out, score) of all documents."""
    learnt = labels.where(~F.coalesce(held_out, F.lit(False)))
    flagged = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return score(flagged, fit(docs, learnt, **parameters)).drop("text")

"""Language ID: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; everything that isn't a letter becomes one space; n-grams of two and
three characters are hashed into bins.  Tasks count bins per language over all learning rows
and Spark adds the counts up.  The matrix of log probabilities has the same bins whatever the
number of languages; it is broadcast in blocks of languages of at most `MATRIX_BYTES` each.
Scoring gathers the matrix columns of a batch's n-grams and adds them up by text; a block gives
its best language and the sum of its likelihoods, from which the posterior follows exactly.

The score is the posterior of the predicted language.  A null text, or one without a letter,
is `und` with score 0, as is every text if nothing could be learnt.  Ties go to the language that comes
first by name.  Null languages are not learnt from.  Repeated rows count and are predicted each; long
texts are read whole; an empty table gives one.  Extra columns stay, own columns `lang_pred` and
`score` give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

BINS = 1 << 14
MATRIX_BYTES = 64 << 20
_SPACE = 32
_LETTER = np.array([chr(i).isalpha() for i in range(0x10000)])
_U = np.uint32


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each between spaces and without anything but letters, and the text of each."""
    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = np.where(points < 0x10000, _LETTER[np.minimum(points, 0xFFFF)], True)
    points = np.where(letter, points, _SPACE).astype(np.uint32)
    stays = letter | np.concatenate([[True], letter[:-1]])  # one space for a run of other characters
    return points[stays], owner[stays]


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all n-grams of the texts, and the number of the text of each."""
    points, owner = _letters(texts)
    two = (points[:-1] * _U(0x9E3779B1)) ^ (points[1:] * _U(0x85EBCA77))
    three = two[:-1] * _U(0xC2B2AE3D) + points[2:] * _U(0x27D4EB2F)
    bins = [((x ^ (x >> _U(15))) * _U(0x2C1B3C6D) >> _U(16)) & _U(BINS - 1) for x in (two, three)]
    inside = [owner[:-1] == owner[1:], owner[:-2] == owner[2:]]
    some = [points[:-1] != points[1:], (points[:-2] != _SPACE) | (points[1:-1] != _SPACE)]
    use = [a & b for a, b in zip(inside, some, strict=True)]
    return np.concatenate([b[u] for b, u in zip(bins, use, strict=True)]).astype(np.int64), np.concatenate([owner[:-1][use[0]], owner[:-2][use[1]]])


def _chunks(texts: list[str], most: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, texts[start:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bin, n) of a task's rows; n-gram counts, and the rows themselves under bin -1."""
    held: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}

    def flush() -> pa.RecordBatch:
        langs, bins, counts = [], [], []
        for lang, n in held.items():
            at = np.flatnonzero(n)
            langs += [lang] * (len(at) + 1)
            bins.append(np.append(at, -1))
            counts.append(np.append(n[at], rows[lang]))
        held.clear()
        rows.clear()
        values = [pa.array(langs, pa.string()), pa.array(np.concatenate(bins), pa.int64()), pa.array(np.concatenate(counts), pa.int64())]
        return pa.RecordBatch.from_arrays(values, ["lang", "bin", "n"])

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for lang in dict.fromkeys(langs):
            own = [texts[i] for i in np.flatnonzero(langs == lang)]
            rows[lang] = rows.get(lang, 0) + len(own)
            total = held.setdefault(lang, np.zeros(BINS, np.int64))
            for _, chunk in _chunks(own):
                total += np.bincount(hashed(chunk)[0], minlength=BINS)
        if len(held) > 256:
            yield flush()
    if held:
        yield flush()


class Model:
    """Languages of a block and their matrix (bins x languages) of log probabilities; log priors among all `total` rows."""

    def __init__(self, langs: list[str], counts: np.ndarray, rows: np.ndarray, total: int | None = None, smoothing: float = 0.5):
        self.langs = langs
        share = (counts + smoothing) / (counts + smoothing).sum(1, keepdims=True)
        self.logs = np.ascontiguousarray(np.log(share).T.astype(np.float32))
        self.prior = np.log(rows / (total or rows.sum()))

    def predict(self, texts: list[str | None]) -> tuple[list[str | None], list[float | None], list[float | None]]:
        """The best language of each text, its log likelihood, and the log of the sum over the languages; null without a letter."""
        best, top, every = ([None] * len(texts) for _ in range(3))
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        for start, chunk in _chunks([texts[i] for i in known]):
            bins, owner = hashed(chunk)
            order = np.argsort(owner, kind="stable")
            bins, owner = bins[order], owner[order]
            total = np.tile(self.prior, (len(chunk), 1))
            firsts = np.flatnonzero(np.diff(owner, prepend=-1))
            for column in range(len(self.langs)):
                total[owner[firsts], column] += np.add.reduceat(self.logs[bins, column], firsts, dtype=np.float64) if len(firsts) else 0
            first = total.argmax(1)
            most = total.max(1)
            summed = most + np.log(np.exp(total - most[:, None]).sum(1))
            for k in range(len(chunk)):
                best[known[start + k]], top[known[start + k]], every[known[start + k]] = self.langs[first[k]], float(most[k]), float(summed[k])
        return best, top, every


def learn(docs: DataFrame, matrix_bytes: int = MATRIX_BYTES) -> list[Model]:
    """Learn from all rows of (lang, text) with a language; one bounded matrix at a time reaches the driver."""
    rows = docs.where("lang is not null").select("lang", "text")
    counted = rows.mapInArrow(_count, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "language-counts")
    seen = {r["lang"]: r["n"] for r in counted.where("bin = -1").collect()}
    langs, total = sorted(seen), sum(seen.values())
    size = max(matrix_bytes // (4 * BINS), 1)
    models = []
    for i in range(0, len(langs), size):
        block = langs[i : i + size]
        found = counted.where((F.col("bin") >= 0) & F.col("lang").between(block[0], block[-1])).toPandas()
        counts = np.zeros((len(block), BINS), np.int64)
        counts[found["lang"].map({v: k for k, v in enumerate(block)}).to_numpy(np.int64), found["bin"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
        models.append(Model(block, counts, np.array([seen[v] for v in block]), total))
    return models


_OUT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("top", T.DoubleType()), T.StructField("every", T.DoubleType())])


def _predictor(docs: DataFrame, model: Model):  # noqa: ANN202
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(returnType=_OUT)
    def run(texts: pa.Array) -> pa.Array:
        best, top, every = sent.value.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(top, pa.float64()), pa.array(every, pa.float64())], ["lang", "top", "every"])

    return run.asNondeterministic()


def predict(docs: DataFrame, models: list[Model]) -> DataFrame:
    """The documents with `lang_pred` and `score`, from the text alone."""
    own = [c for c in docs.columns if c not in ("lang_pred", "score", "_out")]
    if not models:
        return docs.select(*own, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    blocks = F.array(*[_predictor(docs, m)(F.col("text")) for m in models])
    first = F.array_min(F.transform("_out", lambda b: F.struct((-b["top"]).alias("lost"), b["lang"].alias("lang"))))
    others = F.aggregate("_out", F.lit(0.0), lambda s, b: s + F.exp(b["every"] + first["lost"]))
    out = docs.select(*own, blocks.alias("_out"))
    return out.select(*own, F.coalesce(first["lang"], F.lit("und")).alias("lang_pred"), F.coalesce(F.least(1 / others, F.lit(1.0)), F.lit(0.0)).alias("score"))


def split_and_predict(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learn from rows that aren't held out, predict all."""
    flagged = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return predict(flagged.select("doc_id", "held_out", "text"), learn(flagged.where("not held_out"))).drop("text")

"""KMeans over token sets for a whole range of k in the same passes.

Rows with the same tokens are one weighted point.  A pass over the points assigns each to its
nearest centre under every k at once and adds up weights by (k, cluster, token); counts are whole
numbers, so the sums, and with them the centres, don't depend on how points are partitioned.
Starts are warm: beginning with one centre, a pass at a time splits the cluster of the largest cost,
whose costliest point (weight times distance; the largest token numbers of equal ones) becomes the new
centre, which gives starting centres for every k.  The driver holds the centres, their sums and a
point for each: (low + ... + high) x width numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_SUMS = "model int, cluster int, token int, s double, numbers array<int>"
_WEIGHT, _COST, _FARTHEST = -1, -2, -3


def token_numbers(tokens: str, width: int):
    """The hashed numbers of an array of tokens, ascending (as `HashingTF` numbers them)."""
    return F.array_sort(F.transform(tokens, lambda t: F.pmod(F.hash(t), F.lit(width))))


def points(rows: DataFrame, numbers: str = "numbers") -> DataFrame:
    """(numbers, weight): the distinct token sets, written to the shared folder."""
    return materialize(rows.groupBy(F.col(numbers).alias("numbers")).agg(F.count(F.lit(1)).alias("weight")), "kmeans-points")


def _padded(numbers: Sequence, width: int) -> np.ndarray:
    """One row per point; `width` (a column of zeros) fills up."""
    longest = max((len(x) for x in numbers), default=0)
    out = np.full((len(numbers), max(longest, 1)), width)
    for i, x in enumerate(numbers):
        out[i, : len(x)] = x
    return out


def distances(at: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points (padded token numbers) to centres (clusters x width)."""
    wide = np.hstack([centres, np.zeros((len(centres), 1))])
    dot = sum(wide[:, at[:, t]] for t in range(at.shape[1]))
    square = (at < centres.shape[1]).sum(axis=1).astype(float)
    for gap in range(1, at.shape[1]):  # a number held r times counts r squared
        square += 2 * ((at[:, gap:] == at[:, :-gap]) & (at[:, gap:] < centres.shape[1])).sum(axis=1)
    return square[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * dot.T


def _pass(spark_points: DataFrame, models: list[np.ndarray], width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, list]]:
    """Per model: token sums (clusters x width), weights, costs and costliest points by cluster."""
    shared = spark_points.sparkSession.sparkContext.broadcast(models)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres = shared.value
        sums = [np.zeros((len(c), width + 1)) for c in centres]
        weight, cost = [np.zeros(len(c)) for c in centres], [np.zeros(len(c)) for c in centres]
        far_off: dict[tuple[int, int], tuple[float, list[int]]] = {}
        for batch in batches:
            at, w = _padded(batch["numbers"].tolist(), width), batch["weight"].to_numpy(float)
            for m, c in enumerate(centres):
                far = distances(at, c)
                near = far.argmin(axis=1)
                for t in range(at.shape[1]):
                    np.add.at(sums[m], (near, at[:, t]), w)
                np.add.at(weight[m], near, w)
                own = w * np.maximum(far[np.arange(len(near)), near], 0)
                np.add.at(cost[m], near, own)
                for cluster in np.unique(near):
                    worst = np.flatnonzero((near == cluster) & (own == own[near == cluster].max()))
                    best = max((float(own[i]), [int(x) for x in batch["numbers"].iloc[i]]) for i in worst)
                    far_off[m, int(cluster)] = max(far_off.get((m, int(cluster)), best), best)
        for m in range(len(centres)):
            cluster, token = np.nonzero(sums[m][:, :width])
            whole = np.arange(len(weight[m]))
            yield pd.DataFrame([(*k, _FARTHEST, *v) for k, v in far_off.items() if k[0] == m], columns=["model", "cluster", "token", "s", "numbers"])
            yield pd.DataFrame({
                "model": m, "cluster": np.concatenate([cluster, whole, whole]),
                "token": np.concatenate([token, np.full(len(whole), _WEIGHT), np.full(len(whole), _COST)]),
                "s": np.concatenate([sums[m][cluster, token], weight[m], cost[m]]), "numbers": None,
            })

    parts = spark_points.mapInPandas(add, _SUMS).groupBy("model", "cluster", "token")
    found = parts.agg(F.sum("s").alias("s"), F.max(F.struct("s", "numbers"))["numbers"].alias("numbers")).toPandas()
    shared.unpersist()
    out = []
    for m, c in enumerate(models):
        own = found[found["model"] == m]
        sums, rest = np.zeros((len(c), width)), {}
        tokens = own[own["token"] >= 0]
        sums[tokens["cluster"], tokens["token"]] = tokens["s"]
        for kind in (_WEIGHT, _COST):
            rest[kind] = np.zeros(len(c))
            part = own[own["token"] == kind]
            rest[kind][part["cluster"]] = part["s"]
        worst = own[own["token"] == _FARTHEST]
        out.append((sums, rest[_WEIGHT], rest[_COST], dict(zip(worst["cluster"], worst["numbers"], strict=True))))
    return out


def _moved(centres: np.ndarray, sums: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Means of the clusters; an empty cluster keeps its centre."""
    return np.where(weight[:, None] > 0, sums / np.maximum(weight, 1)[:, None], centres)


def split_widest(centres: np.ndarray, cost: np.ndarray, worst: dict) -> np.ndarray:
    """One centre more: the costliest point of the costliest cluster."""
    new = np.zeros((1, centres.shape[1]))
    np.add.at(new[0], np.asarray(worst.get(int(cost.argmax()), []), int), 1)
    return np.vstack([centres, new])


def sweep(spark_points: DataFrame, low: int, high: int, width: int, max_iter: int = 20) -> tuple[dict[int, np.ndarray], list[tuple[int, float]]]:
    """Centres and cost for each k from `low` to `high`."""
    centres, starts = np.zeros((1, width)), {}
    for k in range(1, high + 1):
        ((sums, weight, _, _),) = _pass(spark_points, [centres], width)
        centres = _moved(centres, sums, weight)
        if k >= low:
            starts[k] = centres
        if k < high:
            ((_, _, cost, worst),) = _pass(spark_points, [centres], width)
            centres = split_widest(centres, cost, worst)
    models, costs = starts, {}
    going = list(models)
    for _ in range(max_iter):
        held = dict(zip(going, _pass(spark_points, [models[k] for k in going], width), strict=True))
        fresh = {k: _moved(models[k], sums, weight) for k, (sums, weight, _, _) in held.items()}
        costs |= {k: float(cost.sum()) for k, (_, _, cost, _) in held.items()}
        still = [k for k in going if not np.array_equal(fresh[k], models[k])]
        models |= fresh
        going = still
        if not going:
            break
    if going:
        last = _pass(spark_points, [models[k] for k in going], width)
        costs |= {k: float(cost.sum()) for k, (_, _, cost, _) in zip(going, last, strict=True)}
    return models, sorted(costs.items())


def nearest(centres: np.ndarray):
    """A function of a numbers column: the nearest centre, the first of equal ones."""
    width = centres.shape[1]

    @F.pandas_udf(T.IntegerType())
    def assign(numbers: pd.Series) -> pd.Series:
        return pd.Series(distances(_padded(numbers.tolist(), width), centres).argmin(axis=1).astype("int32"))

    return assign

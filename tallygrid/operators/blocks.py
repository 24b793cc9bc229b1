"""Sums of products over a shared key, multiplied block by block.

Joining two tables on a key and adding up products makes (rows of a key) x (rows of a key) rows for
every key before the sum.  Here keys are dealt into blocks; a task gets both sides of a block, lays
them out as matrices (keys x rows, keys x columns) and multiplies, so the sum over the keys of a block
is done before any row exists.  Spark then adds the blocks' partial sums.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .core import with_totals

_CELLS = 2_000_000


def _codes(frame: pd.DataFrame, names: Sequence[str]) -> tuple[np.ndarray, pd.DataFrame]:
    """A number for each row's values, and the values by number."""
    number = frame.groupby(list(names), sort=False, dropna=False).ngroup().to_numpy()
    first = np.unique(number, return_index=True)[1]
    return number, frame.iloc[first][list(names)].reset_index(drop=True)


def _leading(cells: np.ndarray, top: int) -> np.ndarray:
    """Where a column's cells are filled and may be among its `top` largest at six decimals."""
    filled = cells != 0
    if len(cells) <= top:
        return filled
    least = np.partition(cells, -top, axis=0)[-top]
    return filled & (cells >= least - 2e-6 - 1e-9 * np.abs(least))


def _multiply(inner: str, scope: Sequence[str], rows: Sequence[str], columns: Sequence[str], out: str, schema: Sequence[str], top: int | None = None) -> Callable:
    def product(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys = pd.Index(left[inner].unique()).intersection(right[inner].unique())
        left, right = left[left[inner].isin(keys)], right[right[inner].isin(keys)]
        if not len(keys):
            return pd.DataFrame(columns=list(schema))
        (i, row_names), (j, column_names) = _codes(left, rows), _codes(right, columns)
        b = np.zeros((len(keys), len(column_names)))
        np.add.at(b, (keys.get_indexer(right[inner]), j), right["__b"].to_numpy(float))
        step, parts = max(1, _CELLS // len(column_names)), []
        whole_scope = top is not None and left["__blocks"].iloc[0] == 1
        totals = np.zeros(len(column_names))
        at, values = keys.get_indexer(left[inner]), left["__a"].to_numpy(float)
        for start in range(0, len(row_names), step):
            inside = (i >= start) & (i < start + step)
            a = np.zeros((len(keys), min(step, len(row_names) - start)))
            np.add.at(a, (at[inside], i[inside] - start), values[inside])
            cells = a.T @ b
            totals += cells.sum(axis=0)
            r, c = np.nonzero(_leading(cells, top) if whole_scope else cells)
            part = pd.concat([row_names.iloc[r + start].reset_index(drop=True), column_names.iloc[c].reset_index(drop=True)], axis=1)
            part[out] = cells[r, c]
            part["__column"] = c
            parts.append(part)
        whole = pd.concat(parts, ignore_index=True)
        whole["__total"] = totals[whole["__column"].to_numpy(int)] if whole_scope else np.nan
        for name in scope:
            whole[name] = left[name].iloc[0]
        return whole[list(schema)]

    return product


def partial_products(
    left: DataFrame, right: DataFrame, scope: Sequence[str], inner: Sequence[str], rows: Sequence[str], columns: Sequence[str],
    a: str, b: str, out: str, keys_per_block: int = 256, top: int | None = None,
) -> DataFrame:
    """Per scope, block of keys, `rows` (of the left) and `columns` (of the right): the sum of a * b over the block's keys.

    Keys (`inner`) and scope must not be null; rows with nulls there meet nothing, as in a join.
    With `top`, a scope of one block, whose sums are whole, leaves out the rows that can't be among the
    `top` largest of their column, and `__total` has the column's sum; it is unknown in other scopes.
    """
    def keyed(df: DataFrame, value: str, name: str, keep: Sequence[str]) -> DataFrame:
        df = df.dropna(subset=[*scope, *inner])
        # Named anew: both sides may come from one table.
        named = [F.col(c).alias(c) for c in (*scope, *keep)]
        return df.select(*named, F.to_json(F.struct(*inner)).alias("__key"), F.col(value).cast("double").alias(name))

    left, right = keyed(left, a, "__a", rows), keyed(right, b, "__b", columns)
    one = list(scope) or ["__all"]
    if not scope:
        left, right = left.withColumn("__all", F.lit(0)), right.withColumn("__all", F.lit(0))
    left = materialize(left, "product-left")  # read for the number of blocks and for the product
    blocks = left.groupBy(*one).agg(F.ceil(F.countDistinct("__key") / keys_per_block).alias("__blocks"))

    def dealt(df: DataFrame) -> DataFrame:
        # The number is named anew, as both sides have it.
        return df.join(blocks, one).withColumn("__block", F.pmod(F.xxhash64("__key"), F.col("__blocks"))).withColumn("__blocks", F.col("__blocks") + 0)

    kinds = {f.name: f.dataType for f in [*left.schema.fields, *right.schema.fields]}
    fields = [T.StructField(c, kinds[c]) for c in (*scope, *rows, *columns)] + [T.StructField(out, T.DoubleType())]
    if top is not None:
        fields.append(T.StructField("__total", T.DoubleType()))
    product = _multiply("__key", scope, rows, columns, out, [f.name for f in fields], top)
    grouped = (dealt(df).groupBy(*one, "__block") for df in (left, right))
    first, second = grouped
    return first.cogroup(second).applyInPandas(product, T.StructType(fields))


def sum_of_products(left: DataFrame, right: DataFrame, scope: Sequence[str], inner: Sequence[str], rows: Sequence[str], columns: Sequence[str], a: str, b: str, out: str, keys_per_block: int = 256) -> DataFrame:
    parts = partial_products(left, right, scope, inner, rows, columns, a, b, out, keys_per_block)
    return parts.groupBy(*scope, *rows, *columns).agg(F.sum(out).alias(out))


def leading_products(left: DataFrame, right: DataFrame, scope: Sequence[str], inner: Sequence[str], rows: Sequence[str], columns: Sequence[str], a: str, b: str, out: str, total: str, top: int, keys_per_block: int = 512) -> DataFrame:
    """`sum_of_products` without most of the rows that are not among the `top` largest of their scope and columns, and the sum over all rows as `total`.

    A rank at six decimals over what is left is the rank over all.  Only scopes of several blocks make
    a row for every cell, since their partial sums have to meet.
    """
    parts = materialize(partial_products(left, right, scope, inner, rows, columns, a, b, out, keys_per_block, top), "leading-products")
    keys = [*scope, *rows, *columns]
    partial = F.col("__total").isNull() | F.isnan("__total")  # Arrow turns NaN into null
    whole = parts.filter(~partial).select(*keys, out, F.col("__total").alias(total))
    met = parts.filter(partial).groupBy(*keys).agg(F.sum(out).alias(out))
    return whole.unionByName(with_totals(met, [*scope, *columns], **{total: F.sum(out)}).select(*keys, out, total))

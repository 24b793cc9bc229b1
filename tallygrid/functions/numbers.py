"""Three number readers, kept apart because they disagree on '1.234,56'."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import NUMBER_NULL_WORDS

_PLAIN_NUMBER = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"
# Points between thousands; the other form has a decimal comma, with or without such points.
_GROUPED = r"^[-+]?\d{1,3}(\.\d{3})+$"
_READABLE = r"^[-+]?((\d{1,3}(\.\d{3})+|\d+),\d+|(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?|\d{1,3}(\.\d{3})+)$"


def _as_double(text: Column) -> Column:
    # The pattern guard keeps out suffixes such as '1d' that the JVM reader would accept.
    return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double"))


def metric(c: Column | str) -> Column:
    """Decimal comma becomes a point; anything unreadable counts as zero."""
    text = F.trim(_col(c).cast("string"))
    return F.coalesce(_as_double(F.replace(text, F.lit(","), F.lit("."))), F.lit(0.0))


def number(df: DataFrame, name: str) -> Column:
    """`metric` of a named column, skipping the text reader where the type is numeric."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return metric(name)


def _compact(c: Column | str) -> Column:
    return F.translate(F.trim(_col(c).cast("string")), "\u00a0 ", "")


def reads_as_number(c: Column | str) -> Column:
    """Whether `parse_number` reads a number there; one pattern, never null."""
    return F.coalesce(_compact(c).rlike(_READABLE), F.lit(False))


def parse_number(c: Column | str) -> Column:
    """Locale-aware: grouped thousands and decimal commas are understood, junk is null.

    The text is mentioned few times, as every mention is work of its own in a condition.
    """
    text = _compact(c)
    point = F.when(F.contains(text, F.lit(",")), F.translate(text, ",.", ".")).when(text.rlike(_GROUPED), F.translate(text, ".", ""))
    return F.when(text.rlike(_READABLE), point.otherwise(text).try_cast("double"))


def parse_number_lenient(c: Column | str) -> Column:
    """Both separators: points are grouping. A lone comma is decimal."""
    text = F.trim(_col(c).cast("string"))
    has_comma = F.contains(text, F.lit(","))
    has_dot = F.contains(text, F.lit("."))
    no_dots = F.replace(text, F.lit("."), F.lit(""))
    readable = (
        F.when(has_comma & has_dot, F.replace(no_dots, F.lit(","), F.lit(".")))
        .when(has_comma, F.replace(text, F.lit(","), F.lit(".")))
        .otherwise(text)
    )
    return _as_double(readable)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Null instead of division by zero."""
    bottom = _col(denominator)
    return F.when(bottom != 0, _col(numerator) / bottom)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c

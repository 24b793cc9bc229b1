"""Codes to labels: categories, age bands, regions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import parse_number
from .text import _col, clean_value, once, safe_text
from .words import (
    ACCENTED,
    CATEGORY_LABELS,
    CATEGORY_NULL_WORDS,
    FIELD_LABELS,
    PROFILE_ALIASES,
    REGION_STATES,
    UNACCENTED,
)


def strip_accents(c: Column | str) -> Column:
    return F.translate(_col(c), ACCENTED, UNACCENTED)


def _lookup(key: Column, table: dict[str, str]) -> Column:
    # A literal map stays inside generated code; no join, nothing to broadcast.
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def humanize(c: Column | str) -> Column:
    """Underscores to spaces; shouting longer than three characters to title case."""
    def named(text: Column) -> Column:
        shouting = (text == F.upper(text)) & (F.upper(text) != F.lower(text)) & (F.length(text) > 3)
        return F.when(shouting, title_case(text)).otherwise(text)

    return once(F.trim(F.replace(safe_text(c, "Sem valor"), F.lit("_"), F.lit(" "))), named)


def title_case(text: Column) -> Column:
    """Capital after every non-letter, not only after spaces ('1-URGENT' -> '1-Urgent')."""
    spaced = F.regexp_replace(text, r"([^\p{L}\s])", "$1\u0001 ")
    return F.replace(F.initcap(spaced), F.lit("\u0001 "), F.lit(""))


def label_category(value: Column | str, role: str) -> Column:
    """The published label of a code, 'Ano N', 'Codigo N' or readable text."""
    return once(safe_text(value, "SEM_VALOR"), lambda text: _label(text, role))


def _label(text: Column, role: str) -> Column:
    choices = [F.when(F.lower(text).isin(CATEGORY_NULL_WORDS), F.lit("Sem valor"))]
    if CATEGORY_LABELS.get(role):
        plain = F.regexp_replace(strip_accents(text), r"^([-+]*\d+)\.0$", "$1")

        def key(code: Column) -> Column:
            worded = F.regexp_replace(F.trim(F.regexp_replace(F.upper(code), r"[\s_]", " ")), " ", "_")
            return F.when(F.length(code) <= 1, code).otherwise(worded)

        choices.append(_lookup(once(plain, key), CATEGORY_LABELS[role]))
    prefix = "Ano " if role == "ano" else ("Codigo " if role.startswith("perfil_") else None)
    if prefix:
        number = F.regexp_replace(text, r"\.0$", "")
        choices.append(F.when(text.rlike(r"^[-+]?\d+(\.0)?$"), F.concat(F.lit(prefix), number)))
    return F.coalesce(*choices, humanize(text))


def label_if_present(value: Column | str, role: str) -> Column:
    """Label, or '' when there is nothing to label."""
    text = safe_text(value)
    blank = F.lower(text).isin("", "sem valor", "sem_valor")
    return F.when(blank, F.lit("")).otherwise(label_category(text, role))


def field_label(name: str) -> str:
    """Readable name of a column (driver side: column names only)."""
    if name in FIELD_LABELS:
        return FIELD_LABELS[name]
    words = name.replace("perfil_", "").replace("_", " ").strip()
    return words.title() if words.isupper() and len(words) > 3 else words


def age_bands() -> list[tuple[int, int, str]]:
    """The fifteen bands: 16-17, 18-20, 21-24, five-year steps, 80 and over."""
    edges = [16, 18, 21, *range(25, 81, 5)]
    bands = [(a, b - 1, f"{a} a {b - 1} anos") for a, b in zip(edges, edges[1:])]
    return [*bands, (80, 120, "80 anos ou mais")]


def age_band(value: Column | str) -> Column:
    """Age in years to band text; ages outside 16-120 fall back to the code table."""
    def banded(age: Column) -> Column:
        bands = [F.when(age.between(low, high), F.lit(text)) for low, high, text in age_bands()]
        outside = F.when((age < 16) | (age > 120), label_category(value, "perfil_faixa_etaria"))
        return F.when(age.isNull(), F.lit("")).otherwise(F.coalesce(outside, *bands, F.lit("")))

    return once(parse_number(value).cast("int"), banded)


def coalesce_profile_aliases(columns: list[str], role: str) -> Column:
    """First raw alias of a dimension whose labelled value is valid, else ''."""
    from .text import valid

    present = {name.lower(): name for name in columns}
    choices = []
    for alias in PROFILE_ALIASES.get(role, [role]):
        if alias in present:
            label = clean_value(label_category(F.col(f"`{present[alias]}`"), role))
            choices.append(F.when(valid(label), label))
    return F.coalesce(*choices, F.lit(""))


def region_of_state(c: Column | str) -> Column:
    table = {uf: region for region, states in REGION_STATES.items() for uf in states}
    return F.coalesce(_lookup(F.upper(_col(c)), table), F.lit("Sem regiao"))

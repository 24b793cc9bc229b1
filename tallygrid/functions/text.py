"""Text cleaning, validity predicates, codes and profile combinations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import ELECTORAL, Spec
from .words import LABEL_NULL_WORDS, MISSING_SPELLINGS, NULL_WORDS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _words(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _trimmed_sql(name: str) -> str:
    # Named columns are built from expression text: one call to the JVM per predicate.
    return f"trim(coalesce(cast(`{name}` as string), ''))"


def _trimmed(c: Column | str) -> Column:
    if isinstance(c, str):
        return F.expr(_trimmed_sql(c))
    return F.trim(F.coalesce(_col(c).cast("string"), F.lit("")))


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is computed once, however often it is mentioned.

    Repeated mentions under a condition are work of their own, and side by side in a stage's one method they
    make it too long for the JVM to compile.  A function over an array is kept out of that method.
    """
    return F.get(F.transform(F.array(c), use), F.lit(0))


def safe_text(c: Column | str, fallback: str = "") -> Column:
    """Trimmed text; spellings of a missing value become the fallback."""
    if isinstance(c, str):
        t = _trimmed_sql(c)
        return F.expr(f"if(lower({t}) in ({_words(MISSING_SPELLINGS)}), '{fallback}', {t})")
    text = _trimmed(c)
    return F.when(F.lower(text).isin(MISSING_SPELLINGS), F.lit(fallback)).otherwise(text)


def filled(c: Column | str) -> Column:
    """`safe_text`, null instead of ''."""
    return once(_trimmed(c), lambda text: F.when(~F.lower(text).isin(MISSING_SPELLINGS), text))


def clean_value(c: Column | str) -> Column:
    """Trimmed text; null words and '... sem valor' become ''."""
    text = _trimmed(c)
    low = F.lower(text)
    missing = low.isin(NULL_WORDS) | low.endswith("_sem_valor") | low.endswith(" sem valor")
    return F.when(missing, F.lit("")).otherwise(text)


def profile_value(c: Column | str) -> Column:
    """As `clean_value`, also dropping labels that are bare codes."""
    text = clean_value(c)
    low = F.lower(text)
    unusable = low.startswith("codigo ") | low.isin("nao informado", "não informado")
    return F.when(unusable, F.lit("")).otherwise(text)


def meaningful(c: Column | str) -> Column:
    """Text fit for a label: no null words, no '... sem valor', no 'Codigo 12'."""
    text = _trimmed(c)
    low = F.lower(text)
    missing = (
        low.isin(LABEL_NULL_WORDS)
        | low.endswith("_sem_valor")
        | low.endswith(" sem valor")
        | low.rlike(r"^c[oó]digo [-+]*\d*\.?\d+$")
    )
    return F.when(missing, F.lit("")).otherwise(text)


def has_text(c: Column | str) -> Column:
    if isinstance(c, str):
        return F.expr(f"{_trimmed_sql(c)} <> ''")
    return _trimmed(c) != ""


def valid(c: Column | str) -> Column:
    """True when the value is present, is no null word and does not say 'sem valor'."""
    if isinstance(c, str):
        low = f"lower({_trimmed_sql(c)})"
        return F.expr(f"{low} not in ({_words(NULL_WORDS)}) and not contains({low}, 'sem valor')")
    low = F.lower(_trimmed(c))
    return ~low.isin(NULL_WORDS) & ~F.contains(low, F.lit("sem valor"))


def any_profile_valid(spec: Spec = ELECTORAL) -> Column:
    """One test over an array: a test per dimension, side by side, is a method too long for the JVM to compile."""
    return F.exists(F.array(*[F.col(dim).cast("string") for dim in spec.dims]), valid)


def positive(c: Column | str) -> Column:
    return _col(c) > 0


def compact_code(c: Column | str) -> Column:
    """'12.0' -> '12'."""
    return F.regexp_replace(safe_text(c), r"^(\d+)\.0$", "$1")


def discrete(c: Column | str) -> Column:
    """Key text that is never null: blanks become SEM_VALOR."""
    if isinstance(c, str):
        return F.expr(f"coalesce(nullif(trim(cast(`{c}` as string)), ''), 'SEM_VALOR')")
    return F.coalesce(F.nullif(F.trim(_col(c).cast("string")), F.lit("")), F.lit("SEM_VALOR"))


def clean_state(c: Column | str) -> Column:
    """Two letters, else SEM_UF."""
    return once(F.upper(clean_value(c)), lambda text: F.when(text.rlike(r"^\p{L}{2}$"), text).otherwise(F.lit("SEM_UF")))


def years_in(c: Column | str) -> Column:
    """Distinct years 1900-2099 mentioned in a text, ascending."""
    found = F.regexp_extract_all(_trimmed(c), F.lit(r"((?:19|20)\d{2})"), F.lit(1))
    return F.array_sort(F.array_distinct(found))


def first_year(c: Column | str) -> Column:
    return F.coalesce(F.get(years_in(c), F.lit(0)), F.lit(""))


_UUID = r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
_HEX_RUN = r"(?=[0-9a-fA-F]{8})[0-9a-fA-F]*[0-9][a-fA-F][0-9a-fA-F]*"


_YEAR = r"(?<!\d)((?:19|20)\d{2})(?!\d)"


def _without_random(path: Column | str) -> Column:
    """A path without UUIDs and hex runs, the random parts of written files' names."""
    return F.regexp_replace(F.regexp_replace(_trimmed(path), _UUID, ""), _HEX_RUN, "")


def path_years(path: Column | str) -> Column:
    """Distinct years 1900-2099 that stand by themselves in a path, ascending."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(_without_random(path), F.lit(_YEAR), F.lit(1))))


def path_year(path: Column | str) -> Column:
    """The first year that stands by itself in a path, folders before the file name; '' without any.

    Digits inside longer numbers, UUIDs and hex runs are no years.
    """
    parts = F.split(_without_random(path), r"[/\\]")
    folders = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/")
    found = [F.nullif(F.regexp_extract(x, _YEAR, 1), F.lit("")) for x in (folders, F.element_at(parts, -1))]
    return F.coalesce(*found, F.lit(""))


def profile_combo(spec: Spec = ELECTORAL) -> Column:
    """'label=value; label=value', skipping dimensions without a valid value."""
    parts = [
        F.when(valid(dim), F.concat(F.lit(f"{label}="), F.col(dim).cast("string")))
        for dim, label in spec.dims.items()
    ]
    return F.concat_ws("; ", *parts)


def combo_part(combo: Column | str, label: str) -> Column:
    """The value of one label inside a combined profile; null when absent."""
    return F.nullif(F.trim(F.regexp_extract(_col(combo).cast("string"), f"{label}=([^;]+)", 1)), F.lit(""))


def joined_codes(*codes: Column | str) -> Column:
    """Codes joined with '|', blanks skipped."""
    return F.concat_ws("|", *[F.nullif(compact_code(c), F.lit("")) for c in codes])


def section_codes(spec: Spec = ELECTORAL, year: str = "ano_correlacao") -> dict[str, Column]:
    """Municipality, zone, section and period+section codes."""
    sector = joined_codes(spec.place, spec.zone, spec.section)
    return {
        "codigo_municipio": joined_codes(spec.place),
        "codigo_zona_eleitoral": joined_codes(spec.place, spec.zone),
        "codigo_setor_eleitoral": sector,
        "codigo_correlacao_setor_ano": joined_codes(F.col(year), sector),
    }


def correlation_year(content: Column | str, file_name: Column | str) -> Column:
    """Year in the content, else in the file name, else a marker."""
    return F.coalesce(
        F.nullif(first_year(content), F.lit("")),
        F.nullif(path_year(file_name), F.lit("")),
        F.lit("ano_desconhecido"),
    )


def entity_label(candidate: Column | str = "candidato", party: Column | str = "partido") -> Column:
    """'candidate | party', whichever exists, else GERAL."""
    both = F.concat_ws(
        " | ", F.nullif(safe_text(candidate), F.lit("")), F.nullif(safe_text(party), F.lit(""))
    )
    return F.coalesce(F.nullif(both, F.lit("")), F.lit("GERAL"))

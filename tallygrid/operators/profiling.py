"""What the columns of a table hold, from one pass over distinct values.

The table is turned into (column, value, rows) once, a column at a time: files are read by
column, so that is one pass over their bytes.  Ties collapse before the shuffle, so a column
with one dominant value costs one row per task, and every text test below runs once per
distinct value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import field_label, label_category
from ..functions.numbers import parse_number, parse_number_lenient, ratio
from ..functions.text import years_in
from ..functions.words import CATEGORY_LABELS, CATEGORY_NULL_WORDS
from ..session import materialize
from ..sources.roles import DIMENSION_ROLES, METRIC_ROLES, canonical_field, is_code_like, normalize_name, role_of
from .core import share_of_total, top_ranked, with_totals

TIME_ROLES = {"ano", "data", "hora", "datetime"}
CLUSTER_METRICS = {"votos", "comparecimento", "abstencao"}
DISCRETE_ROLES = {
    "uf", "regiao", "turno", "cargo", "partido", "candidato", "ideologia", "coalizao", "perfil_faixa_etaria", "perfil_genero",
    "perfil_instrucao", "perfil_estado_civil", "perfil_raca_cor", "perfil_biometria",
} | set(CATEGORY_LABELS)


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(coluna, valor, n) with missing values as null.

    `df` is read once per column: a table, or a join that was written (`materialize`).
    """
    names = list(columns or df.columns)
    parts = [df.select(F.lit(c).alias("coluna"), F.col(f"`{c}`").cast("string").alias("valor")) for c in names]
    counts = reduce(DataFrame.union, parts).groupBy("coluna", "valor").agg(F.count(F.lit(1)).alias("n"))
    text = F.trim("valor")
    missing = F.lower(text).isin("", "nan", "none", "null", "<na>")
    return counts.groupBy("coluna", F.when(~missing, text).alias("valor")).agg(F.sum("n").alias("n"))


def by_column(mapping: Mapping[str, object], default: object) -> Column:
    """A per-column constant (column names only, known on the driver)."""
    out = F.lit(default)
    for name, value in mapping.items():
        if value != default:
            out = F.when(F.col("coluna") == name, F.lit(value)).otherwise(out)
    return out


def _labelled(names: Sequence[str], roles: Mapping[str, str]) -> Column:
    # One branch per role, not per column.
    label = label_category("valor", "")
    for role in sorted({roles[n] for n in names}):
        if role in CATEGORY_LABELS or role.startswith("perfil_"):
            own = [n for n in names if roles[n] == role]
            label = F.when(F.col("coluna").isin(own), label_category("valor", role)).otherwise(label)
    return label


def _useful_labels(counts: DataFrame, names: Sequence[str], roles: Mapping[str, str]) -> DataFrame:
    """Counts per readable label, without null words and bare codes."""
    rows = counts.filter(F.col("valor").isNotNull()).groupBy("coluna", _labelled(names, roles).alias("rotulo")).agg(
        F.sum("n").alias("n")
    )
    low = F.lower("rotulo")
    unusable = low.isin([*CATEGORY_NULL_WORDS, "sem valor"]) | low.rlike(r"^c[oó]digo [-+]*\d*\.?\d+$")
    return rows.filter(~unusable)


def useful_discrete(counts: DataFrame, names: Sequence[str], roles: Mapping[str, str] | None = None, low: int = 2, high: int = 500) -> DataFrame:
    """Per column: readable categories and whether it is worth charting (2-500, not numbers)."""
    roles = roles or {c: role_of(c) for c in names}
    numbers = counts.filter(F.col("valor").isNotNull()).groupBy("coluna").agg(
        ratio(F.sum(F.when(parse_number("valor").isNotNull(), F.col("n")).otherwise(0)), F.sum("n")).alias("numeric_ratio")
    )
    labels = _useful_labels(counts, names, roles).groupBy("coluna").agg(F.count(F.lit(1)).alias("qtd_categorias"))
    known = by_column({c: roles[c] in DISCRETE_ROLES for c in names}, False)
    coded = by_column({c: roles[c] in CATEGORY_LABELS for c in names}, False)
    timed = by_column({c: roles[c] in TIME_ROLES for c in names}, False)
    numeric = F.col("numeric_ratio") >= 0.80
    size = F.coalesce("qtd_categorias", F.lit(0))
    return numbers.join(labels, "coluna", "left").select(
        "coluna", size.alias("qtd_categorias"), "numeric_ratio",
        (~timed & ~(numeric & ~coded) & ~(numeric & ~known) & size.between(low, high)).alias("discreto_util"),
    )


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls, distinct values, number and year ratios, role, kind and use flags per column."""
    names = list(columns or df.columns)
    roles = {c: role_of(c) for c in names}
    counts = materialize(value_counts(df, names), "counts")  # read by every statistic
    present = F.col("valor").isNotNull()
    n_if = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    stats = counts.groupBy("coluna").agg(
        F.sum("n").alias("linhas_amostra"), n_if(present).alias("nao_nulos"), n_if(~present).alias("nulos"),
        F.count("valor").alias("unicos"), n_if(parse_number("valor").isNotNull()).alias("__numbers"),
        F.sum(F.when(present, F.size(years_in("valor")) * F.col("n")).otherwise(0)).alias("__years"),
    )
    stats = stats.join(useful_discrete(counts, names, roles).select("coluna", "discreto_util"), "coluna", "left")
    filled = F.greatest(F.col("nao_nulos"), F.lit(1))
    role, code = by_column(roles, ""), by_column({c: is_code_like(c) for c in names}, False)
    out = stats.select(
        "coluna", role.alias("__role"), code.alias("parece_codigo"), "linhas_amostra", "nao_nulos", "nulos",
        (F.col("nulos") / F.col("linhas_amostra")).alias("pct_nulos"), "unicos", (F.col("unicos") / filled).alias("ratio_unicos"),
        (F.col("__numbers") / filled).alias("numeric_ratio"), (F.col("__years") / filled).alias("year_ratio"),
        F.coalesce("discreto_util", F.lit(False)).alias("usar_como_discreto"),
    )
    numeric = F.col("numeric_ratio")
    dated = (F.col("year_ratio") >= 0.5) & (F.col("unicos") <= 80)
    few = F.col("unicos") <= F.least(F.lit(250), F.greatest(F.lit(30), F.floor(F.col("nao_nulos") * 0.08)))
    kind = (
        F.when(F.col("__role").isin(sorted(DIMENSION_ROLES)), "dimensao")
        .when(F.col("__role").isin(sorted(METRIC_ROLES)) & (numeric >= 0.5), "metrica")
        .when(dated, "ano_detectado_por_valor")
        .when((numeric >= 0.95) & F.col("usar_como_discreto"), "categorico_discreto")
        .when((numeric >= 0.95) & ~F.col("parece_codigo"), "numerico")
        .when(F.col("parece_codigo"), "codigo")
        .when(few, "categorico")
        .otherwise("texto")
    )
    out = out.withColumn("tipo_inferido", kind)
    inferred = F.when((F.col("__role") == "") & (F.col("tipo_inferido") == "ano_detectado_por_valor"), "ano_candidato").otherwise(F.col("__role"))
    metric = F.col("__role").isin(sorted(CLUSTER_METRICS)) & F.col("tipo_inferido").isin("metrica", "numerico") & ~F.col("parece_codigo")
    return out.withColumns(
        {"role_sugerido": inferred, "usar_como_metrica": metric, "usar_em_clustering": F.col("usar_como_discreto")}
    ).drop("__role")


# Name patterns of quantities and codes.
QUANTITY_PREFIXES = ("QT_", "QTD_", "VR_", "VL_", "PCT_", "PC_", "TX_")
QUANTITY_WORDS = (
    "VOTO", "VOTACAO", "VOTAÇÃO", "COMPARECIMENTO", "ABSTEN", "ELEITORADO", "ELEITORES", "APTOS", "VALIDOS", "VÁLIDOS",
    "NOMINAIS", "LEGENDA", "BRANCOS", "NULOS", "ANULADOS", "TOTAL", "PERCENTUAL", "PORCENTAGEM", "QTD", "QUANTIDADE",
)
KEY_NAMES = ("ANO_ELEICAO",)
CODE_PREFIXES = ("CD_", "SQ_", "ID_", "SG_", "NR_", "HH_", "MM_")
TEXT_PREFIXES = ("NM_", "DS_")
DATE_PREFIXES = ("DT_", "DATA_")


def name_traits(name: str) -> dict[str, bool]:
    """Quantity / code / date / description, judged by the column name."""
    n = normalize_name(name)
    quantity = n.startswith(QUANTITY_PREFIXES) or any(w in n for w in QUANTITY_WORDS)
    described = n.startswith(TEXT_PREFIXES)
    code = not quantity and not described and (n in KEY_NAMES or n.startswith(CODE_PREFIXES))
    dated = n.startswith(DATE_PREFIXES) or n in ("DT", "DATE") or "DATA" in n
    return {"quantidade": quantity, "codigo": code, "data": dated, "descricao": described}


def semantic_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type, class and reason of every column, with scores for numeric and categorical use."""
    names = list(columns or df.columns)
    traits = {c: name_traits(c) for c in names}
    counts = value_counts(df, names)
    stats = counts.groupBy("coluna").agg(
        F.sum("n").alias("linhas"), F.sum(F.when(F.col("valor").isNotNull(), F.col("n")).otherwise(0)).alias("qtd_nao_nulos"),
        F.count("valor").alias("qtd_unicos"), F.sum(F.when(parse_number_lenient("valor").isNotNull(), F.col("n")).otherwise(0)).alias("qtd_numericos"),
    )
    filled = F.greatest(F.col("qtd_nao_nulos"), F.lit(1))
    out = stats.withColumns(
        {
            "ratio_numerico": F.col("qtd_numericos") / filled, "ratio_unicos": F.col("qtd_unicos") / filled,
            **{f"parece_{t}": by_column({c: traits[c][t] for c in names}, False) for t in ("quantidade", "codigo", "data", "descricao")},
        }
    )
    number, spread, distinct = F.col("ratio_numerico"), F.col("ratio_unicos"), F.col("qtd_unicos")
    kind = (
        F.when(F.col("qtd_nao_nulos") == 0, "vazio")
        .when(F.col("parece_codigo") & (number >= 0.80), "codigo_numerico")
        .when(F.col("parece_codigo"), "codigo_categorico")
        .when(F.col("parece_quantidade") & (number >= 0.80), "numerico_analitico_quantidade")
        .when(F.col("parece_data"), "data_ou_temporal")
        .when((number >= 0.95) & ((distinct <= 50) | (spread <= 0.05)), "codigo_provavel_numerico")
        .when(number >= 0.95, "numerico_analitico")
        .when(F.col("parece_descricao") & ((distinct <= 120) | (spread <= 0.10)), "dimensao_textual")
        .when(F.col("parece_descricao"), "texto_livre")
        .when((distinct <= 80) | (spread <= 0.05), "categorico")
        .otherwise("texto")
    )
    classes = {
        "vazio": "vazio", "codigo_numerico": "codigo", "codigo_categorico": "codigo", "numerico_analitico_quantidade": "quantidade",
        "data_ou_temporal": "data", "codigo_provavel_numerico": "codigo_provavel", "numerico_analitico": "numerico",
        "dimensao_textual": "dimensao", "texto_livre": "texto", "categorico": "categorico", "texto": "texto",
    }
    klass = F.lit("texto")
    for name, value in classes.items():
        klass = F.when(F.col("tipo_inferido") == name, value).otherwise(klass)
    out = out.withColumn("tipo_inferido", kind).withColumn("classe_semantica", klass).withColumn(
        "processar_analise", F.col("classe_semantica").isin("quantidade", "numerico", "dimensao", "categorico")
    )
    out = with_totals(out, [], __most_numbers=F.max("qtd_numericos"), __most_rows=F.max("qtd_nao_nulos"))
    numeric = F.col("classe_semantica").isin("quantidade", "numerico") & (F.col("qtd_numericos") > 2)
    score = F.col("parece_quantidade").cast("int") * 5.0 + F.col("qtd_numericos") / F.greatest("__most_numbers", F.lit(1)) + F.least(distinct, F.lit(1000)) / 1000.0
    category = F.col("tipo_inferido").isin("categorico", "dimensao_textual") & (distinct >= 2)
    weight = 1.0 / F.greatest(distinct, F.lit(1)) + F.col("qtd_nao_nulos") / F.greatest("__most_rows", F.lit(1))
    return out.withColumns({"score_numerico": F.when(numeric, score), "score_categorico": F.when(category, weight)}).drop("__most_numbers", "__most_rows")


def analytic_columns(profile: DataFrame, max_numeric: int | None = None, max_categories: int | None = None) -> tuple[list[str], list[str]]:
    """Numeric and categorical column names, best first (collects one row per column)."""
    numeric = profile.filter("score_numerico is not null").orderBy(F.desc("score_numerico"), "coluna")
    if max_numeric is not None:
        numeric = numeric.limit(max_numeric)
    few = F.lit(True) if max_categories is None else F.col("qtd_unicos") <= max_categories
    category = profile.filter("score_categorico is not null").filter(few).orderBy(F.desc("score_categorico"), "coluna")
    return [r.coluna for r in numeric.collect()], [r.coluna for r in category.collect()]


def discrete_summary(df: DataFrame, top: int = 20, columns: Sequence[str] | None = None) -> DataFrame:
    """Leading labelled values of every useful discrete column."""
    names = list(columns or df.columns)
    roles = {c: role_of(c) for c in names}
    counts = materialize(value_counts(df, names), "counts")
    labels = _useful_labels(counts, names, roles)
    useful = useful_discrete(counts, names, roles).filter("discreto_util").select("coluna", "qtd_categorias")
    rows = share_of_total(labels.join(useful, "coluna"), ["coluna"], "n", "share")
    ranked = top_ranked(rows, ["coluna"], "n", ["rotulo"], "rank_valor", top)
    readable = by_column({c: field_label(c) for c in names}, "")
    return ranked.select(
        F.col("coluna").alias("campo"), readable.alias("campo_legivel"), F.col("rotulo").alias("valor"), F.col("n").alias("qtd"),
        "share", "rank_valor", "qtd_categorias",
    )


def field_catalogue(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column profiles of several tables with the canonical field name of every column."""
    parts = []
    for name, df in tables.items():
        canonical = by_column({c: canonical_field(c) for c in df.columns}, "")
        written = materialize(df, "profiled")  # joins are done once, not per column
        parts.append(column_profile(written).withColumns({"arquivo_relativo": F.lit(name), "campo_canonico": canonical}))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

"""Ready-made column counts: one row per (scope, dimension, value) with share and rank.

All of them follow one shape: aggregate to cells, unpivot the cells, add up per value,
relate to the scope total and keep the leading values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.numbers import ratio
from ..functions.text import combo_part, valid
from ..model import ELECTORAL, Spec
from .core import level_location, share_of_total, sums, top_ranked, unpivot

PLACE = ("nivel", "ano", "uf", "cd_municipio", "nm_municipio")


def _finish(values: DataFrame, scope: Sequence[str], ties: Sequence[str], weight: str, bar: Sequence[str], dim: str, top: int | None) -> DataFrame:
    shares = share_of_total(values, scope, weight, "share_histograma")
    ranked = top_ranked(shares, scope, F.round(weight, 6), ties, "rank_histograma", top)
    return ranked.withColumn("grafico_sugerido", F.when(F.col(dim).isin(list(bar)), "barra").otherwise("pizza_barra"))


def _count(cells: DataFrame, ids: Sequence[str], dims: dict[str, str], measures: Sequence[str], dim: str, value: str) -> DataFrame:
    long = unpivot(cells, ids, dims, dim, value, measures)
    counted = long.filter(valid(value)).groupBy(*ids, dim, value).agg(*sums(measures))
    return counted.filter(F.col(measures[0]) > 0)


def _profile_dims(spec: Spec, from_columns: bool) -> dict[str, Column]:
    """Each dimension from its column when valid, else from the combined profile."""
    out = {}
    for c, label in spec.dims.items():
        part = combo_part("perfil_combinado", label)
        own = [F.when(valid(c), F.col(c))] if from_columns else []
        out[c] = F.coalesce(*own, part, F.lit(""))
    return out


def _with_combo(spec: Spec) -> dict[str, str]:
    return {"perfil_combinado": "perfil_combinado", **spec.dims}


def hist_profile(profiles: DataFrame, spec: Spec = ELECTORAL, top: int | None = 200) -> DataFrame:
    """People, turnout and abstention per profile value, from a profile level table."""
    measures = ["qtd_pessoas", "comparecimento_estimado", "abstencao_estimado"]
    cells = profiles.filter(F.col("eleitorado") > 0).withColumnRenamed("eleitorado", "qtd_pessoas")
    cells = cells.withColumns(_profile_dims(spec, True))
    values = _count(cells, PLACE, _with_combo(spec), measures, "dimensao_perfil", "valor_perfil")
    return _profile_finish(values, top).withColumn("tipo_histograma", F.lit("perfil_eleitor"))


def _profile_finish(values: DataFrame, top: int | None) -> DataFrame:
    scope = ["nivel", "ano", "uf", "cd_municipio", "dimensao_perfil"]
    out = _finish(values, scope, ["valor_perfil"], "qtd_pessoas", ["perfil_combinado"], "dimensao_perfil", top)
    return out.withColumns(
        {
            "taxa_comparecimento": ratio("comparecimento_estimado", "qtd_pessoas"),
            "taxa_abstencao": ratio("abstencao_estimado", "qtd_pessoas"),
        }
    )


def _raise_level(hist: DataFrame, level: str, keys: Sequence[str], measures: Sequence[str], spec: Spec) -> DataFrame:
    scope = spec.level_scope(level)
    name = [F.max(spec.place_name).alias(spec.place_name)] if level == "municipio" else []
    out = hist.groupBy(*scope, *keys).agg(*sums(measures), *name)
    return out.withColumns(level_location(level, spec))


def hist_profile_rollup(hist: DataFrame, level: str, spec: Spec = ELECTORAL, top: int | None = 200) -> DataFrame:
    """Re-sum profile counts to a wider level; exact when the input was not cut."""
    measures = ["qtd_pessoas", "comparecimento_estimado", "abstencao_estimado"]
    keys = ["tipo_histograma", "dimensao_perfil", "valor_perfil"]
    return _profile_finish(_raise_level(hist, level, keys, measures, spec), top)


RESULT_DIMS = ("entidade", "cargo", "turno", "resultado_eleitoral", "resultado_grupo", "faixa_rank", "faixa_share_votos")


def hist_results(level_results: DataFrame, spec: Spec = ELECTORAL, top: int | None = 200) -> DataFrame:
    """Votes per entity, office, round, outcome, rank band and share band."""
    measures = ["qtd_votos", "brancos", "nulos", "validos_estimados", "qtd_registros"]
    rows = level_results.filter(valid("entidade") & (F.col("votos") > 0)).withColumns(
        {
            "faixa_rank": bands.rank_band("rank_entidade"),
            "faixa_share_votos": bands.share_band("share_votos"),
            "qtd_votos": F.col("votos"),
            "qtd_registros": F.lit(1),
            # office and round are ids and dimensions at once
            "d_cargo": F.col("cargo"),
            "d_turno": F.col("turno"),
        }
    )
    dims = {("d_" + d if d in spec.contest else d): "dim_" + d for d in RESULT_DIMS}
    ids = [*PLACE, *spec.contest, "tipo_entidade"]
    values = _count(rows, ids, dims, measures, "dimensao_resultado", "valor_resultado")
    values = values.withColumn("dimensao_resultado", F.expr("substring(dimensao_resultado, 5)"))
    return _results_finish(values, top)


def _results_finish(values: DataFrame, top: int | None) -> DataFrame:
    scope = ["nivel", "ano", "uf", "cd_municipio", "tipo_entidade", "dimensao_resultado"]
    ties = ["valor_resultado", "cargo", "turno"]
    return _finish(values, scope, ties, "qtd_votos", ["entidade", "cargo"], "dimensao_resultado", top)


def hist_results_rollup(hist: DataFrame, level: str, spec: Spec = ELECTORAL, top: int | None = 200) -> DataFrame:
    measures = ["qtd_votos", "brancos", "nulos", "validos_estimados", "qtd_registros"]
    keys = [*spec.contest, "tipo_entidade", "dimensao_resultado", "valor_resultado"]
    return _results_finish(_raise_level(hist, level, keys, measures, spec), top)


def _entity_finish(values: DataFrame, spec: Spec, top: int | None) -> DataFrame:
    scope = ["nivel", "ano", "uf", "cd_municipio", *spec.contest, "tipo_entidade", "entidade", "dimensao_perfil"]
    ties = ["valor_perfil", "resultado_eleitoral"]
    return _finish(values, scope, ties, "qtd_votos", ["perfil_combinado"], "dimensao_perfil", top)


def hist_profile_entity(entity_profiles: DataFrame, spec: Spec = ELECTORAL, top: int | None = 200) -> DataFrame:
    """Proxy votes per profile value inside every entity and contest."""
    rows = entity_profiles.filter(valid("entidade") & valid("perfil_combinado") & (F.col("votos") > 0))
    rows = rows.withColumnRenamed("votos", "qtd_votos").withColumns(_profile_dims(spec, False))
    ids = [*PLACE, *spec.contest, "tipo_entidade", "entidade", "resultado_eleitoral"]
    values = _count(rows, ids, _with_combo(spec), ["qtd_votos"], "dimensao_perfil", "valor_perfil")
    values = values.withColumn("tipo_histograma", F.concat(F.lit("perfil_"), F.col("tipo_entidade")))
    return _entity_finish(values, spec, top)


def hist_profile_entity_rollup(hist: DataFrame, level: str, spec: Spec = ELECTORAL, top: int | None = 200) -> DataFrame:
    keys = [*spec.contest, "tipo_entidade", "entidade", "resultado_eleitoral", "tipo_histograma", "dimensao_perfil", "valor_perfil"]
    return _entity_finish(_raise_level(hist, level, keys, ["qtd_votos"], spec), spec, top)


def _cluster_finish(values: DataFrame, top: int | None) -> DataFrame:
    scope = ["nivel", "ano", "uf", "cd_municipio", "cluster_id", "dimensao_perfil"]
    return _finish(values, scope, ["valor_perfil", "cluster_tipo", "partido"], "qtd_pessoas", ["perfil_combinado"], "dimensao_perfil", top)


def hist_clusters(clusters: DataFrame, kind: str, spec: Spec = ELECTORAL, top: int | None = 200) -> DataFrame:
    """Weight per profile value inside every cluster."""
    rows = clusters.filter(valid("perfil_combinado")).withColumns(
        {**_profile_dims(spec, True), "qtd_pessoas": F.greatest("eleitorado", "votos_proxy")}
    )
    ids = [*PLACE, "cluster_id", "cluster_tipo", "partido"]
    values = _count(rows, ids, _with_combo(spec), ["qtd_pessoas"], "dimensao_perfil", "valor_perfil")
    return _cluster_finish(values, top).withColumn("tipo_histograma", F.lit(kind))


def hist_clusters_rollup(hist: DataFrame, level: str, spec: Spec = ELECTORAL, top: int | None = 200) -> DataFrame:
    keys = ["tipo_histograma", "cluster_id", "cluster_tipo", "partido", "dimensao_perfil", "valor_perfil"]
    return _cluster_finish(_raise_level(hist, level, keys, ["qtd_pessoas"], spec), top)

"""Buckets of profiles by a stable hash, with the leading personas of every bucket.

The bucket is the leading 32 bits of an MD5 digest modulo k: the same number in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import narrative
from ..functions.numbers import number
from ..functions.text import profile_combo, valid
from ..model import ELECTORAL, Spec
from .core import roll_up, share_of_total, top_ranked

PERSONA_KEYS = ["cluster_id", "cluster_tipo", "perfil_combinado", "partido", "algoritmo_cluster", "tipo_features_cluster"]


def stable_bucket(text: Column, k: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % k


def _personas(cells: DataFrame, scope: list[str], weight: str, dims: list[str], top: int | None) -> DataFrame:
    shares = share_of_total(cells, scope, weight, "share_cluster")
    ranked = top_ranked(
        shares, [*scope, "cluster_id"], F.round(weight, 6), ["perfil_combinado", "partido", *dims], "rank_persona_cluster", top
    )
    return ranked.withColumn("descricao", narrative.persona("perfil_combinado", "partido"))


def profile_bucket_totals(electorate: DataFrame, k: int = 2, spec: Spec = ELECTORAL) -> DataFrame:
    rows = electorate.withColumn("perfil_combinado", profile_combo(spec)).filter(
        valid("perfil_combinado") & (number(electorate, "eleitorado") > 0)
    )
    cells = rows.groupBy(*spec.place_keys, *spec.dims, "perfil_combinado").agg(
        F.max(spec.place_name).alias(spec.place_name), F.sum(number(electorate, "eleitorado")).alias("eleitorado")
    )
    return cells.withColumns(
        {
            "nivel": F.lit("municipio"),
            "cluster_id": stable_bucket(F.col("perfil_combinado"), k),
            "cluster_tipo": F.lit("eleitores_discretos"),
            "partido": F.lit(""),
            "votos_proxy": F.lit(0.0),
            "algoritmo_cluster": F.lit("DiscreteProfileHash"),
            "tipo_features_cluster": F.lit("sexo_genero, escolaridade, estado_civil, faixa_etaria, raca_cor"),
        }
    )


def profile_party_bucket_totals(parts: DataFrame, k: int = 2, spec: Spec = ELECTORAL) -> DataFrame:
    rows = parts.filter(valid("perfil_combinado") & valid("entidade") & (F.col("votos_proxy") > 0))
    cells = rows.groupBy(*spec.place_keys, "perfil_combinado", F.col("entidade").alias("partido")).agg(
        F.max(spec.place_name).alias(spec.place_name), F.sum("votos_proxy").alias("votos_proxy")
    )
    return cells.withColumns(
        {
            "nivel": F.lit("municipio"),
            "cluster_id": stable_bucket(F.concat_ws("|", "perfil_combinado", "partido"), k),
            "cluster_tipo": F.lit("eleitores_resultado_discreto"),
            **{d: F.lit("") for d in spec.dims},
            "eleitorado": F.lit(0.0),
            "algoritmo_cluster": F.lit("DiscreteProfilePartyHash"),
            "tipo_features_cluster": F.lit("perfil_eleitor_discreto + partido"),
        }
    )


def hash_clusters_profile(electorate: DataFrame, k: int = 2, spec: Spec = ELECTORAL, top: int | None = 5) -> DataFrame:
    """Buckets of combined profiles per municipality, leading personas by head count."""
    return _personas(profile_bucket_totals(electorate, k, spec), spec.place_keys, "eleitorado", spec.dim_columns, top)


def hash_clusters_profile_entity(parts: DataFrame, k: int = 2, spec: Spec = ELECTORAL, top: int | None = 5) -> DataFrame:
    """Buckets of profile and party per municipality, leading personas by proxy votes."""
    return _personas(profile_party_bucket_totals(parts, k, spec), spec.place_keys, "votos_proxy", spec.dim_columns, top)


def cluster_rollup(buckets: DataFrame, level: str, spec: Spec = ELECTORAL, top: int | None = 5) -> DataFrame:
    """Bucket personas of a wider level; the weight is the larger of people and proxy votes."""
    totals = [F.sum("eleitorado").alias("eleitorado"), F.sum("votos_proxy").alias("votos_proxy")]
    cells = roll_up(buckets.filter(valid("perfil_combinado")), level, [*PERSONA_KEYS, *spec.dims], totals, spec)
    cells = cells.withColumn("peso_cluster", F.greatest("eleitorado", "votos_proxy"))
    return _personas(cells, [*spec.level_scope(level), "cluster_tipo"], "peso_cluster", spec.dim_columns, top)

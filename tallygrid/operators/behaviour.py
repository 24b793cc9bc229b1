"""Who votes for whom: votes by contest, place, profile and entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..functions.text import entity_label, safe_text
from ..model import ELECTORAL, Spec
from ..session import materialize
from .core import share_of_total, share_within, sums, top1

MAX_ENTITIES = 250
OTHERS = "OUTRAS_ENTIDADES"


def _unit(df: DataFrame, spec: Spec) -> list[str]:
    places = [spec.state, spec.place, spec.place_name, spec.zone, spec.section, "local_votacao", "bairro"]
    return [spec.period, *spec.contest, *[c for c in places if c in df.columns], *spec.dims]


def behaviour_panel(base: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Votes, share and turnout rates per contest, place, profile and entity."""
    unit = _unit(base, spec)
    rows = base.withColumns(
        {**{d: safe_text(d) for d in spec.dims}, "entidade_voto": entity_label(spec.candidate, spec.party)}
    )
    panel = rows.groupBy(*unit, spec.party, spec.candidate, "entidade_voto").agg(
        F.sum("votos").alias("votos"), F.max("eleitorado").alias("eleitorado"),
        *sums(["comparecimento_estimado", "abstencao_estimado", "brancos", "nulos"]),
    )
    return share_within(panel, unit, "votos", "share_voto_no_perfil_secao").withColumns(
        {
            "taxa_abstencao_perfil_secao": ratio("abstencao_estimado", "eleitorado"),
            "taxa_comparecimento_perfil_secao": ratio("comparecimento_estimado", "eleitorado"),
        }
    )


def who_votes_for_whom(panel: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """The leading entity of every profile in every place."""
    keep = [spec.party, spec.candidate, "share_voto_no_perfil_secao", "taxa_abstencao_perfil_secao", "taxa_comparecimento_perfil_secao"]
    best = top1(panel, _unit(panel, spec), "votos", ["entidade_voto"], keep)
    return best.withColumnsRenamed(
        {"entidade_voto": "entidade_dominante", "votos": "votos_entidade_dominante", "share_voto_no_perfil_secao": "share_entidade_dominante"}
    )


def profile_affinity(panel: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Share of an entity inside a full profile against its overall share."""
    contest = [spec.period, *spec.contest]
    inside = panel.groupBy(*contest, *spec.dims, "entidade_voto").agg(F.sum("votos").alias("votos"))
    inside = share_within(inside, [*contest, *spec.dims], "votos", "share_entidade_no_perfil")
    world = panel.groupBy(*contest, "entidade_voto").agg(F.sum("votos").alias("__v"))
    world = share_of_total(world, contest, "__v", "share_global_entidade").drop("__v")
    return inside.join(world, [*contest, "entidade_voto"], "left").withColumn(
        "lift_perfil_entidade", ratio("share_entidade_no_perfil", "share_global_entidade")
    )


def leading_entities(panel: DataFrame, n: int = MAX_ENTITIES) -> list[str]:
    """Names of the n entities with most votes (runs a job; at most n strings return)."""
    totals = panel.groupBy("entidade_voto").agg(F.sum("votos").alias("v"))
    return [r[0] for r in totals.orderBy(F.desc("v"), "entidade_voto").limit(n).collect()]


def behaviour_matrix(panel: DataFrame, spec: Spec = ELECTORAL, max_entities: int = MAX_ENTITIES) -> DataFrame:
    """One row per place and profile, one share column per entity.

    Entities beyond the largest `max_entities` are added up under one heading, so every
    vote is in the row.  Headings are passed to the pivot, which then needs no extra pass.
    """
    unit = _unit(panel, spec)
    # Read for the headings and for the rows.
    panel = materialize(panel.select(*unit, "entidade_voto", "votos", "eleitorado", "comparecimento_estimado", "abstencao_estimado"), "panel")
    kept = leading_entities(panel, max_entities)
    named = F.when(F.col("entidade_voto").isin(kept), F.col("entidade_voto")).otherwise(OTHERS)
    work = panel.withColumn("entidade_voto", named).groupBy(*unit, "entidade_voto").agg(
        F.sum("votos").alias("votos"), *[F.max(c).alias(c) for c in ("eleitorado", "comparecimento_estimado", "abstencao_estimado")]
    )
    shares = share_within(work, unit, "votos", "share")
    headings = [*sorted(kept), OTHERS]

    def share_of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("entidade_voto") == name, F.col("share"))), F.lit(0.0)).alias(name)

    metrics = [F.max("eleitorado").alias("eleitorado"), F.max("abstencao_estimado").alias("__a"), F.max("comparecimento_estimado").alias("__c"), F.sum("votos").alias("votos")]
    wide = shares.groupBy(*unit).agg(*metrics, *[share_of(h) for h in headings])
    return wide.withColumns(
        {"taxa_abstencao": ratio("__a", "eleitorado"), "taxa_comparecimento": ratio("__c", "eleitorado")}
    ).drop("__a", "__c")

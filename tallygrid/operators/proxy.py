"""Ecological proxy: profile head counts spread over entities by their section share.

The shared key is the section.  Both sides are aggregated first, to vocabulary sizes, not row
counts, and multiplied by blocks of sections (`blocks`): a block makes one row per profile and
entity, whatever the number of its sections.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands, narrative
from ..functions.numbers import number, ratio
from ..functions.text import profile_combo, valid
from ..model import ELECTORAL, Spec
from ..session import materialize
from .blocks import leading_products, sum_of_products
from .core import by_level, level_location, roll_up, share_of_total, share_within, top_ranked, with_totals
from .order_statistics import ranked_spread


def section_shares(results: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL) -> DataFrame:
    """Share of every entity in every section contest."""
    rows = results.filter(valid(entity) & (number(results, "votos") > 0))
    votes = rows.groupBy(*spec.contest_keys, F.col(entity).alias("entidade")).agg(
        F.sum(number(results, "votos")).alias("votos")
    )
    return share_within(votes, spec.contest_keys, "votos", "share_secao")


def section_combos(electorate: DataFrame, on: Sequence[str], spec: Spec = ELECTORAL) -> DataFrame:
    cells = electorate.groupBy(*on, *spec.dims).agg(
        F.max(spec.place_name).alias(spec.place_name), F.sum(number(electorate, "eleitorado")).alias("eleitorado_perfil")
    )
    combos = cells.withColumn("perfil_combinado", profile_combo(spec)).filter(valid("perfil_combinado"))
    return combos.groupBy(*on, "perfil_combinado").agg(
        F.max(spec.place_name).alias(spec.place_name), F.sum("eleitorado_perfil").alias("eleitorado_perfil")
    )


def proxy_parts(electorate: DataFrame, results: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL, on: Sequence[str] | None = None) -> DataFrame:
    """Proxy votes per municipality, contest, entity and combined profile.

    The sum over sections of head counts times shares is a matrix product: sections of a place are
    multiplied by blocks, so no row per section, profile and entity is made.
    """
    keys = list(on or spec.section_keys)
    heads, shares = section_combos(electorate, keys, spec), section_shares(results, entity, spec)
    inner = [k for k in keys if k not in spec.place_keys]
    columns = [*[c for c in spec.contest if c not in inner], "entidade"]
    both = [c for c in spec.contest if c in inner]  # contests that the electorate has as well
    out = sum_of_products(heads, shares, [*spec.place_keys, *both], [k for k in inner if k not in both], ["perfil_combinado"], columns, "eleitorado_perfil", "share_secao", "votos_proxy")
    names = electorate.groupBy(*spec.place_keys).agg(F.max(spec.place_name).alias(spec.place_name))
    out = out.join(names, list(spec.place_keys))
    return out.select(*spec.place_keys, *spec.contest, "entidade", "perfil_combinado", spec.place_name, "votos_proxy")


def leading_cells(electorate: DataFrame, results: DataFrame, levels: Sequence[str], top: int, entity: str = "partido", spec: Spec = ELECTORAL) -> dict[str, DataFrame] | None:
    """Per level: votes of the profiles that can be an entity's `top`, with the entity's total as `votos_entidade_total`.

    Every level is a product over its own sections, cut where it is multiplied, so the cells of all
    profiles and entities of all places are never written.  That needs head counts that are not
    negative (parts of a place would cancel out): None if there are any.
    """
    keys = list(spec.section_keys)
    heads = materialize(section_combos(electorate, keys, spec), "section-combos")
    if not heads.filter(F.col("eleitorado_perfil") < 0).isEmpty():
        return None
    shares = materialize(section_shares(results, entity, spec), "section-shares")
    names = electorate.dropna(subset=spec.place_keys).groupBy(*spec.place_keys).agg(F.max(spec.place_name).alias(spec.place_name))
    out = {}
    for level in levels:
        scope = spec.level_scope(level)
        inner = [k for k in keys if k not in scope]
        cells = leading_products(heads, shares, scope, inner, ["perfil_combinado"], [*spec.contest, "entidade"], "eleitorado_perfil", "share_secao", "votos", "votos_entidade_total", top)
        if level == "municipio":
            cells = cells.join(names, spec.place_keys)
        out[level] = cells.withColumns(level_location(level, spec))
    return out


def _profiles_of_entities(cells: DataFrame, entities: DataFrame, contest_scope: Sequence[str], entity: str, top: int | None) -> DataFrame:
    entity_scope = [*contest_scope, "entidade"]
    entities = with_totals(entities, contest_scope, votos_lider=F.max("votos_entidade_total"))
    entities = ranked_spread(entities, contest_scope, F.round("votos_entidade_total", 6), ["entidade"], "rank_entidade")
    ranked = top_ranked(cells, entity_scope, F.round("votos", 6), ["perfil_combinado"], "rank_perfil_entidade_ano", top)
    return ranked.join(entities, entity_scope).withColumns(
        {
            "tipo_entidade": F.lit(entity),
            "share_perfil_na_entidade": ratio("votos", "votos_entidade_total"),
            "resultado_eleitoral": bands.outcome(),
            "margem_votos_para_lider": F.col("votos_lider") - F.col("votos_entidade_total"),
        }
    ).withColumn("descricao", narrative.entity_profile_text())


def leading_profiles(electorate: DataFrame, results: DataFrame, levels: Sequence[str], entity: str = "partido", spec: Spec = ELECTORAL, top: int = 10) -> list[DataFrame]:
    """`profile_entity_level` of every given level, from sections instead of written parts."""
    found = leading_cells(electorate, results, levels, top, entity, spec)
    if found is None:
        parts = materialize(proxy_parts(electorate, results, entity, spec), "proxy-parts")
        return [profile_entity_level(parts, level, entity, spec, top) for level in levels]
    out = []
    for level, cells in found.items():
        contest_scope = [*spec.level_scope(level), *spec.contest]
        entities = cells.groupBy(*contest_scope, "entidade").agg(F.max("votos_entidade_total").alias("votos_entidade_total"))
        out.append(_profiles_of_entities(cells.drop("votos_entidade_total"), entities, contest_scope, entity, top))
    return out


def leading_profiles_all_levels(electorate: DataFrame, results: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL, top: int = 10) -> DataFrame:
    """`profile_entity_all_levels` from sections instead of written parts."""
    found = leading_cells(electorate, results, list(spec.levels), top, entity, spec)
    if found is None:
        return profile_entity_all_levels(proxy_parts(electorate, results, entity, spec), entity, spec, top)
    cells = reduce(DataFrame.unionByName, found.values())
    scope = ["nivel", spec.period, spec.state, spec.place, *spec.contest, "entidade"]
    shares = cells.withColumn("share_perfil_na_entidade", ratio("votos", "votos_entidade_total")).drop("votos_entidade_total")
    ranked = top_ranked(shares, scope, F.round("votos", 6), ["perfil_combinado"], "rank_perfil_entidade_ano", top)
    return ranked.withColumn("tipo_entidade", F.lit(entity))


def profile_entity_level(parts: DataFrame, level: str, entity: str = "partido", spec: Spec = ELECTORAL, top: int | None = 10) -> DataFrame:
    """Profiles behind every entity of a level: totals, entity rank, leader, share, top rows.

    Proxy votes are sums of fractions, so ranks compare them at six decimals: the order in
    which partial sums arrive cannot change a rank.
    """
    contest_scope = [*spec.level_scope(level), *spec.contest]
    entity_scope = [*contest_scope, "entidade"]
    rows = parts.filter(valid("perfil_combinado") & valid("entidade") & (F.col("votos_proxy") > 0))
    cells = roll_up(rows, level, [*spec.contest, "entidade", "perfil_combinado"], [F.sum("votos_proxy").alias("votos")], spec)
    # Read for the entities' totals and for their profiles: the proxy is multiplied once.
    cells = materialize(cells, "proxy-cells")
    entities = cells.groupBy(*entity_scope).agg(F.sum("votos").alias("votos_entidade_total"))
    return _profiles_of_entities(cells, entities, contest_scope, entity, top)


def profile_entity_all_levels(parts: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL, top: int = 10) -> DataFrame:
    """All three levels from one pass over the parts, top profiles of every entity."""
    rows = parts.filter(valid("perfil_combinado") & valid("entidade"))
    levels = by_level(
        rows, [*spec.contest, "entidade", "perfil_combinado"], [F.sum("votos_proxy").alias("votos")], spec
    )
    scope = ["nivel", spec.period, spec.state, spec.place, *spec.contest, "entidade"]
    shares = share_of_total(levels, scope, "votos", "share_perfil_na_entidade")
    ranked = top_ranked(shares, scope, F.round("votos", 6), ["perfil_combinado"], "rank_perfil_entidade_ano", top)
    return ranked.withColumn("tipo_entidade", F.lit(entity))


def profile_entity_union(tables: Sequence[DataFrame], n: int = 10) -> DataFrame:
    keep = [
        "nivel", "ano", "uf", "cd_municipio", "nm_municipio", "cargo", "turno", "entidade", "perfil_combinado",
        "votos", "share_perfil_na_entidade", "rank_perfil_entidade_ano", "tipo_entidade", "descricao",
    ]
    parts = [t.filter(F.col("rank_perfil_entidade_ano") <= n).select(*keep) for t in tables]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

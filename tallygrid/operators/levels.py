"""Municipality, state and country tables.

Upper levels are rolled up from complete municipality rows and cut last; `truncated`
inputs (tables already cut to their top rows) can be passed in to get the lossy totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands, narrative
from ..functions.numbers import number, ratio
from ..functions.text import any_profile_valid, discrete, profile_combo, valid
from ..model import BALLOTS, ELECTORAL, TURNOUT, Spec
from .core import (
    by_level, join_null_safe, previous, roll_up, share_of_total, share_within, sums, top_ranked, unpivot,
    with_totals,
)
from .sections import contest_heads, section_electorate

SUMMARY_SUMS = ("qtd_municipios", "qtd_secoes", *TURNOUT, *BALLOTS)


def _rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "abstencao_media": ratio("abstencao_estimado", "eleitorado"),
            "comparecimento_medio": ratio("comparecimento_estimado", "eleitorado"),
        }
    )


def _sections(spec: Spec) -> Column:
    return F.countDistinct(F.concat_ws("|", spec.zone, spec.section)).alias("qtd_secoes")


def _shared(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if k in df.columns]


def summary_municipality(electorate: DataFrame, results: DataFrame, spec: Spec = ELECTORAL, rule: str = "max_or_dim_total") -> DataFrame:
    """Sections, head count, turnout and ballots per municipality and contest."""
    on = [*spec.place_keys, *_shared(electorate, spec.contest)]
    heads = section_electorate(
        electorate.filter(valid(spec.place)), spec, rule, [*spec.section_keys, *_shared(electorate, spec.contest)]
    )
    e = heads.groupBy(*on).agg(F.max(spec.place_name).alias(spec.place_name), _sections(spec), *sums(TURNOUT))
    votes = results.filter(valid(spec.place))
    r = votes.groupBy(*spec.place_keys, *spec.contest).agg(*[F.sum(number(results, m)).alias(m) for m in BALLOTS])
    joined = e.join(r, on, "left")
    cast_votes = F.coalesce(F.col("votos"), F.lit(0.0))
    out = joined.withColumns(
        {
            "nivel": F.lit("municipio"),
            "qtd_municipios": F.lit(1),
            "abstencao_estimado": F.coalesce(F.col("abstencao_estimado"), F.col("eleitorado") - cast_votes),
            "comparecimento_estimado": F.coalesce(F.col("comparecimento_estimado"), cast_votes),
            "validos_estimados": F.coalesce(F.col("validos_estimados"), F.col("votos"), F.lit(0.0)),
            "votos_vencedor": F.lit(0.0),
            **{m: F.coalesce(F.col(m), F.lit(0.0)) for m in ("votos", "brancos", "nulos")},
        }
    )
    return _rates(out)


def summary_from_sections(electorate: DataFrame, results: DataFrame, spec: Spec = ELECTORAL, rule: str = "max_or_dim_total") -> DataFrame:
    """The same table from a full outer join of sections: keeps sections seen on one side only."""
    contest = _shared(electorate, spec.contest)
    on = [*spec.section_keys, *contest]
    p = section_electorate(electorate, spec, rule, on)
    r = results.groupBy(*spec.contest_keys).agg(
        F.max(spec.place_name).alias("__name"), *[F.sum(number(results, m)).alias(m) for m in BALLOTS]
    )
    joined = p.join(r, on, "full_outer").withColumns(
        {
            spec.place_name: F.coalesce(F.col(spec.place_name), F.col("__name")),
            **{c: F.coalesce(F.col(c), F.lit("")) for c in spec.contest},
            **{m: F.coalesce(F.col(m), F.lit(0.0)) for m in (*TURNOUT, *BALLOTS)},
        }
    )
    out = joined.filter(valid(spec.place)).groupBy(*spec.place_keys, *spec.contest).agg(
        F.max(spec.place_name).alias(spec.place_name), _sections(spec), *sums([*TURNOUT, *BALLOTS])
    )
    return _rates(out.withColumns({"nivel": F.lit("municipio"), "qtd_municipios": F.lit(1)}))


def summary_from_winners(winners: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """The same table from section winners with head counts."""
    out = (
        winners.filter(valid(spec.place))
        .groupBy(*spec.place_keys, *spec.contest)
        .agg(
            F.max(spec.place_name).alias(spec.place_name),
            _sections(spec),
            F.sum("eleitorado_secao").alias("eleitorado"),
            F.sum("votos_total_secao").alias("votos"),
            F.sum("votos_vencedor").alias("votos_vencedor"),
        )
        .withColumns(
            {
                "nivel": F.lit("municipio"),
                "qtd_municipios": F.lit(1),
                "abstencao_estimado": F.col("eleitorado") - F.col("votos"),
                "comparecimento_estimado": F.col("votos"),
                "brancos": F.lit(0.0),
                "nulos": F.lit(0.0),
                "validos_estimados": F.col("votos"),
            }
        )
    )
    return _rates(out)


def summary_rollup(municipal: DataFrame, level: str, spec: Spec = ELECTORAL) -> DataFrame:
    return _rates(roll_up(municipal, level, spec.contest, sums(SUMMARY_SUMS), spec))


def profile_totals(electorate: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Head count, turnout and abstention per municipality and profile cell."""
    rows = electorate.filter(any_profile_valid(spec) & (number(electorate, "eleitorado") > 0) & valid(spec.place))
    return (
        rows.groupBy(*spec.place_keys, *spec.dims)
        .agg(F.max(spec.place_name).alias(spec.place_name), *[F.sum(number(electorate, m)).alias(m) for m in TURNOUT])
        .withColumn("perfil_combinado", profile_combo(spec))
        .filter(valid("perfil_combinado"))
    )


def profile_level(profiles: DataFrame, level: str, spec: Spec = ELECTORAL) -> DataFrame:
    """Profile cells of one level with share, rank, rates and a sentence.

    A scope holds at most one row per combination of profile values, whatever the number
    of people behind them.
    """
    keys = [*spec.dims, "perfil_combinado"]
    scope = spec.level_scope(level)
    cells = roll_up(profiles, level, keys, sums(TURNOUT), spec)
    ranked = top_ranked(cells, scope, "eleitorado", keys[::-1], "rank_perfil_ano")
    return share_within(ranked, scope, "eleitorado", "share_perfil").withColumns(
        {
            "qtd_eleitores_perfil": F.col("eleitorado"),
            "histograma_qtd_pessoas": F.col("eleitorado"),
            "taxa_comparecimento_perfil": ratio("comparecimento_estimado", "eleitorado"),
            "taxa_abstencao_perfil": ratio("abstencao_estimado", "eleitorado"),
            "descricao": narrative.leading_profile("perfil_combinado", "share_perfil"),
        }
    )


def profile_municipality(electorate: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    return profile_level(profile_totals(electorate, spec), "municipio", spec)


def result_totals(results: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL) -> DataFrame:
    """Ballots per municipality, contest and entity."""
    rows = results.filter(valid(entity) & (number(results, "votos") > 0) & valid(spec.place))
    return rows.groupBy(*spec.place_keys, *spec.contest, discrete(entity).alias("entidade")).agg(
        F.max(spec.place_name).alias(spec.place_name), *[F.sum(number(results, m)).alias(m) for m in BALLOTS]
    ).withColumn("tipo_entidade", F.lit(entity))


def results_level(totals: DataFrame, level: str, spec: Spec = ELECTORAL, top: int | None = 50) -> DataFrame:
    """Entities of one level: share, leader, rank, outcome and margins, cut to the top.

    Totals and leaders are aggregated and joined, and ranking is cut before the shuffle:
    a country-wide contest with any number of candidates never sits in one task.
    """
    keys = [*spec.contest, "entidade", "tipo_entidade"]
    scope = [*spec.level_scope(level), *spec.contest, "tipo_entidade"]
    rows = roll_up(totals, level, keys, sums(BALLOTS), spec)
    rows = with_totals(rows, scope, votos_total_disputa=F.sum("votos"), votos_lider=F.max("votos"))
    ranked = top_ranked(rows, scope, "votos", ["entidade"], "rank_entidade", top)
    return ranked.withColumns(
        {
            "share_votos": ratio("votos", "votos_total_disputa"),
            "resultado_eleitoral": bands.outcome(),
            "resultado_grupo": bands.outcome_group(),
            "margem_votos_para_lider": F.col("votos_lider") - F.col("votos"),
            "margem_share_para_lider": ratio(F.col("votos_lider") - F.col("votos"), "votos_total_disputa"),
        }
    ).withColumn("interpretacao_resultado", narrative.result_text())


def results_municipality(results: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL, top: int | None = 50) -> DataFrame:
    return results_level(result_totals(results, entity, spec), "municipio", spec, top)


def results_rollup(municipal: DataFrame, level: str, spec: Spec = ELECTORAL, top: int | None = 50) -> DataFrame:
    """From an existing municipality table; lossy if that table was cut."""
    return results_level(municipal, level, spec, top)


def top_profiles_all_levels(electorate: DataFrame, n: int = 10, spec: Spec = ELECTORAL) -> DataFrame:
    """The n largest combined profiles of the country, every state and every municipality."""
    cells = electorate.withColumn("perfil_combinado", profile_combo(spec)).groupBy(
        *spec.place_keys, "perfil_combinado"
    ).agg(F.max(spec.place_name).alias(spec.place_name), F.sum(number(electorate, "eleitorado")).alias("eleitorado"))
    cells = cells.filter(valid("perfil_combinado") & (F.col("eleitorado") > 0) & valid(spec.state) & valid(spec.place))
    levels = by_level(cells, ["perfil_combinado"], sums(["eleitorado"]), spec)
    scope = ["nivel", spec.period, spec.state, spec.place]
    shares = share_of_total(levels, scope, "eleitorado", "share_perfil")
    return top_ranked(shares, scope, "eleitorado", ["perfil_combinado"], "rank_perfil_ano", n).withColumn(
        "descricao",
        F.concat(F.lit("Perfil "), F.col("perfil_combinado"), F.lit(" representa "), narrative.percent("share_perfil"), F.lit(" do eleitorado.")),
    )


def top_profiles_union(tables: Sequence[DataFrame], n: int = 10) -> DataFrame:
    """Top rows of level tables under one another."""
    keep = ["nivel", "ano", "uf", "cd_municipio", "nm_municipio", "perfil_combinado", "eleitorado", "share_perfil", "rank_perfil_ano", "descricao"]
    parts = [t.filter(F.col("rank_perfil_ano") <= n).select(*keep) for t in tables]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def profile_by_period(electorate: DataFrame, spec: Spec = ELECTORAL, names: dict[str, str] | None = None) -> DataFrame:
    """Head count, share and rank of every value of every dimension, per period."""
    dims = names or {c: c.replace("perfil_", "") for c in spec.dims}
    cells = electorate.groupBy(spec.period, *dims).agg(F.sum(number(electorate, "eleitorado")).alias("eleitorado"))
    values = unpivot(cells, [spec.period], dims, "dimensao_perfil", "valor_perfil", ["eleitorado"])
    totals = (
        values.filter(valid("valor_perfil"))
        .groupBy(spec.period, "dimensao_perfil", "valor_perfil")
        .agg(F.sum("eleitorado").alias("eleitorado"))
        .filter(F.col("eleitorado") > 0)
    )
    scope = [spec.period, "dimensao_perfil"]
    ranked = top_ranked(totals, scope, "eleitorado", ["valor_perfil"], "rank_dimensao_ano")
    return share_within(ranked, scope, "eleitorado", "share_eleitorado_ano")


def timeline(electorate: DataFrame, scope: Sequence[str], label: str, spec: Spec = ELECTORAL, rule: str = "max_or_dim_total") -> DataFrame:
    """Section totals added up per period and scope."""
    sections = section_electorate(electorate, spec, rule, [*spec.section_keys, spec.place_name])
    return sections.groupBy(spec.period, *scope).agg(*sums(TURNOUT)).withColumn("tipo_timeline", F.lit(label))


def timelines_from_summary(municipal: DataFrame, spec: Spec = ELECTORAL) -> dict[str, DataFrame]:
    """Municipal, state and national series from the municipality summary."""
    scopes = {
        "timeline_municipal": [spec.state, spec.place, spec.place_name],
        "timeline_uf": [spec.state],
        "timeline_nacional": [],
    }
    return {
        name: municipal.groupBy(spec.period, *scope).agg(*sums(TURNOUT)).withColumn("tipo_timeline", F.lit(name))
        for name, scope in scopes.items()
    }


def municipal_portrait(municipal: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Municipality sums over contests, with mean rates."""
    keys = [*spec.place_keys, spec.place_name]
    return _rates(municipal.groupBy(*keys).agg(*sums([*TURNOUT, *BALLOTS, "qtd_secoes"])))


def electorate_portrait(electorate: DataFrame, results: DataFrame | None, spec: Spec = ELECTORAL, rule: str = "max_or_dim_total") -> DataFrame:
    """Electorate totals per municipality, with votes when results are given."""
    keys = [*spec.place_keys, spec.place_name]
    e = section_electorate(electorate, spec, rule, [*spec.section_keys, spec.place_name]).groupBy(*keys).agg(*sums(TURNOUT))
    if results is None:
        return e.withColumn("votos", F.lit(0.0))
    votes = results.groupBy(*keys).agg(F.sum(number(results, "votos")).alias("votos"))
    return e.join(votes, keys, "left").withColumn("votos", F.coalesce(F.col("votos"), F.lit(0.0)))


def candidate_profile(candidates: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Demographic combination of every candidate with the number of records."""
    keys = [*spec.place_keys, spec.place_name, spec.contest[0], spec.party, spec.candidate]
    rows = candidates.filter(valid(spec.candidate)).withColumn("perfil_candidato", profile_combo(spec))
    return rows.groupBy(*keys, "perfil_candidato").agg(F.count(F.lit(1)).alias("qtd_registros_candidato"))


CHANGE_METRICS = ("votos", "eleitorado", "pct_comparecimento", "pct_abstencao", "competitividade")


def consolidate_municipal(base: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL) -> DataFrame:
    """Leader, runner-up, margin and competitiveness per contest, with change over periods."""
    keys = [*spec.place_keys, spec.place_name, *spec.contest]
    metrics = [m for m in (*BALLOTS[:1], *TURNOUT, *BALLOTS[1:]) if m in base.columns]
    ballots = [m for m in metrics if m not in TURNOUT]
    by_entity = base.groupBy(*keys, F.col(entity).alias("entidade")).agg(*sums(ballots))
    heads = contest_heads(base, spec).groupBy(*keys).agg(*sums([m for m in metrics if m in TURNOUT]))
    lead = top_ranked(by_entity.select(*keys, "entidade", "votos"), keys, "votos", ["entidade"], "rk", 2)

    def place(rank: int, source: str) -> Column:
        return F.max(F.when(F.col("rk") == rank, F.col(source)))

    podium = lead.groupBy(*keys).agg(
        place(1, "entidade").alias("lider"), place(1, "votos").alias("votos_lider"),
        place(2, "entidade").alias("segundo"), place(2, "votos").alias("votos_segundo"),
    )
    out = join_null_safe(by_entity.groupBy(*keys).agg(*sums(ballots)), podium, keys, "left")
    out = join_null_safe(out, heads, keys, "left").select(*keys, *metrics, "lider", "votos_lider", "segundo", "votos_segundo")
    gap = F.coalesce(F.col("votos_lider"), F.lit(0.0)) - F.coalesce(F.col("votos_segundo"), F.lit(0.0))
    out = out.withColumns(
        {
            "pct_comparecimento": ratio("comparecimento_estimado", "eleitorado"),
            "pct_abstencao": ratio("abstencao_estimado", "eleitorado"),
            "margem_lider": ratio(gap, "votos"),
            "ano_num": F.col(spec.period).try_cast("int"),
        }
    )
    clipped = F.least(F.greatest(F.col("margem_lider"), F.lit(0.0)), F.lit(1.0))
    out = out.withColumn("competitividade", F.when(F.col("margem_lider").isNotNull(), 1 - clipped))
    series = [spec.state, spec.place, *spec.contest]
    out = previous(out, series, "ano_num", {m: f"{m}_lag" for m in CHANGE_METRICS})
    out = out.withColumns({f"{m}_delta": F.col(m) - F.col(f"{m}_lag") for m in CHANGE_METRICS})
    return out.withColumns({f"{m}_delta_pct": ratio(f"{m}_delta", F.abs(F.col(f"{m}_lag"))) for m in CHANGE_METRICS})


def timelines_full(base: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL) -> dict[str, DataFrame]:
    """National, state, municipal and entity series by office and round."""
    metrics = [m for m in (*BALLOTS[:1], *TURNOUT, *BALLOTS[1:]) if m in base.columns]

    turnout = [m for m in metrics if m in TURNOUT]
    ballots = [m for m in metrics if m not in TURNOUT]

    def series(scope: Sequence[str]) -> DataFrame:
        keys = [spec.period, *scope, *spec.contest]
        out = base.groupBy(*keys).agg(*sums(ballots))
        out = join_null_safe(out, contest_heads(base, spec).groupBy(*keys).agg(*sums(turnout)), keys, "left")
        return out.withColumns(
            {
                "pct_comparecimento": ratio("comparecimento_estimado", "eleitorado"),
                "pct_abstencao": ratio("abstencao_estimado", "eleitorado"),
            }
        )

    entities = base.groupBy(spec.period, *spec.contest, F.col(entity).alias("entidade")).agg(*sums(["votos"]))
    return {
        "timeline_nacional": series([]),
        "timeline_uf": series([spec.state]),
        "timeline_municipal": consolidate_municipal(base, entity, spec),
        "timeline_entidades": share_of_total(entities, [spec.period, *spec.contest], "votos", "share"),
    }

"""Scenario projection from section shares, with backtest and uncertainty bands."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.numbers import ratio
from ..functions.text import meaningful, safe_text
from ..model import ELECTORAL, TURNOUT, Spec
from ..session import materialize
from .analyses import clip01, dominant_values
from .core import average_rank, by_level, period_pairs, previous, safe_corr, share_of_total, share_within, sums, top_ranked
from .order_statistics import average_rank_spread

TARGET_YEAR = 2026
DEFAULT_SIGMA = 0.035
DEFAULT_CONFIDENCE = 0.35


@dataclass(frozen=True)
class Scenario:
    name: str
    trend_weight: float
    turnout_shift: float
    noise: float


# The six published parameter sets.
SCENARIOS = (
    Scenario("base", 0.60, 0.00, 1.00),
    Scenario("continuidade_historica", 0.30, 0.00, 0.80),
    Scenario("impulso_territorial", 0.90, 0.00, 1.15),
    Scenario("alta_abstencao", 0.50, -0.04, 1.25),
    Scenario("baixa_abstencao", 0.70, 0.03, 1.10),
    Scenario("maior_volatilidade", 0.80, 0.00, 1.80),
)


def place_columns(df: DataFrame, spec: Spec = ELECTORAL) -> list[str]:
    wanted = [spec.state, spec.place, spec.place_name, spec.zone, spec.section, "local_votacao", "bairro"]
    return [c for c in wanted if c in df.columns]


def unit_columns(model: DataFrame, spec: Spec = ELECTORAL) -> list[str]:
    return [*place_columns(model, spec), *spec.contest]


def model_base(base: DataFrame, entity: str = "partido", office: str | None = None, spec: Spec = ELECTORAL) -> DataFrame:
    """Entity shares per section contest and period.

    The office filter is a substring match that is ignored when nothing matches; the test
    is a scalar subquery, so no separate job runs.
    """
    rows = base
    if office:
        hit = F.contains(F.upper(F.col(spec.contest[0])), F.lit(office.upper()))
        anywhere = base.agg(F.coalesce(F.max(hit), F.lit(False)).alias("m")).scalar()
        rows = base.filter(hit | ~anywhere)
    keys = [spec.period, *unit_columns(base, spec)]
    named = safe_text(entity, "GERAL")
    out = rows.groupBy(*keys, named.alias("entidade")).agg(
        F.sum("votos").alias("votos"), *[F.max(m).alias(m) for m in TURNOUT]
    )
    return share_within(out, keys, "votos", "share").withColumn("ano_num", F.col(spec.period).try_cast("int"))


def backtest(model: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Error of forecasting each period by the one before it."""
    keys = [*unit_columns(model, spec), "entidade"]
    # One row per period: a handful of rows whatever the data size.
    periods = model.filter("ano_num is not null").select("ano_num").distinct()
    before = F.lag("ano_num").over(Window.partitionBy(F.lit(0)).orderBy("ano_num"))
    steps = periods.withColumn("base_year", before).filter("base_year is not null")
    real = model.join(steps, "ano_num").select(*keys, "base_year", F.col("ano_num").alias("target_year"), F.col("share").alias("real"))
    pred = model.select(*keys, F.col("ano_num").alias("base_year"), F.col("share").alias("pred"))
    joined = real.join(pred, [*keys, "base_year"]).dropna(subset=["real", "pred"])
    error = F.col("pred") - F.col("real")
    return joined.groupBy("base_year", "target_year").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(error)).alias("mae_share"), F.sqrt(F.avg(error * error)).alias("rmse_share")
    )


def temporal_confidence(model: DataFrame, spec: Spec = ELECTORAL, min_rows: int = 10, spread: bool = True) -> DataFrame:
    """Mean |Spearman| of section shares over period pairs, one row.

    A pair of periods covers every section of the country, so ranks are computed in
    ranges (spread=True); the plain window is for small inputs.
    """
    keys = [*unit_columns(model, spec), "entidade"]
    pairs = period_pairs(model.filter("ano_num is not null"), keys, "ano_num", "share").dropna(subset=["v1", "v2"])
    rank = average_rank_spread if spread else average_rank
    pairs = pairs.select("p1", "p2", "v1", "v2")
    if spread:
        # Read several times below (counts, ranks): written once to the shared folder.
        pairs = materialize(pairs, "period-pairs")
    ranked = rank(rank(pairs, ["p1", "p2"], "v1", "r1"), ["p1", "p2"], "v2", "r2")
    each = ranked.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n"), safe_corr("r1", "r2").alias("rho"))
    mean = F.avg(F.when(F.col("n") >= min_rows, F.abs("rho")))
    clipped = F.least(F.greatest(mean, F.lit(0.05)), F.lit(0.95))
    return each.agg(F.coalesce(clipped, F.lit(DEFAULT_CONFIDENCE)).alias("confianca"))


def historical_swing(model: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Share change since the previous observed period, per year."""
    keys = [*unit_columns(model, spec), "entidade"]
    out = previous(model, keys, "ano_num", {"share": "share_lag", "ano_num": "ano_lag"})
    out = out.withColumns({"swing": F.col("share") - F.col("share_lag"), "anos_delta": F.col("ano_num") - F.col("ano_lag")})
    return out.withColumn("swing_anual", F.when(F.col("anos_delta") > 0, F.col("swing") / F.col("anos_delta")))


def projection_base(model: DataFrame, spec: Spec = ELECTORAL, confidence: DataFrame | None = None, target: int = TARGET_YEAR, sigma: float = DEFAULT_SIGMA) -> DataFrame:
    """Rows of the latest period with the estimated swing, its spread and the confidence."""
    dated = model.filter("ano_num is not null")
    latest = dated.agg(F.max("ano_num").alias("y")).scalar()
    by_entity = [*spec.contest, "entidade"]
    swings = historical_swing(dated, spec).filter("swing_anual is not null").groupBy(*by_entity).agg(
        F.avg("swing_anual").alias("__mean"), F.stddev_samp("swing_anual").alias("__std")
    )
    trust = (confidence if confidence is not None else temporal_confidence(dated, spec)).scalar()
    out = dated.filter(F.col("ano_num") == latest).join(swings, by_entity, "left").withColumn("confianca_temporal_modelo", trust)
    spread = F.least(F.greatest(1.60 - F.col("confianca_temporal_modelo"), F.lit(0.70)), F.lit(1.80))
    years = F.least(F.greatest(F.lit(target) - F.col("ano_num"), F.lit(0)), F.lit(12))
    return out.withColumns(
        {
            "swing_anual_estimado": F.coalesce("__mean", F.lit(0.0)),
            "sigma_multiplicador_temporal": spread,
            "sigma_estimado": F.coalesce("__std", F.lit(sigma)) * spread,
            "anos_ate_alvo": years,
        }
    ).drop("__mean", "__std")


def _turnout(shift: Column | float) -> Column:
    seen = F.coalesce(ratio("comparecimento_estimado", F.when(F.col("eleitorado") > 0, F.col("eleitorado"))), F.lit(0.75))
    first = F.least(F.greatest(seen, F.lit(0.30)), F.lit(0.98))
    return F.least(F.greatest(first + shift, F.lit(0.30)), F.lit(0.98))


def scenario_projection(prepared: DataFrame, spec: Spec = ELECTORAL, scenarios: Sequence[Scenario] = SCENARIOS) -> DataFrame:
    """Projected share, turnout and votes of every section entity under every scenario.

    All scenarios are normalised side by side in one window, so the shuffle carries each
    row once; the rows are multiplied by the scenarios only at the end, in place.
    """
    unit = unit_columns(prepared, spec)
    w = Window.partitionBy(*unit)
    raw = {
        f"__raw{i}": F.greatest(
            F.coalesce("share", F.lit(0.0)) + s.trend_weight * F.col("swing_anual_estimado") * F.col("anos_ate_alvo"), F.lit(0.000001)
        )
        for i, s in enumerate(scenarios)
    }
    rows = prepared.withColumns(raw)
    rows = rows.withColumns({f"__sum{i}": F.sum(f"__raw{i}").over(w) for i in range(len(scenarios))})
    options = [
        F.struct(
            F.lit(s.name).alias("cenario"),
            (F.col(f"__raw{i}") / F.col(f"__sum{i}")).alias("share_pred_2026"),
            _turnout(s.turnout_shift).alias("pct_comparecimento_pred"),
        )
        for i, s in enumerate(scenarios)
    ]
    kept = [spec.period, "ano_num", *unit, "entidade", "share", "eleitorado", "swing_anual_estimado", "sigma_estimado", "confianca_temporal_modelo", "sigma_multiplicador_temporal"]
    out = rows.select(*kept, F.explode(F.array(*options)).alias("__s")).select(*kept, "__s.*")
    return out.withColumn(
        "votos_pred_2026", F.col("share_pred_2026") * F.coalesce("eleitorado", F.lit(0.0)) * F.col("pct_comparecimento_pred")
    )


def scenario_national(projected: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    scope = ["cenario", *spec.contest]
    out = projected.groupBy(*scope, "entidade").agg(*sums(["votos_pred_2026", "eleitorado"]))
    return share_of_total(out, scope, "votos_pred_2026", "share_nacional_pred_2026")


def _uniform(digest: Column, start: int) -> Column:
    """A number between 0 and 1 from 52 bits of a digest in hex."""
    return (F.conv(F.substring(digest, start, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


# The steps of the two sequences behind a normal value, the golden ratio and the root of two without their whole parts.
STEPS = (0.6180339887498949, 0.41421356237309515)


def normal_values(a: float, b: float, n: int) -> np.ndarray:
    """Standard normal values 1 to n of a rotated lattice: two sequences with irrational steps from random starts (Box-Muller)."""
    r = np.arange(1, n + 1)
    u, v = (np.maximum((x + r * step) - np.floor(x + r * step), 1e-12) for x, step in zip((a, b), STEPS, strict=True))
    return np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)


_VECTOR = "cenario string, {contest}, entidade string, start int, block array<double>"


def uncertainty_bands(
    prepared: DataFrame, n: int = 3000, seed: int = 42, spec: Spec = ELECTORAL, scenarios: Sequence[Scenario] = SCENARIOS,
    sigma: float = DEFAULT_SIGMA, held: int = 4096, block: int = 500,
) -> DataFrame:
    """Mean, quantiles and deviation of the national share over n noisy replicates.

    A section contest is one row with its entities in an array (a ballot bounds it), so its n
    replicates are drawn and normalised side by side, as vectors.  Noise starts from a digest of
    contest, entity and scenario, so it is the same whatever the partitioning.  A task adds vectors up
    by scenario, contest and entity, at most `held` of them before it passes them on in blocks of replicates;
    Spark adds those by replicate.  Quantiles are exact, over n values per entity.
    """
    unit = unit_columns(prepared, spec)
    entity = F.struct(
        "entidade", F.coalesce("share", F.lit(0.0)).alias("share"), F.coalesce("swing_anual_estimado", F.lit(0.0)).alias("swing"),
        F.coalesce("sigma_estimado", F.lit(sigma)).alias("sigma"), F.col("anos_ate_alvo").cast("double").alias("anos"),
        F.coalesce("eleitorado", F.lit(0.0)).alias("eleitorado"), _turnout(0.0).alias("turnout"),
    )
    contests = prepared.groupBy(*unit).agg(F.array_sort(F.collect_list(entity)).alias("itens")).select(
        *spec.contest, F.concat_ws("|", F.lit(str(seed)), *unit).alias("chave"), "itens"
    )
    plan = F.array(*[
        F.struct(F.lit(s.name).alias("cenario"), F.lit(s.trend_weight).alias("peso"), F.lit(s.turnout_shift).alias("desvio"), F.lit(s.noise).alias("ruido"))
        for s in scenarios
    ])
    def ready(e: Column) -> Column:
        digest = F.md5(F.concat_ws("|", "chave", F.col("s.cenario"), e["entidade"]))
        centre = e["share"] + F.col("s.peso") * e["swing"] * e["anos"]
        cast = e["eleitorado"] * F.least(F.greatest(e["turnout"] + F.col("s.desvio"), F.lit(0.30)), F.lit(0.98))
        return F.struct(
            e["entidade"].alias("entidade"), centre.alias("centro"), (e["sigma"] * F.col("s.ruido")).alias("raio"), cast.alias("votantes"),
            _uniform(digest, 1).alias("a"), _uniform(digest, 14).alias("b"),
        )

    scope = ["cenario", *spec.contest]
    # A row per contest and scenario, its entities' numbers in parallel arrays.
    names = ["entidade", "centro", "raio", "votantes", "a", "b"]
    packed = contests.select("*", F.explode(plan).alias("s")).select(F.col("s.cenario").alias("cenario"), *spec.contest, F.transform("itens", ready).alias("x"))
    packed = packed.select(*scope, *[F.col(f"x.{c}").alias(c) for c in names])

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}

        def passed() -> pd.DataFrame:
            rows = [(*key, start, each[start : start + block]) for key, each in sums.items() for start in range(0, n, block)]
            return pd.DataFrame(rows, columns=[*scope, "entidade", "start", "block"])

        for batch in batches:
            for row in batch.itertuples(index=False):
                group, (entities, *numbers) = row[: len(scope)], row[len(scope) :]
                centre, radius, cast, a, b = (np.asarray(x, float) for x in numbers)
                noise = np.stack([normal_values(x, y, n) for x, y in zip(a, b, strict=True)])
                raw = np.maximum(centre[:, None] + noise * radius[:, None], 1e-6)
                votes = raw / raw.sum(axis=0) * cast[:, None]
                for entity, each in zip(entities, votes, strict=True):
                    key = (*group, entity)
                    sums[key] = sums[key] + each if key in sums else each
                if len(sums) > held:
                    yield passed()
                    sums = {}
        if sums:
            yield passed()

    contest = ", ".join(f"{c} {kind}" for c, kind in packed.dtypes if c in spec.contest)
    votes = packed.mapInPandas(draw, _VECTOR.format(contest=contest)).select(*scope, "entidade", "start", F.posexplode("block").alias("i", "v"))
    votes = votes.withColumn("r", F.col("start") + F.col("i"))
    totals = votes.groupBy(*scope, "entidade", "r").agg(F.sum("v").alias("v"))
    shares = share_within(totals, [*scope, "r"], "v", "share")  # one row per entity of a contest
    # n values per group, a parameter
    q = F.percentile("share", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    out = shares.groupBy(*scope, "entidade").agg(
        F.count(F.lit(1)).alias("n_simulacoes"), F.avg("share").alias("share_medio"), q.alias("__q"), F.stddev_pop("share").alias("share_desvio")
    )
    return out.withColumns({f"share_{p}": F.col("__q")[i] for i, p in enumerate(("p05", "p50", "p95"))}).drop("__q")


# ---- party tables ---------------------------------------------------------------------


def party_history(model: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Votes and share of parties per level, contest and period."""
    rows = model.withColumn("partido", meaningful("entidade")).filter("partido <> ''")
    cells = rows.groupBy("ano_num", spec.state, spec.place, *spec.contest, "partido").agg(
        F.max(spec.place_name).alias(spec.place_name), F.sum("votos").alias("votos_historicos"), F.sum("eleitorado").alias("eleitorado_historico")
    )
    levels = by_level(cells.withColumnRenamed("ano_num", spec.period), [*spec.contest, "partido"], sums(["votos_historicos", "eleitorado_historico"]), spec)
    levels = levels.withColumnRenamed(spec.period, "ano_num")
    scope = ["nivel", "ano_num", spec.state, spec.place, *spec.contest]
    return share_of_total(levels, scope, "votos_historicos", "share_historico")


def party_profile_reference(base: DataFrame, level: str, spec: Spec = ELECTORAL) -> DataFrame:
    """Dominant value and share of every profile dimension among a party's weight."""
    rows = base.withColumns({"partido": meaningful("partido"), **{d: meaningful(d) for d in spec.dims}}).filter("partido <> ''")
    rows = rows.withColumn("__w", F.when(F.col("votos") > 0, F.col("votos")).otherwise(F.coalesce("eleitorado", F.lit(0.0))))
    keys = [*spec.levels[level], *([spec.place_name] if level == "municipio" else []), "partido"]
    totals = rows.groupBy(*keys).agg(
        F.sum("votos").alias("votos_historicos_perfil"), F.sum("eleitorado").alias("eleitorado_historico_perfil")
    )
    found = dominant_values(rows, keys, {d: d for d in spec.dims}, "__w", blank=None)
    out = totals.join(found, keys, "left")
    picked = [c for d in spec.dims for c in (F.col(d).alias(f"{d}_associado"), F.col(f"{d}__share").alias(f"{d}_share_associado"))]
    labels = ["faixa etaria", "sexo/genero", "escolaridade", "estado civil", "raca/cor"]
    words = [F.when(F.col(d).isNotNull(), F.concat(F.lit(name + ": "), F.col(d))) for d, name in zip(spec.dims, labels)]
    text = F.concat_ws("; ", *words)
    text = F.when(text == "", "Perfil de eleitor ainda insuficiente neste recorte.").otherwise(text)
    place = {c: (F.col(c) if c in keys else F.lit("")) for c in (spec.state, spec.place, spec.place_name)}
    return out.select(
        F.lit(level).alias("nivel"), *[c.alias(n) for n, c in place.items()], "partido", "votos_historicos_perfil",
        "eleitorado_historico_perfil", *picked, text.alias("perfil_eleitor_2026"),
    )


def _history_keys(spec: Spec) -> list[str]:
    return ["nivel", spec.state, spec.place, spec.place_name, *spec.contest, "partido"]


def party_trends(history: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """First and last share of a party, change, annual trend and label."""
    rows = history.filter("ano_num is not null")
    out = rows.groupBy(*_history_keys(spec)).agg(
        F.max("ano_num").alias("ano_base_historico"), F.max_by("share_historico", "ano_num").alias("share_historico_recente"),
        F.max_by("votos_historicos", "ano_num").alias("votos_historicos_recentes"), F.min("ano_num").alias("ano_inicial_historico"),
        F.min_by("share_historico", "ano_num").alias("share_historico_inicial"), F.countDistinct("ano_num").alias("qtd_anos_historicos"),
        # distinct calendar years of one party
        F.array_join(F.array_sort(F.collect_set(F.col("ano_num").cast("string"))), ", ").alias("anos_historicos"),
    )
    out = out.withColumn("delta_share_historico", F.col("share_historico_recente") - F.col("share_historico_inicial"))
    years = F.col("ano_base_historico") - F.col("ano_inicial_historico")
    return out.withColumns(
        {
            "tendencia_anual_share": F.when(years > 0, F.col("delta_share_historico") / years),
            "tendencia_partido": bands.delta_label("delta_share_historico"),
        }
    )


def party_historical_correlation(history: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Mean Spearman of party shares over consecutive periods of a place contest."""
    scope = ["nivel", spec.state, spec.place, spec.place_name, *spec.contest]
    rows = history.filter("ano_num is not null and share_historico is not null")
    years = rows.select(*scope, "ano_num").distinct()
    following = years.withColumn("p2", F.lead("ano_num").over(Window.partitionBy(*scope).orderBy("ano_num")))
    first = rows.join(following, [*scope, "ano_num"]).select(*scope, "partido", F.col("ano_num").alias("p1"), "p2", F.col("share_historico").alias("v1"))
    second = rows.select(*scope, "partido", F.col("ano_num").alias("p2"), F.col("share_historico").alias("v2"))
    pairs = first.join(second, [*scope, "partido", "p2"])
    # A contest in one place: as many rows as parties on the ballot.
    ranked = average_rank(average_rank(pairs, [*scope, "p1"], "v1", "r1"), [*scope, "p1"], "v2", "r2")
    each = ranked.groupBy(*scope, "p1", "p2").agg(F.count(F.lit(1)).alias("n"), safe_corr("r1", "r2").alias("rho")).filter("n >= 2 and rho is not null")
    means = each.groupBy(*scope).agg(
        F.avg("rho").alias("correlacao_historica_share_partidos"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("-", "p1", "p2"))), ", ").alias("pares_anos_correlacionados"),
    )
    counted = years.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("qtd_anos_historicos_recorte"),
        F.array_join(F.array_sort(F.collect_list(F.col("ano_num").cast("string"))), ", ").alias("anos_historicos_recorte"),
    )
    out = counted.join(means, scope, "left")
    return out.withColumns(
        {
            "pares_anos_correlacionados": F.coalesce("pares_anos_correlacionados", F.lit("")),
            "forca_correlacao_historica": bands.correlation_strength("correlacao_historica_share_partidos"),
        }
    )


def party_projection(
    projected: DataFrame, level: str, profiles: DataFrame, trends: DataFrame, correlation: DataFrame, spec: Spec = ELECTORAL
) -> DataFrame:
    """Scenario votes and share of parties at a level, with profile, trend and correlation."""
    rows = projected.withColumn("partido", meaningful("entidade")).filter("partido <> ''")
    place = [*spec.levels[level], *([spec.place_name] if level == "municipio" else [])]
    scope = ["cenario", *place, *spec.contest]
    out = rows.groupBy(*scope, "partido").agg(F.sum("votos_pred_2026").alias("votos_pred_2026"))
    out = share_of_total(out, scope, "votos_pred_2026", "share_pred_2026", "votos_validos_total_modelado")
    sections = rows.groupBy("cenario", *unit_columns(rows, spec)).agg(F.max("eleitorado").alias("eleitorado"))
    heads = sections.groupBy(*scope).agg(F.sum("eleitorado").alias("eleitorado_total_modelado"))
    out = out.join(heads, scope, "left").withColumns(
        {
            "nivel": F.lit(level),
            **{c: (F.col(c) if c in place else F.lit("")) for c in (spec.state, spec.place, spec.place_name)},
            "pct_votos_partido_2026": F.col("share_pred_2026"),
            "ano_simulado": F.lit(TARGET_YEAR),
        }
    )
    where = ["nivel", spec.state, spec.place, spec.place_name]
    out = out.join(profiles, [*where, "partido"], "left").join(trends, [*where, *spec.contest, "partido"], "left")
    out = out.join(correlation, [*where, *spec.contest], "left")
    return out.withColumn(
        "perfil_eleitor_2026", F.coalesce("perfil_eleitor_2026", F.lit("Perfil de eleitor ainda insuficiente neste recorte."))
    )


def decisive_places(projected: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Projected leader and runner-up of every section contest and how decisive it is."""
    scope = ["cenario", *unit_columns(projected, spec)]
    podium = top_ranked(projected, scope, F.round("share_pred_2026", 9), ["entidade"], "__r", 2)

    def at(rank: int, source: str, out: str) -> Column:
        return F.max(F.when(F.col("__r") == rank, F.col(source))).alias(out)

    out = podium.groupBy(*scope).agg(
        at(1, "entidade", "lider_pred"), at(1, "share_pred_2026", "share_lider_pred"), at(1, "votos_pred_2026", "votos_lider_pred"),
        at(2, "entidade", "segundo_pred"), at(2, "share_pred_2026", "share_segundo_pred"), at(2, "votos_pred_2026", "votos_segundo_pred"),
    )
    out = out.withColumn("margem_pred", F.col("share_lider_pred") - F.coalesce("share_segundo_pred", F.lit(0.0)))
    votes = F.coalesce("votos_lider_pred", F.lit(0.0)) + F.coalesce("votos_segundo_pred", F.lit(0.0))
    return out.withColumn("indice_decisivo", (1 - clip01(F.col("margem_pred"))) * F.log1p(votes))


def entity_contribution(model: DataFrame, projected: DataFrame, simulated: DataFrame | None = None, spec: Spec = ELECTORAL) -> DataFrame:
    """Latest period against the base scenario per entity, with bands when given."""
    keys = [*spec.contest, "entidade"]
    latest = model.agg(F.max("ano_num").alias("y")).scalar()
    now = model.filter(F.col("ano_num") == latest).groupBy(*keys).agg(
        F.sum("votos").alias("votos_base"), F.avg(F.coalesce("share", F.lit(0.0))).alias("share_medio_base"),
        F.sum("eleitorado").alias("eleitorado_base"), F.max("ano_num").alias("ano_base"),
    )
    then = projected.filter("cenario = 'base'").groupBy(*keys).agg(
        F.sum("votos_pred_2026").alias("votos_pred_2026"), F.avg("share_pred_2026").alias("share_pred_2026"),
        F.avg("swing_anual_estimado").alias("swing_anual_estimado"), F.avg("sigma_estimado").alias("sigma_estimado"),
    )
    out = now.join(then, keys, "full_outer").withColumn("delta_share_medio", F.col("share_pred_2026") - F.col("share_medio_base"))
    if simulated is not None:
        kept = ["share_medio", "share_p05", "share_p50", "share_p95", "share_desvio"]
        out = out.join(simulated.filter("cenario = 'base'").select(*keys, *kept), keys, "left")
    return out


# The premise sentence of every scenario.
PREMISES = {
    "base": "tendência histórica ponderada sem choque externo forte",
    "continuidade_historica": "menor peso para mudança brusca; maior estabilidade",
    "impulso_territorial": "maior peso para swing territorial observado",
    "alta_abstencao": "reduz comparecimento esperado",
    "baixa_abstencao": "aumenta comparecimento esperado",
    "maior_volatilidade": "aumenta ruído e dispersão do Monte Carlo",
}


def scenario_justification(projected: DataFrame) -> DataFrame:
    premise = F.lit("cenário parametrizado pelo modelo")
    for name, text in PREMISES.items():
        premise = F.when(F.col("cenario") == name, text).otherwise(premise)
    return projected.groupBy("cenario").agg(
        F.avg("swing_anual_estimado").alias("swing_medio"), F.avg("sigma_estimado").alias("sigma_medio"),
        F.sum("votos_pred_2026").alias("votos_preditos"),
    ).withColumn("premissa", premise)

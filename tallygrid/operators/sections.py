"""Operators at the finest grain: one polling section."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import narrative
from ..functions.numbers import number, ratio
from ..functions.text import any_profile_valid, discrete, meaningful, profile_combo, safe_text, valid
from ..model import BALLOTS, ELECTORAL, TURNOUT, Spec
from .core import join_null_safe, order_by_weight, share_within, sums, top1, totals_with_names

PLACE_DETAILS = ("local_votacao", "bairro")


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def _any(df: DataFrame, names: Sequence[str]) -> list[Column]:
    # max() instead of any_value(): same meaning for a functional dependency, but repeatable
    return [F.max(n).alias(n) for n in _present(df, names)]


def section_winners(results: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Leading party, candidate and number of every section contest, with its share.

    Both steps are plain aggregates: votes per entity, then the least struct
    (-votes, names), so nothing has to sort or hold a whole contest.
    """
    keys = [*spec.place_keys, spec.place_name, spec.zone, spec.section, *spec.contest]
    entity = [spec.party, spec.candidate, spec.number]
    votes = (
        results.select(*[discrete(c).alias(c) for c in [*keys, *entity]], number(results, "votos").alias("votos"))
        .filter(F.col("votos") > 0)
        .groupBy(*keys, *entity)
        .agg(F.sum("votos").alias("votos"))
    )
    lead = F.min(F.struct((-F.col("votos")).alias("votos"), *entity))
    return (
        votes.groupBy(*keys)
        .agg(lead.alias("lead"), F.sum("votos").alias("votos_total_secao"))
        .select(
            *keys,
            F.col(f"lead.{spec.party}").alias("partido_vencedor"),
            F.col(f"lead.{spec.candidate}").alias("candidato_vencedor"),
            F.col(f"lead.{spec.number}").alias("nr_votavel"),
            (-F.col("lead.votos")).alias("votos_vencedor"),
            "votos_total_secao",
        )
        .withColumn("share_vencedor", ratio("votos_vencedor", "votos_total_secao"))
    )


def section_electorate(electorate: DataFrame, spec: Spec = ELECTORAL, rule: str = "max_or_dim_total", on: Sequence[str] | None = None) -> DataFrame:
    """Head count, turnout and abstention of a section from its profile cells.

    rule='max' takes the largest cell (right when every cell repeats the section total),
    'sum' adds the cells, 'max_or_dim_total' takes the larger of the two readings, where
    the sum is taken per profile dimension over its valid values.
    """
    keys = list(on or spec.section_keys)
    names = [n for n in _present(electorate, [spec.place_name, *PLACE_DETAILS]) if n not in keys]
    value = {m: number(electorate, m) for m in TURNOUT}
    largest = {} if rule == "sum" else value
    added = value if rule == "sum" else {}
    by_dim = {f"__{d}_{m}": F.when(valid(d), v) for m, v in value.items() for d in spec.dims} if rule not in ("sum", "max") else {}
    found = totals_with_names(electorate, keys, names, added | by_dim, largest)
    if by_dim:
        found = found.withColumns({m: F.greatest(m, *[f"__{d}_{m}" for d in spec.dims]) for m in value})
    return found.select(*keys, *names, *TURNOUT)


def profile_cells(electorate: DataFrame, keys: Sequence[str], spec: Spec = ELECTORAL, weight: str = "eleitorado", out: str = "eleitorado_perfil", extra: Sequence[str] = ()) -> DataFrame:
    """Head count per key and profile cell, cells without any valid dimension dropped."""
    rows = electorate.filter(any_profile_valid(spec) & (number(electorate, weight) > 0))
    return (
        rows.groupBy(*keys, *spec.dims)
        .agg(F.sum(number(electorate, weight)).alias(out), *[F.sum(number(electorate, e)).alias(e) for e in extra if e != out])
        .withColumn("perfil_combinado", profile_combo(spec))
    )


def predominant_profile(electorate: DataFrame, keys: Sequence[str], spec: Spec = ELECTORAL) -> DataFrame:
    """The heaviest profile cell per key, with its dimensions."""
    cells = profile_cells(electorate, keys, spec).filter(valid("perfil_combinado"))
    return top1(cells, keys, "eleitorado_perfil", ["perfil_combinado", *spec.dims])


def section_winner_profile(results: DataFrame, electorate: DataFrame, spec: Spec = ELECTORAL, on: Sequence[str] | None = None, rule: str = "max_or_dim_total") -> DataFrame:
    """Winners with the section's head count and predominant profile."""
    keys = list(on or spec.section_keys)
    electorate = electorate.withColumns({k: discrete(k) for k in keys})  # filled as the winners' keys are
    heads = section_electorate(electorate, spec, rule, keys).select(
        *keys, F.col("eleitorado").alias("eleitorado_secao")
    )
    profile = predominant_profile(electorate, keys, spec).select(
        *keys, F.col("perfil_combinado").alias("perfil_predominante_secao")
    )
    return section_winners(results, spec).join(heads, keys, "left").join(profile, keys, "left")


def contest_heads(base: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Head counts once per section contest; the wide base repeats them on every entity's row."""
    keys = _present(base, [*spec.contest_keys, spec.place_name, *PLACE_DETAILS])
    return base.groupBy(*keys).agg(*[F.max(m).alias(m) for m in _present(base, TURNOUT)])


def section_entity_results(base: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL) -> DataFrame:
    """Votes, share, rank and abstention of every entity in every section contest."""
    keys = _present(base, [*spec.contest_keys, spec.place_name, *PLACE_DETAILS])
    rows = base.groupBy(*keys, F.col(entity).alias("entidade")).agg(
        F.sum("votos").alias("votos"),
        *[F.max(m).alias(m) for m in _present(base, TURNOUT)],
        *sums(_present(base, ["brancos", "nulos"])),
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by_weight("votos", ["entidade"])))
    return share_within(
        rows.withColumn("rank", rank.cast("long")), keys, "votos", "share"
    ).withColumn("taxa_abstencao", ratio("abstencao_estimado", "eleitorado"))


def section_results_ranked(base: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL) -> DataFrame:
    """Winner against runner-up in every section contest, with margins and a remark."""
    keys = _present(base, [*spec.contest_keys, spec.place_name, *PLACE_DETAILS])
    ranked = section_entity_results(base, entity, spec)
    ahead = Window.partitionBy(*keys).orderBy("rank")
    with_second = ranked.withColumns(
        {
            "segundo_colocado": F.lead("entidade").over(ahead),
            "votos_segundo": F.coalesce(F.lead("votos").over(ahead), F.lit(0)),
            "share_segundo": F.coalesce(F.lead("share").over(ahead), F.lit(0.0)),
        }
    )
    winners = with_second.filter(F.col("rank") == 1).drop("rank")
    renamed = winners.withColumnsRenamed(
        {"entidade": "vencedor_secao", "votos": "votos_vencedor", "share": "share_vencedor"}
    )
    return renamed.withColumns(
        {
            "margem_votos": F.col("votos_vencedor") - F.col("votos_segundo"),
            "margem_share": F.col("share_vencedor") - F.col("share_segundo"),
        }
    ).withColumn("como_ganhou", narrative.how_won())


def section_winner_explained(base: DataFrame, electorate: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL, on: Sequence[str] | None = None) -> DataFrame:
    """Winners with the leading value of each profile dimension and a reason text."""
    keys = list(on or spec.section_keys)
    dims = {c: c.replace("perfil_", "") for c in spec.dims}
    # One aggregate per section: a struct minimum per dimension over pre-summed values.
    values = electorate.filter(number(electorate, "eleitorado") > 0).select(
        *keys, number(electorate, "eleitorado").alias("e"), *[safe_text(c).alias(n) for c, n in dims.items()]
    ).unpivot([*keys, "e"], list(dims.values()), "dim", "valor")
    totals = values.filter(F.col("valor") != "").groupBy(*keys, "dim", "valor").agg(F.sum("e").alias("e"))
    best = top1(totals, [*keys, "dim"], "e", ["valor"])
    item = F.concat(F.col("dim"), F.lit(": "), F.col("valor"), F.lit(" ("), F.col("e").cast("long").cast("string"), F.lit(" eleitores)"))
    by_dim = [F.max(F.when(F.col("dim") == n, item)) for n in dims.values()]
    profile = best.groupBy(*keys).agg(F.concat_ws("; ", *by_dim).alias("perfil_predominante_secao"))
    out = join_null_safe(section_results_ranked(base, entity, spec), profile, keys, "left")
    reasons = F.concat_ws(
        "; ",
        F.when(F.col("share_vencedor").isNotNull(), F.format_string("teve %.2f%% dos votos validos/registrados no recorte", F.col("share_vencedor") * 100)),
        F.when(F.col("margem_share").isNotNull(), F.format_string("abriu margem de %.2f pontos percentuais sobre o segundo", F.col("margem_share") * 100)),
        F.when(F.col("taxa_abstencao").isNotNull(), F.format_string("a abstencao observada foi %.2f%%", F.col("taxa_abstencao") * 100)),
        F.when(F.coalesce(F.col("perfil_predominante_secao"), F.lit("")) != "", F.concat(F.lit("o perfil predominante da secao foi "), F.col("perfil_predominante_secao"))),
    )
    return out.withColumn("por_que_ganhou_proxy", reasons)


def section_abstention(base: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Turnout, abstention and blank+null rates of every section contest."""
    keys = _present(base, [*spec.contest_keys, spec.place_name])
    out = base.groupBy(*keys).agg(
        *[F.max(m).alias(m) for m in TURNOUT],
        *sums(["brancos", "nulos", "votos"]),
    )
    return out.withColumns(
        {
            "taxa_abstencao": ratio("abstencao_estimado", "eleitorado"),
            "taxa_comparecimento": ratio("comparecimento_estimado", "eleitorado"),
            "taxa_brancos_nulos": ratio(F.col("brancos") + F.col("nulos"), "votos"),
        }
    )


def section_profile_cache(electorate: DataFrame, spec: Spec = ELECTORAL, on: Sequence[str] | None = None, rule: str = "max_or_dim_total") -> DataFrame:
    """Every profile cell of a section with the section totals and its rank."""
    keys = list(on or spec.section_keys)
    cells = profile_cells(electorate, keys, spec).filter(valid("perfil_combinado"))
    heads = section_electorate(electorate, spec, rule, keys)
    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*order_by_weight("eleitorado_perfil", ["perfil_combinado", *spec.dims]))
    )
    return join_null_safe(cells, heads, keys, "left").withColumn("rn_perfil_secao", rank.cast("long"))


def section_results_cache(results: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Votes, blanks, nulls and valid votes per section, party, candidate and number."""
    entity = [spec.party, spec.candidate, spec.number]
    rows = results.filter(number(results, "votos") > 0).withColumns({e: discrete(e) for e in entity})
    return rows.groupBy(*spec.contest_keys, *entity).agg(
        F.max(spec.place_name).alias(spec.place_name), *[F.sum(number(results, m)).alias(m) for m in BALLOTS]
    )


def section_candidates(candidates: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Candidate records per section with counts."""
    dims = {c: c.replace("perfil_", "candidato_") for c in spec.dims}
    keep = [spec.party, spec.candidate, "nr_candidato", "sq_candidato", "situacao_candidatura", "resultado_candidatura"]
    known = valid(spec.candidate) | valid("nr_candidato") | valid(spec.party)
    rows = candidates.filter(known).select(
        *spec.contest_keys,
        spec.place_name,
        *[discrete(c).alias(c) for c in keep],
        *[discrete(c).alias(n) for c, n in dims.items()],
    )
    return rows.groupBy(*spec.contest_keys, *keep, *dims.values()).agg(
        F.max(spec.place_name).alias(spec.place_name), F.count(F.lit(1)).alias("qtd_registros_candidato")
    )


def section_base(results: DataFrame, electorate: DataFrame, spec: Spec = ELECTORAL, on: Sequence[str] | None = None, rule: str = "max_or_dim_total") -> DataFrame:
    """Results with the section totals and the predominant profile in one wide row.

    Three aggregates of the inputs, then two left joins on the section key: every join
    side is already reduced to at most one row per section.
    """
    keys = list(on or spec.section_keys)
    ballots = {m: number(results, m) for m in BALLOTS}
    votes = totals_with_names(results.filter(ballots["votos"] > 0), [*spec.contest_keys, spec.party, spec.candidate], [spec.place_name], ballots, {})
    heads = section_electorate(electorate, spec, rule, keys).withColumnRenamed(spec.place_name, "__name")
    profile = predominant_profile(electorate, keys, spec).select(*keys, *spec.dims)
    joined = join_null_safe(join_null_safe(votes, heads, keys, "left"), profile, keys, "left")
    return joined.withColumn(
        spec.place_name, F.coalesce(F.nullif(F.col(spec.place_name), F.lit("")), F.col("__name"))
    ).withColumn("entidade", F.col(spec.party)).drop("__name")


def section_profile_rows(electorate: DataFrame, spec: Spec = ELECTORAL, on: Sequence[str] | None = None) -> DataFrame:
    """Profile cells of a section with the largest totals seen in the cell."""
    keys = list(on or spec.section_keys)
    rows = electorate.filter(any_profile_valid(spec) & (number(electorate, "eleitorado") > 0))
    return (
        rows.groupBy(*keys, *spec.dims)
        .agg(
            *_any(rows, [spec.place_name, *PLACE_DETAILS]),
            F.sum(number(electorate, "eleitorado")).alias("eleitorado_perfil"),
            F.max(number(electorate, "eleitorado")).alias("eleitorado_secao"),
            *[F.max(number(electorate, m)).alias(m) for m in TURNOUT[1:]],
        )
        .withColumns({"perfil_combinado": profile_combo(spec), "nivel": F.lit("secao")})
    )


def choose_entity(df: DataFrame, preferred: Sequence[str] = ("candidato", "partido"), fallback: str = "GERAL") -> Column:
    """The first entity column holding any value (runs one short job), else a constant."""
    present = _present(df, preferred)
    if present:
        found = df.select(*[F.max(meaningful(c) != "").alias(c) for c in present]).first()
        for name in present:
            if found[name]:
                return F.col(name)
    return F.lit(fallback)

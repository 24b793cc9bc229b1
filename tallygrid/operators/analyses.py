"""Electoral analyses over the section base, the results and the electorate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands, narrative
from ..functions.numbers import number, ratio
from ..functions.text import has_text, meaningful, profile_combo, safe_text, valid
from ..model import ELECTORAL, TURNOUT, Spec
from ..session import materialize
from .blocks import sum_of_products
from .core import by_level, previous, share_of_total, share_within, sums, top1, top_ranked, unpivot


def short_dims(spec: Spec = ELECTORAL) -> dict[str, str]:
    return {c: c.replace("perfil_", "") for c in spec.dims}


def _votes(df: DataFrame, keys: Sequence[str], entity: str) -> DataFrame:
    return df.groupBy(*keys, F.col(entity).alias("entidade")).agg(F.sum(number(df, "votos")).alias("votos"))


def electorate_profiles(base: DataFrame, entity: str = "partido", dims: Sequence[str] | None = None, spec: Spec = ELECTORAL) -> DataFrame:
    """Votes of every entity inside every full profile, with its share there."""
    dims = list(dims or spec.dim_columns[:4])
    scope = [spec.period, *spec.contest, *dims]
    rows = base.withColumns({d: safe_text(d) for d in dims})
    unit = list(dict.fromkeys([*spec.contest_keys, *dims]))  # an entity's rows in a section repeat its head counts
    once = rows.groupBy(*unit, F.col(entity).alias("entidade")).agg(F.sum("votos").alias("votos"), *[F.max(m).alias(m) for m in TURNOUT])
    rows = once.groupBy(*scope, "entidade").agg(*sums(["votos", *TURNOUT]))
    return share_within(rows, scope, "votos", "share_no_perfil").withColumn(
        "taxa_abstencao_perfil", ratio("abstencao_estimado", "eleitorado")
    )


def profile_by_year(electorate: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Share and rank of every written value of every dimension, per year."""
    dims = short_dims(spec)
    heads = electorate.filter(number(electorate, "eleitorado") > 0)
    cells = heads.groupBy(spec.period, *dims).agg(F.sum(number(heads, "eleitorado")).alias("eleitorado"))
    values = unpivot(cells, [spec.period], dims, "dimensao_perfil", "valor_perfil", ["eleitorado"])
    totals = values.filter(has_text("valor_perfil")).groupBy(spec.period, "dimensao_perfil", "valor_perfil").agg(
        F.sum("eleitorado").alias("eleitorado")
    )
    scope = [spec.period, "dimensao_perfil"]
    ranked = top_ranked(totals, scope, "eleitorado", ["valor_perfil"], "rank_dimensao_ano")
    return share_within(ranked, scope, "eleitorado", "share_eleitorado_ano")


def profile_vote_association(
    results: DataFrame, electorate: DataFrame, entity: str = "partido", top: int = 3, global_from: str = "all",
    spec: Spec = ELECTORAL, on: Sequence[str] | None = None,
) -> DataFrame:
    """Proxy share and lift of every leading entity inside every profile value.

    Only the `top` entities of a section contest take part.  global_from='all' measures the
    global share over every vote, 'top' over the votes of those leading rows only.
    """
    keys = list(on or spec.section_keys)
    scope = [*keys, *spec.contest]
    cast_votes = results.filter(has_text(entity) & (number(results, "votos") > 0))
    by_place = share_within(_votes(cast_votes, scope, entity), scope, "votos", "share_entidade_recorte")
    leading = top_ranked(by_place, scope, "votos", ["entidade"], "rank_entidade_recorte", top)

    contest = [spec.period, *spec.contest]
    source = leading if global_from == "top" else by_place
    world = share_of_total(
        source.groupBy(*contest, "entidade").agg(F.sum("votos").alias("__v")), contest, "__v", "share_global_entidade"
    ).drop("__v")

    dims = short_dims(spec)
    heads = electorate.filter(number(electorate, "eleitorado") > 0)
    cells = heads.groupBy(*keys, *dims).agg(F.sum(number(heads, "eleitorado")).alias("e"))
    values = unpivot(cells, keys, dims, "dimensao_perfil", "valor_perfil", ["e"]).filter(has_text("valor_perfil"))
    profile = values.groupBy(*keys, "dimensao_perfil", "valor_perfil").agg(F.sum("e").alias("e"))
    people = profile.groupBy(spec.period, "dimensao_perfil", "valor_perfil").agg(
        F.sum("e").alias("eleitorado_perfil_recorte")
    )
    proxy = (
        profile.join(leading, keys)
        .groupBy(*contest, "dimensao_perfil", "valor_perfil", "entidade")
        .agg(F.sum(F.col("e") * F.col("share_entidade_recorte")).alias("votos_proxy_perfil_entidade"))
    )
    out = proxy.join(people, [spec.period, "dimensao_perfil", "valor_perfil"], "left").join(
        world, [*contest, "entidade"], "left"
    )
    out = out.withColumn("share_proxy_no_perfil", ratio("votos_proxy_perfil_entidade", "eleitorado_perfil_recorte"))
    return out.withColumn("lift_perfil_entidade_proxy", ratio("share_proxy_no_perfil", "share_global_entidade"))


def result_electorate_correlation(results: DataFrame, electorate: DataFrame, spec: Spec = ELECTORAL, **options) -> DataFrame:
    """The association for parties and for candidates, one under the other.

    Votes per section contest, party and candidate and heads per section and profile cell are written once, for both.
    """
    keys = list(options.get("on") or spec.section_keys)
    votes, heads = number(results, "votos"), number(electorate, "eleitorado")
    cast_votes = results.filter(votes > 0).groupBy(*keys, *spec.contest, spec.party, spec.candidate).agg(F.sum(votes).alias("votos"))
    cells = electorate.filter(heads > 0).groupBy(*keys, *spec.dims).agg(F.sum(heads).alias("eleitorado"))
    results, electorate = materialize(cast_votes, "association-votes", free=True), materialize(cells, "association-heads", free=True)
    parts = [
        profile_vote_association(results, electorate, kind, spec=spec, **options).withColumn("tipo_entidade", F.lit(kind))
        for kind in (spec.party, spec.candidate)
    ]
    return parts[0].unionByName(parts[1])


def vote_trends(results: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL) -> DataFrame:
    """Share per period with change since the previous observed period."""
    contest = [spec.period, *spec.contest]
    out = share_of_total(_votes(results, contest, entity), contest, "votos", "share")
    out = out.withColumn("ano_num", F.col(spec.period).try_cast("int"))
    out = previous(out, [*spec.contest, "entidade"], "ano_num", {"votos": "votos_lag", "share": "share_lag"})
    out = out.withColumns(
        {"delta_votos": F.col("votos") - F.col("votos_lag"), "delta_share": F.col("share") - F.col("share_lag")}
    )
    curve = F.when(F.col("delta_share") > 0, "crescimento").when(F.col("delta_share") < 0, "queda").otherwise("estavel/sem_lag")
    return out.withColumns(
        {"crescimento_votos_pct": ratio("delta_votos", F.abs(F.col("votos_lag"))), "curva": curve}
    )


def _patterns(cells: DataFrame, keys: list[str], measure: str, share: str, rank: str, n: int, spec: Spec) -> DataFrame:
    """Top combinations per level and period, then change over periods among the kept rows."""
    levels = by_level(cells, [*keys, "perfil_combinado"], sums([measure]), spec)
    scope = ["nivel", spec.period, spec.state, spec.place, *keys]
    shares = share_of_total(levels, scope, measure, share)
    top = top_ranked(shares, scope, F.round(measure, 6), ["perfil_combinado"], rank, n)
    top = top.withColumn("ano_num", F.col(spec.period).try_cast("int"))
    series = ["nivel", spec.state, spec.place, *keys, "perfil_combinado"]
    top = previous(top, series, "ano_num", {share: f"{share}_ano_anterior", measure: f"{measure}_ano_anterior"})
    return top.withColumns(
        {
            f"{share}_delta": F.col(share) - F.col(f"{share}_ano_anterior"),
            f"{measure}_delta": F.col(measure) - F.col(f"{measure}_ano_anterior"),
        }
    ).withColumn("padrao_temporal", bands.delta_label(f"{share}_delta"))


def annual_profile_patterns(electorate: DataFrame, n: int = 10, spec: Spec = ELECTORAL) -> DataFrame:
    cells = electorate.groupBy(*spec.place_keys, *spec.dims).agg(
        F.max(spec.place_name).alias(spec.place_name), F.sum(number(electorate, "eleitorado")).alias("eleitorado")
    )
    cells = cells.withColumn("perfil_combinado", profile_combo(spec)).filter(valid("perfil_combinado"))
    return _patterns(cells, [], "eleitorado", "share_perfil", "rank_perfil_ano", n, spec)


def annual_entity_profile_patterns(base: DataFrame, entity: str = "partido", n: int = 10, spec: Spec = ELECTORAL) -> DataFrame:
    rows = base.filter(meaningful(entity) != "")
    cells = rows.groupBy(*spec.place_keys, F.col(entity).alias("entidade"), *spec.dims).agg(
        F.max(spec.place_name).alias(spec.place_name), F.sum("votos").alias("votos")
    )
    cells = cells.withColumn("perfil_combinado", profile_combo(spec)).filter(valid("perfil_combinado"))
    out = _patterns(cells, ["entidade"], "votos", "share_perfil_na_entidade", "rank_perfil_entidade_ano", n, spec)
    return out.withColumn("tipo_entidade", F.lit(entity))


def top_profiles_by_scope(electorate: DataFrame, n: int = 10, spec: Spec = ELECTORAL) -> DataFrame:
    scope = (
        F.when(F.col("nivel") == "brasil", "Federacao").when(F.col("nivel") == "estado", F.col(spec.state))
        .otherwise(F.col(spec.place_name))
    )
    text = F.concat(
        F.col("perfil_combinado"), F.lit(" representa "), narrative.percent("share_perfil"), F.lit(" do eleitorado em "),
        F.col(spec.period), F.lit(" no nivel "), F.col("nivel"), F.lit("."),
    )
    return annual_profile_patterns(electorate, n, spec).withColumns({"escopo": scope, "descricao": text})


def party_identification(results: DataFrame, spec: Spec = ELECTORAL, extra: Sequence[str] = ("ideologia", "coalizao")) -> DataFrame:
    """Party share per place, split by ideology and coalition where those columns exist."""
    more = [c for c in extra if c in results.columns]
    place = [*spec.place_keys, *spec.contest]
    out = results.groupBy(*place, *more, spec.party).agg(F.sum(number(results, "votos")).alias("votos"))
    out = share_of_total(out, place, "votos", "share_partidario")
    return out.withColumns({f"{c}_disponivel_no_dado": F.lit(c in more) for c in extra})


def dominant_values(df: DataFrame, keys: Sequence[str], dims: dict[str, str], weight: str, blank: str | None = "SEM_VALOR") -> DataFrame:
    """Per key: heaviest value of each dimension and its weight, one column pair per dimension.

    blank=None leaves out rows without a value instead of counting them under a word.
    """
    text = {c: safe_text(c, blank or "") for c in dims}
    cells = df.withColumns(text).groupBy(*keys, *dims).agg(F.sum(weight).alias("__w"))
    values = unpivot(cells, keys, dims, "__dim", "__value", ["__w"])
    if blank is None:
        values = values.filter(has_text("__value"))
    totals = values.groupBy(*keys, "__dim", "__value").agg(F.sum("__w").alias("__w"))
    totals = share_within(totals, [*keys, "__dim"], "__w", "__share")
    best = top1(totals, [*keys, "__dim"], "__w", ["__value"], ["__share"])
    picks: list[Column] = []
    for name in dims.values():
        here = F.col("__dim") == name
        picks += [
            F.max(F.when(here, F.col("__value"))).alias(name),
            F.max(F.when(here, F.col("__w"))).alias(f"{name}__peso"),
            F.max(F.when(here, F.col("__share"))).alias(f"{name}__share"),
        ]
    return best.groupBy(*keys).agg(*picks)


def entity_voter_profile(base: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL, keys: Sequence[str] | None = None) -> DataFrame:
    """Dominant value and share of every dimension among the votes of an entity."""
    keys = list(keys or [spec.period, *spec.contest, entity])
    rows = base.filter(has_text(entity))
    totals = rows.groupBy(*keys).agg(F.sum("votos").alias(f"votos_{entity}"))
    found = dominant_values(rows, keys, {c: c for c in spec.dims}, "votos")
    out = totals.join(found, keys, "left")
    picked = []
    for c in spec.dims:
        picked += [
            F.col(c).alias(f"{c}_dominante"),
            ratio(f"{c}__peso", f"votos_{entity}").alias(f"{c}_share_no_{entity}"),
        ]
    words = [F.concat(F.lit(c.replace("perfil_", "") + ": "), F.col(c)) for c in spec.dims]
    person = F.concat(F.lit(f"Eleitor predominante do {entity}: "), F.concat_ws("; ", *words))
    return out.select(
        *keys, f"votos_{entity}", *picked, person.alias(f"pessoa_do_{entity}"),
        F.lit(entity).alias("tipo_entidade"), F.col(entity).alias("entidade"),
    )


def leading_names(df: DataFrame, keys: Sequence[str], column: str, weight: str, n: int, out: str) -> DataFrame:
    """The n heaviest values joined in order; ranking is cut before values are collected."""
    totals = df.groupBy(*keys, column).agg(F.sum(weight).alias("__w"))
    top = top_ranked(totals, keys, F.round("__w", 6), [column], "__r", n).filter(has_text(column))
    ordered = F.array_sort(F.collect_list(F.struct("__r", column)))
    return top.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x[column]), "; ").alias(out))


def candidate_with_electorate(base: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Candidates with their main states and places and the profile of their electorate."""
    keys = [spec.period, *spec.contest, spec.party, spec.candidate]
    rows = base.filter(has_text(spec.candidate))
    out = entity_voter_profile(rows, spec.candidate, spec, keys)
    out = out.join(leading_names(rows, keys, spec.state, "votos", 5, "ufs_principais"), keys, "left")
    out = out.join(leading_names(rows, keys, spec.place_name, "votos", 5, "municipios_principais"), keys, "left")
    renamed = {f"{c}_dominante": f"{c}_eleitorado_associado" for c in spec.dims}
    return out.withColumnsRenamed(renamed).drop(*[f"{c}_share_no_{spec.candidate}" for c in spec.dims])


def _place_shares(results: DataFrame, entity: str, spec: Spec) -> DataFrame:
    place = [*spec.place_keys, *spec.contest]
    return share_of_total(_votes(results, place, entity), place, "votos", "share")


def rejection_proxy(results: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL) -> DataFrame:
    return _place_shares(results, entity, spec).withColumn("proxy_rejeicao_territorial", 1 - F.col("share"))


def clip01(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def crystallisation(results: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL) -> DataFrame:
    """Mean share damped by its spread over periods; null with a single period."""
    keys = [spec.state, spec.place, *spec.contest, "entidade"]
    out = _place_shares(results, entity, spec).groupBy(*keys).agg(
        F.avg("share").alias("share_medio"), F.stddev_samp("share").alias("share_std"),
        F.count("share").alias("anos_observados"), F.sum("votos").alias("votos_total"),
    )
    index = F.col("share_medio") * (1 - clip01(F.coalesce(F.col("share_std"), F.lit(0.0))))
    return out.withColumn("indice_cristalizacao", F.when(F.col("anos_observados") > 1, index))


def transfer_matrix(results: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL, contest_in_scope: bool = False) -> DataFrame:
    """Territorial co-occurrence of shares between periods, normalised by origin.

    The result itself is the entity x entity matrix per period pair: a product of place x entity
    matrices, multiplied by blocks of places, so a block of places makes one row per pair.
    """
    keys = [spec.state, spec.place, *spec.contest]
    shares = _place_shares(results, entity, spec).withColumn("y", F.col(spec.period).try_cast("int")).filter("y is not null")
    origin = shares.select(*keys, F.col("y").alias("ano_origem"), F.col("entidade").alias("entidade_origem"), F.col("share").alias("a"))
    target = shares.select(*keys, F.col("y").alias("ano_destino"), F.col("entidade").alias("entidade_destino"), F.col("share").alias("b"))
    own = list(spec.contest) if contest_in_scope else []
    inner = [k for k in keys if k not in own]
    scores = sum_of_products(origin, target, own, inner, ["ano_origem", "entidade_origem"], ["ano_destino", "entidade_destino"], "a", "b", "score_coocorrencia")
    scores = scores.filter(F.col("ano_origem") < F.col("ano_destino"))
    scope = ["ano_origem", "ano_destino", *own]
    return share_of_total(scores, [*scope, "entidade_origem"], "score_coocorrencia", "transferencia_proxy")


def strategic_vote(results: DataFrame, entity: str = "partido", spec: Spec = ELECTORAL) -> DataFrame:
    """Concentration on the first two and weight of small entities, against the previous period."""
    place = [*spec.place_keys, *spec.contest]
    shares = _place_shares(results, entity, spec)
    two = top_ranked(shares, place, "share", ["entidade"], "__r", 2).groupBy(*place).agg(F.sum("share").alias("top2_share"))
    rest = shares.groupBy(*place).agg(
        F.coalesce(F.sum(F.when(F.col("share") < 0.05, F.col("share"))), F.lit(0.0)).alias("menor_share"),
        F.countDistinct("entidade").alias("entidades"),
    )
    out = two.join(rest, place).withColumn("ano_num", F.col(spec.period).try_cast("int"))
    series = [spec.state, spec.place, *spec.contest]
    out = previous(out, series, "ano_num", {"top2_share": "top2_share_lag", "menor_share": "menor_share_lag"})
    change = (F.col("top2_share") - F.col("top2_share_lag")) + (F.col("menor_share_lag") - F.col("menor_share"))
    return out.withColumn("indicador_voto_util_proxy", change)


def qa_facts(electorate: DataFrame, association: DataFrame, winners: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """The numbers behind the question-and-answer report, as (fato, chave, valor)."""
    def facts(df: DataFrame, name: str, key: Column, value: Column) -> DataFrame:
        return df.select(F.lit(name).alias("fato"), key.alias("chave"), value.cast("double").alias("valor"))

    leading = profile_by_year(electorate, spec).filter(F.col("rank_dimensao_ano") == 1)
    lifts = association.orderBy(
        F.round("lift_perfil_entidade_proxy", 6).desc_nulls_last(),
        *[spec.period, *spec.contest, "dimensao_perfil", "valor_perfil", "entidade"],
    ).limit(12)
    often = winners.groupBy("vencedor_secao").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "vencedor_secao").limit(8)
    totals = winners.agg(
        F.count(F.lit(1)).alias("recortes"), F.avg("share_vencedor").alias("share_medio_vencedor"),
        F.avg("margem_share").alias("margem_media"),
        F.sum(F.when(F.col("margem_share") < 0.03, 1).otherwise(0)).alias("vitorias_apertadas"),
    )
    summary = totals.select(*[F.col(c).cast("double").alias(c) for c in totals.columns]).unpivot(
        [], totals.columns, "chave", "valor"
    )
    parts = [
        facts(leading, "perfil_dominante", F.concat_ws("|", spec.period, "dimensao_perfil", "valor_perfil"), F.col("share_eleitorado_ano")),
        facts(lifts, "maior_lift", F.concat_ws("|", spec.period, *spec.contest, "dimensao_perfil", "valor_perfil", "entidade"), F.col("lift_perfil_entidade_proxy")),
        facts(often, "vencedor_recorrente", F.col("vencedor_secao"), F.col("n")),
        summary.select(F.lit("resumo_vitorias").alias("fato"), "chave", "valor"),
    ]
    return reduce(DataFrame.unionByName, parts)

"""Questions asked of the gold tables: filters, top lists and small roll-ups.

Lists end in orderBy + limit, which Spark runs as a per-task top-k; nothing is sorted whole.
Ties are broken by the remaining visible columns, so lists are reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.numbers import ratio
from ..functions.text import valid
from ..model import ELECTORAL, Spec
from ..operators.core import share_of_total, sums, top1, top_ranked, unpivot

STATUS_COLUMNS = (
    "resultado_eleitoral", "situacao_eleitoral", "situacao_total", "situacao", "ds_sit_tot_turno", "situacao_turno", "status_eleicao",
)
RANK_COLUMNS = ("rank_entidade", "rank_partido", "rank_candidato", "rank")
YEAR_COLUMNS = ("ano", "ano_correlacao", "ano_num")
PARTY_COLUMNS = ("partido", "entidade", "partido_vencedor", "sg_partido", "nm_partido")
VOTE_COLUMNS = ("votos", "votos_pred_2026", "votos_vencedor", "qt_votos", "votos_total_secao", "qt_votos_nominais")


def first_column(df: DataFrame, names: Sequence[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def gold_filters(df: DataFrame, uf: str | None = None, municipio: str | None = None, ano: str | None = None, cenario: str | None = None, nivel: str | None = None) -> DataFrame:
    """Optional equality filters; a municipality is 'code|name' or a name."""
    if uf and "uf" in df.columns:
        df = df.filter(F.col("uf") == uf)
    if municipio:
        code, bar, _ = municipio.partition("|")
        if bar and "cd_municipio" in df.columns:
            df = df.filter(F.col("cd_municipio") == code)
        elif "nm_municipio" in df.columns:
            df = df.filter(F.col("nm_municipio") == municipio)
    year = first_column(df, YEAR_COLUMNS)
    if ano and year:
        df = df.filter(F.col(year).cast("string") == str(ano))
    if cenario and "cenario" in df.columns:
        df = df.filter(F.col("cenario") == cenario)
    if nivel and "nivel" in df.columns:
        df = df.filter(F.lower("nivel") == nivel.lower())
    return df


def head(df: DataFrame, order: Sequence[Column], n: int | None) -> DataFrame:
    ties = [F.col(f"`{c}`").asc_nulls_last() for c in sorted(df.columns)]
    ordered = df.orderBy(*order, *ties)
    return ordered.limit(n) if n is not None else ordered


def down(name: str) -> Column:
    return F.round(name, 6).desc_nulls_last()


def with_winner_priority(df: DataFrame) -> DataFrame:
    """Status text, else rank, turned into resultado_eleitoral and a 0/1 priority."""
    status = first_column(df, STATUS_COLUMNS)
    if status:
        label = bands.elected_status(status)
        return df.withColumns({"resultado_eleitoral": label, "__first": (label == "eleito").cast("int")})
    rank = first_column(df, RANK_COLUMNS)
    if rank:
        return df.withColumns({"resultado_eleitoral": bands.elected_by_rank(rank), "__first": (F.col(rank) == 1).cast("int")})
    return df.withColumn("__first", F.lit(0))


def places(municipal: DataFrame, uf: str, n: int | None = None) -> DataFrame:
    rows = municipal.filter(valid("nm_municipio") & (F.col("uf") == uf))
    pairs = rows.select(F.concat_ws("|", "cd_municipio", "nm_municipio").alias("value"), F.col("nm_municipio").alias("label"))
    return head(pairs.distinct(), [F.col("label")], n)


def top_profiles(profiles: DataFrame, nivel: str = "brasil", n: int = 10, **where) -> DataFrame:
    rows = gold_filters(profiles, nivel=nivel, **where).filter(valid("perfil_combinado"))
    if "share_perfil" not in rows.columns:
        rows = share_of_total(rows, [], first_column(rows, ["eleitorado", "votos", "peso"]), "share_perfil")
    keep = ["nivel", "ano", "uf", "cd_municipio", "nm_municipio", "perfil_combinado", "share_perfil", "eleitorado", "rank_perfil_ano"]
    rows = rows.select(*[c for c in keep if c in rows.columns])
    return head(rows, [F.col("rank_perfil_ano").asc(), down("share_perfil"), down("eleitorado")], n)


def profile_distribution(table: DataFrame, ano: str | None = None, n: int | None = 24, spec: Spec = ELECTORAL) -> DataFrame:
    """Dimension shares from a long (dimensao, valor) table or a wide profile table."""
    rows = gold_filters(table, ano=ano)
    if {"dimensao_perfil", "valor_perfil"} <= set(rows.columns):
        rows = rows.filter(valid("valor_perfil") & ~F.lower("dimensao_perfil").rlike("biometria|data|hora"))
        out = rows.groupBy("ano", "dimensao_perfil", "valor_perfil").agg(
            F.sum("eleitorado").alias("peso"), F.avg("share_eleitorado_ano").alias("share")
        )
    else:
        weight = first_column(rows, ["eleitorado", "votos"])
        long = unpivot(rows, ["ano"], spec.dims, "dimensao_perfil", "valor_perfil", [weight]).filter(valid("valor_perfil"))
        out = long.groupBy("ano", "dimensao_perfil", "valor_perfil").agg(F.sum(weight).alias("peso"))
        out = share_of_total(out, ["ano", "dimensao_perfil"], "peso", "share")
    return head(out, [down("peso")], n)


def party_projection_view(projection: DataFrame, n: int = 20, cenario: str = "base", **where) -> DataFrame:
    rows = gold_filters(projection, cenario=cenario, **where).filter(valid("partido"))
    keep = ["cenario", "nivel", "uf", "cd_municipio", "nm_municipio", "cargo", "turno", "partido", "share_pred_2026", "votos_pred_2026"]
    return head(rows.select(*keep), [down("share_pred_2026")], n)


def state_map(projection: DataFrame | None, history: DataFrame | None = None, cenario: str = "base", ano: str | None = None) -> DataFrame:
    """Leading party of every state, from the projection, else from past results."""
    if projection is not None:
        rows = gold_filters(projection, cenario=cenario, ano=ano).filter(valid("uf") & valid("partido"))
        totals = rows.groupBy("uf", "partido").agg(F.max("share_pred_2026").alias("share_pred_2026"), F.sum("votos_pred_2026").alias("votos_pred_2026"))
        source = "simulacao_2026"
    else:
        party, votes = first_column(history, PARTY_COLUMNS), first_column(history, VOTE_COLUMNS)
        rows = gold_filters(history, ano=ano).filter(valid("uf") & valid(party))
        totals = rows.groupBy("uf", F.col(party).alias("partido")).agg(F.sum(votes).alias("votos_pred_2026")).filter("votos_pred_2026 > 0")
        totals = share_of_total(totals, ["uf"], "votos_pred_2026", "share_pred_2026")
        source = "historico_processado"
    ranked = totals.withColumn("__s", F.round("share_pred_2026", 6))
    best = top1(ranked, ["uf"], "__s", ["partido"], ["share_pred_2026", "votos_pred_2026"])
    return best.drop("__s").withColumn("fonte", F.lit(source))


def historical_party(results: DataFrame, n: int | None = 20, **where) -> DataFrame:
    """Votes and share per party, elected first."""
    party, votes = first_column(results, PARTY_COLUMNS), first_column(results, VOTE_COLUMNS)
    rows = with_winner_priority(gold_filters(results, **where).filter(valid(party)))
    keys = [F.col(party).alias("partido"), *([F.col("resultado_eleitoral")] if "resultado_eleitoral" in rows.columns else [])]
    totals = rows.groupBy(*keys).agg(F.sum(votes).alias("votos_pred_2026"), F.max("__first").alias("__first")).filter("votos_pred_2026 > 0")
    out = share_of_total(totals, [], "votos_pred_2026", "share_pred_2026")
    return head(out, [F.desc("__first"), down("share_pred_2026")], n).drop("__first")


def quick_party(level_results: DataFrame, nivel: str = "brasil", n: int = 20, **where) -> DataFrame:
    party = first_column(level_results, ["partido", "entidade"])
    rows = with_winner_priority(gold_filters(level_results, nivel=nivel, **where).filter(valid(party)))
    keep = ["nivel", "ano", "uf", "cd_municipio", "nm_municipio", "cargo", "turno", "resultado_eleitoral", "share_votos", "votos", "rank_entidade"]
    rows = rows.select(F.col(party).alias("partido"), *keep, "__first")
    return head(rows, [F.desc("__first"), down("share_votos")], n).drop("__first")


def entity_results(level_results: DataFrame, nivel: str = "brasil", n: int = 20, **where) -> DataFrame:
    rows = with_winner_priority(gold_filters(level_results, nivel=nivel, **where).filter(valid("entidade")))
    keep = ["nivel", "ano", "uf", "cd_municipio", "nm_municipio", "cargo", "turno", "resultado_eleitoral", "entidade", "tipo_entidade", "votos", "share_votos", "rank_entidade"]
    return head(rows.select(*keep, "__first"), [F.desc("__first"), down("share_votos")], n).drop("__first")


def entity_profiles(level_profiles: DataFrame, nivel: str = "brasil", n: int = 20, **where) -> DataFrame:
    rows = gold_filters(level_profiles, nivel=nivel, **where).filter(valid("entidade") & valid("perfil_combinado"))
    keep = ["nivel", "ano", "uf", "cd_municipio", "nm_municipio", "cargo", "turno", "entidade", "perfil_combinado", "votos", "share_perfil_na_entidade", "rank_perfil_entidade_ano", "tipo_entidade"]
    return head(rows.select(*keep), [down("share_perfil_na_entidade")], n)


def cluster_personas_view(clusters: DataFrame, nivel: str = "brasil", n: int = 20, **where) -> DataFrame:
    rows = gold_filters(clusters, nivel=nivel, **where).filter(valid("perfil_combinado"))
    keep = ["nivel", "ano", "uf", "cd_municipio", "nm_municipio", "cluster_id", "cluster_tipo", "perfil_combinado", "partido", "eleitorado", "votos_proxy", "share_cluster", "rank_persona_cluster"]
    return head(rows.select(*keep), [down("share_cluster")], n)


def metrics_by_year(table: DataFrame, **where) -> DataFrame:
    names = ["votos", "eleitorado", "comparecimento_estimado", "abstencao_estimado", "votos_total", "eleitorado_total", "comparecimento_medio", "abstencao_media"]
    rows = gold_filters(table, **where)
    year = first_column(rows, YEAR_COLUMNS)
    return rows.groupBy(F.col(year).cast("string").alias("ano")).agg(*sums([c for c in names if c in rows.columns]))


def table_preview(table: DataFrame, n: int = 100) -> DataFrame:
    """The first rows in the order of all columns."""
    return table.orderBy(*[f"`{c}`" for c in table.columns]).limit(n)


def latest_period(table: DataFrame, column: str = "ano") -> DataFrame:
    """Rows of the largest numeric period; everything when no period is a number."""
    number = F.col(column).try_cast("double")
    latest = table.agg(F.max(number).alias("m")).scalar()
    return table.filter(F.coalesce(number == latest, latest.isNull()))


def people_estimate(profiles: DataFrame, summary: DataFrame) -> DataFrame:
    """Share times the largest head count of the summary."""
    total = summary.agg(F.max("eleitorado").alias("m")).scalar()
    return profiles.withColumn("pessoas_perfil_estimado", F.greatest(F.coalesce("share_perfil", F.lit(0.0)), F.lit(0.0)) * total)


def place_party_matrix(results: DataFrame, n_places: int = 24, n_parties: int = 12, place: str = "nm_municipio", party: str = "partido") -> DataFrame:
    """Votes of the leading parties (columns) in the leading places (rows)."""
    def leading(column: str, n: int) -> DataFrame:
        return head(results.groupBy(column).agg(F.sum("votos").alias("v")), [down("v")], n).select(column)

    headings = [r[0] for r in leading(party, n_parties).collect()]  # at most n_parties names
    rows = results.filter(F.col(party).isin(headings)).join(leading(place, n_places), place, "left_semi")
    return rows.groupBy(place).pivot(party, headings).agg(F.sum("votos")).fillna(0, headings)


def place_summary(municipal: DataFrame) -> DataFrame:
    """Votes, mean rates, periods and the most frequent leader of every place."""
    keys = ["uf", "cd_municipio"]
    totals = municipal.groupBy(*keys).agg(
        F.max("nm_municipio").alias("nm_municipio"), F.sum("votos").alias("votos"), F.avg("pct_abstencao").alias("abstencao_media"),
        F.avg("pct_comparecimento").alias("comparecimento_medio"), F.array_join(F.array_sort(F.collect_set("ano")), ", ").alias("anos"),
    )
    often = municipal.filter(valid("lider")).groupBy(*keys, "lider").agg(F.count(F.lit(1)).alias("__n"))
    return totals.join(top1(often, keys, "__n", ["lider"]).drop("__n"), keys, "left")


def winners_losers_split(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Winning and other rows, by status text, else by rank."""
    if "resultado_eleitoral" in results.columns:
        status = F.lower(F.coalesce("resultado_eleitoral", F.lit("")))
        won = status.rlike("vencedor|eleito|ganhou")
    elif "rank_entidade" in results.columns:
        won = F.coalesce(F.col("rank_entidade") == 1, F.lit(False))
    else:
        won = F.lit(False)
    return results.filter(won), results.filter(~won)


def cluster_discriminant_view(discriminants: DataFrame, n: int = 30) -> DataFrame:
    rows = discriminants.filter(valid("valor_discriminado"))
    return head(rows.select("cluster", "campo_discriminado", "valor_discriminado", "lift_vs_global"), [down("lift_vs_global")], n)


def entity_profile_cards(table: DataFrame, nivel: str | None = None, n: int = 10, **where) -> DataFrame:
    """Entity and profile pairs by lift, then share."""
    entity = first_column(table, ["entidade", "partido", "candidato"])
    profile = first_column(table, ["perfil_combinado", "valor_perfil"])
    share = first_column(table, ["share_perfil_na_entidade", "share_proxy_no_perfil", "share_perfil", "share_pred_2026"])
    lift = first_column(table, ["lift_perfil_entidade_proxy", "lift"])
    rows = gold_filters(table, nivel=nivel, **where).filter(valid(entity) & valid(profile))
    keep = [c for c in ("nivel", "ano", "uf", "cd_municipio", "nm_municipio", "cargo", "turno", "padrao_temporal") if c in rows.columns]
    named = [F.col(entity).alias("entidade"), F.col(profile).alias("perfil"), F.col(share).alias("share")]
    out = rows.select(*keep, *named, *([F.col(lift).alias("lift")] if lift else []))
    return head(out, [*([down("lift")] if lift else []), down("share")], n)


def kpis(table: DataFrame, totals: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    return table.agg(*sums(totals), *[F.countDistinct(F.nullif(F.col(c), F.lit(""))).alias(f"qtd_{c}") for c in distinct])


def state_metrics(timeline_uf: DataFrame, n: int | None = None) -> DataFrame:
    names = [c for c in ("eleitorado", "comparecimento_estimado", "abstencao_estimado", "votos") if c in timeline_uf.columns]
    return head(timeline_uf.groupBy("uf").agg(*sums(names)), [down(names[0])], n)


def place_snapshot(municipal: DataFrame, uf: str, n: int = 50, by_period: bool = True) -> DataFrame:
    names = [c for c in ("eleitorado", "votos", "comparecimento_estimado", "abstencao_estimado", "comparecimento_medio", "abstencao_media") if c in municipal.columns]
    keys = ["uf", "cd_municipio", "nm_municipio", *(["ano"] if by_period else [])]
    return head(municipal.filter(F.col("uf") == uf).groupBy(*keys).agg(*sums(names)), [down("eleitorado")], n)


def place_party_snapshot(winners: DataFrame, uf: str, n: int = 50) -> DataFrame:
    party, votes = first_column(winners, ["partido_vencedor", *PARTY_COLUMNS]), first_column(winners, ["votos_vencedor", *VOTE_COLUMNS])
    rows = winners.filter((F.col("uf") == uf) & valid(party))
    totals = rows.groupBy("cd_municipio", "nm_municipio", F.col(party).alias("partido")).agg(F.sum(votes).alias("votos"))
    return head(totals, [down("votos")], 3 * n)


def party_votes_by_state(results: DataFrame) -> dict[str, DataFrame]:
    """Party sums and shares per state, and the national sums built from them."""
    party, votes = first_column(results, PARTY_COLUMNS), first_column(results, VOTE_COLUMNS)
    state = results.filter(valid(party)).groupBy("uf", F.col(party).alias("partido")).agg(F.sum(votes).alias("votos")).filter("votos > 0")
    nation = state.groupBy("partido").agg(F.sum("votos").alias("votos"))
    return {"estado": share_of_total(state, ["uf"], "votos", "share"), "brasil": share_of_total(nation, [], "votos", "share")}


def top_lists(municipal: DataFrame, entities: DataFrame) -> dict[str, DataFrame]:
    """States by votes and by mean rates, places by mean abstention, entities of the latest period."""
    def mean_by(keys: Sequence[str], metric: str, n: int) -> DataFrame:
        return head(municipal.groupBy(*keys).agg(F.avg(metric).alias(metric)).filter(F.col(metric).isNotNull()), [down(metric)], n)

    return {
        "votos_por_uf": head(municipal.groupBy("uf").agg(F.sum("votos").alias("votos")), [down("votos")], 30),
        "abstencao_por_uf": mean_by(["uf"], "pct_abstencao", 30),
        "comparecimento_por_uf": mean_by(["uf"], "pct_comparecimento", 30),
        "municipios_maior_abstencao": mean_by(["uf", "nm_municipio"], "pct_abstencao", 25),
        "entidades_ano_recente": head(latest_period(entities).groupBy("entidade").agg(F.sum("votos").alias("votos")), [down("votos")], 25),
    }


def top_states_per_cluster(clustered: DataFrame, cluster: str = "cluster", n: int = 5) -> DataFrame:
    counts = clustered.groupBy(cluster, "uf").agg(F.count(F.lit(1)).alias("qtd"))
    return top_ranked(counts, [cluster], "qtd", ["uf"], "rank", n)

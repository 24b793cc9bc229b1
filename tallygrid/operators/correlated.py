"""Results, electorate and candidates related through territorial codes and periods."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import field_label
from ..functions.numbers import ratio
from ..functions.text import (
    correlation_year, entity_label, has_text, path_year, path_years, safe_text, section_codes,
)
from ..model import ELECTORAL, Spec
from .core import period_pairs, share_within, sums, text_list, top_ranked, unpivot
from .order_statistics import pair_correlations

SECTOR_KEYS = [
    "ano_correlacao", "uf", "cd_municipio", "nm_municipio", "zona", "secao", "local_votacao", "bairro",
    "codigo_municipio", "codigo_setor_eleitoral", "codigo_correlacao_setor_ano",
]
CONTEST_KEYS = [*SECTOR_KEYS, "cargo", "turno"]
SECTOR_JOIN = ["ano_correlacao", "uf", "cd_municipio", "zona", "secao"]
CANDIDATE_JOIN = ["ano_correlacao", "cargo", "partido", "candidato"]


def family_flags(text: Column, spec: Spec = ELECTORAL) -> dict[str, Column]:
    """Result / electorate / candidate flags from path words or metrics; first true names the family."""
    profile = reduce(or_, [has_text(d) for d in spec.dims])
    is_result = text.rlike("resultado|votacao|vota") | (F.col("votos") > 0) | (F.col("validos_estimados") > 0)
    is_electorate = text.rlike("eleitorado|perfil_eleitor") | (F.col("eleitorado") > 0) | profile
    is_candidate = text.rlike("candidato|cand|partido|coligacao|colig") | has_text(spec.candidate) | has_text(spec.party)
    family = F.when(is_result, "resultado").when(is_electorate, "eleitorado").when(is_candidate, "candidato").otherwise("outros")
    return {"eh_resultado": is_result, "eh_eleitorado": is_electorate, "eh_candidato": is_candidate, "familia_dado": family}


def annotate_gold(gold: DataFrame, metadata: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Gold rows with source metadata, correlation year, territorial codes and family."""
    described = ["dominio_documento", "assunto_documento", "tipo_arquivo_json"]
    meta = metadata.groupBy("arquivo_origem").agg(*[F.max(c).alias(c) for c in described])
    out = gold.join(meta, "arquivo_origem", "left").withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in described})
    out = out.withColumns({"ano_conteudo_original": safe_text(spec.period), "ano_nome_arquivo": path_year("arquivo_origem")})
    out = out.withColumn("ano_correlacao", correlation_year(spec.period, "ano_nome_arquivo"))
    stem = F.regexp_replace(F.regexp_extract("arquivo_origem", r"([^/\\]+)$", 1), r"\.[^.]*$", "")
    text = F.lower(F.concat_ws(" ", "dominio_documento", "assunto_documento", "arquivo_origem"))
    out = out.withColumns(
        {
            spec.period: F.when(has_text(spec.period), F.col(spec.period)).otherwise(F.col("ano_correlacao")),
            "subtitulo_arquivo": stem,
            **section_codes(spec),
        }
    )
    return out.withColumns({"tem_codigo_setor": F.col("codigo_setor_eleitoral") != "", **family_flags(text, spec)})


def profile_sector(annotated: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Head count, share and rank of every profile value in every sector."""
    dims = {c: c.replace("perfil_", "") for c in spec.dims}
    rows = annotated.filter("eh_eleitorado")
    cells = rows.groupBy(*SECTOR_KEYS, *dims).agg(F.sum("eleitorado").alias("e"))
    values = unpivot(cells, SECTOR_KEYS, dims, "dimensao_perfil", "valor_perfil", ["e"]).filter(
        has_text("valor_perfil") & ~F.lower("valor_perfil").isin("sem valor", "sem_valor")
    )
    totals = values.groupBy(*SECTOR_KEYS, "dimensao_perfil", "valor_perfil").agg(F.sum("e").alias("eleitorado_perfil_setor"))
    scope = [*SECTOR_KEYS, "dimensao_perfil"]
    ranked = top_ranked(totals, scope, "eleitorado_perfil_setor", ["valor_perfil"], "rank_perfil_setor")
    return share_within(ranked, scope, "eleitorado_perfil_setor", "share_perfil_setor")


def electorate_sector(annotated: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Sector head count, turnout, rates, predominant profile and sources."""
    rows = annotated.filter("eh_eleitorado")
    # Every per-dimension total comes out of the same aggregate as the maxima.
    per_dim = {d: F.sum(F.when(has_text(d), F.col("eleitorado"))) for d in spec.dims}
    sector = rows.groupBy(*SECTOR_KEYS).agg(
        F.max("eleitorado").alias("__largest"),
        F.max("comparecimento_estimado").alias("comparecimento_setor"),
        F.max("abstencao_estimado").alias("abstencao_setor"),
        F.sum("brancos").alias("brancos_setor"),
        F.sum("nulos").alias("nulos_setor"),
        F.sum("linhas_origem").alias("linhas_origem_eleitorado"),
        text_list("arquivo_origem").alias("arquivos_eleitorado"),
        text_list("subtitulo_arquivo").alias("subtitulos_eleitorado"),
        *[c.alias(f"eleitorado_total_dim_{d.replace('perfil_', '')}") for d, c in per_dim.items()],
    )
    totals = [F.col(f"eleitorado_total_dim_{d.replace('perfil_', '')}") for d in spec.dims]
    sector = sector.withColumn("eleitorado_total_dimensao_max", F.greatest(*totals))
    sector = sector.withColumn(
        "eleitorado_setor", F.greatest("__largest", F.coalesce("eleitorado_total_dimensao_max", F.lit(0.0)))
    ).drop("__largest")
    sector = sector.withColumns(
        {
            "pct_comparecimento_setor": ratio("comparecimento_setor", "eleitorado_setor"),
            "pct_abstencao_setor": ratio("abstencao_setor", "eleitorado_setor"),
        }
    )
    best = profile_sector(annotated, spec).filter(F.col("rank_perfil_setor") == 1)
    items = [
        F.max(
            F.when(
                F.col("dimensao_perfil") == d.replace("perfil_", ""),
                F.concat(F.lit(field_label(d) + ": "), F.col("valor_perfil")),
            )
        )
        for d in spec.dims
    ]
    profile = best.groupBy(*SECTOR_KEYS).agg(F.concat_ws("; ", *items).alias("perfil_predominante_setor"))
    out = sector.join(profile, SECTOR_KEYS, "left")
    return out.withColumn("perfil_predominante_setor", F.coalesce("perfil_predominante_setor", F.lit("")))


def results_sector_entity(annotated: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Votes, share, rank and winner flag of every entity in every sector contest."""
    rows = annotated.filter("eh_resultado")
    entity = [c for c in (spec.party, spec.candidate, "ideologia", "coalizao") if c in rows.columns]
    metrics = ["votos", "brancos", "nulos", "validos_estimados", "comparecimento_estimado", "abstencao_estimado"]
    out = rows.groupBy(*CONTEST_KEYS, *entity).agg(*sums(metrics), F.sum("linhas_origem").alias("linhas_origem_resultado"))
    out = out.withColumn("entidade", entity_label(spec.candidate, spec.party))
    out = top_ranked(out, CONTEST_KEYS, "votos", ["entidade", *entity], "rank_entidade_setor")
    out = share_within(out, CONTEST_KEYS, "votos", "share_votos_setor")
    return out.withColumn("vencedor_setor", F.when(F.col("rank_entidade_setor") == 1, F.col("entidade")).otherwise(""))


def candidate_catalogue(annotated: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Distinct candidates per period with the sources that mention them."""
    rows = annotated.filter("eh_candidato")
    keys = ["ano_correlacao", spec.period, spec.state, *spec.contest, spec.party, spec.candidate]
    keys += [c for c in ("ideologia", "coalizao") if c in rows.columns]
    texts = {
        "arquivo_origem": "arquivos_candidato", "subtitulo_arquivo": "subtitulos_candidato",
        "dominio_documento": "dominios_candidato", "assunto_documento": "assuntos_candidato",
    }
    lists = [text_list(source).alias(name) for source, name in texts.items()]
    return rows.groupBy(*keys).agg(F.sum("linhas_origem").alias("linhas_origem_candidato"), *lists)


def keys_with_values(left: DataFrame, right: DataFrame, names: Sequence[str]) -> list[str]:
    """The join keys holding any value on both sides (runs two one-row aggregates)."""
    shared = [n for n in names if n in left.columns and n in right.columns]
    probe = [F.max(has_text(n)).alias(n) for n in shared]
    a, b = left.agg(*probe).first(), right.agg(*probe).first()
    return [n for n in shared if (a[n] and b[n]) or n == "ano_correlacao"]


def _one_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    first = F.min(F.struct(*order, *columns))
    return df.groupBy(*keys).agg(first.alias("__f")).select(*keys, *[F.col(f"__f.{c}").alias(c) for c in columns])


def correlated_base(
    results_entity: DataFrame, sectors: DataFrame, catalogue: DataFrame,
    sector_keys: Sequence[str] = tuple(SECTOR_JOIN), candidate_keys: Sequence[str] = tuple(CANDIDATE_JOIN),
) -> DataFrame:
    """Results with the sector's electorate and the catalogue's sources, metrics filled in."""
    attached = [
        "eleitorado_setor", "comparecimento_setor", "abstencao_setor", "pct_comparecimento_setor", "pct_abstencao_setor",
        "perfil_predominante_setor", "arquivos_eleitorado", "subtitulos_eleitorado",
    ]
    extra_order = [c for c in ("nm_municipio", "codigo_setor_eleitoral") if c not in sector_keys]
    out = results_entity.join(_one_per_key(sectors, sector_keys, attached, extra_order), list(sector_keys), "left")
    described = ["arquivos_candidato", "subtitulos_candidato", "dominios_candidato", "assuntos_candidato", "linhas_origem_candidato"]
    known = _one_per_key(catalogue, candidate_keys, described, [c for c in ("uf", "turno") if c not in candidate_keys])
    known = known.withColumn("__known", F.lit(True))
    out = out.join(known, list(candidate_keys), "left").withColumn(
        "candidato_presente_catalogo", F.coalesce("__known", F.lit(False))
    ).drop("__known")

    def filled(own: str, other: str) -> Column:
        mine = F.coalesce(F.col(own), F.lit(0.0)) if own in out.columns else F.lit(0.0)
        return F.when(mine > 0, mine).otherwise(F.coalesce(F.col(other), F.lit(0.0)))

    return out.withColumns(
        {
            "eleitorado": filled("eleitorado", "eleitorado_setor"),
            "comparecimento_estimado": filled("comparecimento_estimado", "comparecimento_setor"),
            "abstencao_estimado": filled("abstencao_estimado", "abstencao_setor"),
            "base_correlacao": F.lit("resultados + eleitorado_setor + candidatos_catalogo"),
        }
    )


def sector_summary(results_entity: DataFrame, sectors: DataFrame, sector_keys: Sequence[str] = tuple(SECTOR_JOIN)) -> DataFrame:
    """Contest sums with the winner and the sector's electorate."""
    metrics = ["votos", "brancos", "nulos", "validos_estimados", "comparecimento_estimado", "abstencao_estimado"]
    won = F.col("rank_entidade_setor") == 1
    names = {
        "entidade": "vencedor_setor", "partido": "partido_vencedor_setor", "candidato": "candidato_vencedor_setor",
        "votos": "votos_vencedor_setor", "share_votos_setor": "share_vencedor_setor",
    }
    out = results_entity.groupBy(*CONTEST_KEYS).agg(
        *sums(metrics), *[F.max(F.when(won, F.col(c))).alias(n) for c, n in names.items()]
    )
    attached = ["eleitorado_setor", "comparecimento_setor", "abstencao_setor", "pct_comparecimento_setor", "pct_abstencao_setor", "perfil_predominante_setor"]
    extra_order = [c for c in ("nm_municipio", "codigo_setor_eleitoral") if c not in sector_keys]
    return out.join(_one_per_key(sectors, sector_keys, attached, extra_order), list(sector_keys), "left")


def year_stats(annotated: DataFrame, results_entity: DataFrame, sectors: DataFrame, catalogue: DataFrame, correlated: DataFrame) -> DataFrame:
    """Rows, distinct codes and totals of every layer, per correlation year."""
    year = "ano_correlacao"

    def distinct(c: str) -> Column:
        return F.countDistinct(F.nullif(F.col(c), F.lit("")))

    rows = F.count(F.lit(1))
    parts = [
        annotated.groupBy(year).agg(
            rows.alias("linhas_gold_anotado"), distinct("arquivo_origem").alias("arquivos_origem"), distinct("uf").alias("ufs"),
            distinct("cd_municipio").alias("municipios"), distinct("codigo_setor_eleitoral").alias("setores_eleitorais"),
        ),
        correlated.groupBy(year).agg(rows.alias("linhas_base_correlacionada")),
        sectors.groupBy(year).agg(rows.alias("linhas_eleitorado_setor"), F.sum("eleitorado_setor").alias("eleitorado_total_setores")),
        results_entity.groupBy(year).agg(rows.alias("linhas_resultado_entidade"), F.sum("votos").alias("votos_total_resultados")),
        catalogue.groupBy(year).agg(
            rows.alias("linhas_catalogo_candidato"), distinct("candidato").alias("candidatos"), distinct("partido").alias("partidos")
        ),
    ]
    out = reduce(lambda a, b: a.join(b, year, "full_outer"), parts)
    counts = [c for c in out.columns if c != year]
    return out.fillna(0, counts).withColumnRenamed(year, "ano")


TEMPORAL_METRICS = (
    "votos", "eleitorado", "comparecimento_estimado", "abstencao_estimado", "pct_comparecimento", "pct_abstencao",
    "competitividade", "margem_lider",
)


def temporal_correlation(municipal: DataFrame, metrics: Sequence[str] = TEMPORAL_METRICS, min_rows: int = 5, spec: Spec = ELECTORAL) -> DataFrame:
    """Pearson and Spearman of municipal metrics between every pair of periods."""
    keys = [spec.state, spec.place, *spec.contest]
    long = municipal.select(*keys, "ano_num", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [*keys, "ano_num"], list(metrics), "metrica", "v"
    )
    means = long.filter(F.col("v").isNotNull()).groupBy(*keys, "metrica", "ano_num").agg(F.avg("v").alias("v"))
    pairs = period_pairs(means, [*keys, "metrica"], "ano_num", "v")
    out = pair_correlations(pairs, ["metrica", "p1", "p2"], min_rows)
    return out.withColumnsRenamed({"p1": "ano_1", "p2": "ano_2"}).withColumns(
        {"tipo": F.lit("mesma_metrica_entre_anos"), "abs_pearson": F.abs("pearson")}
    )


def entity_share_correlation(timeline_entities: DataFrame, min_rows: int = 3, spec: Spec = ELECTORAL) -> DataFrame:
    """Pearson and Spearman of entity shares between every pair of periods."""
    rows = timeline_entities.withColumn("ano_num", F.col(spec.period).try_cast("int"))
    pairs = period_pairs(rows, [*spec.contest, "entidade"], "ano_num", "share")
    out = pair_correlations(pairs, ["p1", "p2"], min_rows)
    renamed = {"p1": "ano_1", "p2": "ano_2", "n": "n_entidades", "pearson": "pearson_share", "spearman": "spearman_share"}
    return out.withColumnsRenamed(renamed).withColumn("abs_pearson_share", F.abs("pearson_share"))


def file_inventory(gold: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """Periods, places and offices found in every source."""
    return _inventory(gold, spec)


def _inventory(gold: DataFrame, spec: Spec, *more: Column) -> DataFrame:
    """The inventory and further aggregates of every source, from one pass over the rows.

    Periods, places and offices of a source are vocabularies, so they are collected as sets beside the counts.
    """
    source = "arquivo_origem"
    year = F.col(spec.period).try_cast("int")
    rows = gold.withColumn("__y", F.when(year.between(1900, 2100), year)).withColumn("__t", F.col("__y").cast("string"))

    def distinct(c: str) -> Column:
        return F.size(F.collect_set(F.nullif(F.col(c), F.lit("")))).cast("long")

    out = rows.groupBy(source).agg(
        F.min("__y").alias("__min"), F.max("__y").alias("__max"), F.size(F.collect_set("__y")).cast("long").alias("qtd_anos"),
        distinct(spec.state).alias("ufs"), distinct(spec.place).alias("municipios"), F.count(F.lit(1)).alias("linhas_gold"),
        text_list("__t", ", ").alias("anos_detectados_conteudo"), text_list(spec.contest[0], ", ").alias("cargos"), *more,
    )
    extra = out.columns[9:]  # after the source and the eight above
    named = path_years(source)
    return out.select(
        source,
        F.coalesce("anos_detectados_conteudo", F.lit("")).alias("anos_detectados_conteudo"),
        F.array_join(named, ", ").alias("anos_detectados_nome"),
        F.coalesce("__min", F.get(named, F.lit(0)).cast("int")).alias("ano_min"),
        F.coalesce("__max", F.try_element_at(named, F.lit(-1)).cast("int")).alias("ano_max"),
        "qtd_anos", "ufs", "municipios", F.coalesce("cargos", F.lit("")).alias("cargos"), "linhas_gold", *extra,
    )


def file_year_matrix(inventory: DataFrame, years: Sequence[str] | None = None) -> DataFrame:
    """A 0/1 column per year and source. Without `years`, the headings take one short job."""
    content = F.split("anos_detectados_conteudo", ", ")
    named = F.split("anos_detectados_nome", ", ")
    present = F.when(F.col("anos_detectados_conteudo") != "", content).otherwise(named)
    if years is None:
        both = inventory.select(F.explode(F.array_union(content, named)).alias("y")).filter("y <> ''")
        years = sorted(r[0] for r in both.distinct().collect())  # at most 200 calendar years
    return inventory.select(
        "arquivo_origem", *[F.array_contains(present, y).cast("int").alias(str(y)) for y in years]
    )


def traceability(gold: DataFrame, spec: Spec = ELECTORAL) -> DataFrame:
    """What every source contributed to the projection."""
    return (
        _inventory(gold, spec, F.sum("votos").alias("votos_soma"))
        .withColumnRenamed("anos_detectados_conteudo", "anos_usados")
        .drop("anos_detectados_nome", "qtd_anos")
        .withColumn("uso_na_simulacao", F.lit("alimenta base_modelagem, swing histórico, timeline e Monte Carlo"))
    )


def evidence_table(
    inventory: DataFrame, temporal: DataFrame, entities: DataFrame, model: DataFrame | None = None,
    similarity: DataFrame | None = None, backtest: DataFrame | None = None, field_map: DataFrame | None = None,
) -> DataFrame:
    """Coverage, strongest correlations, similarities and past error as one long table."""
    def line(df: DataFrame, kind: str, what: Column, value: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("tipo"), what.alias("evidencia"), value.cast("string").alias("valor"))

    def years(df: DataFrame, year: Column) -> DataFrame:
        listed = df.select(year.alias("y")).filter("y is not null").distinct().groupBy().agg(
            F.array_join(F.array_sort(F.collect_list("y")), ", ").alias("v")
        )
        return listed

    span = F.concat(F.col("ano_1").cast("string"), F.lit("→"), F.col("ano_2").cast("string"))
    found = inventory.select(F.explode(F.array_union(F.split("anos_detectados_conteudo", ", "), F.split("anos_detectados_nome", ", "))).alias("y")).filter("y <> ''")
    parts = [
        line(years(found, F.col("y")), "cobertura_temporal", F.lit("anos_detectados"), F.col("v")),
        line(
            temporal.orderBy(F.round("abs_pearson", 6).desc_nulls_last(), F.desc("n"), "metrica", "ano_1", "ano_2").limit(20),
            "correlacao_temporal", F.concat(F.col("metrica"), F.lit(" "), span), F.round("pearson", 6),
        ),
        line(
            entities.orderBy(F.round("abs_pearson_share", 6).desc_nulls_last(), F.desc("n_entidades"), "ano_1", "ano_2").limit(15),
            "correlacao_entidades", span, F.round("pearson_share", 6),
        ),
    ]
    if similarity is not None:
        top = similarity.orderBy(F.desc("score_similaridade"), "arquivo_1", "arquivo_2").limit(10)
        parts.append(line(top, "similaridade_tabelas", F.concat_ws(" ↔ ", "arquivo_1", "arquivo_2"), F.round("score_similaridade", 6)))
    if field_map is not None:
        counted = field_map.groupBy().agg(F.count(F.lit(1)).alias("n"))
        parts.append(line(counted, "mapa_canonico", F.lit("campos_aprendidos"), F.concat(F.col("n").cast("string"), F.lit(" grupos canônicos"))))
    if model is not None:
        parts.append(line(years(model, F.col("ano_num").cast("int").cast("string")), "base_modelagem", F.lit("anos_efetivamente_usados"), F.col("v")))
    if backtest is not None:
        parts.append(line(backtest.agg(F.avg("mae_share").alias("m")), "backtesting", F.lit("mae_share_medio"), F.round("m", 6)))
    return reduce(DataFrame.unionByName, parts)

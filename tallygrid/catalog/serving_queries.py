"""V: serving queries over the gold tables, and F4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analyses as an
from ..operators import hash_clusters, levels, sections
from ..plans import serving as sv
from .analysis_queries import association_sql
from .base import Data, frac, ok, query, r6
from .level_queries import entity_profile_sql, entity_profile_table, k3_sql, k_buckets, profile_sql, profile_table, results_sql, results_table
from .projection_queries import party_projection_sql, party_tables

_P = "nivel, ano, uf, cd_municipio, nm_municipio"


def summary(d: Data):
    return levels.summary_municipality(d.electorate, d.results)


@query("V3_places", "select distinct cd_municipio || '|' || nm_municipio as value, nm_municipio as label from l_summary where uf = 'ASIA'")
def v3(d):
    return sv.places(summary(d), "ASIA")


@query("V4_top_profiles", f"select {_P}, perfil_combinado, share_perfil, eleitorado, rank_perfil_ano from ({profile_sql('estado')}) where uf = 'ASIA' and ano = '1997' order by rank_perfil_ano limit 10")
def v4(d):
    return sv.top_profiles(profile_table(d, "estado"), "estado", 10, uf="ASIA", ano="1997")


@query("V5q_profile_distribution_long", f"select ano, dimensao_perfil, valor_perfil, eleitorado as peso, {r6('s')} as share from l_period where ano = '1998' order by round(eleitorado, 6) desc, ano, dimensao_perfil, valor_perfil limit 24")
def v5long(d):
    return sv.profile_distribution(levels.profile_by_period(d.electorate), ano="1998").select("ano", "dimensao_perfil", "valor_perfil", "peso", "share")


@query("V5q_profile_distribution_wide", f"""
  select ano, dimensao_perfil, valor_perfil, peso, {r6('peso / sum(peso) over (partition by ano, dimensao_perfil)')} as share from (
    {' union all '.join(f"select ano, '{n}' as dimensao_perfil, {c} as valor_perfil, sum(eleitorado) as peso from w where {ok(c)} group by ano, {c}" for c, n in {'perfil_faixa_etaria': 'faixa_etaria', 'perfil_genero': 'sexo_genero', 'perfil_instrucao': 'escolaridade', 'perfil_estado_civil': 'estado_civil', 'perfil_raca_cor': 'raca_cor'}.items())})""".replace("from w", f"from ({profile_sql('brasil')})"))
def v5wide(d):
    return sv.profile_distribution(profile_table(d, "brasil"), n=None)


@query("V6_party_projection_view", f"""select cenario, {_P.replace('ano, ', '')}, cargo, turno, partido, share_pred_2026, votos_pred_2026 from ({party_projection_sql('estado')}) where cenario = 'base'
  order by share_pred_2026 desc, cargo, cd_municipio, cenario, nivel, nm_municipio, partido, share_pred_2026, turno, uf limit 20""")
def v6(d):
    return sv.party_projection_view(party_tables(d, "estado"))


@query("V7_state_map", f"""
  select uf, partido, share_pred_2026, votos_pred_2026, 'simulacao_2026' as fonte from (
    select *, row_number() over (partition by uf order by share_pred_2026 desc, partido) as rn from (
      select uf, partido, max(share_pred_2026) as share_pred_2026, {r6('sum(v)')} as votos_pred_2026 from (
        select uf, entidade as partido, cargo, turno, sum(votos_pred) as v, {r6('sum(votos_pred) / sum(sum(votos_pred)) over (partition by uf, cargo, turno)')} as share_pred_2026
        from scen where cenario = 'base' group by uf, entidade, cargo, turno) group by uf, partido)) where rn = 1""")
def v7(d):
    return sv.state_map(party_tables(d, "estado"))


@query("V7_state_map_history", f"""
  select uf, partido, v as votos_pred_2026, {r6('s')} as share_pred_2026, 'historico_processado' as fonte from (
    select *, row_number() over (partition by uf order by round(s, 6) desc, partido) as rn from (
      select uf, partido, v, v / sum(v) over (partition by uf) as s from (select uf, entidade as partido, sum(votos) as v from ({results_sql('estado')}) group by all))) where rn = 1""")
def v7h(d):
    return sv.state_map(None, results_table(d, "estado"))


@query("V8_historical_party", f"""
  select partido, resultado_eleitoral, v as votos_pred_2026, {r6('v / sum(v) over ()')} as share_pred_2026 from (
    select entidade as partido, 'vencedor_ranking' as resultado_eleitoral, sum(votos) as v from ({results_sql('brasil')}) where rank_entidade = 1 group by entidade
    union all select entidade, 'nao_vencedor_ranking', sum(votos) from ({results_sql('brasil')}) where rank_entidade <> 1 group by entidade)""")
def v8(d):
    return sv.historical_party(results_table(d, "brasil").drop("resultado_eleitoral"), n=None)


_QUICK = f"{_P}, cargo, turno, 'vencedor_ranking' as resultado_eleitoral, share_votos, votos, rank_entidade"


@query("V9_quick_party", f"select entidade as partido, {_QUICK} from ({results_sql('estado')}) where uf = 'EUROPE' and rank_entidade = 1 order by share_votos desc, ano, cargo, partido, turno limit 20")
def v9(d):
    return sv.quick_party(results_table(d, "estado").drop("resultado_eleitoral"), "estado", 20, uf="EUROPE")


@query("V10_entity_results", f"select entidade, tipo_entidade, {_QUICK} from ({results_sql('brasil', 'l_names')}) where rank_entidade = 1 order by share_votos desc, ano, cargo, entidade, turno limit 20")
def v10(d):
    return sv.entity_results(results_table(d, "brasil", "candidato").drop("resultado_eleitoral"))


@query("V11_entity_profiles", f"""select {_P}, cargo, turno, entidade, perfil_combinado, {r6('votos')} as votos, {r6('sh')} as share_perfil_na_entidade, rank_perfil_entidade_ano, tipo_entidade
  from (select *, share_perfil_na_entidade as sh from ({entity_profile_sql('brasil', r6=str)})) order by round(sh, 6) desc, ano, cargo, cd_municipio, entidade, nivel, nm_municipio, perfil_combinado limit 20""")
def v11(d):
    return sv.entity_profiles(entity_profile_table(d, "brasil"))


@query("V12_cluster_personas_view", f"""select {_P}, cluster_id, cluster_tipo, perfil_combinado, partido, eleitorado, votos_proxy, share_cluster, rank_persona_cluster from ({k3_sql('eleitores', 'brasil')})
  order by share_cluster desc, ano, cd_municipio, cluster_id, cluster_tipo, eleitorado, nivel, nm_municipio, partido, perfil_combinado limit 20""")
def v12(d):
    return sv.cluster_personas_view(hash_clusters.cluster_rollup(k_buckets(d, "eleitores"), "brasil"))


@query("V13_metrics_by_year", f"select ano, sum(votos) as votos, sum(eleitorado) as eleitorado, sum(comparecimento_estimado) as comparecimento_estimado, sum(abstencao_estimado) as abstencao_estimado, {r6('sum(comparecimento_estimado / eleitorado)')} as comparecimento_medio, {r6('sum(abstencao_estimado / eleitorado)')} as abstencao_media from l_summary where uf = 'ASIA' group by ano")
def v13(d):
    return sv.metrics_by_year(summary(d), uf="ASIA")


@query("V14_table_preview", """select * from l_summary order by ano, uf, cd_municipio, nm_municipio, qtd_secoes, eleitorado, comparecimento_estimado,
  abstencao_estimado, cargo, turno limit 100""")
def v14(d):
    return sv.table_preview(summary(d), 100)


@query("V15_latest_period", "select * from l_summary where ano = (select max(ano) from l_summary)")
def v15(d):
    return sv.latest_period(summary(d))


@query("V16_people_estimate", f"select ano, perfil_combinado, perfil_raca_cor, {r6('eleitorado / t * (select max(eleitorado) from l_summary)')} as pessoas_perfil_estimado from (select *, sum(eleitorado) over (partition by ano) as t from ({profile_sql('brasil')}))")
def v16(d):
    return sv.people_estimate(profile_table(d, "brasil"), summary(d)).select("ano", "perfil_combinado", "perfil_raca_cor", "pessoas_perfil_estimado")


@query("V17_place_party_matrix_totals", """
  with r as (select nm_municipio, partido, sum(votos) as v from results group by all),
  p as (select partido from r group by 1 order by sum(v) desc, partido limit 12), m as (select nm_municipio from r group by 1 order by sum(v) desc, nm_municipio limit 24)
  select nm_municipio, cast(sum(v) as bigint) as total from r where partido in (select partido from p) and nm_municipio in (select nm_municipio from m) group by 1""")
def v17(d):
    wide = sv.place_party_matrix(d.results)
    parties = [c for c in wide.columns if c != "nm_municipio"]
    return wide.select("nm_municipio", sum((F.col(f"`{c}`") for c in parties), F.lit(0)).alias("total"))


@query("V17_place_party_matrix", """
  with r as (select nm_municipio, partido, sum(votos) as v from results group by all),
  p as (select partido from r group by 1 order by sum(v) desc, partido limit 12), m as (select nm_municipio from r group by 1 order by sum(v) desc, nm_municipio limit 24),
  f as (select nm_municipio, partido, cast(v as bigint) as v from r where partido in (select partido from p) and nm_municipio in (select nm_municipio from m))
  select nm_municipio, coalesce(columns(* exclude (nm_municipio)), 0) from (pivot f on partido using sum(v) group by nm_municipio)""")
def v17full(d):
    return sv.place_party_matrix(d.results)


@query("V18_place_summary", f"""
  select uf, cd_municipio, max(nm_municipio) as nm_municipio, sum(votos) as votos, {r6('avg(pct_abstencao)')} as abstencao_media, {r6('avg(pct_comparecimento)')} as comparecimento_medio,
    string_agg(distinct ano, ', ' order by ano) as anos, any_value(l.lider) as lider
  from municipal join (select * from (select uf, cd_municipio, lider, row_number() over (partition by uf, cd_municipio order by count(*) desc, lider) as rn from municipal group by uf, cd_municipio, lider) where rn = 1) l using (uf, cd_municipio) group by uf, cd_municipio""")
def v18(d):
    return sv.place_summary(levels.consolidate_municipal(d.base))


@query("V19_winners_losers_split", f"select case when rank_entidade = 1 then 'ganhou' else 'perdeu' end as grupo, count(*) as linhas, sum(votos) as votos from ({results_sql('estado')}) group by 1")
def v19(d):
    won, lost = sv.winners_losers_split(results_table(d, "estado").drop("resultado_eleitoral"))
    both = won.withColumn("grupo", F.lit("ganhou")).unionByName(lost.withColumn("grupo", F.lit("perdeu")))
    return both.groupBy("grupo").agg(F.count(F.lit(1)).alias("linhas"), F.sum("votos").alias("votos"))


@query("V21_entity_profile_cards", f"""select ano, cargo, turno, entidade, valor_perfil as perfil, {r6('sp')} as share, {r6('lift')} as lift from ({association_sql('partido', 'all')}) where {ok('valor_perfil')}
  order by round(lift, 6) desc, round(sp, 6) desc, ano, cargo, entidade, round(lift, 9), valor_perfil limit 10""")
def v21(d):
    return sv.entity_profile_cards(an.profile_vote_association(d.results, d.electorate))


@query("V22_kpis", "select sum(votos) as votos, sum(eleitorado) as eleitorado, count(distinct uf) as qtd_uf, count(distinct cd_municipio) as qtd_cd_municipio, count(distinct ano) as qtd_ano from l_summary")
def v22(d):
    return sv.kpis(summary(d), ["votos", "eleitorado"], ["uf", "cd_municipio", "ano"])


@query("V23_state_metrics", "select uf, sum(eleitorado) as eleitorado, sum(comparecimento_estimado) as comparecimento_estimado, sum(abstencao_estimado) as abstencao_estimado from e_section group by uf")
def v23(d):
    return sv.state_metrics(levels.timeline(d.electorate, ["uf"], "timeline_uf"))


@query("V24_place_snapshot", f"""select uf, cd_municipio, nm_municipio, ano, sum(eleitorado) as eleitorado, sum(votos) as votos, sum(comparecimento_estimado) as comparecimento_estimado, sum(abstencao_estimado) as abstencao_estimado,
  {r6('sum(comparecimento_estimado / eleitorado)')} as comparecimento_medio, {r6('sum(abstencao_estimado / eleitorado)')} as abstencao_media from l_summary where uf = 'AFRICA' group by all order by sum(eleitorado) desc limit 50""")
def v24(d):
    return sv.place_snapshot(summary(d), "AFRICA")


@query("V25_place_party_snapshot", """select cd_municipio, nm_municipio, partido, cast(sum(v) as double) as votos from (
    select cd_municipio, nm_municipio, arg_max(partido, rk) as partido, max(v) as v from (select *, row_number() over (partition by ano, uf, cd_municipio, zona, secao, cargo, turno order by v, partido desc, candidato desc, nr_votavel desc) as rk from (
      select ano, uf, cd_municipio, nm_municipio, zona, secao, cargo, turno, partido, candidato, nr_votavel, sum(votos) as v from results where uf = 'ASIA' and votos > 0 group by all)) group by ano, uf, cd_municipio, nm_municipio, zona, secao, cargo, turno)
  group by all order by votos desc, cd_municipio, nm_municipio, partido limit 150""")
def v25(d):
    return sv.place_party_snapshot(sections.section_winners(d.results), "ASIA")


@query("V26_party_votes_by_state", f"select uf, partido, v as votos, {frac('v', 't')} as share from (select *, sum(v) over (partition by uf) as t from (select uf, partido, cast(sum(votos) as bigint) as v from results group by all))")
def v26(d):
    return sv.party_votes_by_state(d.results)["estado"]


@query("V26_party_votes_nation", f"select partido, v as votos, {frac('v', 't')} as share from (select *, sum(v) over () as t from (select partido, cast(sum(votos) as bigint) as v from results group by all))")
def v26n(d):
    return sv.party_votes_by_state(d.results)["brasil"]


_LISTS = {
    "votos_por_uf": "select uf, sum(votos) as votos from municipal group by uf",
    "abstencao_por_uf": f"select uf, {r6('avg(pct_abstencao)')} as pct_abstencao from municipal group by uf having avg(pct_abstencao) is not null",
    "comparecimento_por_uf": f"select uf, {r6('avg(pct_comparecimento)')} as pct_comparecimento from municipal group by uf having avg(pct_comparecimento) is not null",
    "municipios_maior_abstencao": f"select uf, nm_municipio, {r6('avg(pct_abstencao)')} as pct_abstencao from municipal group by all order by round(avg(pct_abstencao), 6) desc nulls last, nm_municipio limit 25",
    "entidades_ano_recente": "select entidade, sum(votos) as votos from tl_entities where ano = (select max(ano) from tl_entities) group by all order by votos desc, entidade limit 25",
}
for _name, _sql in _LISTS.items():

    def _register_list(name=_name, sql=_sql):
        @query(f"V27_{name}", sql)
        def run(d):
            return sv.top_lists(levels.consolidate_municipal(d.base), levels.timelines_full(d.base)["timeline_entidades"])[name]

    _register_list()


@query("F4_gold_filters", f"select * from ({results_sql('municipio')}) where uf = 'ASIA' and ano = '1997' and cd_municipio = '12'", drop=("interpretacao_resultado",))
def f4(d):
    return sv.gold_filters(results_table(d, "municipio"), uf="ASIA", municipio="12|NATION_12", ano="1997")

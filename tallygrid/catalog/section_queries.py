"""Q: section-level queries."""

from __future__ import annotations

from ..operators import sections as op
from .base import ANY_DIM, COMBO, CONTEST, DIM_LIST, SECTION, DIMS, frac, ok, query, r6

_WINNERS = f"""
  select {CONTEST}, nm_municipio, partido as partido_vencedor, candidato as candidato_vencedor, nr_votavel,
         votos as votos_vencedor, votos_total_secao, {frac('votos', 'votos_total_secao')} as share_vencedor
  from (select *, sum(votos) over (partition by {CONTEST}) as votos_total_secao,
               row_number() over (partition by {CONTEST} order by votos desc, partido, candidato, nr_votavel) as rn
        from (select {CONTEST}, nm_municipio, partido, candidato, nr_votavel, cast(sum(votos) as double) as votos
              from results where votos > 0 group by all)) where rn = 1"""


@query("Q1_section_winners", _WINNERS)
def q1(d):
    return op.section_winners(d.results)


_RANKED = f"""
  with s as (select {CONTEST}, nm_municipio, partido as entidade, sum(votos) as votos, max(eleitorado) as eleitorado,
                    max(comparecimento_estimado) as comparecimento_estimado,
                    max(abstencao_estimado) as abstencao_estimado, sum(brancos) as brancos, sum(nulos) as nulos
             from base group by all),
  k as (select *, votos / nullif(sum(votos) over (partition by {CONTEST}), 0) as share,
               row_number() over (partition by {CONTEST} order by votos desc, entidade) as rk from s)"""


@query("Q2_section_entity_results", _RANKED + f"""
  select {CONTEST}, nm_municipio, entidade, votos, eleitorado, comparecimento_estimado, abstencao_estimado,
         brancos, nulos, rk as rank, {r6('share')} as share, {frac('abstencao_estimado', 'eleitorado')} as taxa_abstencao
  from k""")
def q2a(d):
    return op.section_entity_results(d.base)


_WON = _RANKED + f""", w as (
  select a.* exclude (rk, entidade, votos, share), a.entidade as vencedor_secao, a.votos as votos_vencedor,
         a.share as share_vencedor, b.entidade as segundo_colocado, coalesce(b.votos, 0) as votos_segundo,
         coalesce(b.share, 0) as share_segundo, abstencao_e as taxa_abstencao
  from (select *, abstencao_estimado / nullif(eleitorado, 0) as abstencao_e from k where rk = 1) a
  left join (select * from k where rk = 2) b using ({CONTEST}))
  select * exclude (abstencao_e, share_vencedor, share_segundo, taxa_abstencao), {r6('share_vencedor')} as share_vencedor,
         {r6('share_segundo')} as share_segundo, {r6('taxa_abstencao')} as taxa_abstencao,
         votos_vencedor - votos_segundo as margem_votos, {r6('share_vencedor - share_segundo')} as margem_share,
         case when (share_vencedor >= .5) then 'venceu com maioria absoluta dos votos da seção'
              when share_vencedor >= .35 then 'venceu com pluralidade competitiva'
              else 'venceu em disputa fragmentada' end
         || case when share_vencedor - share_segundo < .03 then '; margem muito apertada'
                 when share_vencedor - share_segundo < .10 then '; margem moderada' else '; margem confortável' end
         || case when taxa_abstencao >= .30 then '; abstenção alta no recorte'
                 when taxa_abstencao <= .12 then '; comparecimento alto no recorte' else '' end as como_ganhou
  from w"""


@query("Q2_section_results_ranked", _WON)
def q2(d):
    return op.section_results_ranked(d.base)


@query("Q3_section_winner_profile", f"""
  select w.*, e.eleitorado as eleitorado_secao, p.perfil_combinado as perfil_predominante_secao
  from ({_WINNERS}) w left join e_section e using ({SECTION}) left join e_lead p using ({SECTION})""")
def q3(d):
    return op.section_winner_profile(d.results, d.electorate)


_TWO = "printf('%.2f', round(100 * {}, 2))"
_LEADERS = f"""
  with u as ({' union all '.join(f"select {SECTION}, '{x.replace('perfil_', '')}' as dim, {x} as valor, cast(sum(eleitorado) as bigint) as e from electorate where eleitorado > 0 and trim({x}) <> '' group by all" for x in DIMS)}),
  t as (select *, row_number() over (partition by {SECTION}, dim order by e desc, valor) as rn from u)
  select {SECTION}, concat_ws('; ', {', '.join(f"max(case when dim = '{x.replace('perfil_', '')}' then dim || ': ' || valor || ' (' || e || ' eleitores)' end)" for x in DIMS)}) as perfil_predominante_secao
  from t where rn = 1 group by {SECTION}"""


@query("Q4_section_winner_explained", _RANKED + f""", b as (select {CONTEST}, share from k where rk = 2),
  x as (select a.{CONTEST.replace(', ', ', a.')}, a.share as s1, a.share - coalesce(b.share, 0) as m1, a.abstencao_estimado / nullif(a.eleitorado, 0) as t1 from (select * from k where rk = 1) a left join b using ({CONTEST})),
  q as ({_WON}), p as ({_LEADERS})
  select q.*, p.perfil_predominante_secao, concat_ws('; ', 'teve ' || {_TWO.format('s1')} || '% dos votos validos/registrados no recorte', 'abriu margem de ' || {_TWO.format('m1')} || ' pontos percentuais sobre o segundo',
    'a abstencao observada foi ' || {_TWO.format('t1')} || '%', 'o perfil predominante da secao foi ' || nullif(p.perfil_predominante_secao, '')) as por_que_ganhou_proxy
  from q join x using ({CONTEST}) left join p using ({SECTION})""")
def q4(d):
    return op.section_winner_explained(d.base, d.electorate)


@query("Q4_section_dimension_leaders", f"""
  with w as (select distinct {SECTION} from base),
  u as ({' union all '.join(f"select {SECTION}, '{x.replace('perfil_', '')}' as dim, {x} as valor, cast(sum(eleitorado) as bigint) as e from electorate where eleitorado > 0 and trim({x}) <> '' group by all" for x in DIMS)}),
  t as (select *, row_number() over (partition by {SECTION}, dim order by e desc, valor) as rn from u)
  select {SECTION}, concat_ws('; ', {', '.join(f"max(case when dim = '{x.replace('perfil_', '')}' then dim || ': ' || valor || ' (' || e || ' eleitores)' end)" for x in DIMS)}) as perfil_predominante_secao
  from t join w using ({SECTION}) where rn = 1 group by {SECTION}""")
def q4b(d):
    out = op.section_winner_explained(d.base, d.electorate)
    return out.select("ano", "uf", "cd_municipio", "zona", "secao", "perfil_predominante_secao").filter(
        "perfil_predominante_secao is not null").distinct()


@query("Q5_section_abstention", f"""
  select *, {frac('abstencao_estimado', 'eleitorado')} as taxa_abstencao,
         {frac('comparecimento_estimado', 'eleitorado')} as taxa_comparecimento,
         {frac('brancos + nulos', 'votos')} as taxa_brancos_nulos
  from (select r.*, e.eleitorado, e.comparecimento_estimado, e.abstencao_estimado
        from (select {CONTEST}, max(nm_municipio) as nm_municipio, cast(sum(brancos) as double) as brancos, cast(sum(nulos) as double) as nulos,
                     cast(sum(votos) as double) as votos from results where votos > 0 group by {CONTEST}) r
        left join e_section e using ({SECTION}))""")
def q5(d):
    return op.section_abstention(d.base)


@query("Q6_section_profile_cache", f"""
  select c.*, e.nm_municipio, e.eleitorado, e.comparecimento_estimado, e.abstencao_estimado,
         row_number() over (partition by {SECTION} order by eleitorado_perfil desc, perfil_combinado, {DIM_LIST}) as rn_perfil_secao
  from e_cells c left join e_section e using ({SECTION}) where {ok('perfil_combinado')}""")
def q6(d):
    return op.section_profile_cache(d.electorate)


@query("Q7_section_results_cache", f"""
  select {CONTEST}, partido, candidato, nr_votavel, max(nm_municipio) as nm_municipio,
         cast(sum(votos) as double) as votos, cast(sum(brancos) as double) as brancos,
         cast(sum(nulos) as double) as nulos, cast(sum(validos_estimados) as double) as validos_estimados
  from results where votos > 0 group by {CONTEST}, partido, candidato, nr_votavel""")
def q7(d):
    return op.section_results_cache(d.results)


def _d(c):
    return f"coalesce(nullif(trim({c}), ''), 'SEM_VALOR')"


@query("Q8_section_candidates", f"""
  select {CONTEST}, max(nm_municipio) as nm_municipio, {', '.join(f'{_d(c)} as {c}' for c in ['partido', 'candidato', 'nr_candidato', 'sq_candidato', 'situacao_candidatura', 'resultado_candidatura'])},
         {', '.join(f"{_d(c)} as {c.replace('perfil_', 'candidato_')}" for c in DIMS)}, count(*) as qtd_registros_candidato
  from candidates where {ok('candidato')} or {ok('nr_candidato')} or {ok('partido')}
  group by {CONTEST}, partido, candidato, nr_candidato, sq_candidato, situacao_candidatura, resultado_candidatura, {DIM_LIST}""")
def q8(d):
    return op.section_candidates(d.candidates)


@query("Q9_section_base", "select * from base")
def q9(d):
    return d.base


@query("Q10_section_profile_rows", f"""
  select 'secao' as nivel, {SECTION}, {DIM_LIST}, {COMBO} as perfil_combinado, max(nm_municipio) as nm_municipio,
         cast(sum(eleitorado) as double) as eleitorado_perfil, cast(max(eleitorado) as double) as eleitorado_secao,
         cast(max(comparecimento_estimado) as double) as comparecimento_estimado,
         cast(max(abstencao_estimado) as double) as abstencao_estimado
  from electorate where {ANY_DIM} and eleitorado > 0 group by {SECTION}, {DIM_LIST}""")
def q10(d):
    return op.section_profile_rows(d.electorate)

"""Registry of named queries over the star-schema tables.

A query is a function of a `Data` handle.  Results are tidied the same way for all:
fractions rounded to six places, counts as bigint.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import sections
from ..sources import star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Data:
    """Inputs of one query run, built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return star.table(self.spark, self.folder, name)

    @cached_property
    def results(self) -> DataFrame:
        return star.results(self.spark, self.folder)

    @cached_property
    def electorate(self) -> DataFrame:
        return star.electorate(self.spark, self.folder)

    @cached_property
    def candidates(self) -> DataFrame:
        return star.candidates(self.spark, self.folder)

    @cached_property
    def base(self) -> DataFrame:
        return sections.section_base(self.results, self.electorate)


def tidy(df: DataFrame) -> DataFrame:
    """Six decimals for doubles (twelve first, which absorbs summation noise), long counts."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("decimal(38,12)"), 6).cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, drop: tuple[str, ...] = ()):
    """Register a query, its check SQL and the text columns the check leaves out."""

    def register(build: Callable[[Data], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return tidy(build(Data(spark, folder)).drop(*drop))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return build

    return register


# ---- check SQL -----------------------------------------------------------------------

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body


def with_ctes(sql: str) -> str:
    """Prefix the named sub-selects a statement mentions, in definition order."""
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                visit(body)

    visit(sql)
    parts = [f"{name} as ({body})" for name, body in CTES.items() if name in wanted]
    if not parts:
        return sql
    sql = sql.strip()
    if sql.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + sql[5:]
    return "with " + ",\n".join(parts) + "\n" + sql


def r6(x: str) -> str:
    return f"cast(round(cast({x} as decimal(38,12)), 6) as double)"


def frac(a: str, b: str) -> str:
    return r6(f"cast({a} as double) / nullif({b}, 0)")


def ok(c: str) -> str:
    """Validity predicate in SQL."""
    words = "'', 'nan', 'none', 'null', '<na>', '#nulo#', 'sem valor', 'sem_valor', 'nao informado', 'nao informado.', 'geral'"
    low = f"lower(trim(coalesce(cast({c} as varchar), '')))"
    return f"({low} not in ({words}) and {low} not like '%sem valor%')"


DIMS = ["perfil_faixa_etaria", "perfil_genero", "perfil_instrucao", "perfil_estado_civil", "perfil_raca_cor"]
DIM_LABELS = ["faixa_etaria", "sexo_genero", "escolaridade", "estado_civil", "raca_cor"]
DIM_LIST = ", ".join(DIMS)
ANY_DIM = "(" + " or ".join(ok(d) for d in DIMS) + ")"
COMBO = "concat_ws('; ', " + ", ".join(
    f"case when {ok(d)} then '{label}=' || {d} end" for d, label in zip(DIMS, DIM_LABELS)
) + ")"
SECTION = "ano, uf, cd_municipio, zona, secao"
CONTEST = SECTION + ", cargo, turno"


def long_sum(x: str) -> str:
    return f"cast(sum({x}) as bigint)"


_PLACED = (
    "from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey "
    "join region on n_regionkey = r_regionkey"
)
_PLACE = (
    "cast(year(o_orderdate) as varchar) as ano, r_name as uf, cast(n_nationkey as varchar) as cd_municipio, "
    "n_name as nm_municipio, cast(c_custkey % 3 as varchar) as zona, cast(c_custkey % 12 as varchar) as secao"
)
cte("results", f"""
  select {_PLACE}, p_type as cargo, case when l_linenumber <= 4 then '1' else '2' end as turno,
         p_brand as partido, p_name as candidato, cast(p_partkey as varchar) as nr_votavel,
         cast(l_quantity as bigint) as votos, cast(round(l_discount * 100) as bigint) as brancos,
         cast(round(l_tax * 100) as bigint) as nulos, cast(l_quantity as bigint) as validos_estimados
  {_PLACED} join lineitem on l_orderkey = o_orderkey join part on l_partkey = p_partkey""")
cte("electorate", f"""
  select {_PLACE},
         case when c_acctbal < 0 then 'negativo' when c_acctbal < 3000 then 'ate 3000'
              when c_acctbal < 7000 then '3000 a 7000' else '7000 ou mais' end as perfil_faixa_etaria,
         o_orderstatus as perfil_genero, o_orderpriority as perfil_instrucao, c_mktsegment as perfil_estado_civil,
         case o_orderkey % 7 when 0 then '#NULO#' when 1 then 'Sem valor'
              else 'G' || cast(o_orderkey % 5 as varchar) end as perfil_raca_cor,
         1 + o_orderkey % 9 as eleitorado,
         1 + o_orderkey % 9 - case when o_orderkey % 9 >= 2 then o_orderkey % 3 else 0 end as comparecimento_estimado,
         case when o_orderkey % 9 >= 2 then o_orderkey % 3 else 0 end as abstencao_estimado
  {_PLACED}""")
cte("candidates", f"""
  select {_PLACE}, p_type as cargo, case when l_linenumber <= 4 then '1' else '2' end as turno,
         p_brand as partido, p_name as candidato, cast(p_partkey as varchar) as nr_candidato,
         cast(l_suppkey as varchar) as sq_candidato,
         case when p_size < 20 then 'jovem' else 'senior' end as perfil_faixa_etaria,
         case when p_partkey % 2 = 0 then 'F' else 'M' end as perfil_genero,
         case when p_size % 5 = 0 then 'Sem valor' else 'E' || cast(p_size % 5 as varchar) end as perfil_instrucao,
         '' as perfil_estado_civil,
         case when p_partkey % 11 = 0 then '#NULO#' else 'R1' end as perfil_raca_cor,
         l_returnflag as situacao_candidatura,
         case when l_linestatus = 'O' then 'ELEITO' else 'NAO ELEITO' end as resultado_candidatura
  {_PLACED} join lineitem on l_orderkey = o_orderkey join part on l_partkey = p_partkey""")


def _section_total(m: str) -> str:
    per_dim = ", ".join(f"sum(case when {ok(d)} then {m} end)" for d in DIMS)
    return f"cast(greatest(max({m}), {per_dim}) as double) as {m}"


cte("e_section", f"""
  select {SECTION}, max(nm_municipio) as nm_municipio, {_section_total('eleitorado')},
         {_section_total('comparecimento_estimado')}, {_section_total('abstencao_estimado')}
  from electorate group by {SECTION}""")
cte("e_cells", f"""
  select {SECTION}, {DIM_LIST}, {COMBO} as perfil_combinado, cast(sum(eleitorado) as double) as eleitorado_perfil
  from electorate where {ANY_DIM} and eleitorado > 0 group by {SECTION}, {DIM_LIST}""")
cte("e_lead", f"""
  select * exclude (rn) from (
    select *, row_number() over (partition by {SECTION}
      order by eleitorado_perfil desc, perfil_combinado, {DIM_LIST}) as rn
    from e_cells where {ok('perfil_combinado')}) where rn = 1""")
cte("base", f"""
  select r.*, e.eleitorado, e.comparecimento_estimado, e.abstencao_estimado, {', '.join('p.' + d for d in DIMS)},
         r.partido as entidade
  from (select {CONTEST}, max(nm_municipio) as nm_municipio, partido, candidato, cast(sum(votos) as double) as votos,
               cast(sum(brancos) as double) as brancos, cast(sum(nulos) as double) as nulos,
               cast(sum(validos_estimados) as double) as validos_estimados
        from results where votos > 0 group by {CONTEST}, partido, candidato) r
  left join e_section e using ({SECTION}) left join e_lead p using ({SECTION})""")

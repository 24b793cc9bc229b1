"""I: ingest, silver, sinks and samples, on documents derived from the tables by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import profiling
from ..session import materialize, scratch_path
from ..sources import delimited, files, roles, silver, tables
from .base import Data, ok, query
from .correlated_queries import _PEOPLE_PATH, _RESULT_PATH
from .scalar_queries import counted

_UF = "upper(substr(uf, 1, 2))"


def raw_votes(d: Data) -> DataFrame:
    return d.results.selectExpr(
        "ano as ANO_ELEICAO", "turno as NR_TURNO", f"{_UF} as SG_UF", "cd_municipio as CD_MUNICIPIO", "nm_municipio as NM_MUNICIPIO", "zona as NR_ZONA",
        "secao as NR_SECAO", "cargo as DS_CARGO", "nr_votavel as NR_VOTAVEL", "candidato as NM_VOTAVEL", "partido as SG_PARTIDO", "concat(votos, ',0') as QT_VOTOS")


def raw_people(d: Data) -> DataFrame:
    return d.electorate.selectExpr(
        "ano as ANO_ELEICAO", f"{_UF} as SG_UF", "cd_municipio as CD_MUNICIPIO", "nm_municipio as NM_MUNICIPIO", "zona as NR_ZONA", "secao as NR_SECAO",
        "if(eleitorado % 2 = 0, '2', '4') as CD_GENERO", "perfil_instrucao as DS_GRAU_ESCOLARIDADE", "perfil_raca_cor as DS_RACA_COR",
        "cast(eleitorado as string) as QT_ELEITORES_PERFIL")


def raw_candidates(d: Data) -> DataFrame:
    return d.candidates.selectExpr(
        "ano as ANO_ELEICAO", f"{_UF} as SG_UF", "cargo as DS_CARGO", "partido as SG_PARTIDO", "nr_candidato as NR_CANDIDATO", "sq_candidato as SQ_CANDIDATO",
        "if(nr_candidato % 2 = 0, candidato, nr_candidato) as NM_URNA_CANDIDATO", "candidato as NM_CANDIDATO", "cast(20 + nr_candidato % 60 as string) as NR_IDADE_DATA_POSSE",
        "situacao_candidatura as DS_SITUACAO_CANDIDATURA", "resultado_candidatura as DS_SIT_TOT_TURNO")


def written_lines(d: Data) -> str:
    """Votes as JSON lines, plus one broken and one non-object line per customer."""
    path = scratch_path(d.spark, "votacao_secao_json")
    good = raw_votes(d).select(F.to_json(F.struct("*")).alias("value"))
    broken = d.table("customer").select(F.explode(F.array(F.lit('{"ANO_ELEICAO": "19'), F.lit("[1, 2]"))).alias("value"))
    good.unionByName(broken).write.text(path)
    return path


@query("I1_read_json_records", f"select ano as \"ANO_ELEICAO\", {_UF} as \"SG_UF\", partido as \"SG_PARTIDO\", count(*) as n, cast(sum(votos) as double) as votos from results group by all")
def i1(d):
    out = files.read_json_records(d.spark, written_lines(d))
    votes = F.regexp_replace("QT_VOTOS", ",", ".").cast("double")
    return out.groupBy("ANO_ELEICAO", "SG_UF", "SG_PARTIDO").agg(F.count(F.lit(1)).alias("n"), F.sum(votes).alias("votos"))


@query("I1_read_json_lists", "select o_orderpriority as \"PRIORIDADE\", count(*) as n from orders group by 1")
def i1b(d):
    path = scratch_path(d.spark, "listas_json")
    grouped = d.table("orders").groupBy((F.col("o_orderkey") % 50).alias("g"), (F.col("o_orderkey") % 2).alias("h")).agg(
        F.collect_list(F.struct(F.col("o_orderpriority").alias("prioridade"))).alias("itens"))
    grouped.select(F.when(F.col("h") == 0, F.col("itens")).alias("pares"), F.when(F.col("h") == 1, F.col("itens")).alias("impares"), "g", "h").write.partitionBy("g", "h").json(path)  # one document per file
    return files.read_json_records(d.spark, path, shape="object").groupBy("PRIORIDADE").agg(F.count(F.lit(1)).alias("n"))


@query("I1_read_json_arrays", "select o_orderpriority as \"PRIORIDADE\", count(*) as n, cast(sum(o_orderkey) as bigint) as chaves from orders group by 1")
def i1c(d):
    """Four documents, each one list over many lines' worth of text, read by ranges."""
    path = scratch_path(d.spark, "vetor_json")
    orders = d.table("orders")
    record = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("chave"), F.struct(F.col("o_orderpriority").alias("prioridade"), F.lit('}{"[').alias("nota")).alias("dados"), F.col("o_orderpriority").alias("prioridade")))
    line = orders.select((F.col("o_orderkey") % 4).alias("g"), F.lit(1).alias("k"), F.concat(record, F.lit(",")).alias("value"))
    ends = line.select("g").distinct().select("g", F.explode(F.expr("array(struct(0 as k, '[' as value), struct(2 as k, 'null]' as value))")).alias("e")).select("g", "e.k", "e.value")
    line.unionByName(ends).repartition("g").sortWithinPartitions("g", "k").select("g", "value").write.partitionBy("g").text(path)
    out = files.read_json_records(d.spark, path, shape="array")
    return out.groupBy("PRIORIDADE").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("CHAVE").cast("long")).alias("chaves"))


@query("I2_unreadable_parquet", "select case when length(o_orderpriority) < 6 then 'curto' else 'sem_fim' end as motivo, count(distinct o_orderpriority) as n from orders group by 1")
def i2p(d):
    """Good Parquet files beside text that only begins like one."""
    root = scratch_path(d.spark, "misto")
    orders = d.table("orders")
    orders.write.parquet(f"{root}/bons")
    orders.select("o_orderpriority").distinct().select(F.concat(F.lit("PAR1 "), "o_orderpriority").alias("value"), F.col("o_orderpriority").alias("p")).write.partitionBy("p").option("compression", "none").text(f"{root}/maus")
    return files.unreadable_parquet(d.spark, root, pattern="*.{parquet,txt}").groupBy("motivo").agg(F.count(F.lit(1)).alias("n"))


@query("I2_quarantine_bad_records", "select 'bons' as grupo, count(*) as n from results union all select 'json_invalido', 2 * count(*) from customer")
def i2(d):
    good, bad = files.quarantine_bad_records(d.spark, written_lines(d))
    return good.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit("bons").alias("grupo"), "n").unionByName(
        bad.groupBy(F.col("motivo").alias("grupo")).agg(F.count(F.lit(1)).alias("n")))


@query("I3_discover_files", "select distinct 'resultados' as dominio_documento, 'dados' as tipo_arquivo_json, cast(year(o_orderdate) as varchar) as ano_arquivo from orders")
def i3(d):
    root = scratch_path(d.spark, "documentos")
    # Every task writes what it joined: one task that writes a year would have to join it alone.
    rows = materialize(d.results.select("ano", "votos"), "votos")
    for year in [str(y) for y in range(1995, 2002)]:
        rows.filter(F.col("ano") == year).select("votos").write.json(f"{root}/votacao_secao_{year}/JSON")
    return files.discover_files(d.spark, root).select("dominio_documento", "tipo_arquivo_json", "ano_arquivo").distinct()


_PATHS = f"case o_orderkey % 6 when 0 then {_RESULT_PATH} when 1 then {_PEOPLE_PATH} when 2 then 'x/consulta_cand_' || ano || '/a.json' when 3 then 'x/bem_candidato/b.json' when 4 then 'y/manifesto_1.json' else 'z/livre_' || ano || '.json' end"
_ORDERS = "(select o_orderkey, cast(year(o_orderdate) as varchar) as ano, 'asia' as uf from orders)"


@query("I4_classify_document", f"""select case k when 0 then 'resultados' when 1 then 'eleitorado' when 2 then 'candidatos' when 3 then 'candidatos' when 4 then 'metadados_processamento' else 'outros' end as dominio_documento,
  case k when 0 then 'votacao_secao' when 1 then 'perfil_eleitor_secao' when 2 then 'consulta_candidato' when 3 then 'bens_candidato' when 4 then 'manifesto_1' else 'livre_' || ano end as assunto_documento,
  case when k = 4 then 'metadado' else 'dados' end as tipo_arquivo_json, count(*) as n from (select o_orderkey % 6 as k, ano from {_ORDERS}) group by all""")
def i4(d):
    rows = paths(d)
    return counted(rows, **files.classify_document("path"))


def paths(d: Data) -> DataFrame:
    base = d.table("orders").selectExpr("o_orderkey", "cast(year(o_orderdate) as string) as ano", "'asia' as uf")
    return base.select(F.expr(_PATHS).alias("path"), "ano")


@query("I5_year_from_path", f"select case when k in (3, 4) then '' else ano end as v, ano as periodo, count(*) as n from (select o_orderkey % 6 as k, ano from {_ORDERS}) group by all")
def i5(d):
    return counted(paths(d), v=files.year_from_path("path"), periodo=files.document_period("path", F.col("ano")))


@query("I6_detect_year", "select case when o_orderkey % 3 = 2 then '' else cast(year(o_orderdate) as varchar) end as ano, count(*) as n from orders group by 1")
def i6(d):
    raw = d.table("orders").selectExpr(
        "if(o_orderkey % 3 = 0, concat('', year(o_orderdate)), '') as ANO_ELEICAO", "if(o_orderkey % 3 = 2, 'de 1990 a 1994', concat('pleito de ', year(o_orderdate))) as OBS", "'x' as OUTRA")
    return counted(raw, ano=roles.detect_year(raw.columns))


@query("I7_read_delimited_grouped", "select o_orderpriority as \"PRIORIDADE\", count(*) as n, cast(sum(o_orderkey) as bigint) as chaves from orders group by 1")
def i7(d):
    groups = written_groups(d)
    (rows,) = groups.values()
    return rows.groupBy("PRIORIDADE").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("CHAVE").cast("long")).alias("chaves"))


def written_groups(d: Data):
    root = scratch_path(d.spark, "csv")
    orders = d.table("orders")
    orders.filter("o_orderkey % 2 = 0").selectExpr("o_orderkey as chave", "o_orderpriority as prioridade").write.options(header="true", sep=";").csv(f"{root}/a")
    orders.filter("o_orderkey % 2 = 1").selectExpr("o_orderpriority as PRIORIDADE", "o_orderkey as CHAVE").write.options(header="true", sep="|").csv(f"{root}/b")
    found = d.spark.read.text(f"{root}/a").inputFiles() + d.spark.read.text(f"{root}/b").inputFiles()
    return delimited.read_delimited_grouped(d.spark, sorted(found))


@query("I7_group_manifest", "select 1 as grupo_id, 'CHAVE,PRIORIDADE' as campos, count(*) as qtd_linhas from orders")
def i7m(d):
    return delimited.group_manifest(written_groups(d))


@query("I9_resolve_role_column", "select partido, case when votos % 2 = 0 then candidato else 'URNA ' || candidato end as candidato, count(*) as n from results group by all")
def i9(d):
    raw = d.results.selectExpr("nr_votavel as NR_PARTIDO", "partido as SG_PARTIDO", "concat('nome ', partido) as NM_PARTIDO_LONGO", "candidato as NM_CANDIDATO",
                               "if(votos % 2 = 0, '', concat('URNA ', candidato)) as NM_URNA_CANDIDATO", "nr_votavel as NR_CANDIDATO")
    ordered = ["NR_PARTIDO", "SG_PARTIDO", "NM_PARTIDO_LONGO", "NM_URNA_CANDIDATO", "NM_CANDIDATO", "NR_CANDIDATO"]
    return counted(raw, partido=roles.resolve_role(ordered, "partido"), candidato=roles.resolve_role(ordered, "candidato"))


@query("I10_records_to_gold_base", f"select ano, {_UF} as uf, case turno when '1' then 'Primeiro turno' else 'Segundo turno' end as turno, partido, count(*) as n, cast(sum(votos) as double) as votos from results group by all")
def i10(d):
    out = silver.records_to_gold_base(raw_votes(d))
    return out.groupBy("ano", "uf", "turno", "partido").agg(F.count(F.lit(1)).alias("n"), F.sum("votos").alias("votos"))


@query("I13_silver_electorate", f"select ano, {_UF} as uf, case when eleitorado % 2 = 0 then 'Masculino' else 'Feminino' end as perfil_genero, case when {ok('perfil_raca_cor')} then perfil_raca_cor else '' end as perfil_raca_cor, count(*) as n, cast(sum(eleitorado) as double) as eleitorado from electorate group by all")
def i13(d):
    out = silver.silver_electorate(raw_people(d), "perfil.json")
    return out.groupBy("ano", "uf", "perfil_genero", "perfil_raca_cor").agg(F.count(F.lit(1)).alias("n"), F.sum("eleitorado").alias("eleitorado"))


_BAND = "case when a < 21 then '18 a 20 anos' when a < 25 then '21 a 24 anos' else (a // 5 * 5) || ' a ' || (a // 5 * 5 + 4) || ' anos' end"


@query("I14_silver_candidates", f"""select candidato, nr_candidato, perfil_faixa_etaria, count(*) as n from (
  select distinct ano, {_UF}, cargo, partido, candidato, nr_candidato, sq_candidato, situacao_candidatura, resultado_candidatura, {_BAND} as perfil_faixa_etaria
  from (select *, 20 + cast(nr_candidato as bigint) % 60 as a from candidates)) group by all""")
def i14(d):
    out = silver.silver_candidates(raw_candidates(d))
    return counted(out, candidato=F.col("candidato"), nr_candidato=F.col("nr_candidato"), perfil_faixa_etaria=F.col("perfil_faixa_etaria"))


@query("I15_silver_results", f"select ano, {_UF} as uf, case turno when '1' then 'Primeiro turno' else 'Segundo turno' end as turno, partido, nr_votavel, count(*) as n, cast(sum(votos) as double) as votos from results group by all")
def i15(d):
    out = silver.silver_results(raw_votes(d))
    return out.groupBy("ano", "uf", "turno", "partido", "nr_votavel").agg(F.count(F.lit(1)).alias("n"), F.sum("votos").alias("votos"))


@query("I16_silver_conform", "select ano, 'SEM_UF' as uf, cd_municipio, zona, secao, cargo, turno, partido, candidato, nr_votavel, cast(sum(votos) as double) as votos, cast(sum(brancos) as double) as brancos, cast(sum(nulos) as double) as nulos, cast(sum(votos) as double) as validos_estimados from results group by all")
def i16(d):
    out = silver.silver_conform("resultados_votos", d.results)
    return out.drop("nm_municipio", "local_votacao", "bairro", "sq_candidato", "schema_id", "arquivo_origem", "qtd_registros")


@query("I17_bronze_with_lineage", f"select 'resultados' as _dominio_documento, {_UF} as _uf_particao, ano as _ano_arquivo, {_RESULT_PATH} as _arquivo_origem, count(*) as n from results group by all")
def i17(d):
    path = F.expr(_RESULT_PATH.replace("ano", "ANO_ELEICAO").replace("uf", "UFN"))
    bronze = silver.bronze_with_lineage(raw_votes_named(d), "resultados", path, F.col("SG_UF"))
    return counted(bronze, **{c: F.col(c) for c in ("_dominio_documento", "_uf_particao", "_ano_arquivo", "_arquivo_origem")})


def raw_votes_named(d: Data) -> DataFrame:
    return d.results.selectExpr("ano as ANO_ELEICAO", f"{_UF} as SG_UF", "uf as UFN", "votos as QT_VOTOS")


@query("I18_schema_catalog", "select 'resultados' as dominio, 12 as qtd_campos, count(*) as n from results union all select 'eleitorado', 10, count(*) from electorate")
def i18(d):
    votes, people = raw_votes(d), raw_people(d)
    catalog = silver.schema_catalog(d.spark, [("resultados", "a.json", votes.columns), ("eleitorado", "b.json", people.columns)])
    ids = silver.bronze_with_lineage(votes, "resultados", "a.json", F.col("SG_UF")).select("_schema_id").unionByName(
        silver.bronze_with_lineage(people, "eleitorado", "b.json", F.col("SG_UF")).select("_schema_id"))
    return ids.join(catalog, ids["_schema_id"] == catalog["schema_id"]).groupBy("dominio", "qtd_campos").agg(F.count(F.lit(1)).alias("n"))


@query("I19_narrow_section_docs", """select 'resultado_secao' as tipo_documento, ano, 'SEM_UF' as uf, count(*) as n, cast(sum(votos) as double) as total from results group by all
  union all select 'perfil_secao', ano, 'SEM_UF', count(*), cast(sum(eleitorado) as double) from electorate group by all union all select 'candidatos_secao', ano, 'SEM_UF', count(*), 0.0 from candidates group by all""")
def i19(d):
    parts = []
    for kind, df, total in (("resultado_secao", d.results, "votos"), ("perfil_secao", d.electorate, "eleitorado_perfil"), ("candidatos_secao", d.candidates, "qtd_registros_candidato")):
        parts.append(silver.narrow_section_docs(df, kind).groupBy("tipo_documento", "ano", "uf").agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("total")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("I20_partitioned_sink_scan", "select ano, uf, partido, count(*) as n, cast(sum(votos) as bigint) as votos from results group by all")
def i20(d):
    path = scratch_path(d.spark, "prata")
    tables.partitioned_sink(d.results, path, ["uf"])
    out = tables.scan_gold(d.spark, path)
    return out.groupBy(F.col("ano").cast("string").alias("ano"), "uf", "partido").agg(F.count(F.lit(1)).alias("n"), F.sum("votos").alias("votos"))


@query("I21_scan_gold_merged", "select count(*) as n, count(*) filter (where o_orderkey % 2 = 0) as com_extra from orders")
def i21(d):
    path = scratch_path(d.spark, "ouro")
    d.table("orders").filter("o_orderkey % 2 = 0").selectExpr("o_orderkey", "1 as extra").write.parquet(f"{path}/parte=a")
    d.table("orders").filter("o_orderkey % 2 = 1").select("o_orderkey").write.parquet(f"{path}/parte=b")
    return tables.scan_gold(d.spark, path).agg(F.count(F.lit(1)).alias("n"), F.count("extra").alias("com_extra"))


@query("I22_csv_preview_sink", "select least(count(*), 100) as n, 1 as notas from orders")
def i22(d):
    path = scratch_path(d.spark, "previa")
    tables.csv_preview_sink(d.table("orders"), path, 100)
    out = d.spark.read.options(header="true", sep=";").csv(path)
    assert d.spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 3)).first()[0] == tables.BYTE_ORDER_MARK.encode()
    return out.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_csv_preview_observacao").alias("notas"))


@query("I23_incremental_refresh", "select ano, uf, cast(sum(votos) as bigint) as votos, '1' as refeito from results where ano >= '1998' group by all union all select ano, uf, 0, '0' from results where ano < '1998' group by all")
def i23(d):
    """Old slices are finished with a marker value; a refresh adds the new ones and leaves them."""
    path, manifest = scratch_path(d.spark, "ouro"), scratch_path(d.spark, "manifesto")

    def build(mark):
        return lambda rows: rows.groupBy("ano", "uf").agg(F.sum(F.col("votos") * mark).alias("votos"), F.lit(str(mark)).alias("refeito"))

    tables.incremental_refresh(d.results.filter("ano < '1998'"), build(0), path, manifest, "v1")
    tables.incremental_refresh(d.results, build(1), path, manifest, "v1")
    return d.spark.read.schema("votos long, refeito string, ano string, uf string").parquet(path)


@query("I24_slice_filter", "select uf, ano, cd_municipio, count(*) as n from results where uf in ('ASIA', 'EUROPE') and ano = '1997' and (uf, cd_municipio) in (select (uf, cd_municipio) from (select distinct uf, cd_municipio, dense_rank() over (partition by uf order by cd_municipio) as r from results where ano = '1997') where r <= 2) group by all")
def i24(d):
    out = tables.slice_filter(d.results, ["asia", "EUROPE"], ["1997"], 2)
    return counted(out, uf=F.col("uf"), ano=F.col("ano"), cd_municipio=F.col("cd_municipio"))


@query("I25_list_places", """select cd_municipio, max(nm_municipio) as nm_municipio, cast(sum(linhas) as bigint) as linhas_total, cast(sum(e) as double) as eleitorado_estimado from (
  select cd_municipio, max(nm_municipio) as nm_municipio, max(eleitorado) as e, count(*) as linhas from electorate group by cd_municipio, zona, secao
  union all select cd_municipio, max(nm_municipio), 0, count(*) from results group by cd_municipio) group by cd_municipio""")
def i25(d):
    return tables.list_places(d.electorate, d.results)


@query("I26_reservoir_sample", "select o_orderkey, o_orderstatus from (select * from orders order by md5('42|' || o_orderkey) limit (select cast(least(5000, greatest(10, round(count(*) * 0.1))) as bigint) from orders))")
def i26(d):
    return tables.reservoir_sample(d.table("orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 0.1, 10, 5000)


@query("I26_head_sample", "select * from orders order by o_orderkey, o_custkey limit 100")
def i26h(d):
    return tables.head_sample(d.table("orders"), 100)


@query("I27_analytic_projection", "select count(*) as n, cast(sum(round(l_extendedprice * 100)) as bigint) as centavos, count(distinct l_returnflag) as marcas from lineitem")
def i27(d):
    rows = d.table("lineitem").select("l_orderkey", "l_extendedprice", "l_returnflag", F.col("l_suppkey").alias("CD_FORNECEDOR"))
    out = tables.analytic_projection(rows, profiling.semantic_profile(rows))
    assert "CD_FORNECEDOR" not in out.columns
    return out.agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("centavos"), F.countDistinct("l_returnflag").alias("marcas"))


@query("I28_row_counts_by_table", " union all ".join(f"select '{t}' as tabela, count(*) as linhas from {t}" for t in ("orders", "lineitem", "customer", "events")))
def i28(d):
    return tables.row_counts_by_table({t: d.table(t) for t in ("orders", "lineitem", "customer", "events")})

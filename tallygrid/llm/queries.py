"""Registered queries of this subpackage, each over its whole table, and SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate, html_paths, language_id, line_dedup, merkle, ngram_join, prefix_trie, quality_neighbours, quality_rules, record_sql, secrets, sentence_pieces, url_rules, warc,
)
from ..session import scratch_path
from .common import crc_mod, table


# The given url rules.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_paths.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_upper", "n_top_word")


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    held_out = crc_mod("doc_id", 5) == 0
    scored = quality_neighbours.split_and_score(table(spark, folder, "documents"), table(spark, folder, "labels"), held_out)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge(pages, table(spark, folder, "labels"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "mined")


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, folder, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return done.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op7_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.split_and_predict(table(spark, folder, "documents"), crc_mod("doc_id", 4) == 2)


def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(table(spark, folder, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


#: The model that the queries use; a parameter of the operator.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = sentence_pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), sentence_pieces.read_model(MODEL))
    return coded.select("doc_id", "n_tokens", "ids", "parity", "round_trip")


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = F.when(crc_mod("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proved = merkle.manifest(docs, "source", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], {"text": tampered})
    digests = {"leaf": "leaf", "subroot": "subroot", "root": "root", "folded_root": "folded_root"}
    shown = [F.lower(F.hex(c)).alias(name) for name, c in digests.items()]
    proof = F.lower(F.hex(merkle.proof_digest("path"))).alias("proof_sha256")
    return proved.select("doc_id", *shown, proof, (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages, path = table(spark, folder, "pages"), scratch_path(spark, "warc")
    warc.write(pages, path)
    back, kind = warc.read(spark, path), dict(pages.dtypes)["page_id"]
    ids = {"page_id": F.col("page").cast(kind), "refers_to": F.col("refers_to").cast(kind)}
    return back.withColumns(ids).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op13_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.build(table(spark, folder, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_quality_rules, op3_benchmark_decontamination, op4_quality_classifier, op5_url_filters,
        op6_line_dedup, op7_secret_scans, op8_language_id, op9_ngram_jaccard_join, op10_sentencepiece, op11_merkle_manifest,
        op12_warc, op13_conversation_prefix_trie,
    )
}
_WHITE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP6 = f"""
with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select r, doc_id, unnest(ls) as line, unnest(range(len(ls))) as i from d),
k as (select *, translate(trim(line, {_WHITE_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key from k where key <> '' group by key having count(distinct r) >= 10)
select doc_id, count(*) as n_lines, count(f.key) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where f.key is null), '')) as kept_sha256
from k left join f using (key) group by r, doc_id
"""

_OP3 = r"""
with w as (
  select 'd' as kind, doc_id as id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as ws from documents
  union all select 'i', item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') from benchmark),
s as (select distinct kind, id, array_to_string(ws[i:i + 4], ' ') as g from (select *, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5)),
k as (select distinct len(ws) as k from w where kind = 'i' and len(ws) between 1 and 4),
a as (select * from s union all select 'i', id, array_to_string(ws, ' ') from w where kind = 'i' and len(ws) between 1 and 4
  union all select distinct 'd', id, array_to_string(ws[i:i + k - 1], ' ') from (select *, unnest(range(1, len(ws) - k + 2)) as i from w, k where kind = 'd' and len(ws) >= k)),
n as (select id, count(*) as n from a where kind = 'i' group by id),
p as (select d.id as doc_id, i.id as item_id, count(*) as n_shared from a d join a i on d.g = i.g where d.kind = 'd' and i.kind = 'i' group by 1, 2)
select doc_id, item_id, n as n_item_shingles, n_shared, round(n_shared / n, 6) as containment
from p join n on n.id = item_id where 100 * n_shared >= 80 * n
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_OP9 = f"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_AZ}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents),
s as (
  select distinct doc_id, case when len(ws) < 4 then array_to_string(ws, ' ') else array_to_string(ws[i:i + 3], ' ') end as g
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) as i from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 85 * (x.n + y.n - common)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as node, doc_id as seen from documents union select r.node, e.b from r join e on e.a = r.seen)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id
from documents d left join n using (doc_id) join (select node as doc_id, min(seen) as component_id from r group by node) c using (doc_id)
"""

ORACLE: dict[str, str] = {
    "op3_benchmark_decontamination": _OP3, "op6_line_dedup": _OP6, "op9_ngram_jaccard_join": _OP9,
    "op11_merkle_manifest": record_sql.OP11, "op12_warc": record_sql.OP12, "op13_conversation_prefix_trie": record_sql.OP13,
}

"""URL filters: given host rules, and association rules mined from labels.

Given rules (host, path prefix, verdict) fit a host and its subdomains; the longest that fits
decides.  The other urls are decided by mined rules:

* A url is a set of tokens: host labels by level, words of hyphenated labels, path segments
  (numbers generalised), extension, query keys and scheme.
* Pages whose url ends in the id of a labelled document carry its label.  FP-growth mines
  token combinations of the bad urls alone; Spark counts them among all labelled urls.  Rules
  are kept with enough bad urls (a number, whatever the table's size), enough confidence and
  enough above the base rate; one that contains a shorter rule at least as sure is pruned.
* Rules are indexed by their rarest token.  Each distinct token set looks its tokens up; a rule
  matches if the set holds all of it.  A url that any mined rule matches is blocked, else allowed.

All of it is DataFrame functions and pyspark.ml.  A null url, or one without "://", has an
empty host and path, fits no rule and has no tokens: it is allowed.  Without labels, or with
labels that no token combination explains, nothing is mined.  Repeated rows are judged
alike; a document labelled twice is bad if any label says so.  Extra columns stay.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import small


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without "://"."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lowered, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; rules are (verdict, host/path) and few."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        top, _, rest = text.partition("/")
        fits = ((host == top) | host.endswith(f".{top}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """The distinct tokens of a url; none without "://"."""
    host, path = parts(url)
    labels = F.reverse(F.split(host, "\\."))
    levels = F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x))
    joined = F.filter(labels, lambda x: F.contains(x, F.lit("-")))
    words = F.transform(F.flatten(F.transform(joined, lambda x: F.split(x, "-"))), lambda x: F.concat(F.lit("w:"), x))
    segments = F.transform(F.array_remove(F.split(F.lower(path), "/"), ""), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0")))
    ending = F.regexp_extract(F.lower(path), "\\.([a-z0-9]{1,5})/?$", 1)
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    keys = F.transform(F.array_remove(F.split(query, "&"), ""), lambda x: F.concat(F.lit("q:"), F.lower(F.regexp_extract(x, "^([^=]*)", 1))))
    scheme = F.array(F.concat(F.lit("s:"), F.lower(F.regexp_extract(url, "^([^:]*)://", 1))))
    end = F.when(ending != "", F.array(F.concat(F.lit("e:"), ending))).otherwise(F.array().cast("array<string>"))
    every = F.array_sort(F.array_distinct(F.concat(levels, words, segments, end, keys, scheme)))
    return F.when(host != "", every).otherwise(F.array().cast("array<string>"))


def labelled_id(path: Column) -> Column:
    """The number that a path ends in."""
    return F.regexp_extract(path, "/([0-9]{1,18})(?:\\.[a-z]+)?/?$", 1).try_cast("long")


def mine(pages: DataFrame, labels: DataFrame, min_count: int = 20, min_confidence: float = 0.5, min_lift: float = 2.0) -> DataFrame:
    """(rule, tokens, confidence, support, lift) of token combinations that go with a bad label.

    A combination must be in `min_count` bad urls.  Its urls must be bad `min_lift` times as often
    as all, or good `min_lift` times as seldom, which stays possible when most urls are bad.
    Tokens that only bad urls have are rules by themselves and prune all that contains them, so
    they are not mined further.  What reaches the driver inside FP-growth are the other tokens
    with `min_count` bad urls; its combinations grow with the tokens that so many bad urls share.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    own = pages.select(labelled_id(parts(F.col("url"))[1]).alias("doc_id"), tokens(F.col("url")).alias("items")).where("doc_id is not null")
    sets = own.join(marks, "doc_id").where(F.size("items") > 0).groupBy("items").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 0).alias("bad"))
    sets = materialize(sets, "url-baskets")
    total, bad = (x or 0 for x in sets.agg(F.sum("n"), F.sum("bad")).first())
    counted = sets.select(F.explode("items").alias("token"), "n", "bad").groupBy("token").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    counted = materialize(counted.where(F.col("bad") >= min_count), "url-tokens")
    pure = counted.where("bad = n").select(F.array("token").alias("tokens"), "n", "bad")

    mixed = sets.where("bad > 0").select("items", "bad", F.explode("items").alias("token")).join(counted.where("bad < n").select("token"), "token")
    baskets = mixed.groupBy("items", "bad").agg(F.collect_list("token").alias("mixed"))
    baskets = materialize(baskets.select(F.col("mixed").alias("items"), F.explode(F.sequence(F.lit(1), F.col("bad").cast("int")))).select("items"), "url-bad")
    least = min(1.0, (min_count - 0.5) / max(1, baskets.count()))
    found = FPGrowth(itemsCol="items", minSupport=least).fit(baskets).freqItemsets.where(F.col("freq") >= min_count)
    asked = found.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("bad"))
    rarest = asked.select("tokens", "bad", F.explode("tokens").alias("token")).join(counted.select("token", "n"), "token")
    rarest = rarest.groupBy("tokens", "bad").agg(F.min(F.struct("n", "token")).alias("w")).select("tokens", "bad", F.col("w.token").alias("token"))
    met = sets.select("items", "n", F.explode("items").alias("token")).join(small(materialize(rarest, "url-itemsets"), 512), "token")
    among = met.where(_holds("items", "tokens")).groupBy("tokens", "bad").agg(F.sum("n").alias("n")).select("tokens", "n", "bad")

    base = bad / max(1, total)
    confidence = F.col("bad") / F.col("n")
    rules = among.unionByName(pure).select(
        F.array_join("tokens", " ").alias("rule"), "tokens", confidence.alias("confidence"), (F.col("bad") / F.lit(max(1, total))).alias("support"),
        (confidence / F.lit(base or 1.0)).alias("lift"),
    )
    better = (F.col("lift") >= min_lift) | ((1 - F.col("confidence")) * min_lift <= 1 - base)
    sure = rules.where((F.col("confidence") >= min_confidence) & (F.col("confidence") > base) & better)
    return prune(materialize(sure, "url-rules"))


def _holds(items: str, part: str) -> Column:
    return F.size(F.array_except(part, items)) == 0


def _indexed(rules: DataFrame) -> DataFrame:
    """The rules with `token`, the one of theirs that the fewest rules have."""
    every = rules.select("rule", F.explode("tokens").alias("token"))
    first = every.join(every.groupBy("token").agg(F.count("*").alias("n")), "token").groupBy("rule").agg(F.min(F.struct("n", "token")).alias("w"))
    return rules.join(first.select("rule", F.col("w.token").alias("token")), "rule")


def prune(rules: DataFrame) -> DataFrame:
    """Rules of which no proper part is a rule at least as sure; parts are found by their rarest token."""
    index = _indexed(rules).select(F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"), "token")
    asked = rules.select("rule", "tokens", "confidence", F.explode("tokens").alias("token"))
    met = asked.join(index, "token").where((F.size("part") < F.size("tokens")) & (F.col("part_confidence") >= F.col("confidence")) & _holds("tokens", "part"))
    return rules.join(met.select("rule").distinct(), "rule", "left_anti")


def matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(items, mined) for token sets that a rule matches; mined is the surest rule."""
    index = _indexed(rules).select("rule", "tokens", "confidence", "token")
    full = sets.select("items", F.explode("items").alias("token")).join(small(materialize(index, "url-index"), 512), "token").where(_holds("items", "tokens"))
    return full.groupBy("items").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "rule")).alias("w")).select("items", F.col("w.rule").alias("mined"))


def judge(pages: DataFrame, labels: DataFrame, given: list[tuple[str, str]], **parameters) -> DataFrame:
    """The pages with host, path, rule, verdict and `mined` (the mined rule that blocks, if any)."""
    host, path = parts(F.col("url"))
    rules = materialize(mine(pages, labels, **parameters), "url-pruned")
    sets = pages.select(tokens(F.col("url")).alias("items")).where(F.size("items") > 0).distinct()
    blocked = small(materialize(matched(sets, rules), "url-matched"), 1024)
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "mined")]
    row = pages.select(F.struct(*own).alias("_own"), host.alias("host"), path.alias("path"), tokens(F.col("url")).alias("items"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), given)
    judged = row.join(blocked, "items", "left")
    what = F.coalesce(verdict, F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("_own.*", "host", "path", rule.alias("rule"), what.alias("verdict"), F.when(rule.isNull(), F.col("mined")).alias("mined"))

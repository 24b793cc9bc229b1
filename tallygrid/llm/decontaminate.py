"""Find benchmark items inside documents: MinHash containment search by item size.

An item's containment in a document is the share of its distinct five-word shingles that the
document has.  Items are partitioned by size.  A partition's items are sketched with their k
smallest shingle hashes (bottom-k MinHash), where k depends on the partition's sizes only:
an item of s shingles may miss `allowed = floor((1 - threshold) * s)` of them, so of its k
smallest at least `k - allowed` are in every document that contains it.  With k above
`allowed` for the whole partition this search has no false negatives, whatever the length of
the document: long documents are never reduced to a sketch of their own, in which a short
item would vanish.  The pairs that reach the bound are verified on the shingles' words.

Only the items' sketches and the documents' shingle hashes meet in a join, left to size-checked
planning (a broadcast of a small side, else a split sort-merge join).  Documents meet
candidates by a digest of their text, which is broadcast up to a counted size and shuffled
beyond it; copies of one document are verified once.

All of it is DataFrame functions.  Words are runs of letters and digits, lower-cased.  An item of
one to four words is one shingle, its whole sequence, and meets the documents' windows of its own
length (made only for lengths that items have).  Texts without words contain nothing and are in
nothing, null ones too; a short document holds the short items that occur in it.  Texts are read
whole, whatever their length.  Repeated rows and equal items give a row each; extra columns stay out
of the pairs and in the documents of `clean`.  Empty tables give no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import small

WIDTH = 5
_WORD_BREAK = "[^\\p{L}\\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _WORD_BREAK), "")


def _per_shingle(text: Column, make, width: int = WIDTH) -> Column:
    """`make` of the words at each place; the words are bound once, not split again per place."""

    def places(w: Column) -> Column:
        at = F.when(F.size(w) >= width, F.sequence(F.lit(0), F.size(w) - width)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: make([F.get(w, i + j) for j in range(width)]))

    return F.flatten(F.transform(F.array(words(text)), places))


def _hash(ws: list[Column]) -> Column:
    return F.xxhash64(*ws)


def _join(ws: list[Column]) -> Column:
    return F.concat_ws(" ", *ws)


def _of_document(text: Column, make, lengths: list[int]) -> Column:
    """A document's five-word shingles, and its windows of the lengths that short items have."""
    parts = [_per_shingle(text, make), *[_per_shingle(text, make, n) for n in lengths]]
    return F.array_distinct(F.concat(*parts) if lengths else parts[0])


def _of_item(text: Column, make, lengths: list[int]) -> Column:
    """An item's five-word shingles, or its whole sequence of fewer words."""
    out = _per_shingle(text, make)
    for n in lengths:
        out = F.when(F.size(words(text)) == n, _per_shingle(text, make, n)).otherwise(out)
    return F.array_distinct(out)


def short_lengths(items: DataFrame) -> list[int]:
    """The numbers of words, one to four, of items that have no five-word shingle."""
    sizes = items.select(F.size(words(F.col("text"))).alias("n")).where(F.col("n").between(1, WIDTH - 1)).distinct()
    return sorted(r["n"] for r in sizes.collect())  # at most four numbers


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _allowed(size: Column, percent: int) -> Column:
    """Shingles that a contained item may miss: size - ceil(percent * size / 100)."""
    return size - F.ceil(F.lit(percent) * size / F.lit(100))


def sketch_items(items: DataFrame, percent: int, margin: int, lengths: list[int]) -> DataFrame:
    """(item_key, least, h): the k smallest hashes of each distinct item, and how many a match needs.

    Partition p holds the sizes of 2**p up to 2**(p+1) - 1; its k is what its largest size
    may miss, plus `margin`.
    """
    distinct = items.where(F.col("text").isNotNull()).select(text_key(F.col("text")).alias("item_key"), "text").dropDuplicates(["item_key"])
    sized = distinct.withColumn("hs", F.array_sort(_of_item(F.col("text"), _hash, lengths))).withColumn("n", F.size("hs")).where("n > 0")
    part = F.floor(F.log2(F.col("n"))).cast("int")
    largest = F.pow(F.lit(2.0), part + 1) - 1
    sized = sized.withColumn("k", F.least(F.col("n"), (_allowed(largest, percent) + margin).cast("int")))
    least = F.greatest(F.col("k") - _allowed(F.col("n"), percent), F.lit(1)).cast("int")
    return sized.select("item_key", least.alias("least"), F.explode(F.slice("hs", F.lit(1), F.col("k"))).alias("h"))


def candidates(docs: DataFrame, items: DataFrame, percent: int, margin: int, lengths: list[int]) -> DataFrame:
    """(text_key, item_key): pairs whose sketch matches reach the bound."""
    sketches = materialize(sketch_items(items, percent, margin, lengths), "item-sketches")
    hashes = docs.where("text is not null").select(text_key(F.col("text")).alias("text_key"), F.explode_outer(_of_document(F.col("text"), _hash, lengths)).alias("h"))
    hits = hashes.join(sketches, "h").select("text_key", "item_key", "h", "least").distinct()
    return hits.groupBy("text_key", "item_key").agg(F.count("*").alias("hits"), F.first("least").alias("least")).where("hits >= least").select("text_key", "item_key")


def contained(docs: DataFrame, items: DataFrame, percent: int = 80, margin: int = 4) -> DataFrame:
    """(text_key, item_key, n_item_shingles, n_shared): distinct texts that contain distinct items."""
    lengths = short_lengths(items)
    pairs = materialize(candidates(docs, items, percent, margin, lengths), "item-candidates")
    keys = materialize(pairs.select("text_key").distinct(), "item-candidate-keys")
    texts = docs.where("text is not null").select(text_key(F.col("text")).alias("text_key"), "text").join(small(keys), "text_key").dropDuplicates(["text_key"])
    by_text = pairs.groupBy("text_key").agg(F.collect_set("item_key").alias("asked"))
    asked = texts.join(by_text, "text_key").select("text_key", _of_document(F.col("text"), _join, lengths).alias("have"), F.explode("asked").alias("item_key"))
    wanted = items.where("text is not null").select(text_key(F.col("text")).alias("item_key"), _of_item(F.col("text"), _join, lengths).alias("want")).dropDuplicates(["item_key"])
    counts = F.size("want").cast("long").alias("n_item_shingles"), F.size(F.array_intersect("want", "have")).cast("long").alias("n_shared")
    checked = asked.join(wanted, "item_key").select("text_key", "item_key", *counts)
    return materialize(checked.where(F.col("n_shared") * 100 >= F.col("n_item_shingles") * percent), "item-contained")


def find(docs: DataFrame, items: DataFrame, percent: int = 80, margin: int = 4) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment) for every document and item it contains."""
    pairs = contained(docs, items, percent, margin)
    named = items.where("text is not null").select("item_id", text_key(F.col("text")).alias("item_key"))
    owners = docs.where("text is not null").select("doc_id", text_key(F.col("text")).alias("text_key"))
    joined = owners.join(pairs, "text_key").join(named, "item_key")
    share = F.round(F.col("n_shared") / F.col("n_item_shingles"), 6)
    return joined.select("doc_id", "item_id", "n_item_shingles", "n_shared", share.alias("containment"))


def clean(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """The documents that contain no item."""
    bad = materialize(contained(docs, items, percent).select("text_key").distinct(), "item-bad-keys")
    row = docs.select(F.struct(*docs.columns).alias("_row"), text_key(F.col("text")).alias("text_key"))
    return row.join(small(bad), "text_key", "left_anti").select("_row.*")

"""Benchmark decontamination: a prefix-filtered join of document shingles with benchmark windows, checked word by word.

A window is ``size`` consecutive item words, or all words of a shorter item, seen as a set of shingles of three words (fewer only if the
window is shorter). It occurs in a document only if all its shingles do, so its prefix of necessary tokens is a single one: the
shingle that is rarest over all documents. The documents are read once for the positions of benchmark shingles; counts,
prefix join, positional bounds (the window must lie inside the document) and the comparison of all its words follow on these rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrain.llm.common import ascii_lower, small, words_of, written

#: Between words, once A-Z is lower case: every ASCII character but digits and a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3
#: Benchmark shingles (16 bytes each) broadcast at a time; more take further passes over the documents.
SHINGLES_AT_ONCE = 4_000_000


def contract_words(text: Column) -> Column:
    return words_of(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN)


def windows(items: DataFrame, size: int) -> DataFrame:
    """(item_id, window, len): windows of each item as words joined by a space; items without words have none."""
    items = items.select("item_id", contract_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - size, F.lit(0))
    starts = items.select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    part = F.slice("words", F.col("at") + 1, F.least(F.lit(size), F.size("words")))
    return starts.select("item_id", F.array_join(part, " ").alias("window"), F.size(part).alias("len")).distinct()


def _hash(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*(F.get(words, at + i) for i in range(k)))


def window_shingles(wins: DataFrame) -> DataFrame:
    """(window, len, at, k, h): the shingles of each distinct window."""
    wins = wins.select("window", "len").distinct().withColumn("words", F.split("window", " "))
    k = F.least(F.lit(SHINGLE), F.col("len"))
    parts = wins.select("window", "len", "words", k.alias("k"), F.explode(F.sequence(F.lit(0), F.col("len") - k)).alias("at"))
    words, at = F.col("words"), F.col("at")
    h = F.when(F.col("k") == 1, _hash(words, at, 1)).when(F.col("k") == 2, _hash(words, at, 2)).otherwise(_hash(words, at, SHINGLE))
    return parts.select("window", "len", "at", "k", h.alias("h"))


def shingle_positions(docs: DataFrame, shingles: DataFrame, size: int) -> DataFrame:
    """(doc_id, key, n_words, pos, k, h, start, context): where documents hold a benchmark shingle, with the words around it."""
    wanted = written(shingles.select("k", "h").distinct(), "benchmark-shingles")
    sizes = sorted(r["k"] for r in wanted.select("k").distinct().collect())
    passes = -(-wanted.count() // SHINGLES_AT_ONCE)
    docs = docs.select("doc_id", F.xxhash64("text").alias("key"), contract_words(F.col("text")).alias("words"))
    spots = docs.select("doc_id", "key", "words", F.posexplode("words").alias("pos", "word"))
    words, pos = F.col("words"), F.col("pos")
    hashes = [F.struct(F.lit(k).alias("k"), F.xxhash64("word", *(F.get(words, pos + i) for i in range(1, k))).alias("h")) for k in sizes]
    if len(hashes) == 1:
        spots = spots.select("doc_id", "key", "words", "pos", hashes[0]["k"].alias("k"), hashes[0]["h"].alias("h"))
    else:
        spots = spots.select("doc_id", "key", "words", "pos", F.inline(F.array(*hashes)))
    spots = spots.where(pos + F.col("k") <= F.size("words"))
    start = F.greatest(pos - (size - 1), F.lit(0))
    found = []
    for i in range(passes):
        part = F.broadcast(wanted.where(F.pmod("h", F.lit(passes)) == i))
        found.append(spots.join(part, ["k", "h"]).select(
            "doc_id", "key", F.size("words").alias("n_words"), "pos", "k", "h", start.alias("start"), F.slice("words", start + 1, pos + size - start).alias("context")))
    return written(reduce(DataFrame.unionAll, found), "benchmark-positions")


def occurrences(docs: DataFrame, items: DataFrame, size: int = 13) -> DataFrame:
    """(doc_id, key, at, len, window): every place where a window of an item occurs in a document."""
    shingles = written(window_shingles(windows(items, size)), "window-shingles")
    if shingles.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, key long, at int, len int, window string")
    spots = shingle_positions(docs, shingles, size)
    counts = spots.groupBy("k", "h").agg(F.count("*").alias("n"))
    rarest = shingles.join(counts, ["k", "h"], "left").groupBy("window", "len").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "k", "h")).alias("p"))
    prefix = rarest.where("p.n > 0").select("window", "len", F.col("p.at").alias("offset"), F.col("p.k").alias("k"), F.col("p.h").alias("h"))
    near = spots.join(prefix, ["k", "h"]).withColumn("at", F.col("pos") - F.col("offset"))
    near = near.where("at >= 0 AND at + len <= n_words")
    same = F.array_join(F.slice("context", F.col("at") - F.col("start") + 1, F.col("len")), " ") == F.col("window")
    return near.where(same).select("doc_id", "key", "at", "len", "window").distinct()


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 13, share: int = 20) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, item_ids, contaminated), one row per document; text_key is the XXH64 of the text.

    n_hit counts the words inside any occurrence of a window; item_ids are the ids, as strings in order, of the items with one.
    A document is contaminated if it has hits and ``share`` * n_hit >= n_words. Null and empty texts have no words; items without
    words match nothing; items with the same text all count; items without an id count as one, with the id "". Rows equal in
    doc_id and text get the same result, rows that share only the id their own. No documents give no rows, no items no hits.
    """
    found = written(occurrences(docs, items, size), "occurrences")
    cover = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["at"] + x["len"] - F.greatest(x["at"], s["end"]))).alias("n"), F.greatest(s["end"], x["at"] + x["len"]).alias("end")))
    hits = found.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(F.struct("at", "len"))).alias("spans"))
    hits = hits.select(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key"), cover["n"].cast("long").alias("n_hit"))
    named = found.select("doc_id", "key", "window").distinct().join(windows(items, size).select("item_id", "window"), "window")
    named = named.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("item_ids"))
    named = named.select(F.col("doc_id").alias("named_id"), F.col("key").alias("named_key"), "item_ids")
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), F.size(contract_words(F.col("text"))).cast("long").alias("n_words"))
    rows = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left")
    rows = rows.join(named, F.col("doc_id").eqNullSafe(F.col("named_id")) & (F.col("key") == F.col("named_key")), "left")
    n_hit, ids = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.select(
        "doc_id", F.col("key").alias("text_key"), "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, size: int = 13, share: int = 20) -> DataFrame:
    """The documents that aren't contaminated."""
    dirty = decontaminate(docs, items, size, share).where("contaminated").select(F.col("doc_id").alias("dirty_id"), F.col("text_key").alias("dirty_key"))
    dirty = written(dirty.distinct(), "contaminated")
    return docs.join(small(dirty), docs["doc_id"].eqNullSafe(dirty["dirty_id"]) & (F.xxhash64(docs["text"]) == dirty["dirty_key"]), "left_anti")


def digests(result: DataFrame) -> DataFrame:
    return result.withColumn("items_sha256", F.sha2(F.array_join("item_ids", ","), 256)).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")

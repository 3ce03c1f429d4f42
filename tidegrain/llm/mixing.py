"""Mixing sources to target weights on a low-discrepancy schedule.

Each source's documents are put in a shuffled order (by digest of the id) and cut into blocks of ``block`` words. The points
x_i = i * golden ratio mod 1 run through the cumulative shares of the sources: slot i belongs to the source whose interval holds x_i, so
every stretch of the schedule comes near the weights. The r-th slot of a source takes its block r, beginning again after the last
one, until the source has given its target. Slots are ranked and documents placed by prefix sums over chunks, so the largest
source is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrain.llm.common import free_name, small, words_of, written

BLOCK = 4096
#: Slots that are ranked together, and hexadecimal digits of the shuffling digest that name a chunk of documents.
SLOT_CHUNK, CHUNK_DIGITS = 1 << 16, 4
#: Equal parts of [0, 1) by which points and intervals are matched.
CELLS = 4096
#: The golden ratio's fraction, and that of 2^20 times it.
GOLDEN = 0.6180339887498949
GOLDEN_20 = 0.607787409740351


def _long(x) -> Column:
    return F.lit(x).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, shuffle): the narrow rows everything else works on."""
    rows = docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"))
    size = F.col("size")
    return rows.select("doc_id", "source", "size", F.md5(F.encode(F.concat_ws(":", F.lit("mix"), F.col("doc_id").cast("string"), size.cast("string")), "UTF-8")).alias("shuffle"))


def targets(rows: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(sid, source, source_size, weight, target, quota) per source; quota is the target in whole words.

    Sources by code point, null last, take ``weights`` in turn. target = min(most * size, level * weight) where the level makes the
    targets add up to all words: what is left when excess over the limit is shared out again until no source is above.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("sid", F.row_number().over(rank) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*(_long(w) for w in weights)), F.col("sid") % len(weights) + 1))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "sid")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(everything)).withColumn("capped", F.coalesce(F.sum(F.col("source_size") * most).over(before), _long(0)))
    s = s.withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", F.max((F.col("total") - F.col("capped")) / F.col("open")).over(everything))
    target = F.least((F.col("source_size") * most).cast("double"), F.col("level") * F.col("weight"))
    return s.select("sid", "source", "source_size", "weight", target.alias("target"), F.least(F.floor(target + 0.5).cast("long"), F.col("source_size") * most).alias("quota"))


def placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with sid and ``first``, the document's first word in the shuffled order of its source."""
    rows = rows.join(small(sources.select("sid", F.col("source").alias("of"))), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("chunk", F.substring("shuffle", 1, CHUNK_DIGITS))
    sums = rows.groupBy("sid", "chunk").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    bases = sums.select("sid", "chunk", F.coalesce(before, _long(0)).alias("base"))
    inside = F.sum("size").over(Window.partitionBy("sid", "chunk").orderBy("shuffle", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("inside", inside).join(bases, ["sid", "chunk"]).withColumn("first", F.col("base") + F.col("inside") - F.col("size")).drop("inside", "base", "chunk", "shuffle")


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """(slot, sid, pass, block_no, words): which block each slot takes, and how many of its words."""
    spark = sources.sparkSession
    q = sources.where("quota > 0").withColumn("blocks", F.ceil(F.col("source_size") / block))
    q = q.withColumn("rest", F.col("quota") % F.col("source_size")).withColumn(
        "slots", F.floor(F.col("quota") / F.col("source_size")) * F.col("blocks") + F.ceil(F.col("rest") / block))
    order = Window.orderBy("sid")
    q = q.withColumn("to", F.sum("slots").over(order)).withColumn("from", F.col("to") - F.col("slots")).withColumn("all", F.max("to").over(Window.partitionBy()))
    q = written(q.select("sid", "source_size", "quota", "blocks", "rest", "slots", (F.col("from") / F.col("all")).alias("low"), (F.col("to") / F.col("all")).alias("high")), "mix-quotas")
    total = q.agg(F.sum("slots")).first()[0] or 0
    i = F.col("id") + 1
    x = (F.floor(i / (1 << 20)) * GOLDEN_20 % 1.0 + (i % (1 << 20)) * GOLDEN) % 1.0
    points = spark.range(total).select(F.col("id").alias("slot"), x.alias("x")).withColumn("cell", F.floor(F.col("x") * CELLS))
    intervals = q.select("sid", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), _long(CELLS - 1)))).alias("cell"))
    hit = points.join(small(written(intervals, "mix-intervals")), "cell").where("x >= low AND x < high").select("slot", "sid", F.floor(F.col("slot") / SLOT_CHUNK).alias("part"))
    hit = written(hit, "mix-slots")
    sums = hit.groupBy("sid", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sums.select("sid", "part", F.coalesce(before, _long(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("sid", "part").orderBy("slot")) - 1
    ranked = hit.withColumn("inside", inside).join(bases, ["sid", "part"]).select("slot", "sid", (F.col("base") + F.col("inside")).alias("r"))
    # A source that the points gave fewer slots than its quota (by the discrepancy, a few) takes the rest at the end.
    given = sums.groupBy("sid").agg(F.sum("n").alias("given")).withColumnRenamed("sid", "sid_given")
    short = q.join(given, F.col("sid") == F.col("sid_given"), "left").withColumn("given", F.coalesce("given", _long(0))).where("given < slots")
    tail = short.select("sid", "given", F.explode(F.sequence(F.col("given"), F.col("slots") - 1)).alias("r")).select((_long(total) + F.col("r") - F.col("given")).alias("slot"), "sid", "r")
    slots = ranked.unionByName(tail).join(small(q), "sid").where("r < slots")
    number = F.col("r") % F.col("blocks")
    left = F.when((F.col("rest") > 0) & (F.col("r") == F.col("slots") - 1), F.col("rest") - number * block).otherwise(_long(block))
    return slots.select("slot", "sid", F.floor(F.col("r") / F.col("blocks")).alias("pass"), number.alias("block_no"), left.alias("words"))


def mix(rows: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, pass, sid, doc_id, first, offset, words): the mixture in order of ``slot`` and ``first``.

    ``rows`` are placed rows and ``sources`` the targets, both written tables. A row takes ``words`` words of a document from its word
    ``offset`` on; a document that lies across blocks comes in several rows. Documents without words have none.
    """
    filled = rows.where("size > 0")
    cut = F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block)))
    pieces = filled.select("sid", "doc_id", "first", "size", cut.alias("block_no"))
    begin = F.greatest("first", F.col("block_no") * block)
    pieces = pieces.select(
        "sid", "doc_id", "first", "block_no", (begin - F.col("first")).alias("offset"), (begin - F.col("block_no") * block).alias("at"),
        (F.least(F.col("first") + F.col("size"), (F.col("block_no") + 1) * block) - begin).alias("length"))
    taken = F.least("length", F.col("words") - F.col("at"))
    return pieces.join(schedule(sources, block), ["sid", "block_no"]).withColumn("words", taken).where("words > 0").select("slot", "pass", "sid", "doc_id", "first", "offset", "words")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Placed rows, targets and mixture of the documents, the first two as written tables."""
    rows = written(sized(docs), "mix-rows")
    sources = written(targets(rows, weights, most), "mix-targets")
    rows = written(placed(rows, sources), "mix-placed")
    return rows, sources, mix(rows, sources, block)


def shares(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per document; taken counts its words in the mixture, repeats included.

    A source gives its target to the word. Null text has size 0 and is never taken; a null source is a source of its own. Rows
    that share a doc_id are documents of their own. Other columns are not read. The order depends on ids and sizes only, so reruns agree.
    """
    rows, sources, mixture = mixed(docs, weights, most, block)
    taken = mixture.groupBy("sid", "first").agg(F.sum("words").alias("taken"))
    filled = rows.where("size > 0").join(taken, ["sid", "first"], "left").select("sid", "doc_id", "size", F.coalesce("taken", _long(0)).alias("taken"))
    everything = filled.unionByName(rows.where("size = 0").select("sid", "doc_id", "size", _long(0).alias("taken")))
    return everything.join(small(sources), "sid").select("doc_id", "size", "source_size", "target", "taken")


def draw(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, block: int = BLOCK) -> DataFrame:
    """The documents as the mixture repeats or leaves them: a document comes once for every time its first word is taken.

    Columns are those of ``docs``. Documents without words are left out, as no block holds them.
    """
    rows, _, mixture = mixed(docs, weights, most, block)
    copies = mixture.where("offset = 0").groupBy("sid", "first").agg(F.count("*").alias("copies"))
    lots = rows.where("size > 0").join(copies, ["sid", "first"], "left")
    lots = written(lots.select(F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.col("size").alias("mix_size"), "first", F.coalesce("copies", _long(0)).alias("copies")), "mix-copies")
    key = ["mix_id", "mix_source", "mix_size"]
    words, time, number = (free_name(n, [*docs.columns, *lots.columns]) for n in ("mix_words", "mix_time", "mix_no"))
    # the names of the lots are chosen apart from those of the documents
    lots = lots.select(*(F.col(c).alias(free_name(c, docs.columns)) for c in lots.columns))
    key, first, copies = [free_name(c, docs.columns) for c in key], free_name("first", docs.columns), free_name("copies", docs.columns)
    marked = docs.withColumn(words, F.size(words_of(F.col("text"))).cast("long")).where(F.col(words) > 0)

    def same(other: DataFrame) -> Column:
        return F.col("doc_id").eqNullSafe(other[key[0]]) & F.col("source").eqNullSafe(other[key[1]]) & (F.col(words) == other[key[2]])

    def repeated(found: DataFrame) -> DataFrame:
        return found.where(F.col(copies) > 0).withColumn(time, F.explode(F.sequence(_long(1), F.col(copies)))).select(*(docs[c] for c in docs.columns))

    shared = written(lots.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), "mix-shared")
    if shared.isEmpty():
        return repeated(marked.join(lots, same(lots)))
    # Rows that agree in id, source and size are told apart by their order.
    alone = marked.join(shared, same(shared), "left_anti")
    again = marked.join(shared, same(shared), "left_semi").withColumn(number, F.row_number().over(Window.partitionBy("doc_id", "source", words).orderBy("text")))
    place = free_name("mix_place", docs.columns)
    numbered = lots.withColumn(place, F.row_number().over(Window.partitionBy(*key).orderBy(first)))
    single = numbered.where(F.col(place) == 1)
    return repeated(alone.join(single, same(single))).unionByName(repeated(again.join(numbered, same(numbered) & (F.col(number) == F.col(place)))))

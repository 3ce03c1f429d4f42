"""Join-shaped operators that are more than one call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrain.session import shared_dir


def divide(df: DataFrame, key: str, item: str, universe: DataFrame, **stats: Column) -> DataFrame:
    """Keys related to **every** item of ``universe`` (relational division), with aggregates over all rows of a key.

    ``df`` holds (key, item) pairs; repeated ones count once, and are combined in the map tasks. ``stats`` come from the same pass.
    With an empty universe every key of ``df`` qualifies.
    """
    wanted = universe.select(item).where(F.col(item).isNotNull()).distinct()
    size = wanted.agg(F.count(F.lit(1))).scalar()
    marked = df.join(wanted.withColumn("_hit", F.lit(True)), item, "left")
    hits = marked.groupBy(key).agg(F.count_distinct(F.when(F.col("_hit"), F.col(item))).alias("_n"), *[e.alias(n) for n, e in stats.items()])
    return hits.where(F.col("_n") == size).drop("_n")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows without a dimension row."""
    return fact.join(dim.select(key), key, "left_anti")


def _ancestors(df: DataFrame, child: str, parent: str) -> DataFrame:
    return df.select(F.col(child).alias("_c"), F.col(parent).alias("_p")).where(F.col("_p").isNotNull())


def _doubled(up: DataFrame, distance: int, nodes: int) -> DataFrame:
    """Ancestors at twice the distance; ancestors further away than there are nodes mean a cycle."""
    if distance > nodes and not up.isEmpty():
        raise ValueError("the hierarchy has a cycle")
    far = up.select(F.col("_c").alias("_p"), F.col("_p").alias("_q"))
    return up.join(far, "_p").select("_c", F.col("_q").alias("_p")).checkpoint()


def closure(df: DataFrame, child: str, parent: str) -> DataFrame:
    """(ancestor, descendant, level) pairs of a tree, each node being its own ancestor at level 0.

    The levels reached double with every round, so a chain of n nodes takes log2(n) of them. A cycle is an error.
    """
    shared_dir(df.sparkSession)
    out = df.select(F.col(child).alias("ancestor"), F.col(child).alias("descendant"), F.lit(0).cast("bigint").alias("level")).checkpoint()
    up, distance, nodes = _ancestors(df, child, parent).checkpoint(), 1, out.count()
    while not up.isEmpty():
        higher = out.join(up, F.col("ancestor") == F.col("_c")).select(F.col("_p").alias("ancestor"), "descendant", (F.col("level") + distance).alias("level"))
        out = out.unionByName(higher).checkpoint()
        up, distance = _doubled(up, distance, nodes), 2 * distance
    return out


def roll_up(df: DataFrame, child: str, parent: str, value: str) -> DataFrame:
    """(node, members, depth, total) of every subtree: nodes below, levels below, and the sum of ``value`` with the node's own.

    One row per node at all times: with the totals over the next d levels known, those over 2d levels add the totals of the descendants
    exactly d levels below. A cycle is an error; a parent that is no node is dropped.
    """
    shared_dir(df.sparkSession)
    zero = F.lit(0).cast("bigint")
    out = df.select(F.col(child).alias("node"), zero.alias("members"), zero.alias("depth"), F.col(value).alias("total")).checkpoint()
    kind = out.schema["total"].dataType
    up, distance, nodes = _ancestors(df, child, parent).checkpoint(), 1, out.count()
    while not up.isEmpty():
        below = out.join(up, F.col("node") == F.col("_c")).groupBy("_p").agg(
            F.sum(F.col("members") + 1).alias("_m"), (F.max("depth") + distance).alias("_d"), F.sum("total").alias("_t"))
        # a node exactly ``distance`` below counts itself and what is known below it
        out = out.join(below, F.col("node") == F.col("_p"), "left").select(
            "node", (F.col("members") + F.coalesce("_m", zero)).alias("members"), F.greatest("depth", F.coalesce("_d", zero)).alias("depth"),
            F.when(F.col("_t").isNull(), F.col("total")).otherwise(F.coalesce("total", F.lit(0)) + F.col("_t")).cast(kind).alias("total")).checkpoint()
        up, distance = _doubled(up, distance, nodes), 2 * distance
    return out


def asof_lookup(times: DataFrame, events: DataFrame, t: str, event_t: str, payload: Sequence[str], block: str = "day") -> DataFrame:
    """For each distinct time of ``times``: the latest row of ``events`` at or before it.

    Both sides are cut into calendar blocks; inside a block a forward fill finds the row, and the last row
    of earlier blocks is carried over. Only block summaries are ordered globally.
    ``events`` must have one row per ``event_t``.
    """
    pack = F.struct(F.col(event_t).alias("_et"), *[F.col(p) for p in payload])
    left = times.select(F.col(t).alias("_t")).where(F.col("_t").isNotNull()).distinct()
    right = events.where(F.col(event_t).isNotNull()).select(F.col(event_t).alias("_t"), pack.alias("_ev"))
    both = left.withColumn("_ev", F.lit(None).cast(right.schema["_ev"].dataType)).withColumn("_side", F.lit(1)).unionByName(
        right.withColumn("_side", F.lit(0))
    ).withColumn("_block", F.date_trunc(block, "_t"))
    w = W.partitionBy("_block").orderBy("_t", "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = both.withColumn("_here", F.last("_ev", ignorenulls=True).over(w)).where("_side = 1")
    blocks = both.groupBy("_block").agg(F.max_by("_ev", F.when(F.col("_ev").isNotNull(), F.col("_t"))).alias("_last"))
    carry = blocks.select(
        "_block",
        F.last("_last", ignorenulls=True).over(W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
    )
    found = filled.join(carry, "_block").withColumn("_hit", F.coalesce("_here", "_before"))
    return found.select(F.col("_t").alias(t), *[F.col(f"_hit.{p}").alias(p) for p in payload])


def reconcile(system: DataFrame, physical: DataFrame, key: str, qty: str) -> DataFrame:
    """Compare two stock lists: missing, unregistered, surplus, shortage or equal per key."""
    a = system.select(key, "category", F.col(qty).alias("system_qty"))
    b = physical.select(key, F.col(qty).alias("physical_qty"))
    diff = F.col("physical_qty") - F.col("system_qty")
    state = (
        F.when(F.col("physical_qty").isNull(), "MISSING")
        .when(F.col("system_qty").isNull(), "UNREGISTERED")
        .when(diff > 0, "EXCESO")
        .when(diff < 0, "FALTA")
        .otherwise("OK")
    )
    critical = F.col("physical_qty").isNull() & (F.col("category") == "A")
    return a.join(b, key, "full_outer").select(
        key, "category", "system_qty", "physical_qty", diff.alias("difference"), state.alias("state"),
        critical.cast("int").cast("bigint").alias("critical"),
    )


def basket_pair_counts(df: DataFrame, basket: str, item: str, at_least: int = 2, block: int = 256) -> DataFrame:
    """(item_a, item_b, together): pairs of items found together in ``at_least`` baskets or more.

    Items in fewer baskets can't be in such a pair and go first. The items of a basket are dealt to blocks of about ``block`` and every
    two blocks meet in a task of their own, so a basket of any size is spread; the pairs themselves are counted map-side first.
    """
    shared_dir(df.sparkSession)
    rows = df.select(F.col(basket).alias("_b"), F.col(item).alias("_i")).where(F.col(basket).isNotNull() & F.col(item).isNotNull()).distinct()
    often = rows.groupBy("_i").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= at_least).select("_i")
    rows = rows.join(often, "_i").checkpoint()
    sizes = rows.groupBy("_b").agg(F.ceil(F.count(F.lit(1)) / block).cast("bigint").alias("_blocks"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    own = rows.join(sizes, "_b").withColumn("_g", F.pmod(F.xxhash64("_i"), "_blocks"))
    cells = own.select("_b", "_i", "_g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)).alias("_o")).select(
        "_b", "_i", "_g", F.least("_g", "_o").alias("_x"), F.greatest("_g", "_o").alias("_y"))
    a, b = cells.alias("a"), cells.alias("b")
    meet = (F.col("a._b") == F.col("b._b")) & (F.col("a._x") == F.col("b._x")) & (F.col("a._y") == F.col("b._y")) & (F.col("a._i") < F.col("b._i"))
    here = (F.least("a._g", "b._g") == F.col("a._x")) & (F.greatest("a._g", "b._g") == F.col("a._y"))
    pairs = a.join(b, meet & here).groupBy(F.col("a._i").alias("item_a"), F.col("b._i").alias("item_b")).agg(F.count(F.lit(1)).alias("together"))
    return pairs.where(F.col("together") >= at_least)


def both_ways(df: DataFrame, a: str, b: str, origin: str, other: str) -> DataFrame:
    """Each pair in both directions in one pass (no second scan of the pair table)."""
    rest = [c for c in df.columns if c not in (a, b)]
    way = F.array(
        F.struct(F.col(a).alias("o"), F.col(b).alias("x")), F.struct(F.col(b).alias("o"), F.col(a).alias("x"))
    )
    return df.select(*rest, F.explode(way).alias("_w")).select(F.col("_w.o").alias(origin), F.col("_w.x").alias(other), *rest)


def best_companion(df: DataFrame, basket: str, item: str, at_least: int = 2, block: int = 256) -> DataFrame:
    """Item most often in the same basket (lowest id on a tie), for items with a partner seen ``at_least`` times."""
    both = both_ways(basket_pair_counts(df, basket, item, at_least, block), "item_a", "item_b", "origin", "companion")
    w = W.partitionBy("origin").orderBy(F.col("together").desc(), F.col("companion").asc())
    return both.select("origin", "companion", "together").withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def not_in(df: DataFrame, key: str, values: DataFrame, value: str) -> DataFrame:
    """``key NOT IN (SELECT value ...)`` with SQL's NULL rules, as a shuffled anti-join.

    Spark's own plan for ``NOT IN`` broadcasts the list, which may not fit; here the two NULL rules
    are scalars: a NULL in the list empties the result, and a NULL key survives only an empty list.
    """
    facts = values.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(value).isNull(), 1)).alias("nulls")).alias("f"))
    n, nulls = facts.select("f.n").scalar(), facts.select("f.nulls").scalar()
    listed = values.where(F.col(value).isNotNull()).select(F.col(value).alias(key))
    kept = df.join(listed, key, "left_anti")
    return kept.where((nulls == 0) & (F.col(key).isNotNull() | (n == 0)))

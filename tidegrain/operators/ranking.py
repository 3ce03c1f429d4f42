"""Ordering operators that stay distributed when one key, or the whole table, is a single group."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrain.session import shared_dir


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows of each key.

    The rank filter is pushed below the shuffle (window group limit), so a map task sends at most
    ``n`` rows per key whatever the size of the group. ``order`` must end in a unique column.
    """
    name = rank_col or "_rank"
    w = W.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out.withColumn(name, F.col(name).cast("bigint")) if rank_col else out.drop(name)


def keep_top_ranked(df: DataFrame, c: str, k: int, rank_col: str) -> DataFrame:
    """Rows whose ``RANK() OVER (ORDER BY c DESC) <= k``, ties kept.

    All values ranked up to k are among the k largest rows, so the ranks are found on those k rows alone and joined to the table
    by value: however many rows tie, they stay where they are. Nulls have no rank.
    """
    top = df.select(F.col(c).alias("_top")).where(F.col(c).isNotNull()).orderBy(F.desc("_top")).limit(k)
    ranks = top.select("_top", F.rank().over(W.orderBy(F.desc("_top"))).cast("bigint").alias(rank_col)).distinct()
    return df.join(F.broadcast(ranks), F.col(c) == F.col("_top")).drop("_top")  # at most k rows


def top_of_group(df: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """Rows equal to the maximum of their group, ties kept, in one pass.

    ``RANK() = 1`` is pushed below the shuffle: a map task sends only its own best rows of each group.
    """
    w = W.partitionBy(*keys).orderBy(F.col(c).desc())
    return df.withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank")


def dense_top(df: DataFrame, keys: Sequence[str], c: str, k: int, rank_col: str) -> DataFrame:
    """``DENSE_RANK() <= k`` inside each group: ranks are computed on distinct values, not on rows."""
    values = df.select(*keys, c).distinct()
    w = W.partitionBy(*keys).orderBy(F.col(c).desc())
    ranks = values.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
    return df.join(ranks.withColumn(rank_col, F.col(rank_col).cast("bigint")), [*keys, c])


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and of a size Catalyst knows when it plans a join."""
    path = f"{shared_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_group_stats(df: DataFrame, keys: Sequence[str], stage: bool = False, **stats: Column) -> DataFrame:
    """Group statistics beside the detail rows.

    Partial aggregation plus a null-safe equi-join instead of a window: a hot group is pre-aggregated
    in the map tasks, and the detail side is never gathered in one task. With ``stage``, meant for keys of few values, the statistics
    are written first: under the broadcast threshold the detail rows are not shuffled at all, over it adaptive skew splitting holds.
    """
    renamed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    small = df.groupBy(*renamed).agg(*[e.alias(n) for n, e in stats.items()])
    small = staged(small) if stage else small
    cond = None
    for i, k in enumerate(keys):
        part = df[k].eqNullSafe(small[f"_k{i}"])
        cond = part if cond is None else cond & part
    return df.join(small, cond, "inner").drop(*[f"_k{i}" for i in range(len(keys))])


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_no") -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY ...)`` without a one-task window.

    A range-partitioned sort numbers rows inside each partition; the partition sizes give the offsets.
    The sorted rows are checkpointed once so that both passes see the same partitions, also after a
    lost executor. The offset table has one row per partition.
    """
    shared_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()).checkpoint()
    part, local = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + local + 1)
        .drop("_part", "_before", "_mid")
    )


def global_ntile(df: DataFrame, n: int, order: Sequence[Column], name: str) -> DataFrame:
    """Exact ``NTILE(n)`` over the whole table: the first ``rows mod n`` tiles get one row more."""
    ranked = global_row_number(df, order, "_rn")
    total = ranked.agg(F.max("_rn").alias("t")).scalar()  # of the checkpointed rows, not of the input again
    size, extra = F.expr(f"_total div {n}"), F.col("_total") % n
    cut = extra * (size + 1)
    in_large = F.floor((F.col("_rn") - 1) / (size + 1)) + 1
    in_small = extra + F.floor((F.col("_rn") - 1 - cut) / F.greatest(size, F.lit(1))) + 1
    return (
        ranked.withColumn("_total", total)
        .withColumn(name, F.when(F.col("_rn") <= cut, in_large).otherwise(in_small).cast("bigint"))
        .drop("_rn", "_total")
    )


def with_ntile(df: DataFrame, n: int, rising: Sequence[Column], name: str) -> DataFrame:
    """``NTILE(n) OVER (ORDER BY rising)`` without moving the rows: each is compared with the keys that begin the tiles.

    ``rising`` are expressions in ascending order, nulls first, that together are unique. Only they are sorted and numbered; the n - 1
    keys at the starts of tiles 2 to n are the only rows that come back, as one array. ``df`` is read twice, so give it written or cheap.
    """
    keys = df.select(*[e.alias(f"_o{i}") for i, e in enumerate(rising)])
    names = keys.columns
    ranked = global_row_number(keys, [F.col(c).asc_nulls_first() for c in names], "_rn")
    total = ranked.agg(F.max("_rn").alias("t")).scalar()
    sized = ranked.withColumn("_total", total)
    starts = [F.expr(f"{i} * (_total div {n}) + least({i}, _total % {n}) + 1") for i in range(1, n)]
    cuts = sized.where(F.col("_rn").isin(*starts)).agg(F.collect_list(F.struct(*names)).alias("cuts")).scalar()
    key = F.struct(*[e.alias(c) for e, c in zip(rising, names)])
    passed = F.size(F.filter(F.col("_cuts"), lambda cut: cut <= F.col("_key")))
    return df.withColumns({"_cuts": cuts, "_key": key}).withColumn(name, (passed + 1).cast("bigint")).drop("_cuts", "_key")


def running_total(df: DataFrame, keys: Sequence[str], block: Column, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Running sum per key with the rows of a key split into ordered blocks (for example days).

    Block totals are pre-aggregated, their prefix sums carried into the blocks, and the row-level window
    sees only one block, so a key holding much of the table is spread over many tasks.
    ``block`` must be monotone in ``order``.
    """
    rows = df.withColumn("_block", block)
    totals = rows.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    w = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(*keys, "_block", F.sum("_sum").over(w).alias("_carry"))
    inner = W.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        rows.join(carried, [*keys, "_block"])
        .withColumn(name, F.coalesce("_carry", F.lit(0)) + F.sum(value).over(inner))
        .drop("_block", "_carry")
    )


def longest_islands(df: DataFrame, keys: Sequence[str], month: str) -> DataFrame:
    """Longest run of consecutive months per key, earliest run on a tie.

    ``df`` holds one row per key and month, so a group is bounded by the number of months.
    """
    rn = F.row_number().over(W.partitionBy(*keys).orderBy(month))
    runs = (
        df.withColumn("_island", F.add_months(F.col(month), -rn))
        .groupBy(*keys, "_island")
        .agg(
            F.min(month).alias("run_start"),
            F.max(month).alias("run_end"),
            F.count(F.lit(1)).alias("run_months"),
        )
    )
    return first_per_key(runs, keys, [F.col("run_months").desc(), F.col("run_start").asc()]).drop("_island")

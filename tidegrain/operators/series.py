"""Time-series operators on keyed series: hourly grid, interpolation, forward fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """Newest row per key: window group limit keeps one row per key and map task."""
    w = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def interpolate_positions(df: DataFrame, keys: Sequence[str], t: str, c: str, block: Column | None = None) -> DataFrame:
    """Linear fill by row position between known values; the ends take the nearest known value.

    ``df`` has one row per key and time. A series is cut into blocks (``block``, monotone in ``t``, for example the day): windows over
    rows see one block, the positions and the known values around it are carried over from the block summaries.
    """
    rows = df.withColumn("_block", F.lit(0) if block is None else block)
    inner = W.partitionBy(*keys, "_block").orderBy(t)
    rows = rows.withColumn("_in", F.row_number().over(inner).cast("bigint"))
    point = F.when(F.col(c).isNotNull(), F.struct(F.col("_in").alias("p"), F.col(c).alias("v")))
    names = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    series = [f"_k{i}" for i in range(len(keys))]
    sums = rows.groupBy(*names, F.col("_block").alias("_of")).agg(F.count(F.lit(1)).alias("_n"), F.min(point).alias("_first"), F.max(point).alias("_last"))
    order = W.partitionBy(*series).orderBy("_of")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(1, W.unboundedFollowing)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint")))

    def moved(x: Column) -> Column:
        return F.when(x.isNotNull(), F.struct((x["p"] + F.col("_base")).alias("p"), x["v"].alias("v")))

    sums = sums.withColumns({"_first": moved(F.col("_first")), "_last": moved(F.col("_last"))}).withColumns({
        "_from": F.last("_last", ignorenulls=True).over(before), "_to": F.first("_first", ignorenulls=True).over(after)}).drop("_n", "_first", "_last")
    same = F.col("_block").eqNullSafe(F.col("_of"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rows = rows.join(sums, same).drop("_of", *series).withColumn("_known", moved(point))
    rows = rows.withColumns({
        "_a": F.coalesce(F.last("_known", ignorenulls=True).over(inner.rowsBetween(W.unboundedPreceding, 0)), "_from"),
        "_b": F.coalesce(F.first("_known", ignorenulls=True).over(inner.rowsBetween(0, W.unboundedFollowing)), "_to")})
    share = (F.col("_base") + F.col("_in") - F.col("_a.p")) / (F.col("_b.p") - F.col("_a.p"))
    line = F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * share
    filled = (
        F.when(F.col(c).isNotNull(), F.col(c))
        .when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), line)
        .otherwise(F.coalesce(F.col("_a.v"), F.col("_b.v")))
    )
    return rows.withColumn(c, filled).drop("_block", "_in", "_base", "_from", "_to", "_known", "_a", "_b")


def hourly_grid(df: DataFrame, keys: Sequence[str], t: str, numbers: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Regular hourly series per key from known points at full hours.

    Each known point is expanded over the hours up to the next one (``lead`` + ``sequence``), so the windows
    run on the points and no grid has to be joined. Numbers are interpolated over time between the nearest
    known values of the column (carried forward after the last one, NULL before the first one); labels are
    carried forward. The series spans the key's own first to last time.
    """
    base = W.partitionBy(*keys).orderBy(t)
    upto = base.rowsBetween(W.unboundedPreceding, 0)
    after = base.rowsBetween(1, W.unboundedFollowing)
    known = {
        f"_k_{c}": F.when(F.col(c).isNotNull(), F.struct(F.col(t).alias("t"), F.col(c).cast("double").alias("v"))) for c in numbers
    }
    # all window columns in one projection: one sort and one window operator
    windows = {"_next": F.lead(t).over(base)}
    for c in numbers:
        windows[f"_{c}_a"] = F.last(f"_k_{c}", ignorenulls=True).over(upto)
        windows[f"_{c}_b"] = F.first(f"_k_{c}", ignorenulls=True).over(after)
    windows.update({f"_l_{c}": F.last(c, ignorenulls=True).over(upto) for c in labels})
    out = df.withColumns(known).withColumns(windows)
    last = F.coalesce(F.col("_next") - F.expr("INTERVAL 1 HOUR"), F.col(t))
    out = out.withColumn("_slot", F.explode(F.sequence(F.col(t), last, F.expr("INTERVAL 1 HOUR"))))
    cols = [F.col(k) for k in keys] + [F.col("_slot").alias(t)]
    for c in numbers:
        cols.append(_line(F.col(f"_{c}_a"), F.col(f"_{c}_b"), F.col("_slot")).alias(c))
    cols += [F.col(f"_l_{c}").alias(c) for c in labels]
    return out.select(*cols, *[c for c in df.columns if c not in {*keys, t, *numbers, *labels}])


def to_full_hours(df: DataFrame, keys: Sequence[str], t: str, numbers: Sequence[str], labels: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """Points at any minute as one point per key and full hour, for ``hourly_grid``.

    Points of an hour collide: numbers take the mean of the known ones (summed as decimals, so in any order the same), labels the last
    known one by time, and by ``newest`` on a tie. Partial aggregation, so a series of many points is not gathered in one task.
    """
    order = F.struct(t, *newest)
    slot = F.date_trunc("hour", t).cast(df.schema[t].dataType)
    means = [(F.sum(F.col(c).cast("decimal(28,6)")).cast("double") / F.nullif(F.count(c), F.lit(0))).alias(c) for c in numbers]
    lasts = [F.max(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v"))))["v"].alias(c) for c in labels]
    return df.groupBy(*keys, slot.alias("_slot")).agg(*means, *lasts).withColumnRenamed("_slot", t)


def hourly_blocks(df: DataFrame, keys: Sequence[str], t: str, numbers: Sequence[str], labels: Sequence[str], block: Column) -> DataFrame:
    """``hourly_grid`` of long series: windows see one block of a series (for example a day), and the known values around it are carried over.

    ``df`` has one row per key and full hour; ``block`` is monotone in ``t``. A block's points get the last known point of each column before
    it, the first one behind it and the next point's time from summaries of one row per block, as documents of a series do not end its values.
    """
    rows = df.withColumn("_block", block)

    def point(c: str) -> Column:
        v = F.col(c).cast("double") if c in numbers else F.col(c)
        return F.when(F.col(c).isNotNull(), F.struct(F.col(t).alias("t"), v.alias("v")))

    ends = [a for c in (*numbers, *labels) for a in (F.max(point(c)).alias(f"_{c}_last"), F.min(point(c)).alias(f"_{c}_first"))]
    sums = rows.groupBy(*keys, "_block").agg(F.min(t).alias("_start"), *ends)
    order = W.partitionBy(*keys).orderBy("_block")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(1, W.unboundedFollowing)
    around = {"_following": F.lead("_start").over(order)}
    for c in (*numbers, *labels):
        around[f"_{c}_from"] = F.last(f"_{c}_last", ignorenulls=True).over(before)
        around[f"_{c}_to"] = F.first(f"_{c}_first", ignorenulls=True).over(after)
    sums = sums.withColumns(around).select(*keys, "_block", *around)
    inner = W.partitionBy(*keys, "_block").orderBy(t)
    upto, behind = inner.rowsBetween(W.unboundedPreceding, 0), inner.rowsBetween(1, W.unboundedFollowing)
    rows = rows.join(sums, [*keys, "_block"])
    found = {"_next": F.coalesce(F.lead(t).over(inner), "_following")}
    for c in (*numbers, *labels):
        found[f"_{c}_a"] = F.coalesce(F.last(point(c), ignorenulls=True).over(upto), f"_{c}_from")
        found[f"_{c}_b"] = F.coalesce(F.first(point(c), ignorenulls=True).over(behind), f"_{c}_to")
    rows = rows.withColumns(found)
    last = F.coalesce(F.col("_next") - F.expr("INTERVAL 1 HOUR"), F.col(t))
    rows = rows.withColumn("_slot", F.explode(F.sequence(F.col(t), last, F.expr("INTERVAL 1 HOUR"))))
    filled = [_line(F.col(f"_{c}_a"), F.col(f"_{c}_b"), F.col("_slot")).alias(c) for c in numbers]
    return rows.select(*keys, F.col("_slot").alias(t), *filled, *[F.col(f"_{c}_a.v").alias(c) for c in labels])


def _line(a: Column, b: Column, slot: Column) -> Column:
    def hours(x: Column) -> Column:
        return F.unix_timestamp(x.cast("timestamp")) / F.lit(3600.0)

    share = (hours(slot) - hours(a["t"])) / (hours(b["t"]) - hours(a["t"]))
    return F.when(b.isNull(), a["v"]).otherwise(a["v"] + (b["v"] - a["v"]) * share)


def forward_fill(df: DataFrame, keys: Sequence[str], t: str, cols: Sequence[str]) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(t).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})

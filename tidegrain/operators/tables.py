"""Table changes as new versions: upsert, partial upsert, history, normalising loads, deletes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrain.operators.ranking import first_per_key, global_row_number


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """Replace rows of ``target`` by rows of ``source`` with the same key, add the new ones.

    A key that appears twice in the source keeps its newest row (by ``newest``).
    Running it again with the same source gives the same table.
    """
    if newest:
        source = first_per_key(source, keys, [F.col(c).desc_nulls_last() for c in newest])
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def upsert_columns(target: DataFrame, source: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Update only ``cols`` of existing keys; unknown keys are inserted whole."""
    s = source.select(key, *[F.col(c).alias(f"_s_{c}") for c in target.columns if c != key], F.lit(True).alias("_in_s"))
    t = target.withColumn("_in_t", F.lit(True))
    joined = t.join(s, key, "full_outer")
    out = []
    for c in target.columns:
        if c == key:
            out.append(F.col(key))
        elif c in cols:
            out.append(F.when(F.col("_in_s"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("_in_t"), F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c))
    return joined.select(*out)


def update_first(df: DataFrame, pred: Column, order: Sequence[str], changes: Mapping[str, Column]) -> DataFrame:
    """Change only the first row (by a unique ``order``) that satisfies ``pred``."""
    first = df.where(pred).agg(F.min(F.struct(*order))).scalar()
    hit = F.coalesce(pred & (F.struct(*order) == first), F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in changes.items()})


def delete_in(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """Delete by list; rows with NULL stay."""
    return df.where(~F.coalesce(F.col(c).isin(*values), F.lit(False)))


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    return df.where(~F.coalesce(pred, F.lit(False)))


def retain(df: DataFrame, t: str, days: int, today: str) -> DataFrame:
    """Keep the last ``days`` days before ``today``."""
    return df.where(F.col(t) >= F.date_sub(F.lit(today).cast("date"), days).cast("timestamp_ntz"))


def with_surrogate(df: DataFrame, keys: Sequence[str], name: str, sequence: bool = False) -> DataFrame:
    """Surrogate key: digest of the natural key (no sort, stable over loads), or a dense sequence."""
    if sequence:
        return global_row_number(df, [F.col(k) for k in keys], name)
    return df.withColumn(name, F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys])))


def normalise(df: DataFrame, c: str, id_name: str, value_name: str, first_seen: Sequence[Column]) -> DataFrame:
    """Dimension of the distinct values of ``c`` with ids in order of first appearance."""
    seen = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(value_name)).agg(F.min(F.struct(*first_seen)).alias("_seen"))
    return global_row_number(seen, [F.col("_seen")], id_name).drop("_seen")


def scd1(source: DataFrame, key: str, newest: Sequence[str]) -> DataFrame:
    """Dimension that keeps the current state only (full rebuild)."""
    return first_per_key(source, [key], [F.col(c).desc_nulls_last() for c in newest])


def scd2(dim: DataFrame, source: DataFrame, key: str, tracked: Sequence[str], now: str) -> DataFrame:
    """History dimension: close changed versions at ``now``, open new ones, keep the rest.

    ``dim`` has ``key``, tracked columns, ``valid_from``, ``valid_to``, ``is_current``.
    """
    at = F.lit(now).cast("timestamp")
    closed = dim.where("is_current = 0")
    cur = dim.where("is_current = 1").withColumn("_mark", _mark(tracked))
    src = source.select(key, *tracked).withColumn("_mark_s", _mark(tracked))
    marks = src.select(F.col(key), "_mark_s")
    matched = cur.join(marks, key, "left")
    changed = F.col("_mark_s").isNotNull() & (F.col("_mark") != F.col("_mark_s"))
    current = matched.select(
        key, *tracked, "valid_from",
        F.when(changed, at).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(changed, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("is_current"),
    )
    opened = (
        src.join(cur.select(key, "_mark"), key, "left")
        .where(F.col("_mark").isNull() | (F.col("_mark") != F.col("_mark_s")))
        .select(key, *tracked, at.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"),
                F.lit(1).cast("bigint").alias("is_current"))
    )
    return closed.select(*current.columns).unionByName(current).unionByName(opened)


def _mark(cols: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def validate_insert(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Checked insert of (raw_id, raw_name, raw_email): the first valid row of an id wins.

    Adds ``verdict``: ``ACCEPTED`` or the reason of the rejection.
    """
    shaped = df.select(
        *df.columns,
        F.col("raw_id").try_cast("bigint").alias("customer_id"),
        F.initcap(F.trim("raw_name")).alias("name"),
        F.lower(F.trim("raw_email")).alias("email"),
    )
    fault = (
        F.when(F.col("customer_id").isNull(), "BAD_ID")
        .when(F.coalesce(F.col("name"), F.lit("")) == "", "EMPTY_NAME")
        .when(~F.coalesce(F.col("email").contains("@"), F.lit(False)), "BAD_EMAIL")
    )
    shaped = shaped.withColumn("_fault", fault)
    winners = (
        shaped.where("_fault IS NULL").groupBy("customer_id").agg(F.min(F.struct(*order)).alias("_first"))
    )
    joined = shaped.join(winners, "customer_id", "left")
    verdict = F.when(F.col("_fault").isNotNull(), F.col("_fault")).when(
        F.struct(*order) == F.col("_first"), "ACCEPTED"
    ).otherwise("DUPLICATE_ID")
    return joined.withColumn("verdict", verdict).drop("_fault", "_first")

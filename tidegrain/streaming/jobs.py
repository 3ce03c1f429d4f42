"""Structured Streaming versions of the incremental parts.

Every job reads files with ``availableNow`` (each file once, then stop), keeps its progress in a checkpoint
and writes to a table in the shared folder. State that grows with the data lives in those tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.operators.ranking import first_per_key
from tidegrain.operators.tables import upsert
from tidegrain.session import shared_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """Fresh folder of one run in the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stream_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Stored table as a file stream; zone-less times become timestamps so that watermarks are allowed."""
    schema = spark.read.parquet(f"{root}/{name}.parquet").schema
    df = spark.readStream.schema(schema).parquet(f"{root}/{name}.parque[t]")
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"})


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Stored Parquet rows, or none where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored_events(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Stored table with zone-less times as timestamps."""
    rows = spark.read.parquet(f"{root}/{name}.parquet")
    return rows.withColumns({f.name: F.col(f.name).cast("timestamp") for f in rows.schema if f.dataType.typeName() == "timestamp_ntz"})


def shuffled_stream(spark: SparkSession, root: str, name: str, key: str, batches: int, work: str) -> DataFrame:
    """Stored table landed in some ``batches`` groups of files by a hash of ``key`` and read a group a batch, so times arrive out of order.

    A group is spread over as many files as a shuffle has partitions, so that no batch hangs on a few tasks.
    """
    rows = stored_events(spark, root, name)
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = rows.withColumn("batch", F.pmod(F.xxhash64(key), F.lit(batches))).withColumn("_salt", F.pmod(F.xxhash64(key, F.lit("salt")), F.lit(spread)))
    marked.repartition(batches * spread, "batch", "_salt").drop("_salt").write.partitionBy("batch").parquet(f"{work}/in")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", spread).parquet(f"{work}/in/batch=*")


def run_deliveries(deliveries: Sequence[DataFrame], out: str, step: Callable[[DataFrame, int], None]) -> None:
    """Land one delivery after the other and run the stream over what is new: a run, and so a batch, for each that has rows."""
    for i, rows in enumerate(deliveries):
        rows.write.mode("overwrite").parquet(f"{out}/in/delivery={i}")
        run_batches(rows.sparkSession.readStream.schema(rows.schema).parquet(f"{out}/in/delivery=*"), out, step)


def stream_landing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """New landing documents, each file once; text that does not parse goes to ``_corrupt``."""
    return spark.readStream.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def run_append(df: DataFrame, out: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Run to the end of the input and return the written table."""
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{out}/_progress")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(f"{out}/data").awaitTermination()
    return df.sparkSession.read.parquet(f"{out}/data")


def run_batches(df: DataFrame, out: str, step: Callable[[DataFrame, int], None]) -> None:
    """Run ``step(batch, batch_id)`` over the input; a failed batch is repeated with the same id."""
    df.writeStream.foreachBatch(step).option("checkpointLocation", f"{out}/_progress").trigger(availableNow=True).start().awaitTermination()


def hourly_slots(events: DataFrame, t: str, lateness: str, *aggs: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Tumbling hourly aggregation with a lateness buffer; a slot is emitted once the watermark has passed its end."""
    w = events.withWatermark(t, lateness).groupBy(F.window(t, "1 hour"), *keys).agg(*aggs)
    return w.select(F.col("window.start").alias("slot"), *[c for c in w.columns if c != "window"])


class PartitionedTable:
    """Parquet table in date partitions with repeatable key upserts.

    ``partition`` is an expression over the keys alone, so a key always lies in one partition. A batch rewrites only the partitions
    it touches: merged rows go to a staging folder of the batch first, then replace the partitions (dynamic overwrite), so a
    repeated batch gives the same table.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partition: tuple[str, Column], schema: str):
        self.spark, self.path, self.keys, self.schema = spark, path, list(keys), schema
        self.partition, self.partition_of = partition

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, self.schema)  # no table before the first batch

    def merge(self, batch: DataFrame, batch_id: int, newest: Sequence[str], combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> None:
        """Bring in the batch; of a key's stored and incoming rows the newest stays, unless ``combine`` says otherwise."""
        spark = batch.sparkSession
        order = [F.col(c).desc_nulls_last() for c in newest]
        rows = first_per_key(batch.withColumn(self.partition, self.partition_of), self.keys, order)
        staging = f"{self.path}_staging/{batch_id}"
        rows.write.mode("overwrite").parquet(f"{staging}/in")
        rows = spark.read.schema(rows.schema).parquet(f"{staging}/in")
        touched = rows.select(self.partition).distinct()
        current = self.read().join(touched, self.partition, "left_semi")
        merged = combine(current, rows) if combine else first_per_key(current.unionByName(rows.select(*current.columns)), self.keys, order)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{staging}/out")
        spark.read.schema(self.schema).parquet(f"{staging}/out").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(self.path)


    def merge_changed(self, batch: DataFrame, batch_id: int, newest: Sequence[str]) -> DataFrame:
        """Bring in the batch and return the rows it changed: those of the table that now hold what the batch brought.

        A repeated batch returns the same rows, so whatever is computed from them can be repeated too.
        """
        self.merge(batch, batch_id, newest)
        brought = self.spark.read.parquet(f"{self.path}_staging/{batch_id}/in").select(self.partition, *self.keys, *newest)
        return self.read().join(brought, [self.partition, *self.keys, *newest], "left_semi")

    def replace(self, rows: DataFrame, batch_id: int) -> None:
        """Put ``rows`` (one per key) in place of the stored rows of their keys."""
        self.merge(rows, batch_id, self.keys, lambda current, new: upsert(current, new, self.keys))


def on_time_load(spark: SparkSession, t: str, lateness: str, table: PartitionedTable, newest: Sequence[str], out: str) -> Callable[[DataFrame, int], None]:
    """Step that loads the rows of a batch which are no more than ``lateness`` behind the newest time of all batches before.

    Later rows are written to ``late``, and each batch's newest time and counts to ``marks``: on time and late rows are all rows. A
    repeated batch looks at the marks of earlier batches only, so it decides alike.
    """
    marks = "batch int, mark timestamp, rows bigint, late bigint"

    def step(batch: DataFrame, batch_id: int) -> None:
        before = read_or_empty(spark, f"{out}/marks", marks).where(F.col("batch") < batch_id)
        limit = before.agg(F.max("mark")).scalar() - F.expr(f"INTERVAL {lateness}")
        late = F.coalesce(F.col(t) < limit, F.lit(False))  # the first batch is on time
        batch.where(late).write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")
        table.merge(batch.where(~late), batch_id, newest)
        counts = batch.agg(F.max(t).alias("mark"), F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late"))
        counts.write.mode("overwrite").parquet(f"{out}/marks/batch={batch_id}")

    return step


def first_breach(events: DataFrame, key: str, t: str, breach: Column, out: str) -> DataFrame:
    """Readings of each key up to and including its first breach, in whatever order they arrive.

    A batch stores its readings and the first breach per key among them; the first breach of all batches is applied on reading,
    because a later batch may bring an earlier one.
    """
    spark = events.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")
        seen = spark.read.schema(batch.schema).parquet(f"{out}/data/batch={batch_id}")
        seen.where(breach).groupBy(key).agg(F.min(t).alias("_first")).write.mode("overwrite").parquet(f"{out}/first/batch={batch_id}")

    run_batches(events, out, step)
    first = spark.read.parquet(f"{out}/first").groupBy(key).agg(F.min("_first").alias("_first"))
    seen = spark.read.parquet(f"{out}/data").drop("batch")
    return seen.join(first, key, "left").where(F.col("_first").isNull() | (F.col(t) <= F.col("_first"))).drop("_first")


def fill_late(fact: PartitionedTable, late: DataFrame, out: str, column: str, seen_at: str, newest: str, window: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Late values fill the column of rows loaded earlier with NULL; only rows of the active window change.

    ``seen_at`` of the fact keeps the time (``newest``) of the value it holds, so an older value that arrives later changes nothing.
    """

    def combine(current: DataFrame, rows: DataFrame) -> DataFrame:
        new = rows.select(*fact.keys, F.col(column).alias("_late"), F.col(newest).alias("_at"))
        later = F.col("_at").isNotNull() & (F.col(seen_at).isNull() | (F.col("_at") >= F.col(seen_at)))
        return current.join(new, fact.keys, "left").withColumns({
            column: F.when(later, F.col("_late")).otherwise(F.col(column)), seen_at: F.when(later, F.col("_at")).otherwise(F.col(seen_at))}).drop("_late", "_at")

    run_batches(late, out, lambda batch, i: fact.merge(window(batch), i, [newest], combine))
    return fact.read()

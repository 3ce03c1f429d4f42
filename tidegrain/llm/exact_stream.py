"""Exact deduplication by a stateful stream: state on disk keeps, per digest, the row that stays and where its text lies.

The stream reads the documents folder and aggregates by digest in the RocksDB state store, without a watermark, so no key expires.
The state of a digest is its count and the largest (doc_id, file, row): the stable identifier and the locator of the content;
texts never enter the state. New files can be added and the stream run again from its checkpoint. Then every row whose digest has
more than one row is a hit: its full text is compared with the text at the locator. Texts that differ under one digest are
separated by grouping them on the text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.llm.common import ascii_lower, new_folder, small, written

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # many small stores: without this each one reserves megabytes of disk ahead
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

#: Files never become too old to be read (some 270 years).
NO_AGE = "100000d"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _located(df: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, text, digest, file, row); text is normalised, null counts as empty."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    rows = df.select("doc_id", text.alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.withColumn("digest", digest(F.col("text")))


def run_stream(spark: SparkSession, folder: str, checkpoint: str, digest: Callable[[Column], Column] = sha256, files_at_once: int | None = None) -> None:
    """Take every file of ``folder`` that the checkpoint has not seen into the keyed state, then stop."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        path, name = folder.rstrip("/").rpartition("/")[::2]
        some = spark.read.parquet(folder).select("_metadata.file_name").first()
        # without the age, a file of a modification time long before the newest one's would never be read
        reader = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFileAge", NO_AGE)
        if some and some["file_name"] == name:  # a single file: the stream watches its folder for this name
            folder, reader = path, reader.option("pathGlobFilter", name)
        if files_at_once:
            reader = reader.option("maxFilesPerTrigger", files_at_once)
        rows = _located(reader.parquet(folder), digest)
        state = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("keeper"), F.count("*").alias("n"))
        query = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(digest, keep_id, keep_file, keep_row, n) as the state store holds them."""
    rows = spark.read.format("statestore").load(checkpoint)
    keeper, n = (F.col("value")[f.name] for f in rows.schema["value"].dataType.fields)
    return rows.select(F.col("key.digest").alias("digest"), keeper["doc_id"].alias("keep_id"), keeper["file"].alias("keep_file"), keeper["row"].alias("keep_row"), n.alias("n"))


def deduplicate(spark: SparkSession, folder: str, digest: Callable[[Column], Column] = sha256, checkpoint: str | None = None, files_at_once: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per document of the Parquet ``folder``, dropped ones too.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the largest doc_id stays, of rows that
    share it the last in file order, so exactly one row of a group is kept; null ids come first in this order. Other columns are
    not read. An empty folder of the right schema gives no rows.
    """
    checkpoint = checkpoint or new_folder(spark, "dedup-stream")
    docs = _located(spark.read.parquet(folder), digest)
    if spark.read.parquet(folder).isEmpty():
        return docs.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha256(F.col("text")).alias("text_sha256"))
    run_stream(spark, folder, checkpoint, digest, files_at_once)
    state = written(read_state(spark, checkpoint), "dedup-state")
    rows = docs.select("doc_id", "digest", "file", "row", *([] if digest is sha256 else [sha256(F.col("text")).alias("text_sha256")]))
    labels = rows.join(state, "digest").withColumn("kept", (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row")))

    # The bytes of every hit are compared with those at the locator.
    repeated = small(written(state.where("n > 1").drop("n", "keep_id"), "dedup-repeated"))
    hits = written(docs.join(repeated, "digest").withColumn("is_keeper", (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).drop("keep_file", "keep_row"), "dedup-hits")
    kept_text = hits.where("is_keeper").select("digest", F.col("text").alias("kept_text"))
    other = written(hits.where("NOT is_keeper").join(kept_text, "digest").where("text <> kept_text").select("digest"), "dedup-collisions")  # nothing behind the join, so a hot digest can be split
    if not other.isEmpty():
        apart = hits.join(other, "digest", "left_semi")
        classes = apart.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "file", "row")).alias("k"), F.count("*").alias("m"))
        again = apart.join(classes, ["digest", "text"]).select(F.col("file").alias("f"), F.col("row").alias("r"), "k", "m")
        labels = labels.join(again, (F.col("file") == F.col("f")) & (F.col("row") == F.col("r")), "left")
        moved = F.col("m").isNotNull()
        labels = labels.withColumn("kept", F.when(moved, (F.col("file") == F.col("k.file")) & (F.col("row") == F.col("k.row"))).otherwise(F.col("kept")))
        labels = labels.withColumn("keep_id", F.when(moved, F.col("k.doc_id")).otherwise(F.col("keep_id"))).withColumn("n", F.coalesce("m", "n"))
    text_sha = F.col("digest" if digest is sha256 else "text_sha256")
    return labels.select("doc_id", "keep_id", F.col("n").alias("group_size"), "kept", text_sha.alias("text_sha256"))

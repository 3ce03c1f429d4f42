"""Writers: tables, views, landing zone with its ledger, dead letters, text reports, run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEDGER_SCHEMA = "source string, path string, status string, error string, attempts bigint, created_at timestamp, updated_at timestamp"
AUDIT_SCHEMA = "pipeline_name string, status string, duration_seconds double, rows_affected bigint, error_message string, env string, executed_at timestamp"


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Full rebuild of a table (also: create as select, replacing)."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def ctas_if_absent(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create as select; an existing table is left alone."""
    writer = df.write.mode("ignore")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def declare_table(spark: SparkSession, name: str, columns: str, path: str | None = None, partition: str | None = None, bucket: tuple[str, int] | None = None, order: str | None = None) -> None:
    """Create a declared Parquet table if it is absent; ``bucket`` (column, number) and ``order`` lay out its rows for joins on that column."""
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"]
    if partition:
        parts.append(f"PARTITIONED BY ({partition})")
    if bucket:
        parts.append(f"CLUSTERED BY ({bucket[0]})" + (f" SORTED BY ({order})" if order else "") + f" INTO {bucket[1]} BUCKETS")
    if path:
        parts.append(f"LOCATION '{path}'")
    spark.sql(" ".join(parts))


def insert_into(df: DataFrame, name: str) -> None:
    """Append into a declared table, columns put in its order."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def write_bucketed(df: DataFrame, name: str, path: str, column: str, buckets: int, order: str) -> None:
    """Table in buckets of ``column``, each sorted by ``order``: tables of the same buckets are joined and grouped by it without a shuffle.

    Rows are dealt to as many tasks as there are buckets first, so a bucket is one file.
    """
    df.repartition(buckets, column).write.mode("overwrite").option("path", path).bucketBy(buckets, column).sortBy(order).saveAsTable(name)


def append_numbered(df: DataFrame, keys: Sequence[str], name: str, path: str, load: int) -> DataFrame:
    """Number the rows that earlier loads have not stored, densely after the highest number they gave, and store them as load ``load``.

    Numbers follow the keys inside a load. The high-water mark of each load is stored with it and read from the loads before only, so
    running a load again gives the same numbers. Returns all stored rows.
    """
    from tidegrain.operators.ranking import global_row_number
    from tidegrain.streaming.jobs import read_or_empty

    spark, columns = df.sparkSession, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    stored = read_or_empty(spark, f"{path}/rows", f"{columns}, `{name}` bigint, load int")
    marks = read_or_empty(spark, f"{path}/marks", "high bigint, load int").where(F.col("load") < load)
    high = marks.agg(F.max("high")).first()[0] or 0
    new = df.join(stored.where(F.col("load") < load).select(*keys), list(keys), "left_anti").select(*df.columns)
    numbered = global_row_number(new, [F.col(k) for k in keys], name)
    numbered.withColumn(name, F.col(name) + F.lit(high)).write.mode("overwrite").parquet(f"{path}/rows/load={load}")
    written = spark.read.schema(f"{columns}, `{name}` bigint").parquet(f"{path}/rows/load={load}")
    written.agg(F.coalesce(F.max(name), F.lit(high)).cast("bigint").alias("high")).write.mode("overwrite").parquet(f"{path}/marks/load={load}")
    return spark.read.schema(f"{columns}, `{name}` bigint, load int").parquet(f"{path}/rows")


def manifest(df: DataFrame, partition: str) -> DataFrame:
    """Rows and an order-free checksum of each partition: equal tables have equal manifests, whatever their files and order.

    The checksum is the sum of the rows' 64-bit hashes, so a repeated or lost row changes it.
    """
    hashed = F.xxhash64(*(F.col(c) for c in df.columns)).cast("decimal(38,0)")
    return df.groupBy(partition).agg(F.count(F.lit(1)).alias("rows"), F.sum(hashed).alias("checksum"))


def copy_to_store(df: DataFrame, path: str, partition: str) -> DataFrame:
    """Write an extract to another store and compare both sides: (partition, rows, copied, equal)."""
    df.write.mode("overwrite").partitionBy(partition).parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    there = manifest(copy.select(*df.columns), partition).select(F.col(partition).alias("_p"), F.col("rows").alias("copied"), F.col("checksum").alias("_checksum"))
    both = manifest(df, partition).join(there, F.col(partition).eqNullSafe(F.col("_p")), "full_outer")
    equal = F.coalesce((F.col("rows") == F.col("copied")) & (F.col("checksum") == F.col("_checksum")), F.lit(False))
    return both.select(F.coalesce(partition, "_p").alias(partition), "rows", "copied", equal.alias("equal"))


def retain_partitions(spark: SparkSession, name: str, day: str, t: str, since: str) -> None:
    """Delete the rows of a managed table before the time ``since``: whole date partitions are dropped, only the border one is written anew.

    ``day`` is the date partition of the time ``t``. The list of partitions is one row per date.
    """
    border = spark.sql(f"SELECT CAST(CAST('{since}' AS TIMESTAMP) AS DATE)").first()[0].isoformat()
    days = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    if border in days:
        rows = spark.table(name).where((F.col(day) == F.lit(border).cast("date")) & (F.col(t) >= F.lit(since).cast(spark.table(name).schema[t].dataType)))
        staging = f"{name}_border"
        overwrite_table(rows, staging)
        if spark.table(staging).isEmpty():
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({day} = '{border}')")
        else:
            columns = [c for c in spark.table(name).columns if c != day]
            spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({day} = '{border}') SELECT {', '.join(columns)} FROM {staging}")
        spark.sql(f"DROP TABLE {staging}")
    for old in days:
        if old < border:
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({day} = '{old}')")


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def register_views(layers: Sequence[tuple[str, DataFrame]]) -> None:
    for name, df in layers:
        df.createOrReplaceTempView(name)


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Session table with frozen rows: a reliable checkpoint behind a temporary view."""
    from tidegrain.session import shared_dir

    shared_dir(df.sparkSession)
    frozen = df.checkpoint()
    frozen.createOrReplaceTempView(name)
    return frozen


def land_raw(df: DataFrame, path: str) -> None:
    """Append documents to the landing zone, laid out by source and ingestion date; files are never rewritten.

    ``df`` has ``source``, ``ingest_date`` and the document columns.
    """
    df.write.mode("append").partitionBy("source", "ingest_date").json(path)


def ledger_add(files: DataFrame, now: str) -> DataFrame:
    """Ledger rows for landed files (``source``, ``path``), to be done."""
    at = F.lit(now).cast("timestamp")
    return files.select(
        "source", "path", F.lit("pending").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(0).cast("bigint").alias("attempts"), at.alias("created_at"), at.alias("updated_at"))


def ledger_actionable(ledger: DataFrame) -> DataFrame:
    """Files to process: new ones and failed ones (retry); parked files wait for somebody to look at them."""
    return ledger.where(F.col("status").isin("pending", "error"))


def ledger_update(ledger: DataFrame, results: DataFrame, now: str, most_attempts: int | None = None) -> DataFrame:
    """Ledger after a run; ``results`` has ``path`` and ``error`` (NULL on success). A file that fails for the last time is parked."""
    r = results.select("path", F.col("error").alias("_err"), F.lit(True).alias("_done"))
    done = F.coalesce(F.col("_done"), F.lit(False))
    attempts = F.col("attempts") + F.when(done, 1).otherwise(0)
    failed = F.lit("error") if most_attempts is None else F.when(attempts >= most_attempts, "parked").otherwise("error")
    return ledger.join(r, "path", "left").select(
        "source", "path", F.when(done, F.when(F.col("_err").isNull(), "success").otherwise(failed)).otherwise(F.col("status")).alias("status"),
        F.when(done, F.col("_err")).otherwise(F.col("error")).alias("error"), attempts.alias("attempts"), "created_at",
        F.when(done, F.lit(now).cast("timestamp")).otherwise(F.col("updated_at")).alias("updated_at"))


class FileLedger:
    """Ledger kept over runs: every step writes the whole state as a new version, and a restart goes on from the last one."""

    def __init__(self, spark: SparkSession, path: str, most_attempts: int = 3):
        from tidegrain.streaming.jobs import read_or_empty

        self.spark, self.path, self.most_attempts = spark, path, most_attempts
        self.version = read_or_empty(spark, path, f"{LEDGER_SCHEMA}, version int").agg(F.max("version")).first()[0] or 0

    def read(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.path}/version={self.version}")

    def _write(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/version={self.version + 1}")
        self.version += 1

    def add(self, files: DataFrame, now: str) -> None:
        """Files (``source``, ``path``) the ledger does not know yet, to be done."""
        known = self.read()
        self._write(known.unionByName(ledger_add(files.distinct().join(known.select("path"), "path", "left_anti"), now)))

    def actionable(self) -> DataFrame:
        return ledger_actionable(self.read()).select("path")

    def finish(self, results: DataFrame, now: str) -> None:
        self._write(ledger_update(self.read(), results, now, self.most_attempts))


def quarantine(df: DataFrame, fault: Column) -> tuple[DataFrame, DataFrame]:
    """Split rows into good ones and dead letters that carry the text of their fault (NULL = good)."""
    marked = df.withColumn("_error", fault)
    return marked.where("_error IS NULL").drop("_error"), marked.where("_error IS NOT NULL")


def report_lines(df: DataFrame, widths: dict[str, int], sep: str = " | ") -> DataFrame:
    """Body of a fixed-width report: one padded line per row (negative width = right aligned)."""
    return df.select(_line(widths, sep).alias("value"))


def write_report(df: DataFrame, path: str, title: str, widths: dict[str, int], order: Sequence, total: str | None = None) -> None:
    """Write a fixed-width text report with header, body and optional totals line: text files that make up the report in the order of their names.

    The body is sorted over all tasks and written in parts, however long it is; header and totals are files of their own before and behind it.
    """
    spark = df.sparkSession
    head = [title, "=" * 60, " | ".join(c.upper().ljust(abs(w)) for c, w in widths.items()), "-" * 60]
    # one row with line breaks: a file of its own, in order
    spark.createDataFrame([("\n".join(head),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/section=0")
    df.orderBy(*order).select(_line(widths).alias("value")).write.mode("overwrite").text(f"{path}/section=1")
    if total:
        foot = df.agg(F.sum(total).alias("t")).select(F.format_string("TOTAL %s: %.2f", F.lit(total), F.col("t").cast("double")).alias("value"))
        foot.write.mode("overwrite").text(f"{path}/section=2")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """(section, row, value): the lines of a report, numbered in each section by the order of its parts."""
    parts = spark.read.schema("value string, section bigint").text(path, wholetext=True).select("section", F.col("_metadata.file_name").alias("part"), F.split("value", "\n").alias("lines"))
    lines = parts.select("section", "part", F.posexplode("lines").alias("at", "value")).where("value <> ''")
    before = F.sum("n").over(W.partitionBy("of").orderBy("name").rowsBetween(W.unboundedPreceding, -1))
    # one row per file
    sizes = lines.groupBy(F.col("section").alias("of"), F.col("part").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(before, F.lit(0).cast("bigint")))
    placed = lines.join(F.broadcast(sizes), (F.col("section") == F.col("of")) & (F.col("part") == F.col("name")))
    return placed.select("section", (F.col("before") + F.col("at") + 1).alias("row"), "value")


def _line(widths: dict[str, int], sep: str = " | ") -> Column:
    cells = [F.lpad(F.col(c).cast("string"), -w, " ") if w < 0 else F.rpad(F.col(c).cast("string"), w, " ") for c, w in widths.items()]
    return F.concat_ws(sep, *cells)


def format_events(df: DataFrame, t: str, kind: str, text: str) -> DataFrame:
    """``[timestamp] TYPE   : text`` lines."""
    return df.select(F.format_string("[%s] %-7s: %s", F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.col(kind), F.col(text)).alias("value"))


def append_audit(spark: SparkSession, name: str, row: dict, path: str | None = None) -> None:
    """Append one run to the run log, a declared table."""
    declare_table(spark, name, AUDIT_SCHEMA, path)
    insert_into(spark.createDataFrame([row], AUDIT_SCHEMA), name)

"""Registered streaming jobs over ``events``; each equals the batch statement beside it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions.numbers import dbl
from tidegrain.plans import energy as E
from tidegrain.plans.registry import job
from tidegrain.sources.sinks import land_raw
from tidegrain.sources.tables import Tables
from tidegrain.streaming import jobs as S


@job("stream_hourly_slots", """SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS slot, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events) GROUP BY 1, 2""")
def stream_hourly_slots(t: Tables) -> DataFrame:
    """Hourly aggregation with a two-hour lateness buffer (slots the watermark has closed)."""
    src = S.stream_table(t.spark, t.root, "events").select("ts", "event_type", F.col("value").cast("decimal(18,2)").alias("v"))
    agg = S.hourly_slots(src, "ts", "2 hours", F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"), keys=["event_type"])
    out = S.run_append(agg, S.work_dir(t.spark, "slots"))
    return out.select(D.epoch(F.col("slot")).alias("slot"), "event_type", "n", dbl("v").alias("total"))


@job("stream_first_breach", """WITH b AS (SELECT user_id, min(ts) AS f FROM events WHERE value > 200 GROUP BY 1) SELECT e.event_id, e.user_id, e.value FROM events e LEFT JOIN b ON b.user_id = e.user_id WHERE b.f IS NULL OR e.ts <= b.f""")
def stream_first_breach(t: Tables, limit: float = 200.0) -> DataFrame:
    """Readings of every sensor until its first value over the limit."""
    work = S.work_dir(t.spark, "breach")
    src = S.shuffled_stream(t.spark, t.root, "events", "event_id", 3, work).select("event_id", "user_id", "ts", "value")
    return S.first_breach(src, "user_id", "ts", F.col("value") > limit, work).select("event_id", "user_id", "value")


@job("stream_landing", """SELECT CASE WHEN event_id % 50 = 9 THEN 'corrupt' ELSE event_type END AS kind, count(*) AS documents FROM events GROUP BY 1""")
def stream_landing(t: Tables) -> DataFrame:
    """Landing zone read incrementally: documents by kind, unreadable text kept apart."""
    work = S.work_dir(t.spark, "landing")
    e = F.col("event_id")
    text = F.when(e % 50 == 9, F.concat(F.lit('{"event_id": '), e.cast("string"))).otherwise(F.to_json(F.struct("event_id", "event_type")))
    t.raw("events").select(text.alias("value")).write.text(f"{work}/in")
    docs = S.stream_landing(t.spark, f"{work}/in", "event_id bigint, event_type string")
    out = S.run_append(docs.select(F.when(F.col("_corrupt").isNotNull(), "corrupt").otherwise(F.col("event_type")).alias("kind")), work)
    return out.groupBy("kind").agg(F.count(F.lit(1)).alias("documents"))


@job("stream_upsert", """SELECT user_id, CAST(epoch(slot) AS BIGINT) AS slot, event_id, value FROM (SELECT user_id, date_trunc('hour', ts) AS slot, event_id, value, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_upsert(t: Tables) -> DataFrame:
    """Latest reading per sensor and hour kept by a repeatable upsert into date partitions from files out of order (each batch is applied twice)."""
    work = S.work_dir(t.spark, "upsert")
    table = S.PartitionedTable(t.spark, f"{work}/table", ["user_id", "slot"], ("day", F.to_date("slot")), "user_id bigint, slot timestamp, event_id bigint, value double, ts timestamp, day date")
    src = S.shuffled_stream(t.spark, t.root, "events", "event_id", 3, work).select("user_id", F.date_trunc("hour", "ts").alias("slot"), "event_id", "value", "ts")

    def twice(batch: DataFrame, i: int) -> None:
        table.merge(batch, i, ["ts", "event_id"])
        table.merge(batch, i, ["ts", "event_id"])

    S.run_batches(src, work, twice)
    return table.read().select("user_id", D.epoch(F.col("slot")).alias("slot"), "event_id", "value")


@job("stream_late_prices", """SELECT f.client_id, f.unix_time, CASE WHEN f.unix_time >= 1705356000 THEN p.price_euro_mwh END AS price_pvpc_eur_mwh FROM v_fact f LEFT JOIN (SELECT CAST(epoch(dt) AS BIGINT) AS unix_time, max_by(v, ts) AS price_euro_mwh FROM (
SELECT date_trunc('hour', ts) AS dt, ts, CAST(value AS DOUBLE) AS v FROM events WHERE event_type = 'click') GROUP BY 1) p ON p.unix_time = f.unix_time""")
def stream_late_prices(t: Tables) -> DataFrame:
    """Prices that arrive after the fact was loaded with NULL fill the slots from two hours before ``now``."""
    work = S.work_dir(t.spark, "late")
    schema = "unix_time bigint, client_id string, price_pvpc_eur_mwh double, price_seen_at timestamp, slot_date date"
    E.gold_fact(t).select("unix_time", "client_id", F.lit(None).cast("double").alias("price_pvpc_eur_mwh"), F.lit(None).cast("timestamp").alias("price_seen_at"), "slot_date").write.partitionBy("slot_date").parquet(f"{work}/table")
    fact = S.PartitionedTable(t.spark, f"{work}/table", ["unix_time"], ("slot_date", F.to_date(F.timestamp_seconds("unix_time"))), schema)
    prices = S.shuffled_stream(t.spark, t.root, "events", "event_id", 3, work).where("event_type = 'click'").select(
        D.epoch(F.date_trunc("hour", "ts")).alias("unix_time"), F.col("value").alias("price_pvpc_eur_mwh"), "ts")
    start = D.epoch(F.lit("2024-01-15 22:00:00").cast("timestamp"))
    return S.fill_late(fact, prices, work, "price_pvpc_eur_mwh", "price_seen_at", "ts", lambda b: b.where(F.col("unix_time") >= start)).select("client_id", "unix_time", "price_pvpc_eur_mwh")


@job("landing_zone", "SELECT 'prices' AS source, CAST(ts AS DATE) AS ingest_date, count(*) AS documents FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' GROUP BY 2")
def landing_zone(t: Tables) -> DataFrame:
    """Documents landed in source and date folders; the count reads only the folders asked for."""
    work = S.work_dir(t.spark, "zone")
    docs = E.raw_prices(t).select("raw_data", "_source_file", F.lit("prices").alias("source"), F.to_date("_ingested_at_utc").alias("ingest_date"))
    land_raw(docs, f"{work}/zone")
    zone = t.spark.read.schema("raw_data string, _source_file string, source string, ingest_date date").json(f"{work}/zone")
    return zone.where((F.col("source") == "prices") & F.col("ingest_date").between("2024-01-10", "2024-01-11")).groupBy("source", "ingest_date").agg(F.count(F.lit(1)).alias("documents"))

"""Incremental loads over several runs: recomputed windows, late rows, counts of what cleaning dropped."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions import solar
from tidegrain.functions import text as X
from tidegrain.plans import energy as E
from tidegrain.plans.registry import job
from tidegrain.sources.tables import Tables
from tidegrain.streaming import jobs as S


@job("stream_window_recompute", """SELECT c.client_id, c.unix_time, c.pv_power_gen_kw, c.power_con_kw, p.price FROM v_calc c LEFT JOIN (
SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS unix_time, max_by(CAST(value AS DOUBLE), ts) AS price FROM events WHERE event_type = 'click' GROUP BY 1) p ON p.unix_time = c.unix_time WHERE c.unix_time >= 1705363200""")
def stream_window_recompute(t: Tables, now: str = E.NOW, deliveries: int = 3) -> DataFrame:
    """Fact of the active window under weather and prices that arrive in any order: a batch computes only what it changed.

    A batch's documents go into the stored weather and prices, newest first; the (client, hour) keys that now hold something new, and
    lie at or after ``now``, go through yield and fact again. Date partitions without such keys keep their files.
    """
    work, clients = S.work_dir(t.spark, "recompute"), E.clean_clients(t)
    events = S.stored_events(t.spark, t.root, "events")
    form = E.silver_weather(E.weather_documents(events.limit(0))).schema
    keys = ["client_id", "unix_time"]

    def table(name: str, by: list[str], columns: str) -> S.PartitionedTable:
        day = ("slot_date", F.to_date(F.timestamp_seconds("unix_time")))
        return S.PartitionedTable(t.spark, f"{work}/{name}", by, day, f"{columns}, slot_date date")

    weather = table("weather", keys, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in form))
    prices = table("prices", ["unix_time"], "unix_time bigint, price double, ts timestamp")
    fact = table("fact", keys, "client_id string, unix_time bigint, pv_power_gen_kw double, power_con_kw double, price double")
    active = F.col("unix_time") >= D.epoch(F.lit(now).cast("timestamp"))

    def step(batch: DataFrame, i: int) -> None:
        brought = batch.where("event_type = 'click'").select(D.epoch(F.date_trunc("hour", "ts")).alias("unix_time"), F.col("value").alias("price"), "ts")
        hours = prices.merge_changed(brought, i, ["ts"]).where(active).select("slot_date", "unix_time")
        moved = weather.merge_changed(E.silver_weather(E.weather_documents(batch)), i, ["_ingested_at_utc", "_source_file"]).where(active)
        priced = weather.read().join(hours, ["slot_date", "unix_time"], "left_semi")
        touched = moved.select("slot_date", *keys).unionByName(priced.select("slot_date", *keys)).distinct()
        rows = weather.read().join(touched, ["slot_date", *keys], "left_semi").drop("slot_date")
        calc = solar.pv_yield(E.active_silver(clients, rows, now)).select(*keys, "pv_power_gen_kw", "power_con_kw")
        fact.replace(calc.join(prices.read().select("unix_time", "price"), "unix_time", "left"), i)

    S.run_deliveries([events.where(F.pmod(F.xxhash64("event_id"), F.lit(deliveries)) == i) for i in range(deliveries)], work, step)
    return fact.read().drop("slot_date")


#: Deliveries of the late-row jobs: blocks of eight days, and of every seventh reading a block later.
_DELIVERY = "least((day(ts) - 1) // 8 + CASE WHEN event_id % 7 = 3 THEN 1 ELSE 0 END, 3)"
_LATE = f"""WITH e AS (SELECT *, {_DELIVERY} AS d FROM events), m AS (SELECT d, max(ts) AS mark FROM e GROUP BY 1), b AS (SELECT x.d, max(m.mark) AS mark FROM (SELECT DISTINCT d FROM e) x LEFT JOIN m ON m.d < x.d GROUP BY 1),
f AS (SELECT e.*, coalesce(e.ts < b.mark - INTERVAL 2 HOUR, FALSE) AS late FROM e JOIN b ON b.d = e.d)"""


def _buffered(t: Tables, lateness: str = "2 HOURS") -> tuple[S.PartitionedTable, str]:
    """Readings loaded in four deliveries with a lateness buffer: the fact (newest reading per sensor and hour) and the folder of late rows and marks."""
    work = S.work_dir(t.spark, "buffer")
    rows = S.stored_events(t.spark, t.root, "events").select("event_id", "user_id", F.date_trunc("hour", "ts").alias("slot"), "value", "ts")
    block = F.least(F.floor((F.dayofmonth("ts") - 1) / 8) + F.when(F.col("event_id") % 7 == 3, 1).otherwise(0), F.lit(3))
    fact = S.PartitionedTable(t.spark, f"{work}/fact", ["user_id", "slot"], ("slot_date", F.to_date("slot")), "user_id bigint, slot timestamp, event_id bigint, value double, ts timestamp, slot_date date")
    S.run_deliveries([rows.where(block == i) for i in range(4)], work, S.on_time_load(t.spark, "ts", lateness, fact, ["ts", "event_id"], work))
    return fact, work


@job("stream_fact_late", f"""{_LATE} SELECT 'fact' AS kind, user_id, CAST(epoch(slot) AS BIGINT) AS slot, event_id, value FROM (
SELECT user_id, date_trunc('hour', ts) AS slot, event_id, value, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn FROM f WHERE NOT late) WHERE rn = 1
UNION ALL SELECT 'late', user_id, CAST(epoch(date_trunc('hour', ts)) AS BIGINT), event_id, value FROM f WHERE late""")
def stream_fact_late(t: Tables) -> DataFrame:
    """Fact load with a two-hour buffer: rows further behind go to a table of late rows instead of vanishing."""
    fact, work = _buffered(t)
    late = S.read_or_empty(t.spark, f"{work}/late/batch=*", "event_id bigint, user_id bigint, slot timestamp, value double, ts timestamp")
    columns = ["user_id", D.epoch(F.col("slot")).alias("slot"), "event_id", "value"]
    return fact.read().select(F.lit("fact").alias("kind"), *columns).unionByName(late.select(F.lit("late").alias("kind"), *columns))


@job("stream_late_counts", f"{_LATE} SELECT CAST(row_number() OVER (ORDER BY d) - 1 AS BIGINT) AS batch, count(*) AS rows, count(CASE WHEN late THEN 1 END) AS late, count(CASE WHEN NOT late THEN 1 END) AS on_time FROM f GROUP BY d")
def stream_late_counts(t: Tables) -> DataFrame:
    """Rows, late rows and rows on time of every batch, from the marks the loads left."""
    _, work = _buffered(t)
    marks = t.spark.read.schema("batch int, mark timestamp, rows bigint, late bigint").parquet(f"{work}/marks")
    return marks.select(F.col("batch").cast("bigint").alias("batch"), "rows", "late", (F.col("rows") - F.col("late")).alias("on_time"))


def counted(t: Tables, step: str, rows: DataFrame, seen: Observation) -> DataFrame:
    """Write cleaned rows and, from metrics taken in the same pass, what came in, was dropped and why, and went out: (step, reason, rows)."""
    work, done = S.work_dir(t.spark, f"audit-{step}"), Observation()
    rows.observe(done, F.count(F.lit(1)).alias("rows out")).write.parquet(f"{work}/rows")
    found = {**seen.get, **done.get}
    found["repeated"] = found.pop("valid") - found["rows out"]
    audit = t.spark.createDataFrame([(step, reason, n) for reason, n in found.items()], "step string, reason string, rows bigint")
    audit.write.parquet(f"{work}/audit")
    return t.spark.read.schema("step string, reason string, rows bigint").parquet(f"{work}/audit")


def _audit_sql(step: str, parts: dict[str, str], rows: str) -> str:
    return " UNION ALL ".join(f"SELECT '{step}' AS step, '{reason}' AS reason, CAST(({what}) AS BIGINT) AS rows FROM {rows}" for reason, what in parts.items())


_NO_FIELD, _BAD_PLACE = "client_id IS NULL OR name IS NULL", "latitude NOT BETWEEN -90 AND 90"
_VALID = f"NOT ({_NO_FIELD}) AND NOT ({_BAD_PLACE}) AND pv_peak_power_kw > 0"


@job("clients_dropped", _audit_sql("clients", {
    "rows in": "count(*)", "missing field": f"count(CASE WHEN {_NO_FIELD} THEN 1 END)", "coordinates out of range": f"count(CASE WHEN NOT ({_NO_FIELD}) AND {_BAD_PLACE} THEN 1 END)",
    "no power": f"count(CASE WHEN NOT ({_NO_FIELD}) AND NOT ({_BAD_PLACE}) AND NOT pv_peak_power_kw > 0 THEN 1 END)",
    "repeated": f"count(CASE WHEN {_VALID} THEN 1 END) - count(DISTINCT CASE WHEN {_VALID} THEN client_id END)", "rows out": f"count(DISTINCT CASE WHEN {_VALID} THEN client_id END)"}, "v_raw_client"))
def clients_dropped(t: Tables) -> DataFrame:
    """Client records that came in, were dropped (by first reason) and went out, counted while they are cleaned."""
    seen = Observation()
    return counted(t, "clients", E.silver_clients(E.raw_clients(t), seen), seen)


_PRICE = """(SELECT event_id % 60 = 11 AS untimed, event_id % 10 <> 3 AND event_id % 50 = 7 AS outlier, struct_pack(a := event_id % 2, b := date_trunc('hour', ts)) AS k FROM events)"""


@job("prices_dropped", _audit_sql("prices", {
    "rows in": "count(*)", "no time": "count(CASE WHEN untimed THEN 1 END)", "outlier": "count(CASE WHEN NOT untimed AND outlier THEN 1 END)",
    "repeated": "count(CASE WHEN NOT untimed AND NOT outlier THEN 1 END) - count(DISTINCT CASE WHEN NOT untimed AND NOT outlier THEN k END)",
    "rows out": "count(DISTINCT CASE WHEN NOT untimed AND NOT outlier THEN k END)"}, _PRICE))
def prices_dropped(t: Tables) -> DataFrame:
    """Price values that came in, had no time, were outliers or repeated an hour, and went out."""
    seen = Observation()
    return counted(t, "prices", E.silver_prices(E.raw_prices(t), seen=seen), seen)


_CLEAN = "translate(trim(text), '#$%&/()', '')"


@job("documents_dropped", _audit_sql("documents", {
    "rows in": "count(*)", "blank": f"count(*) - count(CASE WHEN {_CLEAN} <> '' THEN 1 END)", "repeated": "0 * count(*)", "rows out": f"count(CASE WHEN {_CLEAN} <> '' THEN 1 END)"}, "documents"))
def documents_dropped(t: Tables) -> DataFrame:
    """Texts that came in, were blank after cleaning, and went out (whole texts)."""
    seen, clean = Observation(), t.raw("documents").select("doc_id", X.clean_text(F.col("text")).alias("clean"))
    return counted(t, "documents", E.faultless(clean, {"blank": F.coalesce(F.col("clean"), F.lit("")) == ""}, seen), seen)

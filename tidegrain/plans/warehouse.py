"""Stored tables and files: catalog tables, buckets, numbered loads, copies between stores, whole documents, retention, long reports."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions.numbers import dbl
from tidegrain.operators.series import hourly_blocks, to_full_hours
from tidegrain.plans import energy as E
from tidegrain.plans.registry import job
from tidegrain.sources import readers as RD
from tidegrain.sources import sinks as SK
from tidegrain.sources.tables import Tables
from tidegrain.streaming.jobs import work_dir

#: Buckets of the client tables.
BUCKETS = 8


def table_name(name: str) -> str:
    """A name of its own in the session's catalog for every run."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


# -- catalog tables ---------------------------------------------------------------------------------

@job("dim_tracks_table", """SELECT track_id, name, genre, CAST(unit_price AS DOUBLE) AS unit_price, CASE WHEN track_id % 2 = 0 THEN 'first load' ELSE 'second load' END AS loaded FROM v_track""")
def dim_tracks_table(t: Tables) -> DataFrame:
    """Declared dimension filled by two inserts; declaring or creating it again leaves its rows alone."""
    name, path = table_name("dim_tracks"), work_dir(t.spark, "dim_tracks")
    columns = "track_id BIGINT, name STRING, genre STRING, unit_price DOUBLE, loaded STRING"
    rows = t.tracks.select(F.when(F.col("track_id") % 2 == 0, "first load").otherwise("second load").alias("loaded"), dbl("unit_price").alias("unit_price"), "genre", "name", "track_id")
    for load in ("first load", "second load"):
        SK.declare_table(t.spark, name, columns, path)
        SK.insert_into(rows.where(F.col("loaded") == load), name)  # columns come in another order than declared
    SK.ctas_if_absent(rows.withColumn("loaded", F.lit("third load")), name)
    return RD.read_table(t.spark, name, ["track_id", "name", "genre", "unit_price", "loaded"])


@job("genre_table", "SELECT genre, count(*) AS tracks FROM v_track GROUP BY 1")
def genre_table(t: Tables) -> DataFrame:
    """Table built from a query, then rebuilt whole from another; the rebuilt rows are read."""
    name, path = table_name("genres"), work_dir(t.spark, "genres")
    SK.overwrite_table(t.tracks.select("genre").distinct(), name, path)
    SK.overwrite_table(t.tracks.groupBy("genre").agg(F.count(F.lit(1)).alias("tracks")), name, path)
    return RD.read_table(t.spark, name, ["genre", "tracks"])


@job("audit_log", """SELECT 'clients' AS pipeline_name, 'SUCCESS' AS status, count(*) AS rows_affected, 'DEV' AS env FROM v_clean_client UNION ALL SELECT 'prices', 'SUCCESS', count(*), 'DEV' FROM v_clean_price
UNION ALL SELECT 'weather', 'SUCCESS', count(*), 'DEV' FROM v_clean_weather UNION ALL SELECT 'fact', 'SUCCESS', count(*), 'DEV' FROM v_fact""")
def audit_log(t: Tables) -> DataFrame:
    """Run log in a declared table: one appended row per layer with the rows it holds."""
    name, path = table_name("etl_metadata"), work_dir(t.spark, "etl_metadata")
    for layer, build in (("clients", E.clean_clients), ("prices", E.clean_prices), ("weather", E.clean_weather), ("fact", E.gold_fact)):
        n = build(t).count()
        SK.append_audit(t.spark, name, {"pipeline_name": layer, "status": "SUCCESS", "duration_seconds": None, "rows_affected": n, "error_message": None, "env": "DEV", "executed_at": None}, path)
    return RD.read_table(t.spark, name, ["pipeline_name", "status", "rows_affected", "env"])


def bucketed_clients(t: Tables) -> tuple[str, str]:
    """Names of the fact and the client dimension as tables in the same buckets of client_id, written once per run."""
    fact, dim = table_name("fact_by_client"), table_name("dim_by_client")
    narrow = E.gold_fact(t).select("client_id", "unix_time", "pv_power_gen_kw", "power_consumption_kw")
    SK.write_bucketed(narrow, fact, work_dir(t.spark, fact), "client_id", BUCKETS, "client_id")
    SK.write_bucketed(E.gold_dim_client(t).select("client_id", "name", "has_battery"), dim, work_dir(t.spark, dim), "client_id", BUCKETS, "client_id")
    return fact, dim


def energy_by_client(t: Tables, fact: str, dim: str) -> DataFrame:
    def total(c: str):
        return F.sum(F.col(c).cast("decimal(18,3)")).cast("double").alias(c)

    rows = t.spark.table(fact).join(t.spark.table(dim).hint("merge"), "client_id")
    return rows.groupBy("client_id", "name", "has_battery").agg(F.count(F.lit(1)).alias("hours"), total("pv_power_gen_kw"), total("power_consumption_kw"))


@job("bucketed_client_energy", """SELECT f.client_id, d.name, d.has_battery, count(*) AS hours, CAST(sum(CAST(f.pv_power_gen_kw AS DECIMAL(18,3))) AS DOUBLE) AS pv_power_gen_kw,
CAST(sum(CAST(f.power_consumption_kw AS DECIMAL(18,3))) AS DOUBLE) AS power_consumption_kw FROM v_fact f JOIN v_dim_client d ON d.client_id = f.client_id GROUP BY 1, 2, 3""")
def bucketed_client_energy(t: Tables) -> DataFrame:
    """Energy per client from two tables in the same buckets: neither the join nor the grouping shuffles."""
    return energy_by_client(t, *bucketed_clients(t))


# -- numbered loads, copies ---------------------------------------------------------------------------

@job("fact_sales_numbered", """SELECT i.invoice_id, l.line_no, l.track_id, l.artist_id, row_number() OVER (ORDER BY i.invoice_date >= TIMESTAMP '1996-01-01', i.invoice_id, l.line_no, l.track_id, l.artist_id) AS sales_no,
CASE WHEN i.invoice_date < TIMESTAMP '1996-01-01' THEN 1 ELSE 2 END AS load FROM (SELECT DISTINCT invoice_id, line_no, track_id, artist_id FROM v_line) l JOIN v_invoice i ON i.invoice_id = l.invoice_id""")
def fact_sales_numbered(t: Tables) -> DataFrame:
    """Sales lines under a dense number over two loads: the second brings all lines, numbers the new ones, and is run twice."""
    keys, path = ["invoice_id", "line_no", "track_id", "artist_id"], work_dir(t.spark, "numbered")
    rows = t.lines.select(*keys).distinct().join(t.invoices.select("invoice_id", "invoice_date"), "invoice_id").select(*keys, "invoice_date")
    SK.append_numbered(rows.where(F.col("invoice_date") < F.lit("1996-01-01").cast("timestamp_ntz")), keys, "sales_no", path, 1)
    for _ in range(2):
        out = SK.append_numbered(rows, keys, "sales_no", path, 2)
    return out.select(*keys, "sales_no", F.col("load").cast("bigint").alias("load"))


@job("cross_store_extract", """SELECT genre, count(*) AS rows, count(*) AS copied, TRUE AS equal FROM v_track t JOIN (SELECT DISTINCT track_id, artist_id FROM v_line) l ON l.track_id = t.track_id JOIN v_artist a ON a.employee_id = l.artist_id
WHERE t.composer IS NOT NULL GROUP BY 1""")
def cross_store_extract(t: Tables) -> DataFrame:
    """Join query read from one store and written to another, with counts and checksums of both sides by genre."""
    pairs = t.lines.select("track_id", "artist_id").distinct()
    artists = t.artists.select(F.col("employee_id").alias("artist_id"), F.col("name").alias("artist"))
    rows = t.tracks.where("composer IS NOT NULL").select("track_id", "name", "composer", "album", "genre").join(pairs, "track_id").join(artists, "artist_id")
    return SK.copy_to_store(rows.select("track_id", "artist_id", "name", "composer", "album", "artist", "genre"), work_dir(t.spark, "store2"), "genre")


# -- whole documents --------------------------------------------------------------------------------------

#: Customers of a landed document.
PER_DOCUMENT = 100


def _landed_clients(t: Tables) -> str:
    """Customers landed as documents that hold one JSON array each, a bounded number of customers in a document."""
    path, k = work_dir(t.spark, "documents"), F.col("c_custkey")
    doc = F.floor(k / PER_DOCUMENT).cast("bigint")
    one = F.sort_array(F.collect_list(F.struct(k.alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))))
    docs = t.raw("customer").groupBy(doc.alias("doc")).agg(F.to_json(one, {"pretty": "true"}).alias("value"))
    docs.repartition("doc").write.option("lineSep", "\n\n").partitionBy("doc").text(path)
    return path


@job("json_array_scan", f"SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, 'doc=' || CAST(c_custkey // {PER_DOCUMENT} AS VARCHAR) AS folder FROM customer")
def json_array_scan(t: Tables) -> DataFrame:
    """Rows of multi-line JSON array documents, with the folder of the file each came from."""
    rows = RD.with_provenance(RD.read_json_array(t.spark, f"{_landed_clients(t)}/doc=*", "id bigint, name string, balance double"), "file_path")
    return rows.select("id", "name", "balance", F.element_at(F.split("_source_file", "/"), -2).alias("folder"))


@job("raw_document_scan", f"SELECT 'doc=' || CAST(c_custkey // {PER_DOCUMENT} AS VARCHAR) AS folder, count(*) AS customers, CAST(min(c_custkey) AS BIGINT) AS first_id, string_agg(c_name, ',' ORDER BY c_custkey) AS names FROM customer GROUP BY 1")
def raw_document_scan(t: Tables) -> DataFrame:
    """Whole documents kept as text with their file and reading time; what they hold is parsed afterwards."""
    raw = RD.read_raw(t.spark, f"{_landed_clients(t)}/doc=*")
    parsed = raw.where("_ingested_at_utc IS NOT NULL").select(F.element_at(F.split("_source_file", "/"), -2).alias("folder"), F.from_json("raw_data", "array<struct<id:bigint,name:string>>").alias("a"))
    return parsed.select("folder", F.size("a").cast("bigint").alias("customers"), F.col("a")[0]["id"].alias("first_id"), F.array_join("a.name", ",").alias("names"))


@job("client_master_scan", "SELECT client_id, description, panel_type, efficiency, nominal_load_kw FROM v_raw_client WHERE again = 0")
def client_master_scan(t: Tables) -> DataFrame:
    """Client master from its exported sheet: empty cells and ``nan`` are missing values."""
    path, columns = work_dir(t.spark, "master"), ["client_id", "description", "panel_type", "efficiency", "nominal_load_kw"]
    raw = E.raw_clients(t).where("_source_file = 'clients_0.json'").select(*columns)
    raw.withColumn("efficiency", F.coalesce("efficiency", F.lit("nan"))).write.csv(path, header=True)
    rows = RD.read_clients(t.spark, path, "client_id string, description string, panel_type string, efficiency double, nominal_load_kw double")
    return rows.withColumn("efficiency", F.when(~F.isnan("efficiency"), F.col("efficiency")))


@job("production_ingest", """SELECT year(o_orderdate) AS year, 'MON ' || month(o_orderdate) AS period, CAST(o_custkey % 50 + 1 AS BIGINT) AS state_ansi, CASE WHEN count(*) % 7 <> 3 THEN CAST(sum(o_custkey) AS BIGINT) END AS value,
count(*) % 7 = 3 AS withheld FROM orders GROUP BY year(o_orderdate), month(o_orderdate), o_custkey % 50""")
def production_ingest(t: Tables) -> DataFrame:
    """Production files read into their declared table; values lose their thousands separators, withheld ones become NULL."""
    path, name = work_dir(t.spark, "production"), table_name("production")
    d, k = F.col("o_orderdate"), F.col("o_custkey")
    sums = t.raw("orders").groupBy(F.year(d).alias("Year"), F.month(d).alias("m"), (k % 50 + 1).cast("int").alias("State_ANSI")).agg(F.sum(k).alias("v"), F.count(F.lit(1)).alias("n"))
    sums.select(
        "Year", F.concat(F.lit("MON "), F.col("m").cast("string")).alias("Period"), F.lit("STATE").alias("Geo_Level"), "State_ANSI", F.lit(1).alias("Commodity_ID"), F.lit("TOTAL").alias("Domain"),
        F.when(F.col("n") % 7 == 3, " (D)").otherwise(F.format_number("v", 0)).alias("Value")).write.csv(path, header=True, ignoreLeadingWhiteSpace=False)
    SK.declare_table(t.spark, name, RD.PRODUCTION_SCHEMA, work_dir(t.spark, name))
    SK.insert_into(RD.read_csv(t.spark, path, RD.PRODUCTION_SCHEMA), name)
    value = F.replace(F.trim("Value"), F.lit(","), F.lit(""))
    return t.spark.table(name).select(
        F.col("Year").cast("bigint").alias("year"), F.col("Period").alias("period"), F.col("State_ANSI").cast("bigint").alias("state_ansi"), value.try_cast("bigint").alias("value"),
        value.startswith("(").alias("withheld"))


# -- series, retention, reports ----------------------------------------------------------------------------

@job("sensor_hours", """WITH p AS (SELECT user_id, date_trunc('hour', ts) AS t, CAST(sum(CASE WHEN event_id % 5 <> 0 THEN CAST(value AS DECIMAL(28,6)) END) AS DOUBLE) / nullif(count(CASE WHEN event_id % 5 <> 0 THEN value END), 0) AS value,
max(CASE WHEN event_type <> 'view' THEN struct_pack(ts := ts, event_id := event_id, v := event_type) END).v AS kind FROM events GROUP BY 1, 2),
q AS (SELECT *, lead(t) OVER w AS nxt, last_value(CASE WHEN value IS NOT NULL THEN struct_pack(t := t, v := value) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a,
first_value(CASE WHEN value IS NOT NULL THEN struct_pack(t := t, v := value) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b,
last_value(kind IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS kd FROM p WINDOW w AS (PARTITION BY user_id ORDER BY t)),
g AS (SELECT *, unnest(generate_series(t, coalesce(nxt - INTERVAL 1 HOUR, t), INTERVAL 1 HOUR)) AS slot FROM q)
SELECT user_id, CAST(epoch(slot) AS BIGINT) AS slot, CASE WHEN b IS NULL THEN a.v ELSE a.v + (b.v - a.v) * ((epoch(slot) / 3600.0::DOUBLE - epoch(a.t) / 3600.0::DOUBLE) / (epoch(b.t) / 3600.0::DOUBLE - epoch(a.t) / 3600.0::DOUBLE)) END AS value, kd AS kind FROM g""")
def sensor_hours(t: Tables) -> DataFrame:
    """Readings at odd minutes, some without a value, as hourly series: collisions are resolved, gaps filled across day borders."""
    e = t.raw("events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"))
    points = to_full_hours(e, ["user_id"], "ts", ["value"], ["kind"], ["event_id"])
    grid = hourly_blocks(points, ["user_id"], "ts", ["value"], ["kind"], F.to_date("ts"))
    return grid.select("user_id", D.epoch(F.col("ts")).alias("slot"), "value", "kind")


@job("retained_events", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-16 09:30:00'")
def retained_events(t: Tables) -> DataFrame:
    """Events of a retention period: older date partitions dropped, only the border day written anew."""
    name = table_name("retained")
    rows = t.raw("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.to_date("ts").alias("day"))
    rows.repartition("day").write.partitionBy("day").saveAsTable(name)
    SK.retain_partitions(t.spark, name, "day", "ts", "2024-01-16 09:30:00")
    return t.spark.table(name).select("event_id", D.epoch(F.col("ts")).alias("ts"))


@job("invoice_report", """WITH b AS (SELECT rpad(CAST(invoice_id AS VARCHAR), 12, ' ') || ' | ' || lpad(CAST(total AS VARCHAR), 15, ' ') AS value, row_number() OVER (ORDER BY invoice_id, total) AS row FROM v_invoice)
SELECT 1 AS section, CAST(row AS BIGINT) AS row, value FROM b UNION ALL SELECT 0, row, value FROM (VALUES (1::BIGINT, 'INVOICES'), (2, repeat('=', 60)), (3, 'INVOICE_ID   | TOTAL          '), (4, repeat('-', 60))) h(row, value)
UNION ALL SELECT 2, 1, 'TOTAL total: ' || CAST(sum(total) AS VARCHAR) FROM v_invoice""")
def invoice_report(t: Tables) -> DataFrame:
    """Report over all invoices in ordered part files, read back with every line's place."""
    path = work_dir(t.spark, "report")
    SK.write_report(t.invoices.select(F.col("invoice_id"), "total"), path, "INVOICES", {"invoice_id": 12, "total": -15}, ["invoice_id", "total"], total="total")
    return SK.read_report(t.spark, path)

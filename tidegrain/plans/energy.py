"""Hourly energy pipeline: raw documents, cleaned tables, photovoltaic yield, star schema.

The raw documents are derived from the stored tables (clients from ``customer``, weather and price
payloads from ``events``), one small document per source row, with the faults the cleaning must handle.
"""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions import solar
from tidegrain.functions.numbers import default_out_of_range, half_even
from tidegrain.operators.ranking import first_per_key
from tidegrain.operators.series import hourly_grid, interpolate_positions
from tidegrain.operators.tables import upsert
from tidegrain.plans.registry import job
from tidegrain.sources.tables import Tables

# Parameters of the registered runs.
START, NOW, ZONE = "2024-01-01 00:00:00", "2024-01-16 00:00:00", "Europe/Madrid"

CLIENT_NUMBERS = ["latitude", "longitude", "nominal_load_kw", "pv_peak_power_kw", "panel_area_m2", "efficiency", "loss_pct", "angle", "aspect",
                  "battery_capacity_kwh", "soc_min_pct", "installation_cost_eur"]
CLIENT_TEXTS = ["client_id", "name", "description", "panel_type", "mounting", "timezone"]
CLIENT_COLUMNS = ["client_id", "name", "description", "latitude", "longitude", "timezone", "nominal_load_kw", "pv_peak_power_kw", "panel_area_m2", "efficiency",
                  "panel_type", "loss_pct", "angle", "aspect", "mounting", "battery_capacity_kwh", "soc_min_pct", "installation_cost_eur"]
PRICE_SCHEMA = "included array<struct<id:string,type:string,attributes:struct<values:array<struct<datetime:string,value:double,percentage:double>>>>>"
WEATHER_SCHEMA = ("list array<struct<dt_txt:string,main:struct<temp:double,humidity:double>,clouds:struct<all:double>,pop:double,wind:struct<speed:double>,"
                  "weather:array<struct<id:bigint,main:string,description:string>>,sys:struct<pod:string>>>")


# -- raw documents --------------------------------------------------------------------------------

def _client_key(k: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(k.cast("string"), 6, "0"))


def raw_clients(t: Tables) -> DataFrame:
    """Client master as text columns, with missing and impossible values and repeated ingestions."""
    c = t.raw("customer")
    k = F.col("c_custkey")
    base = c.select(
        F.when(k % 97 != 5, _client_key(k)).alias("client_id"),
        F.when(k % 53 == 7, "None").otherwise(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("name"),
        F.when(k % 2 == 0, F.col("c_mktsegment")).alias("description"),
        F.when(k % 101 == 3, F.lit(91.5)).otherwise(F.lit(30.0) + (k * 37 % 1500) / F.lit(100.0)).alias("latitude"),
        (F.lit(-10.0) + (k * 53 % 1400) / F.lit(100.0)).alias("longitude"),
        F.when(k % 8 != 0, F.lit("Europe/Madrid")).alias("timezone"),
        F.when(k % 5 != 0, F.lit(20.0) + k % 30).alias("nominal_load_kw"),
        F.when(k % 89 == 4, F.lit(0.0)).otherwise(F.lit(5.0) + k % 40).alias("pv_peak_power_kw"),
        F.when(k % 71 == 1, F.lit(-5.0)).otherwise(F.lit(10.0) + k % 90).alias("panel_area_m2"),
        F.when(k % 6 == 0, None).when(k % 13 == 1, F.lit(1.7)).otherwise(F.lit(0.15) + (k % 8) / F.lit(100.0)).alias("efficiency"),
        F.when(k % 4 == 1, "nan").when(k % 4 == 2, "mono").otherwise("poly").alias("panel_type"),
        F.when(k % 17 == 2, F.lit(95.0)).when(k % 11 == 3, None).otherwise(F.lit(10.0) + k % 8).alias("loss_pct"),
        F.when(k % 19 == 3, F.lit(150.0)).otherwise(F.lit(10.0) + k % 50).alias("angle"),
        (F.lit(0.0) + k * 29 % 361).alias("aspect"),
        F.when(k % 3 == 1, F.lit("roof")).alias("mounting"),
        F.when(k % 3 == 0, F.lit(0.0)).when(k % 31 == 2, F.lit(-1.0)).otherwise(F.lit(0.0) + k % 50).alias("battery_capacity_kwh"),
        F.when(k % 7 == 0, None).otherwise(F.lit(0.0) + k % 95).alias("soc_min_pct"),
        (F.lit(8000.0) + k * 3 % 20000).alias("installation_cost_eur"),
        F.lit(0).alias("again"), k.alias("k"),
    )
    again = base.where("k % 10 = 0").withColumn("pv_peak_power_kw", F.col("pv_peak_power_kw") + F.lit(1.0)).withColumn("again", F.lit(1))
    both = base.unionByName(again)
    stamp = F.timestamp_seconds(F.lit(1704067200) + (F.col("k") % 24) * 3600 + F.col("again") * 86400)
    return both.select(
        *CLIENT_TEXTS, *[F.col(c).cast("string").alias(c) for c in CLIENT_NUMBERS],
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("_ingested_at_utc"),
        F.concat(F.lit("clients_"), F.col("again").cast("string"), F.lit(".json")).alias("_source_file"),
    )


# Weather condition by event type (id, main, description).
CONDITIONS = {"click": (800, "Clear", "clear sky"), "view": (802, "Clouds", "scattered clouds"), "purchase": (500, "Rain", "light rain"),
              "error": (211, "Thunderstorm", "thunderstorm"), "signup": (804, "Clouds", "overcast clouds")}


def _condition(pos: int) -> Column:
    out = None
    for kind, values in CONDITIONS.items():
        v = F.lit(values[pos])
        out = F.when(F.col("event_type") == kind, v) if out is None else out.when(F.col("event_type") == kind, v)
    return out


def raw_weather(t: Tables) -> DataFrame:
    return weather_documents(t.raw("events"))


def weather_documents(events: DataFrame) -> DataFrame:
    """One forecast document per event: three-hour steps, some values missing, some times repeated."""
    e = F.col("event_id")
    slot = F.date_trunc("hour", F.col("ts").cast("timestamp"))

    def entry(hours: int, temp: Column, rain: Column) -> Column:
        at = slot + F.expr(f"INTERVAL {hours} HOUR")
        return F.struct(
            F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("dt_txt"),
            F.struct(temp.alias("temp"), (e * 17 % 101).cast("double").alias("humidity")).alias("main"),
            F.struct((e * 13 % 101).cast("double").alias("all")).alias("clouds"), rain.alias("pop"),
            F.struct(((e * 7 % 200) / F.lit(10.0)).alias("speed")).alias("wind"),
            F.array(F.struct(_condition(0).cast("bigint").alias("id"), _condition(1).alias("main"),
                             F.when(e % 7 == 0, F.upper(_condition(2))).otherwise(_condition(2)).alias("description"))).alias("weather"),
            F.struct(F.when(F.hour(at).between(6, 18), "d").otherwise("n").alias("pod")).alias("sys"),
        )

    temp, rain = F.lit(-5.0) + (e * 31 % 450) / F.lit(10.0), (e % 101) / F.lit(100.0)
    null = F.lit(None).cast("double")
    entries = F.array(
        entry(0, F.when(e % 11 == 0, null).otherwise(temp), rain), entry(3, temp + F.lit(1.0), F.when(e % 9 == 0, null).otherwise(rain)),
        entry(6, temp + F.lit(2.5), F.when(e % 13 == 0, null).otherwise(rain)),
    )
    entries = F.when(e % 5 == 0, F.concat(entries, F.array(entry(3, temp + F.lit(4.0), rain)))).otherwise(entries)
    client = _client_key(F.col("user_id"))
    return events.select(
        client.alias("client_id"), F.to_json(F.struct(entries.alias("list"))).alias("raw_data"),
        F.concat(F.lit("weather_"), client, F.lit("_"), e.cast("string"), F.lit(".json")).alias("_source_file"), F.col("ts").cast("timestamp").alias("_ingested_at_utc"),
    )


def raw_prices(t: Tables) -> DataFrame:
    """One price document per event: two series, local offset times, missing, extreme and malformed values."""
    e = F.col("event_id")
    local = F.date_trunc("hour", F.col("ts").cast("timestamp")) + F.expr("INTERVAL 1 HOUR")
    at = F.when(e % 60 == 11, F.lit("not a date")).otherwise(F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000+01:00")))
    value = F.when(e % 10 == 3, None).when(e % 50 == 7, F.lit(2500.0)).otherwise(F.lit(20.0) + (e * 37 % 2000) / F.lit(10.0))
    values = F.array(F.struct(at.alias("datetime"), value.alias("value"), F.lit(1.0).alias("percentage")))
    series = F.array(F.struct(F.lit("1001").alias("id"), F.when(e % 2 == 0, "PVPC").otherwise("SPOT").alias("type"), F.struct(values.alias("values")).alias("attributes")))
    return t.raw("events").select(
        F.to_json(F.struct(series.alias("included"))).alias("raw_data"), F.concat(F.lit("prices_"), e.cast("string"), F.lit(".json")).alias("_source_file"),
        F.col("ts").cast("timestamp").alias("_ingested_at_utc"),
    )


# -- cleaned tables -------------------------------------------------------------------------------

def faultless(df: DataFrame, faults: dict[str, Column], seen: Observation | None) -> DataFrame:
    """Rows without any of the named faults; ``seen`` counts all rows and those dropped, by first fault, in the same pass."""
    fault = F.coalesce(*(F.when(bad, F.lit(name)) for name, bad in faults.items()))
    marked = df.withColumn("_fault", fault)
    if seen is not None:
        counts = [F.count_if(F.col("_fault") == name).alias(name) for name in faults]
        marked = marked.observe(seen, F.count(F.lit(1)).alias("rows in"), *counts, F.count_if(F.col("_fault").isNull()).alias("valid"))
    return marked.where("_fault IS NULL").drop("_fault")


def silver_clients(raw: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Typed, validated, deduplicated (newest ingestion) and imputed client records."""
    text = {c: F.when(~F.col(c).isin("None", "nan", "NaN", "null"), F.col(c)) for c in CLIENT_TEXTS}
    df = raw.withColumns({**{c: F.col(c).try_cast("double") for c in CLIENT_NUMBERS}, **text,
                          "_ingested_at_utc": F.try_to_timestamp("_ingested_at_utc")})
    df = df.withColumns({"latitude": half_even(F.col("latitude"), 6), "longitude": half_even(F.col("longitude"), 6), "name": F.trim(F.upper("name"))})
    critical = ["client_id", "name", "latitude", "longitude", "pv_peak_power_kw", "_ingested_at_utc"]
    missing = F.greatest(*(F.col(c).isNull() | (F.isnan(c) if c in CLIENT_NUMBERS else F.lit(False)) for c in critical))
    df = faultless(df, {
        "missing field": missing, "coordinates out of range": F.expr("NOT (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)"), "no power": F.expr("NOT pv_peak_power_kw > 0")}, seen)
    df = df.withColumns({
        "angle": default_out_of_range(F.col("angle"), 0, 90, 30.0), "aspect": default_out_of_range(F.col("aspect"), 1, 360, 180.0),
        "loss_pct": default_out_of_range(F.col("loss_pct"), 0, 90, 14.0), "soc_min_pct": default_out_of_range(F.col("soc_min_pct"), 0, 90, 20.0),
        "efficiency": F.when(~F.col("efficiency").between(0, 1), F.lit(0.15)).otherwise(F.col("efficiency")),
        **{c: F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)) for c in ("panel_area_m2", "battery_capacity_kwh", "installation_cost_eur")},
    })
    df = first_per_key(df, ["client_id"], [F.col("_ingested_at_utc").desc(), F.col("_source_file").desc()])
    return df.withColumn("nominal_load_kw", F.coalesce("nominal_load_kw", F.col("pv_peak_power_kw") * F.lit(1.3))).na.fill({
        "description": "unknown", "panel_area_m2": 0.0, "efficiency": 0.15, "panel_type": "unknown", "mounting": "unknown",
        "battery_capacity_kwh": 0.0, "installation_cost_eur": 0.0, "timezone": "UTC",
    }).select(*CLIENT_COLUMNS, "_source_file", "_ingested_at_utc")


def silver_prices(raw: DataFrame, lo: float = -100, hi: float = 2000, seen: Observation | None = None) -> DataFrame:
    """Hourly prices: flatten, UTC, outliers out, newest ingestion per hour, linear fill, epoch key."""
    doc = raw.select("_source_file", "_ingested_at_utc", F.explode(F.from_json("raw_data", PRICE_SCHEMA)["included"]).alias("s"))
    rows = doc.select("_source_file", "_ingested_at_utc", F.col("s.type").alias("price_type"), F.explode("s.attributes.values").alias("v")).select(
        "price_type", F.try_to_timestamp(F.col("v.datetime")).alias("datetime_utc"), F.col("v.value").alias("price_euro_mwh"), "_source_file", "_ingested_at_utc")
    rows = faultless(rows, {"no time": F.col("datetime_utc").isNull(), "outlier": F.coalesce(~F.col("price_euro_mwh").between(lo, hi), F.lit(False))}, seen)
    rows = first_per_key(rows, ["price_type", "datetime_utc"], [F.col("_ingested_at_utc").desc(), F.col("_source_file").desc()])
    filled = interpolate_positions(rows, ["price_type"], "datetime_utc", "price_euro_mwh", F.to_date("datetime_utc"))
    return filled.withColumns({"price_euro_mwh": half_even(F.col("price_euro_mwh"), 4), "unix_time": D.epoch(F.col("datetime_utc"))})


WEATHER_NUMBERS = ["temp_celsius", "humidity_pct", "clouds_pct", "rain_prob_norm", "wind_speed_mps"]
WEATHER_LABELS = ["weather_id", "weather_main", "weather_description", "pod"]


def silver_weather(raw: DataFrame) -> DataFrame:
    """Hourly weather per document, then the newest document per client and hour.

    The resampling windows run inside one document (a bounded group), whatever a client's share of the table.
    """
    doc = raw.select("client_id", "_source_file", "_ingested_at_utc", F.posexplode(F.from_json("raw_data", WEATHER_SCHEMA)["list"]).alias("pos", "f"))
    w = F.try_element_at(F.col("f.weather"), F.lit(1))
    rows = doc.select(
        "client_id", "_source_file", "_ingested_at_utc", "pos", F.try_to_timestamp(F.col("f.dt_txt")).alias("forecast_time_utc"),
        F.col("f.main.temp").alias("temp_celsius"), F.col("f.main.humidity").alias("humidity_pct"), F.col("f.clouds.all").alias("clouds_pct"),
        F.col("f.pop").alias("rain_prob_norm"), F.col("f.wind.speed").alias("wind_speed_mps"),
        w["id"].alias("weather_id"), w["main"].alias("weather_main"), w["description"].alias("weather_description"), F.col("f.sys.pod").alias("pod"),
    ).where("client_id IS NOT NULL AND forecast_time_utc IS NOT NULL")
    # one shuffle by document serves both windows: repeated times, and the grid
    rows = rows.repartition("client_id", "_source_file")
    rows = first_per_key(rows, ["client_id", "_source_file", "forecast_time_utc"], [F.col("pos").desc()]).drop("pos")
    grid = hourly_grid(rows, ["client_id", "_source_file"], "forecast_time_utc", WEATHER_NUMBERS, WEATHER_LABELS)
    grid = grid.withColumns({**{c: half_even(F.col(c), 3) for c in WEATHER_NUMBERS}, "unix_time": D.epoch(F.col("forecast_time_utc")),
                             "is_daylight": F.when(F.col("pod") == "d", 1).otherwise(0).cast("bigint")})
    grid = grid.withColumn("rain_prob_norm", F.coalesce("rain_prob_norm", F.lit(0.0))).drop("pod")
    return first_per_key(grid, ["client_id", "unix_time"], [F.col("_ingested_at_utc").desc(), F.col("_source_file").desc()])


def active_silver(clients: DataFrame, weather: DataFrame, now: str) -> DataFrame:
    """Clients joined with the weather slots at or after ``now``."""
    active = weather.where(F.col("forecast_time_utc") >= F.lit(now).cast("timestamp")).drop("_source_file", "_ingested_at_utc")
    return active.join(clients.drop("_source_file", "_ingested_at_utc"), "client_id")


# -- staged layers --------------------------------------------------------------------------------

def clean_clients(t: Tables) -> DataFrame:
    return t.staged("clean_clients", lambda: silver_clients(raw_clients(t)))


def clean_prices(t: Tables) -> DataFrame:
    return t.staged("clean_prices", lambda: silver_prices(raw_prices(t)))


def clean_weather(t: Tables) -> DataFrame:
    return t.staged("clean_weather", lambda: silver_weather(raw_weather(t)))


def clean_calculations(t: Tables) -> DataFrame:
    return t.staged("clean_calculations", lambda: solar.pv_yield(active_silver(clean_clients(t), clean_weather(t), START)))


def dim_client(clients: DataFrame) -> DataFrame:
    """Client dimension with capability flags (full rebuild)."""
    def flag(c: str) -> Column:
        return F.when(F.coalesce(F.col(c), F.lit(0.0)) > 0, 1).otherwise(0).cast("bigint")

    return clients.select(*CLIENT_COLUMNS, flag("pv_peak_power_kw").alias("has_solar"), flag("battery_capacity_kwh").alias("has_battery"))


def dim_datetime(weather: DataFrame, zone: str = ZONE) -> DataFrame:
    """Calendar dimension of the distinct hours, with local clock, holiday and tariff attributes."""
    slots = weather.groupBy("unix_time").agg(F.max("is_daylight").alias("is_daylight"))
    utc = F.timestamp_seconds("unix_time")
    slots = slots.withColumns({"_u": utc, "_l": F.from_utc_timestamp(utc, zone)})
    u, local = F.col("_u"), F.col("_l")
    pattern = "yyyy-MM-dd HH:mm:ss"
    tariff = D.tariff_period(local)

    def flag(c: Column) -> Column:
        return F.when(c, 1).otherwise(0).cast("bigint")

    return slots.select(
        "unix_time", F.date_format(u, pattern).alias("datetime_utc"), F.date_format(local, pattern).alias("datetime_local"), F.to_date(u).alias("date"),
        F.hour(u).cast("bigint").alias("hour_utc"), F.hour(local).cast("bigint").alias("hour_local"), F.lower(F.date_format(local, "EEEE")).alias("day_of_week"), "is_daylight",
        flag(F.weekday(local) >= 5).alias("is_weekend"), flag(D.is_holiday(local)).alias("is_festivo"), D.month_of(local).alias("month"), D.year_of(local).alias("year"),
        tariff.alias("tariff_period"), D.tariff_label(tariff).alias("tariff_label"),
    )


def dim_weather(weather: DataFrame) -> DataFrame:
    """Weather dimension: the most frequent label pair of each condition id."""
    pairs = weather.where("weather_id IS NOT NULL").groupBy("weather_id", "weather_main", "weather_description").agg(F.count(F.lit(1)).alias("freq"))
    best = first_per_key(pairs, ["weather_id"], [F.col("freq").desc(), F.col("weather_main").asc(), F.col("weather_description").asc()])
    return best.select("weather_id", "weather_main", "weather_description")


FACT_COLUMNS = ["client_id", "unix_time", "forecast_time_utc", "pv_power_gen_kw", "pv_performance_ratio", "poa_wm2", "t_cell_celsius", "power_consumption_kw",
                "temp_celsius", "humidity_pct", "clouds_pct", "rain_prob_norm", "wind_speed_mps", "weather_id", "price_pvpc_eur_mwh", "_loaded_at_utc"]


def fact_rows(calc: DataFrame, weather: DataFrame, prices: DataFrame, start: str) -> DataFrame:
    """Rows of the active window with weather and the regulated price (left joins, price type filtered first)."""
    w = weather.select("client_id", "unix_time", *WEATHER_NUMBERS, "weather_id", "_ingested_at_utc")
    p = prices.where("price_type = 'PVPC'").select("unix_time", F.col("price_euro_mwh").alias("price_pvpc_eur_mwh"))
    loaded = F.date_trunc("minute", F.col("_ingested_at_utc") + F.expr("INTERVAL 10 MINUTE"))
    return (
        calc.where(F.col("unix_time") >= D.epoch(F.lit(start).cast("timestamp"))).join(w, ["client_id", "unix_time"], "left").join(p, "unix_time", "left")
        .withColumnRenamed("power_con_kw", "power_consumption_kw").withColumn("_loaded_at_utc", loaded).select(*FACT_COLUMNS)
    )


def gold_dim_client(t: Tables) -> DataFrame:
    return t.staged("gold_dim_client", lambda: dim_client(clean_clients(t)))


def gold_dim_datetime(t: Tables) -> DataFrame:
    return t.staged("gold_dim_datetime", lambda: dim_datetime(clean_weather(t)))


def gold_dim_weather(t: Tables) -> DataFrame:
    return t.staged("gold_dim_weather", lambda: dim_weather(clean_weather(t)))


# Files, and so write tasks, that a date of the fact is spread over.
FACT_FILES = 8


def fact_layout(rows: DataFrame) -> DataFrame:
    """Rows dealt by date and a hash of the client: slots are whole hours, so the time itself would give one value."""
    return rows.repartition("slot_date", F.pmod(F.xxhash64("client_id"), F.lit(FACT_FILES)))


def gold_fact(t: Tables) -> DataFrame:
    """Fact table in date partitions, so that reports on a day or month read only their partitions."""
    def build() -> DataFrame:
        rows = fact_rows(clean_calculations(t), clean_weather(t), clean_prices(t), START)
        return fact_layout(rows.withColumn("slot_date", F.to_date("forecast_time_utc")))

    return t.staged("gold_fact_energy_forecast", build, ("slot_date",)).select(*FACT_COLUMNS, F.col("slot_date").cast("date").alias("slot_date"))


# -- registered jobs ------------------------------------------------------------------------------

@job("silver_clients", "SELECT * FROM v_clean_client")
def job_clients(t: Tables) -> DataFrame:
    return silver_clients(raw_clients(t)).drop("_ingested_at_utc", "_source_file")


@job("silver_prices", "SELECT price_type, unix_time, price_euro_mwh FROM v_clean_price")
def job_prices(t: Tables) -> DataFrame:
    return silver_prices(raw_prices(t)).select("price_type", "unix_time", "price_euro_mwh")


@job("silver_weather", "SELECT * EXCLUDE (ing) FROM v_clean_weather")
def job_weather(t: Tables) -> DataFrame:
    return silver_weather(raw_weather(t)).drop("_ingested_at_utc", "_source_file", "forecast_time_utc")


@job("active_silver", "SELECT w.client_id, w.unix_time, c.name, w.temp_celsius, w.weather_id FROM v_clean_weather w JOIN v_clean_client c ON c.client_id = w.client_id WHERE w.unix_time >= 1705363200")
def job_active(t: Tables) -> DataFrame:
    return active_silver(clean_clients(t), clean_weather(t), NOW).select("client_id", "unix_time", "name", "temp_celsius", "weather_id")


@job("solar_position", "SELECT client_id, unix_time, round(elevation, 6) AS elevation, round(azimuth, 6) AS azimuth FROM v_irradiance")
def job_position(t: Tables) -> DataFrame:
    df = solar.solar_position(active_silver(clean_clients(t), clean_weather(t), START))
    return df.select("client_id", "unix_time", half_even(F.col("elevation"), 6).alias("elevation"), half_even(F.col("azimuth"), 6).alias("azimuth"))


@job("irradiance", "SELECT client_id, unix_time, round(ghi, 6) AS ghi, round(dni, 6) AS dni, round(dhi, 6) AS dhi, round(poa, 6) AS poa FROM v_irradiance")
def job_irradiance(t: Tables) -> DataFrame:
    """Global, direct, diffuse and panel-plane irradiance."""
    df = solar.solar_position(active_silver(clean_clients(t), clean_weather(t), START))
    df = solar.poa(solar.erbs(solar.ghi(df)))
    return df.select("client_id", "unix_time", *[half_even(F.col(c), 6).alias(c) for c in ("ghi", "dni", "dhi", "poa")])


@job("expected_load", "SELECT client_id, unix_time, power_con_kw FROM v_calc")
def job_load(t: Tables) -> DataFrame:
    df = solar.expected_load(active_silver(clean_clients(t), clean_weather(t), START))
    return df.select("client_id", "unix_time", half_even(F.col("p_con"), 3).alias("power_con_kw"))


@job("pv_yield", "SELECT * FROM v_calc")
def job_yield(t: Tables) -> DataFrame:
    """Cell temperature, irradiance, power, performance ratio and load per client and hour."""
    return solar.pv_yield(active_silver(clean_clients(t), clean_weather(t), START)).drop("forecast_time_utc")


@job("dim_client", "SELECT * FROM v_dim_client")
def job_dim_client(t: Tables) -> DataFrame:
    return dim_client(clean_clients(t))


@job("dim_datetime", "SELECT * FROM v_dim_datetime")
def job_dim_datetime(t: Tables) -> DataFrame:
    return dim_datetime(clean_weather(t))


@job("dim_weather", "SELECT * FROM v_dim_weather")
def job_dim_weather(t: Tables) -> DataFrame:
    return dim_weather(clean_weather(t))


@job("fact_energy", "SELECT * FROM v_fact")
def job_fact(t: Tables) -> DataFrame:
    """Stored fact with the active window (two hours back) computed again and upserted by key."""
    window = fact_rows(clean_calculations(t), clean_weather(t), clean_prices(t), "2024-01-15 22:00:00")
    stored = gold_fact(t).select(*FACT_COLUMNS)
    return upsert(stored, window, ["client_id", "unix_time"]).drop("forecast_time_utc").withColumn("_loaded_at_utc", D.epoch(F.col("_loaded_at_utc")))


@job("run_summary", """WITH s AS (SELECT l_orderkey AS run_id, l_linenumber AS stage, struct_pack(p := l_partkey, s := l_suppkey, q := l_quantity) AS o, l_returnflag <> 'R' AS ok, CAST(l_quantity AS BIGINT) AS n FROM lineitem),
f AS (SELECT run_id, stage, min(struct_pack(o := o, ok := ok)) AS first FROM s GROUP BY 1, 2), st AS (SELECT run_id, min(stage) AS stop FROM f WHERE NOT first.ok GROUP BY 1),
x AS (SELECT s.*, st.stop FROM s LEFT JOIN st ON s.run_id = st.run_id JOIN f ON f.run_id = s.run_id AND f.stage = s.stage WHERE st.stop IS NULL OR s.stage < st.stop OR (s.stage = st.stop AND s.o = f.first.o AND NOT s.ok))
SELECT run_id, CASE WHEN max(stop) IS NOT NULL THEN 'FAILED AT STAGE ' || max(stop) WHEN count(CASE WHEN NOT ok THEN 1 END) > 0 THEN 'PARTIAL SUCCESS' ELSE 'SUCCESS' END AS status,
count(CASE WHEN ok THEN 1 END) AS steps_ok, count(CASE WHEN NOT ok THEN 1 END) AS steps_failed, CAST(coalesce(sum(CASE WHEN ok THEN n END), 0) AS BIGINT) AS rows_affected FROM x GROUP BY 1""")
def run_summary(t: Tables) -> DataFrame:
    """Status of each run from its step results.

    A run stops at the first stage whose first step fails; other failures give a partial success.
    Everything is aggregation (first step per stage, first failing stage, totals), so a long run needs no window.
    """
    steps = t.raw("lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("stage"), F.struct("l_partkey", "l_suppkey", "l_quantity").alias("o"),
        (F.col("l_returnflag") != "R").alias("ok"), F.col("l_quantity").cast("bigint").alias("n"))
    per = steps.groupBy("run_id", "stage").agg(
        F.min(F.struct("o", "ok"))["ok"].alias("first_ok"), F.count(F.lit(1)).alias("steps"), F.count(F.when(F.col("ok"), 1)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).alias("rows"))
    stops = per.where(~F.col("first_ok")).groupBy("run_id").agg(F.min("stage").alias("stop"))
    full = F.coalesce(F.col("stage") < F.col("stop"), F.lit(True))
    at_stop = F.coalesce(F.col("stage") == F.col("stop"), F.lit(False))
    zero = F.lit(0).cast("bigint")
    g = per.join(stops, "run_id", "left").groupBy("run_id").agg(
        F.max("stop").alias("stop"), F.sum(F.when(full, F.col("good")).otherwise(zero)).alias("steps_ok"),
        F.sum(F.when(full, F.col("steps") - F.col("good")).when(at_stop, F.lit(1)).otherwise(zero)).cast("bigint").alias("steps_failed"),
        F.sum(F.when(full, F.col("rows")).otherwise(zero)).alias("rows_affected"))
    status = F.when(F.col("stop").isNotNull(), F.concat(F.lit("FAILED AT STAGE "), F.col("stop").cast("string"))).when(F.col("steps_failed") > 0, "PARTIAL SUCCESS").otherwise("SUCCESS")
    return g.select("run_id", status.alias("status"), "steps_ok", "steps_failed", "rows_affected")

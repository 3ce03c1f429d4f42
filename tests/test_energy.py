"""Energy pipeline properties: cleaning fixtures, solar scenario bounds, calendar with clock changes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidegrain.functions import solar
from tidegrain.plans import energy as E


def scenario(spark, **over):
    row = dict(client_id="C", unix_time=int(dt.datetime(2026, 5, 1, 15, tzinfo=dt.timezone.utc).timestamp()), forecast_time_utc=dt.datetime(2026, 5, 1, 15), latitude=42.803852, longitude=-1.701962,
               pv_peak_power_kw=16.0, loss_pct=14.0, angle=30.0, aspect=180.0, nominal_load_kw=16.0, clouds_pct=82.0, weather_id=803, temp_celsius=20.29, wind_speed_mps=5.54) | over
    types = {str: "string", int: "bigint", float: "double", dt.datetime: "timestamp"}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in row.items()))


def test_reference_scenario_bounds(spark):
    df = scenario(spark)
    p = solar.solar_position(df).first()
    assert 30 <= p["elevation"] <= 60 and 180 <= p["azimuth"] <= 270
    y = solar.pv_yield(df).first()
    assert 1 <= y["pv_power_gen_kw"] <= 10 and 0.5 <= y["pv_performance_ratio"] <= 1.0


@pytest.mark.parametrize("hour,lat,expected,tol", [(12, 51.4779, 61.96, 0.5), (0, 51.4779, -15.1, 0.6)])
def test_known_elevations_at_greenwich_solstice(spark, hour, lat, expected, tol):
    at = int(dt.datetime(2024, 6, 20, hour, 2, tzinfo=dt.timezone.utc).timestamp())
    assert abs(solar.solar_position(scenario(spark, unix_time=at, latitude=lat, longitude=0.0)).first()["elevation"] - expected) < tol


def test_night_gives_no_power(spark):
    at = int(dt.datetime(2026, 5, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    y = solar.pv_yield(scenario(spark, unix_time=at, forecast_time_utc=dt.datetime(2026, 5, 1, 1))).first()
    assert (y["pv_power_gen_kw"], y["poa_wm2"], y["pv_performance_ratio"], y["t_cell_celsius"]) == (0.0, 0.0, 0.0, 20.29)
    assert y["power_con_kw"] == 1.6  # night shift: ten per cent of the nominal load


def test_worse_weather_gives_less(spark):
    outs = [solar.pv_yield(scenario(spark, weather_id=w, clouds_pct=50.0)).first()["pv_power_gen_kw"] for w in (800, 802, 804, 500, 211)]
    assert outs == sorted(outs, reverse=True) and outs[-1] > 0


def client(**over):
    return {c: None for c in E.CLIENT_TEXTS + E.CLIENT_NUMBERS} | dict(client_id="C1", name=" one ", latitude="40.1234567", longitude="-3", pv_peak_power_kw="10", angle="20", aspect="90",
                                                                      _ingested_at_utc="2024-01-01 00:00:00", _source_file="f") | over


def test_client_cleaning(spark):
    raw = [client(), client(client_id="C2", name="None"), client(client_id="C3", latitude="91"), client(client_id="C4", pv_peak_power_kw="0"), client(client_id="C5", angle="150", aspect="0", panel_type="nan", efficiency="7"),
           client(client_id="C6", pv_peak_power_kw="5"), client(client_id="C6", pv_peak_power_kw="8", _ingested_at_utc="2024-01-02 00:00:00"), client(client_id="C7", latitude="abc")]
    cols = list(raw[0])
    out = {r["client_id"]: r for r in E.silver_clients(spark.createDataFrame([tuple(r[c] for c in cols) for r in raw], ", ".join(f"{c} string" for c in cols))).collect()}
    assert set(out) == {"C1", "C5", "C6"}
    assert (out["C1"]["name"], out["C1"]["latitude"], out["C1"]["nominal_load_kw"], out["C1"]["timezone"]) == ("ONE", 40.123457, 13.0, "UTC")
    assert (out["C5"]["angle"], out["C5"]["aspect"], out["C5"]["panel_type"], out["C5"]["efficiency"]) == (30.0, 180.0, "unknown", 0.15)
    assert out["C6"]["pv_peak_power_kw"] == 8.0


def test_price_cleaning(spark):
    def doc(hours):
        return json.dumps({"included": [{"id": "1001", "type": "PVPC", "attributes": {"values": [{"datetime": d, "value": v, "percentage": 1} for d, v in hours]}}]})

    a = doc([("2024-01-01T00:00:00.000+01:00", None), ("2024-01-01T01:00:00.000+01:00", 10.0), ("2024-01-01T02:00:00.000+01:00", None), ("2024-01-01T03:00:00.000+01:00", 20.0), ("2024-01-01T04:00:00.000+01:00", 2500.0),
             ("bad", 1.0), ("2024-01-01T05:00:00.000+01:00", None)])
    b = doc([("2024-01-01T03:00:00.000+01:00", 30.0)])
    raw = spark.createDataFrame([(a, "a", dt.datetime(2024, 1, 1)), (b, "b", dt.datetime(2024, 1, 2))], "raw_data string, _source_file string, _ingested_at_utc timestamp")
    out = [(r["unix_time"] - 1704063600, r["price_euro_mwh"]) for r in E.silver_prices(raw).orderBy("unix_time").collect()]
    assert out == [(0, 10.0), (3600, 10.0), (7200, 20.0), (10800, 30.0), (18000, 30.0)]


def test_calendar_knows_clock_changes(spark):
    hours = [dt.datetime(2026, 3, 29, 0), dt.datetime(2026, 3, 29, 1), dt.datetime(2026, 10, 25, 0), dt.datetime(2026, 10, 25, 1), dt.datetime(2026, 12, 25, 11)]
    df = spark.createDataFrame([(int(h.replace(tzinfo=dt.timezone.utc).timestamp()), 1) for h in hours], "unix_time bigint, is_daylight bigint")
    got = [(r["hour_local"], r["is_festivo"], r["tariff_period"]) for r in E.dim_datetime(df).orderBy("unix_time").collect()]
    assert [g[0] for g in got] == [1, 3, 2, 2, 12] and got[-1][1:] == (1, "P6")


def test_empty_input_gives_empty_output(spark):
    raw = spark.createDataFrame([], "raw_data string, _source_file string, _ingested_at_utc timestamp, client_id string")
    assert E.silver_weather(raw).count() == 0 and E.silver_prices(raw.drop("client_id")).count() == 0


def test_mode_breaks_ties_by_label(spark, rows):
    df = spark.createDataFrame([(800, "Clear", "b"), (800, "Clear", "a"), (500, "Rain", "x"), (None, "?", "?")], "weather_id bigint, weather_main string, weather_description string")
    assert rows(E.dim_weather(df)) == [(500, "Rain", "x"), (800, "Clear", "a")]


def test_fact_keeps_rows_without_price(spark):
    ts = dt.datetime(2024, 1, 1)
    calc = spark.createDataFrame([("C", 1704067200, ts, 1.0, 0.8, 1.0, 1.0, 1.0)], "client_id string, unix_time bigint, forecast_time_utc timestamp, pv_power_gen_kw double, pv_performance_ratio double, poa_wm2 double, t_cell_celsius double, power_con_kw double")
    w = spark.createDataFrame([("C", 1704067200, 1.0, 1.0, 1.0, 0.0, 1.0, 800, ts)], ", ".join(["client_id string", "unix_time bigint", *[f"{c} double" for c in E.WEATHER_NUMBERS], "weather_id bigint", "_ingested_at_utc timestamp"]))
    p = spark.createDataFrame([("SPOT", 1704067200, 5.0)], "price_type string, unix_time bigint, price_euro_mwh double")
    row = E.fact_rows(calc, w, p, "2024-01-01 00:00:00").select(F.col("price_pvpc_eur_mwh")).first()
    assert row[0] is None


def test_no_weather_id_means_no_yield(spark):
    row = solar.pv_yield(scenario(spark, clouds_pct=50.0).withColumn("weather_id", F.lit(None).cast("bigint"))).first()
    assert row["pv_power_gen_kw"] == 0.0 and row["poa_wm2"] == 0.0


def test_daytime_rules_count_daytime_rows(spark):
    from tidegrain.operators import quality as Q
    from tidegrain.plans.quality import CALC_RULES

    day, night = (500.0, 5.0, 0.8, 1.0, 4.0), (0.0, 0.0, 0.0, 1.0, 4.0)
    df = spark.createDataFrame([day] + [night] * 98 + [(500.0, 1.0, 0.8, 1.0, 4.0)], "poa_wm2 double, pv_power_gen_kw double, pv_performance_ratio double, power_con_kw double, pv_peak_power_kw double")
    got = {r["rule_id"]: (r["total"], r["failed"]) for r in Q.run_rules(df, CALC_RULES).collect()}
    assert got == {"DQ-S015": (100, 0), "DQ-S016": (2, 1), "DQ-S017": (2, 0), "DQ-S018": (100, 0)}


def test_a_date_of_the_fact_is_dealt_to_several_write_tasks(spark):
    from tidegrain.sources.tables import Tables

    plan = E.fact_layout(E.gold_fact(Tables(spark, "/root/testdata/sf0.001")))
    parts = plan.select("slot_date", F.pmod(F.xxhash64("client_id"), F.lit(E.FACT_FILES)).alias("p")).distinct().groupBy("slot_date").count()
    assert parts.agg(F.min("count")).first()[0] > 1

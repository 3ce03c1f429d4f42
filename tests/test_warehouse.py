"""Catalog tables, buckets, numbered loads, copies, retention, long reports, off-hour series."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from tidegrain.operators.series import hourly_blocks, hourly_grid, to_full_hours
from tidegrain.plans import warehouse as WH
from tidegrain.sources import readers as RD
from tidegrain.sources import sinks as SK
from tidegrain.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_declared_table_takes_columns_by_name_and_is_left_alone(spark, tmp_path, rows):
    SK.declare_table(spark, "t_declared", "a INT, b STRING", f"file://{tmp_path}/t")
    SK.insert_into(spark.createDataFrame([("x", 1)], "b string, a int"), "t_declared")
    SK.declare_table(spark, "t_declared", "a INT, b STRING", f"file://{tmp_path}/t")
    SK.ctas_if_absent(spark.createDataFrame([(9, "z")], "a int, b string"), "t_declared")
    SK.insert_into(spark.createDataFrame([("y", 2)], "b string, a int"), "t_declared")
    assert rows(RD.read_table(spark, "t_declared", ["a", "b"])) == [(1, "x"), (2, "y")]
    SK.overwrite_table(spark.createDataFrame([(7, "n")], "a int, b string"), "t_declared", f"file://{tmp_path}/t")
    assert rows(spark.table("t_declared")) == [(7, "n")]


def test_audit_rows_are_appended(spark, tmp_path, rows):
    row = {"pipeline_name": "p", "status": "SUCCESS", "duration_seconds": 1.5, "rows_affected": 3, "error_message": None, "env": "DEV", "executed_at": dt.datetime(2024, 1, 1)}
    for n in (1, 2):
        SK.append_audit(spark, "t_audit", {**row, "rows_affected": n}, f"file://{tmp_path}/a")
    assert rows(spark.table("t_audit"), "pipeline_name", "rows_affected") == [("p", 1), ("p", 2)]


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    t = Tables(spark, FOLDER)
    fact, dim = WH.bucketed_clients(t)
    p = plan(WH.energy_by_client(t, fact, dim))
    assert "SortMergeJoin" in p and "Exchange" not in p
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # shows the buckets in the plan
    one = plan(spark.table(fact).where("client_id = 'C000017'"))
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert re.search(r"SelectedBucketsCount: 1 out of 8", one)


def test_numbers_go_on_over_loads(spark, tmp_path, rows):
    def load(i, keys):
        return SK.append_numbered(spark.createDataFrame([(k, k * 10) for k in keys], "k long, v long").repartition(3), ["k"], "no", f"{tmp_path}/n", i)

    load(1, [5, 3, 9])
    want = [(1, 4, 2), (3, 1, 1), (4, 5, 2), (5, 2, 1), (9, 3, 1)]
    for _ in range(2):
        assert rows(load(2, [1, 4, 5, 9]), "k", "no", "load") == want
    assert rows(load(3, [9]), "k", "no", "load") == want  # nothing new
    assert rows(load(4, [0]), "k", "no", "load") == sorted([*want, (0, 6, 4)])


def test_copy_is_compared_by_content(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, None, "x"), (3, "c", "y")], "k int, v string, p string")
    assert rows(SK.copy_to_store(df, f"{tmp_path}/s", "p")) == [("x", 3, 3, True), ("y", 1, 1, True)]
    a, b = SK.manifest(df, "p"), SK.manifest(df.repartition(4).withColumn("v", F.when(F.col("k") == 3, "d").otherwise(F.col("v"))), "p")
    same = rows(a.join(b, "p").select("p", a["checksum"] == b["checksum"]))
    assert same == [("x", True), ("y", False)]


def test_retention_keeps_the_files_of_newer_days(spark, rows):
    name = WH.table_name("t_retain")
    data = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(96)]
    spark.createDataFrame(data, "i int, t timestamp").withColumn("day", F.to_date("t")).repartition("day").write.partitionBy("day").saveAsTable(name)

    def files():
        return {f: os.path.getmtime(f.removeprefix("file:")) for f in spark.table(name).inputFiles() for f in ["/" + f.removeprefix("file:").lstrip("/")]}

    before = files()
    SK.retain_partitions(spark, name, "day", "t", "2024-01-02 09:30:00")
    spark.catalog.refreshTable(name)
    after = files()
    assert rows(spark.table(name).select("i")) == [(i,) for i in range(34, 96)]
    newer = [f for f in before if "day=2024-01-03" in f or "day=2024-01-04" in f]
    assert newer and all(after[f] == before[f] for f in newer)
    assert not any("day=2024-01-01" in f for f in after) and not any(f in before for f in after if "day=2024-01-02" in f)
    SK.retain_partitions(spark, name, "day", "t", "2024-01-04 00:00:00")
    assert rows(spark.table(name).select("i")) == [(i,) for i in range(72, 96)]


def test_report_parts_make_up_the_report(spark, tmp_path):
    df = spark.range(5000).repartition(6).selectExpr("id AS k", "CAST(id AS DECIMAL(10,2)) AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    SK.write_report(df, f"{tmp_path}/r", "TITLE", {"k": 8, "v": -10}, ["k"], total="v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    text = ""
    for section in ("section=0", "section=1", "section=2"):
        names = sorted(n for n in os.listdir(f"{tmp_path}/r/{section}") if n.startswith("part-"))
        assert section != "section=1" or len(names) > 1
        text += "".join(open(f"{tmp_path}/r/{section}/{n}").read() for n in names)
    lines = text.splitlines()
    assert lines[0] == "TITLE" and lines[4:5004] == [f"{k:<8} | {f'{k}.00':>10}" for k in range(5000)] and lines[5004:] == ["TOTAL v: 12497500.00"]
    got = SK.read_report(spark, f"{tmp_path}/r").orderBy("section", "row").collect()
    assert [r["value"] for r in got] == lines


def test_points_off_the_hour(spark, rows):
    h = lambda x: dt.datetime(2024, 1, 1) + dt.timedelta(hours=x)
    points = [(1, h(0.2), 2.0, "a"), (1, h(0.9), 4.0, None), (1, h(3.5), None, "b"), (1, h(26.1), 29.0, None), (2, h(5.99), 1.0, None)]
    df = spark.createDataFrame(points, "k int, t timestamp, v double, s string")
    full = to_full_hours(df, ["k"], "t", ["v"], ["s"])
    assert rows(full) == sorted([(1, h(0), 3.0, "a"), (1, h(26), 29.0, None), (1, h(3), None, "b"), (2, h(5), 1.0, None)], key=repr)
    got = rows(hourly_blocks(full, ["k"], "t", ["v"], ["s"], F.to_date("t")))
    assert got == sorted([*[(1, h(i), 3.0 + i, "a" if i < 3 else "b") for i in range(27)], (2, h(5), 1.0, None)], key=repr)


@pytest.mark.parametrize("hours", [3, 24, 1000])
def test_blocks_do_not_change_the_grid(spark, rows, hours):
    points = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=(k + 3) * i), None if (i * k) % 4 == 1 else float(i * i % 17), None if i % 5 else f"s{i}") for k in (1, 2, 3) for i in range(40)]
    df = spark.createDataFrame(points, "k int, t timestamp, v double, s string")
    block = F.floor(F.unix_timestamp("t") / (3600 * hours))
    assert rows(hourly_blocks(df, ["k"], "t", ["v"], ["s"], block)) == rows(hourly_grid(df, ["k"], "t", ["v"], ["s"]))

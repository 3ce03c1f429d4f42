"""File shapes, tables, landing zone, ledger, reports, streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidegrain.sources import readers as RD
from tidegrain.sources import sinks as SK
from tidegrain.streaming import jobs as ST


def test_json_and_xml_and_html(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "x", "v": 1}, {"id": "y"}]))
    (tmp_path / "t.json").write_text(json.dumps([["ann", "sql", "1"], ["bob", "sql"]]))
    assert rows(RD.read_json_array(spark, f"{tmp_path}/a.json", "id string, v int")) == [("x", 1), ("y", None)]
    assert rows(RD.read_json_tuples(spark, f"{tmp_path}/t.json", ["n", "c", "r"]), "n", "c", "r") == [("ann", "sql", "1"), ("bob", "sql", None)]
    raw = RD.read_raw(spark, f"{tmp_path}/a.json").first()
    assert raw["raw_data"].startswith("[") and raw["_source_file"].endswith("a.json")
    xml = spark.createDataFrame([("<a><count>3</count><b><count>4</count></b></a>",)], "d string")
    assert rows(RD.xml_values(xml, "d", "//count/text()")) == [("3",), ("4",)]
    html = spark.createDataFrame([('<p><span class="x">12</span><spanner>9</spanner><span>3</span></p>',)], "h string")
    assert rows(RD.html_tag_values(html, "h", "span")) == [("12",), ("3",)]


def test_short_csv_rows_are_skipped(spark, tmp_path, rows):
    (tmp_path / "x.csv").write_text("a,b,c,1,2,3,g\nshort,row\nd,e,f,4,5,6,\n")
    assert rows(RD.read_csv_positional(spark, f"{tmp_path}/x.csv", RD.TRACK_CSV_SCHEMA), "name", "length", "genre") == [("a", 3, "g"), ("d", 6, None)]


def test_client_export(spark, tmp_path, rows):
    (tmp_path / "c.csv").write_text("client_id,name,angle\nC1,One,nan\nC2,,5\n")
    assert rows(RD.read_clients(spark, f"{tmp_path}/c.csv", "client_id string, name string, angle string")) == [("C1", "One", None), ("C2", None, "5")]


def test_tables(spark, rows):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    SK.overwrite_table(df, "t_main")
    SK.ctas_if_absent(df.withColumn("v", F.lit("zzz")), "t_main")
    SK.insert_into(spark.createDataFrame([("b", 2)], "v string, k int"), "t_main")
    assert rows(RD.read_table(spark, "t_main", ["k", "v"])) == [(1, "a"), (2, "b")]
    frozen = SK.freeze(spark.table("t_main"), "t_frozen")
    SK.overwrite_table(spark.createDataFrame([(9, "z")], "k int, v string"), "t_main")
    assert frozen.count() == spark.table("t_frozen").count() == 2
    SK.append_audit(spark, "etl_metadata", dict(pipeline_name="p", status="SUCCESS", duration_seconds=1.5, rows_affected=3, error_message=None, env="dev", executed_at=dt.datetime(2024, 1, 1)))
    assert spark.table("etl_metadata").count() == 1


def test_ledger_retries_errors(spark, rows):
    files = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "c")], "source string, path string")
    ledger = SK.ledger_update(SK.ledger_add(files, "2024-01-01 00:00:00"), spark.createDataFrame([("a", None), ("b", "boom")], "path string, error string"), "2024-01-01 01:00:00")
    assert rows(ledger, "path", "status", "error") == [("a", "success", None), ("b", "error", "boom"), ("c", "pending", None)]
    assert rows(SK.ledger_actionable(ledger), "path") == [("b",), ("c",)]
    done = SK.ledger_update(ledger, spark.createDataFrame([("b", None)], "path string, error string"), "2024-01-01 02:00:00")
    assert rows(done.where("path = 'b'"), "status", "error") == [("success", None)]


def test_report_has_header_body_and_total(spark, tmp_path):
    df = spark.createDataFrame([("Spain", 2.5), ("Chile", 10.0)], "country string, total double")
    SK.write_report(df, f"{tmp_path}/r", "SALES", {"country": 10, "total": -8}, [F.col("total").desc()], total="total")
    lines = [r[0] for r in spark.read.text(f"{tmp_path}/r").collect()]
    assert lines[0] == "SALES" and lines[4] == "Chile      |     10.0" and lines[-1] == "TOTAL total: 12.50"


def test_partition_upsert_is_repeatable_and_keeps_the_newest(spark, tmp_path, rows):
    schema = "k bigint, v bigint, d date"
    table = ST.PartitionedTable(spark, f"{tmp_path}/t", ["k"], ("d", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("k") % 2).cast("int"))), schema)

    def frame(data):
        return spark.createDataFrame(data, "k bigint, v bigint")

    table.merge(frame([(1, 1), (2, 2), (3, 3)]), 0, ["v"])
    for _ in range(2):
        table.merge(frame([(2, 20), (2, 10), (4, 4)]), 1, ["v"])
        assert rows(table.read(), "k", "v") == [(1, 1), (2, 20), (3, 3), (4, 4)]
    table.merge(frame([(2, 5), (3, 9)]), 2, ["v"])  # 5 is older than 20
    assert rows(table.read(), "k", "v") == [(1, 1), (2, 20), (3, 9), (4, 4)]


def test_an_unreadable_table_is_an_error_not_an_empty_one(spark, tmp_path):
    table = ST.PartitionedTable(spark, f"{tmp_path}/t", ["k"], ("d", F.lit(dt.date(2024, 1, 1))), "k bigint, d date")
    assert table.read().collect() == []
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        table.merge(spark.createDataFrame([(1,)], "k bigint"), 0, ["k"])


def test_an_earlier_breach_in_a_later_batch_counts(spark, tmp_path, rows):
    t0 = dt.datetime(2024, 1, 1)
    hour = lambda h: t0 + dt.timedelta(hours=h)
    for i, data in enumerate([[(1, hour(3), 5.0), (1, hour(4), 12.0)], [(1, hour(1), 11.0), (1, hour(0), 1.0)]]):
        spark.createDataFrame(data, "k int, t timestamp, v double").coalesce(1).write.parquet(f"{tmp_path}/in/part={i}")
        src = spark.readStream.schema("k int, t timestamp, v double").parquet(f"{tmp_path}/in/part=*")
        out = ST.first_breach(src, "k", "t", F.col("v") > 10, f"{tmp_path}/out")
    assert rows(out, "k", "v") == [(1, 1.0), (1, 11.0)]


def test_stream_in_two_runs_reads_each_file_once(spark, tmp_path, rows):
    def land(i, data):
        spark.createDataFrame(data, "k int, t timestamp, v double").coalesce(1).write.parquet(f"{tmp_path}/in/part={i}")

    def run():
        src = spark.readStream.schema("k int, t timestamp, v double").parquet(f"{tmp_path}/in/part=*")
        return ST.first_breach(src, "k", "t", F.col("v") > 10, f"{tmp_path}/out")

    t0 = dt.datetime(2024, 1, 1)
    land(0, [(1, t0, 5.0), (1, t0 + dt.timedelta(hours=1), 11.0), (1, t0 + dt.timedelta(hours=2), 1.0), (2, t0, 1.0)])
    assert rows(run(), "k", "v") == [(1, 11.0), (1, 5.0), (2, 1.0)]
    land(1, [(1, t0 + dt.timedelta(hours=3), 2.0), (2, t0 + dt.timedelta(hours=3), 3.0)])
    assert rows(run(), "k", "v") == [(1, 11.0), (1, 5.0), (2, 1.0), (2, 3.0)]


def test_corrupt_documents_are_kept_apart(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"x": 1}\n{"x": \n')
    out = ST.run_append(ST.stream_landing(spark, f"{tmp_path}/in", "x int"), f"{tmp_path}/o")
    assert rows(out.select("x", F.col("_corrupt").isNotNull())) == [(1, False), (None, True)]

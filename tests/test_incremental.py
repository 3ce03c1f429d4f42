"""Loads over several runs: changed keys, late rows, the ledger's states, counts of dropped rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidegrain.plans import energy as E
from tidegrain.sources import sinks as SK
from tidegrain.sources.tables import Tables
from tidegrain.streaming import jobs as S

FOLDER = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 1)


def files(path):
    path = path.removeprefix("file://")
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def table(spark, path):
    return S.PartitionedTable(spark, path, ["k", "t"], ("d", F.to_date("t")), "k bigint, t timestamp, v double, seen timestamp, d date")


def frame(spark, rows):
    return spark.createDataFrame([(k, DAY + dt.timedelta(hours=h), v, DAY + dt.timedelta(hours=s)) for k, h, v, s in rows], "k bigint, t timestamp, v double, seen timestamp")


def test_a_batch_changes_only_what_it_touches(spark, tmp_path, rows):
    t = table(spark, f"{tmp_path}/t")
    t.merge(frame(spark, [(1, 1, 1.0, 0), (2, 2, 2.0, 9), (1, 30, 3.0, 0)]), 0, ["seen"])
    before = files(f"{tmp_path}/t/d=2024-01-02")
    batch = frame(spark, [(1, 1, 10.0, 5), (2, 2, 20.0, 5), (3, 3, 30.0, 5)])  # the second is older than the stored row
    for _ in range(2):
        changed = t.merge_changed(batch, 1, ["seen"])
        assert rows(changed, "k", "v") == [(1, 10.0), (3, 30.0)]
        assert rows(t.read(), "k", "v") == [(1, 10.0), (1, 3.0), (2, 2.0), (3, 30.0)]
    assert before and files(f"{tmp_path}/t/d=2024-01-02") == before


def test_recomputed_window_keeps_untouched_partitions(spark, tmp_path, monkeypatch):
    """A delivery of one day's documents leaves the fact files of days it has no keys for."""
    kept = []
    run = S.run_deliveries

    def two(deliveries, out, step):
        events = S.stored_events(spark, FOLDER, "events")
        late = F.to_date("ts") == dt.date(2024, 1, 28)

        def watched(batch, i):
            old = files(f"{out}/fact")
            step(batch, i)
            if i:
                new = files(f"{out}/fact")
                kept.append([f for f in old if new.get(f) == old[f]])
                assert all("slot_date=2024-01-28" in f or "slot_date=2024-01-29" in f for f in new if new[f] != old.get(f))

        run([events.where(~late), events.where(late)], out, watched)

    monkeypatch.setattr(S, "run_deliveries", two)
    want = entry.queries()["stream_window_recompute"](spark, FOLDER)
    assert want.count() > 0 and kept and any("slot_date=2024-01-20" in f for f in kept[0])


def test_rows_behind_the_buffer_are_kept_and_counted(spark, tmp_path, rows):
    out, t = f"{tmp_path}/o", table(spark, f"{tmp_path}/t")
    step = S.on_time_load(spark, "t", "2 HOURS", t, ["seen"], out)
    first = frame(spark, [(1, 1, 1.0, 0), (1, 10, 2.0, 0)])
    second = frame(spark, [(2, 8, 3.0, 0), (2, 7, 4.0, 0), (2, 12, 5.0, 0)])  # two hours behind 10 is on time, three are not
    step(first, 0)
    for _ in range(2):  # a repeated batch decides alike
        step(second, 1)
        assert rows(t.read(), "k", "v") == [(1, 1.0), (1, 2.0), (2, 3.0), (2, 5.0)]
        assert rows(spark.read.parquet(f"{out}/late/batch=*"), "k", "v") == [(2, 4.0)]
        assert rows(spark.read.parquet(f"{out}/marks"), "batch", "rows", "late") == [(0, 2, 0), (1, 3, 1)]


def test_deliveries_are_batches(spark, tmp_path):
    seen = []
    parts = [spark.range(10).repartition(7), spark.range(0), spark.range(3)]
    S.run_deliveries(parts, f"{tmp_path}/o", lambda batch, i: seen.append(batch.count()))
    assert [n for n in seen if n] == [10, 3]


def test_ledger_parks_and_restarts(spark, tmp_path, rows):
    path = f"{tmp_path}/ledger"
    names = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "b")], "source string, path string")
    for run in range(1, 4):
        ledger = SK.FileLedger(spark, path, most_attempts=2)  # a new process
        ledger.add(names, f"2024-01-0{run} 00:00:00")
        todo = ledger.actionable()
        assert rows(todo) == ([("a",), ("b",)] if run == 1 else [("b",)] if run == 2 else [])
        ledger.finish(todo.select("path", F.when(F.col("path") == "b", "broken").alias("error")), f"2024-01-0{run} 01:00:00")
    assert rows(SK.FileLedger(spark, path).read(), "path", "status", "attempts", "error") == [("a", "success", 1, None), ("b", "parked", 2, "broken")]


@pytest.mark.parametrize("build", [lambda t, o: E.silver_clients(E.raw_clients(t), o), lambda t, o: E.silver_prices(E.raw_prices(t), seen=o)])
def test_counts_come_from_the_same_pass(spark, build):
    t, seen = Tables(spark, FOLDER), Observation()
    observed = build(t, seen)
    observed.write.format("noop").mode("overwrite").save()
    assert seen.get["rows in"] == seen.get["valid"] + sum(n for k, n in seen.get.items() if k not in ("rows in", "valid"))

    def scans(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")

    assert scans(observed) == scans(build(t, None))


def test_shuffled_stream_is_spread_over_files(spark, tmp_path):
    work, sizes = f"{tmp_path}/w", []
    src = S.shuffled_stream(spark, FOLDER, "events", "event_id", 3, work)
    S.run_batches(src, f"{work}/run", lambda batch, i: sizes.append(batch.count()))
    assert len(sizes) >= 2 and sum(sizes) == spark.read.parquet(f"{FOLDER}/events.parquet").count()
    assert len(files(f"{work}/in")) > 3

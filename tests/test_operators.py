"""Composed operators against brute force and against array libraries on small frames."""

import collections
import datetime as dt
import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegrain.operators import joins as J
from tidegrain.operators import quality as Q
from tidegrain.operators import ranking as R
from tidegrain.operators import series as S
from tidegrain.operators import tables as T


@pytest.mark.parametrize("heavy", [2, 4, 100])
def test_best_companion_equals_brute_force(spark, heavy):
    rnd = random.Random(heavy)
    data = [(b, rnd.randrange(25)) for b in range(30) for _ in range(rnd.choice([1, 2, 3, 5, 12]))] + [(99, i) for i in range(25)]
    pairs = collections.Counter()
    baskets = collections.defaultdict(set)
    for b, i in data:
        baskets[b].add(i)
    for items in baskets.values():
        for a, b in itertools.permutations(items, 2):
            pairs[a, b] += 1
    best = {}
    for (a, b), n in pairs.items():
        if n >= 2 and (a not in best or (-n, b) < best[a]):
            best[a] = (-n, b)
    got = J.best_companion(spark.createDataFrame(data, "b int, i int"), "b", "i", 2, heavy)
    assert {r["origin"]: (-r["together"], r["companion"]) for r in got.collect()} == best


def test_global_number_and_tiles(spark):
    data = [(random.Random(i).randrange(7), i) for i in range(101)]
    df = spark.createDataFrame(data, "v int, id int").repartition(5)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {r["id"]: r["n"] for r in R.global_row_number(df, order, "n").collect()}
    ranked = [i for _, i in sorted(data, key=lambda x: (-x[0], x[1]))]
    assert got == {i: n + 1 for n, i in enumerate(ranked)}
    tiles = {r["id"]: r["q"] for r in R.global_ntile(df, 4, order, "q").collect()}
    sizes = [26, 25, 25, 25]
    assert [tiles[i] for i in ranked] == [q + 1 for q, s in enumerate(sizes) for _ in range(s)]
    by_cuts = {r["id"]: r["q"] for r in R.with_ntile(df, 4, [-F.col("v"), F.col("id")], "q").collect()}
    assert by_cuts == tiles
    for n in range(7):
        small = spark.createDataFrame([(None if i == 1 else i, i) for i in range(n)], "v int, id int")
        want = {r["id"]: r["q"] for r in R.global_ntile(small, 3, [F.col("v"), F.col("id")], "q").collect()}
        assert {r["id"]: r["q"] for r in R.with_ntile(small, 3, [F.col("v"), F.col("id")], "q").collect()} == want
    few = {r["id"]: r["q"] for r in R.global_ntile(spark.createDataFrame([(1, 1), (2, 2)], "v int, id int"), 4, [F.col("id")], "q").collect()}
    assert few == {1: 1, 2: 2}


def test_running_total_over_blocks(spark):
    data = [(k, d, i, (i * 7) % 5) for k in (1, 2) for d in range(4) for i in range(d * 3, d * 3 + 3)]
    df = spark.createDataFrame(data, "k int, d int, i int, v int")
    got = {(r["k"], r["i"]): r["run"] for r in R.running_total(df, ["k"], F.col("d"), [F.col("i")], "v", "run").collect()}
    for k in (1, 2):
        total = 0
        for _, _, i, v in sorted(x for x in data if x[0] == k):
            total += v
            assert got[k, i] == total


def test_islands(spark, rows):
    months = {"a": ["2024-01", "2024-02", "2024-04", "2024-05", "2024-06"], "b": ["2024-03"], "c": ["2023-12", "2024-01", "2024-05", "2024-06"]}
    df = spark.createDataFrame([(k, dt.date.fromisoformat(m + "-01")) for k, ms in months.items() for m in ms], "k string, m date")
    assert rows(R.longest_islands(df, ["k"], "m"), "k", "run_start", "run_months") == [("a", dt.date(2024, 4, 1), 3), ("b", dt.date(2024, 3, 1), 1), ("c", dt.date(2023, 12, 1), 2)]


def test_division(spark, rows):
    df = spark.createDataFrame([("all", 1), ("all", 2), ("all", 2), ("some", 1), ("other", 9)], "k string, i int")
    assert rows(J.divide(df, "k", "i", spark.createDataFrame([(1,), (2,), (None,)], "i int"))) == [("all",)]
    assert len(rows(J.divide(df, "k", "i", spark.createDataFrame([], "i int")))) == 3
    assert rows(J.divide(df.union(df), "k", "i", spark.createDataFrame([(1,), (2,)], "i int"), n=F.count("i"))) == [("all", 2 * df.where("k = 'all'").count())]


def test_closure_and_cycle(spark, rows):
    tree = spark.createDataFrame([(0, None), (1, 0), (2, 1), (3, 1), (9, None)], "id int, up int")
    assert rows(J.closure(tree, "id", "up")) == sorted([(0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (9, 9, 0), (0, 1, 1), (1, 2, 1), (1, 3, 1), (0, 2, 2), (0, 3, 2)], key=repr)
    with pytest.raises(ValueError):
        J.closure(spark.createDataFrame([(1, 2), (2, 1)], "id int, up int"), "id", "up")


def test_asof_carries_over_blocks(spark):
    t0 = dt.datetime(2024, 1, 1)
    ev = [(t0 + dt.timedelta(hours=h), h) for h in (1, 30, 31, 200)]
    times = [t0 + dt.timedelta(hours=h) for h in (0, 1, 5, 29, 30, 100, 300)]
    left = spark.createDataFrame([(t,) for t in times], "t timestamp")
    got = {r["t"]: r["p"] for r in J.asof_lookup(left, spark.createDataFrame(ev, "at timestamp, p int"), "t", "at", ["p"]).collect()}
    assert got == {t: max(((a, p) for a, p in ev if a <= t), default=(None, None))[1] for t in times}


def test_interpolation_equals_pandas(spark):
    rnd = random.Random(5)
    for _ in range(4):
        values = [None if rnd.random() < 0.4 else round(rnd.uniform(-5, 5), 2) for _ in range(30)]
        df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, t int, v double")
        want = pd.Series(values, dtype=float).interpolate().ffill().bfill()
        for block in (None, F.floor(F.col("t") / 4), F.floor(F.col("t") / 11)):
            got = [r["v"] for r in S.interpolate_positions(df, ["k"], "t", "v", block).orderBy("t").collect()]
            assert np.allclose(np.array(got, dtype=float), want, equal_nan=True)


def test_hourly_grid_equals_pandas(spark):
    t0 = dt.datetime(2024, 1, 1)
    hours, temps, labels = [0, 3, 4, 9, 12], [None, 5.0, None, 8.0, None], ["a", None, "b", "c", None]
    df = spark.createDataFrame([("k", t0 + dt.timedelta(hours=h), x, lab) for h, x, lab in zip(hours, temps, labels)], "k string, t timestamp, x double, lab string")
    got = S.hourly_grid(df, ["k"], "t", ["x"], ["lab"]).orderBy("t").collect()
    p = pd.DataFrame({"x": temps, "lab": labels}, index=[t0 + dt.timedelta(hours=h) for h in hours]).resample("1h").asfreq()
    x = p["x"].astype(float).interpolate()
    assert [r["t"] for r in got] == list(p.index.to_pydatetime())
    assert np.allclose(np.array([r["x"] for r in got], dtype=float), x, equal_nan=True)
    assert [r["lab"] for r in got] == list(p["lab"].ffill())


def test_upsert_is_repeatable(spark, rows):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, t int")
    source = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "c", 1)], "k int, v string, t int")
    once = T.upsert(target, source, ["k"], ["t"])
    assert rows(once) == [(1, "a", 0), (2, "new", 2), (3, "c", 1)]
    assert rows(T.upsert(once, source, ["k"], ["t"])) == rows(once)
    assert rows(T.upsert(target, source.limit(0), ["k"], ["t"])) == rows(target)


def test_partial_upsert_keeps_name(spark, rows):
    target = spark.createDataFrame([("a", "A", 1.0)], "id string, name string, price double")
    source = spark.createDataFrame([("a", "changed", 2.0), ("b", "B", 3.0)], "id string, name string, price double")
    assert rows(T.upsert_columns(target, source, "id", ["price"])) == [("a", "A", 2.0), ("b", "B", 3.0)]


def test_history(spark, rows):
    dim = spark.createDataFrame([("a", 1.0, dt.datetime(2024, 1, 1), None, 1), ("b", 2.0, dt.datetime(2024, 1, 1), None, 1)], "k string, p double, valid_from timestamp, valid_to timestamp, is_current bigint")
    out = T.scd2(dim, spark.createDataFrame([("a", 5.0), ("c", None)], "k string, p double"), "k", ["p"], "2024-02-01 00:00:00")
    assert rows(out, "k", "p", "is_current") == [("a", 1.0, 0), ("a", 5.0, 1), ("b", 2.0, 1), ("c", None, 1)]
    again = T.scd2(out, spark.createDataFrame([("a", 5.0), ("c", None)], "k string, p double"), "k", ["p"], "2024-03-01 00:00:00")
    assert rows(again) == rows(out)


def test_update_first_and_deletes(spark, rows):
    df = spark.createDataFrame([(1, "x", 1.0), (2, "y", 1.0), (3, "y", 1.0), (4, None, 1.0)], "id int, n string, p double")
    assert rows(T.update_first(df, F.col("n") == "y", ["id"], {"p": F.lit(9.0)}), "id", "p") == [(1, 1.0), (2, 9.0), (3, 1.0), (4, 1.0)]
    assert rows(T.update_first(df, F.col("n") == "none", ["id"], {"p": F.lit(9.0)})) == rows(df)
    assert rows(T.delete_in(df, "n", ["y"]), "id") == [(1,), (4,)]


def test_normalise_ids_follow_first_appearance(spark, rows):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None)], "s int, v string")
    assert rows(T.normalise(df, "v", "id", "name", [F.col("s")]), "id", "name") == [(1, "b"), (2, "a")]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "A", 5), (2, "B", 5), (3, "A", 5), (4, "B", 1)], "id int, category string, q int")
    b = spark.createDataFrame([(2, 7), (3, 5), (4, 0), (9, 1)], "id int, q int")
    got = {r["id"]: (r["state"], r["critical"]) for r in J.reconcile(a, b, "id", "q").collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "MISSING", 2: "EXCESO", 3: "OK", 4: "FALTA", 9: "UNREGISTERED"} and got[1][1] == 1


def test_rules_count_null_as_failed(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    r = Q.run_rules(df, [Q.Rule("R", "t", "x > 0", "d", "HIGH", 0.5)])
    row = Q.dq_action(r).first()
    assert (row["total"], row["failed"], row["action"], row["within_tolerance"]) == (3, 2, "BLOCK", 0)


def test_hierarchy_of_a_thousand_levels(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None, 1) for i in range(1000)] + [(5000, 10, 7), (5001, None, None)], "id int, up int, v bigint")
    got = {r["node"]: (r["members"], r["depth"], r["total"]) for r in J.roll_up(chain, "id", "up", "v").collect()}
    assert got[0] == (1000, 999, 1007) and got[10] == (990, 989, 997) and got[11] == (988, 988, 989) and got[999] == (0, 0, 1) and got[5000] == (0, 0, 7) and got[5001] == (0, 0, None)
    assert J.closure(chain, "id", "up").count() == 1000 * 1001 // 2 + 1 + 11 + 1
    with pytest.raises(ValueError):
        J.roll_up(spark.createDataFrame([(1, 2, 1), (2, 3, 1), (3, 1, 1), (4, 1, 1)], "id int, up int, v bigint"), "id", "up", "v")

"""Plan checks: pushed filters, narrow scans, rank limits below the shuffle, no Python and no nested-loop join."""

import pytest

import __spark_entry__ as entry
from tidegrain.plans.energy_reports import on_day, star
from tidegrain.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"
BATCH = [n for n in entry.all_jobs() if not n.startswith("stream")]


def plan(df) -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["yearly_customers", "vs_previous_month", "commodity_total"])
def test_date_ranges_reach_the_scan(spark, name):
    assert "GreaterThanOrEqual(o_orderdate" in plan(entry.queries()[name](spark, FOLDER))


def test_scan_reads_needed_columns_only(spark):
    p = plan(entry.queries()["revenue_series"](spark, FOLDER))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in p


@pytest.mark.parametrize("name", ["invoice_drift", "customers_unique", "best_artist_country", "undecided_taste", "max_per_country"])
def test_rank_filters_are_limited_before_the_shuffle(spark, name):
    p = plan(entry.queries()[name](spark, FOLDER))
    assert "WindowGroupLimit" in p and "Partial" in p


@pytest.mark.parametrize("name", ["vs_month_mean", "vs_year_month_mean", "price_vs_genre"])
def test_detail_rows_are_not_shuffled_for_a_few_groups(spark, name):
    p = plan(entry.queries()[name](spark, FOLDER))
    assert "BroadcastHashJoin" in p and "hashpartitioning" not in p


def test_top_ranks_meet_the_table_by_value(spark):
    p = plan(entry.queries()["staff_rank"](spark, FOLDER))
    assert "TakeOrderedAndProject(limit=3" in p


def test_reports_read_one_partition(spark):
    p = plan(star(Tables(spark, FOLDER), on_day("2024-01-17")))
    assert "PartitionFilters: [isnotnull(slot_date" in p


def test_no_python_and_no_nested_loop(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in BATCH[::6]:
            p = plan(entry.queries()[name](spark, FOLDER))
            for bad in ("EvalPython", "FlatMapGroups", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoop"):
                assert bad not in p, (name, bad)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

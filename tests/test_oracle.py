"""Registered jobs against their SQL on another engine (TIDEGRAIN_ALL=1 runs every job)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = """revenue_series rfm basket_pairs buying_streaks covers_all undecided_taste running_spend slowdown team_sales best_artist_country top_artists
market_segments top5_share inactive_in_year clean_pipeline states_or_zero top_terms silver_clients silver_prices pv_yield fact_energy run_summary daily_kpis row_rules
roster track_library client_history""".split()
SQL = entry.oracle_sql()
NAMES = [n for n in entry.queries() if n in SQL and (os.environ.get("TIDEGRAIN_ALL") == "1" or n in SAMPLE)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def _norm(rows):
    return sorted((tuple(v.isoformat() if hasattr(v, "isoformat") else v for v in r) for r in rows), key=repr)


def test_every_job_has_a_statement():
    assert set(entry.all_jobs()) <= set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    mine = _norm(tuple(r[c] for c in cols) for r in df.collect())
    cur = duck.execute(SQL[name])
    order = [[d[0] for d in cur.description].index(c) for c in cols]
    assert mine == _norm(tuple(r[i] for i in order) for r in cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0

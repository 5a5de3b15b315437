"""Upsert properties, stored tables, ingest windows, the stream and a whole run."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators.ingest_window import ingest_window, ingest_window_per_symbol
from pricelake.operators.quality import QualityGateError
from pricelake.operators.run_history import track_run
from pricelake.operators.stage_history import ingest_windows, run_kpis
from pricelake.operators.upsert import merge_into, upsert
from pricelake.plans.workflows import Lake, Settings
from pricelake.schemas import ASSET_CATALOG, BRONZE
from pricelake.sources.bronze import write_bronze
from pricelake.sources.stage_log import read_stage_log
from pricelake.sources.versioned import MonthlyTable, VersionedTable
from pricelake.streaming.bronze_to_silver import merge_available, stream_bronze
from tests.conftest import bronze_row, utc

D = dt.date


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE)


def closes(df):
    return {(r["symbol"], r["date"]): r["close"] for r in df.collect()}


@pytest.fixture
def table(spark, tmp_path):
    return MonthlyTable(spark, str(tmp_path / "silver"), BRONZE)


DAY = D(2025, 1, 10)
BASE = bronze_row("A", DAY, 100.0, utc(2025, 1, 11))


def test_same_batch_twice_is_one_row(spark, table):
    assert merge_into(table, frame(spark, BASE)) == 1
    assert merge_into(table, frame(spark, BASE)) == 1
    assert closes(table.read()) == {("A", DAY): 100.0}


@pytest.mark.parametrize(
    ("hour", "close", "kept"), [(5, 105.0, 105.0), (-5, 99.0, 100.0), (0, 98.0, 100.0)]
)
def test_only_strictly_newer_rows_replace(spark, table, hour, close, kept):
    merge_into(table, frame(spark, BASE))
    other = bronze_row("A", DAY, close, utc(2025, 1, 11) + dt.timedelta(hours=hour))
    merge_into(table, frame(spark, other))
    assert closes(table.read()) == {("A", DAY): kept}


def test_gap_is_filled_and_other_months_stay(spark, table):
    days = [D(2025, 1, 31), D(2025, 2, 1), D(2025, 2, 2)]
    merge_into(table, frame(spark, *[bronze_row("A", d, 1.0, utc(2025, 2, 3)) for d in days[:2]]))
    before = table.months()
    merge_into(table, frame(spark, bronze_row("A", days[2], 2.0, utc(2025, 2, 4))))
    assert len(closes(table.read())) == 3
    assert table.months()["2025-01"] == before["2025-01"]
    assert table.months()["2025-02"] > before["2025-02"]
    assert set(closes(table.read({"2025-01"}))) == {("A", days[0])}


def test_first_arrival_wins_among_equal_age(spark):
    rows = [bronze_row("A", DAY, float(c), utc(2025, 1, 11)) for c in (3, 1, 2)]
    batch = spark.createDataFrame(
        [(*r, i) for i, r in enumerate(rows)], _with_seq()
    )
    out = upsert(frame(spark), batch, arrival=["seq"])
    assert closes(out) == {("A", DAY): 3.0}


def _with_seq():
    from pyspark.sql import types as T

    return T.StructType([*BRONZE.fields, T.StructField("seq", T.IntegerType())])


def test_failed_publish_keeps_the_old_state(spark, table):
    merge_into(table, frame(spark, BASE))
    newer = frame(spark, bronze_row("A", DAY, 105.0, utc(2025, 1, 12)))
    boom = newer.withColumn("close", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(PySparkException, match="boom"):
        table.publish(boom, {"2025-01"})
    assert closes(table.read()) == {("A", DAY): 100.0}
    merge_into(table, newer)
    assert closes(table.read()) == {("A", DAY): 105.0}


def test_vacuum_keeps_what_is_referenced(spark, table):
    for i in range(4):
        merge_into(table, frame(spark, bronze_row("A", DAY, float(i), utc(2025, 1, 11 + i))))
    merge_into(table, frame(spark, bronze_row("A", D(2025, 3, 1), 9.0, utc(2025, 3, 2))))
    assert table.vacuum(keep=2) == 3
    assert closes(table.read()) == {("A", DAY): 3.0, ("A", D(2025, 3, 1)): 9.0}


def test_versioned_table_replaces_and_reads_its_own_past(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None
    for i in range(1, 5):
        before = t.read()
        one = spark.range(1)
        t.replace(one if before is None else before.union(one))
        assert t.read().count() == i


_ROW = st.tuples(
    st.sampled_from(["A", "B"]), st.integers(1, 3), st.integers(1, 100), st.integers(0, 400)
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(_ROW, min_size=1, max_size=6), min_size=1, max_size=3))
def test_upsert_against_brute_force(spark, batches):
    """Row by row in order: insert, or replace if strictly newer. Applying twice changes nothing."""
    expected, state = {}, frame(spark)
    for batch in batches:
        rows = []
        for i, (symbol, day, close, age) in enumerate(batch):
            stamp = utc(2025, 1, 1) + dt.timedelta(minutes=age)
            key = (symbol, D(2025, 1, day))
            if key not in expected or stamp > expected[key][1]:
                expected[key] = (float(close), stamp)
            rows.append((*bronze_row(symbol, key[1], float(close), stamp), i))
        incoming = spark.createDataFrame(rows, _with_seq())
        state = upsert(state, incoming, arrival=["seq"])
        state = spark.createDataFrame(state.collect(), BRONZE)
    want = {k: v[0] for k, v in expected.items()}
    assert closes(state) == want
    assert closes(upsert(state, incoming, arrival=["seq"])) == want


# -- ingest window --------------------------------------------------------------------------


def window(df, **kw):
    r = ingest_window(df, today="2025-06-15", lookback_days=30, **kw).first()
    return str(r["start"]), str(r["end"]), r["up_to_date"]


def test_ingest_window_precedence(spark):
    held = spark.sql("select * from values ('A', date'2025-06-01'), ('B', date'2025-06-10') as v(symbol, date)")
    assert window(held) == ("2025-06-11", "2025-06-14", False)
    assert window(held.where("false")) == ("2025-05-16", "2025-06-14", False)
    assert window(held, start="2025-01-01") == ("2025-01-01", "2025-06-14", False)
    assert window(held, end="2025-06-05") == ("2025-06-11", "2025-06-05", False)
    caught_up = spark.sql("select 'A' as symbol, date'2025-06-14' as date")
    assert window(caught_up) == ("2025-06-15", "2025-06-14", True)
    symbols = spark.sql("select explode(array('A','B','C')) as symbol")
    per = {r["symbol"]: str(r["start"]) for r in ingest_window_per_symbol(held, symbols, today="2025-06-15", lookback_days=30).collect()}
    assert per == {"A": "2025-06-02", "B": "2025-06-11", "C": "2025-05-16"}


# -- stream -----------------------------------------------------------------------------------


def test_stream_merges_new_files_once(spark, tmp_path, table):
    root, mark = str(tmp_path / "bronze"), str(tmp_path / "mark")
    write_bronze(frame(spark, BASE), root)
    merge_available(stream_bronze(spark, root), table, mark).awaitTermination()
    first = table.months()
    late = [bronze_row("A", DAY, 99.0, utc(2025, 1, 10, 1)), bronze_row("B", DAY, 7.0, utc(2025, 1, 12))]
    write_bronze(frame(spark, *late), root)
    merge_available(stream_bronze(spark, root), table, mark).awaitTermination()
    assert closes(table.read()) == {("A", DAY): 100.0, ("B", DAY): 7.0}
    second = table.months()
    merge_available(stream_bronze(spark, root), table, mark).awaitTermination()
    assert first != second == table.months()


# -- a whole run --------------------------------------------------------------------------------


def daily_rows(days, run_id, stamp, bump=0.0):
    start, rows = D(2024, 1, 1), []
    for i in range(days):
        d = start + dt.timedelta(days=i)
        rows.append(bronze_row("BTC", d, 100.0 + i + bump, stamp, run_id, "coingecko", "crypto"))
        if d.weekday() < 5:
            rows.append(bronze_row("AAPL", d, 50.0 + (i % 7), stamp, run_id))
    return rows


def test_lake_end_to_end(spark, tmp_path):
    # the second run brings a leap of a price and a stock with a single day: both are reported, not fatal here
    reported = {"fact_daily_metrics.daily_return.range": "warn", "no_calendar_gaps_stock": "warn"}
    lake = Lake(spark, str(tmp_path / "lake"), Settings(max_lag_days=4, gold_severity=reported))
    catalog = spark.createDataFrame([("BTC", "Bitcoin", "USD", "close_volume_only")], ASSET_CATALOG)
    first = frame(spark, *daily_rows(400, "run1", utc(2025, 2, 5)))
    names = lake.run(first, catalog, run_id="run1", as_of="2025-02-03")
    assert set(names) >= {"returns_by_window", "dca_vs_lump", "correlation_long"}
    returns = lake.answers.read("returns_by_window")
    assert returns.count() == 12

    # a second run adds a symbol and a correction; known ids stay
    ids = {r["symbol"]: r["asset_id"] for r in lake.gold("dim_asset").collect()}
    extra = [
        bronze_row("AAA", D(2025, 2, 3), 5.0, utc(2025, 2, 6), "run2"),
        bronze_row("BTC", D(2025, 2, 3), 1000.0, utc(2025, 2, 6), "run2", "coingecko", "crypto"),
    ]
    lake.run(frame(spark, *extra), catalog, run_id="run2", as_of="2025-02-03")
    now = {r["symbol"]: r["asset_id"] for r in lake.gold("dim_asset").collect()}
    assert {k: now[k] for k in ids} == ids and now["AAA"] == max(ids.values()) + 1
    fact = lake.fact.read()
    assert fact.count() == first.count() + 1
    btc = fact.where((F.col("asset_id") == ids["BTC"]) & (F.col("date_id") == 20250203)).first()
    assert btc["close"] == 1000.0
    assert lake.gold("fact_daily_metrics").count() == fact.count()

    from pricelake.operators.run_history import run_state
    from pricelake.schemas import RUN_EVENTS

    runs = run_state(spark.read.schema(RUN_EVENTS).parquet(lake.path("meta", "runs")))
    assert {(r["run_id"], r["status"]) for r in runs.collect()} == {("run1", "success"), ("run2", "success")}

    # the gate stops a run whose prices are out of bounds, and the run is recorded as failed
    wild = frame(spark, bronze_row("AAPL", D(2025, 2, 4), 1e9, utc(2025, 2, 7), "run3"))
    with pytest.raises(QualityGateError, match="close_within_bounds"):
        lake.run(wild, catalog, run_id="run3", as_of="2025-02-03")
    runs = run_state(spark.read.schema(RUN_EVENTS).parquet(lake.path("meta", "runs")))
    failed = runs.where("run_id = 'run3'").first()
    assert failed["status"] == "failed" and "close_within_bounds" in failed["error_payload"]
    history = spark.read.parquet(lake.path("meta", "quality"))
    assert history.where("not passed and severity = 'error'").count() == 1

    # the lake's own log tells the issues of the failed run and the dates of each ingest
    log = read_stage_log(spark, lake.path("meta", "stages"))
    kpis = {r["run_label"]: r for r in run_kpis(log).collect()}
    assert kpis["run3"]["dq_issues"] == 1 and kpis["run3"]["errors"] == 1 and kpis["run1"]["dq_issues"] == 0
    assert kpis["run1"]["silver_rows"] == first.count()
    windows = {r["run_label"]: (r["start_date"], r["end_date"]) for r in ingest_windows(log).collect()}
    assert windows["run1"] == ("2024-01-01", "2025-02-03") and windows["run3"] == ("2025-02-04", "2025-02-04")


def ticks(spark, run_id="r1"):
    """Three ticks of one day, in the order they were made: 50, 40, 60."""
    rows = [(*bronze_row("BTC", DAY, close, utc(2025, 1, 12), run_id, "coingecko", "crypto"), ms) for ms, close in ((1, 50.0), (2, 40.0), (3, 60.0))]
    return spark.createDataFrame(rows, T.StructType([*BRONZE.fields, T.StructField("ts_ms", T.LongType())]))


def test_first_tick_of_a_day_is_its_close(spark, tmp_path, table):
    lake = Lake(spark, str(tmp_path / "lake"))
    with track_run(spark, lake.path("meta", "runs"), "run1") as run:
        # rows that carry another id get the run's own
        assert lake.ingest(ticks(spark, "other"), run, as_of="2025-01-10") == 3
    assert closes(lake.silver.read()) == {("BTC", DAY): 50.0}
    assert spark.read.parquet(lake.path("bronze")).count() == 3
    root = str(tmp_path / "bronze")
    write_bronze(ticks(spark), root)
    merge_available(stream_bronze(spark, root), table, str(tmp_path / "mark")).awaitTermination()
    assert closes(table.read()) == {("BTC", DAY): 50.0}


def test_retired_asset_ids_are_not_given_again(spark, tmp_path):
    from pricelake.operators.dimensions import dim_asset, dim_asset_type

    catalog = spark.createDataFrame([], ASSET_CATALOG)
    stamp = utc(2025, 1, 12)
    old = frame(spark, bronze_row("A", DAY, 1.0, stamp), bronze_row("B", DAY, 1.0, stamp))
    first = dim_asset(old, dim_asset_type(old), catalog)
    new = frame(spark, bronze_row("A", DAY, 1.0, stamp), bronze_row("C", DAY, 1.0, stamp))
    second = dim_asset(new, dim_asset_type(new), catalog, first)
    assert {r["symbol"]: r["asset_id"] for r in second.collect()} == {"A": 1, "B": 2, "C": 3}


def test_analyse_without_prices_writes_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.transform(spark.createDataFrame([], ASSET_CATALOG))
    assert lake.analyse() == []

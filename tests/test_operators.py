"""Operators against brute force and hand-made cases."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pricelake.functions.dates import monthly_target
from pricelake.operators import derived_series, investing
from pricelake.operators.asof import asof_backward, asof_forward, last_value_at_or_before
from pricelake.operators.correlation import correlation_long
from pricelake.operators.dex import human_amount, swap_price, top_pairs
from pricelake.operators.dimensions import dim_date
from pricelake.operators.metrics import add_metrics, rolling_returns, spread
from pricelake.operators.numbering import number_rows
from pricelake.operators.quality import (
    QualityGateError,
    calendar_gaps,
    enforce,
    expression_false,
    out_of_range,
    quality_rollup,
    record_report,
    silver_report,
    stale_by_test,
    stale_symbols,
    source_freshness,
)
from pricelake.operators.run_history import run_state, stale_runs, track_run
from pricelake.operators.stage_history import labelled, run_groups, stage_rollup, wall_clock
from pricelake.operators.volatility import volatility_rank
from pricelake.operators.window_returns import returns_by_window, window_return, window_winners
from pricelake.schemas import DQ_HISTORY, RUN_EVENTS, STAGE_LOG
from tests.conftest import PRICE_SCHEMA, utc

D = dt.date


def series(spark, rows):
    return spark.createDataFrame([(s, "crypto", d, float(c)) for s, d, c in rows], PRICE_SCHEMA)


@pytest.fixture(scope="module")
def gappy():
    """Series with daily stretches, long gaps, lone days, a zero price and one single row."""
    rng, rows = random.Random(7), []
    for symbol, keep in (("dense", 1.0), ("week", 0.7), ("sparse", 0.02)):
        day = D(2020, 1, 1)
        for i in range(900):
            in_gap = symbol == "week" and (200 <= i < 290 or 400 <= i < 800)
            if not in_gap and rng.random() < keep:
                rows.append((symbol, day + dt.timedelta(days=i), round(rng.uniform(1, 99), 2)))
    rows.append(("lone", D(2020, 5, 5), 3.0))
    rows += [("zero", D(2020, 1, 1), 0.0), ("zero", D(2020, 1, 2), 5.0), ("zero", D(2020, 6, 1), 6.0)]
    return rows


def brute_rolling(rows, n):
    out = {}
    for s, d, c in rows:
        base = next(c2 for s2, d2, c2 in sorted(rows) if s2 == s and d - dt.timedelta(days=n) <= d2 <= d)
        out[s, d] = c / base - 1.0 if base else None
    return out


def test_series_are_dealt_by_their_number_of_rows(spark):
    rows = spark.range(3000).selectExpr("concat('s', id % 300) AS symbol", "date_add(DATE '2024-01-01', cast(id div 300 AS int)) AS date", "1.0D + id AS close")
    dealt = spread(rows, ["symbol"], task_rows=100)
    tasks = dealt.select("symbol", F.spark_partition_id().alias("task")).distinct().groupBy("symbol").count()
    assert dealt.rdd.getNumPartitions() == 30 and tasks.where("count > 1").isEmpty()
    assert spread(rows, ["symbol"]) is rows
    plan = rolling_returns(dealt, by=["symbol"], windows=[7])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan


def test_rolling_returns_against_brute_force(spark, gappy):
    windows = [7, 30, 31, 90, 365]
    got = rolling_returns(series(spark, gappy), by=["symbol"], windows=windows).collect()
    assert len(got) == len(gappy)
    for n in windows:
        want = brute_rolling(gappy, n)
        for r in got:
            assert r[f"rolling_return_{n}d"] == want[r["symbol"], r["date"]], (n, r)


def test_metrics_against_numpy(spark, gappy):
    p = series(spark, gappy)
    rows = add_metrics(p, p.where("symbol = 'week'"), by=["symbol"]).orderBy("symbol", "date").collect()
    bench = {d: c for s, d, c in gappy if s == "week"}
    first_bench = bench[min(bench)]
    for symbol in ("dense", "week", "zero"):
        mine = [r for r in rows if r["symbol"] == symbol]
        c = [r["close"] for r in mine]
        returns = [None] + [b / a - 1.0 if a else None for a, b in zip(c, c[1:])]
        for i, r in enumerate(mine):
            assert r["daily_return"] == returns[i]
            if returns[i] is not None and returns[i] > -1:
                assert math.isclose(r["log_return"], math.log1p(returns[i]), rel_tol=1e-9)
            frame = [x for x in returns[max(0, i - 29) : i + 1] if x is not None]
            if len(frame) >= 30:
                assert math.isclose(r["rolling_vol_30d"], np.std(frame, ddof=1), rel_tol=1e-9)
            else:
                assert r["rolling_vol_30d"] is None
            if symbol == "zero" or r["date"] not in bench:
                assert r["rel_perf_vs_btc"] is None
            else:
                want = c[i] / c[0] - bench[r["date"]] / first_bench
                assert math.isclose(r["rel_perf_vs_btc"], want, abs_tol=1e-12)


def test_metrics_use_one_shuffle_by_asset(spark, tmp_path, gappy):
    path = str(tmp_path / "p")
    series(spark, gappy).select("symbol", "date", "close").write.parquet(path)
    p = spark.read.parquet(path)
    bench = p.where("symbol = 'week'")
    plan = add_metrics(p, bench, by=["symbol"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(symbol") == 1
    # sorted once by date, once more after the bridge rows
    assert plan.count("Sort [symbol") == 2
    # every window is partitioned; the only single partition is the benchmark's first close
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("symbol" in line.rsplit("], [", 2)[1] for line in windows)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_labels_are_shown_whole(spark):
    from pricelake.operators.stage_history import display_label

    long = "daily-" + "x" * 1200
    shown = spark.createDataFrame([(long,)], "label string").select(display_label(F.col("label"))).first()[0]
    assert shown.endswith("x" * 1200)


def test_custom_windows_keep_their_order(spark):
    rows = [{"window": w, "symbol": "A", "return": 0.1, "btc_return": 0.0, "beats_btc": True} for w in ("2w", "9d", "1y")]
    winners = window_winners(spark.createDataFrame(rows), "BTC", {"9d": 9, "2w": 14}).collect()
    assert [r["window"] for r in sorted(winners, key=lambda r: r["position"])] == ["1y", "9d", "2w"]
    assert len({r["position"] for r in winners}) == 3


def test_numbering_in_ranges_equals_window(spark):
    rng = random.Random(3)
    keys = rng.sample(range(10**6), 5000)
    df = spark.createDataFrame([(f"S{k:07d}", k) for k in keys], "symbol string, k long")
    ranged = number_rows(df, [F.col("symbol")], "id", ranges=16).collect()
    assert {r["symbol"]: r["id"] for r in ranged} == {
        f"S{k:07d}": i for i, k in enumerate(sorted(keys), 1)
    }
    down = number_rows(df, [-F.col("k")], "id", start=11).collect()
    assert {r["k"]: r["id"] for r in down} == {
        k: i for i, k in enumerate(sorted(keys, reverse=True), 11)
    }
    assert number_rows(df.limit(0), [F.col("symbol")], "id").count() == 0


@pytest.mark.parametrize("forward", [True, False])
def test_asof_against_brute_force(spark, gappy, forward):
    rng = random.Random(1)
    targets = [
        (i, rng.choice(["dense", "week", "sparse", "lone", "none"]), D(2019, 12, 1) + dt.timedelta(days=rng.randrange(1000)))
        for i in range(400)
    ] + [(1000 + i, "week", D(2020, 8, 1)) for i in range(300)]
    t = spark.createDataFrame(targets, "id int, symbol string, target date")
    got = (asof_forward if forward else asof_backward)(t, series(spark, gappy)).collect()
    assert len(got) == len(targets)
    for r in got:
        days = [d for s, d, _ in gappy if s == r["symbol"]]
        fits = [d for d in days if (d >= r["target"] if forward else d <= r["target"])]
        want = (min(fits) if forward else max(fits)) if fits else None
        assert r["fill_date"] == want
        assert (r["fill_close"] is None) == (want is None)


def test_last_value_skips_nulls(spark):
    df = spark.sql(
        "select * from values ('A', date'2025-01-01', 1.0D), ('A', date'2025-01-02', null), ('A', date'2025-01-09', 9.0D) as v(symbol, date, x)"
    )
    assert last_value_at_or_before(df, ["x"], "2025-01-05").first()["x"] == 1.0


# -- investing ----------------------------------------------------------------------------------

RISING = [("BTC", D(2024, 1, 1), 40000), ("BTC", D(2024, 6, 1), 60000), ("BTC", D(2024, 12, 1), 90000), ("BTC", D(2025, 1, 1), 100000)]


def test_lump_sum_value(spark):
    r = investing.lump_sum(series(spark, RISING), principal_usd=1000, start="2024-01-01", end="2025-01-01").first()
    assert r["current_value_usd"] == 2500.0 and r["total_return"] == 1.5


def test_lump_sum_leap_day_and_missing_prices(spark):
    p = series(spark, [("A", D(2023, 2, 28), 10), ("A", D(2024, 2, 29), 20), ("B", D(2024, 3, 5), 1)])
    rows = investing.lump_sum_one_year(p, as_of="2024-02-29").collect()
    assert [(r["symbol"], str(r["start_date"])) for r in rows] == [("A", "2023-02-28")]


def test_dca_falls_forward(spark):
    p = series(spark, [("BTC", D(2024, m, 3), c) for m, c in ((1, 40000), (2, 50000), (3, 60000))])
    r = investing.dca(p, monthly_amount_usd=100, months=3, start="2024-01-01", as_of="2024-03-31").first()
    assert r["months"] == 3 and r["total_invested_usd"] == 300.0
    buys = investing.dca_buys(p, monthly_amount_usd=100, months=3, start="2024-01-01").collect()
    assert min(b["fill_date"] for b in buys) == D(2024, 1, 3)


def brute_buys(rows, symbol, months, start, day):
    out = []
    for i in range(months):
        y, m = divmod(start.year * 12 + start.month - 1 + i, 12)
        target = D(y, m + 1, day)
        later = sorted((d, c) for s, d, c in rows if s == symbol and d >= target)
        if not later:
            break
        out.append((i, target, *later[0]))
    return out


@pytest.mark.parametrize(("start", "day", "months"), [(D(2020, 1, 17), 1, 12), (D(2020, 3, 5), 20, 30), (D(2019, 6, 1), 28, 14)])
def test_dca_buys_against_brute_force(spark, gappy, start, day, months):
    got = investing.dca_buys(series(spark, gappy), monthly_amount_usd=50, months=months, start=start, buy_day=day).collect()
    for symbol in {s for s, _, _ in gappy}:
        mine = sorted((r["buy_no"], r["target"], r["fill_date"], r["price"]) for r in got if r["symbol"] == symbol)
        assert mine == brute_buys(gappy, symbol, months, start, day), symbol


def test_zero_price_gives_an_unknown_outcome(spark, gappy):
    zero = series(spark, [r for r in gappy if r[0] == "zero"])
    r = investing.dca(zero, monthly_amount_usd=50, months=3, start="2020-01-01", as_of="2020-07-01").first()
    assert r["months"] == 3 and r["total_units"] is None and r["total_return"] is None
    lump = investing.lump_sum(zero, principal_usd=1, start="2020-01-01", end="2020-07-01")
    assert lump.first()["units"] is None
    both = lump.unionByName(investing.lump_sum(series(spark, RISING), principal_usd=1, start="2024-01-01", end="2025-01-01"))
    best = derived_series.best_worst(both, benchmark="BTC").first()
    assert best["best_symbol"] == best["worst_symbol"] == "BTC"


def test_buy_day_must_exist_in_every_month():
    with pytest.raises(ValueError):
        monthly_target(None, None, 31)


def test_dca_path_ends_at_the_totals(spark, deterministic_prices):
    last = investing.dca_path(deterministic_prices, as_of="2025-02-01").where("date = '2025-02-01'").collect()
    rows = investing.dca_vs_lump_sum(deterministic_prices, as_of="2025-02-01").collect()
    totals = {(r["symbol"], r["strategy"]): r for r in rows}
    for r in last:
        dca = totals[r["symbol"], "dca"]
        assert math.isclose(r["dca_value"], dca["current_value_usd"], rel_tol=1e-12)
        assert r["dca_invested"] == dca["principal_usd"]
        assert math.isclose(r["lump_value"], totals[r["symbol"], "lump_sum"]["current_value_usd"], rel_tol=1e-12)


# -- windows, volatility, correlation --------------------------------------------------------------


def test_window_fallback_and_benchmark_flag(spark):
    p = series(spark, [("BTC", D(2025, 1, d), 100 + d) for d in range(1, 31)] + [("A", D(2025, 1, d), 10 + d) for d in range(1, 31)])
    m = add_metrics(p, p.where("symbol = 'BTC'"), by=["symbol"], windows=[7])
    rows = returns_by_window(m, p, benchmark="BTC", windows_days={"7d": 7, "2w": 14}, as_of="2025-01-30").collect()
    cell = {(r["window"], r["symbol"]): r for r in rows}
    assert set(w for w, _ in cell) == {"7d", "2w", "ytd"}
    assert cell["2w", "A"]["return"] == 40 / 26 - 1 and str(cell["2w", "A"]["start_date"]) == "2025-01-16"
    assert cell["2w", "BTC"]["beats_btc"] is None and cell["2w", "A"]["beats_btc"] is True
    assert window_return(p, 14, as_of="2025-01-30").where("symbol = 'A'").first()["return"] == 40 / 26 - 1
    winners = window_winners(spark.createDataFrame(rows), "BTC").collect()
    assert {r["window"]: r["position"] for r in winners} == {"7d": 1, "ytd": 5, "2w": 7}


def test_volatility_rank_multiples(spark):
    vol = spark.sql("select * from values ('A','stock',0.02D,9L), ('SPY','index',0.01D,9L), ('N','fx',null,1L) as v(symbol, asset_type, daily_return_stdev, n_obs)")
    rows = {r["symbol"]: r for r in volatility_rank(vol, reference="SPY").collect()}
    assert [rows[s]["rank"] for s in ("A", "SPY", "N")] == [1, 2, 3]
    assert rows["A"]["multiple"] == 2.0 and rows["SPY"]["multiple"] is None
    assert math.isclose(rows["A"]["annualised_pct"], 2 * math.sqrt(252))
    absent = volatility_rank(vol, reference="none").collect()
    assert all(r["multiple"] is None for r in absent)


@pytest.mark.parametrize("block", [1, 3, 512])
def test_correlation_against_numpy(spark, block):
    rng, days, symbols = np.random.default_rng(5), 40, [f"s{i}" for i in range(7)]
    data = rng.normal(size=(7, days))
    rows = [(s, D(2025, 1, 1) + dt.timedelta(days=j), float(data[i, j])) for i, s in enumerate(symbols) for j in range(days) if not (i == 2 and j == 11)]
    rows += [("flat", D(2025, 1, 1) + dt.timedelta(days=j), 0.0) for j in range(days)]
    m = spark.createDataFrame(rows, "symbol string, date date, daily_return double")
    got = {(r["symbol"], r["other"]): r for r in correlation_long(m, block_symbols=block).collect()}
    want = np.corrcoef(np.delete(data, 11, axis=1))
    assert len(got) == 49
    for i, a in enumerate(symbols):
        for j, b in enumerate(symbols):
            assert math.isclose(got[a, b]["correlation"], want[i, j], abs_tol=1e-12)
            assert got[a, b]["n_days"] == days - 1


def test_rebased_series_drop_zero_bases(spark):
    p = series(spark, [("A", D(2025, 1, 1), 0), ("A", D(2025, 1, 2), 5), ("B", D(2025, 1, 1), 4), ("B", D(2025, 1, 2), 5)])
    rows = derived_series.rebased_change(p).orderBy("date").collect()
    assert [(r["symbol"], r["change_pct"]) for r in rows] == [("B", 0.0), ("B", 25.0)]


# -- dimensions and quality -----------------------------------------------------------------------


def test_dim_date_falls_back_to_weekdays(spark):
    silver = spark.sql("select * from values (date'2025-01-03'), (date'2025-01-04'), (date'2025-01-05') as v(date)")
    calendar = spark.sql("select date'2025-01-04' as date, true as is_trading_day")
    rows = {r["date_id"]: r for r in dim_date(silver, calendar).collect()}
    assert (rows[20250105]["dow"], rows[20250105]["is_trading_day"]) == (0, False)
    assert rows[20250104]["is_trading_day"] and rows[20250103]["is_trading_day"]


def test_calendar_gaps_include_assets_without_prices(spark):
    assets = spark.sql("select * from values (1L,'A','stock'), (2L,'B','stock'), (3L,'C','fx') as v(asset_id, symbol, asset_type)")
    dates = spark.sql("select * from values (20250102L, true), (20250103L, true), (20250104L, false) as v(date_id, is_trading_day)")
    fact = spark.sql("select * from values (1L, 20250102L, 1.0D), (1L, 20250104L, 1.0D) as v(asset_id, date_id, close)")
    got = {(r["symbol"], str(r["date"])) for r in calendar_gaps(assets, dates, fact).collect()}
    assert got == {("A", "2025-01-03"), ("B", "2025-01-02"), ("B", "2025-01-03")}


def test_three_valued_checks(spark):
    df = spark.sql("select * from values (1, 2), (3, 2), (null, 2) as v(a, b)")
    assert [r["a"] for r in expression_false(df, "a <= b").collect()] == [3]
    assert out_of_range(df, "a", low=1, inclusive=False).count() == 1
    assert out_of_range(df, "a", low=2, where="b = 2").count() == 1


def test_silver_report_gate_and_history(spark, tmp_path):
    p = series(spark, [("A", D(2025, 1, 1), 5), ("A", D(2025, 1, 1), 5), ("B", D(2025, 1, 9), 500)])
    report = silver_report(p, as_of="2025-01-10", low=0, high=100, max_lag_days=3)
    rows = {r["test_name"].split(".")[1]: r for r in report.collect()}
    assert [rows[k]["row_count"] for k in ("unique_symbol_date", "close_not_null", "close_within_bounds", "freshness")] == [1, 0, 1, 1]
    assert rows["freshness"]["details"] == '{"stale_count":1}'
    with pytest.raises(QualityGateError, match="freshness"):
        enforce(report)
    fine = silver_report(p.where("symbol = 'B'"), as_of="2025-01-10", low=0, high=1000, max_lag_days=3)
    enforce(fine)
    assert fine.where("test_name = 'silver.freshness'").first()["severity"] == "info"
    path = str(tmp_path / "history")
    record_report(report, path, run_id="r1")
    record_report(fine, path, run_id="r2")
    history = spark.read.schema(DQ_HISTORY).parquet(path)
    rollup = {r["test_name"]: r for r in quality_rollup(history).collect()}
    assert rollup["silver.unique_symbol_date"]["duplicate_keys"] == 1
    assert rollup["silver.freshness"]["runs"] == 2
    assert [r["symbol"] for r in stale_symbols(p, as_of="2025-01-10", max_lag_days=3).collect()] == ["A"]
    listed = spark.createDataFrame([("t", '{"stale_symbols":["A","B"]}'), ("t", '{"stale_symbols":["A"]}'), ("u", "{}")], "test_name string, details string")
    assert sorted(map(tuple, stale_by_test(listed).collect())) == [("t", "A"), ("t", "B")]


def test_empty_silver_passes_the_gate(spark):
    report = silver_report(series(spark, []), as_of="2025-01-10", low=0, high=1, max_lag_days=3)
    assert report.count() == 4 and report.where("not passed").count() == 0


@pytest.mark.parametrize(("hours", "status"), [(10, "pass"), (60, "warn"), (200, "error")])
def test_source_freshness(spark, hours, status):
    df = spark.sql("select timestamp'2025-01-01 00:00:00' as ingested_at")
    now = F.lit(utc(2025, 1, 1) + dt.timedelta(hours=hours))
    assert source_freshness(df, now=now).first()["status"] == status


# -- runs and stages ----------------------------------------------------------------------------


def test_run_states(spark, tmp_path):
    path = str(tmp_path / "runs")
    with track_run(spark, path, "good", "abc") as run:
        run.loaded["massive"] = 5
    with pytest.raises(KeyError), track_run(spark, path, "bad"):
        raise KeyError("x")
    spark.createDataFrame([("lost", utc(2025, 1, 1), "running", None, None, None)], RUN_EVENTS).write.mode("append").parquet(path)
    events = spark.read.schema(RUN_EVENTS).parquet(path)
    runs = {r["run_id"]: r for r in run_state(events).collect()}
    assert runs["good"]["status"] == "success" and runs["good"]["rows_by_source"] == '{"massive": 5}'
    assert runs["good"]["ended_at"] >= runs["good"]["started_at"] and runs["good"]["git_sha"] == "abc"
    assert runs["bad"]["status"] == "failed" and "KeyError" in runs["bad"]["error_payload"]
    assert runs["lost"]["ended_at"] is None
    late = stale_runs(run_state(events), now=F.lit(utc(2025, 1, 1, 3)))
    assert [r["run_id"] for r in late.collect()] == ["lost"]


def log(spark, *records):
    names = STAGE_LOG.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], STAGE_LOG)


def test_stage_rollup_counts_only_numbers(spark):
    base = {"stage": "s", "started_at": "2025-01-01T00:00:00+00:00", "duration_s": 1.0, "status": "ok"}
    df = log(
        spark,
        base | {"meta": '{"rows": 2.9, "flag": true, "text": "7", "big": 5}'},
        base | {"meta": '{"rows": -1.9}', "status": "error", "rss_mb_start": 1.0, "rss_mb_end": 2.26, "rss_mb_peak": 9.0},
        base | {"stage": "t", "duration_s": 5.0},
    )
    rows = {r["stage"]: r for r in stage_rollup(df).collect()}
    assert rows["s"]["meta"] == '{"big":5,"rows":1}' and rows["t"]["meta"] == "{}"
    assert (rows["s"]["status"], rows["s"]["count"], rows["s"]["delta_rss_mb"]) == ("error", 2, 1.3)
    assert rows["t"]["peak_rss_mb"] is None and rows["t"]["delta_rss_mb"] is None
    assert wall_clock(df).first()["wall_clock_s"] == 5.0
    assert wall_clock(df.limit(0)).first()["wall_clock_s"] == 0.0


def test_unlabelled_records(spark):
    a = {"stage": "s", "started_at": "2025-01-02T00:00:00+00:00", "duration_s": 1.0}
    assert [r["run_label"] for r in run_groups(log(spark, a)).collect()] == ["unlabeled"]
    b = a | {"started_at": "2025-01-01T00:00:00+00:00", "run_label": "clean_baseline"}
    c = a | {"run_label": "daily-2025-01-02"}
    rows = run_groups(log(spark, a, c, b)).collect()
    assert [r["display"] for r in rows] == ["incremental_run", "Daily run · 2025-01-02"]
    assert labelled(log(spark, a, b)).count() == 1


# -- exchange trades --------------------------------------------------------------------------------


def test_swap_example(spark):
    """A recorded swap of 150.077090 for 0.065460521380972534."""
    df = spark.sql("select cast(150077090 as decimal(38,0)) a, cast(65460521380972534 as decimal(38,0)) b, cast(0 as decimal(38,0)) z")
    out = df.select(
        human_amount(F.col("a"), F.lit(6)).alias("amount0_in"),
        human_amount(F.col("z"), F.lit(6)).alias("amount0_out"),
        human_amount(F.col("z"), F.lit(18)).alias("amount1_in"),
        human_amount(F.col("b"), F.lit(18)).alias("amount1_out"),
        human_amount(F.col("b"), F.lit(0)).alias("whole"),
    )
    r = swap_price(out).first()
    assert str(r["amount0_in"]) == "150.077090000000000000"
    assert str(r["amount1_out"]) == "0.065460521380972534"
    assert int(r["whole"]) == 65460521380972534
    assert r["direction"] == "0->1" and round(r["price"], 4) == 2292.6351


def test_top_pairs(spark):
    rows = [(p, 1000.5, t, utc(2025, 1, 8)) for p, n in (("X", 3), ("Y", 5)) for t in range(n)]
    rows += [("Z", 1.0, 1, utc(2024, 1, 1))] * 9
    df = spark.createDataFrame(rows, "token_pair string, amount_usd double, taker long, block_time timestamp")
    got = top_pairs(df, now=F.lit(utc(2025, 1, 10))).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(1, "Y", 5, "$5,002.50", 5), (2, "X", 3, "$3,001.50", 3)]


def test_human_amount_rejects_garbage(spark):
    with pytest.raises(PySparkException):
        spark.sql("select 'x' as raw").select(human_amount(F.col("raw"), F.lit(6))).collect()


# -- price fact ----------------------------------------------------------------------------------


def test_fact_takes_newer_rows_and_appends_columns(spark):
    from pricelake.operators.facts import fact_daily_price
    from pricelake.schemas import BRONZE
    from tests.conftest import bronze_row

    assets = spark.sql("select 1L as asset_id, 'A' as symbol")
    dates = spark.sql("select * from values (20250101L, date'2025-01-01'), (20250102L, date'2025-01-02') as v(date_id, date)")
    old = spark.createDataFrame([bronze_row("A", D(2025, 1, 1), 10.0, utc(2025, 1, 2))], BRONZE)
    current = fact_daily_price(old, assets, dates).drop("vwap")
    silver = spark.createDataFrame(
        [
            bronze_row("A", D(2025, 1, 1), 11.0, utc(2025, 1, 3)),
            bronze_row("A", D(2025, 1, 2), 12.0, utc(2025, 1, 3)),
            bronze_row("A", D(2025, 1, 2), 99.0, utc(2025, 1, 1)),
            bronze_row("B", D(2025, 1, 2), 99.0, utc(2025, 1, 3)),
        ],
        BRONZE,
    )
    out = fact_daily_price(silver, assets, dates, current)
    assert set(out.columns) == {*current.columns, "vwap"}
    got = {r["date_id"]: (r["close"], r["vwap"]) for r in out.collect()}
    assert got == {20250101: (11.0, 11.0), 20250102: (12.0, 12.0)}
    same = fact_daily_price(old, assets, dates, current).collect()
    assert [(r["close"], r["vwap"]) for r in same] == [(10.0, None)]

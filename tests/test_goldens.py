"""Answers on the deterministic price recurrence against known values."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from pricelake.operators.correlation import correlation_long, correlation_matrix
from pricelake.operators.investing import dca_vs_lump_sum
from pricelake.operators.metrics import add_metrics
from pricelake.operators.volatility import volatility_summary
from pricelake.operators.window_returns import returns_by_window

AS_OF = "2025-02-01"

# Window, start date and return of BTC as of 2025-02-01.
RETURNS = {
    "7d": ("2025-01-25", -0.00003149975193794674),
    "1m": ("2025-01-02", 0.004377939409815346),
    "3m": ("2024-11-03", -0.0048874259729716485),
    "6m": ("2024-08-05", -0.0007984373238192344),
    "1y": ("2024-02-02", 0.0013584178952685821),
    "ytd": ("2025-01-01", 0.004377939409815346),
}
# n_buys, units, current value, profit, return.
STRATEGIES = {
    "dca": (12, 0.030207703666417614, 1200.7372412581833, 0.7372412581833032, 0.0006143677151527527),
    "lump_sum": (1, 0.030230165913691962, 1201.6301014743224, 1.6301014743223732, 0.0013584178952686444),
}
SIGMA = 0.0030041067781033256


@pytest.fixture(scope="module")
def metrics(deterministic_prices):
    bench = deterministic_prices.where("symbol = 'BTC'")
    return add_metrics(deterministic_prices, bench, by=["symbol"]).persist()


def test_returns_by_window(metrics, deterministic_prices):
    rows = returns_by_window(metrics, deterministic_prices, benchmark="BTC", as_of=AS_OF).collect()
    assert len(rows) == 18
    for r in rows:
        start, value = RETURNS[r["window"]]
        assert str(r["start_date"]) == start and str(r["end_date"]) == AS_OF
        assert math.isclose(r["return"], value, abs_tol=1e-9)
        assert math.isclose(r["btc_return"], value, abs_tol=1e-9)
        # equal series differ by rounding only, so the flag itself is not checked
        assert (r["beats_btc"] is None) == (r["symbol"] == "BTC")


def test_volatility_summary(metrics):
    rows = volatility_summary(metrics, as_of=AS_OF, lookback_days=365).collect()
    assert {r["symbol"] for r in rows} == {"AAPL", "BTC", "C:EURUSD"}
    for r in rows:
        assert math.isclose(r["daily_return_stdev"], SIGMA, abs_tol=1e-9)
        assert r["n_obs"] == 365


def test_dca_vs_lump(deterministic_prices):
    rows = dca_vs_lump_sum(deterministic_prices, as_of=AS_OF, symbol="BTC").collect()
    assert {r["strategy"] for r in rows} == set(STRATEGIES)
    for r in rows:
        buys, units, value, pnl, ret = STRATEGIES[r["strategy"]]
        assert r["principal_usd"] == 1200.0 and r["n_buys"] == buys
        for got, want in (
            (r["units"], units),
            (r["current_value_usd"], value),
            (r["pnl_usd"], pnl),
            (r["total_return"], ret),
        ):
            assert math.isclose(got, want, abs_tol=1e-6)


def test_correlation_shape_and_diagonal(metrics):
    long = correlation_long(metrics, as_of=AS_OF).persist()
    wide = correlation_matrix(long)
    assert wide.columns == ["symbol", "AAPL", "BTC", "C:EURUSD"]
    assert wide.count() == 3
    diagonal = long.where(F.col("symbol") == F.col("other")).collect()
    assert all(abs(r["correlation"] - 1.0) < 1e-9 for r in diagonal)
    both = {(r["symbol"], r["other"]): r["correlation"] for r in long.collect()}
    assert all(abs(v - both[b, a]) < 1e-12 for (a, b), v in both.items())


def test_benchmark_has_no_relative_performance_against_itself(metrics):
    worst = metrics.where("symbol = 'BTC'").agg(F.max(F.abs("rel_perf_vs_btc"))).first()[0]
    assert worst == 0.0

from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pricelake.session import build


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "local[4]",
        "pricelake-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


PRICE_SCHEMA = "symbol string, asset_type string, date date, close double"
METRIC_COLUMNS = [
    "daily_return",
    "log_return",
    "rolling_return_7d",
    "rolling_return_30d",
    "rolling_return_90d",
    "rolling_return_180d",
    "rolling_return_365d",
    "rolling_vol_30d",
]


def compounding(seeds, start, days, step):
    """Rows of a price recurrence in double precision: multiplied first, then emitted."""
    rows = []
    for symbol, asset_type, price in seeds:
        for i in range(days):
            price *= 1 + step(i)
            rows.append((symbol, asset_type, start + dt.timedelta(days=i), price))
    return rows


@pytest.fixture(scope="session")
def deterministic_prices(spark):
    seeds = [("BTC", "crypto", 40000.0), ("AAPL", "stock", 180.0), ("C:EURUSD", "fx", 1.09)]
    rows = compounding(seeds, dt.date(2024, 1, 1), 400, lambda i: 0.0015 * ((i % 7) - 3))
    return spark.createDataFrame(rows, PRICE_SCHEMA).persist()


def bronze_row(symbol, date, close, ingested_at, run_id="r1", source="massive", asset_type="stock"):
    """A complete bronze row around one close."""
    return (
        source, asset_type, symbol, date, close * 0.99, close * 1.01, close * 0.98, close,
        1e6, close, 10, ingested_at, run_id,
    )


def utc(*parts):
    return dt.datetime(*parts, tzinfo=dt.UTC)

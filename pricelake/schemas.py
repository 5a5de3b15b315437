"""Table schemas and the fixed values their contracts accept."""

from __future__ import annotations

from pyspark.sql import types as T

# Accepted sources, asset types, completeness labels, base currencies.
SOURCES = ["massive", "coingecko", "synthetic"]
ASSET_TYPES = ["stock", "fx", "index", "crypto"]
PRICE_COMPLETENESS = ["ohlcv", "close_volume_only"]
DEFAULT_BASE_CCY = "USD"
CLOSE_ONLY_SOURCE = "coingecko"
FLAT_SOURCE = "synthetic"

# Named windows in days, and the order in which reports list them.
WINDOW_DAYS = {"7d": 7, "1m": 30, "3m": 90, "6m": 180, "1y": 365}
WINDOW_ORDER = ["7d", "1m", "3m", "6m", "ytd", "1y"]
ROLLING_DAYS = [7, 30, 90, 180, 365]
VOLATILITY_ROWS = 30
TRADING_DAYS_PER_YEAR = 252

PRICE_KEY = ["symbol", "date"]
FACT_KEY = ["asset_id", "date_id"]

BRONZE = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("asset_type", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType(), False),
        T.StructField("volume", T.DoubleType()),
        T.StructField("vwap", T.DoubleType()),
        T.StructField("trade_count", T.IntegerType()),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("run_id", T.StringType(), False),
    ]
)

ANALYSIS_INPUT = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("asset_type", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("close", T.DoubleType(), False),
    ]
)

# One page of daily bars as landed by the provider.
BAR_PAGE = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("resultsCount", T.IntegerType()),
        T.StructField("next_url", T.StringType()),
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("o", T.DoubleType()),
                        T.StructField("h", T.DoubleType()),
                        T.StructField("l", T.DoubleType()),
                        T.StructField("c", T.DoubleType()),
                        T.StructField("v", T.DoubleType()),
                        T.StructField("vw", T.DoubleType()),
                        T.StructField("t", T.LongType()),
                        T.StructField("n", T.IntegerType()),
                    ]
                )
            ),
        ),
    ]
)

# Parallel arrays of [timestamp in ms, value].
_PAIRS = T.ArrayType(T.ArrayType(T.DoubleType()))
SERIES_PAGE = T.StructType(
    [
        T.StructField("prices", _PAIRS),
        T.StructField("market_caps", _PAIRS),
        T.StructField("total_volumes", _PAIRS),
    ]
)

ASSET_CATALOG = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("base_ccy", T.StringType()),
        T.StructField("price_completeness", T.StringType()),
    ]
)

STAGE_LOG = T.StructType(
    [
        T.StructField("stage", T.StringType(), False),
        T.StructField("started_at", T.StringType(), False),
        T.StructField("duration_s", T.DoubleType(), False),
        T.StructField("status", T.StringType()),
        T.StructField("pid", T.LongType()),
        T.StructField("rss_mb_start", T.DoubleType()),
        T.StructField("rss_mb_peak", T.DoubleType()),
        T.StructField("rss_mb_end", T.DoubleType()),
        T.StructField("meta", T.StringType()),
        T.StructField("run_label", T.StringType()),
    ]
)

RUN_EVENTS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("event_ts", T.TimestampType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_by_source", T.StringType()),
        T.StructField("error_payload", T.StringType()),
        T.StructField("git_sha", T.StringType()),
    ]
)

DQ_HISTORY = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("test_name", T.StringType(), False),
        T.StructField("run_ts", T.TimestampType(), False),
        T.StructField("passed", T.BooleanType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("details", T.StringType()),
    ]
)

FINGERPRINTS = T.StructType(
    [
        T.StructField("seed_name", T.StringType(), False),
        T.StructField("sha256", T.StringType(), False),
    ]
)

"""Payload normalisation, bronze, seeds, calendar, logs."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pricelake.functions.dates import millis_to_date
from pricelake.operators.contract import BRONZE_RULES, ContractError, coerce, violating_rows
from pricelake.schemas import ASSET_CATALOG, BRONZE
from pricelake.sources.bars import normalize_bars, read_bar_pages
from pricelake.sources.bronze import Written, read_bronze, write_bronze
from pricelake.sources.calendar import trading_calendar
from pricelake.sources.combine import union_sources
from pricelake.sources.flat import flat_series
from pricelake.sources.seeds import (
    changed_files,
    read_catalog,
    read_seed_files,
    write_fingerprints,
)
from pricelake.sources.series import collapse_to_day, normalize_series, parse_series_pages
from pricelake.sources.sinks import write_answer
from pricelake.sources.stage_log import read_stage_log, timed_stage
from tests.conftest import bronze_row, utc

D = dt.date


def ms(*parts):
    return int(utc(*parts).timestamp() * 1000)


def test_utc_day_edges(spark):
    moments = [ms(2025, 1, 5, 23, 59, 59), ms(2025, 1, 6), ms(2025, 1, 6, 5)]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = spark.createDataFrame([(m,) for m in moments], "t long")
        got = [r[0] for r in rows.select(millis_to_date(rows.t)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [D(2025, 1, 5), D(2025, 1, 6), D(2025, 1, 6)]


def write_pages(folder, *pages):
    for i, page in enumerate(pages):
        (folder / f"page{i}.json").write_text(json.dumps(page, indent=1))
    return str(folder)


BAR = {"o": 100.0, "h": 105.0, "l": 99.0, "c": 104.0, "v": 1e6, "vw": 102.5, "t": ms(2025, 1, 6, 5), "n": 42}


def bars_of(spark, path):
    pages = read_bar_pages(spark, path).selectExpr("ticker as symbol", "'stock' as asset_type", "results")
    return normalize_bars(pages, run_id="r1", ingested_at=utc(2025, 1, 7))


def test_bar_pages_are_unioned_and_optional_fields_stay_null(spark, tmp_path):
    later = {k: v for k, v in BAR.items() if k not in ("vw", "n")} | {"t": ms(2025, 1, 7, 5)}
    path = write_pages(
        tmp_path,
        {"ticker": "AAPL", "status": "OK", "results": [BAR], "next_url": "x", "extra": 1},
        {"ticker": "AAPL", "status": "OK", "results": [later]},
        {"ticker": "AAPL", "status": "OK", "results": [], "resultsCount": 0},
        {"ticker": "AAPL", "status": "OK"},
    )
    rows = bars_of(spark, path).orderBy("date").collect()
    assert [(r["date"], r["close"], r["trade_count"], r["vwap"]) for r in rows] == [
        (D(2025, 1, 6), 104.0, 42, 102.5),
        (D(2025, 1, 7), 104.0, None, None),
    ]
    assert rows[0]["source"] == "massive" and rows[0]["run_id"] == "r1"


def test_bar_without_close_fails(spark, tmp_path):
    broken = {k: v for k, v in BAR.items() if k != "c"}
    path = write_pages(tmp_path, {"ticker": "AAPL", "status": "OK", "results": [broken]})
    with pytest.raises(PySparkException, match="required field c"):
        bars_of(spark, path).collect()


def series_of(spark, *documents, start="2025-01-01", end="2025-01-02"):
    landed = spark.createDataFrame(
        [(str(i), "BTC", "crypto", json.dumps(d)) for i, d in enumerate(documents)],
        "page_id string, symbol string, asset_type string, payload string",
    )
    return normalize_series(
        parse_series_pages(landed), start=start, end=end, run_id="r1", ingested_at=utc(2025, 1, 3)
    )


def test_series_match_on_timestamp(spark):
    hours = [ms(2025, 1, 1, h) for h in range(24)] + [ms(2025, 1, 2, h) for h in range(24)]
    outside = [ms(2024, 12, 31, 23), ms(2025, 1, 3)]
    document = {
        "prices": [[t, 100.0 + i] for i, t in enumerate(hours)]
        + [[hours[0], 777.0]]
        + [[t, 1.0] for t in outside],
        "total_volumes": [[t, 5.0] for t in hours[1:]] + [[hours[5] + 1, 9.0]],
        "market_caps": [],
    }
    rows = {r["ts_ms"]: r for r in series_of(spark, document).collect()}
    assert sorted(rows) == hours
    assert rows[hours[0]]["close"] == 777.0 and rows[hours[0]]["volume"] is None
    assert rows[hours[1]]["volume"] == 5.0 and rows[hours[1]]["open"] is None
    days = collapse_to_day(series_of(spark, document), ["ts_ms", "page_id"]).orderBy("date").collect()
    assert [(r["date"], r["close"]) for r in days] == [(D(2025, 1, 1), 777.0), (D(2025, 1, 2), 124.0)]


@pytest.mark.parametrize("field", ["prices", "total_volumes", "market_caps"])
def test_series_rejects_pairs_of_wrong_length(spark, field):
    document = {"prices": [[ms(2025, 1, 1), 1.0]], field: [[ms(2025, 1, 1), 1.0, 2.0]]}
    with pytest.raises(PySparkException, match=f"{field}: expected"):
        series_of(spark, document).collect()


def test_empty_series_document(spark):
    assert series_of(spark, {}).count() == 0


def test_flat_series(spark):
    bounds = spark.sql("select date'2025-01-01' as start, date'2025-01-05' as end")
    rows = flat_series(bounds, run_id="r1", ingested_at=utc(2025, 1, 6)).collect()
    assert len(rows) == 5
    assert all((r["open"], r["close"], r["volume"], r["source"]) == (1.0, 1.0, None, "synthetic") for r in rows)


def test_union_promotes_untyped_nulls_and_filters_on_catalog(spark):
    full = spark.createDataFrame([bronze_row("A", D(2025, 1, 1), 1.0, utc(2025, 1, 2))], BRONZE)
    bare = full.selectExpr("source", "asset_type", "'B' as symbol", "date", "close", "null as vwap", "ingested_at", "run_id")
    out = union_sources(full, bare)
    assert out.schema["vwap"].dataType.simpleString() == "double"
    assert {r["symbol"] for r in out.collect()} == {"A", "B"}
    only = union_sources(full, bare, catalog=spark.sql("select 'B' as symbol"))
    assert [r["symbol"] for r in only.collect()] == ["B"]


# -- bronze ---------------------------------------------------------------------------------


def bronze(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE)


def test_bronze_rerun_replaces_its_folders_only(spark, tmp_path):
    root = str(tmp_path / "bronze")
    day = utc(2025, 1, 2, 3)
    fx = bronze_row("C:X", D(2025, 1, 1), 2.0, day, asset_type="fx")
    first = write_bronze(bronze(spark, bronze_row("A", D(2025, 1, 1), 98.0, day), fx), root)
    assert first == Written(2, D(2025, 1, 2), D(2025, 1, 2), D(2025, 1, 1), D(2025, 1, 1))
    again = [bronze_row("A", D(2025, 1, 1), 99.0, day), bronze_row("A", D(2025, 1, 2), 101.0, day)]
    assert write_bronze(bronze(spark, *again), root).rows == 2
    rows = read_bronze(spark, root)
    assert sorted(r["close"] for r in rows.where("asset_type = 'stock'").collect()) == [99.0, 101.0]
    assert rows.where("asset_type = 'fx'").count() == 1


def test_bronze_empty_batch_writes_nothing(spark, tmp_path):
    root = tmp_path / "bronze"
    assert write_bronze(bronze(spark), str(root)).rows == 0
    assert not list(root.rglob("*.parquet"))


def test_bronze_violation_publishes_nothing_and_reports_all(spark, tmp_path):
    root = tmp_path / "bronze"
    good = bronze_row("A", D(2025, 1, 1), 98.0, utc(2025, 1, 2))
    bad = list(bronze_row("A", D(2025, 1, 2), -5.0, utc(2025, 1, 2)))
    bad[0] = "elsewhere"
    with pytest.raises(ContractError) as failed:
        write_bronze(bronze(spark, good, tuple(bad)), str(root))
    found = {(c, col) for c, col, _ in failed.value.found}
    assert ("accepted_values", "source") in found and ("at_least_0", "close") in found
    assert not list(root.rglob("*.parquet"))


def test_bronze_is_strict_about_columns(spark, tmp_path):
    rows = bronze(spark, bronze_row("A", D(2025, 1, 1), 98.0, utc(2025, 1, 2)))
    with pytest.raises(ContractError, match="no_extra_columns"):
        write_bronze(rows.withColumn("surprise", rows.close), str(tmp_path / "b"))


def test_bronze_needs_every_column_and_coerces_types(spark, tmp_path):
    rows = bronze(spark, bronze_row("A", D(2025, 1, 1), 98.0, utc(2025, 1, 2)))
    with pytest.raises(ContractError, match="column_present"):
        write_bronze(rows.drop("vwap"), str(tmp_path / "b"))
    text = rows.withColumns({"close": rows.close.cast("string"), "trade_count": rows.trade_count.cast("long")})
    assert write_bronze(text, str(tmp_path / "b")).rows == 1
    assert read_bronze(spark, str(tmp_path / "b")).first()["close"] == 98.0
    with pytest.raises(ContractError, match="castable_to_double"):
        write_bronze(text.withColumn("close", F.lit("n/a")), str(tmp_path / "c"))


def test_coercion_reports_values_that_do_not_fit(spark):
    raw = spark.sql("select * from values ('1.5'), ('x'), (null) as v(close)")
    frame, rules = coerce(raw, BRONZE)
    assert frame.schema["close"].dataType.simpleString() == "double"
    assert violating_rows(frame, rules).count() == 1


def test_violating_rows_list_every_rule(spark):
    bad = list(bronze_row("A", D(2025, 1, 2), -5.0, utc(2025, 1, 2)))
    (row,) = violating_rows(bronze(spark, tuple(bad)), BRONZE_RULES).collect()
    assert "at_least_0(close)" in row["violations"] and "at_least_0(open)" in row["violations"]


# -- seeds, calendar, sinks, log --------------------------------------------------------------


def test_seed_files_and_fingerprints(spark, tmp_path):
    seeds = tmp_path / "seeds"
    seeds.mkdir()
    (seeds / "asset_catalog.csv").write_text("symbol,name,base_ccy,price_completeness\nBTC,Bitcoin,USD,close_volume_only\n")
    (seeds / "other.csv").write_text("a\n1\n")
    assert read_catalog(spark, str(seeds / "asset_catalog.csv")).schema.names == ASSET_CATALOG.names
    stored = str(tmp_path / "fingerprints")
    write_fingerprints(read_seed_files(spark, str(seeds)), stored)
    known = spark.read.parquet(stored)
    assert changed_files(read_seed_files(spark, str(seeds)), known).count() == 0
    (seeds / "other.csv").write_text("a\n2\n")
    (seeds / "new.csv").write_text("b\n")
    names = {r[0] for r in changed_files(read_seed_files(spark, str(seeds)), known).collect()}
    assert names == {"other", "new"}


def test_trading_calendar(spark):
    bounds = spark.sql("select date'2025-01-01' as start, date'2025-01-03' as end")
    days = spark.sql("select * from values (date'2025-01-02'), (date'2025-01-02') as v(date)")
    rows = trading_calendar(bounds, days).orderBy("date").collect()
    assert [r["is_trading_day"] for r in rows] == [False, True, False]


def test_write_answer(spark, tmp_path):
    df = spark.sql("select 'a' as symbol, 1.5D as value")
    write_answer(df, str(tmp_path), "t")
    write_answer(df, str(tmp_path), "t")
    assert spark.read.parquet(str(tmp_path / "t" / "parquet")).collect() == df.collect()
    assert spark.read.option("header", True).csv(str(tmp_path / "t" / "csv")).count() == 1


def test_stage_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_stage_log(spark, path).count() == 0

    def fill(meta):
        meta["rows"] = 7

    timed_stage(spark, path, "ok", fill, run_label="demo")

    def fail(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        timed_stage(spark, path, "broken", fail)
    (tmp_path / "log" / "extra.txt").write_text('\n\n{"stage":"old","started_at":"2025-01-01T00:00:00+00:00","duration_s":1.0}\n\n')
    rows = {r["stage"]: r for r in read_stage_log(spark, path).collect()}
    assert set(rows) == {"ok", "broken", "old"}
    assert rows["ok"]["status"] == "ok" and json.loads(rows["ok"]["meta"]) == {"rows": 7}
    assert rows["broken"]["status"] == "error" and rows["broken"]["run_label"].startswith("daily-")
    assert rows["old"]["rss_mb_peak"] is None and rows["ok"]["run_label"] == "demo"

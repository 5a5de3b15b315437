"""The stored lake: increments, pruned reads, the gold gate, atomic publication."""

from __future__ import annotations

import datetime as dt
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pricelake.functions.dates import date_id, date_of
from pricelake.operators import metrics_increment as mi
from pricelake.operators.facts import FACT, FACT_MONTH
from pricelake.operators.gold_gate import GAPS, RECOMPUTED, gold_report
from pricelake.operators.metrics import fact_daily_metrics, metric_columns
from pricelake.operators.numbering import number_rows
from pricelake.operators.quality import QualityGateError
from pricelake.operators.run_history import track_run
from pricelake.operators.upsert import merge_into, stage_merge
from pricelake.plans.workflows import SILVER, Lake, Settings
from pricelake.schemas import ASSET_CATALOG, BRONZE, DQ_HISTORY, FACT_KEY
from pricelake.sources.bronze import read_bronze, write_bronze
from pricelake.sources.sinks import Answers
from pricelake.sources.versioned import MonthlyTable, PublishConflict, VersionedTable
from pricelake.streaming.bronze_to_silver import merge_available, stream_bronze
from tests.conftest import bronze_row, utc

D = dt.date
NAMES = ["BTC", "AAPL", "OLD", "SPARSE", "NEW"]


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE)


def months_listed(df):
    return {re.search(r"month=(\d{4}-\d{2})", f)[1] for f in df.inputFiles()}


# -- incremental metrics ------------------------------------------------------------------


class Stored:
    """Fact, index and metrics that take batches of (asset_id, date, close)."""

    def __init__(self, spark, root):
        self.spark = spark
        self.fact = MonthlyTable(spark, f"{root}/fact", FACT, FACT_MONTH)
        self.index, self.metrics = mi.index_table(spark, f"{root}/index"), mi.metrics_table(spark, f"{root}/metrics")
        self.spans = VersionedTable(spark, f"{root}/spans")

    def take(self, batch):
        rows = [(a, int(d.strftime("%Y%m%d")), None, None, None, c, None, None, None, utc(2025, 1, 1)) for a, d, c in batch]
        fresh = self.spark.createDataFrame(rows, FACT)
        fact = stage_merge(self.fact, fresh, self.fact.touched_months(fresh), keys=FACT_KEY, always_replace=True)
        index = self.index.stage(mi.month_index(fact.rows()), fact.months)
        done = mi.stage_metrics(self.metrics, fact, index, fresh, benchmark_id=1, spans_table=self.spans)
        for part in (fact, index, done.staged):
            part.commit()
        return done

    def rebuilt(self):
        fact = self.fact.read()
        dates = fact.select("date_id", date_of(F.col("date_id")).alias("date")).distinct()
        assets = self.spark.createDataFrame(list(enumerate(NAMES, 1)), "asset_id long, symbol string")
        return fact_daily_metrics(fact, dates, assets, benchmark="BTC")


def rounded(df):
    return sorted(tuple(None if v is None else round(v, 9) for v in r) for r in df.select(*FACT_KEY, *metric_columns()).collect())


@pytest.mark.parametrize("seed", range(2))
def test_incremental_metrics_equal_a_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    days = [D(2022, 1, 1) + dt.timedelta(days=i) for i in range(560)]
    history = [(1, d, rng.uniform(50, 150)) for d in days if rng.random() < 0.9]
    history += [(2, d, rng.uniform(5, 15)) for d in days[60:] if d.weekday() < 5]
    history += [(3, d, rng.uniform(1, 2)) for d in days[:250]]
    history += [(4, d, rng.uniform(10, 20)) for d in rng.sample(days, 40)]  # thirty rows reach over years
    stored = Stored(spark, str(tmp_path))
    stored.take([r for r in history if r[1] < days[520]])
    last = stored.metrics.months()
    batches = [
        [r for r in history if days[520] <= r[1] < days[525]],  # some days more
        [r for r in history if r[1] >= days[525]],
        [(4, rng.choice(days[300:500]), 33.0), (2, rng.choice(days[100:300]), 9.5)],  # late rows
        [(1, days[450], 99.0)],  # the benchmark corrected
        [(3, days[0] - dt.timedelta(days=40), 3.0), (5, days[-1], 7.0)],  # before the first row; a new asset
    ]
    if seed == 1:
        batches.append([(1, D(2021, 12, 1), 42.0)])  # before the benchmark's first row
    for batch in batches:
        done = stored.take(batch)
        assert rounded(stored.metrics.read()) == rounded(stored.rebuilt())
        now = stored.metrics.months()
        assert {m for m in now if now[m] != last.get(m)} == done.staged.months
        last = now


def test_a_day_more_reads_thirteen_months_and_rewrites_one(spark, tmp_path):
    stored = Stored(spark, str(tmp_path))
    days = [D(2021, 1, 1) + dt.timedelta(days=i) for i in range(1200)]
    stored.take([(a, d, 10.0 + i % 7) for a in (1, 2) for i, d in enumerate(days)])
    before = stored.fact.months()
    done = stored.take([(a, days[-1] + dt.timedelta(days=1), 11.0) for a in (1, 2)])
    assert done.staged.months == {"2024-04"}
    assert len(done.read_months) == 13 and min(done.read_months) == "2023-04"
    now = stored.fact.months()
    assert {m for m in now if now[m] != before.get(m)} == {"2024-04"}


# -- stored tables ------------------------------------------------------------------------


@pytest.fixture
def table(spark, tmp_path):
    return MonthlyTable(spark, str(tmp_path / "t"), BRONZE)


def test_stored_table_gains_a_column(spark, table):
    day = D(2025, 1, 10)
    merge_into(table, frame(spark, bronze_row("A", day, 1.0, utc(2025, 1, 11)), bronze_row("A", D(2025, 2, 1), 2.0, utc(2025, 2, 2))))
    wider = frame(spark, bronze_row("B", day, 3.0, utc(2025, 1, 12))).withColumn("currency", F.lit("EUR"))
    merge_into(table, wider)
    assert table.schema.names == [*BRONZE.names, "currency"]
    merge_into(table, frame(spark, bronze_row("C", D(2025, 3, 1), 4.0, utc(2025, 3, 2))))  # a batch without it
    got = {(r["symbol"], str(r["date"])): r["currency"] for r in table.read().collect()}
    assert got == {("A", "2025-01-10"): None, ("A", "2025-02-01"): None, ("B", "2025-01-10"): "EUR", ("C", "2025-03-01"): None}


def test_two_publishers_do_not_overwrite_each_other(spark, table):
    one = frame(spark, bronze_row("A", D(2025, 1, 1), 1.0, utc(2025, 1, 2)))
    first, second = table.stage(one, {"2025-01"}), table.stage(one.withColumn("close", F.lit(2.0)), {"2025-01"})
    first.commit()
    with pytest.raises(PublishConflict):
        second.commit()
    assert table.read().first()["close"] == 1.0
    t = VersionedTable(spark, table.root + "-v")
    other = VersionedTable(spark, table.root + "-v")
    t.stage(one)
    other.stage(one)
    assert t.read() is None
    t.commit()
    with pytest.raises(PublishConflict):
        other.commit()


def test_failed_answers_leave_the_last_ones(spark, tmp_path):
    answers = Answers(spark, str(tmp_path))
    with pytest.raises(LookupError):
        answers.read("a")
    good = {"a": spark.range(3), "b": spark.range(2)}
    assert answers.publish(good) == ["a", "b"]
    bad = {"a": spark.range(9), "b": spark.range(2).withColumn("x", F.raise_error(F.lit("boom")))}
    with pytest.raises(PySparkException, match="boom"):
        answers.publish(bad)
    assert answers.read("a").count() == 3 and answers.read("b").count() == 2
    answers.publish({"a": spark.range(5)}, then=lambda read: {"c": read("a").selectExpr("id + 1 AS next")})
    assert answers.read("a").count() == 5 and answers.read("c").agg(F.max("next")).first()[0] == 5
    assert spark.read.option("header", True).csv(answers.folder("c", "csv")).count() == 5


def test_numbering_evaluates_its_input_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    rows = spark.range(1000).repartition(4).mapInArrow(counted, "id long")
    out = number_rows(rows, [-F.col("id")], "n", ranges=5)
    assert [tuple(r) for r in out.orderBy("n").collect()] == [(999 - i, i + 1) for i in range(1000)]
    assert calls.value == 1000


def test_bronze_reads_untyped_columns(spark, tmp_path):
    root = str(tmp_path / "bronze")
    write_bronze(frame(spark, bronze_row("A", D(2025, 1, 1), 2.0, utc(2025, 1, 2))), root)
    folder = tmp_path / "bronze" / "source=coingecko" / "asset_type=crypto" / "ingested_date=2025-01-02"
    folder.mkdir(parents=True)
    stamp = pa.array([utc(2025, 1, 2)], pa.timestamp("us", "UTC"))
    columns = {"symbol": ["BTC"], "date": [D(2025, 1, 1)], "close": [9.5], "open": pa.nulls(1), "trade_count": pa.nulls(1), "ts_ms": pa.nulls(1), "ingested_at": stamp, "run_id": ["r"]}
    pq.write_table(pa.table(columns), folder / "part-0.parquet")
    rows = {r["symbol"]: r for r in read_bronze(spark, root).collect()}
    assert (rows["BTC"]["close"], rows["BTC"]["open"], rows["BTC"]["trade_count"], rows["BTC"]["vwap"]) == (9.5, None, None, None)
    assert rows["A"]["open"] == 1.98 and rows["BTC"]["source"] == "coingecko"


# -- ticks over several batches -----------------------------------------------------------


def tick(ms, close, hour=3):
    return (*bronze_row("BTC", D(2025, 1, 10), close, utc(2025, 1, 12, hour), "r", "coingecko", "crypto"), ms)


def test_first_tick_wins_over_batches_and_restarts(spark, tmp_path):
    table = MonthlyTable(spark, str(tmp_path / "silver"), SILVER)
    root, mark = str(tmp_path / "bronze"), str(tmp_path / "mark")

    def land(*rows):
        spark.createDataFrame(list(rows), SILVER).withColumn("ingested_date", F.to_date("ingested_at")).write.mode("append").partitionBy("source", "asset_type", "ingested_date").parquet(root)
        # each call is a new query that goes on from the checkpoint
        merge_available(stream_bronze(spark, root), table, mark).awaitTermination()
        return table.read().first()["close"]

    assert land(tick(20, 50.0), tick(30, 60.0)) == 50.0
    assert land(tick(10, 40.0)) == 40.0  # an earlier tick comes with a later file
    assert land(tick(15, 45.0)) == 40.0
    assert land(tick(99, 70.0, hour=4)) == 70.0  # fetched again later: newer data replace older
    assert land(tick(5, 35.0, hour=3)) == 70.0


# -- a lake --------------------------------------------------------------------------------


def prices(run_id, first, last, stamp, scale=1.0):
    rows, d = [], first
    while d <= last:
        n = (d - D(2023, 1, 1)).days
        rows.append(bronze_row("BTC", d, (100.0 + n % 50) * scale, stamp, run_id, "coingecko", "crypto"))
        if d.weekday() < 5:
            rows.append(bronze_row("AAPL", d, 50.0 + n % 7, stamp, run_id))
        d += dt.timedelta(days=1)
    return rows


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake") / "l"), Settings(max_lag_days=4))
    lake.run(frame(spark, *prices("r1", D(2023, 1, 1), D(2024, 6, 28), utc(2024, 6, 29))), catalog(spark), run_id="r1", as_of="2024-06-28")
    return lake


def catalog(spark):
    return spark.createDataFrame([("BTC", "Bitcoin", "USD", "close_volume_only")], ASSET_CATALOG)


def test_reads_of_a_year_list_its_months(spark, lake):
    year, metrics = lake.star("2023-07-01", "2024-06-28")
    wanted = {f"2023-{m:02}" for m in range(7, 13)} | {f"2024-{m:02}" for m in range(1, 7)}
    assert months_listed(lake.fact.between("2023-07-01", "2024-06-28")) == wanted == months_listed(lake.metrics.between("2023-07-01", "2024-06-28"))
    whole, all_metrics = lake.star()
    in_year = "date BETWEEN '2023-07-01' AND '2024-06-28'"
    assert sorted(year.collect()) == sorted(whole.where(in_year).collect())
    assert metrics.count() == all_metrics.where(in_year).count()
    plan = year._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(date_id,20230701)" in plan and "LessThanOrEqual(date_id,20240628)" in plan
    ytd = {r["symbol"]: r["return"] for r in lake.year_to_date("2024-06-28").collect()}
    closes = {r["date"]: r["close"] for r in whole.where("symbol = 'BTC'").collect()}
    assert ytd["BTC"] == pytest.approx(closes[D(2024, 6, 28)] / closes[D(2024, 1, 1)] - 1) and set(ytd) == {"BTC", "AAPL"}
    assert lake.last_days(7, "2022-06-01").where("return IS NULL").count() == 2


def test_an_increment_touches_its_months_only(spark, lake):
    before = {t: getattr(lake, t).months() for t in ("silver", "fact", "metrics", "index")}
    rows = frame(spark, *prices("r2", D(2024, 7, 1), D(2024, 7, 2), utc(2024, 7, 3)))
    lake.run(rows, catalog(spark), run_id="r2", as_of="2024-07-02")
    for t, old in before.items():
        now = getattr(lake, t).months()
        assert {m for m in now if now[m] != old.get(m)} == {"2024-07"}, t
    assert lake.intake.changed_months() == set()
    assets, dates = lake.gold("dim_asset"), lake.gold("dim_date")
    assert rounded(lake.metrics.read()) == rounded(fact_daily_metrics(lake.fact.read(), dates, assets, benchmark="BTC"))
    assert dates.count() == lake.silver.read().select("date").distinct().count()
    lake.transform(catalog(spark))  # nothing new: nothing changes
    assert lake.fact.months().keys() == before["fact"].keys() | {"2024-07"}


def checks(lake, run_id):
    rows = lake._history("quality", DQ_HISTORY).where((F.col("run_id") == run_id) & ~F.col("passed")).collect()
    return {r["test_name"]: r["row_count"] for r in rows}


def test_gold_checks_stop_a_run(spark, lake):
    state = lambda: (lake.fact.months(), lake.metrics.months(), lake.gold("dim_date").count())
    before, published = state(), lake.answers.read("volatility_summary").collect()
    # a row whose open (118.8) and close are above its high, and a trading day on which a stock has no price
    wrong = list(bronze_row("BTC", D(2024, 8, 1), 120.0, utc(2024, 8, 2), "r3", "coingecko", "crypto"))
    wrong[5] = 110.0
    with pytest.raises(QualityGateError, match="close_within_low_high"):
        lake.run(frame(spark, tuple(wrong)), catalog(spark), run_id="r3", as_of="2024-07-02")
    assert checks(lake, "r3") == {"fact_daily_price.close_within_low_high": 1, "fact_daily_price.open_within_low_high": 1, GAPS: 1}
    assert state() == before and lake.answers.read("volatility_summary").collect() == published
    runs = {r["run_id"]: r["status"] for r in lake.health(today="2024-07-05")["runs"].collect()}
    assert runs["r3"] == "failed" and runs["r1"] == "success"
    # mended, the same months go through
    mended = [bronze_row("BTC", D(2024, 8, 1), 120.0, utc(2024, 8, 3), "r4", "coingecko", "crypto"), bronze_row("AAPL", D(2024, 8, 1), 51.0, utc(2024, 8, 3), "r4")]
    lake.run(frame(spark, *mended), catalog(spark), run_id="r4", as_of="2024-08-01")
    assert "2024-08" in lake.fact.months() and checks(lake, "r4") == {}
    # a row of the stored fact without an asset stops the next run that rewrites its month
    stray = lake.fact.read({"2024-08"}).limit(1).withColumn("asset_id", F.lit(999).cast("long"))
    merge_into(lake.fact, stray, keys=FACT_KEY)
    more = frame(spark, *prices("r5", D(2024, 8, 2), D(2024, 8, 2), utc(2024, 8, 4)))
    with pytest.raises(QualityGateError, match="fact_daily_price.asset_id.reference"):
        lake.run(more, catalog(spark), run_id="r5", as_of="2024-08-02")
    assert checks(lake, "r5")["fact_daily_price.asset_id.reference"] == 1


def test_gold_report_finds_each_fault(spark, lake):
    tables = {t: lake.gold(t) for t in ("dim_asset_type", "dim_asset", "dim_date")}
    tables |= {"fact_daily_price": lake.fact.read({"2023-03"}), "fact_daily_metrics": lake.metrics.read({"2023-03"})}
    options = {"known_assets": tables["dim_asset"], "months": {"2023-03"}, "halo": lake.fact.read({"2023-01", "2023-02", "2023-03"})}

    def failing(**changed):
        lines = gold_report({**tables, **changed}, **options).collect()
        assert len({r["test_name"] for r in lines}) == len(lines) == 40
        return {r["test_name"]: r["row_count"] for r in lines if not r["passed"]}

    assert failing() == {}
    assets, fact, metrics = tables["dim_asset"], tables["fact_daily_price"], tables["fact_daily_metrics"]
    assert failing(dim_asset=assets.withColumn("base_ccy", F.when(F.col("symbol") == "BTC", "EUR"))) == {"dim_asset.base_ccy.accepted": 1, "dim_asset.base_ccy.not_null": 1}
    assert failing(fact_daily_price=fact.unionByName(fact.limit(1))) == {"fact_daily_price.asset_id_date_id.unique": 1}
    stock = assets.where("symbol = 'AAPL'").first()["asset_id"]
    holes = fact.where((F.col("asset_id") != stock) | (F.col("date_id") % 100 > 3))
    assert failing(fact_daily_price=holes) == {GAPS: 3}
    shifted = metrics.withColumn("rolling_return_30d", F.col("rolling_return_30d") + 0.5)
    assert failing(fact_daily_metrics=shifted) == {RECOMPUTED: metrics.count()}
    worse = fact.withColumns({"close": F.lit(-1.0), "volume": F.lit(-5.0), "low": F.lit(None).cast("double"), "high": F.lit(None).cast("double")})
    assert failing(fact_daily_price=worse) == {"fact_daily_price.close.range": fact.count(), "fact_daily_price.volume.range": fact.count()}
    warned = gold_report({**tables, "fact_daily_price": holes}, **options, severity={GAPS: "warn"})
    assert {r["test_name"]: r["severity"] for r in warned.where("NOT passed").collect()} == {GAPS: "warn"}


def test_what_to_fetch_next(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "l"), Settings(max_lag_days=2, backfill_days=10))
    assert lake.next_window(today="2024-03-01") == (D(2024, 2, 20), D(2024, 2, 29)) and lake.backfill(today="2024-03-01") is None
    asked = []

    def fetch(first, last):
        asked.append((first, last))
        return frame(spark, *prices("x", first, last, utc(2024, 3, 1)))

    assert "lump_sum" in lake.update(fetch, catalog(spark), run_id="u1", today="2024-03-01")
    assert lake.update(fetch, catalog(spark), run_id="u2", today="2024-03-01") == []
    assert asked == [(D(2024, 2, 20), D(2024, 2, 29))]
    assert lake.next_window(today="2024-03-03") == (D(2024, 3, 1), D(2024, 3, 2)) and lake.backfill(today="2024-03-03") == (D(2024, 2, 20), D(2024, 3, 2))
    symbols = spark.createDataFrame([("BTC",), ("NEW",)], "symbol string")
    assert {r["symbol"]: r["start"] for r in lake.windows_by_symbol(symbols, today="2024-03-03").collect()} == {"BTC": D(2024, 3, 1), "NEW": D(2024, 2, 22)}
    # a stale symbol fails the gate and is named
    with track_run(spark, lake.path("meta", "runs"), "u3") as run, pytest.raises(QualityGateError, match="freshness"):
        lake.ingest(frame(spark, bronze_row("BTC", D(2024, 3, 9), 100.0, utc(2024, 3, 10), "u3", "coingecko", "crypto")), run, as_of="2024-03-09")
    health = lake.health(today="2024-03-10")
    assert [tuple(r) for r in health["stale_symbols"].collect()] == [("silver.freshness", "AAPL")]
    assert [tuple(r) for r in health["suggested_range"].collect()] == [(D(2024, 2, 29), D(2024, 3, 9))]
    assert health["checks"].where("NOT passed").count() == 1 and health["stuck_runs"].count() == 0 and health["lags"].count() == 2


def test_catalog_is_read_again_only_if_a_seed_changed(spark, tmp_path):
    seeds = tmp_path / "seeds"
    seeds.mkdir()
    file = seeds / "asset_catalog.csv"
    file.write_text("symbol,name,base_ccy,price_completeness\nBTC,Bitcoin,USD,close_volume_only\n")
    lake = Lake(spark, str(tmp_path / "l"))
    assert lake.catalog(str(seeds)).first()["name"] == "Bitcoin"
    first = lake._gold_table("asset_catalog").read().inputFiles()
    assert lake.catalog(str(seeds)).first()["name"] == "Bitcoin" and lake._gold_table("asset_catalog").read().inputFiles() == first
    file.write_text("symbol,name,base_ccy,price_completeness\nBTC,Coin,USD,close_volume_only\n")
    assert lake.catalog(str(seeds)).first()["name"] == "Coin"


def test_date_numbers(spark):
    days = spark.sql("SELECT explode(sequence(date'1999-12-28', date'2000-03-02')) AS d")
    assert days.where(date_of(date_id(F.col("d"))) != F.col("d")).count() == 0

"""End-to-end runs over a lake folder: ingest, transform, analyse.

The driver only orders the steps; every step reads tables and writes tables, so a lost
executor repeats tasks of one step and nothing depends on cached state. Layout of the lake:

    bronze/  silver/  gold/<table>/  meta/{runs,quality,stale_symbols,stages,seeds}  answers/<number>/<table>/

Each step works on what changed: ingest rewrites the months of its batch, transform those months of the facts and the
months of the metrics that the change reaches, and what transform has written is published once the gold checks have passed.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators import ingest_window, investing, quality, run_history
from pricelake.operators.correlation import correlation_long, correlation_matrix
from pricelake.operators.dimensions import dim_asset, dim_asset_type, dim_date
from pricelake.operators.facts import FACT, FACT_MONTH, FactIntake, star_metrics, star_prices
from pricelake.operators.gold_gate import gold_report
from pricelake.operators.metrics_increment import index_table, metrics_table, month_index, stage_metrics
from pricelake.operators.run_history import Run, track_run
from pricelake.operators.upsert import stage_merge
from pricelake.operators.volatility import volatility_summary
from pricelake.operators.window_returns import returns_by_window, window_return, ytd_return
from pricelake.schemas import ASSET_CATALOG, BRONZE, DQ_HISTORY, FINGERPRINTS, RUN_EVENTS, WINDOW_DAYS
from pricelake.sources.bronze import TICK, Written, read_bronze, write_bronze
from pricelake.sources.seeds import changed_files, read_catalog, read_seed_files, write_fingerprints
from pricelake.sources.sinks import Answers
from pricelake.sources.stage_log import timed_stage
from pricelake.sources.versioned import MonthlyTable, VersionedTable
from pricelake.streaming.bronze_to_silver import merge_available, stream_bronze

#: Silver keeps the order of ticks, so that the first tick of a day wins whichever batch brings it.
SILVER = T.StructType([*BRONZE.fields, T.StructField(TICK, T.LongType())])
STALE = "run_id string, symbol string, max_date date"
_DIMENSIONS = ("dim_asset_type", "dim_asset", "dim_date")


@dataclass
class Settings:
    """Parameters of a run; defaults are those of the daily job."""

    benchmark: str = "BTC"
    close_low: float = 0.0
    close_high: float = 10_000_000.0
    max_lag_days: int = 3
    windows_days: dict[str, int] = field(default_factory=lambda: dict(WINDOW_DAYS))
    lump_principal_usd: float = 1000.0
    dca_monthly_usd: float = 100.0
    dca_months: int = 12
    dca_buy_day: int = 1
    lookback_days: int = 365
    # columns of the wide correlation table, which is written for these symbols only
    matrix_symbols: list[str] | None = None
    # severity of gold checks by name where it is not "error"
    gold_severity: dict[str, str] = field(default_factory=dict)
    backfill_days: int = 365
    stale_run_hours: int = 2


class Lake:
    """The tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str, settings: Settings | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.settings = settings or Settings()
        self.silver = MonthlyTable(spark, f"{self.root}/silver", SILVER)
        self.fact = MonthlyTable(spark, f"{self.root}/gold/fact_daily_price", FACT, FACT_MONTH)
        self.index = index_table(spark, f"{self.root}/gold/asset_months")
        self.metrics = metrics_table(spark, f"{self.root}/gold/fact_daily_metrics")
        self.intake = FactIntake(f"{self.root}/gold/intake", self.fact, self.silver)
        self.answers = Answers(spark, f"{self.root}/answers")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def gold(self, name: str) -> DataFrame | None:
        """A gold table, or None before its first build."""
        if name == "fact_daily_price":
            return self.fact.read()
        if name == "fact_daily_metrics":
            return self.metrics.read()
        return self._gold_table(name).read()

    def _gold_table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path("gold", name))

    def _history(self, name: str, schema) -> DataFrame:
        """A table that runs append to; empty before the first."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path("meta", name))
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path("meta", name))

    def _timed(self, stage: str, action, run_id: str | None):
        return timed_stage(self.spark, self.path("meta", "stages"), stage, action, run_label=run_id)

    # -- steps ----------------------------------------------------------------------------

    def ingest(self, rows: DataFrame, run: Run, *, as_of) -> int:
        """Publish a normalised batch to bronze, merge it into silver, pass the quality gate.

        The rows are stamped with the run's id. Bronze keeps every tick of a day, in silver the
        first one is the day's close. What was stored is counted by source and month in one narrow scan.
        """
        bronze = self.path("bronze")
        columns = [*BRONZE.fieldNames(), *([TICK] if TICK in rows.columns else [])]
        stamped = rows.withColumn("run_id", F.lit(run.run_id)).select(*columns)

        def publish(meta: dict) -> Written:
            done = write_bronze(stamped, bronze)
            meta["rows"] = done.rows
            return done

        def load(meta: dict) -> int:
            written = self._timed("ingest:bronze", publish, run.run_id)
            if not written.rows:
                return 0
            meta["start_date"], meta["end_date"] = str(written.first_date), str(written.last_date)
            batch = read_bronze(self.spark, bronze, written).where(F.col("run_id") == run.run_id).select(*SILVER.fieldNames())
            counts = batch.groupBy("source", F.expr(self.silver.month).alias("month")).agg(F.count(F.lit(1)).alias("n")).collect()
            for r in counts:
                run.loaded[r["source"]] = run.loaded.get(r["source"], 0) + r["n"]
            stage_merge(self.silver, batch, {r["month"] for r in counts}, arrival=[TICK]).commit()
            meta["silver_rows_merged"] = sum(r["n"] for r in counts)
            return meta["silver_rows_merged"]

        merged = self._timed("ingest:total", load, run.run_id)
        if merged:
            self._timed(
                "ingest:dq_assertions", lambda meta: self.check(as_of, run.run_id, meta), run.run_id
            )
        return merged

    def stream(self, checkpoint: str, max_files: int | None = None):
        """Merge bronze files that have not been read yet into silver and stop; returns the query."""
        return merge_available(stream_bronze(self.spark, self.path("bronze"), max_files), self.silver, checkpoint)

    def check(self, as_of, run_id: str | None = None, meta: dict | None = None) -> None:
        """Record the silver checks, then raise if one of severity error failed.

        The counts of the checks (one row each) go into ``meta`` before anything is raised.
        """
        s = self.settings
        history = self.path("meta", "quality")
        report = quality.silver_report(
            self.silver.read(),
            as_of=as_of,
            low=s.close_low,
            high=s.close_high,
            max_lag_days=s.max_lag_days,
        ).persist()
        try:
            for line in report.collect():
                found = json.loads(line["details"])
                (meta if meta is not None else {}).update({k: v for k, v in found.items() if isinstance(v, int)})
            quality.record_report(report, history, run_id=run_id)
            stale = quality.stale_symbols(self.silver.read(), as_of=as_of, max_lag_days=s.max_lag_days)
            named = stale.select(F.lit(run_id).cast("string").alias("run_id"), "symbol", "max_date")
            named.write.mode("append").parquet(self.path("meta", "stale_symbols"))
            quality.enforce(report)
        finally:
            report.unpersist()

    def transform(self, catalog: DataFrame, calendar: DataFrame | None = None, run_id: str | None = None) -> None:
        """Bring what silver gained into the gold tables; nothing is published unless the gold checks pass."""
        changed = self.silver.read(self.intake.changed_months())
        known = {name: self.gold(name) for name in _DIMENSIONS}

        def also(rows: DataFrame, name: str, column: str, stored: str) -> DataFrame:
            rows = rows.select(column)
            return rows if known[name] is None else rows.unionByName(known[name].select(F.col(stored).alias(column)))

        tables = {name: self._gold_table(name) for name in _DIMENSIONS}
        gold = {"dim_asset_type": tables["dim_asset_type"].stage(dim_asset_type(also(changed, "dim_asset_type", "asset_type", "name")))}
        gold["dim_asset"] = tables["dim_asset"].stage(dim_asset(changed, gold["dim_asset_type"], catalog, known["dim_asset"]))
        gold["dim_date"] = tables["dim_date"].stage(dim_date(also(changed, "dim_date", "date", "date"), calendar))
        taken = self.intake.stage(gold["dim_asset"], gold["dim_date"])
        parts = []
        if taken is None:
            report = gold_report(gold, severity=self.settings.gold_severity)
        else:
            fact, fresh = taken
            index = self.index.stage(month_index(fact.rows()), fact.months)
            own = gold["dim_asset"].where(F.col("symbol") == self.settings.benchmark).agg(F.min("asset_id")).first()[0]
            spans = VersionedTable(self.spark, self.path("gold", "intake", "spans"), keep=1)
            metrics = stage_metrics(self.metrics, fact, index, fresh, benchmark_id=own, spans_table=spans)
            parts = [fact, index, metrics.staged]
            gold |= {"fact_daily_price": fact.rows(), "fact_daily_metrics": metrics.staged.rows()}
            report = gold_report(
                gold, known_assets=known["dim_asset"], months=fact.months, halo=fact.read(metrics.read_months),
                severity=self.settings.gold_severity,
            )
        self._gate(report, run_id)
        for table in tables.values():
            table.commit()
        for part in parts:
            part.commit()
        if taken is not None:
            self.intake.commit(taken[1])

    def _gate(self, report: DataFrame, run_id: str | None) -> None:
        """Record the lines of a report and raise if one of severity error failed."""
        lines = self.spark.createDataFrame(report.collect(), report.schema).coalesce(1)  # one line for each check
        quality.record_report(lines, self.path("meta", "quality"), run_id=run_id)
        quality.enforce(lines)

    def star(self, first=None, last=None) -> tuple[DataFrame, DataFrame]:
        """(prices, metrics) by symbol and date. Of a range of dates only its months are listed."""
        assets, types, dates = (self.gold(t) for t in ("dim_asset", "dim_asset_type", "dim_date"))
        prices = star_prices(self.fact.between(first, last), assets, types, dates, first, last)
        metrics = star_metrics(self.metrics.between(first, last), assets, types, dates, first, last)
        return prices, metrics

    def newest_date(self) -> dt.date | None:
        """The last date with a price, from the newest month of the fact."""
        newest = max(self.fact.months(), default=None)
        if newest is None:
            return None
        return dt.datetime.strptime(str(self.fact.read({newest}).agg(F.max("date_id")).first()[0]), "%Y%m%d").date()

    def year_to_date(self, as_of=None) -> DataFrame:
        """Return of the year so far of every symbol, from the year's months."""
        end = _day(as_of or self.newest_date())
        return ytd_return(self.star(end.replace(month=1, day=1), end)[0], end, self.gold("dim_asset"))

    def last_days(self, days: int, as_of=None) -> DataFrame:
        """Return of the last days of every symbol, from their months."""
        end = _day(as_of or self.newest_date())
        return window_return(self.star(end - dt.timedelta(days=days), end)[0], days, end, self.gold("dim_asset"))

    def analyse(self, as_of=None) -> list[str]:
        """Write the answer tables and publish them together; nothing is written while there are no prices."""
        s = self.settings
        newest = self.newest_date()
        if newest is None:
            return []
        end = _day(as_of or newest)
        prices, metrics = self.star()[0], self.star(last=end)[1]
        longest = max([*s.windows_days.values(), (end - end.replace(month=1, day=1)).days])
        recent_prices, _ = self.star(end - dt.timedelta(days=longest), end)
        _, recent_metrics = self.star(end - dt.timedelta(days=s.lookback_days), end)
        answers = {
            # last known values may be of any age, first and last closes lie in the windows
            "returns_by_window": returns_by_window(
                metrics, recent_prices, benchmark=s.benchmark, windows_days=s.windows_days, as_of=end, symbols=self.gold("dim_asset")
            ),
            "lump_sum": investing.lump_sum_one_year(
                prices, principal_usd=s.lump_principal_usd, as_of=end
            ),
            "dca_vs_lump": investing.dca_vs_lump_sum(
                prices,
                monthly_amount_usd=s.dca_monthly_usd,
                months=s.dca_months,
                buy_day=s.dca_buy_day,
                as_of=end,
                symbol=s.benchmark,
            ),
            "volatility_summary": volatility_summary(
                recent_metrics, lookback_days=s.lookback_days, as_of=end
            ),
            "correlation_long": correlation_long(recent_metrics, lookback_days=s.lookback_days, as_of=end),
        }
        order = {
            "returns_by_window": ["window", "symbol"],
            "volatility_summary": ["symbol"],
            "correlation_matrix": ["symbol"],
        }

        def wide(read) -> dict[str, DataFrame]:
            return {"correlation_matrix": correlation_matrix(read("correlation_long"), s.matrix_symbols)} if s.matrix_symbols else {}

        return self.answers.publish(answers, order, wide)

    # -- what to do next ---------------------------------------------------------------------

    def next_window(self, *, today, start=None, end=None) -> tuple[dt.date, dt.date] | None:
        """The dates to fetch; None if the lake is up to date."""
        newest = max(self.silver.months(), default=None)
        held = self.silver.read(set() if newest is None else {newest})  # the newest date is in the newest month
        found = ingest_window.ingest_window(held, today=today, lookback_days=self.settings.backfill_days, start=start, end=end).first()
        return None if found["up_to_date"] else (found["start"], found["end"])

    def windows_by_symbol(self, symbols: DataFrame, *, today) -> DataFrame:
        """The dates to fetch for each symbol, those that lag included."""
        return ingest_window.ingest_window_per_symbol(self.silver.read(), symbols, today=today, lookback_days=self.settings.backfill_days)

    def backfill(self, *, today) -> tuple[dt.date, dt.date] | None:
        """The dates to fetch again; None while there is nothing."""
        found = ingest_window.backfill_span(self.silver.read(), today=today).first()
        return None if found is None else (found["start"], found["end"])

    def health(self, *, today, now=None) -> dict[str, DataFrame]:
        """Recent and stuck runs, the lag of every symbol, a range that would mend it, recent and stale checks."""
        now = F.current_timestamp() if now is None else now
        runs = run_history.run_state(self._history("runs", RUN_EVENTS))
        lags = run_history.symbol_lag(self.silver.read(), today=today, max_lag_days=self.settings.max_lag_days)
        history = self._history("quality", DQ_HISTORY)
        return {
            "runs": run_history.recent_runs(runs),
            "stuck_runs": run_history.stale_runs(runs, now=now, hours=self.settings.stale_run_hours),
            "lags": lags,
            "suggested_range": run_history.suggested_range(lags, today=today),
            "checks": run_history.recent_quality(history, now=now),
            "stale_symbols": quality.stale_by_test(history, self._history("stale_symbols", STALE)),
        }

    def catalog(self, folder: str, name: str = "asset_catalog") -> DataFrame:
        """The asset catalog of a folder of seed files, which is read again only if a file changed."""
        files = read_seed_files(self.spark, folder)
        stored = self._gold_table(name).read()
        if stored is None or not changed_files(files, self._history("seeds", FINGERPRINTS)).isEmpty():
            stored = self._gold_table(name).replace(read_catalog(self.spark, f"{folder.rstrip('/')}/{name}.csv"))
            write_fingerprints(files, self.path("meta", "seeds"))
        return stored.select(*ASSET_CATALOG.fieldNames())

    def run(
        self,
        rows: DataFrame,
        catalog: DataFrame,
        *,
        run_id: str,
        as_of,
        calendar: DataFrame | None = None,
    ) -> list[str]:
        """One tracked run of all three steps; ``rows`` get the run's id."""
        with track_run(self.spark, self.path("meta", "runs"), run_id) as run:
            self.ingest(rows, run, as_of=as_of)
            self._timed("transform:total", lambda _: self.transform(catalog, calendar, run_id), run_id)
            return self._timed("analyze:total", lambda _: self.analyse(as_of), run_id)

    def update(self, fetch, catalog: DataFrame, *, run_id: str, today, start=None, end=None, calendar: DataFrame | None = None) -> list[str]:
        """A run over the dates that are missing: ``fetch(first, last)`` gives their rows. Up to date, nothing runs."""
        window = self.next_window(today=today, start=start, end=end)
        if window is None:
            return []
        return self.run(fetch(*window), catalog, run_id=run_id, as_of=window[1], calendar=calendar)


def _day(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))

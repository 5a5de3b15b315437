"""Frame contracts: rules evaluated in one pass, all violations reported."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.schemas import ASSET_TYPES, BRONZE, SOURCES


@dataclass(frozen=True)
class Rule:
    """``breaks`` builds a boolean column that is true where the rule is violated."""

    check: str
    column: str
    breaks: Callable[[], Column]


class ContractError(ValueError):
    """Carries (check, column, violations) triples."""

    def __init__(self, found: list[tuple]):
        self.found = found
        super().__init__("; ".join(f"{c}({col}): {n}" for c, col, n in found))


def not_null(column: str) -> Rule:
    return Rule("not_null", column, lambda: F.col(column).isNull())


def one_of(column: str, values: list[str]) -> Rule:
    return Rule("accepted_values", column, lambda: ~F.col(column).isin(values))


def at_least(column: str, low: float) -> Rule:
    return Rule(f"at_least_{low:g}", column, lambda: F.col(column) < F.lit(low))


def castable(column: str, kind: str) -> Rule:
    return Rule(
        f"castable_to_{kind}",
        column,
        lambda: F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull(),
    )


_AMOUNTS = ["open", "high", "low", "close", "volume", "vwap", "trade_count"]

BRONZE_RULES = [
    *[not_null(f.name) for f in BRONZE.fields if not f.nullable],
    one_of("source", SOURCES),
    one_of("asset_type", ASSET_TYPES),
    *[at_least(c, 0) for c in _AMOUNTS],
]

ANALYSIS_RULES = [
    not_null("symbol"),
    not_null("asset_type"),
    not_null("date"),
    not_null("close"),
    at_least("close", 0),
]


def extra_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns a strict contract does not know."""
    known = set(schema.fieldNames())
    return [c for c in df.columns if c not in known]


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [c for c in schema.fieldNames() if c not in df.columns]


def coerce(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[Rule]]:
    """Cast known columns to the contract's types; the rules report what did not fit.

    Returns the coerced frame with the original kept as ``<name>__raw`` only for columns
    whose type differs, and one castable rule for each of those.
    """
    rules, cols = [], []
    types = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in schema.fields}
    for name in df.columns:
        target = wanted.get(name)
        if target is None or target == types[name]:
            cols.append(F.col(name))
            continue
        kind = target.simpleString()
        cols += [F.col(name).try_cast(kind).alias(name), F.col(name).alias(f"{name}__raw")]
        rules.append(
            Rule(
                f"castable_to_{kind}",
                name,
                lambda n=name: F.col(f"{n}__raw").isNotNull() & F.col(n).isNull(),
            )
        )
    return df.select(*cols), rules


def report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(check, column, violations) for every rule: one scan, one partial aggregation."""
    counts = df.agg(*[F.count_if(r.breaks()).alias(f"v{i}") for i, r in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(
                F.lit(r.check).alias("check"),
                F.lit(r.column).alias("column"),
                F.col(f"v{i}").alias("violations"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))


def violating_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The offending rows with the list of rules each one breaks."""
    broken = F.array_compact(
        F.array(*[F.when(r.breaks(), F.lit(f"{r.check}({r.column})")) for r in rules])
    )
    return df.withColumn("violations", broken).where(F.size("violations") > 0)


def guard(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The same rows; evaluating a violating one fails the job."""
    names = F.concat_ws(
        ", ", *[F.when(r.breaks(), F.lit(f"{r.check}({r.column})")) for r in rules]
    )
    any_broken = F.lit(False)
    for r in rules:
        any_broken = any_broken | F.coalesce(r.breaks(), F.lit(False))
    passes = F.when(
        any_broken, F.raise_error(F.concat(F.lit("contract violated: "), names)).cast("boolean")
    ).otherwise(F.lit(True))
    return df.where(passes)

"""Decentralised-exchange trades: amounts, prices, top pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def human_amount(raw: Column, decimals: Column) -> Column:
    """raw / 10^decimals, exact for raw values up to 38 digits and decimals up to 18.

    Dividing decimals would cut the scale, so whole and fractional units are separated as
    digit strings and read back as one decimal.
    """
    digits = raw.cast("decimal(38,0)").cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), decimals + 1), F.lit("0"))
    whole = F.substr(padded, F.lit(1), F.length(padded) - decimals)
    fraction = F.substr(padded, F.length(padded) - decimals + 1, decimals)
    text = F.concat(whole, F.when(decimals > 0, F.concat(F.lit("."), fraction)).otherwise(""))
    return text.cast("decimal(38,18)")


def token_amounts(swaps: DataFrame, tokens: DataFrame) -> DataFrame:
    """Add human-readable amounts; ``tokens`` is (pair, decimals0, decimals1)."""
    scaled = swaps.join(tokens, "pair")
    return scaled.withColumns(
        {
            f"{side}_amount{n}": human_amount(F.col(f"amount{n}{side}"), F.col(f"decimals{n}"))
            for n in (0, 1)
            for side in ("In", "Out")
        }
    ).select(
        *swaps.columns,
        *[
            F.col(f"{side}_amount{n}").alias(f"amount{n}_{side.lower()}")
            for n in (0, 1)
            for side in ("In", "Out")
        ],
    )


def swap_price(amounts: DataFrame) -> DataFrame:
    """Direction of a swap and its price in units of token 0 per unit of token 1."""
    sells_zero = F.col("amount0_in") > 0
    paid = F.when(sells_zero, F.col("amount0_in")).otherwise(F.col("amount0_out"))
    got = F.when(sells_zero, F.col("amount1_out")).otherwise(F.col("amount1_in"))
    return amounts.withColumns(
        {
            "direction": F.when(sells_zero, "0->1").otherwise("1->0"),
            "price": paid.cast("double") / F.nullif(got.cast("double"), F.lit(0.0)),
        }
    )


def top_pairs(trades: DataFrame, *, now: Column, days: int = 7, n: int = 10) -> DataFrame:
    """The n busiest pairs of the last days: swaps, formatted volume, distinct takers.

    Grouping runs through partial aggregation; only the n result rows are numbered, by
    their place in the sorted array of winners.
    """
    recent = trades.where(F.col("block_time") >= now - F.expr(f"interval {int(days)} day"))
    best = (
        recent.groupBy("token_pair")
        .agg(
            F.count(F.lit(1)).alias("swap_count"),
            F.sum("amount_usd").alias("volume"),
            F.count_distinct("taker").alias("unique_takers"),
        )
        .orderBy(F.desc("swap_count"), "token_pair")
        .limit(n)
    )
    listed = best.agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    (-F.col("swap_count")).alias("o"), "token_pair", "swap_count", "volume", "unique_takers"
                )
            )
        ).alias("rows")
    )
    return listed.select(F.posexplode("rows").alias("pos", "r")).select(
        (F.col("pos") + 1).alias("rank"),
        "r.token_pair",
        "r.swap_count",
        F.concat(F.lit("$"), F.format_number("r.volume", 2)).alias("total_volume_usd"),
        "r.unique_takers",
    )

"""Queries over exchange trades."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators.dex import swap_price, token_amounts, top_pairs
from pricelake.plans.adapters import rounded, swaps, token_table, trades
from pricelake.plans.registry import query

_AMOUNTS_SQL = """SELECT event_id, event_type AS pair,
    CASE WHEN event_type = 'purchase' THEN 0 ELSE m END AS a0in,
    CASE WHEN event_type = 'purchase' THEN m ELSE 0 END AS a0out,
    CASE WHEN event_type = 'purchase' THEN a ELSE 0 END AS a1in,
    CASE WHEN event_type = 'purchase' THEN 0 ELSE a END AS a1out
  FROM (SELECT *, CAST(round(value * 1000000) AS HUGEINT) AS m,
               CAST(user_id + 1 AS HUGEINT) * 1000000000000007 AS a FROM events)"""


def _human(column: str, decimals: int) -> str:
    # whole units and the zero-padded remainder, as text with 18 decimals
    unit = 10**decimals
    return (
        f"CAST({column} // {unit} AS VARCHAR) || '.' || "
        f"rpad(lpad(CAST({column} % {unit} AS VARCHAR), {decimals}, '0'), 18, '0')"
    )


@query(
    "token_amounts",
    f"""SELECT event_id, pair, {_human("a0in", 6)} AS amount0_in, {_human("a0out", 6)} AS amount0_out,
    {_human("a1in", 18)} AS amount1_in, {_human("a1out", 18)} AS amount1_out
  FROM ({_AMOUNTS_SQL})""",
)
def q_token_amounts(spark, sf_dir):
    out = token_amounts(swaps(spark, sf_dir), token_table(spark, sf_dir))
    sides = ["amount0_in", "amount0_out", "amount1_in", "amount1_out"]
    # plain notation: a decimal of scale 18 casts to scientific text when it is small
    return out.select("event_id", "pair", *[_plain_text(c) for c in sides])


def _plain_text(column: str):
    return F.trim(F.to_char(F.col(column), F.lit("9" * 19 + "0." + "0" * 18))).alias(column)


@query(
    "swap_price",
    f"""SELECT event_id, CASE WHEN a0in > 0 THEN '0->1' ELSE '1->0' END AS direction,
    round((CASE WHEN a0in > 0 THEN a0in ELSE a0out END / 1e6)
      / (CASE WHEN a0in > 0 THEN a1out ELSE a1in END / 1e18), 4) AS price
  FROM ({_AMOUNTS_SQL})""",
)
def q_swap_price(spark, sf_dir):
    amounts = token_amounts(swaps(spark, sf_dir), token_table(spark, sf_dir))
    return rounded(swap_price(amounts).select("event_id", "direction", "price"), 4, "price")


@query(
    "top_pairs",
    """SELECT row_number() OVER (ORDER BY count(*) DESC, event_type)::INTEGER AS rank, event_type AS token_pair,
    count(*) AS swap_count, format('${:,.2f}', round(sum(value), 2)) AS total_volume_usd,
    count(DISTINCT user_id) AS unique_takers
  FROM events
  WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
  GROUP BY event_type ORDER BY 1 LIMIT 10""",
)
def q_top_pairs(spark, sf_dir):
    rows = trades(spark, sf_dir)
    return top_pairs(rows, now=rows.agg(F.max("block_time")).scalar())

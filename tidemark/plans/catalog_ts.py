"""Time-series queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import clean
from tidemark.operators import timeseries as ts
from tidemark.plans import features as feat
from tidemark.registry import register
from tidemark.sources import testviews as tv
from tidemark.sources.testviews import COINS, UNIT_US, VIEW_SQL

BIN_US = 120 * UNIT_US   # the reference's 120-second bars at test scale


@register("a3_market_bars", "WITH " + VIEW_SQL["quotes"] + f"""
SELECT time, open_time, close_time, CASE WHEN m IS NULL THEN NULL ELSE greatest(0, least(1, m)) END AS yes_mid,
       CASE WHEN s < 0 THEN 0 ELSE s END AS yes_spread FROM (
  SELECT make_timestamp(CAST(floor(epoch_us(curr_time) / {BIN_US}) AS BIGINT) * {BIN_US}) AS time, open_time, close_time,
         avg((yes_ask_dollars + yes_bid_dollars) / 2) AS m, avg(yes_ask_dollars - yes_bid_dollars) AS s
  FROM quotes WHERE coin = 'BTC' GROUP BY ALL)
WHERE m IS NOT NULL AND s IS NOT NULL""")
def a3_market_bars(spark, d):
    """A3: BTC market bars of mean mid / spread per (120-unit bin, event), clipped."""
    q = tv.quotes(spark, d).where("coin = 'BTC'").select(
        "curr_time", "open_time", "close_time", ((F.col("yes_ask_dollars") + F.col("yes_bid_dollars")) / 2).alias("yes_mid"),
        (F.col("yes_ask_dollars") - F.col("yes_bid_dollars")).alias("yes_spread"))
    return ts.market_bars(q, BIN_US)


def _acf_sql(src: str) -> str:
    lags = range(1, 8)
    return f"""
SELECT coin, CAST(lag AS BIGINT) AS lag, round(acf, 9) AS acf FROM (
  SELECT coin, unnest([{", ".join(str(k) for k in lags)}]) AS lag, unnest([{", ".join(f"p{k} / ss" for k in lags)}]) AS acf FROM (
    SELECT coin, sum(d * d) AS ss, {", ".join(f"sum(d * l{k}) AS p{k}" for k in lags)} FROM (
      SELECT coin, d, {", ".join(f"lag(d, {k}) OVER (PARTITION BY coin ORDER BY bar_time) AS l{k}" for k in lags)} FROM (
        SELECT coin, bar_time, x - avg(x) OVER (PARTITION BY coin) AS d FROM {src})) GROUP BY coin))"""


_BARS = f"""b AS (
  SELECT replace(product_id, '-USD', '') AS coin,
         make_timestamp(((epoch_us(trade_time) + {UNIT_US - 1}) // {UNIT_US}) * {UNIT_US}) AS bar_time,
         arg_max(price, (trade_time, id)) AS x
  FROM (SELECT * FROM trades WHERE product_id IN ('BTC-USD', 'ETH-USD', 'XRP-USD', 'SOL-USD')
        QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY curr_time, id) = 1) GROUP BY 1, 2)"""


@register("x1_acf_level", "WITH " + VIEW_SQL["trades"] + ",\n" + _BARS + _acf_sql("b"), ["acf"])
def x1_acf_level(spark, d):
    """Autocorrelation to lag 7 of each coin's bar price level."""
    bars = feat.spot_bars(clean.clean_trades(tv.trades(spark, d), COINS, with_id=False), None, UNIT_US).select(
        "coin", F.col("trade_time").alias("bar_time"), F.col("btc_spot_price").alias("x"))
    return ts.acf(bars, "coin", "bar_time", "x")


@register("x1_acf_difference", "WITH " + VIEW_SQL["trades"] + ",\n" + _BARS + """,
db AS (SELECT coin, bar_time, x - lag(x) OVER (PARTITION BY coin ORDER BY bar_time) AS x FROM b QUALIFY x IS NOT NULL)""" + _acf_sql("db"), ["acf"])
def x1_acf_difference(spark, d):
    """Autocorrelation to lag 7 of each coin's first-differenced bar price."""
    bars = feat.spot_bars(clean.clean_trades(tv.trades(spark, d), COINS, with_id=False), None, UNIT_US).select(
        "coin", F.col("trade_time").alias("bar_time"), F.col("btc_spot_price").alias("x"))
    w = Window.partitionBy("coin").orderBy("bar_time")
    db = bars.withColumn("x", F.col("x") - F.lag("x").over(w)).where(F.col("x").isNotNull())
    return ts.acf(db, "coin", "bar_time", "x")

"""Second-venue features (Q5) and the notebook variants of the feature build (Q8, Q9, A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.asof import AsofRight, asof_join
from tidemark.operators.clean import EVENT_COLS, dedupe_first, prepare_trades
from tidemark.operators.rangejoin import range_join
from tidemark.plans.features import UNIT_US, of_coins, whole_units

POLY_EVENT = ["coin", "interval_start_unix", "end_date"]


def polymarket_features(poly: DataFrame, trades: DataFrame, coin: str = "BTC", unit_us: int = UNIT_US,
                        max_ttc: int = 900) -> DataFrame:
    """Q5: second-venue ticks: ttc window, dedupe, lag time / volume (W1, W10), spot as-of, F8, F12."""
    p = poly.where(F.col("coin") == coin).withColumn("time_to_close", whole_units("end_date", "curr_time", unit_us))
    p = p.where((F.col("time_to_close") >= 0) & (F.col("time_to_close") <= max_ttc))
    p = dedupe_first(p, POLY_EVENT + ["time_to_close"], ["curr_time", "id"])
    w = Window.partitionBy(*POLY_EVENT).orderBy("curr_time")
    p = p.select("*", F.lag("curr_time").over(w).alias("prev_time"),
                 F.coalesce(F.col("volume") - F.lag("volume").over(w), F.lit(0.0)).alias("volume_delta_raw"))
    spot = prepare_trades(of_coins(trades, [coin])).select("coin", "trade_time", "price")
    p = asof_join(p, AsofRight(spot, "trade_time", ["price"]), "curr_time", by=["coin"])
    return p.select(
        "curr_time",
        F.col("interval_start_unix").alias("poly_interval_start_unix"),
        F.col("end_date").alias("poly_end_date"),
        F.col("time_to_close").alias("poly_time_to_close"),
        F.col("strike_price").alias("poly_strike_price"),
        F.col("liquidity").alias("poly_liquidity"),
        F.col("volume").alias("poly_volume"),
        # a falling cumulative volume counts as no volume (null already filled with 0).
        F.when(F.col("volume_delta_raw") < 0, F.lit(0.0)).otherwise(F.col("volume_delta_raw")).alias("poly_volume_delta"),
        F.col("yes_implied_price").alias("poly_yes_implied_price"),
        ((F.col("yes_buy_price") + F.col("yes_sell_price")) / 2).alias("poly_yes_mid_price"),
        (F.col("yes_buy_price") - F.col("yes_sell_price")).alias("poly_yes_spread_price"),
        (F.col("price") - F.col("strike_price")).alias("poly_distance_from_strike"))


def notebook_btc_frame(kalshi: DataFrame, trades: DataFrame, unit_us: int = UNIT_US) -> DataFrame:
    """Q8 BTC part: ttc, dedupe (no strike fill), gap gate, spot as-of, distance, mid, outcome."""
    k = kalshi.withColumn("time_to_close", whole_units("close_time", "curr_time", unit_us))
    k = dedupe_first(k, EVENT_COLS + ["time_to_close"], ["curr_time", "id"])
    k = k.where((F.col("coin") == "BTC") & (F.col("time_to_close") >= 0))
    ev = Window.partitionBy(*EVENT_COLS).orderBy("curr_time")
    k = k.withColumn("prev_time", F.lag("curr_time").over(ev))
    k = k.where(whole_units("curr_time", "prev_time", unit_us).between(0.9, 1.1))
    spot = prepare_trades(of_coins(trades, ["BTC"])).select("coin", "trade_time", "price")
    k = asof_join(k, AsofRight(spot, "trade_time", ["price", "trade_time"]), "curr_time", by=["coin"])
    k = k.select("*", (F.col("price") - F.col("floor_strike")).alias("distance_from_strike"),
                 ((F.col("yes_ask_dollars") + F.col("yes_bid_dollars")) / 2).alias("yes_mid_dollars"))
    last_mid = F.max_by("yes_mid_dollars", "curr_time").over(Window.partitionBy("open_time", "close_time"))
    return k.withColumn("outcome", F.when(last_mid.isNull(), F.lit(None)).otherwise((last_mid > 0.5).cast("int")))


NB_FEATURES = ["last_price_dollars", "yes_bid_dollars", "yes_ask_dollars", "no_bid_dollars", "no_ask_dollars",
               "yes_mid_dollars", "spread_dollars", "cross_sum_mid", "time_to_close", "floor_strike"]


def notebook_coin_frame(kalshi: DataFrame, coin: str, unit_us: int = UNIT_US) -> DataFrame:
    """Q8 other-coin part: no gate; mid, spread, cross-sum mid (F9); prefixed."""
    k = kalshi.withColumn("time_to_close", whole_units("close_time", "curr_time", unit_us))
    k = dedupe_first(k, EVENT_COLS + ["time_to_close"], ["curr_time", "id"])
    k = k.where((F.col("coin") == coin) & (F.col("time_to_close") >= 0))
    k = k.select("*",
                 ((F.col("yes_ask_dollars") + F.col("yes_bid_dollars")) / 2).alias("yes_mid_dollars"),
                 (F.col("yes_ask_dollars") - F.col("yes_bid_dollars")).alias("spread_dollars"),
                 ((F.col("yes_ask_dollars") + F.col("yes_bid_dollars")) / 2
                  + (F.col("no_ask_dollars") + F.col("no_bid_dollars")) / 2).alias("cross_sum_mid"))
    return k.select("curr_time", *[F.col(c).alias(f"{coin}_{c}") for c in NB_FEATURES])


def notebook_combined(kalshi: DataFrame, trades: DataFrame, others: Sequence[str] = ("ETH", "XRP", "SOL"),
                      tolerance_units: int = 2, unit_us: int = UNIT_US) -> DataFrame:
    """Q8: BTC frame + as-of other coins with a tolerance (J3), all in one window pass."""
    btc = notebook_btc_frame(kalshi, trades, unit_us)
    rights = [AsofRight(notebook_coin_frame(kalshi, c, unit_us), "curr_time",
                        [f"{c}_{f}" for f in NB_FEATURES], tolerance_us=tolerance_units * unit_us) for c in others]
    return asof_join(btc, rights, "curr_time")


def equijoin_combined(kalshi: DataFrame, coins: Sequence[str] = ("BTC", "ETH", "XRP", "SOL"),
                      unit_us: int = UNIT_US) -> DataFrame:
    """Q9: per-coin frames with next-price target, prefixed, left-joined on exact curr_time (J8);
    rows with a BTC target; outcome by last BTC traded price per BTC open_time (A1b)."""
    k = kalshi.withColumn("time_to_close", whole_units("close_time", "curr_time", unit_us))
    k = k.where(F.col("time_to_close") > 0)
    ev = Window.partitionBy("coin", "open_time", "close_time").orderBy("curr_time", "id")
    k = k.withColumn("next_price_dollars_lead1", F.lead("last_price_dollars").over(ev))
    keep = ["open_time", "close_time", "last_price_dollars", "yes_bid_dollars", "yes_ask_dollars",
            "time_to_close", "next_price_dollars_lead1"]
    frames = []
    for c in coins:
        f = k.where(F.col("coin") == c)
        frames.append(f.select("curr_time", *[F.col(x).alias(f"{c}_{x}") for x in keep]))
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, "curr_time", "left")
    out = out.where(F.col(f"{coins[0]}_next_price_dollars_lead1").isNotNull())
    w = Window.partitionBy(f"{coins[0]}_open_time")
    last_px = F.max_by(f"{coins[0]}_last_price_dollars",
                       F.when(F.col(f"{coins[0]}_last_price_dollars").isNotNull(), F.col("curr_time"))).over(w)
    return out.withColumn("outcome", F.when(last_px.isNull(), F.lit(None)).otherwise((last_px > 0.5).cast("int")))


def tick_trade_features(ticks: DataFrame, trades: DataFrame, bucket_us: int = UNIT_US) -> DataFrame:
    """A4 over J6: trades with prev_time <= trade_time <= curr_time, aggregated per tick."""
    t = prepare_trades(trades).select("coin", "trade_time", "price", "size", "side")
    pairs = range_join(ticks.select("coin", "curr_time", "prev_time"), t, "prev_time", "curr_time",
                       "trade_time", bucket_us, by=["coin"])
    buy = F.when(F.col("side") == "buy", F.col("size")).otherwise(F.lit(0.0))
    sell = F.when(F.col("side") == "sell", F.col("size")).otherwise(F.lit(0.0))
    return (pairs.groupBy("coin", "curr_time")
            .agg(F.count(F.lit(1)).alias("trade_count"), F.sum("size").alias("size_sum"),
                 F.sum(buy).alias("buy_size_sum"), F.sum(sell).alias("sell_size_sum"),
                 (F.sum(buy) - F.sum(sell)).alias("size_imbalance"),
                 F.avg("price").alias("price_mean"), F.stddev_samp("price").alias("price_std"),
                 F.try_divide(F.sum(F.col("price") * F.col("size")), F.sum("size")).alias("vwap")))

"""Cleaning jobs over landed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import dense_index

EVENT_COLS = ["coin", "open_time", "close_time"]


def coin_filter(df: DataFrame, coins: Sequence[str], col: str = "coin", suffix: str = "") -> DataFrame:
    """keep rows whose ``col`` is one of ``{coin}{suffix}``."""
    return df.where(F.col(col).isin([f"{c}{suffix}" for c in coins]))


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row per ``keys`` in ``order`` (D1, D2). Deterministic: order must be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def clean_trades(trades: DataFrame, coins: Sequence[str], with_id: bool = True) -> DataFrame:
    """coin filter, one row per trade_id (earliest arrival), time order, new dense id."""
    t = coin_filter(trades, coins, "product_id", "-USD")
    t = dedupe_first(t, ["trade_id"], ["curr_time", "id"])
    cols = ["curr_time", "product_id", "trade_time", "price", "size", "side"]
    if not with_id:
        return t.select("id", *cols)
    return dense_index(t.select("id", *cols).withColumnRenamed("id", "_src"),
                       ["trade_time", "_src"], name="id").select("id", *cols)


def clean_options(options: DataFrame, coins: Sequence[str]) -> DataFrame:
    """currency filter, time order, new dense id, 12 columns."""
    cols = ["curr_time", "instrument_name", "expiry_datetime", "strike", "option_type",
            "underlying_price", "delta", "mark_iv", "mark_price", "open_interest", "volume"]
    o = coin_filter(options, coins, "currency")
    return dense_index(o.withColumnRenamed("id", "_src"), ["curr_time", "_src"], name="id").select("id", *cols)


KALSHI_COLS = ["curr_time", "coin", "open_time", "close_time", "last_price_dollars", "no_ask_dollars",
               "no_bid_dollars", "yes_ask_dollars", "yes_bid_dollars", "floor_strike"]


def clean_kalshi(quotes: DataFrame, coins: Sequence[str], drop_edge_events: bool = True,
                 with_id: bool = True) -> DataFrame:
    """Drop the first and last (possibly partial) events, bounds taken over all coins.

    The bounds are a one-row aggregate, so the cross join is a broadcast of one row.
    """
    q = quotes
    cols = list(KALSHI_COLS)
    if drop_edge_events:
        bounds = quotes.agg(F.min("open_time").alias("_lo"), F.max("close_time").alias("_hi"))
        q = (q.crossJoin(F.broadcast(bounds))
             .where(~((F.col("open_time") == F.col("_lo")) | (F.col("close_time") == F.col("_hi"))))
             .drop("_lo", "_hi"))
    else:
        cols.append("volume_24h_fp")
    q = coin_filter(q, coins)
    if not with_id:
        return q.select("id", *cols)
    return dense_index(q.select("id", *cols).withColumnRenamed("id", "_src"),
                       ["curr_time", "_src"], name="id").select("id", *cols)


POLY_COLS = ["curr_time", "coin", "interval_start_unix", "end_date", "strike_price", "liquidity", "volume",
             "yes_implied_price", "no_implied_price", "yes_buy_price", "yes_sell_price", "no_buy_price",
             "no_sell_price"]


def clean_polymarket(poly: DataFrame, coins: Sequence[str], with_id: bool = True) -> DataFrame:
    """coin filter, time order, new dense id, 14 columns."""
    p = coin_filter(poly, coins).select("id", *POLY_COLS)
    if not with_id:
        return p
    return dense_index(p.withColumnRenamed("id", "_src"), ["curr_time", "_src"], name="id").select("id", *POLY_COLS)


def prepare_trades(trades: DataFrame) -> DataFrame:
    """coin from product id, trade sign (anything but buy is -1), notional, signed flows."""
    sign = F.when(F.col("side") == "buy", F.lit(1)).otherwise(F.lit(-1))
    return trades.select(
        "*", F.regexp_replace("product_id", "-USD", "").alias("coin"), sign.alias("trade_sign"),
        (F.col("price") * F.col("size")).alias("notional"),
        (F.col("price") * F.col("size") * sign).alias("weighted"),
        (F.col("size") * sign).alias("signed_size"))


def fill_within(df: DataFrame, col: str, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Forward fill then backward fill of ``col`` inside each key group, in ``order``.

    Only rows before a group's first known value are left to the backward fill, so it is that value for all of
    them: one frame over the whole group, where frames that start at each row cost the square of its rows.
    """
    base = Window.partitionBy(*keys).orderBy(*order)
    fwd = F.last(col, ignorenulls=True).over(base.rowsBetween(Window.unboundedPreceding, 0))
    bwd = F.first(col, ignorenulls=True).over(base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn(col, F.coalesce(fwd, bwd))


def null_summary(df: DataFrame) -> DataFrame:
    """F16: (column, null_count, null_share) for columns with nulls, most nulls first.

    One aggregate pass computes every column's count; the wide row is unpivoted. An empty
    input yields an empty table (null_share would divide by zero).
    """
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _c{i}" for i, c in enumerate(cols))
    return (agg.selectExpr("_n", f"stack({len(cols)}, {stack}) AS (column, null_count)")
            .where("null_count > 0")
            .select("column", F.col("null_count").cast("long"),
                    (F.col("null_count") / F.col("_n")).alias("null_share")))


def prepare_training_frame(df: DataFrame, target_col: str = "next_price_dollars_lead1",
                           drop_null_rows: bool = True) -> DataFrame:
    """rows with a target; optionally only rows with no null at all (NaN is kept)."""
    out = df.where(F.col(target_col).isNotNull())
    if drop_null_rows:
        cond = F.lit(True)
        for c in out.columns:
            cond = cond & F.col(f"`{c}`").isNotNull()
        out = out.where(cond)
    return out

"""Order-book analytics over a table of resting bids (snapshot_id, side, price, size).

Each snapshot is one group; every walk is a running sum over the snapshot's levels, so a
book of any depth is a window over its own levels, never a fold on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.market import taker_fee

INF = float("inf")


def top_of_book(book: DataFrame) -> DataFrame:
    """B1: best bids per side; asks are complements of the opposite best bid; empty side -> null."""
    yb = F.max(F.when(F.col("side") == "yes", F.col("price")))
    nb = F.max(F.when(F.col("side") == "no", F.col("price")))
    return (book.groupBy("snapshot_id").agg(yb.alias("yes_bid"), nb.alias("no_bid"))
            .select("snapshot_id", "yes_bid", "no_bid", (1 - F.col("no_bid")).alias("yes_ask"),
                    (1 - F.col("yes_bid")).alias("no_ask")))


def ask_ladder(book: DataFrame, side: str = "yes") -> DataFrame:
    """B2: asks to buy ``side`` = complements of the opposite side's bids, cheapest first."""
    opp = "no" if side == "yes" else "yes"
    lad = book.where(F.col("side") == opp).select("snapshot_id", (1 - F.col("price")).alias("ask_price"), "size")
    w = Window.partitionBy("snapshot_id").orderBy("ask_price")
    return lad.withColumn("level", F.row_number().over(w).cast("long"))


def depth_at(ladder: DataFrame, limit: float) -> DataFrame:
    """Contracts available at prices <= limit."""
    return ladder.groupBy("snapshot_id").agg(
        F.sum(F.when(F.col("ask_price") <= limit, F.col("size")).otherwise(F.lit(0.0))).alias("depth"))


def _cum(ladder: DataFrame, order: Column) -> DataFrame:
    w = Window.partitionBy("snapshot_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return ladder.withColumn("_cum", F.sum("size").over(w)).withColumn("_prior", F.col("_cum") - F.col("size"))


def vwap_and_ceiling(ladder: DataFrame, qty: float) -> DataFrame:
    """B4 + B5: VWAP to fill ``qty`` walking asks upward, and the highest level touched;
    both infinite when the book is too thin."""
    c = _cum(ladder, F.col("ask_price"))
    take = F.least(F.greatest(F.lit(qty) - F.col("_prior"), F.lit(0.0)), F.col("size"))
    agg = c.groupBy("snapshot_id").agg(
        F.sum("size").alias("_total"), F.sum(take * F.col("ask_price")).alias("_cost"),
        F.min(F.when(F.col("_cum") >= qty, F.col("ask_price"))).alias("_ceil"))
    thin = F.col("_total") < qty
    return agg.select("snapshot_id",
                      F.when(thin, F.lit(INF)).otherwise(F.col("_cost") / qty).alias("vwap"),
                      F.when(thin, F.lit(INF)).otherwise(F.col("_ceil")).alias("ceiling_price"))


def sell_walk(book: DataFrame, side: str, held: DataFrame) -> DataFrame:
    """Sell ``held.contracts`` into ``side`` bids, best first, whole contracts per level;
    levels with no take are skipped. Returns floor price, simulated fill and VWAP."""
    b = book.where(F.col("side") == side).join(held, "snapshot_id")
    w = Window.partitionBy("snapshot_id").orderBy(F.col("price").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = F.floor("size")
    b = b.withColumn("_prior", F.coalesce(F.sum(whole).over(w), F.lit(0)))
    take = F.greatest(F.least(whole, F.col("contracts") - F.col("_prior")), F.lit(0))
    b = b.withColumn("_take", take)
    agg = b.groupBy("snapshot_id").agg(
        F.max("price").alias("top_bid"), F.sum("_take").alias("filled"),
        F.sum(F.col("_take") * F.col("price")).alias("proceeds"),
        F.min(F.when(F.col("_take") > 0, F.col("price"))).alias("_floor"))
    floor_px = F.coalesce(F.col("_floor"), F.col("top_bid"))
    return agg.select("snapshot_id", "top_bid", floor_px.alias("floor_price"), F.col("filled").cast("long").alias("filled"),
                      F.when(F.col("filled") > 0, F.col("proceeds") / F.col("filled")).otherwise(floor_px).alias("vwap"))


def entry_walk(ladder: DataFrame, fair: DataFrame, tau: float = 0.04, size_cap: DataFrame | None = None) -> DataFrame:
    """Walk asks upward and stop at the first level where fair - ask <= tau + fee(ask).

    The fee is not monotone in price, so 'stop at first failure' is a running minimum of the
    pass flag, not a filter. ``fair`` has (snapshot_id, fair, best_ask, size_cap).
    """
    x = ladder.join(fair, "snapshot_id")
    ok = (F.col("fair") - F.col("ask_price") > F.lit(tau) + taker_fee(F.col("ask_price"))).cast("int")
    w = Window.partitionBy("snapshot_id").orderBy("ask_price").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_valid", F.min(ok).over(w))
    agg = x.groupBy("snapshot_id", "best_ask", "size_cap").agg(
        F.sum(F.when(F.col("_valid") == 1, F.col("size")).otherwise(F.lit(0.0))).alias("n_valid"),
        F.max(F.when(F.col("_valid") == 1, F.col("ask_price"))).alias("_last"))
    return agg.select("snapshot_id", "n_valid", F.coalesce("_last", "best_ask").alias("order_price"),
                      F.least(F.col("n_valid"), F.col("size_cap")).cast("long").alias("contracts"))


def profit_floored_sell(book: DataFrame, side: str, held: DataFrame, min_profit: float = 0.02) -> DataFrame:
    """Sell walk that stops at the first bid where bid - entry - entry fee - exit fee < min_profit.

    ``held`` has (snapshot_id, contracts, entry_price)."""
    b = book.where(F.col("side") == side).join(held, "snapshot_id")
    profit = F.col("price") - F.col("entry_price") - taker_fee(F.col("entry_price")) - taker_fee(F.col("price"))
    w = Window.partitionBy("snapshot_id").orderBy(F.col("price").desc())
    b = b.withColumn("_ok", F.min((profit >= min_profit).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    b = b.where("_ok = 1")
    whole = F.floor("size")
    b = b.withColumn("_prior", F.coalesce(F.sum(whole).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    b = b.withColumn("_take", F.greatest(F.least(whole, F.col("contracts") - F.col("_prior")), F.lit(0)))
    return b.groupBy("snapshot_id").agg(
        F.sum("_take").cast("long").alias("filled"), F.sum(F.col("_take") * F.col("price")).alias("proceeds"),
        F.min(F.when(F.col("_take") > 0, F.col("price"))).alias("floor_price"))

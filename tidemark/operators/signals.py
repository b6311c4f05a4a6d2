"""Trading signals as columns over scored ticks.

Fixed values below are the reference's configuration constants (decision thresholds).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.market import clamp, taker_fee

# Trading configuration of the reference.
TAU = 0.04
SIGMA = 0.10
BIAS_MID_ZONE = 0.08
BIAS_TAIL_ZONE = 0.03
BIAS_MID_LOW = 0.10
BIAS_MID_HIGH = 0.77
N_CONTRACTS = 1
N_CONTRACTS_MAX = 6
KELLY_BASE_EDGE = 0.04
MIN_TTC = 5
MAX_TTC = 280
EXTREME_MID = 0.82
EXTREME_MID_EARLY_TTC = 186
MIN_ORDER_PRICE = 0.22
DEAD_ZONE_YES = 0.53
DEAD_ZONE_NO = 0.47
REL_STOP_FRACTION = 0.55
REL_STOP_MAX_LOSS = 0.30
REL_STOP_MIN_LOSS = 0.20
REL_STOP_PRICE_FLOOR = 0.15
EXIT_THRESHOLD = 0.25
TAKE_PROFIT_MIN_PROFIT = 0.02
COOLDOWN_SECONDS = 5
DIVERGENCE = 0.015


def bias_corrected(p: Column, mid: Column) -> Column:
    """Subtract the regime offset (mid zone vs tails), clamp to [0.001, 0.999]."""
    off = F.when((mid > BIAS_MID_LOW) & (mid < BIAS_MID_HIGH), F.lit(BIAS_MID_ZONE)).otherwise(F.lit(BIAS_TAIL_ZONE))
    return clamp(p - off, 0.001, 0.999)


def kelly_size(edge: Column) -> Column:
    """clamp(int(N * edge / base), 1, N_max); int() truncates toward zero."""
    scaled = (F.lit(N_CONTRACTS) * edge / F.lit(KELLY_BASE_EDGE)).cast("long")
    return F.when(edge.isNull(), F.lit(None)).otherwise(F.least(F.greatest(scaled, F.lit(1)), F.lit(N_CONTRACTS_MAX)))


def relative_stop_price(avg: Column) -> Column:
    """Stop price = max(0.01, avg - clip(0.55 (1 - avg), 0.20, 0.30)), floored at 0.15 only
    when avg is above 0.15; -1 when avg <= 0."""
    upside = F.greatest(F.lit(0.0), 1 - avg)
    loss = F.greatest(F.lit(REL_STOP_MIN_LOSS), F.least(F.lit(REL_STOP_FRACTION) * upside, F.lit(REL_STOP_MAX_LOSS)))
    stop = F.greatest(F.lit(0.01), avg - loss)
    stop = F.when(avg > REL_STOP_PRICE_FLOOR, F.greatest(F.lit(REL_STOP_PRICE_FLOOR), stop)).otherwise(stop)
    return F.when(avg.isNull(), F.lit(None)).when(avg <= 0, F.lit(-1.0)).otherwise(stop)


def entry_decisions(ticks: DataFrame) -> DataFrame:
    """G3 + G4 + G5 + G6: edges, ordered reject reason, best side, size.

    Input columns: p_hat (bias-corrected), p_std, mid, yes_ask, no_ask, time_to_close.
    """
    p, mid = F.col("p_hat"), F.col("mid")
    ya, na = F.col("yes_ask"), F.col("no_ask")
    t = ticks.withColumn("edge_yes", p - ya).withColumn("edge_no", (1 - p) - na)
    t = (t.withColumn("_yok", F.col("edge_yes") > F.lit(TAU) + taker_fee(ya))
         .withColumn("_nok", F.col("edge_no") > F.lit(TAU) + taker_fee(na)))
    t = t.withColumn("_yc", F.col("_yok") & (p > DEAD_ZONE_YES)).withColumn("_nc", F.col("_nok") & (p < DEAD_ZONE_NO))
    yes_edge_ok, no_edge_ok = F.col("_yok"), F.col("_nok")
    yes_cand, no_cand = F.col("_yc"), F.col("_nc")

    def price_ok(px: Column) -> Column:
        return (px > 0) & (px >= MIN_ORDER_PRICE)

    # Candidates in descending edge order; the first one whose price passes is taken.
    yes_first = F.col("edge_yes") >= F.col("edge_no")
    first_side = F.when(yes_cand & no_cand, F.when(yes_first, "yes").otherwise("no")) \
        .when(yes_cand, "yes").when(no_cand, "no")
    second_side = F.when(yes_cand & no_cand, F.when(yes_first, "no").otherwise("yes"))
    px = lambda s: F.when(s == "yes", ya).when(s == "no", na)
    ttc = F.col("time_to_close")
    t = t.withColumn("_first", first_side).withColumn("_second", second_side)
    first_side, second_side = F.col("_first"), F.col("_second")
    chosen = F.when(first_side.isNotNull() & price_ok(px(first_side)), first_side) \
        .when(second_side.isNotNull() & price_ok(px(second_side)), second_side)
    t = t.withColumn("_chosen", chosen)
    chosen = F.col("_chosen")
    reason = (F.when((ttc < MIN_TTC) | (ttc > MAX_TTC), "ttc")
              .when(F.col("p_std") > SIGMA, "uncertain")
              .when((ttc > EXTREME_MID_EARLY_TTC) & ((mid > EXTREME_MID) | (mid < 1 - EXTREME_MID)), "extreme_mid")
              .when(~yes_edge_ok & ~no_edge_ok, "no_edge")
              .when(~yes_cand & ~no_cand, "dead_zone")
              .when(chosen.isNull() & (px(first_side) <= 0), "no_liquidity")
              .when(chosen.isNull(), "min_price")
              .otherwise("enter"))
    t = t.withColumn("reason", reason).withColumn("side", F.when(F.col("reason") == "enter", chosen))
    edge = F.when(F.col("side") == "yes", F.col("edge_yes")).when(F.col("side") == "no", F.col("edge_no"))
    return t.withColumn("contracts", kelly_size(edge)).drop("_yok", "_nok", "_yc", "_nc", "_first", "_second", "_chosen")


def exit_actions(pos: DataFrame, rel_mode: bool = True) -> DataFrame:
    """Per held side, in order: stop (relative stop vs held-side bid, or absolute stop on the
    mid), take-profit (bid clears entry + fees by the minimum), else hold.

    Input columns: side, contracts, avg_price, held_bid, mid.
    """
    bid, avg = F.col("held_bid"), F.col("avg_price")
    if rel_mode:
        stop = (avg > 0) & bid.isNotNull() & (bid < relative_stop_price(avg))
    else:
        stop = ((F.col("side") == "yes") & (F.col("mid") < EXIT_THRESHOLD)) | \
               ((F.col("side") == "no") & (F.col("mid") > 1 - EXIT_THRESHOLD))
    tp = bid.isNotNull() & (bid - avg - taker_fee(avg) - taker_fee(bid) >= TAKE_PROFIT_MIN_PROFIT)
    action = F.when(F.col("contracts") <= 0, "none").when(stop, "stop").when(tp, "take_profit").otherwise("hold")
    return pos.withColumn("action", action).withColumn(
        "exit_contracts", F.when(F.col("action").isin("stop", "take_profit"), F.col("contracts")).otherwise(F.lit(0.0)))


def divergence_flag(book_mid: Column, listing_mid: Column) -> Column:
    """Book mid and listing mid differ by more than 1.5 cents."""
    return F.abs(book_mid - listing_mid) > DIVERGENCE


def override_positive(live: Column, cached: Column) -> Column:
    """Take the live value when it is positive, else keep the cached one."""
    return F.when(live.isNotNull() & (live > 0), live).otherwise(cached)


def best_side_rank(cands: DataFrame, keys: list[str]) -> DataFrame:
    """G6 as a table operation: candidate rows ranked by edge within each tick."""
    return cands.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("edge").desc(), "side")))

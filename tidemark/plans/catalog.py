"""Registered queries: every operator of the inventory that has a runnable form.

Each entry reads the shared test tables through ``tidemark.sources.testviews`` and returns a
DataFrame; the oracle SQL (DuckDB) is registered next to it.
"""

from __future__ import annotations

from tidemark.oracle import features_sql as fsql
from tidemark.plans import features as feat
from tidemark.registry import register
from tidemark.sources import testviews as tv

_Q_ROUND = sorted(fsql.ROUNDED)
_Q6_ROUND = sorted(fsql.ROUNDED | {f"{c}_{f}" for c in ("ETH", "XRP", "SOL") for f in fsql.ROUNDED})


def _inputs(spark, d):
    return feat.cleaned_inputs(tv.quotes(spark, d), tv.trades(spark, d))


@register("q1_prepare_kalshi", fsql.q1_sql())
def q1_prepare_kalshi(spark, d):
    """Q1: time to close, strike fill, per-(event, ttc) dedupe, strike filter."""
    kal, _ = _inputs(spark, d)
    return feat.prepare_kalshi(kal, tv.UNIT_US).select(
        "id", "curr_time", "coin", "open_time", "close_time", "time_to_close", "floor_strike",
        "last_price_dollars", "yes_bid_dollars", "yes_ask_dollars")


@register("q2_coin_features", fsql.q2_sql("BTC"), _Q_ROUND)
def q2_coin_features(spark, d):
    """Q2: gated BTC ticks with spot as-of and rolling quote features, with the target."""
    kal, tr = _inputs(spark, d)
    return feat.build_coin_df(kal, tr, "BTC", prefix=False, add_target=True, unit_us=tv.UNIT_US)


@register("q3_btc_kalshi", fsql.q3_sql(), _Q_ROUND)
def q3_btc_kalshi(spark, d):
    """Q3: BTC frame + event outcome."""
    kal, tr = _inputs(spark, d)
    return feat.build_btc_kalshi(kal, tr, tv.UNIT_US)


@register("q4_spot_features", fsql.q4_sql(), _Q_ROUND)
def q4_spot_features(spark, d):
    """Q4: 1-unit right-closed spot bars, bar returns, rolling bar stats."""
    _, tr = _inputs(spark, d)
    return feat.spot_features(tr, "BTC", tv.UNIT_US).drop("coin")


@register("q6_btc_feature_table", fsql.q6_sql(), _Q6_ROUND)
def q6_btc_feature_table(spark, d):
    """Q6 (flagship): 70-column BTC feature table."""
    kal, tr = _inputs(spark, d)
    return feat.btc_feature_table(kal, tr, tv.UNIT_US)


@register("q7_training_ready", fsql.q7_sql(), _Q6_ROUND)
def q7_training_ready(spark, d):
    """Q7: flagship table, complete rows with a target only."""
    kal, tr = _inputs(spark, d)
    return feat.training_ready(kal, tr, tv.UNIT_US)

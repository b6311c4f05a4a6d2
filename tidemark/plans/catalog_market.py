"""Market-data queries: cleaning (F*), dedupe / sets (D*), order (T*), aggregates (A*), windows (W*),
joins (J*), second venue (Q5) and notebook variants (Q8, Q9)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import market
from tidemark.oracle.features_sql import KAL_SQL, PREP_SQL, TR_SQL, FEAT_SQL, BARS_SQL
from tidemark.operators import clean
from tidemark.operators.asof import AsofRight, asof_join
from tidemark.operators.ordering import dense_index
from tidemark.plans import features as feat
from tidemark.plans import variants
from tidemark.registry import register
from tidemark.sources import testviews as tv
from tidemark.sources.testviews import COINS, UNIT_US, VIEW_SQL

def W(parts):
    return "WITH " + ",\n".join(parts)


def _kal(spark, d, with_id=False):
    return clean.clean_kalshi(tv.quotes(spark, d), COINS, with_id=with_id)


def _tr(spark, d):
    return clean.clean_trades(tv.trades(spark, d), COINS, with_id=False)


# ---------------------------------------------------------------- F: cleaning and scalar columns
@register("f1_coin_filter", W([VIEW_SQL["trades"]]) + """
SELECT id, product_id, trade_time, price FROM trades WHERE product_id IN ('BTC-USD', 'ETH-USD', 'XRP-USD', 'SOL-USD')""")
def f1_coin_filter(spark, d):
    """rows of the listed coins only."""
    return clean.coin_filter(tv.trades(spark, d), COINS, "product_id", "-USD").select("id", "product_id", "trade_time", "price")


@register("f2_clean_trades", W([VIEW_SQL["trades"]]) + """
SELECT row_number() OVER (ORDER BY trade_time, id) - 1 AS id, curr_time, product_id, trade_time, price, size, side
FROM (SELECT * FROM trades WHERE product_id IN ('BTC-USD', 'ETH-USD', 'XRP-USD', 'SOL-USD')
      QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY curr_time, id) = 1)""")
def f2_clean_trades(spark, d):
    """coin filter, dedupe on trade_id (D1), time order, dense new id."""
    return clean.clean_trades(tv.trades(spark, d), COINS)


_KCOLS = ", ".join(clean.KALSHI_COLS)


@register("f4_clean_kalshi", W([VIEW_SQL["quotes"]]) + f"""
SELECT row_number() OVER (ORDER BY curr_time, id) - 1 AS id, {_KCOLS}
FROM quotes WHERE coin IN ('BTC', 'ETH', 'XRP', 'SOL')
  AND NOT (open_time = (SELECT min(open_time) FROM quotes) OR close_time = (SELECT max(close_time) FROM quotes))""")
def f4_clean_kalshi(spark, d):
    """drop edge events (bounds over all coins, before the coin filter), dense id."""
    return clean.clean_kalshi(tv.quotes(spark, d), COINS)


@register("f4b_clean_kalshi_keep_edges", W([VIEW_SQL["quotes"]]) + f"""
SELECT row_number() OVER (ORDER BY curr_time, id) - 1 AS id, {_KCOLS}, volume_24h_fp
FROM quotes WHERE coin IN ('BTC', 'ETH', 'XRP', 'SOL')""")
def f4b_clean_kalshi_keep_edges(spark, d):
    """Earlier variant keeping edge events and volume_24h_fp."""
    return clean.clean_kalshi(tv.quotes(spark, d), COINS, drop_edge_events=False)


@register("f5_clean_polymarket", W([VIEW_SQL["poly"]]) + f"""
SELECT row_number() OVER (ORDER BY curr_time, id) - 1 AS id, {", ".join(clean.POLY_COLS)}
FROM poly WHERE coin IN ('BTC', 'ETH', 'XRP', 'SOL')""")
def f5_clean_polymarket(spark, d):
    """second-venue cleaning."""
    return clean.clean_polymarket(tv.poly(spark, d), COINS)


@register("f6_prepare_trades", W([VIEW_SQL["trades"]]) + """
SELECT id, coin, trade_sign, price * size AS notional, price * size * trade_sign AS weighted, size * trade_sign AS signed_size
FROM (SELECT *, replace(product_id, '-USD', '') AS coin, CASE WHEN side = 'buy' THEN 1 ELSE -1 END AS trade_sign FROM trades)""")
def f6_prepare_trades(spark, d):
    """coin, trade sign, notional, weighted and signed size."""
    return clean.prepare_trades(tv.trades(spark, d)).select("id", "coin", "trade_sign", "notional", "weighted", "signed_size")


@register("f7_time_to_close", W([VIEW_SQL["quotes"]]) + f"""
SELECT id, (epoch_us(close_time) - epoch_us(curr_time)) // {UNIT_US} AS time_to_close,
       (epoch_us(close_time) - epoch_us(curr_time)) // 1000000 AS time_to_close_s FROM quotes""")
def f7_time_to_close(spark, d):
    """whole units / seconds to close, truncated toward zero."""
    q = tv.quotes(spark, d)
    return q.select("id", feat.whole_units("close_time", "curr_time", UNIT_US).alias("time_to_close"),
                    feat.whole_units("close_time", "curr_time", 1_000_000).alias("time_to_close_s"))


@register("f9_cross_sum_mid", W([VIEW_SQL["quotes"]]) + """
SELECT id, (yes_ask_dollars + yes_bid_dollars) / 2 + (no_ask_dollars + no_bid_dollars) / 2 AS cross_sum_mid FROM quotes""")
def f9_cross_sum_mid(spark, d):
    """yes mid + no mid."""
    q = tv.quotes(spark, d)
    return q.select("id", ((F.col("yes_ask_dollars") + F.col("yes_bid_dollars")) / 2
                           + (F.col("no_ask_dollars") + F.col("no_bid_dollars")) / 2).alias("cross_sum_mid"))


_TTC_RANGES = [("ge_0", "time_to_close >= 0"), ("within_event", "time_to_close BETWEEN 0 AND 120"),
               ("mid_band", "time_to_close BETWEEN 13 AND 26"), ("early", "time_to_close BETWEEN 0 AND 40"),
               ("gt_0", "time_to_close > 0"), ("gt_neg", "time_to_close > -0.01")]


@register("f10_ttc_ranges", W([VIEW_SQL["quotes"], f"""t AS (
  SELECT id, (epoch_us(close_time) - epoch_us(curr_time)) // {UNIT_US} AS time_to_close FROM quotes)"""]) + "\n" + "\nUNION ALL ".join(
    f"SELECT '{n}' AS band, id, time_to_close FROM t WHERE {c}" for n, c in _TTC_RANGES))
def f10_ttc_ranges(spark, d):
    """the rows that each time-to-close filter keeps; bands are the reference's at test scale. One scan."""
    q = tv.quotes(spark, d).select("id", feat.whole_units("close_time", "curr_time", UNIT_US).alias("time_to_close"))
    bands = F.array(*[F.when(F.expr(c), F.lit(n)) for n, c in _TTC_RANGES])
    return q.select(F.explode(F.filter(bands, lambda b: b.isNotNull())).alias("band"), "id", "time_to_close")


@register("f11_prefixed_eth_frame", W([VIEW_SQL["quotes"], VIEW_SQL["trades"], KAL_SQL, TR_SQL, PREP_SQL, FEAT_SQL]) + "\nSELECT curr_time, "
          + ", ".join((f"round({f}, 9) AS ETH_{f}" if f in ("yes_mid_change_std_30s", "yes_mid_change_std_60s", "yes_spread_mean_30s") else f"{f} AS ETH_{f}")
                      for f in feat.QUOTE_FEATURES) + " FROM feat WHERE coin = 'ETH'",
          [f"ETH_{f}" for f in ("yes_mid_change_std_30s", "yes_mid_change_std_60s", "yes_spread_mean_30s")])
def f11_prefixed_eth_frame(spark, d):
    """F11 (+ Q2 for another coin): ETH feature rows, every column but curr_time prefixed."""
    kal, tr = _kal(spark, d), _tr(spark, d)
    return feat.build_coin_df(kal, tr, "ETH", include_event_metadata=False, include_time_to_close=False, unit_us=UNIT_US)


_RAW_COLS = [
    "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 11 = 1 THEN yes_ask_dollars * 100 ELSE yes_ask_dollars END AS ya_raw",
    "CASE WHEN id % 6 = 0 THEN 0 ELSE yes_ask_dollars END AS ya",
    "CASE WHEN id % 7 = 0 THEN 0 ELSE yes_bid_dollars END AS yb",
    "CASE WHEN id % 4 = 0 THEN 0 ELSE no_ask_dollars END AS na",
    "CASE WHEN id % 9 = 0 THEN 0 ELSE no_bid_dollars END AS nb",
    "CASE WHEN id % 5 = 0 THEN 0 WHEN id % 5 = 1 THEN NULL ELSE last_price_dollars END AS lp",
]
_RAW = ", ".join(_RAW_COLS)


def _raw(q):
    return q.selectExpr("id", *_RAW_COLS)


@register("f13_normalize_price", W([VIEW_SQL["quotes"]]) + f"""
SELECT id, CASE WHEN ya_raw IS NULL THEN 0.5 WHEN ya_raw > 1 THEN ya_raw / 100 ELSE ya_raw END AS price
FROM (SELECT id, {_RAW} FROM quotes)""")
def f13_normalize_price(spark, d):
    """price field to dollars: null -> 0.5, cents (> 1) -> /100."""
    from tidemark.functions.market import normalize_price
    return _raw(tv.quotes(spark, d)).select("id", normalize_price(F.col("ya_raw")).alias("price"))


@register("f14_first_truthy", W([VIEW_SQL["quotes"]]) + f"""
SELECT id, coalesce(nullif(lp, 0), nullif(yb, 0), 0.5) AS price FROM (SELECT id, {_RAW} FROM quotes)""")
def f14_first_truthy(spark, d):
    """first field that is neither null nor 0, then a default."""
    from tidemark.functions.market import first_truthy
    return _raw(tv.quotes(spark, d)).select("id", first_truthy(F.col("lp"), F.col("yb"), default=0.5).alias("price"))


@register("f15_complement_repair", W([VIEW_SQL["quotes"]]) + f"""
SELECT id, na4 AS no_ask, nb4 AS no_bid, ya4 AS yes_ask, yb4 AS yes_bid FROM (
 SELECT *, CASE WHEN yb <= 0 THEN CASE WHEN na4 > 0 THEN greatest(1 - na4, 0.01) ELSE 0.5 END ELSE yb END AS yb4 FROM (
  SELECT *, CASE WHEN ya <= 0 THEN CASE WHEN nb4 > 0 THEN greatest(1 - nb4, 0.01) ELSE 0.5 END ELSE ya END AS ya4 FROM (
   SELECT *, CASE WHEN nb <= 0 THEN CASE WHEN ya > 0 THEN greatest(1 - ya, 0.01) ELSE 0.5 END ELSE nb END AS nb4 FROM (
    SELECT *, CASE WHEN na <= 0 THEN CASE WHEN yb > 0 THEN greatest(1 - yb, 0.01) ELSE 0.5 END ELSE na END AS na4 FROM (
     SELECT id, {_RAW} FROM quotes)))))""")
def f15_complement_repair(spark, d):
    """sequential complement repair no_ask -> no_bid -> yes_ask -> yes_bid."""
    from tidemark.functions.market import complement_repair
    r = _raw(tv.quotes(spark, d))
    return complement_repair(r, "ya", "yb", "na", "nb").selectExpr(
        "id", "na AS no_ask", "nb AS no_bid", "ya AS yes_ask", "yb AS yes_bid")


@register("f16_null_summary", W([VIEW_SQL["quotes"]]) + """
SELECT * FROM (SELECT 'floor_strike' AS "column", count(*) - count(floor_strike) AS null_count,
                      (count(*) - count(floor_strike)) / count(*) AS null_share FROM quotes
               UNION ALL
               SELECT 'cap_strike', count(*) - count(cap_strike), (count(*) - count(cap_strike)) / count(*) FROM quotes)
WHERE null_count > 0""")
def f16_null_summary(spark, d):
    """F16: per-column null counts and shares (columns with nulls only)."""
    return clean.null_summary(tv.quotes(spark, d))


@register("f18_null_free_numeric_columns", None)
def f18_null_free_numeric_columns(spark, d):
    """numeric, non-timestamp columns of the flagship table that contain no nulls."""
    from pyspark.sql import types as T
    from tidemark.plans.features import btc_feature_table
    df = btc_feature_table(_kal(spark, d), _tr(spark, d), UNIT_US)
    nulls = clean.null_summary(df).select("column")
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    cols = spark.createDataFrame([(c,) for c in numeric], "column string")
    return cols.join(nulls, "column", "left_anti")


@register("f19_date_prefix_filter", W([VIEW_SQL["fills"]]) + """
SELECT order_key, line_no, ticker, portfolio, time FROM fills WHERE starts_with(strftime(time, '%Y-%m-%d'), '1996-03')""")
def f19_date_prefix_filter(spark, d):
    """rows of a log whose date text starts with a prefix: a range of times, which reaches the scan."""
    f = tv.fills(spark, d)
    return f.where(market.date_prefix("time", "1996-03")).select("order_key", "line_no", "ticker", "portfolio", "time")


@register("f20_point_lookup", W([VIEW_SQL["quotes"], KAL_SQL, PREP_SQL]) + """
SELECT id, coin, curr_time, time_to_close, yes_bid_dollars FROM prepf WHERE time_to_close = 60""")
def f20_point_lookup(spark, d):
    """the rows at one time-to-close."""
    return feat.prepare_kalshi(_kal(spark, d), UNIT_US).where("time_to_close = 60").select(
        "id", "coin", "curr_time", "time_to_close", "yes_bid_dollars")


@register("f21_ttc_as_of", W([VIEW_SQL["quotes"]]) + """
SELECT id, coalesce((epoch_us(CASE WHEN id % 13 = 0 THEN NULL ELSE close_time END) - epoch_us(TIMESTAMP '2024-01-15 00:00:00')) // 1000000, 0)
       AS seconds_to_close FROM quotes""")
def f21_ttc_as_of(spark, d):
    """seconds to close against an explicit as-of time; missing close -> 0."""
    from tidemark.functions.market import seconds_until
    q = tv.quotes(spark, d).withColumn("close_time", F.expr("CASE WHEN id % 13 = 0 THEN NULL ELSE close_time END"))
    return q.select("id", seconds_until("close_time", "2024-01-15 00:00:00").alias("seconds_to_close"))


# ---------------------------------------------------------------- D: dedupe and sets
@register("d1_dedupe_trade_id", W([VIEW_SQL["trades"]]) + """
SELECT trade_id, id, curr_time FROM trades QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY curr_time, id) = 1""")
def d1_dedupe_trade_id(spark, d):
    """One row per trade_id, the earliest arrival kept (deterministic)."""
    return clean.dedupe_first(tv.trades(spark, d), ["trade_id"], ["curr_time", "id"]).select("trade_id", "id", "curr_time")


@register("d3_listing_diff", W([VIEW_SQL["fills"]]) + """
SELECT ticker, 'new' AS status FROM (SELECT DISTINCT ticker FROM fills WHERE year(time) = 1996
                                     EXCEPT SELECT DISTINCT ticker FROM fills WHERE year(time) = 1995)
UNION ALL
SELECT ticker, 'stale' FROM (SELECT DISTINCT ticker FROM fills WHERE year(time) = 1995
                             EXCEPT SELECT DISTINCT ticker FROM fills WHERE year(time) = 1996)""")
def d3_listing_diff(spark, d):
    """D3: tickers new in the later listing and stale from the earlier one (anti joins)."""
    f = tv.fills(spark, d)
    a = f.where(F.year("time") == 1995).select("ticker").distinct()
    b = f.where(F.year("time") == 1996).select("ticker").distinct()
    return (b.join(a, "ticker", "left_anti").withColumn("status", F.lit("new"))
            .unionByName(a.join(b, "ticker", "left_anti").withColumn("status", F.lit("stale"))))


@register("d4_union_distinct", W([VIEW_SQL["ticks"]]) + """
SELECT ticker FROM ticks WHERE p_hat > 0.999 UNION SELECT ticker FROM ticks WHERE mid < 0.02""")
def d4_union_distinct(spark, d):
    """Union of two shortlists, distinct."""
    t = tv.ticks(spark, d)
    return t.where("p_hat > 0.999").select("ticker").unionByName(t.where("mid < 0.02").select("ticker")).distinct()


@register("d5_distinct_events", W([VIEW_SQL["quotes"]]) + """
SELECT DISTINCT coin, open_time, close_time FROM quotes""")
def d5_distinct_events(spark, d):
    """Distinct market events."""
    return tv.quotes(spark, d).select("coin", "open_time", "close_time").distinct()


# ---------------------------------------------------------------- T: sort / limit / top-k
@register("t1_sort_nulls_first", W([VIEW_SQL["quotes"]]) + """
SELECT id, coin, open_time, curr_time, floor_strike FROM quotes ORDER BY floor_strike NULLS FIRST, coin, curr_time, id""")
def t1_sort_nulls_first(spark, d):
    """Multi-key sort, nulls first."""
    return tv.quotes(spark, d).select("id", "coin", "open_time", "curr_time", "floor_strike").orderBy(
        F.col("floor_strike").asc_nulls_first(), "coin", "curr_time", "id")


@register("t6_tail_bars", W([VIEW_SQL["trades"], TR_SQL]) + f"""
SELECT coin, trade_time, last_price FROM (
  SELECT coin, make_timestamp(((epoch_us(trade_time) + {UNIT_US - 1}) // {UNIT_US}) * {UNIT_US}) AS trade_time,
         arg_max(price, (trade_time, id)) AS last_price FROM tr GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY coin ORDER BY trade_time DESC) <= 48""")
def t6_tail_bars(spark, d):
    """Last N (48) bars of each coin's series."""
    bars = feat.spot_bars(_tr(spark, d), None, UNIT_US).select("coin", "trade_time", F.col("btc_spot_price").alias("last_price"))
    w = Window.partitionBy("coin").orderBy(F.col("trade_time").desc())
    return bars.withColumn("_rn", F.row_number().over(w)).where("_rn <= 48").drop("_rn")


@register("t7_head", W([VIEW_SQL["quotes"]]) + """
SELECT id, coin, curr_time, yes_bid_dollars FROM quotes ORDER BY curr_time, id LIMIT 10""")
def t7_head(spark, d):
    """First n rows in a total order (a top-k report)."""
    return tv.quotes(spark, d).orderBy("curr_time", "id").limit(10).select("id", "coin", "curr_time", "yes_bid_dollars")


# ---------------------------------------------------------------- A: aggregates
@register("a1_event_outcome", W([VIEW_SQL["quotes"], KAL_SQL, PREP_SQL]) + """
SELECT coin, open_time, close_time, CAST(CASE WHEN m IS NULL THEN NULL ELSE m > 0.5 END AS INTEGER) AS outcome, m AS last_mid
FROM (SELECT coin, open_time, close_time, arg_max_null((yes_ask_dollars + yes_bid_dollars) / 2, curr_time) AS m
      FROM prepf GROUP BY ALL)""")
def a1_event_outcome(spark, d):
    """A1: outcome per event = last mid (by time) above 0.5; a null last mid stays null."""
    k = feat.prepare_kalshi(_kal(spark, d), UNIT_US)
    m = F.max_by((F.col("yes_ask_dollars") + F.col("yes_bid_dollars")) / 2, "curr_time")
    return (k.groupBy("coin", "open_time", "close_time").agg(m.alias("last_mid"))
            .withColumn("outcome", F.when(F.col("last_mid").isNull(), None).otherwise((F.col("last_mid") > 0.5).cast("int"))))


@register("a1b_last_traded_outcome", W([VIEW_SQL["quotes"], KAL_SQL]) + """
SELECT coin, open_time, CAST(last_px > 0.5 AS INTEGER) AS outcome, last_px
FROM (SELECT coin, open_time, arg_max(last_price_dollars, (curr_time, id)) AS last_px
      FROM kal WHERE last_price_dollars IS NOT NULL GROUP BY ALL)""")
def a1b_last_traded_outcome(spark, d):
    """Last non-null traded price per (coin, open_time) above 0.5."""
    k = _kal(spark, d).where(F.col("last_price_dollars").isNotNull())
    return (k.groupBy("coin", "open_time").agg(F.max_by("last_price_dollars", F.struct("curr_time", "id")).alias("last_px"))
            .withColumn("outcome", (F.col("last_px") > 0.5).cast("int")))


@register("a2_spot_bars", W([VIEW_SQL["trades"], TR_SQL]) + f"""
SELECT coin, make_timestamp(((epoch_us(trade_time) + {UNIT_US - 1}) // {UNIT_US}) * {UNIT_US}) AS bar_time,
       arg_max(price, (trade_time, id)) AS last_price, round(sum(size), 9) AS size_sum,
       round(sum(signed_size), 9) AS signed_size_sum, count(*) AS n_trades
FROM tr GROUP BY 1, 2""", ["size_sum", "signed_size_sum"])
def a2_spot_bars(spark, d):
    """A2: right-closed, right-labelled bars per coin; empty units emit nothing."""
    t = clean.prepare_trades(_tr(spark, d))
    label = F.expr(f"timestamp_micros(((unix_micros(trade_time) + {UNIT_US - 1}) div {UNIT_US}) * {UNIT_US})")
    return t.groupBy("coin", label.alias("bar_time")).agg(
        F.max_by("price", F.struct("trade_time", "id")).alias("last_price"), F.sum("size").alias("size_sum"),
        F.sum("signed_size").alias("signed_size_sum"), F.count(F.lit(1)).alias("n_trades"))


_QS = [("q10", 0.10), ("q25", 0.25), ("q75", 0.75), ("q90", 0.90)]


@register("a5_quantile_bands", W([VIEW_SQL["quotes"], KAL_SQL, PREP_SQL]) + """
SELECT time_to_close, round(median(x), 9) AS median, """ + ", ".join(
    f"max(CASE WHEN rn = round((n - 1) * {q}) THEN x END) AS {nm}" for nm, q in _QS) + """
FROM (SELECT time_to_close, x, row_number() OVER (PARTITION BY time_to_close ORDER BY x) - 1 AS rn,
             count(*) OVER (PARTITION BY time_to_close) AS n
      FROM (SELECT time_to_close, (yes_ask_dollars + yes_bid_dollars) / 2 AS x FROM prepf WHERE coin = 'BTC') WHERE x IS NOT NULL)
GROUP BY time_to_close""", ["median"])
def a5_quantile_bands(spark, d):
    """A5: median (linear) and nearest-rank q10/25/75/90 of the BTC mid per time-to-close."""
    from tidemark.operators.stats import quantile_bands
    k = feat.prepare_kalshi(_kal(spark, d), UNIT_US).where("coin = 'BTC'")
    x = k.select("time_to_close", ((F.col("yes_ask_dollars") + F.col("yes_bid_dollars")) / 2).alias("x"))
    return quantile_bands(x, "time_to_close", "x", dict(_QS))


@register("a6_weighted_flow", W([VIEW_SQL["trades"], TR_SQL]) + """
SELECT coin, round(sum(price * size * trade_sign), 6) AS weighted_flow FROM tr GROUP BY coin""", ["weighted_flow"])
def a6_weighted_flow(spark, d):
    """Total signed dollar flow per coin."""
    t = clean.prepare_trades(_tr(spark, d))
    return t.groupBy("coin").agg(F.round(F.sum("weighted"), 6).alias("weighted_flow"))


@register("a8_value_counts", W([VIEW_SQL["trades"]]) + """
SELECT side, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM trades GROUP BY side""")
def a8_value_counts(spark, d):
    """Value counts with normalised share."""
    c = tv.trades(spark, d).groupBy("side").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


@register("a9_histogram", W([VIEW_SQL["ticks"]]) + """
SELECT bins, bin, count(*) AS n FROM (
  SELECT b.bins, least(CAST(floor((p_hat - mn) / (mx - mn) * b.bins) AS BIGINT), b.bins - 1) AS bin
  FROM ticks, (SELECT min(p_hat) AS mn, max(p_hat) AS mx FROM ticks) r, (VALUES (10), (30)) b(bins))
GROUP BY ALL""")
def a9_histogram(spark, d):
    """Equal-width histograms (10 and 30 bins) over min..max, last bin closed."""
    from tidemark.operators.stats import histogram
    t = tv.ticks(spark, d)
    return histogram(t, "p_hat", 10).unionByName(histogram(t, "p_hat", 30))


@register("a10_global_bounds", W([VIEW_SQL["quotes"]]) + """
SELECT min(open_time) AS first_open, max(close_time) AS last_close FROM quotes""")
def a10_global_bounds(spark, d):
    """A10: global event bounds."""
    return tv.quotes(spark, d).agg(F.min("open_time").alias("first_open"), F.max("close_time").alias("last_close"))


# ---------------------------------------------------------------- W: other window operators
@register("w11_sequence_gaps", W([VIEW_SQL["trades"]]) + """
SELECT id, product_id, sequence,
       CASE WHEN prev IS NULL THEN 0 WHEN sequence > prev THEN sequence - prev - 1 ELSE 0 END AS gap
FROM (SELECT *, lag(sequence) OVER (PARTITION BY CAST(curr_time AS DATE), product_id ORDER BY curr_time, id) AS prev FROM trades)""")
def w11_sequence_gaps(spark, d):
    """Missing sequence numbers per (connection = day, product) in arrival order."""
    from tidemark.operators.windows import seq_gap
    t = tv.trades(spark, d).withColumn("_conn", F.to_date("curr_time"))
    w = Window.partitionBy("_conn", "product_id").orderBy("curr_time", "id")
    return t.select("id", "product_id", "sequence", seq_gap("sequence", w).alias("gap"))


_LIVE = ["live_vol_30", "live_vol_300", "live_flow_mean_30", "live_size_mean_30"]
_LIVE_SQL = """live AS (
  SELECT trade_time,
         CASE WHEN count(btc_spot_return_1s) OVER w30 >= 2 THEN stddev_pop(btc_spot_return_1s) OVER w30 ELSE 0 END AS live_vol_30,
         CASE WHEN count(btc_spot_return_1s) OVER w300 >= 2 THEN stddev_pop(btc_spot_return_1s) OVER w300 ELSE 0 END AS live_vol_300,
         avg(btc_spot_signed_size_1s) OVER w30 AS live_flow_mean_30, avg(btc_spot_size_1s) OVER w30 AS live_size_mean_30
  FROM spot
  WINDOW w30 AS (PARTITION BY coin ORDER BY trade_time ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
         w300 AS (PARTITION BY coin ORDER BY trade_time ROWS BETWEEN 299 PRECEDING AND CURRENT ROW))"""


@register("w12_live_spot_windows", W([VIEW_SQL["quotes"], VIEW_SQL["trades"], KAL_SQL, TR_SQL, BARS_SQL, _LIVE_SQL]) + "\nSELECT trade_time, "
          + ", ".join(f"round({c}, 9) AS {c}" for c in _LIVE) + " FROM live", _LIVE)
def w12_live_spot_windows(spark, d):
    """The live engine's spot windows: population std, partial windows allowed (from 2 rows)."""
    from tidemark.operators.stats import live_spot_windows
    return live_spot_windows(feat.spot_features(_tr(spark, d), "BTC", UNIT_US)).select("trade_time", *_LIVE)


# ---------------------------------------------------------------- J: joins
@register("j1_asof_spot", W([VIEW_SQL["quotes"], VIEW_SQL["trades"], KAL_SQL, TR_SQL]) + """
SELECT k.id, k.coin, k.curr_time, s.trade_time, s.price
FROM kal k ASOF LEFT JOIN (SELECT coin, trade_time, price FROM tr) s ON k.coin = s.coin AND k.curr_time >= s.trade_time""")
def j1_asof_spot(spark, d):
    """Every quote gets the latest same-coin spot trade at or before it."""
    kal = _kal(spark, d).select("id", "coin", "curr_time")
    spot = clean.prepare_trades(_tr(spark, d)).select("coin", "trade_time", "price")
    return asof_join(kal, AsofRight(spot, "trade_time", ["trade_time", "price"]), "curr_time", by=["coin"])


@register("j6_range_join_trades", W([VIEW_SQL["quotes"], VIEW_SQL["trades"], KAL_SQL, TR_SQL, PREP_SQL, FEAT_SQL]) + """
SELECT k.coin, k.curr_time, count(*) AS trade_count, round(sum(size), 9) AS size_sum,
       round(sum(CASE WHEN side = 'buy' THEN size ELSE 0 END), 9) AS buy_size_sum,
       round(sum(CASE WHEN side = 'sell' THEN size ELSE 0 END), 9) AS sell_size_sum,
       round(sum(CASE WHEN side = 'buy' THEN size ELSE 0 END) - sum(CASE WHEN side = 'sell' THEN size ELSE 0 END), 9) AS size_imbalance,
       round(avg(t.price), 9) AS price_mean, round(stddev_samp(t.price), 9) AS price_std,
       round(sum(t.price * size) / sum(size), 9) AS vwap
FROM (SELECT coin, curr_time, prev_time FROM feat) k
JOIN tr t ON t.coin = k.coin AND t.trade_time >= k.prev_time AND t.trade_time <= k.curr_time
GROUP BY k.coin, k.curr_time""", ["size_sum", "buy_size_sum", "sell_size_sum", "size_imbalance", "price_mean", "price_std", "vwap"])
def j6_range_join_trades(spark, d):
    """J6 + A4: trades inside [prev_time, curr_time] of each gated tick, both ends inclusive."""
    ticks = feat.coin_features(_kal(spark, d), _tr(spark, d), unit_us=UNIT_US)
    return variants.tick_trade_features(ticks, _tr(spark, d), UNIT_US)


@register("j10_train_event_rows", W([VIEW_SQL["quotes"], KAL_SQL, PREP_SQL]) + """
SELECT p.id, p.coin, p.open_time, p.curr_time FROM prepf p
SEMI JOIN (SELECT open_time, close_time FROM (
             SELECT open_time, close_time, row_number() OVER (ORDER BY open_time, close_time) AS r, count(*) OVER () AS n
             FROM (SELECT DISTINCT open_time, close_time FROM prepf WHERE coin = 'BTC'))
           WHERE r <= round(0.7 * n)) e
  ON p.open_time = e.open_time AND p.close_time = e.close_time
WHERE p.coin = 'BTC'""")
def j10_train_event_rows(spark, d):
    """J10 + M1: rows of the events in the chronological training split (semi join)."""
    from tidemark.ml.split import chrono_event_split
    k = feat.prepare_kalshi(_kal(spark, d), UNIT_US).where("coin = 'BTC'")
    ev = chrono_event_split(k, ["open_time", "close_time"], "open_time", 0.7).where("split = 'train'")
    return k.join(ev, ["open_time", "close_time"], "left_semi").select("id", "coin", "open_time", "curr_time")


# ---------------------------------------------------------------- Q5, Q8, Q9
_Q5_SQL = W([VIEW_SQL["poly"], VIEW_SQL["trades"], TR_SQL, f"""p0 AS (
  SELECT * FROM (SELECT *, (epoch_us(end_date) - epoch_us(curr_time)) // {UNIT_US} AS time_to_close FROM poly WHERE coin = 'BTC')
  WHERE time_to_close BETWEEN 0 AND 120
  QUALIFY row_number() OVER (PARTITION BY coin, interval_start_unix, end_date, time_to_close ORDER BY curr_time, id) = 1)""",
    """p1 AS (
  SELECT *, lag(curr_time) OVER w AS prev_time, coalesce(volume - lag(volume) OVER w, 0) AS volume_delta_raw
  FROM p0 WINDOW w AS (PARTITION BY coin, interval_start_unix, end_date ORDER BY curr_time))"""]) + """
SELECT p1.curr_time, interval_start_unix AS poly_interval_start_unix, end_date AS poly_end_date,
       time_to_close AS poly_time_to_close, strike_price AS poly_strike_price, liquidity AS poly_liquidity,
       volume AS poly_volume, CASE WHEN volume_delta_raw < 0 THEN 0 ELSE volume_delta_raw END AS poly_volume_delta,
       yes_implied_price AS poly_yes_implied_price, (yes_buy_price + yes_sell_price) / 2 AS poly_yes_mid_price,
       yes_buy_price - yes_sell_price AS poly_yes_spread_price, s.price - strike_price AS poly_distance_from_strike
FROM p1 ASOF LEFT JOIN (SELECT coin, trade_time, price FROM tr WHERE coin = 'BTC') s
  ON p1.coin = s.coin AND p1.curr_time >= s.trade_time"""


@register("q5_polymarket_features", _Q5_SQL)
def q5_polymarket_features(spark, d):
    """Q5: BTC second-venue features."""
    return variants.polymarket_features(clean.clean_polymarket(tv.poly(spark, d), COINS, with_id=False), _tr(spark, d),
                                        unit_us=UNIT_US, max_ttc=tv.EVENT_S // tv.UNIT_S)


def _q8_sql():
    nbf = variants.NB_FEATURES
    ctes = [VIEW_SQL["quotes"], VIEW_SQL["trades"], KAL_SQL, TR_SQL, f"""nk AS (
  SELECT * FROM (SELECT *, (epoch_us(close_time) - epoch_us(curr_time)) // {UNIT_US} AS time_to_close FROM kal)
  QUALIFY row_number() OVER (PARTITION BY coin, open_time, close_time, time_to_close ORDER BY curr_time, id) = 1)""",
            f"""nb0 AS (
  SELECT * FROM (SELECT *, lag(curr_time) OVER (PARTITION BY coin, open_time, close_time ORDER BY curr_time) AS prev_time
                 FROM nk WHERE coin = 'BTC' AND time_to_close >= 0)
  WHERE (epoch_us(curr_time) - epoch_us(prev_time)) // {UNIT_US} BETWEEN 0.9 AND 1.1)""",
            """nb1 AS (
  SELECT nb0.*, s.price, s.trade_time, s.price - floor_strike AS distance_from_strike,
         (yes_ask_dollars + yes_bid_dollars) / 2 AS yes_mid_dollars
  FROM nb0 ASOF LEFT JOIN (SELECT coin, trade_time, price FROM tr) s ON nb0.coin = s.coin AND nb0.curr_time >= s.trade_time)""",
            """nbtc AS (
  SELECT *, CAST(CASE WHEN lm IS NULL THEN NULL ELSE lm > 0.5 END AS INTEGER) AS outcome
  FROM (SELECT *, arg_max_null(yes_mid_dollars, curr_time) OVER (PARTITION BY open_time, close_time) AS lm FROM nb1))"""]
    for c in ("ETH", "XRP", "SOL"):
        ctes.append(f"""o_{c} AS (
  SELECT curr_time AS rt, last_price_dollars, yes_bid_dollars, yes_ask_dollars, no_bid_dollars, no_ask_dollars,
         (yes_ask_dollars + yes_bid_dollars) / 2 AS yes_mid_dollars, yes_ask_dollars - yes_bid_dollars AS spread_dollars,
         (yes_ask_dollars + yes_bid_dollars) / 2 + (no_ask_dollars + no_bid_dollars) / 2 AS cross_sum_mid,
         time_to_close, floor_strike
  FROM nk WHERE coin = '{c}' AND time_to_close >= 0)""")
    sel = ["b.id", "b.curr_time", "b.open_time", "b.close_time", "b.time_to_close", "b.prev_time", "b.price", "b.trade_time",
           "b.distance_from_strike", "b.yes_mid_dollars", "b.outcome"]
    frm = "nbtc b"
    for c in ("ETH", "XRP", "SOL"):
        frm += f"\n  ASOF LEFT JOIN o_{c} ON b.curr_time >= o_{c}.rt"
        sel += [f"CASE WHEN epoch_us(b.curr_time) - epoch_us(o_{c}.rt) <= {2 * UNIT_US} THEN o_{c}.{f} END AS {c}_{f}" for f in nbf]
    return W(ctes) + f"\nSELECT {', '.join(sel)} FROM {frm}"


@register("q8_notebook_tolerance_asof", _q8_sql())
def q8_notebook_tolerance_asof(spark, d):
    """Q8: notebook build: gated BTC, other coins as-of with a 2-unit tolerance (J3), outcome."""
    out = variants.notebook_combined(_kal(spark, d), _tr(spark, d), unit_us=UNIT_US)
    keep = ["id", "curr_time", "open_time", "close_time", "time_to_close", "prev_time", "price", "trade_time",
            "distance_from_strike", "yes_mid_dollars", "outcome"]
    return out.select(*keep, *[f"{c}_{f}" for c in ("ETH", "XRP", "SOL") for f in variants.NB_FEATURES])


def _q9_sql():
    keep = ["open_time", "close_time", "last_price_dollars", "yes_bid_dollars", "yes_ask_dollars", "time_to_close",
            "next_price_dollars_lead1"]
    ctes = [VIEW_SQL["quotes"], KAL_SQL, f"""k9 AS (
  SELECT *, lead(last_price_dollars) OVER (PARTITION BY coin, open_time, close_time ORDER BY curr_time, id) AS next_price_dollars_lead1
  FROM (SELECT *, (epoch_us(close_time) - epoch_us(curr_time)) // {UNIT_US} AS time_to_close FROM kal) WHERE time_to_close > 0)"""]
    for c in ("BTC", "ETH", "XRP", "SOL"):
        ctes.append(f"c_{c} AS (SELECT curr_time, " + ", ".join(f"{x} AS {c}_{x}" for x in keep) + f" FROM k9 WHERE coin = '{c}')")
    frm = "c_BTC" + "".join(f" LEFT JOIN c_{c} USING (curr_time)" for c in ("ETH", "XRP", "SOL"))
    ctes.append(f"j AS (SELECT * FROM {frm} WHERE BTC_next_price_dollars_lead1 IS NOT NULL)")
    return W(ctes) + """
SELECT *, CAST(CASE WHEN lp IS NULL THEN NULL ELSE lp > 0.5 END AS INTEGER) AS outcome FROM (
  SELECT *, arg_max(BTC_last_price_dollars, curr_time) OVER (PARTITION BY BTC_open_time) AS lp FROM j) """.replace("SELECT *, CAST", "SELECT * EXCLUDE (lp), CAST")


@register("q9_equijoin_variant", _q9_sql())
def q9_equijoin_variant(spark, d):
    """Q9: exact-time left joins of coin frames (J8), next-price target (W2), outcome."""
    return variants.equijoin_combined(_kal(spark, d), unit_us=UNIT_US)

"""Trade sheets, lag diagnostics, limit checks, cash and drift."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import ledger as lg
from tidemark.operators import parse as ps
from tidemark.operators import tradesheet as sheet
from tidemark.operators import walkforward as wf
from tidemark.operators.asof import AsofRight, asof_join
from tidemark.operators.timeseries import market_bars
from tidemark.plans import catalog, catalog_market, catalog_trading, catalog_ts  # noqa: F401  (their queries are composed here)
from tidemark.plans import features as feat
from tidemark.plans.catalog_trading import _LOTS, _OPEN, _RP, FEE, ORD, W
from tidemark.registry import REGISTRY, register
from tidemark.session import scratch_path
from tidemark.sources import testviews as tv
from tidemark.sources.testviews import EVENT_US, FILL_ORDER, UNIT_US, VIEW_SQL


def sql_of(name: str) -> str:
    return f"({REGISTRY[name][1]})"


# ---------------------------------------------------------------- J11, E13-E15: trade sheet
# Forecast of a bar: the mid two bars before, drawn a tenth towards one half.
# Bars of 16 units: an event of 120 units has seven, like 900 seconds in bars of 120.
_BIN = 16 * UNIT_US
_SHEET = f"""{VIEW_SQL["quotes"]},
m AS MATERIALIZED (
  SELECT make_timestamp(CAST(floor(epoch_us(curr_time) / {_BIN}) AS BIGINT) * {_BIN}) AS time, open_time, close_time,
         greatest(0, least(1, avg((yes_ask_dollars + yes_bid_dollars) / 2))) AS yes_mid, greatest(0, avg(yes_ask_dollars - yes_bid_dollars)) AS yes_spread
  FROM quotes WHERE coin = 'BTC' AND yes_ask_dollars IS NOT NULL AND yes_bid_dollars IS NOT NULL GROUP BY ALL),
o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY time, open_time, close_time) AS i FROM m),
fc AS (SELECT a.time, arg_min(0.9 * b.yes_mid + 0.05, a.i) AS predicted FROM o a JOIN o b ON b.i = a.i - 2 GROUP BY a.time),
pr AS (SELECT n.*, p.time AS ptime, p.open_time AS popen, p.close_time AS pclose, p.yes_mid AS pmid, p.yes_spread AS pspread FROM o n JOIN o p ON p.i = n.i - 1),
fi AS (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY time ORDER BY open_time, close_time) = 1),
sheet AS MATERIALIZED (
  SELECT fi.time, pmid AS current, yes_mid AS actual, predicted, greatest(0, least(1, pmid + pspread / 2)) AS yes_ask, 1 - greatest(0, least(1, pmid - pspread / 2)) AS no_ask,
         greatest(0, least(1, yes_mid - yes_spread / 2)) AS future_yes_bid, 1 - greatest(0, least(1, yes_mid + yes_spread / 2)) AS future_no_bid
  FROM fi JOIN fc ON fi.time = fc.time WHERE open_time = popen AND close_time = pclose AND ptime < pclose AND fi.time <= close_time)"""
_CURVE = f"""curve AS (
  SELECT threshold, count_if(s <> 0) / count(*) AS coverage, CAST(count_if(s <> 0) AS BIGINT) AS trade_count, CAST(count_if(s > 0) AS BIGINT) AS yes_trade_count,
         CAST(count_if(s < 0) AS BIGINT) AS no_trade_count, round(coalesce(avg(CAST(p > 0 AS INTEGER)), 0), 9) AS hit_rate,
         round(coalesce(avg(p), 0), 9) AS avg_gross_pnl, round(coalesce(sum(p), 0), 9) AS total_gross_pnl
  FROM (SELECT *, CASE WHEN s > 0 THEN future_yes_bid - yes_ask WHEN s < 0 THEN future_no_bid - no_ask END AS p FROM (
    SELECT sheet.*, t.threshold, CASE WHEN abs(predicted - current) >= t.threshold THEN sign(predicted - current) ELSE 0 END AS s
    FROM sheet, (SELECT unnest([{", ".join(f"CAST({t} AS DOUBLE)" for t in sheet.THRESHOLDS)}]) AS threshold) t)) GROUP BY threshold)"""


def _sheet(spark, d):
    q = tv.quotes(spark, d).where("coin = 'BTC'").select(
        "curr_time", "open_time", "close_time", ((F.col("yes_ask_dollars") + F.col("yes_bid_dollars")) / 2).alias("yes_mid"),
        (F.col("yes_ask_dollars") - F.col("yes_bid_dollars")).alias("yes_spread"))
    bars = market_bars(q, _BIN)
    numbered = sheet.dense_index(bars, ["time", "open_time", "close_time"], name="_i")
    two = numbered.select((F.col("_i") + 2).alias("_i"), (0.9 * F.col("yes_mid") + 0.05).alias("predicted"))
    forecasts = numbered.select("_i", "time").join(two, "_i").groupBy("time").agg(F.min_by("predicted", "_i").alias("predicted"))
    return sheet.trade_sheet(bars, forecasts)


@register("e13_trade_sheet", W([_SHEET]) + """
SELECT time, round(current, 9) AS current, round(actual, 9) AS actual, round(predicted, 9) AS predicted, round(yes_ask, 9) AS yes_ask,
       round(no_ask, 9) AS no_ask, round(future_yes_bid, 9) AS future_yes_bid, round(future_no_bid, 9) AS future_no_bid FROM sheet""",
          ["current", "actual", "predicted", "yes_ask", "no_ask", "future_yes_bid", "future_no_bid"])
def e13_trade_sheet(spark, d):
    """J11 + E13: a forecast per market bar, met with the bar and its predecessor."""
    return _sheet(spark, d)


@register("e14_threshold_curve", W([_SHEET, _CURVE]) + "\nSELECT * FROM curve", ["hit_rate", "avg_gross_pnl", "total_gross_pnl"])
def e14_threshold_curve(spark, d):
    """Coverage, trades, hit rate and PnL at ten cutoffs."""
    return sheet.threshold_curve(_sheet(spark, d))


@register("e15_best_cutoff", W([_SHEET, _CURVE]) + f"""
SELECT c.*, round(a.acc, 9) AS directional_accuracy FROM (
  SELECT * FROM curve ORDER BY coverage >= {sheet.MIN_COVERAGE} DESC, total_gross_pnl DESC, avg_gross_pnl DESC, threshold LIMIT 1) c,
  (SELECT avg(CAST(sign(predicted - current) = sign(actual - current) AS INTEGER)) AS acc FROM sheet WHERE actual <> current) a""",
          ["hit_rate", "avg_gross_pnl", "total_gross_pnl", "directional_accuracy"])
def e15_best_cutoff(spark, d):
    """The best cutoff and the directional accuracy."""
    return sheet.best_cutoff(_sheet(spark, d))


# ---------------------------------------------------------------- X2-X4: lag diagnostics
def _acf(spark, d, name):
    return REGISTRY[name][0](spark, d)


def _n_obs(spark, d, less: int):
    from tidemark.operators import clean
    bars = feat.spot_bars(clean.clean_trades(tv.trades(spark, d), tv.COINS, with_id=False), None, UNIT_US)
    return bars.groupBy("coin").agg((F.count(F.lit(1)) - less).alias("n_obs"))


@register("x2_pacf_level", "WITH RECURSIVE a AS MATERIALIZED (SELECT coin, list(acf ORDER BY lag) AS r FROM " + sql_of("x1_acf_level") + """ GROUP BY coin),
dl AS (
  SELECT coin, r, 1 AS k, [r[1]] AS phi, r[1] AS pacf FROM a
  UNION ALL
  SELECT coin, r, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - f * phi[k + 1 - j]), f), f FROM (
    SELECT *, (r[k + 1] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 1 - j])))
              / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j]))) AS f FROM dl WHERE k < 7))
SELECT coin, CAST(k AS BIGINT) AS lag, round(pacf, 6) AS pacf FROM dl""")
def x2_pacf_level(spark, d):
    """Partial autocorrelation to lag 7 of each coin's bar price."""
    p = sheet.pacf(_acf(spark, d, "x1_acf_level"), "coin")
    return p.select("coin", "lag", F.round("pacf", 6).alias("pacf"))


def _kept(df, name):
    """A table of a few rows a coin, written once: what uses it reads these rows instead of planning its scans and
    shuffles again, which all met in the operators of one task."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:10]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _lags(spark, d):
    level, diff = (_kept(_acf(spark, d, name), name) for name in ("x1_acf_level", "x1_acf_difference"))
    n0 = _kept(_n_obs(spark, d, 0), "x3_n_obs")
    n1 = n0.select("coin", (F.col("n_obs") - 1).alias("n_obs"))
    partial = sheet.pacf(level, "coin").select("coin", "lag", F.round("pacf", 6).alias("pacf"))
    parts = (sheet.largest_visible(partial, "coin", "pacf", n0, 3), sheet.largest_visible(level, "coin", "acf", n0, 3),
             sheet.largest_visible(diff, "coin", "acf", n1, 2), sheet.seasonal_lags(level, "coin"))
    return tuple(_kept(p, f"x3_{k}") for k, p in zip(("ar", "ma", "arima_ma", "seasonal"), parts))


_NOBS = "nb AS MATERIALIZED (SELECT coin, count(*) AS n FROM b GROUP BY coin)"


def _visible(src: str, value: str, less: int, n: int) -> str:
    return f"""SELECT nb.coin, list_sort(list_distinct(list_concat([CAST(1 AS BIGINT)], coalesce(v.l, [])))) AS lags FROM nb LEFT JOIN (
  SELECT coin, list(lag) AS l FROM (SELECT x.coin, x.lag, row_number() OVER (PARTITION BY x.coin ORDER BY abs({value}) DESC, x.lag) AS rn
    FROM {sql_of(src)} x JOIN nb ON nb.coin = x.coin WHERE abs({value}) > 1.96 / sqrt(nb.n - {less})) WHERE rn <= {n} GROUP BY coin) v ON v.coin = nb.coin"""


_LAGS_SQL = "WITH " + VIEW_SQL["trades"] + ",\n" + catalog_ts._BARS + ",\n" + _NOBS + f""",
ar AS MATERIALIZED ({_visible("x2_pacf_level", "pacf", 0, 3)}), ma AS MATERIALIZED ({_visible("x1_acf_level", "acf", 0, 3)}),
dm AS MATERIALIZED ({_visible("x1_acf_difference", "acf", 1, 2)}),
se AS MATERIALIZED (SELECT coin, list(lag ORDER BY rn) AS lags FROM (
  SELECT coin, lag, row_number() OVER (PARTITION BY coin ORDER BY abs(acf) DESC, lag) AS rn FROM {sql_of("x1_acf_level")} WHERE lag IN (2, 3, 5, 7)) WHERE rn <= 2 GROUP BY coin)"""


@register("x3_visible_lags", _LAGS_SQL + """
SELECT coin, 'ar' AS kind, lags FROM ar UNION ALL SELECT coin, 'ma', lags FROM ma UNION ALL SELECT coin, 'arima_ma', lags FROM dm UNION ALL SELECT coin, 'seasonal', lags FROM se""")
def x3_visible_lags(spark, d):
    """Lags worth a model, per coin and kind."""
    parts = [df.select("coin", F.lit(k).alias("kind"), "lags") for k, df in zip(("ar", "ma", "arima_ma", "seasonal"), _lags(spark, d))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@register("x4_candidates", _LAGS_SQL + """,
a AS (SELECT coin, unnest(lags) AS x FROM ar), m AS (SELECT coin, unnest(lags) AS x FROM ma), s AS (SELECT coin, unnest(lags) AS x FROM se),
a3 AS (SELECT coin, unnest(lags[1:3]) AS x FROM ar), m3 AS (SELECT coin, unnest(lags[1:3]) AS x FROM ma), d3 AS (SELECT coin, unnest(lags[1:3]) AS x FROM dm)
SELECT DISTINCT coin, family, CAST(p AS BIGINT) AS p, CAST(d AS BIGINT) AS d, CAST(q AS BIGINT) AS q, CAST(sp AS BIGINT) AS sp, CAST(sq AS BIGINT) AS sq, CAST(period AS BIGINT) AS period FROM (
  SELECT coin, 'AR' AS family, x AS p, 0 AS d, 0 AS q, 0 AS sp, 0 AS sq, NULL AS period FROM a UNION ALL SELECT coin, 'MA', 0, 0, x, 0, 0, NULL FROM m
  UNION ALL SELECT a3.coin, 'ARMA', a3.x, 0, m3.x, 0, 0, NULL FROM a3 JOIN m3 ON a3.coin = m3.coin UNION ALL SELECT a3.coin, 'ARIMA', a3.x, 1, d3.x, 0, 0, NULL FROM a3 JOIN d3 ON a3.coin = d3.coin
  UNION ALL SELECT coin, 'SARMA', 0, 0, 0, 1, 0, x FROM s UNION ALL SELECT coin, 'SARMA', 0, 0, 0, 0, 1, x FROM s UNION ALL SELECT coin, 'SARMA', 1, 0, 1, 1, 0, x FROM s)""")
def x4_candidates(spark, d):
    """Candidate AR, MA, ARMA, ARIMA and SARMA models per coin."""
    return sheet.candidates("coin", *_lags(spark, d))


# ---------------------------------------------------------------- J5, J9
_J5_COLS = ["poly_interval_start_unix", "poly_yes_mid_price", "poly_yes_spread_price", "poly_volume_delta", "poly_distance_from_strike"]


@register("j5_second_venue_asof", "SELECT q.*, " + ", ".join(f"p.{c}" for c in _J5_COLS) + f" FROM {sql_of('q3_btc_kalshi')} q ASOF LEFT JOIN {sql_of('q5_polymarket_features')} p ON q.curr_time >= p.curr_time")
def j5_second_venue_asof(spark, d):
    """The second venue's latest features at every BTC row."""
    left, right = REGISTRY["q3_btc_kalshi"][0](spark, d), REGISTRY["q5_polymarket_features"][0](spark, d)
    return asof_join(left, AsofRight(right, "curr_time", _J5_COLS), "curr_time")


_J9_UNIT = 24 * UNIT_US


@register("j9_inner_concat", W([VIEW_SQL["trades"], f"""b AS (
  SELECT replace(product_id, '-USD', '') AS coin, make_timestamp(((epoch_us(trade_time) + {_J9_UNIT - 1}) // {_J9_UNIT}) * {_J9_UNIT}) AS t, arg_max(price, (trade_time, id)) AS x
  FROM (SELECT * FROM trades QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY curr_time, id) = 1) GROUP BY 1, 2)"""]) + """
SELECT b1.t AS time, b1.x AS BTC_price, b2.x AS ETH_price, b3.x AS XRP_price, b4.x AS SOL_price
FROM (SELECT * FROM b WHERE coin = 'BTC') b1 JOIN (SELECT * FROM b WHERE coin = 'ETH') b2 ON b1.t = b2.t
JOIN (SELECT * FROM b WHERE coin = 'XRP') b3 ON b1.t = b3.t JOIN (SELECT * FROM b WHERE coin = 'SOL') b4 ON b1.t = b4.t""")
def j9_inner_concat(spark, d):
    """Coins side by side where all have a bar of that time: one grouping instead of a chain of joins."""
    from tidemark.operators import clean
    bars = feat.spot_bars(clean.clean_trades(tv.trades(spark, d), tv.COINS, with_id=False), None, _J9_UNIT)
    wide = bars.groupBy(F.col("trade_time").alias("time")).agg(*[F.max(F.when(F.col("coin") == c, F.col("btc_spot_price"))).alias(f"{c}_price") for c in tv.COINS],
                                                               F.count_distinct("coin").alias("n"))
    return wide.where(F.col("n") == len(tv.COINS)).drop("n")


# ---------------------------------------------------------------- L6, L10, L11, A7
_STATE = """st AS MATERIALIZED (
  SELECT portfolio, sum(price * contracts) / 1000 AS exposure, count(DISTINCT ticker) % 6 AS open_markets, CAST(40 + portfolio % 80 AS DOUBLE) AS lim
  FROM fills WHERE action = 'buy' GROUP BY portfolio),
hd AS MATERIALIZED (SELECT DISTINCT portfolio, ticker FROM fills WHERE action = 'buy' AND line_no <= 3),
sg AS (SELECT order_key, line_no, ticker, portfolio, price, CAST(contracts AS BIGINT) - 3 AS contracts FROM fills)"""


@register("l6_limit_check", W([VIEW_SQL["fills"], _STATE]) + f"""
SELECT order_key, line_no, ticker, portfolio, price, contracts,
       CASE WHEN contracts <= 0 THEN 'non_positive' WHEN hd.ticker IS NULL AND coalesce(open_markets, 0) >= {lg.MAX_MARKETS} THEN 'market_cap'
            WHEN coalesce(exposure, 0) + contracts * price > coalesce(lim, {lg.HARD_CAP}) THEN 'exposure'
            WHEN coalesce(exposure, 0) + contracts * price > {lg.HARD_CAP} THEN 'hard_cap' ELSE 'ok' END AS reason,
       greatest(0, least(contracts, CASE WHEN price > 0 THEN CAST(trunc(greatest(0, coalesce(lim, {lg.HARD_CAP}) - coalesce(exposure, 0)) / price) AS BIGINT) ELSE 0 END)) AS capped
FROM sg LEFT JOIN st USING (portfolio) LEFT JOIN hd USING (portfolio, ticker)""")
def l6_limit_check(spark, d):
    """Every fill as a request against its portfolio's given state."""
    f = tv.fills(spark, d)
    buys = f.where("action = 'buy'")
    state = buys.groupBy("portfolio").agg((F.sum(F.col("price") * F.col("contracts")) / 1000).alias("exposure"), (F.count_distinct("ticker") % 6).alias("open_markets"))
    state = state.withColumn("limit", (40 + F.col("portfolio") % 80).cast("double"))
    signals = f.select("order_key", "line_no", "ticker", "portfolio", "price", (F.col("contracts").cast("long") - 3).alias("contracts"))
    return lg.limit_check(signals, state, buys.where("line_no <= 3"))


_CASH = f"""ce AS (
  SELECT time, 0 AS kind, order_key, line_no, ticker, portfolio, side,
         CASE WHEN action = 'buy' THEN -contracts * (price + {FEE('price')}) ELSE effective_sell * (price - {FEE('price')}) END AS cash FROM rp
  UNION ALL
  SELECT time + INTERVAL 30 DAY, 1, order_key, line_no, ticker, portfolio, side, contracts FROM settled WHERE won)"""


def _cash(spark, d):
    return lg.cash_events(tv.fills(spark, d), tv.outcomes(spark, d), FILL_ORDER)


@register("l10_cash_curve", W([VIEW_SQL["fills"], VIEW_SQL["outcomes"], _RP, _OPEN, _CASH]) + f"""
SELECT time, CAST(kind AS INTEGER) AS kind, order_key, line_no, ticker, portfolio, side, round(cash, 6) AS cash,
       round(sum(cash) OVER (ORDER BY time, kind, {ORD.replace('time, ', '')}, side ROWS UNBOUNDED PRECEDING), 4) AS balance FROM ce""")
def l10_cash_curve(spark, d):
    """The account's cash after every fill and settlement (30 days after the lot's entry)."""
    order = ["time", "kind", *[c for c in FILL_ORDER if c != "time"], "side"]
    c = lg.cash_curve(_cash(spark, d), order)
    return c.select(*order, F.round("cash", 6).alias("cash"), F.round("balance", 4).alias("balance"))


@register("l11_balance_drift", W([VIEW_SQL["fills"], VIEW_SQL["outcomes"], _RP, _OPEN, _CASH]) + """
SELECT c.portfolio AS portfolio, s_acctbal AS balance, round(c.cash + coalesce(e.exposure, 0), 4) AS paper_equity, round(s_acctbal - (c.cash + coalesce(e.exposure, 0)), 4) AS drift
FROM supplier JOIN (SELECT portfolio, sum(cash) AS cash FROM ce GROUP BY portfolio) c ON s_suppkey = c.portfolio
LEFT JOIN (SELECT o.portfolio, sum(o.contracts * o.price) AS exposure FROM olots o WHERE o.contracts > 0 GROUP BY o.portfolio) e ON e.portfolio = c.portfolio""")
def l11_balance_drift(spark, d):
    """Each account's reported balance against its paper equity."""
    cash = _cash(spark, d).groupBy("portfolio").agg(F.sum("cash").alias("cash"))
    open_ = lg.open_lots(tv.fills(spark, d), FILL_ORDER).groupBy("portfolio").agg(F.sum(F.col("contracts") * F.col("price")).alias("exposure"))
    paper = cash.join(open_, "portfolio", "left").fillna(0.0, ["exposure"])
    reported = tv.table(spark, d, "supplier").select(F.col("s_suppkey").alias("portfolio"), F.col("s_acctbal").alias("balance"))
    out = lg.balance_drift(reported, paper)
    return out.select("portfolio", "balance", F.round("paper_equity", 4).alias("paper_equity"), F.round("drift", 4).alias("drift"))


@register("a7_window_pnl", W([VIEW_SQL["fills"], _RP, _LOTS]) + f"""
SELECT round(max(s), 6) AS max_pnl, round(min(s), 6) AS min_pnl, count(*) AS windows FROM (
  SELECT sum(contracts * (exit_price - entry_price - {FEE('entry_price')} - {FEE('exit_price')})) AS s FROM lots GROUP BY epoch_us(exit_time) // {EVENT_US})""")
def a7_window_pnl(spark, d):
    """Realised PnL per event window, its maximum and minimum."""
    lots = lg.fifo_lots(tv.fills(spark, d), FILL_ORDER).withColumn("window", F.expr(f"unix_micros(exit_time) div {EVENT_US}"))
    out = lg.pnl_per_window(lots, ["window"])
    return out.select(F.round("max_pnl", 6).alias("max_pnl"), F.round("min_pnl", 6).alias("min_pnl"), "windows")


# ---------------------------------------------------------------- P5, P12-P15: snapshots, options, second venue
def _iso(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


@register("p5_contract_snapshot", W([VIEW_SQL["quotes"]]) + """
SELECT id, coin, open_time, close_time, last_price_dollars, liquidity_dollars, no_ask_dollars, no_bid_dollars, yes_ask_dollars,
       CASE WHEN id % 9 <> 0 THEN yes_bid_dollars END AS yes_bid_dollars, open_interest, floor_strike, cap_strike,
       CASE WHEN id % 4 <> 0 THEN volume END AS volume, volume_24h_fp, strike_type FROM quotes""")
def p5_contract_snapshot(spark, d):
    """P5: snapshots with numbers as numbers and as text, unreadable and absent fields."""
    q = tv.quotes(spark, d)
    fields = [_iso("open_time").alias("open_time"), _iso("close_time").alias("close_time"), "last_price_dollars", "liquidity_dollars", "no_ask_dollars", "no_bid_dollars",
              F.col("yes_ask_dollars").cast("string").alias("yes_ask_dollars"), F.when(F.col("id") % 9 == 0, "-").otherwise(F.col("yes_bid_dollars").cast("string")).alias("yes_bid_dollars"),
              "open_interest", "floor_strike", "cap_strike", F.when(F.col("id") % 4 != 0, F.col("volume")).alias("volume"), "volume_24h_fp", "strike_type"]
    return ps.parse_snapshots(q.select("id", "coin", F.to_json(F.struct(*fields)).alias("raw")))


@register("p12_option_rows", W([VIEW_SQL["options"]]) + """
SELECT id, currency, instrument_name, try_strptime(string_split(instrument_name, '-')[2], '%d%b%y') AS expiry_datetime,
       TRY_CAST(string_split(instrument_name, '-')[3] AS DOUBLE) AS strike, string_split(instrument_name, '-')[4] AS option_type,
       underlying_price, mark_iv, CAST(0.5 AS DOUBLE) AS bid_price, CAST(NULL AS DOUBLE) AS ask_price, mark_price, open_interest,
       CASE WHEN id % 9 <> 0 THEN delta END AS delta, CASE WHEN id % 5 <> 0 THEN CAST(id AS DOUBLE) END AS volume FROM options""")
def p12_option_rows(spark, d):
    """Option summaries with nested greeks and stats, some without them."""
    o = tv.options(spark, d)
    body = F.struct("instrument_name", "underlying_price", "mark_iv", F.lit("0.5").alias("bid_price"), F.lit("none").alias("ask_price"), "mark_price", "open_interest",
                    F.when(F.col("id") % 9 != 0, F.struct("delta")).alias("greeks"), F.when(F.col("id") % 5 != 0, F.struct(F.col("id").alias("volume"))).alias("stats"))
    return ps.parse_option_summaries(o.select("id", "currency", F.to_json(body).alias("raw")))


def _event_rows(spark, d):
    """Event messages: every 11th without a market, every 13th with one token only."""
    p = tv.poly(spark, d)
    text = lambda *cs: F.to_json(F.array(*cs))
    yes, no = F.concat(F.lit("y"), F.col("id").cast("string")), F.concat(F.lit("n"), F.col("id").cast("string"))
    market = F.struct(F.col("market_slug").alias("slug"), F.col("condition_id").alias("conditionId"), F.col("liquidity").cast("string").alias("liquidity"), "volume",
                      F.col("open_interest").alias("openInterest"), text(F.col("yes_implied_price").cast("string"), F.col("no_implied_price").cast("string")).alias("outcomePrices"),
                      F.when(F.col("id") % 13 == 0, text(yes)).otherwise(text(yes, no)).alias("clobTokenIds"))
    markets = F.when(F.col("id") % 11 == 0, F.array().cast(f"array<{p.select(market.alias('m')).schema['m'].dataType.simpleString()}>")).otherwise(F.array(market, market))
    return p, ps.parse_events(p.select("id", "coin", "curr_time", "interval_start_unix", F.to_json(F.struct(_iso("end_date").alias("endDate"), markets.alias("markets"))).alias("raw")))


_EVENTS_SQL = """ev AS (
  SELECT id, coin, curr_time, interval_start_unix, end_date, market_slug, condition_id, liquidity, volume, open_interest, yes_implied_price, no_implied_price,
         'y' || CAST(id AS VARCHAR) AS yes_token_id, CASE WHEN id % 13 <> 0 THEN 'n' || CAST(id AS VARCHAR) END AS no_token_id FROM poly WHERE id % 11 <> 0)"""


@register("p13_event_markets", W([VIEW_SQL["poly"], _EVENTS_SQL]) + "\nSELECT * FROM ev")
def p13_event_markets(spark, d):
    """First market of each event, arrays inside strings taken by position."""
    return _event_rows(spark, d)[1]


def _snapshots(spark, d):
    p = tv.poly(spark, d)
    def rows(letter, buy, sell):
        t = p.withColumn("token_id", F.concat(F.lit(letter), F.col("id").cast("string")))
        book = t.where("id % 3 > 0").select("token_id", F.to_json(F.struct(F.col("id").cast("string").alias("timestamp"), F.array(F.col(sell).cast("string")).alias("bids"), F.array().cast("array<string>").alias("asks"))).alias("raw"))
        mid = t.select("token_id", F.when(F.col("id") % 2 == 0, F.to_json(F.struct(F.lit("0.25").alias("mid")))).otherwise(F.to_json(F.struct(F.lit("").alias("mid"), F.lit("0.75").alias("mid_price")))).alias("raw"))
        return [book, *[t.select("token_id", F.to_json(F.struct(F.col(c).cast("string").alias("price"))).alias("raw")) for c in (buy, sell)], mid]
    both = [a.unionByName(b) for a, b in zip(rows("y", "yes_buy_price", "yes_sell_price"), rows("n", "no_buy_price", "no_sell_price"), strict=True)]
    return ps.clob_snapshots(*both)


_SNAP_SQL = """sn AS (
  SELECT l || CAST(id AS VARCHAR) AS token_id, CASE WHEN id % 3 > 0 THEN CAST(id AS VARCHAR) END AS timestamp, buy AS buy_price, sell AS sell_price,
         CASE WHEN id % 2 = 0 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END AS midpoint, CASE WHEN id % 3 > 0 THEN sell END AS best_bid_price
  FROM (SELECT id, 'y' AS l, yes_buy_price AS buy, yes_sell_price AS sell FROM poly UNION ALL SELECT id, 'n', no_buy_price, no_sell_price FROM poly))"""


@register("p14_clob_snapshots", W([VIEW_SQL["poly"], _SNAP_SQL]) + "\nSELECT token_id, timestamp, buy_price, sell_price, midpoint, best_bid_price, CAST(NULL AS VARCHAR) AS best_ask FROM sn")
def p14_clob_snapshots(spark, d):
    """Book, buy, sell and midpoint answers of every token side by side."""
    s = _snapshots(spark, d)
    return s.select("token_id", "timestamp", "buy_price", "sell_price", "midpoint", F.col("best_bid").try_cast("double").alias("best_bid_price"), "best_ask")


@register("p15_second_venue_rows", W([VIEW_SQL["poly"], _EVENTS_SQL, _SNAP_SQL]) + """
SELECT ev.*, y.buy_price AS yes_buy_price, y.sell_price AS yes_sell_price, n.buy_price AS no_buy_price, n.sell_price AS no_sell_price, s.strike_price AS strike_price, 15 AS time_horizon_minutes
FROM ev LEFT JOIN sn y ON y.token_id = ev.yes_token_id LEFT JOIN sn n ON n.token_id = ev.no_token_id
LEFT JOIN (SELECT coin, interval_start_unix, max(strike_price) AS strike_price FROM poly WHERE coin <> 'SOL' GROUP BY ALL) s ON s.coin = ev.coin AND s.interval_start_unix = ev.interval_start_unix""")
def p15_second_venue_rows(spark, d):
    """Assembled rows; one coin has no strikes."""
    p, events = _event_rows(spark, d)
    strikes = p.where("coin <> 'SOL'").groupBy("coin", "interval_start_unix").agg(F.max("strike_price").alias("strike_price"))
    return ps.second_venue_rows(events, _snapshots(spark, d), strikes)


# ---------------------------------------------------------------- X5: batch features against live ones
_SKEW = [("btc_spot_return_vol_30s", "live_vol_30"), ("btc_spot_return_vol_5m", "live_vol_300"),
         ("btc_spot_signed_flow_mean_30s", "live_flow_mean_30"), ("btc_spot_size_mean_30s", "live_size_mean_30")]


@register("x5_skew_report", f"WITH j AS MATERIALIZED (SELECT * FROM {sql_of('q4_spot_features')} a JOIN {sql_of('w12_live_spot_windows')} b USING (trade_time))\n" + "\nUNION ALL ".join(
    f"SELECT '{b}' AS feature, count(*) AS n, CAST(count_if(abs({b} - {v}) > 1e-6) AS BIGINT) AS n_differ, round(max(abs({b} - {v})), 6) AS max_diff, round(avg(abs({b} - {v})), 6) AS mean_diff FROM j"
    for b, v in _SKEW))
def x5_skew_report(spark, d):
    """How far the live engine's spot windows are from the batch features, per feature; one pass."""
    from tidemark.operators import clean
    from tidemark.operators.stats import live_spot_windows
    trades = clean.clean_trades(tv.trades(spark, d), tv.COINS, with_id=False)
    rows = live_spot_windows(feat.spot_features(trades, "BTC", UNIT_US))
    pairs = F.array(*[F.struct(F.lit(b).alias("feature"), F.abs(F.col(b) - F.col(v)).alias("diff")) for b, v in _SKEW])
    x = rows.select(F.explode(pairs).alias("p")).select("p.*")
    return x.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("diff") > 1e-6).alias("n_differ"),
                                    F.round(F.max("diff"), 6).alias("max_diff"), F.round(F.avg("diff"), 6).alias("mean_diff"))


# ---------------------------------------------------------------- X6: autoregressions
def _coin_bars(spark, d):
    from tidemark.operators import clean
    bars = feat.spot_bars(clean.clean_trades(tv.trades(spark, d), tv.COINS, with_id=False), None, UNIT_US)
    return bars.select("coin", F.col("trade_time").alias("bar_time"), F.col("btc_spot_price").alias("x"))


@register("x6_ar1_fits", "WITH " + VIEW_SQL["trades"] + ",\n" + catalog_ts._BARS + f""",
l AS (SELECT *, lag(x) OVER w AS x1, lag(x, {wf.MAX_LAG}) OVER w AS x7, row_number() OVER w - 1 AS i FROM b WINDOW w AS (PARTITION BY coin ORDER BY bar_time)),
f AS (SELECT coin, bar_time, i, regr_slope(x, x1) FILTER (WHERE x7 IS NOT NULL) OVER w AS s, regr_intercept(x, x1) FILTER (WHERE x7 IS NOT NULL) OVER w AS c,
             count(x7) OVER w AS n FROM l WINDOW w AS (PARTITION BY coin ORDER BY bar_time ROWS {wf.FIT_POINTS - 1} PRECEDING))
SELECT coin, bar_time, i, round(s, 6) AS slope, round(c, 3) AS intercept FROM f WHERE n >= {3 * (wf.MAX_LAG + 1)}""")
def x6_ar1_fits(spark, d):
    """AR(1) on the trailing 480 points at every origin, against SQL regression windows."""
    f = wf.forecasts(wf.lag_moments(_coin_bars(spark, d), "coin", "bar_time", "x"), "coin", "bar_time", [1])
    return f.select("coin", "bar_time", "i", F.round(F.get("coefs", 0), 6).alias("slope"), F.round("intercept", 3).alias("intercept"))

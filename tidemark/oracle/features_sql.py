"""DuckDB oracle SQL for the feature tables (Q1–Q7, J1, J2, J4, A2, W-features).

Written independently of the Spark code: native ``ASOF LEFT JOIN``, plain window functions.
"""

from __future__ import annotations

from tidemark.plans.features import QUOTE_FEATURES, SPOT_FEATURES
from tidemark.sources.testviews import UNIT_US, VIEW_SQL

COIN_LIST = "('BTC', 'ETH', 'XRP', 'SOL')"
EV = "PARTITION BY coin, open_time, close_time"

# all_kalshi (F4) and all_trades (F2) as the reference's filtered inputs.
KAL_SQL = f"""kal AS (
  SELECT id, curr_time, coin, open_time, close_time, last_price_dollars, no_ask_dollars, no_bid_dollars,
         yes_ask_dollars, yes_bid_dollars, floor_strike
  FROM quotes
  WHERE coin IN {COIN_LIST}
    AND NOT (open_time = (SELECT min(open_time) FROM quotes) OR close_time = (SELECT max(close_time) FROM quotes)))"""

TR_SQL = f"""tr AS (
  SELECT id, curr_time, product_id, trade_time, price, size, side,
         replace(product_id, '-USD', '') AS coin,
         CASE WHEN side = 'buy' THEN 1 ELSE -1 END AS trade_sign,
         size * CASE WHEN side = 'buy' THEN 1 ELSE -1 END AS signed_size
  FROM trades
  WHERE product_id IN ('BTC-USD', 'ETH-USD', 'XRP-USD', 'SOL-USD')
  QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY curr_time, id) = 1)"""

PREP_SQL = f"""k1 AS (
  SELECT * EXCLUDE (floor_strike),
         (epoch_us(close_time) - epoch_us(curr_time)) // {UNIT_US} AS time_to_close,
         coalesce(last_value(floor_strike IGNORE NULLS) OVER ({EV} ORDER BY curr_time, id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  first_value(floor_strike IGNORE NULLS) OVER ({EV} ORDER BY curr_time, id
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS floor_strike
  FROM kal),
prep AS (
  SELECT * FROM k1
  QUALIFY row_number() OVER ({EV}, time_to_close ORDER BY curr_time, id) = 1),
prepf AS (SELECT * FROM prep WHERE floor_strike IS NOT NULL)"""

FEAT_SQL = f"""g0 AS (
  SELECT *, lag(curr_time) OVER ({EV} ORDER BY curr_time) AS prev_time,
         lead(last_price_dollars) OVER ({EV} ORDER BY curr_time) AS next_price_dollars_lead1
  FROM prepf WHERE time_to_close >= 0),
g1 AS (SELECT * FROM g0 WHERE (epoch_us(curr_time) - epoch_us(prev_time)) // {UNIT_US} BETWEEN 0.9 AND 1.1),
g2 AS (
  SELECT g1.*, s.price,
         (yes_ask_dollars + yes_bid_dollars) / 2 AS yes_mid_dollars,
         yes_ask_dollars - yes_bid_dollars AS yes_spread_dollars,
         s.price - floor_strike AS distance_from_strike
  FROM g1 ASOF LEFT JOIN (SELECT coin, trade_time, price FROM tr) s
    ON g1.coin = s.coin AND g1.curr_time >= s.trade_time),
g3 AS (
  SELECT *,
         coalesce(yes_mid_dollars - lag(yes_mid_dollars, 1) OVER ({EV} ORDER BY curr_time), 0) AS yes_mid_change_1s,
         coalesce(yes_mid_dollars - lag(yes_mid_dollars, 5) OVER ({EV} ORDER BY curr_time), 0) AS yes_mid_change_5s
  FROM g2),
feat AS (
  SELECT *,
         coalesce(CASE WHEN count(yes_mid_change_1s) OVER w30 = 30 THEN stddev_samp(yes_mid_change_1s) OVER w30 END, 0)
           AS yes_mid_change_std_30s,
         coalesce(CASE WHEN count(yes_mid_change_1s) OVER w60 = 60 THEN stddev_samp(yes_mid_change_1s) OVER w60 END, 0)
           AS yes_mid_change_std_60s,
         coalesce(CASE WHEN count(yes_spread_dollars) OVER w30 = 30 THEN avg(yes_spread_dollars) OVER w30 END,
                  yes_spread_dollars) AS yes_spread_mean_30s
  FROM g3
  WINDOW w30 AS ({EV} ORDER BY curr_time ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
         w60 AS ({EV} ORDER BY curr_time ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))"""

BARS_SQL = f"""bars AS (
  SELECT coin, make_timestamp(((epoch_us(trade_time) + {UNIT_US - 1}) // {UNIT_US}) * {UNIT_US}) AS trade_time,
         arg_max(price, (trade_time, id)) AS btc_spot_price,
         sum(size) AS btc_spot_size_1s, sum(signed_size) AS btc_spot_signed_size_1s
  FROM tr WHERE coin = 'BTC' GROUP BY 1, 2),
bret AS (
  SELECT *,
         coalesce(btc_spot_price / lag(btc_spot_price, 1) OVER wb - 1, 0) AS btc_spot_return_1s,
         coalesce(btc_spot_price / lag(btc_spot_price, 5) OVER wb - 1, 0) AS btc_spot_return_5s,
         coalesce(btc_spot_price / lag(btc_spot_price, 15) OVER wb - 1, 0) AS btc_spot_return_15s,
         coalesce(btc_spot_price / lag(btc_spot_price, 60) OVER wb - 1, 0) AS btc_spot_return_60s
  FROM bars WINDOW wb AS (PARTITION BY coin ORDER BY trade_time)),
spot AS (
  SELECT *,
         coalesce(CASE WHEN count(btc_spot_return_1s) OVER w30 = 30 THEN stddev_samp(btc_spot_return_1s) OVER w30 END, 0)
           AS btc_spot_return_vol_30s,
         coalesce(CASE WHEN count(btc_spot_return_1s) OVER w300 = 300 THEN stddev_samp(btc_spot_return_1s) OVER w300 END, 0)
           AS btc_spot_return_vol_5m,
         coalesce(CASE WHEN count(btc_spot_signed_size_1s) OVER w30 = 30 THEN avg(btc_spot_signed_size_1s) OVER w30 END, 0)
           AS btc_spot_signed_flow_mean_30s,
         coalesce(CASE WHEN count(btc_spot_size_1s) OVER w30 = 30 THEN avg(btc_spot_size_1s) OVER w30 END, 0)
           AS btc_spot_size_mean_30s
  FROM bret
  WINDOW w30 AS (PARTITION BY coin ORDER BY trade_time ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
         w300 AS (PARTITION BY coin ORDER BY trade_time ROWS BETWEEN 299 PRECEDING AND CURRENT ROW))"""

BTC_SQL = """btc AS (
  SELECT *, CAST(CASE WHEN last_mid IS NULL THEN NULL ELSE (last_mid > 0.5) END AS INTEGER) AS outcome
  FROM (SELECT *, arg_max_null(yes_mid_dollars, curr_time) OVER (PARTITION BY open_time, close_time) AS last_mid
        FROM feat WHERE coin = 'BTC'))"""


def _ctes(*extra: str) -> str:
    return "WITH " + ",\n".join([VIEW_SQL["quotes"], VIEW_SQL["trades"], KAL_SQL, TR_SQL, PREP_SQL, *extra])


def _r(c: str, nd: int = 9) -> str:
    return f"round({c}, {nd}) AS {c}"


ROUNDED = {"yes_mid_change_std_30s", "yes_mid_change_std_60s", "yes_spread_mean_30s",
           "btc_spot_size_1s", "btc_spot_signed_size_1s", "btc_spot_return_vol_30s", "btc_spot_return_vol_5m",
           "btc_spot_signed_flow_mean_30s", "btc_spot_size_mean_30s"}


def _feat_cols(prefix: str = "") -> list[str]:
    out = []
    for f in QUOTE_FEATURES:
        name = f"{prefix}{f}"
        out.append(f"round({f}, 9) AS {name}" if f in ROUNDED else f"{f} AS {name}")
    return out


def q1_sql() -> str:
    return _ctes() + "\nSELECT id, curr_time, coin, open_time, close_time, time_to_close, floor_strike, " \
        "last_price_dollars, yes_bid_dollars, yes_ask_dollars FROM prepf"


def q2_sql(coin: str = "BTC") -> str:
    cols = ["curr_time", "open_time", "close_time", "prev_time", "time_to_close"] + _feat_cols() + ["next_price_dollars_lead1"]
    return _ctes(FEAT_SQL) + f"\nSELECT {', '.join(cols)} FROM feat WHERE coin = '{coin}'"


def q3_sql() -> str:
    cols = ["row_number() OVER (ORDER BY curr_time) - 1 AS btc_row_id", "curr_time", "open_time", "close_time",
            "prev_time", "time_to_close"] + _feat_cols() + ["next_price_dollars_lead1", "outcome"]
    return _ctes(FEAT_SQL, BTC_SQL) + f"\nSELECT {', '.join(cols)} FROM btc"


def q4_sql() -> str:
    cols = ["trade_time"] + [(f"round({c}, 9) AS {c}" if c in ROUNDED else c) for c in SPOT_FEATURES]
    return _ctes(BARS_SQL) + f"\nSELECT {', '.join(cols)} FROM spot"


def q6_body(others=("ETH", "XRP", "SOL")) -> str:
    ctes = [FEAT_SQL, BTC_SQL, BARS_SQL]
    for c in others:
        cols = ", ".join(f"{f} AS {c}_{f}" for f in QUOTE_FEATURES)
        ctes.append(f"f_{c} AS (SELECT curr_time, {cols} FROM feat WHERE coin = '{c}')")
    joined = "btc"
    sel = ["btc.curr_time", "btc.open_time", "btc.close_time", "btc.prev_time", "btc.time_to_close"]
    sel += [f"btc.{f}" for f in QUOTE_FEATURES] + ["btc.next_price_dollars_lead1", "btc.outcome"]
    for c in others:
        joined += f"\n  ASOF LEFT JOIN f_{c} ON btc.curr_time >= f_{c}.curr_time"
        sel += [f"f_{c}.{c}_{f}" for f in QUOTE_FEATURES]
    joined += "\n  ASOF LEFT JOIN spot ON btc.curr_time >= spot.trade_time"
    sel += ["spot.btc_spot_price"] + [f"coalesce(spot.{c}, 0) AS {c}" for c in SPOT_FEATURES[1:]]
    ctes.append(f"q6 AS (SELECT {', '.join(sel)} FROM {joined})")
    return _ctes(*ctes)


def _q6_select(where: str = "") -> str:
    cols = []
    names = (["curr_time", "open_time", "close_time", "prev_time", "time_to_close"] + QUOTE_FEATURES
             + ["next_price_dollars_lead1", "outcome"]
             + [f"{c}_{f}" for c in ("ETH", "XRP", "SOL") for f in QUOTE_FEATURES] + SPOT_FEATURES)
    for n in names:
        base = n.split("_", 1)[1] if n[:4] in ("ETH_", "XRP_", "SOL_") else n
        cols.append(f"round({n}, 9) AS {n}" if base in ROUNDED else n)
    return f"\nSELECT {', '.join(cols)} FROM q6 {where}"


def q6_sql() -> str:
    return q6_body() + _q6_select()


def q7_sql() -> str:
    from tidemark.plans.features import QUOTE_FEATURES as QF  # noqa: F401
    names = (["curr_time", "open_time", "close_time", "prev_time", "time_to_close"] + QUOTE_FEATURES
             + ["next_price_dollars_lead1", "outcome"]
             + [f"{c}_{f}" for c in ("ETH", "XRP", "SOL") for f in QUOTE_FEATURES] + SPOT_FEATURES)
    return q6_body() + _q6_select("WHERE " + " AND ".join(f"{n} IS NOT NULL" for n in names))

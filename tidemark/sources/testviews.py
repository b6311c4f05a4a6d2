"""Domain views over the shared test tables (FIXTURES.md §3).

Each view is built twice, next to each other: a Spark DataFrame (used by every query) and the
equivalent DuckDB SQL text (a CTE used by the oracle queries). Both read the same parquet files,
and every view's size grows with the tables it reads.

Time is rescaled: one reference "second" is one hour of test-table time (``UNIT_S``) and one
market event lasts five days (``EVENT_S``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNIT_S = 3600                 # one reference second in test time
EVENT_S = 5 * 24 * 3600       # one market event (15 reference minutes) in test time
UNIT_US = UNIT_S * 1_000_000
EVENT_US = EVENT_S * 1_000_000

# The test event_type -> coin mapping of FIXTURES.md §3.
COIN_OF_EVENT_TYPE = {"click": "BTC", "view": "ETH", "purchase": "XRP", "signup": "SOL", "error": "DOGE"}
COINS = ("BTC", "ETH", "XRP", "SOL")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _coin_case(col: str = "event_type") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COIN_OF_EVENT_TYPE.items())
    return f"CASE {col} {whens} END"


def _events(spark, d):
    return (table(spark, d, "events")
            .selectExpr("event_id", "CAST(ts AS TIMESTAMP) AS ts", "user_id", "event_type", "value",
                        "try_cast(get_json_object(props, '$.k') AS INT) AS k",
                        f"{_coin_case()} AS coin"))


# --------------------------------------------------------------------------- spot trades
def trades(spark: SparkSession, d: str) -> DataFrame:
    """coinbase_trades: one executed spot trade per event row."""
    return _events(spark, d).selectExpr(
        "event_id AS id", "ts AS curr_time", "concat(coin, '-USD') AS product_id",
        "'match' AS event_type", "ts AS trade_time",
        "event_id - CASE WHEN event_id % 50 = 49 THEN 1 ELSE 0 END AS trade_id",
        "event_id AS sequence", "100 + value AS price", "(k + 1) / 10 AS size",
        "CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side",
        "concat('m', user_id) AS maker_order_id", "concat('t', event_id) AS taker_order_id")


TRADES_SQL = f"""trades AS (
  SELECT event_id AS id, ts AS curr_time, concat({_coin_case()}, '-USD') AS product_id,
         'match' AS event_type, ts AS trade_time,
         event_id - CASE WHEN event_id % 50 = 49 THEN 1 ELSE 0 END AS trade_id,
         event_id AS sequence, 100 + value AS price,
         (CAST(json_extract_string(props, '$.k') AS INTEGER) + 1) / 10 AS size,
         CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         concat('m', user_id) AS maker_order_id, concat('t', event_id) AS taker_order_id
  FROM events)"""


# --------------------------------------------------------------------------- contract quotes
def quotes(spark: SparkSession, d: str) -> DataFrame:
    """kalshi_markets: one contract quote per event row; five-day events."""
    ev = _events(spark, d).withColumn(
        "curr_time", F.expr("ts + make_dt_interval(0, 0, CAST(event_id % 3 * 20 AS INT), 0)"))
    ev = ev.withColumn("bucket", F.expr(f"unix_micros(curr_time) div {EVENT_US}"))
    return ev.selectExpr(
        "event_id AS id", "curr_time", "coin",
        f"timestamp_micros(bucket * {EVENT_US}) AS open_time",
        f"timestamp_micros((bucket + 1) * {EVENT_US}) AS close_time",
        "(5 + (event_id * 37 + k) % 85) / 100 AS last_price_dollars",
        "value * 100 AS liquidity_dollars",
        "1 - ((5 + (event_id * 37 + k) % 85) / 100 + (1 + user_id % 5) / 100) AS no_bid_dollars",
        "1 - (5 + (event_id * 37 + k) % 85) / 100 AS no_ask_dollars",
        "(5 + (event_id * 37 + k) % 85) / 100 + (1 + user_id % 5) / 100 AS yes_ask_dollars",
        "(5 + (event_id * 37 + k) % 85) / 100 AS yes_bid_dollars",
        "CAST(k * 10 AS DOUBLE) AS open_interest",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(100 + 10 * (bucket % 3) AS DOUBLE) END AS floor_strike",
        "CAST(NULL AS DOUBLE) AS cap_strike", "'greater' AS strike_type",
        "CAST(event_id % 1000 AS DOUBLE) AS volume", "value * 10 AS volume_24h_fp")


QUOTES_SQL = f"""quotes AS (
  SELECT event_id AS id, curr_time, coin,
         make_timestamp(bucket * {EVENT_US}) AS open_time,
         make_timestamp((bucket + 1) * {EVENT_US}) AS close_time,
         (5 + (event_id * 37 + k) % 85) / 100 AS last_price_dollars,
         value * 100 AS liquidity_dollars,
         1 - ((5 + (event_id * 37 + k) % 85) / 100 + (1 + user_id % 5) / 100) AS no_bid_dollars,
         1 - (5 + (event_id * 37 + k) % 85) / 100 AS no_ask_dollars,
         (5 + (event_id * 37 + k) % 85) / 100 + (1 + user_id % 5) / 100 AS yes_ask_dollars,
         (5 + (event_id * 37 + k) % 85) / 100 AS yes_bid_dollars,
         CAST(k * 10 AS DOUBLE) AS open_interest,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(100 + 10 * (bucket % 3) AS DOUBLE) END AS floor_strike,
         CAST(NULL AS DOUBLE) AS cap_strike, 'greater' AS strike_type,
         CAST(event_id % 1000 AS DOUBLE) AS volume, value * 10 AS volume_24h_fp
  FROM (SELECT *, epoch_us(curr_time) // {EVENT_US} AS bucket
        FROM (SELECT event_id, user_id, value, {_coin_case()} AS coin,
                     CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                     ts + to_minutes(CAST(event_id % 3 * 20 AS BIGINT)) AS curr_time
              FROM events)))"""


# --------------------------------------------------------------------------- second venue
def poly(spark: SparkSession, d: str) -> DataFrame:
    """polymarket_markets: second-venue quotes; volume is not monotone on purpose."""
    ev = _events(spark, d).withColumn("ivl", F.expr(f"unix_seconds(ts) div {EVENT_S}"))
    return ev.selectExpr(
        "event_id AS id", "ts AS curr_time", "coin", "15 AS time_horizon_minutes",
        f"ivl * {EVENT_S} AS interval_start_unix",
        "concat(lower(coin), '-updown-', ivl) AS market_slug", "concat('0x', ivl) AS condition_id",
        "CAST(100 + 10 * (ivl % 3) AS DOUBLE) AS strike_price",
        f"timestamp_seconds((ivl + 1) * {EVENT_S}) AS end_date",
        "value * 100 AS liquidity", "CAST((event_id * 13) % 5000 AS DOUBLE) AS volume",
        "CAST(k AS DOUBLE) AS open_interest",
        "(5 + (event_id * 41 + k) % 85) / 100 + (1 + user_id % 4) / 200 AS yes_implied_price",
        "1 - ((5 + (event_id * 41 + k) % 85) / 100 + (1 + user_id % 4) / 200) AS no_implied_price",
        "(5 + (event_id * 41 + k) % 85) / 100 + (1 + user_id % 4) / 100 AS yes_buy_price",
        "(5 + (event_id * 41 + k) % 85) / 100 AS yes_sell_price",
        "1 - (5 + (event_id * 41 + k) % 85) / 100 AS no_buy_price",
        "1 - ((5 + (event_id * 41 + k) % 85) / 100 + (1 + user_id % 4) / 100) AS no_sell_price")


POLY_SQL = f"""poly AS (
  SELECT event_id AS id, ts AS curr_time, coin, 15 AS time_horizon_minutes,
         ivl * {EVENT_S} AS interval_start_unix,
         concat(lower(coin), '-updown-', ivl) AS market_slug, concat('0x', ivl) AS condition_id,
         CAST(100 + 10 * (ivl % 3) AS DOUBLE) AS strike_price,
         make_timestamp((ivl + 1) * {EVENT_US}) AS end_date,
         value * 100 AS liquidity, CAST((event_id * 13) % 5000 AS DOUBLE) AS volume,
         CAST(k AS DOUBLE) AS open_interest,
         (5 + (event_id * 41 + k) % 85) / 100 + (1 + user_id % 4) / 200 AS yes_implied_price,
         1 - ((5 + (event_id * 41 + k) % 85) / 100 + (1 + user_id % 4) / 200) AS no_implied_price,
         (5 + (event_id * 41 + k) % 85) / 100 + (1 + user_id % 4) / 100 AS yes_buy_price,
         (5 + (event_id * 41 + k) % 85) / 100 AS yes_sell_price,
         1 - (5 + (event_id * 41 + k) % 85) / 100 AS no_buy_price,
         1 - ((5 + (event_id * 41 + k) % 85) / 100 + (1 + user_id % 4) / 100) AS no_sell_price
  FROM (SELECT event_id, ts, user_id, value, {_coin_case()} AS coin,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               epoch_us(ts) // {EVENT_US} AS ivl
        FROM events))"""


# --------------------------------------------------------------------------- fills
def fills(spark: SparkSession, d: str) -> DataFrame:
    """Fill ledger: one fill per lineitem row, ordered by (time, order_key, line_no, ticker, supp)."""
    return table(spark, d, "lineitem").selectExpr(
        "CAST(l_shipdate AS TIMESTAMP) AS time", "l_orderkey AS order_key",
        "CAST(l_linenumber AS BIGINT) AS line_no", "l_partkey AS ticker", "l_suppkey AS portfolio",
        "CASE WHEN l_linestatus = 'O' THEN 'yes' ELSE 'no' END AS side",
        "CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS action",
        "(5 + floor(l_extendedprice) % 90) / 100 AS price", "l_quantity AS contracts")


FILLS_SQL = """fills AS (
  SELECT l_shipdate AS time, l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_no,
         l_partkey AS ticker, l_suppkey AS portfolio,
         CASE WHEN l_linestatus = 'O' THEN 'yes' ELSE 'no' END AS side,
         CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS action,
         (5 + CAST(floor(l_extendedprice) AS BIGINT) % 90) / 100 AS price, l_quantity AS contracts
  FROM lineitem)"""

# Total order of fills (ties broken down to a unique 5-tuple).
FILL_ORDER = ("time", "order_key", "line_no", "ticker", "portfolio")


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Settlement result per contract."""
    return table(spark, d, "part").selectExpr(
        "p_partkey AS ticker", "CASE WHEN p_size % 2 = 0 THEN 'yes' ELSE 'no' END AS result")


OUTCOMES_SQL = """outcomes AS (
  SELECT p_partkey AS ticker, CASE WHEN p_size % 2 = 0 THEN 'yes' ELSE 'no' END AS result FROM part)"""


# --------------------------------------------------------------------------- book levels
#: Rows that a task of the order-book walks holds, about.
BOOK_ROWS = 100_000


def book(spark: SparkSession, d: str) -> DataFrame:
    """Order-book levels (snapshot_id, side, price, size): resting bids per side. The rows are dealt out by snapshot
    once, in parts of about ``BOOK_ROWS``; grouping, walks and joins by snapshot stay within them, so a task's
    memory does not grow with the table."""
    lines = table(spark, d, "lineitem").selectExpr(
        "l_orderkey AS snapshot_id",
        "CASE WHEN l_linestatus = 'O' THEN 'yes' ELSE 'no' END AS side",
        "(1 + floor(l_extendedprice) % 48) / 100 AS price", "l_quantity")
    return (lines.repartition(max(1, -(-lines.count() // BOOK_ROWS)), "snapshot_id")
        .groupBy("snapshot_id", "side", "price").agg(F.sum("l_quantity").alias("size")))


BOOK_SQL = """book AS (
  SELECT l_orderkey AS snapshot_id, CASE WHEN l_linestatus = 'O' THEN 'yes' ELSE 'no' END AS side,
         (1 + CAST(floor(l_extendedprice) AS BIGINT) % 48) / 100 AS price, sum(l_quantity) AS size
  FROM lineitem GROUP BY ALL)"""


# --------------------------------------------------------------------------- scored ticks
def ticks(spark: SparkSession, d: str) -> DataFrame:
    """Scored ticks: model probability, its std, market mid and asks, realised outcome."""
    return table(spark, d, "lineitem").selectExpr(
        "l_orderkey AS order_key", "CAST(l_linenumber AS BIGINT) AS line_no", "l_partkey AS ticker",
        "l_suppkey AS supp", "CAST(l_shipdate AS TIMESTAMP) AS time",
        "(1 + (l_orderkey * 7919 + l_partkey * 104729) % 9999) / 10000 AS p_hat",
        "(l_suppkey % 50) / 100 AS p_std",
        "(1 + (l_partkey * 31 + l_orderkey) % 98) / 100 AS mid",
        "(1 + (l_partkey * 31 + l_orderkey) % 98) / 100 + 0.01D AS yes_ask",
        "1 - (1 + (l_partkey * 31 + l_orderkey) % 98) / 100 + 0.01D AS no_ask",
        "CAST((l_linenumber + l_partkey) % 2 AS BIGINT) AS y",
        "l_orderkey % 301 AS time_to_close")


TICKS_SQL = """ticks AS (
  SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS ticker,
         l_suppkey AS supp, l_shipdate AS time,
         (1 + (l_orderkey * 7919 + l_partkey * 104729) % 9999) / 10000 AS p_hat,
         (l_suppkey % 50) / 100 AS p_std,
         (1 + (l_partkey * 31 + l_orderkey) % 98) / 100 AS mid,
         (1 + (l_partkey * 31 + l_orderkey) % 98) / 100 + CAST(0.01 AS DOUBLE) AS yes_ask,
         1 - (1 + (l_partkey * 31 + l_orderkey) % 98) / 100 + CAST(0.01 AS DOUBLE) AS no_ask,
         CAST((l_linenumber + l_partkey) % 2 AS BIGINT) AS y,
         l_orderkey % 301 AS time_to_close
  FROM lineitem)"""


# --------------------------------------------------------------------------- classifier rows
def classifier(spark: SparkSession, d: str) -> DataFrame:
    """Model-training rows: 64 features as array<double>, binary label, group for splits."""
    return table(spark, d, "embeddings").selectExpr(
        "vec_id AS row_id", "transform(embedding, x -> CAST(x AS DOUBLE)) AS features",
        "CAST(label < 5 AS INT) AS y", "vec_id div 10 AS grp")


CLASSIFIER_SQL = """clf AS (
  SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS features,
         CAST(label < 5 AS INTEGER) AS y, vec_id // 10 AS grp
  FROM embeddings)"""


# --------------------------------------------------------------------------- options
def options(spark: SparkSession, d: str) -> DataFrame:
    """Option instrument rows, one per part: symbol text is parsed by P10/P11."""
    month = "CASE p_size % 3 WHEN 0 THEN 'JAN' WHEN 1 THEN 'MAR' ELSE 'JUN' END"
    return table(spark, d, "part").selectExpr(
        "p_partkey AS id",
        "CASE WHEN p_partkey % 2 = 0 THEN 'BTC' ELSE 'ETH' END AS currency",
        f"concat(CASE WHEN p_partkey % 2 = 0 THEN 'BTC' ELSE 'ETH' END, '-', 1 + p_partkey % 28, {month},"
        " '26-', 50000 + 100 * (p_partkey % 400), '-',"
        " CASE WHEN (p_partkey div 28) % 2 = 0 THEN 'C' ELSE 'P' END) AS instrument_name",
        "CASE WHEN (p_partkey div 28) % 2 = 0 THEN 1 ELSE -1 END * ((7 * p_partkey) % 100) / 100 AS delta",
        "CAST(70000 AS DOUBLE) AS underlying_price",
        "p_retailprice / 1000 AS mark_iv", "p_retailprice / 100000 AS mark_price",
        "CAST(p_size AS DOUBLE) AS open_interest")


OPTIONS_SQL = """options AS (
  SELECT p_partkey AS id,
         CASE WHEN p_partkey % 2 = 0 THEN 'BTC' ELSE 'ETH' END AS currency,
         concat(CASE WHEN p_partkey % 2 = 0 THEN 'BTC' ELSE 'ETH' END, '-', 1 + p_partkey % 28,
                CASE p_size % 3 WHEN 0 THEN 'JAN' WHEN 1 THEN 'MAR' ELSE 'JUN' END,
                '26-', 50000 + 100 * (p_partkey % 400), '-',
                CASE WHEN (p_partkey // 28) % 2 = 0 THEN 'C' ELSE 'P' END) AS instrument_name,
         CASE WHEN (p_partkey // 28) % 2 = 0 THEN 1 ELSE -1 END * ((7 * p_partkey) % 100) / 100 AS delta,
         CAST(70000 AS DOUBLE) AS underlying_price,
         p_retailprice / 1000 AS mark_iv, p_retailprice / 100000 AS mark_price,
         CAST(p_size AS DOUBLE) AS open_interest
  FROM part)"""


VIEW_SQL = {
    "trades": TRADES_SQL, "quotes": QUOTES_SQL, "poly": POLY_SQL, "fills": FILLS_SQL,
    "outcomes": OUTCOMES_SQL, "book": BOOK_SQL, "ticks": TICKS_SQL, "clf": CLASSIFIER_SQL,
    "options": OPTIONS_SQL,
}


def with_views(sql_body: str, *names: str, extra: str = "") -> str:
    """Prefix an oracle query with the CTEs it needs: ``WITH v1 AS (...), ... <extra> <body>``."""
    ctes = [VIEW_SQL[n] for n in names]
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + sql_body if ctes else sql_body

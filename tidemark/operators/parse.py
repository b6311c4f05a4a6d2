"""Parsing jobs: raw JSON / strings -> typed rows (P1–P19), option selection.

All parsing is column expressions (``from_json`` with explicit schemas, ``try_cast``), so a
malformed message becomes nulls in its own row, never a failed task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Field names of the landed messages. Numbers come as text or as numbers; every one is read
# as text and cast safely (P4), so a bad value is a null of its own.
TRADE_MSG = "type string, trade_id long, maker_order_id string, taker_order_id string, product_id string, price string, " \
            "size string, side string, sequence long, time string, arrival long"
TICKER_MSG = "type string, product_id string, sequence long, time string, price string, best_bid string, best_ask string, " \
             "best_bid_size string, best_ask_size string, last_size string, side string"
BOOK_MSG = "market_ticker string, market_id string, ts_ms string, yes_dollars_fp array<string>, no_dollars_fp array<string>"
DELTA_MSG = "market_ticker string, market_id string, ts_ms string, price_dollars string, delta_fp string, side string"
KTRADE_MSG = "trade_id string, market_ticker string, ts_ms string, yes_price_dollars string, no_price_dollars string, " \
             "count_fp string, taker_outcome_side string, taker_side string, taker_book_side string"
ORDER_FIELDS = ["fill_count_fp", "remaining_count_fp", "taker_fill_cost_dollars", "maker_fill_cost_dollars",
                "taker_fees_dollars", "maker_fees_dollars", "status", "order_id"]
_ORDER = ", ".join(f"{f} string" for f in ORDER_FIELDS)
ORDER_MSG = f"order struct<{_ORDER.replace(' string', ': string')}>, {_ORDER}"


def route(raw: DataFrame) -> DataFrame:
    """Message type of each raw text; malformed JSON -> 'malformed'."""
    t = F.get_json_object("raw", "$.type")
    return raw.select("*", F.coalesce(t, F.lit("malformed")).alias("msg_type"))


def safe_double(c):
    """Text -> double, bad text -> null."""
    return F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


def safe_int_via_float(c: str):
    """The contract feed's int cast goes through float ('3.0' -> 3, truncating)."""
    return F.expr(f"CAST(try_cast({c} AS DOUBLE) AS BIGINT)")


def parse_trades(raw: DataFrame) -> DataFrame:
    """Spot trade rows from 'match' messages; price / size safe-cast."""
    m = F.from_json("raw", TRADE_MSG)
    x = raw.select(m.alias("m")).where(F.col("m.type") == "match").select("m.*")
    return x.select("trade_id", F.col("type").alias("event_type"), "product_id", safe_double("price").alias("price"),
                    safe_double("size").alias("size"), "side", "sequence", F.expr("try_cast(time AS TIMESTAMP)").alias("time"),
                    "maker_order_id", "taker_order_id")


def parse_tickers(raw: DataFrame) -> DataFrame:
    """Spot quote rows from 'ticker' messages."""
    m = F.from_json("raw", TICKER_MSG)
    x = raw.select(m.alias("m")).where(F.col("m.type") == "ticker").select("m.*")
    numbers = ["price", "best_bid", "best_ask", "best_bid_size", "best_ask_size", "last_size"]
    return x.select("product_id", "sequence", F.expr("try_cast(time AS TIMESTAMP)").alias("time"),
                    *[safe_double(c).alias(c) for c in numbers], "side")


def explode_book(raw: DataFrame) -> DataFrame:
    """One row per (message, side, level). Levels are [price, size, ...] of texts or numbers; a level
    that is shorter, or whose price or size cannot be read, is dropped, and only that level."""
    m = raw.select(F.from_json("raw", BOOK_MSG).alias("m")).select("m.*")
    sides = []
    for side, key in (("yes", "yes_dollars_fp"), ("no", "no_dollars_fp")):
        sides.append(m.select("market_ticker", "market_id", "ts_ms", F.lit(side).alias("side"), F.posexplode(key).alias("level", "_lv")))
    x = sides[0].unionByName(sides[1]).withColumn("_lv", F.from_json("_lv", "array<string>"))
    x = x.select(F.col("market_ticker").alias("ticker"), "market_id", safe_int_via_float("ts_ms").alias("ts_ms"),
                 F.lit("snapshot").alias("event_type"), "side", F.col("level").cast("long").alias("level"),
                 F.get("_lv", 0).try_cast("double").alias("price"), F.get("_lv", 1).try_cast("double").alias("delta_size"))
    return x.where(F.col("price").isNotNull() & F.col("delta_size").isNotNull())


def parse_deltas(raw: DataFrame) -> DataFrame:
    """Delta rows; reject when ticker, price or delta is null or unreadable, or side is not yes/no."""
    m = raw.select(F.from_json("raw", DELTA_MSG).alias("m")).select("m.*")
    x = m.select(F.col("market_ticker").alias("ticker"), "market_id", safe_int_via_float("ts_ms").alias("ts_ms"),
                 F.lit("delta").alias("event_type"), "side", safe_double("price_dollars").alias("price"), safe_double("delta_fp").alias("delta_size"))
    return x.where(F.col("ticker").isNotNull() & F.col("price").isNotNull() & F.col("delta_size").isNotNull() & F.col("side").isin("yes", "no"))


def parse_contract_trades(raw: DataFrame) -> DataFrame:
    """Contract trades; reject empty trade_id / ticker; the taker's outcome side falls back to the taker
    side when null or empty; prices and the (fractional) count are cast safely."""
    m = raw.select(F.from_json("raw", KTRADE_MSG).alias("m")).select("m.*")
    m = m.where((F.coalesce(F.col("trade_id"), F.lit("")) != "") & (F.coalesce(F.col("market_ticker"), F.lit("")) != ""))
    return m.select("trade_id", F.col("market_ticker").alias("ticker"), safe_int_via_float("ts_ms").alias("ts_ms"),
                    safe_double("yes_price_dollars").alias("yes_price"), safe_double("no_price_dollars").alias("no_price"),
                    safe_double("count_fp").alias("count"),
                    F.coalesce(F.nullif(F.col("taker_outcome_side"), F.lit("")), F.col("taker_side")).alias("taker_outcome_side"),
                    "taker_book_side")


def enrich_coin(df: DataFrame, dim: DataFrame, key: str = "ticker") -> DataFrame:
    """Ticker -> coin from a dimension table; unknown -> ''. The dimension is small (one row
    per listed market), so AQE turns this into a broadcast join when its runtime size allows."""
    return df.join(dim, key, "left").withColumn("coin", F.coalesce(F.col("coin"), F.lit("")))


def parse_option_symbol(df: DataFrame, col: str = "instrument_name") -> DataFrame:
    """P10 + P11: 'BTC-25DEC26-100000-C' -> currency, expiry text, expiry date, strike, type.
    Fewer than 4 parts or a non-numeric strike -> null fields; bad expiry -> null date."""
    p = F.split(F.col(col), "-")
    ok = F.size(p) >= 4
    return df.select("*",
                     F.when(ok, p[0]).alias("sym_currency"), F.when(ok, p[1]).alias("expiry"),
                     F.when(ok, F.expr(f"try_cast(split({col}, '-')[2] AS DOUBLE)")).alias("strike"),
                     F.when(ok, p[3]).alias("option_type"),
                     F.when(ok, F.expr(f"CAST(try_to_date(split({col}, '-')[1], 'dMMMyy') AS TIMESTAMP)")).alias("expiry_date"))


def nearest_expiry(opts: DataFrame) -> DataFrame:
    """Options of each currency's nearest expiry date. A minimum per currency (map-side) is joined back."""
    known = opts.where(F.col("expiry_date").isNotNull())
    first = known.groupBy(F.col("currency").alias("_c")).agg(F.min("expiry_date").alias("_first"))
    return known.join(first, (F.col("currency") == F.col("_c")) & (F.col("expiry_date") == F.col("_first"))).drop("_c", "_first")


def nearest(rows: DataFrame, by: Sequence[str], order: Sequence[str], n: int, buckets: int = 64) -> DataFrame:
    """The first ``n`` rows of each ``by`` in ``order``: first of hash buckets of the group, then of what the
    buckets keep, so that a group is never sorted in one task."""
    rows = rows.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    rows = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*order))).where(F.col("_rn") <= n)
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rn") <= n).drop("_b", "_rn")


def near_spot(opts: DataFrame, per_side: int = 12) -> DataFrame:
    """The ``per_side`` calls and puts with strikes nearest the spot (first non-null underlying)."""
    spot = (opts.where(F.col("underlying_price").isNotNull()).groupBy(F.col("currency").alias("_c"))
            .agg(F.min_by("underlying_price", "id").alias("_spot")))
    o = opts.where(F.col("option_type").isin("C", "P")).join(spot, F.col("currency") == F.col("_c"), "left")
    o = o.withColumn("distance_to_spot", F.abs(F.col("strike") - F.col("_spot")))
    return nearest(o, ["currency", "option_type"], ["distance_to_spot", "id"], per_side).select("currency", "instrument_name", "distance_to_spot").distinct()


def delta_selection(opts: DataFrame) -> DataFrame:
    """T4: 25-delta call in [.10, .40], ATM call in [.40, .60], 25-delta put in [-.40, -.10],
    each nearest its target delta (first in input order on ties); distinct."""
    rules = [("C", 0.10, 0.40, 0.25), ("C", 0.40, 0.60, 0.5), ("P", -0.40, -0.10, -0.25)]
    parts = [opts.where((F.col("option_type") == typ) & F.col("delta").between(lo, hi)).groupBy("currency").agg(
        F.min_by(F.struct("instrument_name", "delta"), F.struct(F.abs(F.col("delta") - F.lit(target)), F.col("id"))).alias("best"))
        for typ, lo, hi, target in rules]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("currency", "best.instrument_name", "best.delta").distinct()


def interval_strike(trades: DataFrame, interval_s: int) -> DataFrame:
    """P16 + P17: interval start = floor(t / len) * len; strike = first trade price of the interval."""
    start = (F.floor(F.unix_seconds("trade_time") / interval_s) * interval_s).cast("long")
    return trades.groupBy("coin", start.alias("interval_start_unix")).agg(
        F.min_by("price", F.struct("trade_time", "id")).alias("strike_price"))


def parse_order_response(raw: DataFrame) -> DataFrame:
    """Filled and remaining contracts (whole), average fill price and fee per contract over taker and
    maker parts, status and order id; the ``order`` envelope is optional, absent fields are zero."""
    m = raw.select("id", F.from_json("raw", ORDER_MSG).alias("m"))
    x = m.select("id", *[F.when(F.col("m.order").isNotNull(), F.col(f"m.order.{n}")).otherwise(F.col(f"m.{n}")).alias(n) for n in ORDER_FIELDS])
    whole = [F.coalesce(safe_int_via_float(n), F.lit(0)).alias(n) for n in ORDER_FIELDS[:2]]
    money = [F.coalesce(safe_double(n), F.lit(0.0)).alias(n) for n in ORDER_FIELDS[2:6]]
    x = x.select("id", *whole, *money, "status", "order_id")
    filled = F.when(F.col("fill_count_fp") > 0, F.col("fill_count_fp"))
    return x.select("id", F.col("fill_count_fp").alias("filled"), F.col("remaining_count_fp").alias("remaining"),
                    F.coalesce((F.col("taker_fill_cost_dollars") + F.col("maker_fill_cost_dollars")) / filled, F.lit(0.0)).alias("avg_price"),
                    F.coalesce((F.col("taker_fees_dollars") + F.col("maker_fees_dollars")) / filled, F.lit(0.0)).alias("fee_per_contract"),
                    F.coalesce("status", F.lit("unknown")).alias("status"), F.coalesce("order_id", F.lit("")).alias("order_id"))


def parse_timestamp(c: str):
    """Non-strict timestamp parse of both layouts (' ' or 'T', 'Z' or '+00:00'); bad -> null."""
    return F.expr(f"try_cast({c} AS TIMESTAMP)")


# Fields of a contract snapshot, of an option summary, and of the second venue's messages.
SNAPSHOT_TIMES = ["open_time", "close_time"]
SNAPSHOT_NUMBERS = ["last_price_dollars", "liquidity_dollars", "no_ask_dollars", "no_bid_dollars", "yes_ask_dollars", "yes_bid_dollars",
                    "open_interest", "floor_strike", "cap_strike", "volume", "volume_24h_fp"]
SNAPSHOT_MSG = ", ".join(f"{f} string" for f in [*SNAPSHOT_TIMES, *SNAPSHOT_NUMBERS, "strike_type"])
OPTION_NUMBERS = ["underlying_price", "mark_iv", "bid_price", "ask_price", "mark_price", "open_interest"]
OPTION_MSG = "instrument_name string, " + ", ".join(f"{f} string" for f in OPTION_NUMBERS) + ", greeks struct<delta: string>, stats struct<volume: string>"
EVENT_MSG = "endDate string, markets array<struct<slug: string, conditionId: string, liquidity: string, volume: string, " \
            "openInterest: string, outcomePrices: string, clobTokenIds: string>>"
CLOB_BOOK_MSG = "timestamp string, bids array<string>, asks array<string>"


def parse_snapshots(raw: DataFrame) -> DataFrame:
    """P5: contract snapshots (``raw`` beside other columns) -> 14 named fields; absent or unreadable ones are null."""
    others = [c for c in raw.columns if c != "raw"]
    m = raw.select(*others, F.from_json("raw", SNAPSHOT_MSG).alias("m"))
    return m.select(*others, *[F.col(f"m.{c}").try_cast("timestamp").alias(c) for c in SNAPSHOT_TIMES],
                    *[F.col(f"m.{c}").try_cast("double").alias(c) for c in SNAPSHOT_NUMBERS], F.col("m.strike_type").alias("strike_type"))


def parse_option_summaries(raw: DataFrame) -> DataFrame:
    """Option summaries -> option rows; expiry, strike and type come from the symbol (P10, P11), delta and
    volume from the nested greeks and stats, which may be missing."""
    others = [c for c in raw.columns if c != "raw"]
    m = raw.select(*others, F.from_json("raw", OPTION_MSG).alias("m")).select(*others, "m.*")
    p = parse_option_symbol(m).drop("sym_currency", "expiry")
    return p.select(*others, "instrument_name", F.col("expiry_date").alias("expiry_datetime"), "strike", "option_type",
                    *[F.col(c).try_cast("double").alias(c) for c in OPTION_NUMBERS],
                    F.col("greeks.delta").try_cast("double").alias("delta"), F.col("stats.volume").try_cast("double").alias("volume"))


def parse_events(raw: DataFrame) -> DataFrame:
    """Event messages -> their first market; prices and token ids are JSON arrays inside strings, yes first,
    no second. Events without a market are dropped."""
    others = [c for c in raw.columns if c != "raw"]
    m = raw.select(*others, F.from_json("raw", EVENT_MSG).alias("m"))
    m = m.select(*others, F.col("m.endDate").alias("_end"), F.get("m.markets", 0).alias("k")).where(F.col("k").isNotNull())
    prices, tokens = F.from_json("k.outcomePrices", "array<string>"), F.from_json("k.clobTokenIds", "array<string>")
    return m.select(*others, F.col("_end").try_cast("timestamp").alias("end_date"), F.col("k.slug").alias("market_slug"), F.col("k.conditionId").alias("condition_id"),
                    *[F.col(f"k.{c}").try_cast("double").alias(n) for c, n in (("liquidity", "liquidity"), ("volume", "volume"), ("openInterest", "open_interest"))],
                    F.get(prices, 0).try_cast("double").alias("yes_implied_price"), F.get(prices, 1).try_cast("double").alias("no_implied_price"),
                    F.get(tokens, 0).alias("yes_token_id"), F.get(tokens, 1).alias("no_token_id"))


def clob_snapshots(books: DataFrame, buys: DataFrame, sells: DataFrame, midpoints: DataFrame) -> DataFrame:
    """The four answers for a token (``token_id``, ``raw``) side by side: first bid and ask as they came, buy
    and sell price, and the midpoint under either of its names. One grouping by token, not three joins."""
    def tagged(df: DataFrame, kind: str) -> DataFrame:
        return df.select("token_id", F.lit(kind).alias("kind"), "raw")

    def first(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col("raw")))

    x = tagged(books, "book").unionByName(tagged(buys, "buy")).unionByName(tagged(sells, "sell")).unionByName(tagged(midpoints, "mid"))
    x = x.groupBy("token_id").agg(first("book").alias("book"), first("buy").alias("buy"), first("sell").alias("sell"), first("mid").alias("mid"))
    b = F.from_json("book", CLOB_BOOK_MSG)
    mid = F.coalesce(F.nullif(F.get_json_object("mid", "$.mid"), F.lit("")), F.get_json_object("mid", "$.mid_price"))
    return x.select("token_id", b["timestamp"].alias("timestamp"), F.get(b["bids"], 0).alias("best_bid"), F.get(b["asks"], 0).alias("best_ask"),
                    F.get_json_object("buy", "$.price").try_cast("double").alias("buy_price"), F.get_json_object("sell", "$.price").try_cast("double").alias("sell_price"),
                    mid.try_cast("double").alias("midpoint"))


def second_venue_rows(events: DataFrame, snapshots: DataFrame, strikes: DataFrame, horizon_minutes: int = 15) -> DataFrame:
    """Event rows (P13, with ``coin`` and ``interval_start_unix``) with both tokens' snapshots (P14) and the
    interval's strike (P17); whatever is missing is null."""
    def side(name: str) -> DataFrame:
        return snapshots.select(F.col("token_id").alias(f"{name}_token_id"), F.col("buy_price").alias(f"{name}_buy_price"), F.col("sell_price").alias(f"{name}_sell_price"))
    x = events.join(side("yes"), "yes_token_id", "left").join(side("no"), "no_token_id", "left").join(strikes, ["coin", "interval_start_unix"], "left")
    return x.withColumn("time_horizon_minutes", F.lit(horizon_minutes))

"""Streaming queries (R*): each lands messages derived from the test tables, runs the stream to
completion with ``availableNow`` and returns the sink's table; checked against batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.catalog_parse import RAW_SPOT_SQL, raw_spot_messages
from tidemark.operators.ordering import dense_index
from tidemark.registry import register
from tidemark.sources import testviews as tv
from tidemark.sources.testviews import COINS, UNIT_US, VIEW_SQL
from tidemark.streaming import jobs, live


def W(parts):
    return "WITH " + ",\n".join(parts)


_TRADES_SQL = W([VIEW_SQL["trades"], RAW_SPOT_SQL, """pt AS (
  SELECT CAST(json_extract(raw, '$.trade_id') AS BIGINT) AS trade_id, json_extract_string(raw, '$.product_id') AS product_id,
         TRY_CAST(json_extract_string(raw, '$.price') AS DOUBLE) AS price, TRY_CAST(json_extract_string(raw, '$.size') AS DOUBLE) AS size,
         json_extract_string(raw, '$.side') AS side, CAST(json_extract(raw, '$.sequence') AS BIGINT) AS sequence,
         TRY_CAST(replace(json_extract_string(raw, '$.time'), 'Z', '') AS TIMESTAMP) AS trade_time,
         CAST(json_extract(raw, '$.arrival') AS BIGINT) AS arrival
  FROM raw WHERE json_valid(raw) AND json_extract_string(raw, '$.type') = 'match')"""])

_TRADE_SCHEMA = "trade_id long, product_id string, price double, size double, side string, sequence long, trade_time timestamp, arrival long"


#: Rows of a landed file, which is a micro-batch; more rows in tables that would make very many.
ROWS_PER_FILE = 2_500


def _landed(spark, d, name):
    """Messages in order of arrival, in files that the jobs read one per micro-batch, and their number."""
    messages = raw_spot_messages(spark, d)
    n = messages.count()
    return jobs.land_in_order(messages, jobs.new_dir(spark, f"{name}-src"), "id", jobs.batches_for(n, ROWS_PER_FILE)), n


WATERMARK = "400 days"  # arrival order is not time order in the test tables


def _run(spark, d, name, job=lambda trades: trades, mode="append"):
    """Run ``job`` on the typed trades of the landed messages; the folder of its batches."""
    src, rows = _landed(spark, d, name)
    return jobs.run_available_now(job(jobs.typed_trade_stream(spark, src, max_files=1)), spark, name, mode=mode, rows=rows)


@register("r1_stream_typed_trades", _TRADES_SQL + "\nSELECT * FROM pt")
def r1_stream_typed_trades(spark, d):
    """R1 + R2: message stream -> typed trades via micro-batches into per-batch folders."""
    return jobs.read_batches(spark, _run(spark, d, "r1"), _TRADE_SCHEMA).drop("batch_id")


@register("r3_stream_bars", _TRADES_SQL + f"""
SELECT replace(product_id, '-USD', '') AS coin,
       make_timestamp(((epoch_us(trade_time) + {UNIT_US - 1}) // {UNIT_US}) * {UNIT_US}) AS bar_time,
       arg_max_null(price, (trade_time, trade_id)) AS last_price, round(sum(size), 9) AS size_sum, count(*) AS n_trades
FROM pt GROUP BY 1, 2""", ["size_sum"])
def r3_stream_bars(spark, d):
    """Event-time unit bars with a watermark (update mode, latest version per bar kept)."""
    out = _run(spark, d, "r3", lambda t: jobs.stream_bars(t, UNIT_US, WATERMARK), "update")
    rows = jobs.read_batches(spark, out, "coin string, bar_time timestamp, last_price double, size_sum double, n_trades long")
    return jobs.latest_per_key(rows, ["coin", "bar_time"])


@register("r6_stream_dedupe", _TRADES_SQL + """
SELECT trade_id, count(*) AS n FROM (SELECT DISTINCT trade_id FROM pt) GROUP BY trade_id""")
def r6_stream_dedupe(spark, d):
    """Repeated trade ids dropped within the watermark (each id kept once)."""
    rows = jobs.read_batches(spark, _run(spark, d, "r6", lambda t: jobs.dedupe_stream(t, WATERMARK)), _TRADE_SCHEMA)
    return rows.groupBy("trade_id").agg(F.count(F.lit(1)).alias("n"))


@register("r7_stream_sequence_gaps", _TRADES_SQL + """
SELECT product_id, sequence, arrival, CASE WHEN prev IS NULL THEN 0 WHEN sequence > prev THEN sequence - prev - 1 ELSE 0 END AS gap
FROM (SELECT *, lag(sequence) OVER (PARTITION BY product_id ORDER BY arrival) AS prev FROM pt WHERE sequence IS NOT NULL)""")
def r7_stream_sequence_gaps(spark, d):
    """Stateful per-product sequence-gap alarm (state = last sequence number)."""
    out = _run(spark, d, "r7", jobs.sequence_gap_alarm)
    return jobs.read_batches(spark, out, "product_id string, sequence long, arrival long, gap long").drop("batch_id")


@register("r10_stream_buffer_status", _TRADES_SQL + """
SELECT replace(product_id, '-USD', '') AS coin, count(*) AS n FROM pt GROUP BY 1""")
def r10_stream_buffer_status(spark, d):
    """Rows per coin in update mode (latest count per coin)."""
    out = _run(spark, d, "r10", jobs.coin_counts, "update")
    return jobs.latest_per_key(jobs.read_batches(spark, out, "coin string, n long"), ["coin"])


# ---------------------------------------------------------------- R4, R5: live features
_OTHERS = [c for c in COINS if c != "BTC"]
#: Messages of a micro-batch, at most, and of one of its files. A micro-batch of the live features costs some twelve stages
#: whatever it holds, and its messages are bytes until they are arrays.
LIVE_ROWS, LIVE_FILE_ROWS = 2_000_000, 250_000

_LIVE_SQL = [VIEW_SQL["quotes"], VIEW_SQL["trades"], f"""msgs AS (
  SELECT *, row_number() OVER (ORDER BY curr_time, kind, id) - 1 AS arrival FROM (
    SELECT coin, open_time, close_time, curr_time, last_price_dollars, yes_ask_dollars, yes_bid_dollars, floor_strike, CAST(NULL AS DOUBLE) AS price, 1 AS kind, id
    FROM quotes WHERE coin IN {tuple(COINS)}
    UNION ALL SELECT replace(product_id, '-USD', ''), NULL, NULL, trade_time, NULL, NULL, NULL, NULL, price, 0, id
    FROM trades WHERE replace(product_id, '-USD', '') IN {tuple(COINS)} AND trade_time IS NOT NULL AND price IS NOT NULL)),
lq AS (
  SELECT *, min(arrival) OVER (PARTITION BY coin, open_time, close_time) AS born FROM (
    SELECT *, last_value(price IGNORE NULLS) OVER (PARTITION BY coin ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spot_price FROM msgs)
  WHERE kind = 1),
ln AS (
  SELECT *, dense_rank() OVER (PARTITION BY coin ORDER BY born) AS event_no, born = max(born) OVER (PARTITION BY coin ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS latest,
         (yes_ask_dollars + yes_bid_dollars) / 2 AS yes_mid_dollars, yes_ask_dollars - yes_bid_dollars AS yes_spread_dollars, spot_price - floor_strike AS distance_from_strike FROM lq),
lc AS (SELECT *, coalesce(yes_mid_dollars - lag(yes_mid_dollars) OVER e, 0) AS yes_mid_change_1s, coalesce(yes_mid_dollars - lag(yes_mid_dollars, 5) OVER e, 0) AS yes_mid_change_5s
       FROM ln WINDOW e AS (PARTITION BY coin, open_time, close_time ORDER BY arrival)),
live AS MATERIALIZED (
  SELECT coin, open_time, close_time, curr_time, arrival, event_no, latest, spot_price, last_price_dollars, round(yes_mid_dollars, 6) AS yes_mid_dollars,
         round(yes_spread_dollars, 6) AS yes_spread_dollars, round(distance_from_strike, 6) AS distance_from_strike,
         round(yes_mid_change_1s, 6) AS yes_mid_change_1s, round(yes_mid_change_5s, 6) AS yes_mid_change_5s,
         round(CASE WHEN count(*) OVER w30 = 30 THEN stddev_pop(yes_mid_change_1s) OVER w30 ELSE 0 END, 6) AS yes_mid_change_std_30s,
         round(CASE WHEN count(*) OVER w60 = 60 THEN stddev_pop(yes_mid_change_1s) OVER w60 ELSE 0 END, 6) AS yes_mid_change_std_60s,
         round(CASE WHEN count(*) OVER w30 = 30 THEN avg(yes_spread_dollars) OVER w30 ELSE yes_spread_dollars END, 6) AS yes_spread_mean_30s
  FROM lc WINDOW w30 AS (PARTITION BY coin, open_time, close_time ORDER BY arrival ROWS 29 PRECEDING),
                 w60 AS (PARTITION BY coin, open_time, close_time ORDER BY arrival ROWS 59 PRECEDING))"""]
_ROUNDED = [c for c in live.FEATURES if c != "last_price_dollars"]


def _live(spark, d, name):
    """Messages landed by arrival, the stream run over all of them; the folder of its tables."""
    nothing = F.lit(None).cast("double")
    quotes = tv.quotes(spark, d).where(F.col("coin").isin(list(COINS)))
    quotes = quotes.select("coin", "open_time", "close_time", "curr_time", "last_price_dollars", "yes_ask_dollars", "yes_bid_dollars", "floor_strike",
                           nothing.alias("price"), F.lit(1).alias("kind"), "id")
    never = F.lit(None).cast("timestamp")
    spot = tv.trades(spark, d).withColumn("coin", F.regexp_replace("product_id", "-USD", "")).where(F.col("coin").isin(list(COINS)) & F.col("trade_time").isNotNull() & F.col("price").isNotNull())
    spot = spot.select("coin", never.alias("open_time"), never.alias("close_time"), F.col("trade_time").alias("curr_time"),
                       *[nothing.alias(c) for c in ("last_price_dollars", "yes_ask_dollars", "yes_bid_dollars", "floor_strike")], "price", F.lit(0).alias("kind"), "id")
    messages = dense_index(quotes.unionByName(spot), ["curr_time", "kind", "id"], name="arrival").drop("kind", "id")
    src, out, state = (jobs.new_dir(spark, f"{name}-{x}") for x in ("src", "out", "state"))
    rows = messages.count()
    batches = jobs.batches_for(rows, ROWS_PER_FILE, most=LIVE_ROWS)
    files = max(1, -(-rows // (batches * LIVE_FILE_ROWS)))
    jobs.land_in_order(messages, src, "arrival", batches * files, "parquet")
    stream = spark.readStream.schema(live.MESSAGE).option("maxFilesPerTrigger", files).parquet(src)
    live.run_live(stream, out, state, "BTC", _OTHERS)
    return out


@register("r4_event_state", W(_LIVE_SQL) + "\nSELECT * FROM live", [])
def r4_event_state(spark, d):
    """Features of every quote from its event's bounded history, over many micro-batches."""
    rows = spark.read.schema(live.ROW).parquet(f"{_live(spark, d, 'r4')}/events")
    return rows.select(*[F.round(c, 6).alias(c) if c in _ROUNDED else F.col(c) for c in rows.columns if c != "batch_id"])


@register("r5_cross_asset_rows", W(_LIVE_SQL) + "\nSELECT b.arrival, b.yes_mid_dollars, " + ", ".join(
    f"{o}.arrival AS {o}_arrival, " + ", ".join(f"{o}.{c} AS {o}_{c}" for c in live.FEATURES) for o in _OTHERS) + ",\n       CASE " + " ".join(
    f"WHEN {o}.arrival IS NULL THEN 'no {o} market data yet'" for o in _OTHERS) + " WHEN b.spot_price IS NULL THEN 'no BTC spot data yet' ELSE '' END AS reason\nFROM (SELECT * FROM live WHERE coin = 'BTC') b" + "".join(
    f"\nASOF LEFT JOIN (SELECT * FROM live WHERE coin = '{o}' AND latest) {o} ON b.arrival >= {o}.arrival" for o in _OTHERS))
def r5_cross_asset_rows(spark, d):
    """BTC quotes with the newest row of the other coins' latest events, and what is missing."""
    rows = spark.read.parquet(f"{_live(spark, d, 'r5')}/cross")
    keep = ["arrival", "yes_mid_dollars", *[f"{o}_{c}" for o in _OTHERS for c in ("arrival", *live.FEATURES)], "reason"]
    return rows.select(*[F.round(c, 6).alias(c) if c.removeprefix(c.split("_")[0] + "_") in _ROUNDED or c in _ROUNDED else F.col(c) for c in keep])

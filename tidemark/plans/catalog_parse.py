"""Parsing queries (P*) and option selection (T2–T4, Q10). Raw text is derived from the test
tables inside each engine (Spark ``to_json`` / DuckDB ``json_object``) and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import parse as ps
from tidemark.operators.clean import prepare_trades
from tidemark.registry import register
from tidemark.sources import testviews as tv
from tidemark.sources.testviews import EVENT_S, VIEW_SQL


def W(parts):
    return "WITH " + ",\n".join(parts)


def raw_spot_messages(spark, d):
    """Trade ('match') and quote ('ticker') messages from the trades view, some malformed / bad values."""
    t = tv.trades(spark, d)
    price_txt = F.when(F.col("id") % 89 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    match = F.to_json(F.struct(F.lit("match").alias("type"), "trade_id", "product_id", price_txt.alias("price"),
                               F.col("size").cast("string").alias("size"), "side", "sequence",
                               F.date_format("trade_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
                               F.concat(F.lit("m"), F.col("id").cast("string")).alias("maker_order_id"),
                               F.concat(F.lit("t"), F.col("id").cast("string")).alias("taker_order_id"), F.col("id").alias("arrival")))
    bad = F.concat(F.lit("not json {"), F.col("id").cast("string"))
    m = t.select("id", F.when(F.col("id") % 97 == 0, bad).otherwise(match).alias("raw"))
    tick = t.where(F.col("id") % 3 == 0).select("id", F.to_json(F.struct(
        F.lit("ticker").alias("type"), "product_id", "sequence", F.col("price").cast("string").alias("price"),
        F.date_format("trade_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"), "side",
        (F.col("price") - 0.01).cast("string").alias("best_bid"), (F.col("price") + 0.01).cast("string").alias("best_ask"),
        F.lit("12.5").alias("best_bid_size"), F.lit("").alias("best_ask_size"), F.col("size").alias("last_size"))).alias("raw"))
    return m.unionByName(tick)


RAW_SPOT_SQL = """raw AS (
  SELECT id, CASE WHEN id % 97 = 0 THEN 'not json {' || CAST(id AS VARCHAR)
         ELSE json_object('type', 'match', 'trade_id', trade_id, 'product_id', product_id,
                          'price', CASE WHEN id % 89 = 0 THEN 'n/a' ELSE CAST(price AS VARCHAR) END,
                          'size', CAST(size AS VARCHAR), 'side', side, 'sequence', sequence,
                          'time', strftime(trade_time, '%Y-%m-%dT%H:%M:%S.%fZ'), 'maker_order_id', 'm' || CAST(id AS VARCHAR),
                          'taker_order_id', 't' || CAST(id AS VARCHAR), 'arrival', id)::VARCHAR END AS raw FROM trades
  UNION ALL
  SELECT id, json_object('type', 'ticker', 'product_id', product_id, 'sequence', sequence, 'price', CAST(price AS VARCHAR),
                         'time', strftime(trade_time, '%Y-%m-%dT%H:%M:%S.%fZ'), 'side', side,
                         'best_bid', CAST(price - 0.01 AS VARCHAR), 'best_ask', CAST(price + 0.01 AS VARCHAR),
                         'best_bid_size', '12.5', 'best_ask_size', '', 'last_size', size)::VARCHAR
  FROM trades WHERE id % 3 = 0)"""


@register("p1_route_messages", W([VIEW_SQL["trades"], RAW_SPOT_SQL]) + """
SELECT coalesce(CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.type') END, 'malformed') AS msg_type, count(*) AS n
FROM raw GROUP BY 1""")
def p1_route_messages(spark, d):
    """Route raw messages by type; malformed JSON counted apart."""
    return ps.route(raw_spot_messages(spark, d)).groupBy("msg_type").agg(F.count(F.lit(1)).alias("n"))


@register("p2_parse_trades", W([VIEW_SQL["trades"], RAW_SPOT_SQL]) + """
SELECT CAST(json_extract(raw, '$.trade_id') AS BIGINT) AS trade_id, json_extract_string(raw, '$.product_id') AS product_id,
       TRY_CAST(json_extract_string(raw, '$.price') AS DOUBLE) AS price, TRY_CAST(json_extract_string(raw, '$.size') AS DOUBLE) AS size,
       json_extract_string(raw, '$.side') AS side, CAST(json_extract(raw, '$.sequence') AS BIGINT) AS sequence,
       TRY_CAST(replace(json_extract_string(raw, '$.time'), 'Z', '') AS TIMESTAMP) AS time, 'match' AS event_type,
       json_extract_string(raw, '$.maker_order_id') AS maker_order_id, json_extract_string(raw, '$.taker_order_id') AS taker_order_id
FROM raw WHERE json_valid(raw) AND json_extract_string(raw, '$.type') = 'match'""")
def p2_parse_trades(spark, d):
    """P2 + P4: typed trade rows; unparsable price -> null."""
    return ps.parse_trades(raw_spot_messages(spark, d))


@register("p3_parse_tickers", W([VIEW_SQL["trades"], RAW_SPOT_SQL]) + """
SELECT json_extract_string(raw, '$.product_id') AS product_id, CAST(json_extract(raw, '$.sequence') AS BIGINT) AS sequence,
       TRY_CAST(json_extract_string(raw, '$.price') AS DOUBLE) AS price,
       TRY_CAST(json_extract_string(raw, '$.best_bid') AS DOUBLE) AS best_bid,
       TRY_CAST(json_extract_string(raw, '$.best_ask') AS DOUBLE) AS best_ask,
       TRY_CAST(json_extract_string(raw, '$.best_bid_size') AS DOUBLE) AS best_bid_size,
       TRY_CAST(json_extract_string(raw, '$.best_ask_size') AS DOUBLE) AS best_ask_size,
       TRY_CAST(json_extract_string(raw, '$.last_size') AS DOUBLE) AS last_size, json_extract_string(raw, '$.side') AS side,
       TRY_CAST(replace(json_extract_string(raw, '$.time'), 'Z', '') AS TIMESTAMP) AS time
FROM raw WHERE json_valid(raw) AND json_extract_string(raw, '$.type') = 'ticker'""")
def p3_parse_tickers(spark, d):
    """Typed spot quote rows."""
    return ps.parse_tickers(raw_spot_messages(spark, d))


def raw_book_messages(spark, d):
    """Book snapshots: levels as texts on the yes side and numbers on the no side; every tenth message has a
    short level, every seventh an unreadable price."""
    b = tv.book(spark, d)
    text = F.array(F.col("price").cast("string"), F.format_string("%.1f", F.col("size")))
    g = b.groupBy("snapshot_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("side") == "yes", text))).alias("yes"),
        F.array_sort(F.collect_list(F.when(F.col("side") == "no", F.array("price", "size")))).alias("no_dollars_fp"))
    g = g.withColumn("yes", F.when(F.col("snapshot_id") % 10 == 0, F.concat("yes", F.array(F.array(F.lit("0.5"))))).otherwise(F.col("yes")))
    g = g.withColumn("yes_dollars_fp", F.when(F.col("snapshot_id") % 7 == 0, F.concat(F.array(F.array(F.lit("n/a"), F.lit("3"))), "yes")).otherwise(F.col("yes")))
    return g.select(F.to_json(F.struct(F.concat(F.lit("T"), F.col("snapshot_id").cast("string")).alias("market_ticker"), F.lit("m1").alias("market_id"),
                                       F.format_string("%d.0", F.col("snapshot_id")).alias("ts_ms"), "yes_dollars_fp", "no_dollars_fp")).alias("raw"))


RAW_BOOK_SQL = """g AS (
  SELECT snapshot_id, list_sort(list([CAST(price AS VARCHAR), printf('%.1f', size)]) FILTER (WHERE side = 'yes')) AS yes,
         list_sort(list([price, size]) FILTER (WHERE side = 'no')) AS no FROM book GROUP BY snapshot_id),
g2 AS (SELECT snapshot_id, list_concat(CASE WHEN snapshot_id % 7 = 0 THEN [['n/a', '3']] ELSE [] END, yes,
                                       CASE WHEN snapshot_id % 10 = 0 THEN [['0.5']] ELSE [] END) AS yes, no FROM g)"""


@register("p6_explode_book", W([VIEW_SQL["book"], RAW_BOOK_SQL]) + """
SELECT 'T' || CAST(snapshot_id AS VARCHAR) AS ticker, 'm1' AS market_id, snapshot_id AS ts_ms, 'snapshot' AS event_type, side, CAST(level AS BIGINT) AS level, price, delta_size FROM (
  SELECT snapshot_id, side, level, TRY_CAST(lv[1] AS DOUBLE) AS price, TRY_CAST(lv[2] AS DOUBLE) AS delta_size FROM (
    SELECT snapshot_id, 'yes' AS side, unnest(range(len(yes))) AS level, unnest(yes) AS lv FROM g2) WHERE len(lv) >= 2
  UNION ALL
  SELECT snapshot_id, 'no', level, lv[1], lv[2] FROM (SELECT snapshot_id, unnest(range(len(no))) AS level, unnest(no) AS lv FROM g2))
WHERE price IS NOT NULL AND delta_size IS NOT NULL""")
def p6_explode_book(spark, d):
    """Book snapshot JSON -> one row per (side, level); short and unreadable levels dropped."""
    return ps.explode_book(raw_book_messages(spark, d))


def raw_deltas(spark, d):
    f = tv.fills(spark, d)
    return f.select(F.to_json(F.struct(
        F.when(F.col("line_no") == 7, F.lit(None)).otherwise(F.concat(F.lit("T"), F.col("ticker").cast("string"))).alias("market_ticker"),
        F.lit("m1").alias("market_id"), F.col("order_key").alias("ts_ms"),
        F.when(F.col("order_key") % 11 == 0, F.lit("bad")).otherwise(F.col("price").cast("string")).alias("price_dollars"),
        F.format_string("%.1f", F.col("contracts")).alias("delta_fp"),
        F.when(F.col("order_key") % 13 == 0, F.lit("maybe")).otherwise(F.col("side")).alias("side"))).alias("raw"))


@register("p7_parse_deltas", W([VIEW_SQL["fills"], """raw AS (
  SELECT json_object('market_ticker', CASE WHEN line_no = 7 THEN NULL ELSE 'T' || CAST(ticker AS VARCHAR) END, 'market_id', 'm1', 'ts_ms', order_key,
                     'price_dollars', CASE WHEN order_key % 11 = 0 THEN 'bad' ELSE CAST(price AS VARCHAR) END, 'delta_fp', printf('%.1f', contracts),
                     'side', CASE WHEN order_key % 13 = 0 THEN 'maybe' ELSE side END)::VARCHAR AS raw FROM fills)"""]) + """
SELECT * FROM (
  SELECT json_extract_string(raw, '$.market_ticker') AS ticker, json_extract_string(raw, '$.market_id') AS market_id,
         CAST(trunc(TRY_CAST(json_extract_string(raw, '$.ts_ms') AS DOUBLE)) AS BIGINT) AS ts_ms, 'delta' AS event_type, json_extract_string(raw, '$.side') AS side,
         TRY_CAST(json_extract_string(raw, '$.price_dollars') AS DOUBLE) AS price, TRY_CAST(json_extract_string(raw, '$.delta_fp') AS DOUBLE) AS delta_size FROM raw)
WHERE ticker IS NOT NULL AND price IS NOT NULL AND delta_size IS NOT NULL AND side IN ('yes', 'no')""")
def p7_parse_deltas(spark, d):
    """Validated order-book delta rows."""
    return ps.parse_deltas(raw_deltas(spark, d))


def raw_contract_trades(spark, d):
    f = tv.fills(spark, d)
    tos = F.when(F.col("order_key") % 3 == 0, F.lit(None)).when(F.col("order_key") % 3 == 1, F.lit("")).otherwise(
        F.when(F.col("side") == "yes", "no").otherwise("yes"))
    return f.select(F.to_json(F.struct(
        F.when(F.col("line_no") == 3, F.lit("")).otherwise(F.concat_ws("-", F.col("order_key").cast("string"), F.col("line_no").cast("string"))).alias("trade_id"),
        F.concat(F.lit("T"), F.col("ticker").cast("string")).alias("market_ticker"), F.format_string("%d.7", F.col("order_key")).alias("ts_ms"),
        F.when(F.col("order_key") % 17 == 0, F.lit("?")).otherwise(F.col("price").cast("string")).alias("yes_price_dollars"), F.lit("0.25").alias("no_price_dollars"),
        F.format_string("%.1f", F.col("contracts") + 0.5).alias("count_fp"), tos.alias("taker_outcome_side"),
        F.col("side").alias("taker_side"), F.lit("bid").alias("taker_book_side"))).alias("raw"))


@register("p8_parse_contract_trades", W([VIEW_SQL["fills"], """raw AS (
  SELECT json_object('trade_id', CASE WHEN line_no = 3 THEN '' ELSE CAST(order_key AS VARCHAR) || '-' || CAST(line_no AS VARCHAR) END,
                     'market_ticker', 'T' || CAST(ticker AS VARCHAR), 'ts_ms', CAST(order_key AS VARCHAR) || '.7',
                     'yes_price_dollars', CASE WHEN order_key % 17 = 0 THEN '?' ELSE CAST(price AS VARCHAR) END, 'no_price_dollars', '0.25', 'count_fp', printf('%.1f', contracts + 0.5),
                     'taker_outcome_side', CASE WHEN order_key % 3 = 0 THEN NULL WHEN order_key % 3 = 1 THEN ''
                                                 ELSE CASE WHEN side = 'yes' THEN 'no' ELSE 'yes' END END,
                     'taker_side', side, 'taker_book_side', 'bid')::VARCHAR AS raw FROM fills)"""]) + """
SELECT trade_id, ticker, ts_ms, yes_price, no_price, count, coalesce(nullif(tos, ''), taker_side) AS taker_outcome_side, taker_book_side FROM (
  SELECT json_extract_string(raw, '$.trade_id') AS trade_id, json_extract_string(raw, '$.market_ticker') AS ticker,
         CAST(trunc(TRY_CAST(json_extract_string(raw, '$.ts_ms') AS DOUBLE)) AS BIGINT) AS ts_ms,
         TRY_CAST(json_extract_string(raw, '$.yes_price_dollars') AS DOUBLE) AS yes_price, TRY_CAST(json_extract_string(raw, '$.no_price_dollars') AS DOUBLE) AS no_price,
         TRY_CAST(json_extract_string(raw, '$.count_fp') AS DOUBLE) AS count, json_extract_string(raw, '$.taker_outcome_side') AS tos,
         json_extract_string(raw, '$.taker_side') AS taker_side, json_extract_string(raw, '$.taker_book_side') AS taker_book_side FROM raw)
WHERE coalesce(trade_id, '') <> '' AND coalesce(ticker, '') <> ''""")
def p8_parse_contract_trades(spark, d):
    """Contract trades with the taker-side fallback; text prices and a fractional count."""
    return ps.parse_contract_trades(raw_contract_trades(spark, d))


@register("p9_ticker_coin", W([VIEW_SQL["fills"]]) + """
SELECT f.order_key, f.line_no, f.ticker, coalesce(m.coin, '') AS coin FROM fills f
LEFT JOIN (SELECT DISTINCT ticker, CASE ticker % 4 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' WHEN 2 THEN 'XRP' ELSE 'SOL' END AS coin
           FROM fills WHERE ticker % 5 <> 0) m ON f.ticker = m.ticker""")
def p9_ticker_coin(spark, d):
    """Ticker -> coin enrichment from a market dimension; unknown tickers -> ''."""
    f = tv.fills(spark, d)
    dim = f.where(F.col("ticker") % 5 != 0).select("ticker").distinct().withColumn(
        "coin", F.element_at(F.array(*[F.lit(c) for c in ("BTC", "ETH", "XRP", "SOL")]), (F.col("ticker") % 4 + 1).cast("int")))
    return ps.enrich_coin(f.select("order_key", "line_no", "ticker"), dim)


OPT_SQL = """po AS (
  SELECT *, CASE WHEN len(string_split(instrument_name, '-')) >= 4 THEN string_split(instrument_name, '-')[2] END AS expiry,
         CASE WHEN len(string_split(instrument_name, '-')) >= 4 THEN TRY_CAST(string_split(instrument_name, '-')[3] AS DOUBLE) END AS strike,
         CASE WHEN len(string_split(instrument_name, '-')) >= 4 THEN string_split(instrument_name, '-')[4] END AS option_type,
         try_strptime(string_split(instrument_name, '-')[2], '%d%b%y') AS expiry_date
  FROM options)"""


@register("p10_option_symbols", W([VIEW_SQL["options"], OPT_SQL]) + """
SELECT id, currency, expiry, expiry_date, strike, option_type FROM po""")
def p10_option_symbols(spark, d):
    """P10 + P11: option symbol parse and expiry text -> date."""
    o = ps.parse_option_symbol(tv.options(spark, d))
    return o.select("id", "currency", "expiry", "expiry_date", "strike", "option_type")


_NEAR = "ne AS (SELECT * FROM po WHERE expiry_date = (SELECT min(expiry_date) FROM po p2 WHERE p2.currency = po.currency))"


@register("t2_nearest_expiry", W([VIEW_SQL["options"], OPT_SQL, _NEAR]) + """
SELECT currency, id, instrument_name, expiry_date FROM ne""")
def t2_nearest_expiry(spark, d):
    """Options at each currency's nearest expiry."""
    o = ps.nearest_expiry(ps.parse_option_symbol(tv.options(spark, d)))
    return o.select("currency", "id", "instrument_name", "expiry_date")


@register("t3_near_spot_strikes", W([VIEW_SQL["options"], OPT_SQL, _NEAR]) + """
SELECT DISTINCT currency, instrument_name, distance_to_spot FROM (
  SELECT *, row_number() OVER (PARTITION BY currency, option_type ORDER BY distance_to_spot, id) AS rn FROM (
    SELECT *, abs(strike - first_value(underlying_price IGNORE NULLS) OVER (PARTITION BY currency ORDER BY id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS distance_to_spot
    FROM ne WHERE option_type IN ('C', 'P')))
WHERE rn <= 12""")
def t3_near_spot_strikes(spark, d):
    """12 calls and 12 puts nearest the spot at the nearest expiry, union distinct."""
    return ps.near_spot(ps.nearest_expiry(ps.parse_option_symbol(tv.options(spark, d))))


@register("t4_delta_selection", W([VIEW_SQL["options"], OPT_SQL, _NEAR]) + """
SELECT DISTINCT currency, instrument_name, delta FROM (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY currency ORDER BY abs(delta - 0.25), id) AS rn
                 FROM ne WHERE option_type = 'C' AND delta BETWEEN 0.10 AND 0.40) WHERE rn = 1
  UNION ALL
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY currency ORDER BY abs(delta - 0.5), id) AS rn
                 FROM ne WHERE option_type = 'C' AND delta BETWEEN 0.40 AND 0.60) WHERE rn = 1
  UNION ALL
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY currency ORDER BY abs(delta - (-0.25)), id) AS rn
                 FROM ne WHERE option_type = 'P' AND delta BETWEEN -0.40 AND -0.10) WHERE rn = 1)""")
def t4_delta_selection(spark, d):
    """T4 (+ Q10): 25-delta call, ATM call and 25-delta put at the nearest expiry."""
    return ps.delta_selection(ps.nearest_expiry(ps.parse_option_symbol(tv.options(spark, d))))


@register("p17_interval_strike", W([VIEW_SQL["trades"]]) + f"""
SELECT replace(product_id, '-USD', '') AS coin, CAST(floor(epoch(trade_time) / {EVENT_S}) * {EVENT_S} AS BIGINT) AS interval_start_unix,
       arg_min(price, (trade_time, id)) AS strike_price
FROM trades GROUP BY 1, 2""")
def p17_interval_strike(spark, d):
    """P16 + P17: interval start and the interval's opening trade price as strike."""
    return ps.interval_strike(prepare_trades(tv.trades(spark, d)), EVENT_S)


def raw_orders(spark, d):
    """Order responses: half in an envelope, every fifth without taker cost, some without status."""
    f = tv.fills(spark, d).withColumn("id", F.col("order_key") * 8 + F.col("line_no"))
    body = F.struct(F.format_string("%.1f", F.col("contracts")).alias("fill_count_fp"), F.lit("2.0").alias("remaining_count_fp"),
                    F.when(F.col("line_no") == 5, F.lit(None)).otherwise(F.format_string("%.4f", F.col("contracts") * F.col("price"))).alias("taker_fill_cost_dollars"),
                    F.lit("0.25").alias("maker_fill_cost_dollars"), F.format_string("%.2f", F.col("contracts") * 0.01).alias("taker_fees_dollars"),
                    F.lit("x").alias("maker_fees_dollars"), F.when(F.col("line_no") != 2, F.lit("executed")).alias("status"), F.col("id").cast("string").alias("order_id"))
    return f.select("id", F.when(F.col("order_key") % 2 == 0, F.to_json(F.struct(body.alias("order")))).otherwise(F.to_json(body)).alias("raw"))


@register("p18_order_response", W([VIEW_SQL["fills"], """raw AS (
  SELECT id, json_object('fill_count_fp', printf('%.1f', contracts), 'remaining_count_fp', '2.0',
                          'taker_fill_cost_dollars', CASE WHEN line_no = 5 THEN NULL ELSE printf('%.4f', contracts * price) END, 'maker_fill_cost_dollars', '0.25',
                          'taker_fees_dollars', printf('%.2f', contracts * 0.01), 'maker_fees_dollars', 'x',
                          'status', CASE WHEN line_no <> 2 THEN 'executed' END, 'order_id', CAST(id AS VARCHAR))::VARCHAR AS o
  FROM (SELECT *, order_key * 8 + line_no AS id FROM fills))"""]) + """
SELECT id, CAST(trunc(filled) AS BIGINT) AS filled, CAST(2 AS BIGINT) AS remaining, coalesce(cost / nullif(trunc(filled), 0), 0) AS avg_price,
       coalesce(fees / nullif(trunc(filled), 0), 0) AS fee_per_contract, coalesce(json_extract_string(o, '$.status'), 'unknown') AS status, json_extract_string(o, '$.order_id') AS order_id
FROM (SELECT id, o, CAST(json_extract_string(o, '$.fill_count_fp') AS DOUBLE) AS filled,
             coalesce(CAST(json_extract_string(o, '$.taker_fill_cost_dollars') AS DOUBLE), 0) + CAST(json_extract_string(o, '$.maker_fill_cost_dollars') AS DOUBLE) AS cost,
             CAST(json_extract_string(o, '$.taker_fees_dollars') AS DOUBLE) AS fees FROM raw)""")
def p18_order_response(spark, d):
    """Order response -> fills, costs and fees of taker and maker parts, status, id (envelope optional)."""
    return ps.parse_order_response(raw_orders(spark, d))


@register("p19_parse_timestamps", W([VIEW_SQL["trades"]]) + """
SELECT id, TRY_CAST(regexp_replace(txt, '(Z|[+-]00:?00)$', '') AS TIMESTAMP) AS parsed FROM (
  SELECT id, CASE WHEN id % 53 = 0 THEN 'garbage ' || CAST(id AS VARCHAR)
                  WHEN id % 2 = 0 THEN strftime(trade_time, '%Y-%m-%d %H:%M:%S.%f') || '+00:00'
                  ELSE strftime(trade_time, '%Y-%m-%dT%H:%M:%S.%fZ') END AS txt FROM trades)""")
def p19_parse_timestamps(spark, d):
    """Timestamps in two layouts parsed non-strictly; bad text -> null."""
    t = tv.trades(spark, d)
    txt = (F.when(F.col("id") % 53 == 0, F.concat(F.lit("garbage "), F.col("id").cast("string")))
           .when(F.col("id") % 2 == 0, F.concat(F.date_format("trade_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00")))
           .otherwise(F.date_format("trade_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))
    return t.select("id", txt.alias("txt")).select("id", ps.parse_timestamp("txt").alias("parsed"))

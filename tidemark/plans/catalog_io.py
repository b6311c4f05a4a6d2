"""Source / sink queries (S*): each writes to and reads back from the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.ml import models as md
from tidemark.registry import register
from tidemark.session import scratch_path
from tidemark.sources import io
from tidemark.sources import testviews as tv
from tidemark.sources.testviews import VIEW_SQL
from tidemark.streaming.jobs import new_dir

TRADES_CSV_SCHEMA = ("id long, curr_time timestamp, product_id string, event_type string, trade_time timestamp, "
                     "trade_id long, sequence long, price double, size double, side string, maker_order_id string, "
                     "taker_order_id string")


@register("s1_csv_roundtrip", "WITH " + VIEW_SQL["trades"] + "\nSELECT * FROM trades")
def s1_csv_roundtrip(spark, d):
    """S1 + S5: trades written as CSV and scanned back with an explicit schema."""
    path = new_dir(spark, "s1")
    io.write_csv(tv.trades(spark, d), path)
    return io.read_csv(spark, path, TRADES_CSV_SCHEMA)


@register("s3_paged_extract", "WITH " + VIEW_SQL["fills"] + """
SELECT order_key, line_no, ticker, price FROM fills ORDER BY time, order_key, line_no, ticker, portfolio LIMIT 250""")
def s3_paged_extract(spark, d):
    """S3: projection + a 250-row page in a total order."""
    f = tv.fills(spark, d)
    return io.paged_extract(f, "*", 250, ["time", "order_key", "line_no", "ticker", "portfolio"]).select(
        "order_key", "line_no", "ticker", "price")


@register("s6_append_sink", "WITH " + VIEW_SQL["outcomes"] + "\nSELECT ticker, result FROM outcomes")
def s6_append_sink(spark, d):
    """Two batches appended with a fixed column order, the first of them sent again, read back once."""
    path = new_dir(spark, "s6")
    o = tv.outcomes(spark, d)
    for batch in (0, 1, 0):
        io.append_batch(o.where(f"ticker % 2 = {batch}"), path, ["ticker", "result"], batch)
    return io.read_appended(spark, path, "ticker long, result string")


@register("s7_rounded_log", "WITH " + VIEW_SQL["ticks"] + """
SELECT order_key, line_no, ticker, supp, round(p_hat, 6) AS p_hat, round(p_std, 6) AS p_std,
       round(p_hat - yes_ask, 8) AS edge_yes, round((1 - p_hat) - no_ask, 8) AS edge_no FROM ticks""")
def s7_rounded_log(spark, d):
    """Scored-tick log rows rounded like the reference's log (6 / 8 decimals)."""
    t = tv.ticks(spark, d).select("order_key", "line_no", "ticker", "supp", "p_hat", "p_std",
                                  (F.col("p_hat") - F.col("yes_ask")).alias("edge_yes"),
                                  ((1 - F.col("p_hat")) - F.col("no_ask")).alias("edge_no"))
    return io.log_projection(t, {"p_hat": 6, "p_std": 6, "edge_yes": 8, "edge_no": 8})


@register("s8_model_artifacts", None)
def s8_model_artifacts(spark, d):
    """Draws and scaler saved as parquet, loaded back, feature order checked (mismatch rows)."""
    c = tv.classifier(spark, d)
    stats = md.feature_stats(c).withColumn("feature", F.concat(F.lit("f"), F.col("pos").cast("string")))
    path = scratch_path(spark, f"s8-{new_dir(spark, 'x')[-10:]}")
    io.save_artifacts(md.group_mean_draws(c), stats, path)
    scaler = spark.read.parquet(f"{path}/scaler")
    expected = [f"f{i}" for i in range(63)] + ["extra"]
    return io.check_feature_order(spark, scaler, expected)

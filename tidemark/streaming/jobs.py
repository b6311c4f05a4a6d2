"""Structured Streaming twins of ingestion and features.

Sources are JSON message files (landed messages); every job runs with an explicit schema, a checkpoint
under the shared checkpoint folder and ``foreachBatch`` sinks that are idempotent per batch id (a retried
batch overwrites its own output directory). An event-time watermark bounds the state of bars (R3) and
dedupe (R6), and rows later than it are counted (R11); the other states are one row per product or coin. ``run_available_now`` drives a job to completion (tests, backfills).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark.operators import ledger
from tidemark.operators.parse import TRADE_MSG
from tidemark.session import CHANGELOG, PARTITIONS, ROCKSDB, STATE_PROVIDER, scratch_path, settings
from tidemark.sources import io

RAW_SCHEMA = "raw string"


def new_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex[:10]}")


def land_messages(df: DataFrame, path: str, files: int = 8) -> str:
    """Write a column ``raw`` of message texts as JSON-lines files (the landed message folder)."""
    df.select("raw").repartition(files).write.mode("overwrite").text(path)
    return path


def land_in_order(df: DataFrame, path: str, order: str, batches: int, kind: str = "text") -> str:
    """Write ``df`` as a recorder would: ``batches`` files of consecutive ``order``, in one job, with ascending times
    so that a stream reads them in that order. ``text`` files hold the column ``raw`` alone."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(batches, order).sortWithinPartitions(order)
    (ranged.select("raw") if kind == "text" else ranged).write.format(kind).mode("overwrite").save(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    newest = max((fs.getFileStatus(p).getModificationTime() for p in files), default=0)
    for i, p in enumerate(files):
        fs.setTimes(p, newest + (i - len(files)) * 1000, -1)
    return path


def batches_for(df: DataFrame | int, rows: int, wanted: int = 16, most: int = 500_000) -> int:
    """How many micro-batches ``df``, or so many rows, make: of about ``rows`` rows up to ``wanted`` of them, then as many with more
    rows each, as every micro-batch costs its own commits and tasks; beyond ``most`` rows in one, more again."""
    n = df if isinstance(df, int) else df.count()
    return max(1, -(-n // min(most, max(rows, -(-n // wanted)))))


#: Rows of a stream whose state one partition holds, about.
STATE_ROWS = 500_000


def state_settings(spark: SparkSession, rows: int) -> AbstractContextManager[None]:
    """What a stateful stream over about ``rows`` rows starts with. A query takes its state store and the number of
    its state partitions from the session as it starts and keeps them. Every micro-batch loads, writes and commits
    each partition, whatever it holds, so there are as many as there are cores until ``rows`` asks for more."""
    usual, cores = int(spark.conf.get(PARTITIONS)), spark.sparkContext.defaultParallelism
    parts = max(1, min(usual, cores), -(-rows // STATE_ROWS))
    return settings(spark, {STATE_PROVIDER: ROCKSDB, CHANGELOG: "true", PARTITIONS: str(parts)})


def typed_trade_stream(spark: SparkSession, src: str, max_files: int | None = None) -> DataFrame:
    """Raw message stream -> typed trade rows (P1 routing + P2 parsing), in batches of ``max_files``."""
    r = spark.readStream.schema(RAW_SCHEMA).format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    raw = r.load(src).withColumnRenamed("value", "raw")
    m = raw.select(F.from_json("raw", TRADE_MSG).alias("m")).where(F.col("m.type") == "match").select("m.*")
    return m.select("trade_id", "product_id", F.expr("try_cast(price AS DOUBLE)").alias("price"),
                    F.expr("try_cast(size AS DOUBLE)").alias("size"), "side", "sequence",
                    F.expr("try_cast(time AS TIMESTAMP)").alias("trade_time"), "arrival")


def batch_sink(out: str):
    """foreachBatch writer; each batch lands in its own batch_id folder (idempotent on retry)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))
    return write


def run_available_now(sdf: DataFrame, spark: SparkSession, name: str, mode: str = "append",
                      processing_time: str | None = None, rows: int = 0) -> str:
    """Run a streaming frame over about ``rows`` rows to completion into parquet folders; returns the output folder."""
    out, ckpt = new_dir(spark, f"{name}-out"), new_dir(spark, f"{name}-ckpt")
    w = sdf.writeStream.outputMode(mode).option("checkpointLocation", ckpt).foreachBatch(batch_sink(out))
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    with state_settings(spark, rows):
        q = w.start()
    q.awaitTermination()
    LATE[out] = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    return out


#: Rows that a finished job dropped as later than its watermark, by output folder.
LATE: dict[str, int] = {}


def read_batches(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """Rows of all batches with their ``batch_id``; a job without any batch has no folder and no rows."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema + ", batch_id long")
    return spark.read.schema(schema + ", batch_id long").parquet(out)


def stream_bars(trades: DataFrame, unit_us: int, watermark: str = "7 days") -> DataFrame:
    """Right-closed unit bars by event time; the watermark is on the bar's own time, so a bar's state is
    dropped once it has passed, and rows of dropped bars count as late."""
    label = F.expr(f"timestamp_micros(((unix_micros(trade_time) + {unit_us - 1}) div {unit_us}) * {unit_us})")
    t = trades.withColumn("bar_time", label).withColumn("coin", F.regexp_replace("product_id", "-USD", ""))
    return (t.withWatermark("bar_time", watermark).groupBy("coin", "bar_time")
            .agg(F.max_by("price", F.struct("trade_time", "trade_id")).alias("last_price"),
                 F.sum("size").alias("size_sum"), F.count(F.lit(1)).alias("n_trades")))


def latest_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Update-mode output -> final table: the row of the latest batch per key."""
    w = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "batch_id")


def dedupe_stream(trades: DataFrame, watermark: str = "7 days") -> DataFrame:
    """Drop repeated trade ids within the watermark delay."""
    return trades.withWatermark("trade_time", watermark).dropDuplicatesWithinWatermark(["trade_id"])


def sequence_gap_alarm(trades: DataFrame) -> DataFrame:
    """Per product and message, in order of arrival, how many sequence numbers were skipped since the
    message before (state = the last number). A number that does not advance gives 0 and is the new last
    one. A key's rows of one micro-batch are put in order of arrival together: Spark hands them over in
    Arrow chunks of no particular order; a batch is bounded by the rows of ``max_files`` files, of which only
    the columns used here come."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state):
        pdf = pd.concat(list(pdfs)).sort_values("arrival", kind="mergesort")
        seq = pdf["sequence"].to_numpy()
        before = np.r_[state.get[0] if state.exists else seq[0], seq[:-1]]
        gap = np.where(seq > before, seq - before - 1, 0)
        state.update((int(seq[-1]),))
        yield pd.DataFrame({"product_id": key[0], "sequence": seq, "arrival": pdf["arrival"].to_numpy(), "gap": gap})
    known = trades.where(F.col("sequence").isNotNull() & F.col("product_id").isNotNull()).select("product_id", "sequence", "arrival")
    return known.groupBy("product_id").applyInPandasWithState(
        fn, "product_id string, sequence long, arrival long, gap long", "last_seq long", "append", GroupStateTimeout.NoTimeout)


def coin_counts(trades: DataFrame) -> DataFrame:
    """Buffer status: rows per coin, update mode."""
    return trades.groupBy(F.regexp_replace("product_id", "-USD", "").alias("coin")).agg(F.count(F.lit(1)).alias("n"))


# --- R9: settlement on arrival
LOT_COLUMNS = ["ticker", "side", "time", "order_key", "line_no", "portfolio", "price", "contracts", "won", "pnl"]
LOT_SCHEMA = "ticker long, side string, time timestamp, order_key long, line_no long, portfolio long, price double, contracts double, won boolean, pnl double"


def settle_arrivals(open_lots: DataFrame, path: str) -> Callable[[DataFrame, int], None]:
    """What a stream of outcomes (ticker, result) does with each micro-batch.

    The lots of the batch's tickers are closed and appended to the log under ``path`` by batch id. A ticker closes
    once: results that come again, in the batch or in a later one, change nothing (of two results in a batch the
    smaller counts), and a batch that is replayed is already in the log. A ticker without lots closes none."""
    def close(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        logged = io.read_appended(spark, path, LOT_SCHEMA).select("ticker").distinct()
        new = batch.groupBy("ticker").agg(F.min("result").alias("result")).join(logged, "ticker", "left_anti")
        io.append_batch(ledger.settle(open_lots, new), path, LOT_COLUMNS, batch_id)

    return close


def run_settlement(outcomes: DataFrame, open_lots: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run the stream over all files that are there and return the log of closed lots."""
    query = (outcomes.writeStream.foreachBatch(settle_arrivals(open_lots, path))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return io.read_appended(open_lots.sparkSession, path, LOT_SCHEMA)

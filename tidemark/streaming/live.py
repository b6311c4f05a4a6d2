"""Live features of market events over a stream of quotes and spot trades.

Messages come in order of arrival (``arrival``: one number each, ascending). Two keyed processors with state run in one
query. The first is keyed by coin and light: it keeps the last spot price and the at most ``KEPT_EVENTS`` events of
the coin, and numbers events as they are created. The second is keyed by event and creation and holds the
bounded histories; a timer drops them once the event has closed. So a coin's windows are spread over its events.

Spark hands rows to a keyed processor one by one, each column a Python object, and a coin is one key. So the source makes
of a message the bytes of a ``SENT`` record, and a processor before these two, keyed by coin and stretch of arrivals and
without state, makes one row of many messages that are not late; quotes go on as the bytes of many ``KNOWN`` records.

Cross-asset rows (R5) need other coins' rows, which no key brings together without one task for all. They are met in
``foreachBatch`` by an as-of join on arrival; between batches only one row per coin is kept, written by batch id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.asof import AsofRight, asof_join
from tidemark.streaming.jobs import state_settings

# Lengths of the histories, windows, events kept per coin.
MIDS, CHANGES, SPREADS = 65, 61, 30
SHORT, LONG, BACK, KEPT_EVENTS = 30, 60, 5, 8
BUCKET = 10_000  # arrivals per bucket of the as-of join, and per row of the first processor

QUOTE = "coin string, open_time timestamp, close_time timestamp, curr_time timestamp, arrival long, last_price_dollars double, yes_ask_dollars double, yes_bid_dollars double, floor_strike double"
MESSAGE = QUOTE + ", price double"
FEATURES = ("last_price_dollars", "yes_mid_dollars", "yes_spread_dollars", "distance_from_strike", "yes_mid_change_1s", "yes_mid_change_5s",
            "yes_mid_change_std_30s", "yes_mid_change_std_60s", "yes_spread_mean_30s")
ROW = "coin string, open_time timestamp, close_time timestamp, curr_time timestamp, arrival long, event_no long, latest boolean, spot_price double, " + ", ".join(f"{c} double" for c in FEATURES)


#: Times are microseconds. ``SENT``: a message; ``quote`` tells quotes from spot trades. ``KNOWN``: a quote and what its coin knew.
_VALUES = [(c, "f8") for c in ("last_price_dollars", "yes_ask_dollars", "yes_bid_dollars", "floor_strike")]
SENT = np.dtype([("arrival", "i8"), ("curr_time", "i8"), ("open_time", "i8"), ("close_time", "i8"), *_VALUES, ("price", "f8"), ("quote", "?")])
KNOWN = np.dtype([("arrival", "i8"), ("curr_time", "i8"), *_VALUES, ("spot_price", "f8"), ("latest", "?")])
RECORD = "coin string, stretch long, curr_time timestamp, records binary"
PACK = "coin string, curr_time timestamp, records binary"
NUMBERED = "coin string, open_us long, close_us long, event_no long, curr_time timestamp, records binary"
FRAME = 20_000  # rows that a processor gives at once
BLOCK = 4_096  # places whose windows are looked at together


def to_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages (``MESSAGE``) as ``RECORD``: one ``SENT`` each."""
    for batch in batches:
        out = np.zeros(batch.num_rows, SENT)
        for name in SENT.names[:-1]:
            column = batch.column(name)
            out[name] = (column if pa.types.is_floating(column.type) else column.cast(pa.int64()).fill_null(0)).to_numpy(zero_copy_only=False)
        out["quote"] = batch.column("open_time").is_valid().to_numpy(zero_copy_only=False)
        stretch = pa.array(out["arrival"] // BUCKET)
        ends = np.arange(len(out) + 1, dtype=np.int32) * SENT.itemsize
        records = pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(ends), pa.py_buffer(out.tobytes())])
        yield pa.RecordBatch.from_arrays([batch.column("coin"), stretch, batch.column("curr_time"), records], names=["coin", "stretch", "curr_time", "records"])


def in_order(rows: Iterator[pd.DataFrame], kind: np.dtype) -> np.ndarray:
    """A key's records of one micro-batch by arrival; a micro-batch holds a bounded number of rows."""
    got = np.frombuffer(b"".join([b"".join(pdf["records"]) for pdf in rows]), kind)
    return got[np.argsort(got["arrival"], kind="stable")]


def times(micros: np.ndarray) -> pd.Series:
    return pd.Series(micros.astype("datetime64[us]")).dt.tz_localize("UTC")


def starts(*columns: np.ndarray) -> np.ndarray:
    """Places at which one of ``columns`` differs from the place before, the first included."""
    return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)]) if len(columns[0]) else np.empty(0, int)


class Packing(StatefulProcessor):
    """Per coin and stretch of arrivals: the messages of a micro-batch as few rows, of the earliest time in each. It keeps
    nothing; late messages, which Spark leaves out by the row, never come here."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            records = b"".join(pdf["records"])
            yield pd.DataFrame({"coin": key[0], "curr_time": times(np.frombuffer(records, SENT)["curr_time"].min(keepdims=True)), "records": [records]})

    def close(self) -> None:
        pass


class Numbering(StatefulProcessor):
    """Per coin: the spot price each quote meets, and the number of its event in order of creation. Of more than
    ``KEPT_EVENTS`` events the one created first is dropped; a quote that comes for it later creates it anew."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.coin = handle.getValueState("coin", "price double, created long, opens array<long>, closes array<long>, numbers array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        price, created, *known = self.coin.get() if self.coin.exists() else (None, 0, [], [], [])
        events = {(o, c): n for o, c, n in zip(*known, strict=True)}
        got = in_order(rows, SENT)
        spot = got["price"].copy()
        if price is not None and np.isnan(spot[0]):
            spot[0] = price
        spot = spot[np.maximum.accumulate(np.where(np.isnan(spot), 0, np.arange(len(spot))))]
        q, numbers = got[got["quote"]], np.empty(np.count_nonzero(got["quote"]), np.int64)
        out = np.zeros(len(q), KNOWN)
        for name in KNOWN.names[:-2]:
            out[name] = q[name]
        out["spot_price"] = spot[got["quote"]]
        first = starts(q["open_time"], q["close_time"])
        for a, b, event in zip(first, np.append(first[1:], len(q)), zip(q["open_time"][first].tolist(), q["close_time"][first].tolist())):
            if event not in events:
                created += 1
                events[event] = created
                if len(events) > KEPT_EVENTS:
                    del events[next(iter(events))]
            numbers[a:b] = events[event]
            out["latest"][a:b] = events[event] == created
        last = None if np.isnan(spot[-1]) else float(spot[-1])
        self.coin.update((last, created, [e[0] for e in events], [e[1] for e in events], list(events.values())))
        by_event = np.argsort(numbers, kind="stable")
        for a in range(0, len(q), FRAME):
            part = by_event[a:a + FRAME]
            first = starts(numbers[part])
            head = part[first]
            yield pd.DataFrame({"coin": key[0], "open_us": q["open_time"][head], "close_us": q["close_time"][head], "event_no": numbers[head],
                                "curr_time": times(np.minimum.reduceat(out["curr_time"][part], first)), "records": [r.tobytes() for r in np.split(out[part], first[1:])]})

    def close(self) -> None:
        pass


def windows(x: np.ndarray, n: int, size: int, f: Callable[..., np.ndarray], other: np.ndarray) -> np.ndarray:
    """``f`` of the last ``size`` values at each of the last ``n`` places of ``x``; ``other`` where there are fewer."""
    out, before = other.astype(float).copy(), len(x) - n
    for a in range(max(size - 1 - before, 0), n, BLOCK):
        b = min(a + BLOCK, n)
        out[a:b] = f(np.lib.stride_tricks.sliding_window_view(x[before + a - size + 1:before + b], size), axis=1)
    return out


class Histories(StatefulProcessor):
    """Per event: change of the mid price over one and five quotes, its deviation over 30 and 60, mean spread over
    30. Until there are that many quotes changes and deviations are 0 and the spread is the current one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.mids, self.changes, self.spreads = (handle.getListState(name, "v double") for name in ("mids", "changes", "spreads"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old = [np.array([r[0] for r in s.get()], dtype=float) if s.exists() else np.empty(0) for s in (self.mids, self.changes, self.spreads)]
        if not len(old[0]):
            self.handle.registerTimer(int(key[2]) // 1000)
        got = in_order(rows, KNOWN)
        n, ask, bid = len(got), got["yes_ask_dollars"], got["yes_bid_dollars"]
        mid, spread = (ask + bid) / 2, ask - bid
        mids, spreads = np.concatenate([old[0], mid]), np.concatenate([old[2], spread])
        change = np.diff(mids, prepend=mids[:1])[-n:]
        changes = np.concatenate([old[1], change])
        zero = np.zeros(n)
        out = {"arrival": got["arrival"], "event_no": np.full(n, key[3]), "latest": got["latest"], "spot_price": got["spot_price"],
               "last_price_dollars": got["last_price_dollars"], "yes_mid_dollars": mid, "yes_spread_dollars": spread, "distance_from_strike": got["spot_price"] - got["floor_strike"],
               "yes_mid_change_1s": change, "yes_mid_change_5s": windows(mids, n, BACK + 1, lambda x, axis: x[:, -1] - x[:, 0], zero),
               "yes_mid_change_std_30s": windows(changes, n, SHORT, np.std, zero), "yes_mid_change_std_60s": windows(changes, n, LONG, np.std, zero),
               "yes_spread_mean_30s": windows(spreads, n, SPREADS, np.mean, spread)}
        for state, values, size in ((self.mids, mids, MIDS), (self.changes, changes, CHANGES), (self.spreads, spreads, SPREADS)):
            state.put([(float(v),) for v in values[-size:]])
        for a in range(0, n, FRAME):
            now, opened, closed = (times(v) for v in (got["curr_time"][a:a + FRAME], *(np.full(min(FRAME, n - a), k) for k in key[1:3])))
            yield pd.DataFrame({"coin": key[0], "open_time": opened, "close_time": closed, "curr_time": now, **{c: v[a:a + FRAME] for c, v in out.items()}})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in (self.mids, self.changes, self.spreads):
            state.clear()
        return iter(())

    def close(self) -> None:
        pass


def event_features(messages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """A row per quote with the features of its event (``FEATURES``), the event's number and whether it is the
    coin's latest. ``messages`` (``MESSAGE``): quotes have ``open_time`` and ``close_time``, spot trades ``price``.
    Messages without coin, time or arrival and quotes without bid or ask are left out; messages later than
    ``delay`` behind the newest are late. An event's state goes once that much has passed since its close."""
    known = messages.where("coin is not null and curr_time is not null and arrival is not null")
    known = known.where("(open_time is not null and close_time is not null and yes_ask_dollars is not null and yes_bid_dollars is not null) or (open_time is null and price is not null)")
    packed = known.mapInArrow(to_records, RECORD).withWatermark("curr_time", delay).groupBy("coin", "stretch").transformWithStateInPandas(
        Packing(), PACK, "append", "eventTime", eventTimeColumnName="curr_time")
    named = packed.groupBy("coin").transformWithStateInPandas(
        Numbering(), NUMBERED, "append", "eventTime", eventTimeColumnName="curr_time")
    return named.groupBy("coin", "open_us", "close_us", "event_no").transformWithStateInPandas(Histories(), ROW, "append", "eventTime")


# --- R5
def batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batches written under ``path``."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    named = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("batch_id=")]
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(int(p.getName().split("=")[1]) for p in named if fs.exists(done(p, "_SUCCESS")))


def cross_rows(rows: DataFrame, before: DataFrame | None, coin: str, others: Sequence[str]) -> DataFrame:
    """The rows of ``coin`` with, for each of ``others``, the last row of the event created last (``ETH_...``)
    by arrival, and ``reason``: what is missing, or an empty text. ``before``: rows of earlier batches."""
    at = F.timestamp_micros("arrival").alias("_at")
    seen = rows.where("latest") if before is None else rows.where("latest").unionByName(before)
    rights = [AsofRight(seen.where(F.col("coin") == o).select(at, *[F.col(c).alias(f"{o}_{c}") for c in ("arrival", *FEATURES)]), "_at",
                        [f"{o}_{c}" for c in ("arrival", *FEATURES)]) for o in others]
    out = asof_join(rows.where(F.col("coin") == coin).select("*", at), rights, "_at", bucket_us=BUCKET).drop("_at")
    missing = [F.when(F.col(f"{o}_arrival").isNull(), F.lit(f"no {o} market data yet")) for o in others]
    return out.withColumn("reason", F.coalesce(*missing, F.when(F.col("spot_price").isNull(), F.lit(f"no {coin} spot data yet")), F.lit("")))


def live_sink(out: str, coin: str, others: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """What the stream does with a micro-batch of R4 rows: keep them (``events``), meet them across coins (``cross``),
    keep every coin's newest row for the batches to come (``newest``). Each folder is written by batch id from the
    one before, so a batch that is repeated writes the same."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, f"batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(f"{out}/events/{own}")
        rows = spark.read.schema(ROW).parquet(f"{out}/events/{own}")
        earlier = [b for b in batches(spark, f"{out}/newest") if b < batch_id]
        before = spark.read.schema(ROW).parquet(f"{out}/newest/batch_id={earlier[-1]}") if earlier else None
        cross_rows(rows, before, coin, others).write.mode("overwrite").parquet(f"{out}/cross/{own}")
        newest = rows.where("latest") if before is None else rows.where("latest").unionByName(before)
        newest = newest.groupBy("coin").agg(F.max_by(F.struct(*[c for c in newest.columns if c != "coin"]), "arrival").alias("r")).select("coin", "r.*")
        newest.select(*rows.columns).write.mode("overwrite").parquet(f"{out}/newest/{own}")

    return write


def run_live(messages: DataFrame, out: str, checkpoint: str, coin: str, others: Sequence[str]):
    """Run R4 and R5 over all messages that are there; returns the finished query (its progress). The state is bounded
    by coins and open events, so its partitions do not grow with the messages: every micro-batch visits each of them."""
    stream = event_features(messages).writeStream.outputMode("append").foreachBatch(live_sink(out, coin, others))
    with state_settings(messages.sparkSession, 0):
        query = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query

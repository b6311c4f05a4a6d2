"""Live event features and cross-asset rows (R4, R5) against a plain loop over messages."""

import math
from collections import OrderedDict, deque

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.streaming import jobs, live

OTHERS, START = ("ETH", "XRP"), 1_000_000_800


def messages():
    """Quotes of three coins over events of 40 minutes and spot trades; now and then an event that was dropped."""
    out, n = [], 0
    for m in range(0, 900):
        for j, coin in enumerate(("BTC", *OTHERS)):
            if coin == "XRP" and m < 100:
                continue
            t = START + m * 60 + j
            if (m + j) % 3 == 0:
                out.append((coin, None, None, t, n, None, None, None, None, 100.0 + (m * 7 + j) % 13))
                n += 1
            start = START + m // 40 * 2400
            if m > 500 and m % 97 == 0:  # a few quotes for events long gone
                start -= 24000
            bid = 0.2 + (m * (j + 3) % 29) / 50
            out.append((coin, start, start + 2400, t, n, bid, bid + 0.01 * (1 + m % 4), bid, None if m % 11 == 0 else 101.5, None))
            n += 1
    return out


def frame(spark, rows):
    kinds = live.MESSAGE.replace("open_time timestamp", "open_time long").replace("close_time timestamp", "close_time long").replace("curr_time timestamp", "curr_time long")
    df = spark.createDataFrame(rows, kinds)
    return df.select(*[F.timestamp_seconds(c).alias(c) if c.endswith("_time") else F.col(c) for c in df.columns])


def std(values):
    mean = sum(values) / len(values)
    return math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))


def replay(rows):
    """Rows and cross rows by a loop, one message at a time."""
    coins, spot, newest, got, cross = {}, {}, {}, {}, {}
    for coin, o, c, _, n, last, ask, bid, strike, price in rows:
        if o is None:
            spot[coin] = price
            continue
        events = coins.setdefault(coin, OrderedDict())
        if (o, c) not in events:
            events[o, c] = (deque(maxlen=65), deque(maxlen=61), deque(maxlen=30))
            if len(events) > 8:
                events.popitem(last=False)
        mids, changes, spreads = events[o, c]
        mid, spread = (ask + bid) / 2, ask - bid
        changes.append(mid - mids[-1] if mids else 0.0)
        mids.append(mid)
        spreads.append(spread)
        ch = list(changes)
        got[n] = (last, mid, spread, spot[coin] - strike if coin in spot and strike is not None else None, ch[-1], mids[-1] - mids[-6] if len(mids) >= 6 else 0.0,
                  std(ch[-30:]) if len(ch) >= 30 else 0.0, std(ch[-60:]) if len(ch) >= 60 else 0.0, sum(spreads) / 30 if len(spreads) >= 30 else spread)
        if next(reversed(events)) == (o, c):
            newest[coin] = n
        if coin == "BTC":
            cross[n] = tuple(newest.get(x) for x in OTHERS)
    return got, cross


def values(rows):
    return {r.arrival: tuple(r[c] for c in live.FEATURES) for r in rows}


def close(a, b):
    return a is b is None or (a is not None and b is not None and math.isclose(a, b, abs_tol=1e-9))


def test_stream_equals_a_replay_also_across_a_restart(spark):
    rows = messages()
    src, out, state = (jobs.new_dir(spark, f"live-{x}") for x in ("src", "out", "state"))
    half = len(rows) // 2

    def run():
        stream = spark.readStream.schema(live.MESSAGE).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
        return live.run_live(stream, out, state, "BTC", OTHERS)

    jobs.land_in_order(frame(spark, rows[:half]), f"{src}/one", "arrival", 5, "parquet")
    run()
    jobs.land_in_order(frame(spark, rows[half:]), f"{src}/two", "arrival", 5, "parquet")
    query = run()
    assert len(live.batches(spark, f"{out}/events")) >= 10
    got, want = spark.read.schema(live.ROW).parquet(f"{out}/events").collect(), replay(rows)
    mine = values(got)
    assert mine.keys() == want[0].keys() and len(got) == len(mine)
    for n, row in want[0].items():
        assert all(close(a, b) for a, b in zip(mine[n], row)), (n, mine[n], row)
    cross = spark.read.parquet(f"{out}/cross").collect()
    assert {r.arrival: tuple(r[f"{o}_arrival"] for o in OTHERS) for r in cross} == want[1]
    by_no = {r.arrival: r for r in cross}
    assert by_no[min(by_no)].reason == "no ETH market data yet" and {r.reason for r in cross} >= {"no XRP market data yet", ""}
    for r in cross:
        for o in OTHERS:
            if r[f"{o}_arrival"] is not None:
                assert all(close(r[f"{o}_{c}"], v) for c, v in zip(live.FEATURES, want[0][r[f"{o}_arrival"]]))
    # closed events leave: far fewer histories than events times coins
    totals = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    assert totals and max(totals) < 100
    # a batch that is repeated writes the same
    batch = live.batches(spark, f"{out}/events")[5]
    before = sorted(map(str, spark.read.parquet(f"{out}/cross/batch_id={batch}").collect()))
    kept = spark.createDataFrame(
        spark.read.schema(live.ROW).parquet(f"{out}/events/batch_id={batch}").collect(), live.ROW)
    live.live_sink(out, "BTC", OTHERS)(kept, batch)
    assert sorted(map(str, spark.read.parquet(f"{out}/cross/batch_id={batch}").collect())) == before


def test_runs_in_a_session_with_the_default_state_store(spark):
    provider, default = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    rows, before = messages()[:300], spark.conf.get(provider)
    src, out, state = (jobs.new_dir(spark, f"live-default-{x}") for x in ("src", "out", "state"))
    jobs.land_in_order(frame(spark, rows), src, "arrival", 2, "parquet")
    spark.conf.set(provider, default)
    try:
        live.run_live(spark.readStream.schema(live.MESSAGE).option("maxFilesPerTrigger", 1).parquet(src), out, state, "BTC", OTHERS)
        assert spark.conf.get(provider) == default  # the session's own setting stays
    finally:
        spark.conf.set(provider, before)
    got = spark.read.schema(live.ROW).parquet(f"{out}/events").collect()
    assert values(got).keys() == replay(rows)[0].keys()


def test_state_partitions_follow_the_cores_however_many_messages(spark, monkeypatch, tmp_path):
    """F1: every micro-batch visits each state partition, and the state is bounded: r4_event_state starts with as many
    as there are cores. A micro-batch may be several files."""
    from tidemark.plans import catalog_stream as streams
    from tidemark.sources import testviews as tv
    from tidemark.session import PARTITIONS
    kinds = ("click", "view", "purchase", "signup", "error")
    events = [(i, i * 1700 + i % 7, i % 11, kinds[i * 3 % 5], float(i % 17) if i % 19 else None, '{"k": %d}' % (i % 60)) for i in range(600)]
    spark.createDataFrame(events, "event_id long, s long, user_id long, event_type string, value double, props string").selectExpr(
        "event_id", "timestamp_seconds(1704067200 + s) AS ts", "user_id", "event_type", "value", "props").write.parquet(f"{tmp_path}/events.parquet")
    started = []
    monkeypatch.setattr(jobs, "STATE_ROWS", 10)
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 300)
    monkeypatch.setattr(streams, "LIVE_FILE_ROWS", 100, raising=False)
    monkeypatch.setattr(live, "run_live", lambda *a, run=live.run_live: started.append(run(*a)))
    got = streams.r4_event_state(spark, str(tmp_path)).collect()
    ran = [p for p in started[0].recentProgress if p["stateOperators"]]
    assert {op["numShufflePartitions"] for p in ran for op in p["stateOperators"]} == {min(int(spark.conf.get(PARTITIONS)), spark.sparkContext.defaultParallelism)}
    sizes = [p["numInputRows"] for p in ran if p["numInputRows"]]
    quotes = tv.quotes(spark, str(tmp_path)).where("coin <> 'DOGE'").collect()
    spot = tv.trades(spark, str(tmp_path)).where("product_id <> 'DOGE-USD' and price is not null").collect()
    assert sum(sizes) == len(quotes) + len(spot) and 3 <= len(sizes) <= 5
    rows = [(q.curr_time, 1, q.id, q.coin, q.open_time, q.close_time, q.last_price_dollars, q.yes_ask_dollars, q.yes_bid_dollars, q.floor_strike, None) for q in quotes]
    rows += [(t.trade_time, 0, t.id, t.product_id.removesuffix("-USD"), None, None, None, None, None, None, t.price) for t in spot]
    want = replay([(r[3], r[4], r[5], r[0], n, *r[6:]) for n, r in enumerate(sorted(rows, key=lambda r: r[:3]))])[0]
    mine = values(got)
    assert mine.keys() == want.keys() and len(got) == len(mine)
    for n, row in want.items():
        assert all((a is None and b is None) or math.isclose(a, b, abs_tol=2e-6) for a, b in zip(mine[n], row)), (n, mine[n], row)


class Held:
    """A value or list state without a store."""

    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v

    put = update


class Handle:
    def __init__(self):
        self.timers, self.getValueState, self.getListState = [], lambda *a: Held(), lambda *a: Held()
        self.registerTimer = self.timers.append


def processed(rows, cuts):
    """Features by arrival of one coin's messages, which come in micro-batches cut at ``cuts``, each in any order."""
    numbering, histories, out = live.Numbering(), {}, []
    numbering.init(Handle())
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        records = np.zeros(b - a, live.SENT)
        for i, (_, o, c, t, n, last, ask, bid, strike, price) in enumerate(rows[a:b]):
            records[i] = (n, t, o or 0, c or 0, *(math.nan if v is None else v for v in (last, ask, bid, strike, price)), o is not None)
        records = np.random.default_rng(a).permutation(records)
        sent = iter([pd.DataFrame({"records": [r.tobytes() for r in part]}) for part in np.array_split(records, 3)])
        named = list(numbering.handleInputRows(("BTC",), sent, None))
        for key, pdf in pd.concat(named, ignore_index=True).groupby(["coin", "open_us", "close_us", "event_no"], sort=False) if named else ():
            if key not in histories:
                histories[key] = live.Histories()
                histories[key].init(Handle())
            out += histories[key].handleInputRows(key, iter([pdf]), None)
            assert histories[key].handle.timers == [key[2] // 1000]
    assert max(map(len, out)) <= live.FRAME
    out = pd.concat(out, ignore_index=True).sort_values("arrival", ignore_index=True)
    return out.astype({c: float for c in live.FEATURES})


def test_long_micro_batches_give_the_rows_of_short_ones():
    """more quotes of an event than are given, or looked at, at once."""
    hour, rows = 3_600_000_000, []
    for i in range(2 * live.FRAME + live.BLOCK + 77):
        start, t = (i // 25_000 + (i % 500 == 3)) * hour, i * 1000
        bid = 0.2 + i * 7 % 29 / 50
        rows.append(("BTC", None, None, t, i, None, None, None, None, 100.0 + i % 13) if i % 5 == 0 else
                    ("BTC", hour + start, 2 * hour + start, t, i, bid, bid + 0.01 * (1 + i % 4), bid, None if i % 11 == 0 else 101.5, None))
    whole, parts = processed(rows, []), processed(rows, [1, 2, 40, 7_000, 30_001])
    pd.testing.assert_frame_equal(whole, parts, rtol=0, atol=1e-12)
    want = replay(rows)[0]
    assert whole["arrival"].tolist() == sorted(want)
    assert np.allclose(whole[list(live.FEATURES)].to_numpy(), np.array([want[n] for n in whole["arrival"]], dtype=float), rtol=0, atol=1e-9, equal_nan=True)


def test_late_messages_are_left_out_one_by_one(spark):
    """Messages beside a late one stay, whatever row they are put in; it is counted."""
    hour, src = 3600, jobs.new_dir(spark, "live-late")
    quote = lambda t, n: ("BTC", t - 100, t + 100_000, t, n, 0.5, 0.5, 0.4, 100.0, None)
    rows = [quote(START + h * hour, n) for n, h in enumerate((0, 10, 11, 5, 12))]
    for i, part in enumerate((rows[:2], rows[2:])):
        frame(spark, part).coalesce(1).write.parquet(f"{src}/{i}")
        query = live.run_live(spark.readStream.schema(live.MESSAGE).option("maxFilesPerTrigger", 1).parquet(f"{src}/*"),
                              f"{src}-out", f"{src}-state", "BTC", OTHERS)
    assert sorted(values(spark.read.schema(live.ROW).parquet(f"{src}-out/events").collect())) == [0, 1, 2, 4]
    assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 1

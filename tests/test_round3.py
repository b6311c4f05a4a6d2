"""Appends that are whole or not there (S6), the closed-lot log (S7), settlement on arrival (R9), date prefixes."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import market
from tidemark.operators import ledger
from tidemark.sources import io
from tidemark.streaming import jobs

LOTS = "ticker long, side string, time timestamp, order_key long, line_no long, portfolio long, price double, contracts double"


def test_failed_batch_is_held_back_and_its_retry_adds_nothing(spark):
    path, schema = jobs.new_dir(spark, "s6-test"), "a long, b string"
    df = spark.createDataFrame([(1, "x"), (2, None)], schema)
    assert io.read_appended(spark, path, schema).count() == 0 and io.held_back(spark, path, schema).count() == 0
    assert io.append_batch(df, path, ["a", "b"], 0)
    # a writer that dies between its part files and the manifest
    io.write_csv(df.select("a", "b"), f"{path}/data/batch=1")
    assert io.read_appended(spark, path, schema).count() == 2
    assert [tuple(r) for r in io.held_back(spark, path, schema).collect()] == [(1, 2)]
    # a writer whose tasks fail
    broken = df.withColumn("b", F.raise_error(F.lit("injected")).cast("string"))
    with pytest.raises(Exception, match="injected"):
        io.append_batch(broken, path, ["a", "b"], 2)
    assert io.read_appended(spark, path, schema).count() == 2
    assert io.append_batch(df, path, ["a", "b"], 1) and not io.append_batch(df, path, ["a", "b"], 1) and not io.append_batch(df, path, ["a", "b"], 0)
    assert sorted(r.a for r in io.read_appended(spark, path, schema).collect()) == [1, 1, 2, 2]
    assert io.held_back(spark, path, schema).count() == 0
    assert sorted(tuple(r) for r in io.committed(spark, path).select("batch", "n_rows").collect()) == [(0, 2), (1, 2)]


@pytest.mark.parametrize("files", [1, 4])
def test_settlement_on_arrival_closes_each_lot_once(spark, files):
    lots = spark.createDataFrame([(t, s, None, t * 10 + i, i, 1, 0.30 + 0.01 * i, 2.0 + i) for t in range(1, 9) for i, s in enumerate(["yes", "no", "yes"])], LOTS)
    outcomes = spark.createDataFrame([(t, "yes" if t % 2 else "no") for t in range(1, 7)] + [(2, "no"), (5, "yes"), (99, "yes")], "ticker long, result string")
    landed, log, state, kept = (jobs.new_dir(spark, f"r9-{x}") for x in ("o", "log", "state", "lots"))
    lots.write.parquet(kept)
    outcomes.repartition(files).write.parquet(landed)
    stream = spark.readStream.schema(outcomes.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    got = jobs.run_settlement(stream, spark.read.parquet(kept), log, state).collect()
    want = ledger.settle(lots, outcomes.distinct()).select(*jobs.LOT_COLUMNS).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    # a replayed batch, and one with results that are known, change nothing
    close = jobs.settle_arrivals(spark.read.parquet(kept), log)
    close(outcomes, 0)
    close(outcomes, 1000)
    assert sorted(map(str, io.read_appended(spark, log, jobs.LOT_SCHEMA).collect())) == sorted(map(str, want))


def test_closed_lots_are_logged_at_four_decimals(spark):
    path = jobs.new_dir(spark, "s7-test")
    lots = spark.createDataFrame([(1, 0.123456, -1.00005)], "ticker long, price double, pnl double")
    io.append_closed_lots(lots, path, ["ticker", "price", "pnl"], 3)
    assert [tuple(r) for r in io.read_appended(spark, path, "ticker long, price double, pnl double").collect()] == [(1, 0.1235, -1.0001)]


def test_date_prefixes_are_ranges(spark):
    times = ["1995-12-31 23:59:59", "1996-01-01 00:00:00", "1996-02-29 12:00:00", "1996-03-01 00:00:00", "1996-03-31 23:59:59.999999", "1996-04-01 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").withColumn("time", F.to_timestamp("t"))
    for prefix in ("1996", "1996-03", "1996-02-29"):
        got = {r.t for r in df.where(market.date_prefix("time", prefix)).collect()}
        assert got == {t for t in times if t and t.startswith(prefix)}


def test_fill_reads_a_group_once(spark):
    """W4 (F1-F6, F14-F20): the backward fill is the group's first known value; no frame starts at each row."""
    from tidemark.operators.clean import fill_within
    known = {"a": {3: 1.0, 5: 2.0}, "b": {}, "c": {0: 7.0}, None: {1: 4.0}}
    rows = [(g, t, known[g].get(t)) for g in known for t in range(8)]
    df = fill_within(spark.createDataFrame(rows, "g string, t long, x double"), "x", ["g"], ["t"])
    want = {}
    for g, t, _ in rows:
        past, future = [v for k, v in known[g].items() if k <= t], [v for k, v in known[g].items() if k > t]
        want[g, t] = past[-1] if past else future[0] if future else None
    assert {(r.g, r.t): r.x for r in df.collect()} == want
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedfollowing" in plan and "currentrow$(), unboundedfollowing$()" not in plan


def test_micro_batches_do_not_grow_with_the_table(spark):
    """Small tables make batches of the asked rows, larger ones larger batches, bounded in rows."""
    assert [jobs.batches_for(spark.range(n), 2_500) for n in (0, 2_500, 2_501, 40_000)] == [1, 1, 2, 16]
    assert jobs.batches_for(spark.range(3_000_000), 2_500) == 16
    assert jobs.batches_for(spark.range(3_000_000), 2_500, most=100_000) == 30


def test_book_is_dealt_out_by_snapshot_once(spark, tmp_path, monkeypatch):
    """Parts of a fixed number of rows, and no second shuffle for grouping, walk and join by snapshot."""
    from tidemark.operators import book as bk
    from tidemark.sources import testviews as tv
    lines = [(None if i % 50 == 49 else i // 5, "O" if i % 2 else "F", 1000.5 + i % 4, float(1 + i % 3)) for i in range(200)]
    spark.createDataFrame(lines, "l_orderkey long, l_linestatus string, l_extendedprice double, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(tv, "BOOK_ROWS", 10)
    levels = tv.book(spark, str(tmp_path))
    assert levels.rdd.getNumPartitions() == 20
    want = {}
    for key, status, price, n in lines:
        level = (key, "yes" if status == "O" else "no", (1 + int(price) % 48) / 100)
        want[level] = want.get(level, 0.0) + n
    assert {(r.snapshot_id, r.side, r.price): r.size for r in levels.collect()} == want
    held = levels.select("snapshot_id").distinct().withColumn("contracts", F.lit(2))
    plan = bk.sell_walk(levels, "yes", held.hint("merge"))._jdf.queryExecution().executedPlan().toString()
    assert set(part.split("]")[0].rsplit(" ", 1)[-1] for part in plan.split("Exchange hashpartitioning")[1:]) and "SinglePartition" not in plan
    assert plan.count("Exchange hashpartitioning") == plan.count("REPARTITION_BY_NUM")


def test_state_partitions_follow_the_rows_not_the_shuffle_setting(spark, monkeypatch):
    """a stream's state is in as many partitions as there are cores until its rows ask for more; the session
    keeps its own settings."""
    from tidemark.session import PARTITIONS, ROCKSDB, STATE_PROVIDER
    before, cores = {k: spark.conf.get(k) for k in (PARTITIONS, STATE_PROVIDER)}, spark.sparkContext.defaultParallelism
    src = jobs.new_dir(spark, "state-src")
    jobs.land_in_order(spark.range(40).select("id", F.concat(F.lit('{"type": "match", "trade_id": '), (F.col("id") % 30).cast("string"),
                       F.lit(', "time": "2024-01-01T00:00:00Z"}')).alias("raw")), src, "id", 2)
    spark.conf.set(PARTITIONS, "200")
    try:
        with jobs.state_settings(spark, 10 * jobs.STATE_ROWS * cores):
            assert int(spark.conf.get(PARTITIONS)) == 10 * cores and spark.conf.get(STATE_PROVIDER) == ROCKSDB
        started = []
        monkeypatch.setattr(jobs, "batch_sink", lambda out, sink=jobs.batch_sink: lambda df, i: (started.append(df.sparkSession.conf.get(PARTITIONS)), sink(out)(df, i)))
        out = jobs.run_available_now(jobs.dedupe_stream(jobs.typed_trade_stream(spark, src, max_files=1)), spark, "state-test", rows=40)
        assert len(started) == 2 and {int(n) for n in started} == {cores}
        assert spark.conf.get(PARTITIONS) == "200" and spark.conf.get(STATE_PROVIDER) == before[STATE_PROVIDER]
    finally:
        spark.conf.set(PARTITIONS, before[PARTITIONS])
    assert sorted(r.trade_id for r in jobs.read_batches(spark, out, "trade_id long").collect()) == list(range(30))


def test_cash_events_come_from_one_pass(spark):
    """fills and settlements from one run over the positions: fills are dealt out once, and an outcome that comes
    twice pays twice, one without a ticker or side never."""
    fills = [(i, t, s, a, 0.4, n) for i, (t, s, a, n) in enumerate([
        (1, "yes", "buy", 3.0), (1, "yes", "sell", 2.0), (1, "no", "buy", 4.0), (2, "no", "buy", 5.0), (None, "yes", "buy", 1.0), (3, "no", "sell", 2.0), (4, "yes", "buy", 6.0)])]
    df = spark.createDataFrame(fills, "order_key long, ticker long, side string, action string, price double, contracts double").withColumn("time", F.timestamp_seconds(F.col("order_key")))
    outcomes = spark.createDataFrame([(1, "yes"), (2, "no"), (2, "no"), (2, "yes"), (None, "yes"), (3, None), (4, "no")], "ticker long, result string")
    got = ledger.cash_events(df, outcomes, ["time", "order_key", "ticker"])
    assert got.columns == ["time", "kind", "order_key", "ticker", "side", "cash"]
    paid = sorted((r.order_key, r.ticker, r.side, r.cash, r.time.timestamp()) for r in got.where("kind = 1").collect())
    month = 30 * 86_400.0
    assert paid == [(0, 1, "yes", 1.0, month), (3, 2, "no", 5.0, month + 3), (3, 2, "no", 5.0, month + 3)]
    fee = 0.02  # ceil(7 x 0.4 x 0.6) cents
    cash = {r.order_key: round(r.cash, 9) for r in got.where("kind = 0").collect()}
    assert cash == {0: -1.26, 1: round(2 * (0.4 - fee), 9), 2: -1.68, 3: -2.1, 4: -0.42, 5: 0.0, 6: -2.52}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2


def test_candidates_do_not_plan_their_scans_again(spark, tmp_path):
    """the few rows of lags are written once; the last stage does not hold the operators of all that led to them."""
    from tidemark.plans import catalog_more
    kinds = ["click", "view", "purchase", "signup"]
    rows = [(i, i * 1800, i % 7, kinds[i % 4], float((i * 37) % 101), '{"k": 5}') for i in range(600)] + [(600, None, None, None, None, None)]
    (spark.createDataFrame(rows, "event_id long, s long, user_id long, event_type string, value double, props string")
     .select("event_id", F.timestamp_seconds("s").alias("ts"), "user_id", "event_type", "value", "props").write.parquet(f"{tmp_path}/events.parquet"))
    got = catalog_more.x4_candidates(spark, str(tmp_path))
    assert not any("events.parquet" in f for f in got.inputFiles())
    lags = {(r.coin, r.kind): r.lags for r in catalog_more.x3_visible_lags(spark, str(tmp_path)).collect()}
    found = {(r.coin, r.family, r.p, r.d, r.q, r.sp, r.sq, r.period) for r in got.collect()}
    assert {c for c, _ in lags} == {"BTC", "ETH", "XRP", "SOL"}
    for c in ("BTC", "ETH", "XRP", "SOL"):
        assert {f[2] for f in found if f[:2] == (c, "AR")} == set(lags[c, "ar"]) and {f[4] for f in found if f[:2] == (c, "MA")} == set(lags[c, "ma"])
        assert {(f[2], f[4]) for f in found if f[:2] == (c, "ARIMA")} == {(a, m) for a in lags[c, "ar"][:3] for m in lags[c, "arima_ma"][:3]}
        assert {f[7] for f in found if f[:2] == (c, "SARMA")} == set(lags[c, "seasonal"])

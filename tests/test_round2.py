"""Average entry, feed messages, streams over many batches, models: against brute force and planted cases."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.ml import models as md
from tidemark.operators import ledger as lg
from tidemark.operators import parse as ps
from tidemark.operators import tradesheet as sheet
from tidemark.operators import walkforward as wf
from tidemark.operators.ordering import dense_index
from tidemark.session import ensure_checkpoint_dir
from tidemark.streaming import jobs

ORDER = ["time", "ticker"]
FILL = "time long, ticker long, side string, action string, price double, contracts double"


def fold(fills):
    """Held contracts and average entry after each fill, one by one."""
    held, avg, out = 0.0, None, []
    for _, _, _, action, price, n in fills:
        if action == "buy":
            avg = ((avg or 0.0) * held + price * n) / (held + n)
            held += n
        else:
            held = max(0.0, held - n)
            avg = avg if held > 0 else None
        out.append((held, avg))
    return out


def test_average_entry_of_a_partial_sell(spark):
    rows = [(1, 1, "yes", "buy", .60, 2.0), (2, 1, "yes", "sell", .70, 1.0), (3, 1, "yes", "buy", .30, 1.0)]
    last = lg.positions(spark.createDataFrame(rows, FILL), ORDER).first()
    assert last.contracts == 2 and abs(last.avg_price - 0.45) < 1e-12


def test_average_entry_against_a_fold(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for ticker in range(500):
        mine = [(t, ticker, "yes", rng.choice(["buy", "buy", "sell"]), rng.randrange(5, 95) / 100, float(rng.randrange(1, 9))) for t in range(rng.randrange(1, 25))]
        rows += mine
        want |= {(ticker, t): x for (t, *_), x in zip(mine, fold(mine), strict=True)}
    long = [(t, 1000, "no", "sell" if t % 3 == 2 else "buy", rng.randrange(5, 95) / 100, 6.0 if t % 3 == 2 else 4.0) for t in range(9000)]  # never flat
    rows += long
    want |= {(1000, t): x for (t, *_), x in zip(long, fold(long), strict=True)}
    got = lg.running_position(spark.createDataFrame(rows, FILL), ORDER).collect()
    assert len(got) == len(rows)
    for r in got:
        held, avg = want[r.ticker, r.time]
        assert abs(r.held - held) < 1e-9 and (r.avg_price is None) == (avg is None)
        assert avg is None or abs(r.avg_price - avg) < 1e-9


def test_admission_releases_at_the_average_entry(spark):
    rows = [(1, 1, "yes", "buy", .70, 10.0, 1), (2, 1, "yes", "sell", .10, 10.0, 1), (3, 1, "yes", "sell", .10, 5.0, 1), (4, 2, "no", "buy", .50, 999.0, 1)]
    got = lg.admission_fold(spark.createDataFrame(rows, FILL + ", portfolio long"), "portfolio", ORDER).orderBy("time").collect()
    assert [(r.admitted, round(r.exposure_after, 9)) for r in got] == [(10, 7.0), (10, 0.0), (0, 0.0), (200, 100.0)]


def test_limit_check_reasons(spark):
    signals = spark.createDataFrame([(1, t, p, n) for t, p, n in [(1, .5, 0), (2, .5, 10), (1, .5, 100), (1, .5, 10)]] + [(2, 9, .5, 10)], "portfolio long, ticker long, price double, contracts long")
    state = spark.createDataFrame([(1, 20.0, 4, 60.0)], "portfolio long, exposure double, open_markets long, limit double")
    held = spark.createDataFrame([(1, 1)], "portfolio long, ticker long")
    got = {(r.portfolio, r.ticker, r.contracts): (r.reason, r.capped) for r in lg.limit_check(signals, state, held).collect()}
    assert got == {(1, 1, 0): ("non_positive", 0), (1, 2, 10): ("market_cap", 10), (1, 1, 100): ("exposure", 80), (1, 1, 10): ("ok", 10), (2, 9, 10): ("ok", 10)}


def raw(spark, *messages):
    return spark.createDataFrame([(i, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)], "id long, raw string")


def test_feed_messages_with_texts_bad_values_and_gaps(spark):
    book = {"market_ticker": "T", "market_id": "m", "ts_ms": "12.9", "yes_dollars_fp": [["0.41", "10.5"], ["bad", "1"], ["0.3"], [0.2, 7]], "no_dollars_fp": None}
    got = ps.explode_book(raw(spark, book, "broken {", {"market_ticker": "U"})).collect()
    assert [(r.ticker, r.ts_ms, r.side, r.level, r.price, r.delta_size) for r in got] == [("T", 12, "yes", 0, 0.41, 10.5), ("T", 12, "yes", 3, 0.2, 7.0)]
    delta = {"market_ticker": "T", "price_dollars": "0.55", "delta_fp": "-3.5", "side": "no", "ts_ms": 5}
    bad = [{**delta, "price_dollars": "x"}, {**delta, "side": "maybe"}, {k: v for k, v in delta.items() if k != "delta_fp"}, {**delta, "market_ticker": None}]
    assert [(r.price, r.delta_size, r.ts_ms) for r in ps.parse_deltas(raw(spark, delta, *bad)).collect()] == [(0.55, -3.5, 5)]
    trade = {"trade_id": "a", "market_ticker": "T", "yes_price_dollars": "0.6", "no_price_dollars": 0.4, "count_fp": "2.5", "taker_outcome_side": "", "taker_side": "yes"}
    r, = ps.parse_contract_trades(raw(spark, trade, {**trade, "trade_id": ""})).collect()
    assert (r.yes_price, r.no_price, r["count"], r.taker_outcome_side, r.taker_book_side) == (0.6, 0.4, 2.5, "yes", None)
    order = {"fill_count_fp": "4.0", "remaining_count_fp": "1", "taker_fill_cost_dollars": "1.0", "maker_fill_cost_dollars": "0.6", "taker_fees_dollars": "0.02", "maker_fees_dollars": "0.02", "status": "executed", "order_id": "z"}
    got = ps.parse_order_response(raw(spark, {"order": order}, order, {})).collect()
    assert [tuple(r)[1:] for r in got] == [(4, 1, 0.4, 0.01, "executed", "z")] * 2 + [(0, 0, 0.0, 0.0, "unknown", "")]


def test_sequence_gaps_over_many_batches_equal_one_pass(spark):
    rng = random.Random(3)
    rows, seq = [], {"A": 0, "B": 0}
    for i in range(26_000):
        p = "A" if rng.random() < .95 else "B"
        seq[p] += rng.choice([1, 1, 1, 2, 5, 0, -3])
        rows.append((i, json.dumps({"type": "match", "trade_id": i, "product_id": p, "price": "1", "size": "1", "sequence": seq[p], "time": "2026-01-01T00:00:00Z", "arrival": i})))
    src = jobs.land_in_order(spark.createDataFrame(rows, "id long, raw string").repartition(5), jobs.new_dir(spark, "gaps"), "id", 5)
    out = jobs.run_available_now(jobs.sequence_gap_alarm(jobs.typed_trade_stream(spark, src, max_files=1)), spark, "gaps")
    got = jobs.read_batches(spark, out, "product_id string, sequence long, arrival long, gap long").collect()
    assert len({r.batch_id for r in got}) == 5 and len(got) == len(rows)
    last, want = {}, {}
    for i, text in rows:
        m = json.loads(text)
        before = last.get(m["product_id"], m["sequence"])
        want[i] = m["sequence"] - before - 1 if m["sequence"] > before else 0
        last[m["product_id"]] = m["sequence"]
    assert {r.arrival: r.gap for r in got} == want
    assert jobs.read_batches(spark, out + "-never", "a long").count() == 0


def test_late_rows_are_counted(spark):
    def rows(ids, day):
        return [(i, json.dumps({"type": "match", "trade_id": i, "product_id": "A", "price": "1", "size": "1", "sequence": i, "time": f"2026-01-{day}T00:00:00Z", "arrival": i})) for i in ids]
    every = rows(range(10), "20") + rows(range(10, 20), "21") + rows(range(20, 25), "01")
    src = jobs.land_in_order(spark.createDataFrame(every, "id long, raw string"), jobs.new_dir(spark, "late"), "id", 5)
    bars = jobs.stream_bars(jobs.typed_trade_stream(spark, src, max_files=1), 3_600_000_000, "1 day")
    out = jobs.run_available_now(bars, spark, "late", mode="update")
    assert jobs.LATE[out] >= 1


def test_posterior_blocks_merge_to_the_same_moments(spark):
    rng = np.random.default_rng(2)
    X, th = rng.normal(size=(40, 3)), rng.normal(size=(23, 4)) * 2
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "row_id long, features array<double>")
    draws = spark.createDataFrame([(i, float(t[0]), t[1:].tolist()) for i, t in enumerate(th)], "draw_id long, intercept double, beta array<double>")
    p = 1 / (1 + np.exp(-(th[:, 0] + X @ th[:, 1:].T)))
    for block in (5, 23, 100):
        got = {r.row_id: (r.p_hat, r.p_std) for r in md.posterior_predictive(df, draws, block_draws=block).collect()}
        assert all(abs(got[i][0] - p[i].mean()) < 1e-12 and abs(got[i][1] - p[i].std()) < 1e-12 for i in range(40))


def test_models_recover_planted_effects(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(1500, 4))
    y = rng.random(1500) < 1 / (1 + np.exp(-(0.5 + 2 * X[:, 0] - X[:, 2])))
    df = spark.createDataFrame([(i, X[i].tolist(), int(y[i])) for i in range(1500)], "row_id long, features array<double>, y int")
    theta = md.newton_logistic(df.withColumn("all", F.array(F.lit(0).cast("long"))), {"m": (1.0, 0)}, "all")["m"]
    fitted = md.logistic_fit(df, 1.0)
    assert np.allclose(theta, [fitted.intercept, *fitted.coefficients.toArray()], atol=2e-3)
    assert abs(theta[1] - 2) < .35 and abs(theta[3] + 1) < .3 and abs(theta[2]) < .2
    curve, best = md.cv_grid(df, [1e-4, 1.0, 1e2], md.tail_split_folds(df, "row_id"))
    rows = {r.C: r for r in curve.collect()}
    assert not rows[1e-4].best and rows[1.0].neg_log_loss > rows[1e-4].neg_log_loss and abs(best[1] - 2) < .4
    assert {r.pos for r in md.fdr_select(df).collect()} >= {0, 2}
    walk = np.cumsum(rng.normal(size=600))
    series = spark.createDataFrame([(i, [float(walk[i]), float(rng.normal())]) for i in range(600)], "row_id long, features array<double>")
    assert md.regression_eval(series, 0).first().r2 > 0.7
    noise = spark.createDataFrame([(i, [float(rng.normal()), float(rng.normal())]) for i in range(600)], "row_id long, features array<double>")
    assert md.regression_eval(noise, 1).first().r2 < 0.1  # no column of the inputs is the label


def test_pacf_of_an_ar1(spark):
    acf = spark.createDataFrame([("a", k, 0.5 ** k) for k in range(1, 8)], "coin string, lag long, acf double")
    got = {r.lag: r.pacf for r in sheet.pacf(acf, "coin").collect()}
    assert abs(got[1] - 0.5) < 1e-12 and all(abs(got[k]) < 1e-12 for k in range(2, 8))


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_dense_index_counts_from_zero(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "x long")
    assert {r.x: r.i for r in dense_index(df, ["x"], name="i").collect()} == {i: i for i in range(101)}


def test_forecasts_use_the_past_alone_and_recover_an_ar2(spark):
    rng = np.random.default_rng(9)
    x = [0.0, 0.0]
    for _ in range(900):
        x.append(5 + 0.6 * x[-1] - 0.3 * x[-2] + rng.normal())
    rows = [("a", i, float(v)) for i, v in enumerate(x)]

    def run(data, **kw):
        m = wf.lag_moments(spark.createDataFrame(data, "k string, t long, x double"), "k", "t", "x", refit_every=(1, 10), **kw)
        return {(r.t, r.p): r for r in wf.forecasts(m, "k", "t", [1, 2], 1).collect()}, {(r.t, r.p): r for r in wf.forecasts(m, "k", "t", [2], 10).collect()}

    each, tenth = run(rows)
    last = each[901, 2]
    assert abs(last.coefs[0] - 0.6) < 0.12 and abs(last.coefs[1] + 0.3) < 0.12 and abs(last.intercept - 5) < 1
    X = np.array([[1, x[t - 1], x[t - 2]] for t in range(901 - wf.FIT_POINTS + 1, 902)])
    want = np.linalg.lstsq(X, np.array(x[901 - wf.FIT_POINTS + 1:902]), rcond=None)[0]
    assert np.allclose([last.intercept, *last.coefs], want, atol=1e-6)
    assert tenth[567, 2].coefs == tenth[560, 2].coefs == each[560, 2].coefs
    chunked, _ = run(rows, chunk_rows=600)
    assert all(abs(chunked[k].predicted - each[k].predicted) < 1e-6 for k in each) and chunked.keys() == each.keys()
    changed, _ = run(rows[:700] + [("a", i, v + 100) for _, i, v in rows[700:]])
    assert all(abs(changed[k].predicted - each[k].predicted) < 1e-5 for k in each if k[0] < 700)

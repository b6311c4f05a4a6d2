"""ARMA fits, walk-forward, selection by PnL and residuals (X7-X10) against plain loops."""

import math

import numpy as np
import pytest

from tidemark.operators import arma
from tidemark.operators import tradesheet as sheet

MODELS = "k string, family string, p long, d long, q long, sp long, sq long, period long"
GRID = [("AR", 1, 0, 0, 0, 0, None), ("AR", 3, 0, 0, 0, 0, None), ("MA", 0, 0, 2, 0, 0, None), ("ARMA", 1, 0, 1, 0, 0, None), ("ARMA", 2, 0, 1, 0, 0, None),
        ("ARIMA", 1, 1, 1, 0, 0, None), ("SARMA", 0, 0, 0, 1, 0, 3), ("SARMA", 0, 0, 0, 0, 1, 2), ("SARMA", 1, 0, 1, 1, 0, 5)]
BAR_S, EVENT_S = 60, 420


def spec(family, p=0, d=0, q=0, sp=0, sq=0, period=0):
    return dict(family=family, p=p, d=d, q=q, sp=sp, sq=sq, period=period)


def simulated(n, phi, theta, seed, c=0.0):
    """Values by lag: phi and theta are dicts of lag and coefficient."""
    rng = np.random.default_rng(seed)
    e, z = rng.normal(size=n + 200), [0.0] * (n + 200)
    for t in range(20, n + 200):
        z[t] = c + e[t] + sum(f * z[t - k] for k, f in phi.items()) + sum(f * e[t - k] for k, f in theta.items())
    return np.array(z[200:])


def prices(n, seed):
    rng, x, out = np.random.default_rng(seed), 0.5, []
    for _ in range(n):
        x = 0.5 + 0.9 * (x - 0.5) + rng.normal() * 0.06
        out.append(min(1.0, max(0.0, x)))
    return out


def market(spark, n=300, keys=("a", "b")):
    rows = []
    for j, k in enumerate(keys):
        for i, x in enumerate(prices(n, j)):
            event = i * BAR_S // EVENT_S * EVENT_S
            rows.append((k, i * BAR_S, event, event + EVENT_S, x, 0.01 + 0.01 * (i % 3)))
    df = spark.createDataFrame(rows, "k string, t long, o long, c long, yes_mid double, yes_spread double")
    df = df.selectExpr("k", "timestamp_seconds(t) time", "timestamp_seconds(o) open_time", "timestamp_seconds(c) close_time", "yes_mid", "yes_spread")
    return arma.numbered(df, "k", ["time", "open_time", "close_time"]), rows


def grid(spark, keys=("a", "b")):
    return spark.createDataFrame([(k, *m) for k in keys for m in GRID], MODELS)


@pytest.mark.parametrize("phi,theta,model", [
    ({}, {1: 0.6}, spec("MA", q=1)), ({1: 0.7}, {1: 0.4}, spec("ARMA", p=1, q=1)), ({5: 0.6}, {}, spec("SARMA", sp=1, period=5)),
    ({1: 0.5, 5: 0.4, 6: -0.2}, {1: 0.3}, spec("SARMA", p=1, q=1, sp=1, period=5)), ({}, {3: -0.5}, spec("SARMA", sq=1, period=3))])
def test_planted_models_are_recovered(phi, theta, model):
    y = np.stack([simulated(20_000, phi, theta, s, 0.2) for s in range(3)])
    mean, c, got_phi, got_theta, z, e = arma.fitted(y, model)
    want_phi, want_theta = ([d.get(k, 0.0) for k in range(1, max([0, *d]) + 1)] for d in (phi, theta))
    assert np.allclose(got_phi, [want_phi] * 3, atol=0.06) and np.allclose(got_theta, [want_theta] * 3, atol=0.06)
    assert np.allclose(e[:, 10:].std(axis=1), 1.0, atol=0.03)


def test_moving_averages_become_invertible():
    got = arma.invertible(np.array([[2.0, 0.0], [0.3, -0.1], [0.0, 4.0]]))
    assert np.allclose(got, [[0.5, 0.0], [0.3, -0.1], [0.0, 0.25]])


def plain_forecast(y, m, steps):
    """One model and origin by loops, from the coefficients of its fit."""
    fit = arma.fitted(np.array([y]), m)
    if fit is None:
        return [None] * steps
    mean, c, phi, theta = float(fit[0][0]), float(fit[1][0]), fit[2][0], fit[3][0]
    z = [b - a for a, b in zip(y, y[1:])] if m["d"] else [v - mean for v in y]
    e = []
    for t in range(len(z)):
        e.append(0.0 if t < len(phi) else z[t] - c - sum(phi[k] * z[t - 1 - k] for k in range(len(phi))) - sum(theta[k] * e[t - 1 - k] for k in range(len(theta)) if t - 1 - k >= 0))
    out, level = [], y[-1]
    for _ in range(steps):
        z.append(c + sum(phi[k] * z[-1 - k] for k in range(len(phi))) + sum(theta[k] * e[-1 - k] for k in range(len(theta))))
        e.append(0.0)
        level += z[-1]
        out.append(min(1.0, max(0.0, level if m["d"] else z[-1] + mean)))
    return out


def plain_walk(y, m, part, window):
    first, end = max(len(y) - part.before_end - part.points, 1), len(y) - part.before_end
    out = {}
    for o in range(first, end, part.every):
        for h, v in enumerate(plain_forecast(y[max(0, o - window):o], m, min(part.every, end - o))):
            out[o + h] = v
    return out


@pytest.mark.parametrize("part", [arma.Part(45, 40, 10), arma.Part(12, 0, 1)])
def test_walk_forward_equals_a_plain_loop(spark, part):
    rows, raw = market(spark)
    got = {(r.k, r.model, r.i): r.predicted for r in arma.walk_forward(rows, "k", "yes_mid", grid(spark), part, 120).collect()}
    names = {r.model: r for r in grid(spark).selectExpr("*").withColumn("model", arma.label(arma.F.col("family"))).collect()}
    assert len(got) == 2 * len(GRID) * part.points
    for k in "ab":
        y = [r[4] for r in raw if r[0] == k]
        for name, m in names.items():
            want = plain_walk(y, m.asDict(), part, 120)
            for i, v in want.items():
                assert got[k, name, i] == pytest.approx(v, abs=1e-9)


def test_walk_forward_does_not_look_ahead(spark):
    part = arma.Part(40, 20, 10)
    rows, _ = market(spark, 200, ("a",))
    changed = rows.withColumn("yes_mid", arma.F.when(arma.F.col("i") >= 160, 1 - arma.F.col("yes_mid")).otherwise(arma.F.col("yes_mid")))
    one, two = ({(r.model, r.i): r.predicted for r in arma.walk_forward(x, "k", "yes_mid", grid(spark, ("a",)), part, 100).collect()} for x in (rows, changed))
    assert all(one[key] == two[key] for key in one if key[1] < 170) and any(one[key] != two[key] for key in one if key[1] >= 170)


def test_short_and_constant_series(spark):
    rows, _ = market(spark, 12, ("a",))
    assert arma.walk_forward(rows, "k", "yes_mid", grid(spark, ("a",)), arma.VALID).count() == 0
    flat = market(spark, 200, ("a",))[0].withColumn("yes_mid", arma.F.lit(0.25))
    got = arma.walk_forward(flat, "k", "yes_mid", grid(spark, ("a",)), arma.Part(20, 0, 10), 100).collect()
    assert got and all(r.predicted == pytest.approx(0.25) for r in got)


def plain_score(raw, forecasts):
    """E13-E15 and the errors for one series and model."""
    err, rows = [], []
    for i, v in forecasts.items():
        err.append(raw[i][4] - v)
        now, nxt = raw[i - 1], raw[i]
        if now[2:4] == nxt[2:4] and now[1] < now[3] and nxt[1] <= nxt[3]:
            ask, no_ask = min(1, max(0, now[4] + now[5] / 2)), 1 - min(1, max(0, now[4] - now[5] / 2))
            bid, no_bid = min(1, max(0, nxt[4] - nxt[5] / 2)), 1 - min(1, max(0, nxt[4] + nxt[5] / 2))
            rows.append((v - now[4], bid - ask, no_bid - no_ask))
    best = None
    for th in sheet.THRESHOLDS:
        pnl = [up if m > 0 else down for m, up, down in rows if abs(m) >= th and m != 0]
        n = len(pnl)
        key = (n / len(rows) >= sheet.MIN_COVERAGE, round(sum(pnl), 9), round(sum(pnl) / n, 9) if n else 0.0, -th)
        best = max(best, key) if best else key
    return best[1], -best[3], sum(abs(x) for x in err) / len(err), math.sqrt(sum(x * x for x in err) / len(err))


def test_selection_is_by_pnl(spark):
    valid, test, window, keep = arma.Part(60, 60, 10), arma.Part(60, 0, 1), 120, 3
    rows, raw = market(spark)
    got = sorted(arma.select_models(rows, "k", "yes_mid", grid(spark), keep, valid, test, window).collect(), key=lambda r: (r.k, r["rank"]))
    specs = {r.model: r.asDict() for r in grid(spark, ("a",)).withColumn("model", arma.label(arma.F.col("family"))).collect()}
    want = []
    for k in "ab":
        mine = [r for r in raw if r[0] == k]
        y = [r[4] for r in mine]
        scores = {m: plain_score(mine, plain_walk(y, s, valid, window)) for m, s in specs.items()}
        order = sorted(scores, key=lambda m: (-scores[m][0], specs[m]["family"], m))
        chosen = set(order[:keep]) | {next(m for m in order if specs[m]["family"] == f) for f in {s["family"] for s in specs.values()}}
        last = {m: plain_score(mine, plain_walk(y, specs[m], test, window)) for m in chosen}
        for place, m in enumerate(sorted(last, key=lambda m: (-last[m][0], specs[m]["family"], m)), 1):
            want.append((k, place, m, order.index(m) + 1, *last[m]))
    assert [(r.k, r["rank"], r.model, r.valid_rank) for r in got] == [w[:4] for w in want]
    for r, w in zip(got, want):
        assert (r.total_gross_pnl, r.threshold, r.mae, r.rmse) == pytest.approx(w[4:], abs=1e-8)


def test_residuals_and_their_histogram(spark):
    rows, raw = market(spark, 300, ("a",))
    table = arma.residual_table(rows, "k", "yes_mid", grid(spark, ("a",)), 40, 150).checkpoint()
    specs = {r.model: r.asDict() for r in grid(spark, ("a",)).withColumn("model", arma.label(arma.F.col("family"))).collect()}
    y = [r[4] for r in raw]
    for name, s in specs.items():
        mine = {r.i: r.residual for r in table.collect() if r.model == name}
        assert max(mine) == 259 and min(mine) >= 110
        # a residual is the error of a forecast one point ahead with the same coefficients
        mean, c, phi, theta, z, _ = arma.fitted(np.array([y[110:260]]), s)
        e = []
        for t in range(z.shape[1]):
            a = phi.shape[1]
            e.append(0.0 if t < a else z[0, t] - c[0] - sum(phi[0, k] * z[0, t - 1 - k] for k in range(a)) - sum(theta[0, k] * e[t - 1 - k] for k in range(theta.shape[1]) if t > k))
        skip = int(s["d"]) + phi.shape[1]
        assert [mine[i] for i in sorted(mine)] == pytest.approx(e[phi.shape[1]:], abs=1e-9) and min(mine) == 110 + skip
    bins = arma.residual_histogram(table.where("model = 'AR(1)'"), "k", 10).collect()
    assert sum(r.n for r in bins) == 149 and {r.bin for r in bins} <= set(range(10))

"""Ledger, book and sweep operators against brute force and the reference's stated goldens."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.market import cents, taker_fee
from tidemark.operators import ledger as lg
from tidemark.operators import evaluate as ev
from tidemark.operators import parse as ps

FILL_SCHEMA = "seq long, ticker long, side string, action string, price double, contracts double"


def fee(p):
    import math
    p = max(0.0, min(1.0, p))
    return math.ceil(7.0 * p * (1.0 - p)) / 100.0


def brute_fifo(fills):
    """Reference-style FIFO: open lots per (ticker, side), sells beyond the holding capped."""
    open_, lots = {}, []
    for seq, t, s, a, p, n in fills:
        q = open_.setdefault((t, s), [])
        if a == "buy":
            q.append([seq, p, n])
            continue
        to_close = min(n, sum(x[2] for x in q))
        while to_close > 0 and q:
            lot = q[0]
            k = min(lot[2], to_close)
            lots.append((t, s, lot[0], seq, k, round(k * (p - lot[1] - fee(lot[1]) - fee(p)), 9)))
            lot[2] -= k
            to_close -= k
            if lot[2] == 0:
                q.pop(0)
    return sorted(lots)


def test_fifo_matches_brute_force(spark):
    rnd = random.Random(11)
    fills = []
    for seq in range(400):
        fills.append((seq, rnd.randint(1, 6), rnd.choice(["yes", "no"]), rnd.choice(["buy", "buy", "sell"]),
                      round(rnd.uniform(0.05, 0.95), 2), float(rnd.randint(1, 9))))
    df = spark.createDataFrame(fills, FILL_SCHEMA)
    got = lg.fifo_lots(df, ["seq"], bucket=4.0).collect()
    got = sorted((r.ticker, r.side, r.entry_seq, r.exit_seq, r.contracts, round(r.pnl, 9)) for r in got)
    assert got == brute_fifo(fills)


def test_position_goldens(spark):
    # buy 2 yes @.60, buy 1 no @.35, sell 1 yes -> yes 1, no 1
    f = spark.createDataFrame([(1, 7, "yes", "buy", 0.60, 2.0), (2, 7, "no", "buy", 0.35, 1.0),
                               (3, 7, "yes", "sell", 0.70, 1.0)], FILL_SCHEMA)
    pos = {(r.side): r.contracts for r in lg.positions(f, ["seq"]).collect()}
    assert pos == {"yes": 1.0, "no": 1.0}
    # hedge: 1 yes @.45 + 1 no @.40 locks +0.15
    h = spark.createDataFrame([(1, 8, "yes", "buy", 0.45, 1.0), (2, 8, "no", "buy", 0.40, 1.0)], FILL_SCHEMA)
    net = lg.net_positions(lg.positions(h, ["seq"]))
    assert net.first().locked_pnl == pytest.approx(0.15)
    assert "locked +0.15" in lg.position_text(net).first().position_text
    # 2 yes @.65 + 2 no @.40 -> net flat, locked -0.10
    g = spark.createDataFrame([(1, 9, "yes", "buy", 0.65, 2.0), (2, 9, "no", "buy", 0.40, 2.0)], FILL_SCHEMA)
    txt = lg.position_text(lg.net_positions(lg.positions(g, ["seq"]))).first().position_text
    assert txt == "2YES@0.65 + 2NO@0.40 → net flat (locked -0.10)"
    # net position: 2 yes + 1 no -> (1, yes)
    k = spark.createDataFrame([(1, 5, "yes", "buy", 0.5, 2.0), (2, 5, "no", "buy", 0.5, 1.0)], FILL_SCHEMA)
    r = lg.net_positions(lg.positions(k, ["seq"])).first()
    assert (r.net_contracts, r.net_side) == (1.0, "yes")


def test_fee_and_cents(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (0.125,), (0.135,)], "p double")
    got = [tuple(r) for r in df.select(taker_fee(F.col("p")), cents(F.col("p"))).collect()]
    assert [g[0] for g in got[:3]] == [0.0, 0.02, 0.0]
    assert [g[1] for g in got] == [1, 50, 99, 12, 14]   # half to even, clamped 1..99


def test_symbol_and_expiry_parse(spark):
    df = spark.createDataFrame([("BTC-25DEC26-100000-C",), ("ETH-27MAR26-x-P",), ("BAD",)], "instrument_name string")
    r = ps.parse_option_symbol(df).collect()
    assert (r[0].sym_currency, r[0].expiry, r[0].strike, r[0].option_type) == ("BTC", "25DEC26", 100000.0, "C")
    assert r[1].strike is None and r[1].expiry_date == dt.datetime(2026, 3, 27)
    assert r[2].expiry is None


def test_grid_matches_brute_force(spark):
    rnd = np.random.default_rng(1)
    n = 400
    p = rnd.uniform(0, 1, n).round(3)
    mid = rnd.uniform(0.02, 0.98, n).round(2)
    std = rnd.uniform(0, 0.5, n).round(3)
    y = rnd.integers(0, 2, n)
    rows = [(float(a), float(b), float(c), int(d), float(b) + 0.01, 1 - float(b) + 0.01) for a, b, c, d in zip(p, mid, std, y)]
    df = spark.createDataFrame(rows, "p_hat double, mid double, p_std double, y long, yes_ask double, no_ask double")
    taus, sigs = ev.GRID_TAUS[:12], ev.GRID_SIGMAS[:12]
    got = {(r.i, r.j): (r.trades, r.total_pnl) for r in ev.threshold_grid(df, taus, sigs).collect()}
    for i, tau in enumerate(taus):
        for j, sig in enumerate(sigs):
            pnl, cnt = 0.0, 0
            for a, b, c, d, ya, na in rows:
                if c < sig and a - b > tau:
                    cnt += 1
                    pnl += (1 - ya - 0.02) if d == 1 else (-ya - 0.02)
                elif c < sig and b - a > tau:
                    cnt += 1
                    pnl += (1 - na - 0.02) if d == 0 else (-na - 0.02)
            t, tp = got[(i, j)]
            assert t == cnt
            assert (tp is None and cnt == 0) or tp == pytest.approx(pnl, abs=1e-9)

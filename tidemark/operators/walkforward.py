"""Autoregressions at every point of long series.

A fit on the trailing ``window`` points needs only sums of products of lags. These are differences of running
sums, so every point of a series gets its moments in one pass over chunks of consecutive rows, whatever the
window. All fits - every origin and order - are then small linear systems, solved in batches in Arrow tasks.
Nothing looks ahead: the moments of an origin hold points up to it. Coefficients are least squares given the
first lags. Models with moving averages, walked forward, are in ``arma``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import dense_index, rolling_in_chunks

MAX_LAG = 7
# Points of a fit, of validation and of the holdout; refit intervals in each; models kept.
FIT_POINTS, VALID_POINTS, TEST_POINTS = 480, 180, 240
VALID_EVERY, TEST_EVERY, KEEP = 10, 1, 6


def lag_moments(series: DataFrame, key: str, order: str, x: str, window: int = FIT_POINTS, refit_every: Sequence[int] = (1,),
                chunk_rows: int = 1 << 18) -> DataFrame:
    """Per point: position ``i``, ``lags`` 0..MAX_LAG of the centred value, the series' ``mean``, and for each
    refit interval r the moments ``m<r>`` at the last origin whose position is a multiple of r: the number of
    complete points, the sums of the lags, and the sums of products of all pairs of lags."""
    means = series.groupBy(F.col(key).alias("_key")).agg(F.avg(x).alias("mean"))
    s = series.select(key, order, x).join(means, F.col(key) == F.col("_key")).select(key, order, "mean", (F.col(x) - F.col("mean")).alias("_v"))
    s = dense_index(s, [order], by=[key], name="i")
    pairs = [(a, b) for a in range(MAX_LAG + 1) for b in range(a, MAX_LAG + 1)]

    def compute(df: DataFrame, w) -> DataFrame:
        df = df.withColumn("lags", F.array(*[F.lag("_v", k).over(w) if k else F.col("_v") for k in range(MAX_LAG + 1)]))
        whole = F.get("lags", MAX_LAG).isNotNull()
        terms = [F.lit(1.0), *[F.get("lags", a) for a in range(MAX_LAG + 1)], *[F.get("lags", a) * F.get("lags", b) for a, b in pairs]]
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        df = df.select("*", *[F.sum(F.when(whole, t).otherwise(0.0)).over(run).alias(f"_c{j}") for j, t in enumerate(terms)])
        df = df.withColumn("_m", F.array(*[F.col(f"_c{j}") - F.coalesce(F.lag(f"_c{j}", window).over(w), F.lit(0.0)) for j in range(len(terms))]))
        return df.select("*", *[F.last(F.when(F.col("i") % r == 0, F.col("_m")), ignorenulls=True).over(run).alias(f"m{r}") for r in refit_every])

    out = rolling_in_chunks(s, [key], "i", window + MAX_LAG + max(refit_every), compute, chunk_rows)
    return out.select(key, order, "i", "mean", "lags", *[f"m{r}" for r in refit_every])


def solve(moments: np.ndarray, p: int) -> np.ndarray:
    """Intercept and p coefficients for each row of moments; nan where there are too few points."""
    lags = MAX_LAG + 1
    place = {}
    for a in range(lags):
        for b in range(a, lags):
            place[a, b] = place[b, a] = 1 + lags + len(place) - sum(1 for u, v in place if u > v)
    n = moments[:, 0]
    A, y = np.zeros((len(moments), p + 1, p + 1)), np.zeros((len(moments), p + 1))
    A[:, 0, 0], y[:, 0] = n, moments[:, 1]
    for a in range(1, p + 1):
        A[:, 0, a] = A[:, a, 0] = moments[:, 1 + a]
        y[:, a] = moments[:, place[0, a]]
        for b in range(1, p + 1):
            A[:, a, b] = moments[:, place[a, b]]
    out = np.full((len(moments), p + 1), np.nan)
    fit = n >= 3 * lags
    scale = np.einsum("ijj->i", A[fit]) if fit.any() else np.empty(0)
    A[fit] += np.eye(p + 1) * (scale * 1e-13)[:, None, None]
    if fit.any():
        out[fit] = np.linalg.solve(A[fit], y[fit][:, :, None])[:, :, 0]
    return out


def forecasts(moments: DataFrame, key: str, order: str, orders: Sequence[int], refit_every: int = 1) -> DataFrame:
    """Per origin and order p the forecast of the next value (``predicted``), null before enough points,
    with the fit's ``intercept`` (of the uncentred value) and ``coefs``."""
    rows = moments.select(key, order, "i", "mean", "lags", F.col(f"m{refit_every}").alias("m"))
    names = rows.select(key, order, "i")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[[m is not None and lag[MAX_LAG] is not None and not np.isnan(lag[MAX_LAG]) for m, lag in zip(pdf["m"], pdf["lags"])]]
            if pdf.empty:
                continue
            m, lags, mean = np.vstack(pdf["m"].to_numpy()), np.vstack(pdf["lags"].to_numpy()).astype(float), pdf["mean"].to_numpy()
            for p in orders:
                c = solve(m, p)
                got = ~np.isnan(c[:, 0])
                ahead = c[:, 0] + (c[:, 1:] * lags[:, :p]).sum(axis=1) + mean
                part = pdf.loc[got, [key, order, "i"]].copy()
                part["p"], part["predicted"] = p, ahead[got]
                part["intercept"] = (c[:, 0] + mean * (1 - c[:, 1:].sum(axis=1)))[got]
                part["coefs"] = [x.tolist() for x in c[got, 1:]]
                yield part

    schema = names.schema.simpleString()[len("struct<"):-1]
    return rows.mapInPandas(run, f"{schema}, p long, predicted double, intercept double, coefs array<double>")

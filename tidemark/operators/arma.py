"""ARMA models by regression (X7), walked forward over a series (X8), chosen by what they earn (X9, Q12), with
the residuals of the winner (X10).

Fits are conditional least squares in two stages: residuals of a long autoregression stand in for the shocks,
then the value is regressed on its lags and on lags of these residuals. A seasonal factor adds its lag and
the sums of its lag and the plain ones, each with a coefficient of its own (not held to be a product). A
moving-average polynomial with roots on the wrong side is replaced by the invertible one with the same
autocorrelations. Models with d = 0 have a mean, others none.

Every origin of every series is a row that carries the points it may see, at most ``FIT_POINTS``. Fits of one model
at many origins are one batch of small linear systems in an Arrow task, and rows are dealt out by series and
origin, so a single series is many tasks. Only the evaluated tail of a series gets such rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import tradesheet
from tidemark.operators.ordering import dense_index, rolling_in_chunks
from tidemark.operators.walkforward import FIT_POINTS, KEEP, TEST_EVERY, TEST_POINTS, VALID_EVERY, VALID_POINTS

# Fixed value: points before validation from which lags are chosen.
TRAIN_POINTS = 480
#: Order of the long autoregression, fits solved at once, and the columns of a model.
LONG, BATCH = 20, 256
SPEC = ("family", "p", "d", "q", "sp", "sq", "period")


@dataclass(frozen=True)
class Part:
    """A stretch of a series to forecast: it ends ``before_end`` points before the end and has ``points``; a model
    is fitted every ``every`` points, counted from its start."""

    points: int
    before_end: int
    every: int


VALID, TEST = Part(VALID_POINTS, TEST_POINTS, VALID_EVERY), Part(TEST_POINTS, 0, TEST_EVERY)


# --- X7: fits
def lags_of(plain: int, seasonal: int, period: int) -> list[int]:
    """Lags of one side of a model with a seasonal factor of degree ``seasonal``."""
    out = set(range(1, plain + 1))
    for k in range(1, seasonal + 1):
        out |= {k * period + j for j in range(plain + 1)}
    return sorted(out)


def regressed(columns: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Least squares per row of ``y`` (fits x points) on ``columns`` of the same shape."""
    x = np.stack(columns, axis=2)
    a = x.transpose(0, 2, 1) @ x
    k = a.shape[1]
    a += np.eye(k) * (1e-12 + 1e-11 * np.trace(a, axis1=1, axis2=2) / k)[:, None, None]
    return np.linalg.solve(a, (x.transpose(0, 2, 1) @ y[:, :, None]))[:, :, 0]


def invertible(theta: np.ndarray) -> np.ndarray:
    """Moving-average coefficients with every root of z^m + theta_1 z^(m-1) + ... inside the unit circle."""
    m = theta.shape[1]
    if not m:
        return theta
    companion = np.zeros((len(theta), m, m))
    companion[:, 0, :] = -theta
    companion[:, np.arange(1, m), np.arange(m - 1)] = 1.0
    roots = np.linalg.eigvals(companion)
    out = theta.copy()
    for i in np.flatnonzero((np.abs(roots) > 1).any(axis=1)):
        r = roots[i]
        outside = np.abs(r) > 1
        r[outside] = 1 / np.conj(r[outside])
        out[i] = np.real(np.poly(r))[1:]
    return out


def residuals(z: np.ndarray, c: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """One-step errors within each row of ``z``; those before the longest lag count as zero."""
    n, a, m = z.shape[1], phi.shape[1], theta.shape[1]
    base = z - c[:, None]
    for k in range(1, a + 1):
        base[:, k:] -= phi[:, k - 1:k] * z[:, :n - k]
    base[:, :a] = 0.0
    if not m:
        return base
    e, back = np.zeros((len(z), n + m)), theta[:, ::-1]
    for t in range(a, n):
        e[:, m + t] = base[:, t] - (back * e[:, t:t + m]).sum(axis=1)
    return e[:, m:]


def fitted(y: np.ndarray, spec: dict) -> tuple[np.ndarray, ...] | None:
    """Fits of one model to each row of ``y``: the mean, the constant, coefficients of lags 1.. of the value and of
    the shocks, the (differenced, centred) values and their residuals; None where there are too few points."""
    period = int(spec["period"] or 0)
    ar, ma = lags_of(spec["p"], spec["sp"], period), lags_of(spec["q"], spec["sq"], period)
    z = np.diff(y, n=spec["d"], axis=1) if spec["d"] else y
    n, long = z.shape[1], LONG if ma else 0
    start = max([0, *ar, *[long + k for k in ma]])
    if n - start < 3 * (1 + len(ar) + len(ma) + long):
        return None
    mean = np.zeros(len(z)) if spec["d"] else z.mean(axis=1)
    z = z - mean[:, None]
    const = [] if spec["d"] else [np.ones((len(z), n - start))]
    shocks = np.zeros_like(z)
    if ma:
        columns = [np.ones((len(z), n - long)), *[z[:, long - k:n - k] for k in range(1, long + 1)]]
        b = regressed(columns, z[:, long:])
        shocks[:, long:] = z[:, long:] - sum(b[:, j:j + 1] * x for j, x in enumerate(columns))
    columns = [*const, *[z[:, start - k:n - k] for k in ar], *[shocks[:, start - k:n - k] for k in ma]]
    b = regressed(columns, z[:, start:])
    c = b[:, 0] if const else np.zeros(len(z))
    phi, theta = np.zeros((len(z), max([0, *ar]))), np.zeros((len(z), max([0, *ma])))
    for j, k in enumerate(ar):
        phi[:, k - 1] = b[:, len(const) + j]
    for j, k in enumerate(ma):
        theta[:, k - 1] = b[:, len(const) + len(ar) + j]
    theta = invertible(theta)
    return mean, c, phi, theta, z, residuals(z, c, phi, theta)


def ahead(y: np.ndarray, fit: tuple[np.ndarray, ...], d: int, steps: int) -> np.ndarray:
    """Forecasts 1 to ``steps`` points after each row of ``y``, each made of the ones before it."""
    mean, c, phi, theta, z, e = fit
    a, m, n = phi.shape[1], theta.shape[1], z.shape[1]
    z = np.concatenate([z, np.zeros((len(z), steps))], axis=1)
    e = np.concatenate([e, np.zeros((len(z), steps))], axis=1)
    for t in range(n, n + steps):
        z[:, t] = c + (phi * z[:, t - a:t][:, ::-1]).sum(axis=1) + (theta * e[:, t - m:t][:, ::-1]).sum(axis=1)
    out = z[:, n:] + mean[:, None]
    for _ in range(d):
        out = np.cumsum(out, axis=1)
    return out + y[:, -1:] if d else out


# --- X8: every origin is a row
def label(family: Column) -> Column:
    """A model's name, from its columns."""
    plain = F.format_string("(%d,%d,%d)", "p", "d", "q")
    return (F.when(family == "AR", F.format_string("AR(%d)", "p")).when(family == "MA", F.format_string("MA(%d)", "q"))
            .when(family == "ARMA", F.format_string("ARMA(%d,%d)", "p", "q")).when(family == "ARIMA", F.concat(F.lit("ARIMA"), plain))
            .otherwise(F.concat(F.lit("SARMA"), plain, F.format_string("x(%d,0,%d,%d)", "sp", "sq", "period"))))


def numbered(series: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``series`` with positions ``i`` from 0 and ``n``, the points of the whole series."""
    rows = dense_index(series, list(order), by=[key], name="i")
    sizes = rows.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    return rows.join(sizes, F.col(key) == F.col("_k")).drop("_k")


def origins(rows: DataFrame, key: str, x: str, part: Part, window: int = FIT_POINTS) -> DataFrame:
    """``key``, ``i`` (the first point to forecast), ``steps``, ``seen`` (the at most ``window`` points before it)
    for each origin of ``part``; ``rows`` as of ``numbered``."""
    first, end = F.greatest(F.col("n") - part.before_end - part.points, F.lit(1)), F.col("n") - part.before_end
    tail = rows.where((F.col("i") >= first - window) & (F.col("i") < end)).select(key, "i", "n", F.col(x).alias("_x"))
    at = F.col("i") + 1
    is_origin = (at >= first) & (at < end) & ((at - first) % part.every == 0)

    def compute(df: DataFrame, w: Window) -> DataFrame:
        return df.withColumn("seen", F.collect_list("_x").over(w.rowsBetween(1 - window, 0))).where(is_origin)

    out = rolling_in_chunks(tail, [key], "i", window, compute, chunk_rows=8 * window)
    return out.select(key, at.alias("i"), F.least(F.lit(part.every), end - at).cast("int").alias("steps"), "seen")


def batches_of(pdf: pd.DataFrame) -> Iterator[tuple[dict, pd.DataFrame, np.ndarray]]:
    """Model, rows and their points as a matrix, for rows (``seen``, ``models``) of equally many points."""
    pairs = pdf.explode("models", ignore_index=True)
    if pairs.empty:
        return
    pairs["_m"], pairs["_n"] = [m["model"] for m in pairs["models"]], [len(s) for s in pairs["seen"]]
    for _, g in pairs.groupby(["_m", "_n"], sort=False):
        for lo in range(0, len(g), BATCH):
            some = g.iloc[lo:lo + BATCH]
            yield some["models"].iloc[0], some, np.vstack(some["seen"].to_numpy()).astype(float)


def met_models(at: DataFrame, key: str, models: DataFrame) -> DataFrame:
    """Rows of origins with ``models``, the named models of their series, dealt out by series and origin."""
    known = models.withColumn("period", F.coalesce("period", F.lit(0))).withColumn("model", label(F.col("family")))
    known = known.groupBy(F.col(key).alias("_k")).agg(F.collect_set(F.struct("model", *SPEC)).alias("models"))  # as many as the grid has
    tasks = int(at.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return at.join(known, F.col(key) == F.col("_k")).drop("_k").repartition(tasks, key, "i")


def walk_forward(rows: DataFrame, key: str, x: str, models: DataFrame, part: Part, window: int = FIT_POINTS) -> DataFrame:
    """``key``, ``family``, ``model``, ``i``, ``step`` and ``predicted``, clipped to [0, 1]: forecasts of all
    points of ``part`` by every model of the series (``models``: ``key`` and the columns of ``SPEC``), each from
    the last origin before it and nothing later. Series too short for a model have no forecasts by it."""
    at = met_models(origins(rows, key, x, part, window), key, models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for spec, some, y in batches_of(pdf):
                fit = fitted(y, spec)
                if fit is None:
                    continue
                steps = some["steps"].to_numpy()
                got = np.clip(ahead(y, fit, spec["d"], int(steps.max())), 0.0, 1.0)
                row, step = np.nonzero(np.arange(got.shape[1])[None, :] < steps[:, None])
                yield pd.DataFrame({key: some[key].to_numpy()[row], "family": spec["family"], "model": spec["model"],
                                    "i": some["i"].to_numpy()[row] + step, "step": step + 1, "predicted": got[row, step]})

    kind = dict(rows.dtypes)[key]
    return at.mapInPandas(run, f"`{key}` {kind}, family string, model string, i long, step long, predicted double")


def fits(rows: DataFrame, key: str, x: str, models: DataFrame, part: Part, window: int = FIT_POINTS) -> DataFrame:
    """``key``, ``family``, ``model``, ``i`` (the first point not seen), ``mean``, ``constant``, ``phi`` and
    ``theta`` (coefficients by lag) and ``sigma`` (of the residuals after the longest lag) at every origin."""
    at = met_models(origins(rows, key, x, part, window), key, models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for spec, some, y in batches_of(pdf):
                fit = fitted(y, spec)
                if fit is None:
                    continue
                mean, c, phi, theta, _, e = fit
                yield pd.DataFrame({key: some[key].to_numpy(), "family": spec["family"], "model": spec["model"], "i": some["i"].to_numpy(), "mean": mean,
                                    "constant": c, "phi": phi.tolist(), "theta": theta.tolist(), "sigma": e[:, phi.shape[1]:].std(axis=1)})

    kind = dict(rows.dtypes)[key]
    return at.mapInPandas(run, f"`{key}` {kind}, family string, model string, i long, mean double, constant double, phi array<double>, theta array<double>, sigma double")


# --- X9: what models earn
def scored(forecasts: DataFrame, rows: DataFrame, key: str, x: str) -> DataFrame:
    """Errors and the best cutoff's figures (E14, E15) per series and model. ``rows``: the market bars (``time``,
    ``open_time``, ``close_time``, ``yes_mid``, ``yes_spread``) as of ``numbered``."""
    by = [key, "family", "model"]
    met = forecasts.join(rows.select(key, "i", "time", F.col(x).alias("_actual")), [key, "i"])
    e = F.col("_actual") - F.col("predicted")
    errors = met.groupBy(*by).agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), F.count(e).alias("n_forecasts"))
    sheet = tradesheet.trade_sheet(rows, met.select(*by, "time", "predicted"), [key])
    return errors.join(tradesheet.best_cutoff(sheet, by=by), by)


def ranked(scores: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``scores`` with the place by total PnL (to nine digits) within ``by``, ties by name."""
    best = Window.partitionBy(*by).orderBy(F.round("total_gross_pnl", 9).desc(), "family", "model")
    return scores.withColumn(name, F.row_number().over(best).cast("long"))


def short_list(valid: DataFrame, key: str, keep: int = KEEP) -> DataFrame:
    """The ``keep`` models that earn most in validation, and the best one of each family."""
    places = ranked(ranked(valid, [key], "_place"), [key, "family"], "_in_family")
    return places.where((F.col("_place") <= keep) | (F.col("_in_family") == 1)).drop("_in_family").withColumnRenamed("_place", "valid_rank")


def select_models(rows: DataFrame, key: str, x: str, models: DataFrame, keep: int = KEEP, valid: Part = VALID, test: Part = TEST,
                  window: int = FIT_POINTS) -> DataFrame:
    """The short list of validation, walked through the holdout and ranked by total PnL there. Tables of scores
    are as small as the grid of models; each is made once."""
    named = models.withColumn("period", F.coalesce("period", F.lit(0))).withColumn("model", label(F.col("family")))
    first = scored(walk_forward(rows, key, x, models, valid, window), rows, key, x).checkpoint()
    chosen = short_list(first, key, keep).select(key, "family", "model", "valid_rank", F.col("total_gross_pnl").alias("valid_gross_pnl"), F.col("mae").alias("valid_mae"))
    grid = named.join(chosen, [key, "family", "model"])
    last = scored(walk_forward(rows, key, x, grid.select(key, *SPEC), test, window), rows, key, x)
    return ranked(last, [key], "rank").join(grid, [key, "family", "model"])


# --- X10: residuals
def residual_table(rows: DataFrame, key: str, x: str, models: DataFrame, before_end: int = TEST_POINTS, window: int = FIT_POINTS) -> DataFrame:
    """``key``, ``model``, ``i``, ``residual`` of each series' model (one or a few per series) fitted to the
    ``window`` points that end ``before_end`` points before the series does; none before the longest lag."""
    seen = rows.where((F.col("i") >= F.col("n") - before_end - window) & (F.col("i") < F.col("n") - before_end))
    seen = seen.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("i", F.col(x).alias("x")))).alias("_s"))  # window points
    both = met_models(seen.select(key, F.get("_s", 0)["i"].alias("i"), F.transform("_s", lambda s: s["x"]).alias("seen")), key, models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for spec, some, y in batches_of(pdf):
                fit = fitted(y, spec)
                if fit is None:
                    continue
                e, skipped = fit[5], spec["d"] + fit[2].shape[1]
                e = e[:, fit[2].shape[1]:]
                yield pd.DataFrame({key: np.repeat(some[key].to_numpy(), e.shape[1]), "model": spec["model"],
                                    "i": (some["i"].to_numpy()[:, None] + skipped + np.arange(e.shape[1])[None, :]).ravel(), "residual": e.ravel()})

    return both.mapInPandas(run, f"`{key}` {dict(rows.dtypes)[key]}, model string, i long, residual double")


def residual_histogram(table: DataFrame, key: str, bins: int = 30) -> DataFrame:
    """Residuals per series in equal bins from the smallest to the largest, which is in the last bin."""
    bounds = table.groupBy(F.col(key).alias("_k")).agg(F.min("residual").alias("_lo"), F.max("residual").alias("_hi"))
    both = table.join(bounds, F.col(key) == F.col("_k"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col("residual") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("long")
    return both.groupBy(key, place.alias("bin")).agg(F.min(F.col("_lo") + place * width).alias("from"), F.count(F.lit(1)).alias("n"))

"""Forecasts against the market: trade sheet (J11, E13), threshold curve (E14) and best cutoff (E15);
lag diagnostics of a series (X2, X3) and the candidate models they lead to (X4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.market import clamp
from tidemark.operators.ordering import dense_index

# Cutoffs on the predicted move, least coverage, longest lag, tried seasonal lags.
THRESHOLDS = (0.00, 0.0025, 0.005, 0.01, 0.02, 0.05, 0.075, 0.10, 0.15, 0.20)
MIN_COVERAGE = 0.01
MAX_LAG = 7
SEASONAL = (2, 3, 5, 7)


def with_previous_row(market: DataFrame, order: Sequence[str], cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Each market row with its predecessor in the global order (``prev_*``), within ``by``; the first row has
    none. Positions come from range partitions, so the whole history is never in one task."""
    numbered = dense_index(market, list(order), by=by, name="_i")
    before = numbered.select(*by, (F.col("_i") + 1).alias("_i"), *[F.col(c).alias(f"prev_{c}") for c in cols])
    return numbered.join(before, [*by, "_i"]).drop("_i")


def trade_sheet(market: DataFrame, forecasts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """J11 + E13: forecasts (``time``, ``predicted``) met with the market row of that time and the row before;
    kept if both belong to the same event and it is still open; bid and ask are mid -+ half spread in [0, 1].

    ``market``: ``time``, ``open_time``, ``close_time``, ``yes_mid``, ``yes_spread``; of rows of one time the
    first by event counts. ``by``: columns of both, if there are several markets. Other columns of the forecasts
    (a model's name) come first in the result."""
    by, cols = list(by), ["time", "open_time", "close_time", "yes_mid", "yes_spread"]
    rows = with_previous_row(market.select(*by, *cols), ["time", "open_time", "close_time"], cols, by)
    same = [*by, "time"]
    first = rows.groupBy(*same).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in same]), F.struct("open_time", "close_time")).alias("r")).select(*same, "r.*")
    x = first.join(forecasts.where(F.col("predicted").isNotNull()), same)
    x = x.where("open_time = prev_open_time and close_time = prev_close_time and prev_time < prev_close_time and time <= close_time")

    def quote(sign: int, mid: str, spread: str) -> Column:
        return clamp(F.col(mid) + sign * F.col(spread) / 2, 0.0, 1.0)

    return x.select(
        *[c for c in forecasts.columns if c not in ("time", "predicted")], "time", F.col("prev_yes_mid").alias("current"), F.col("yes_mid").alias("actual"), "predicted",
        quote(1, "prev_yes_mid", "prev_yes_spread").alias("yes_ask"), (1 - quote(-1, "prev_yes_mid", "prev_yes_spread")).alias("no_ask"),
        quote(-1, "yes_mid", "yes_spread").alias("future_yes_bid"), (1 - quote(1, "yes_mid", "yes_spread")).alias("future_no_bid"))


def threshold_curve(sheet: DataFrame, thresholds: Sequence[float] = THRESHOLDS, by: Sequence[str] = ()) -> DataFrame:
    """For every cutoff, trade the sign of the predicted move where it is at least the cutoff, exit at
    the next bid. Each row meets the few cutoffs by ``explode``; sums are partial, so the output is one row per
    cutoff (and ``by``) whatever the sheet's size. Without trades all figures are 0; without rows there is no curve."""
    move = F.col("predicted") - F.col("current")
    x = sheet.withColumn("_m", move).withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    side = F.when(F.abs("_m") >= F.col("threshold"), F.signum("_m")).otherwise(F.lit(0.0))
    x = x.withColumn("_s", side)
    pnl = F.when(F.col("_s") > 0, F.col("future_yes_bid") - F.col("yes_ask")).when(F.col("_s") < 0, F.col("future_no_bid") - F.col("no_ask"))
    x = x.withColumn("_p", pnl)
    n = F.count(F.lit(1))
    return x.groupBy(*by, "threshold").agg(
        (F.count_if(F.col("_s") != 0) / n).alias("coverage"), F.count_if(F.col("_s") != 0).alias("trade_count"),
        F.count_if(F.col("_s") > 0).alias("yes_trade_count"), F.count_if(F.col("_s") < 0).alias("no_trade_count"),
        F.coalesce(F.avg((F.col("_p") > 0).cast("double")), F.lit(0.0)).alias("hit_rate"),
        F.coalesce(F.avg("_p"), F.lit(0.0)).alias("avg_gross_pnl"), F.coalesce(F.sum("_p"), F.lit(0.0)).alias("total_gross_pnl"))


def best_cutoff(sheet: DataFrame, min_coverage: float = MIN_COVERAGE, nd: int = 9, by: Sequence[str] = ()) -> DataFrame:
    """One row (per ``by``): the cutoff with the largest total, then mean PnL among those covered enough (all,
    if none is), ties to the smaller cutoff; and the share of moved prices whose direction was foreseen. PnL is
    compared after rounding to ``nd`` digits, as sums come in any order."""
    keys = list(by) or ["_k"]
    sheet = sheet if by else sheet.withColumn("_k", F.lit(1))
    curve = threshold_curve(sheet, by=keys)
    rank = F.struct((F.col("coverage") >= min_coverage).alias("e"), F.round("total_gross_pnl", nd).alias("t"), F.round("avg_gross_pnl", nd).alias("a"), (-F.col("threshold")).alias("n"))
    best = curve.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in curve.columns if c not in keys]), rank).alias("b")).select(*keys, "b.*")
    moved = F.col("actual") != F.col("current")
    right = F.signum(F.col("predicted") - F.col("current")) == F.signum(F.col("actual") - F.col("current"))
    accuracy = sheet.groupBy(*keys).agg(F.avg(F.when(moved, right.cast("double"))).alias("directional_accuracy"))
    return best.join(accuracy, keys).drop("_k")


def pacf(acf: DataFrame, key: str) -> DataFrame:
    """Partial autocorrelations from a series' few autocorrelations (``lag``, ``acf``) by the
    Durbin-Levinson recursion, written out as array steps on the key's own row."""
    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)

    def step(state: Column, k: Column) -> Column:
        phi, r = state["phi"], state["r"]
        known = F.slice(r, 1, k - 1)
        f = (F.get(r, k - 1) - dot(phi, F.reverse(known))) / (1 - dot(phi, known))
        return F.transform(F.array(f), lambda f: F.struct(
            r.alias("r"), F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - f * y), F.array(f)).alias("phi"),
            F.concat(state["out"], F.array(f)).alias("out")))[0]

    r = acf.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("lag", "acf"))), lambda e: e["acf"]).alias("r"))
    first = F.array(F.col("r")[0])
    start = F.struct(F.col("r").alias("r"), first.alias("phi"), first.alias("out"))
    out = F.aggregate(F.sequence(F.lit(2), F.size("r")), start, step)["out"]
    return r.select(key, F.posexplode(out).alias("lag", "pacf")).select(key, (F.col("lag") + 1).cast("long").alias("lag"), "pacf")


def largest_visible(table: DataFrame, key: str, value: str, n_obs: DataFrame, n: int) -> DataFrame:
    """Per series the ``n`` largest lags beyond 1.96 / sqrt(observations), lag 1 always among them."""
    t = table.join(n_obs, key).where(F.abs(value) > 1.96 / F.sqrt("n_obs"))
    top = t.groupBy(key).agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.abs(value)).alias("v"), "lag"))), 1, n).alias("x"))
    all_keys = n_obs.select(key)
    lags = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(1).cast("long")), F.coalesce(F.transform("x", lambda e: e["lag"]), F.array().cast("array<bigint>")))))
    return all_keys.join(top, key, "left").select(key, lags.alias("lags"))


def seasonal_lags(acf: DataFrame, key: str, n: int = 2) -> DataFrame:
    """The ``n`` tried seasonal lags with the largest autocorrelation, largest first."""
    t = acf.where(F.col("lag").isin(list(SEASONAL)))
    return t.groupBy(key).agg(F.transform(F.slice(F.sort_array(F.collect_list(F.struct((-F.abs("acf")).alias("v"), "lag"))), 1, n), lambda e: e["lag"]).alias("lags"))


def candidates(key: str, ar: DataFrame, ma: DataFrame, diff_ma: DataFrame, seasonal: DataFrame) -> DataFrame:
    """Distinct candidate models (family, p, d, q, P, Q, period) per series from its few lags."""
    z = F.lit(0).cast("long")

    def rows(df: DataFrame, family: str, p=z, d: int = 0, q=z, sp: int = 0, sq: int = 0, period=None) -> DataFrame:
        return df.select(key, F.lit(family).alias("family"), p.alias("p"), F.lit(d).cast("long").alias("d"), q.alias("q"), F.lit(sp).cast("long").alias("sp"),
                         F.lit(sq).cast("long").alias("sq"), (period if period is not None else F.lit(None).cast("long")).alias("period"))

    def each(df: DataFrame, name: str, n: int | None = None) -> DataFrame:
        return df.select(key, F.explode(F.slice("lags", 1, n) if n else F.col("lags")).alias(name))

    one = F.lit(1).cast("long")
    season = each(seasonal, "s")
    parts = [rows(each(ar, "a"), "AR", p=F.col("a")), rows(each(ma, "m"), "MA", q=F.col("m")),
             rows(each(ar, "a", 3).join(each(ma, "m", 3), key), "ARMA", p=F.col("a"), q=F.col("m")),
             rows(each(ar, "a", 3).join(each(diff_ma, "m", 3), key), "ARIMA", p=F.col("a"), d=1, q=F.col("m")),
             rows(season, "SARMA", sp=1, period=F.col("s")), rows(season, "SARMA", sq=1, period=F.col("s")),
             rows(season, "SARMA", p=one, q=one, sp=1, period=F.col("s"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()

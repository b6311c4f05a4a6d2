"""Classical models of the market's mid price, walked forward and chosen by PnL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import arma
from tidemark.operators import tradesheet as sheet
from tidemark.operators.timeseries import acf, market_bars
from tidemark.plans.catalog_trading import W
from tidemark.registry import register
from tidemark.sources import testviews as tv
from tidemark.sources.testviews import UNIT_US, VIEW_SQL

# Bars of half a unit: the shortest test table that is scored has some 1,100 of them per coin, the split needs 900.
_BIN = UNIT_US // 2
_ORDER = ["time", "open_time", "close_time"]
_VALID, _TEST, _FIT = arma.VALID_POINTS, arma.TEST_POINTS, arma.FIT_POINTS

_ROWS_SQL = f"""{VIEW_SQL["quotes"]},
m AS MATERIALIZED (
  SELECT coin, make_timestamp(CAST(floor(epoch_us(curr_time) / {_BIN}) AS BIGINT) * {_BIN}) AS time, open_time, close_time,
         greatest(0, least(1, avg((yes_ask_dollars + yes_bid_dollars) / 2))) AS x
  FROM quotes WHERE yes_ask_dollars IS NOT NULL AND yes_bid_dollars IS NOT NULL GROUP BY ALL),
o AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY coin ORDER BY time, open_time, close_time) - 1 AS i, count(*) OVER (PARTITION BY coin) AS n FROM m)"""


def _rows(spark, d) -> DataFrame:
    """Market bars of every coin with their positions."""
    q = tv.quotes(spark, d).select(
        "coin", "curr_time", "open_time", "close_time", ((F.col("yes_ask_dollars") + F.col("yes_bid_dollars")) / 2).alias("yes_mid"),
        (F.col("yes_ask_dollars") - F.col("yes_bid_dollars")).alias("yes_spread"))
    return arma.numbered(market_bars(q, _BIN, ["coin"]), "coin", _ORDER)


def _models(rows: DataFrame) -> DataFrame:
    """X1-X4 on the points before validation: candidate models per coin. Tables of lags are a few rows per coin and
    are made once."""
    end = F.col("n") - _TEST - _VALID
    train = rows.where((F.col("i") < end) & (F.col("i") >= end - arma.TRAIN_POINTS)).select("coin", "i", F.col("yes_mid").alias("x"))
    before = train.select("coin", (F.col("i") + 1).alias("i"), F.col("x").alias("_b"))
    steps = train.join(before, ["coin", "i"]).select("coin", "i", (F.col("x") - F.col("_b")).alias("x"))
    level, change = (acf(s, "coin", "i", "x", sheet.MAX_LAG).checkpoint() for s in (train, steps))
    sizes = train.groupBy("coin").agg(F.count(F.lit(1)).alias("n_obs"))
    return sheet.candidates(
        "coin", sheet.largest_visible(sheet.pacf(level, "coin"), "coin", "pacf", sizes, 3), sheet.largest_visible(level, "coin", "acf", sizes, 3),
        sheet.largest_visible(change, "coin", "acf", sizes.withColumn("n_obs", F.col("n_obs") - 1), 2), sheet.seasonal_lags(level, "coin"))


def _ar1(rows: DataFrame) -> DataFrame:
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    return rows.select("coin").distinct().select(
        "coin", F.lit("AR").alias("family"), one.alias("p"), zero.alias("d"), zero.alias("q"), zero.alias("sp"), zero.alias("sq"), zero.alias("period"))


@register("x7_arma_fits", None)
def x7_arma_fits(spark, d):
    """Coefficients of every candidate at every origin of validation."""
    rows = _rows(spark, d)
    return arma.fits(rows, "coin", "yes_mid", _models(rows), arma.VALID)


@register("x8_walk_forward", None)
def x8_walk_forward(spark, d):
    """Forecasts 1 to 10 points ahead of every candidate over validation, none of which sees beyond its origin."""
    rows = _rows(spark, d)
    return arma.walk_forward(rows, "coin", "yes_mid", _models(rows), arma.VALID)


def _ar1_sql(part: arma.Part) -> str:
    first, end = f"(n - {part.before_end + part.points})", f"(n - {part.before_end})"
    return W([_ROWS_SQL, f"""l AS (SELECT *, lag(x) OVER (PARTITION BY coin ORDER BY i) AS x1 FROM o),
f AS (SELECT coin, i + 1 AS o, n, x, regr_slope(x, x1) OVER w AS s, regr_intercept(x, x1) OVER w AS c
      FROM l WINDOW w AS (PARTITION BY coin ORDER BY i ROWS {_FIT - 2} PRECEDING)),
p AS (SELECT *, unnest(range(1, {part.every} + 1)) AS h FROM f WHERE o >= {first} AND o < {end} AND (o - {first}) % {part.every} = 0)"""]) + f"""
SELECT coin, o + h - 1 AS i, h AS step, round(greatest(0, least(1, c * (1 - s ** h) / (1 - s) + s ** h * x)), 6) AS predicted FROM p WHERE o + h - 1 < {end}"""


@register("x8_ar1_validation", _ar1_sql(arma.VALID))
def x8_ar1_validation(spark, d):
    """AR(1) refitted every ten points, in SQL by regression windows and the closed form of its recursion."""
    rows = _rows(spark, d)
    return arma.walk_forward(rows, "coin", "yes_mid", _ar1(rows), arma.VALID).select("coin", "i", "step", F.round("predicted", 6).alias("predicted"))


@register("x8_ar1_holdout", _ar1_sql(arma.TEST))
def x8_ar1_holdout(spark, d):
    """AR(1) refitted at every point of the holdout."""
    rows = _rows(spark, d)
    return arma.walk_forward(rows, "coin", "yes_mid", _ar1(rows), arma.TEST).select("coin", "i", "step", F.round("predicted", 6).alias("predicted"))


@register("x9_model_selection", None)
def x9_model_selection(spark, d):
    """Bars, lags, candidates, walk-forward and PnL in validation, the short list again in the holdout."""
    rows = _rows(spark, d)
    return arma.select_models(rows, "coin", "yes_mid", _models(rows))


def _best_residuals(spark, d) -> DataFrame:
    rows = _rows(spark, d)
    best = arma.select_models(rows, "coin", "yes_mid", _models(rows)).where("rank = 1").select("coin", *arma.SPEC).checkpoint()  # one row per coin
    return arma.residual_table(rows, "coin", "yes_mid", best)


@register("x10_residuals", None)
def x10_residuals(spark, d):
    """Residuals of every coin's best model over the last points before the holdout."""
    return _best_residuals(spark, d)


@register("x10_residual_acf", None)
def x10_residual_acf(spark, d):
    """Autocorrelation of the best model's residuals to lag 26 (ten times the logarithm of 480 points)."""
    return acf(_best_residuals(spark, d), "coin", "i", "residual", 26)


@register("x10_residual_histogram", None)
def x10_residual_histogram(spark, d):
    """The best model's residuals in thirty bins."""
    return arma.residual_histogram(_best_residuals(spark, d).checkpoint(), "coin")


@register("x10_ar1_residuals", W([_ROWS_SQL, f"""w AS (SELECT * FROM o WHERE i < n - {_TEST} AND i >= n - {_TEST + _FIT}),
l AS (SELECT *, lag(x) OVER (PARTITION BY coin ORDER BY i) AS x1 FROM w),
f AS (SELECT coin, regr_slope(x, x1) AS s, regr_intercept(x, x1) AS c FROM l GROUP BY coin)"""]) + """
SELECT l.coin, l.i, round(x - c - s * x1, 6) AS residual FROM l JOIN f ON f.coin = l.coin WHERE x1 IS NOT NULL""")
def x10_ar1_residuals(spark, d):
    """Residuals of AR(1), against a SQL regression."""
    rows = _rows(spark, d)
    return arma.residual_table(rows, "coin", "yes_mid", _ar1(rows)).select("coin", "i", F.round("residual", 6).alias("residual"))

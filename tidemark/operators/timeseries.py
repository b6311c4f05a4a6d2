"""Time-series building blocks (A3, X1): resampled market bars and autocorrelations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.market import clamp
from tidemark.operators.ordering import dense_index, rolling_in_chunks


def market_bars(quotes: DataFrame, bin_us: int, by: Sequence[str] = ()) -> DataFrame:
    """A3: left-closed bins of ``bin_us``: mean mid and spread per (``by``, bin, event); rows missing a
    key field are dropped first, incomplete bars after; mid clipped to [0, 1], spread >= 0."""
    q = quotes.where(F.col("curr_time").isNotNull() & F.col("open_time").isNotNull() & F.col("close_time").isNotNull()
                     & F.col("yes_mid").isNotNull())
    b = F.expr(f"timestamp_micros(floor(unix_micros(curr_time) / {bin_us}) * {bin_us})")
    bars = q.groupBy(*by, b.alias("time"), "open_time", "close_time").agg(F.avg("yes_mid").alias("yes_mid"),
                                                                     F.avg("yes_spread").alias("yes_spread"))
    bars = bars.where(F.col("yes_mid").isNotNull() & F.col("yes_spread").isNotNull())
    return bars.select(*by, "time", "open_time", "close_time", clamp(F.col("yes_mid"), 0.0, 1.0).alias("yes_mid"),
                       F.when(F.col("yes_spread") < 0, F.lit(0.0)).otherwise(F.col("yes_spread")).alias("yes_spread"))


def acf(series: DataFrame, key: str, order: str, x: str, max_lag: int = 7, chunk_rows: int = 1 << 20) -> DataFrame:
    """Autocorrelation at lags 1..max_lag per series: global mean, divisor n (sum of products
    over the available pairs divided by the total sum of squares). The mean is a grouped sum joined back; lags
    run over chunks of consecutive rows, so one long series is many tasks."""
    means = series.groupBy(F.col(key).alias("_key")).agg(F.avg(x).alias("_m"))
    d = series.join(means, F.col(key) == F.col("_key")).select(key, order, (F.col(x) - F.col("_m")).alias("_d"))
    d = dense_index(d, [order], by=[key], name="_i")
    lags = range(1, max_lag + 1)
    d = rolling_in_chunks(d, [key], "_i", max_lag, lambda df, w: df.select("*", *[F.lag("_d", k).over(w).alias(f"_l{k}") for k in lags]), chunk_rows)
    agg = d.groupBy(key).agg(F.sum(F.col("_d") * F.col("_d")).alias("_ss"), *[F.sum(F.col("_d") * F.col(f"_l{k}")).alias(f"_p{k}") for k in lags])
    return agg.select(key, F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("lag"),
                                                         (F.col(f"_p{k}") / F.col("_ss")).alias("acf"))
                                               for k in lags])).alias("a")).select(key, "a.*")

"""Distribution summaries: quantile bands (A5), histograms (A9), live spot windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import dense_index, rolling_in_chunks


def quantile_bands(df: DataFrame, key: str, x: str, qs: dict[str, float]) -> DataFrame:
    """A5: per key, linear median and nearest-rank quantiles (index round((n-1) q), half away from 0).

    Nulls are removed first. Ranking is a window per key (a time-to-close value), which is bounded
    by the number of events.
    """
    d = df.where(F.col(x).isNotNull())
    w = Window.partitionBy(key).orderBy(x)
    d = d.select(key, x, (F.row_number().over(w) - 1).alias("_rn"), F.count(F.lit(1)).over(Window.partitionBy(key)).alias("_n"))
    return d.groupBy(key).agg(
        F.percentile(x, 0.5).alias("median"),
        *[F.max(F.when(F.col("_rn") == F.round((F.col("_n") - 1) * q), F.col(x))).alias(name) for name, q in qs.items()])


def histogram(df: DataFrame, x: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum goes into the last bin."""
    bounds = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    b = F.least(F.floor((F.col(x) - F.col("_mn")) / (F.col("_mx") - F.col("_mn")) * bins).cast("long"), F.lit(bins - 1))
    return (df.crossJoin(F.broadcast(bounds)).select(F.lit(bins).alias("bins"), b.alias("bin"))
            .groupBy("bins", "bin").agg(F.count(F.lit(1)).alias("n")))


def live_spot_windows(spot: DataFrame, chunk_rows: int = 1 << 20) -> DataFrame:
    """The live engine's spot windows over bars: population std once two rows exist, means over
    whatever rows exist (the batch features wait for full windows and use sample std). A coin's history is
    cut into chunks of consecutive bars with 300 bars of context."""
    bars = dense_index(spot, ["trade_time"], by=["coin"], name="_bar")
    r = F.col("btc_spot_return_1s")

    def compute(df: DataFrame, w: Window) -> DataFrame:
        w30, w300 = w.rowsBetween(-29, 0), w.rowsBetween(-299, 0)
        return df.select(
            "*",
            F.when(F.count(r).over(w30) >= 2, F.stddev_pop(r).over(w30)).otherwise(F.lit(0.0)).alias("live_vol_30"),
            F.when(F.count(r).over(w300) >= 2, F.stddev_pop(r).over(w300)).otherwise(F.lit(0.0)).alias("live_vol_300"),
            F.avg("btc_spot_signed_size_1s").over(w30).alias("live_flow_mean_30"),
            F.avg("btc_spot_size_1s").over(w30).alias("live_size_mean_30"))

    return rolling_in_chunks(bars, ["coin"], "_bar", 300, compute, chunk_rows).drop("_bar")

"""Window building blocks (W1–W13) shared by the feature builds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_full(agg: Callable[[Column], Column], col: str, w: Window, n: int) -> Column:
    """Row-count rolling aggregate that is null until the window holds ``n`` non-null values.

    Matches a rolling window with ``min_periods = n`` (W6, W7, W9).
    """
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(F.col(col)).over(frame) == n, agg(F.col(col)).over(frame))


def diff(col: str, w: Window, k: int = 1, fill: float | None = 0.0) -> Column:
    """``x - lag(x, k)``; the first k rows get ``fill``."""
    d = F.col(col) - F.lag(col, k).over(w)
    return d if fill is None else F.coalesce(d, F.lit(fill))


def seq_gap(seq: str, w: Window) -> Column:
    """Missing sequence numbers since the previous message: seq - prev - 1 if seq > prev else 0."""
    prev = F.lag(seq).over(w)
    return F.when(prev.isNull(), F.lit(0)).when(F.col(seq) > prev, F.col(seq) - prev - 1).otherwise(F.lit(0))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1,
                  name: str = "_rn") -> DataFrame:
    """First ``n`` rows per group by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n).drop(name)

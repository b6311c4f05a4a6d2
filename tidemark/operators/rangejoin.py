"""Interval joins without a nested loop.

Each interval is exploded into the time buckets it spans; each point has exactly one bucket, so
an equi-join on (keys, bucket) followed by the exact predicate finds every pair once. Work is
proportional to matches plus buckets spanned, and the join shuffles on (keys, bucket), so one
busy key is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_join(intervals: DataFrame, points: DataFrame, lo: str, hi: str, point_time: str,
               bucket_us: int, by: Sequence[str] = (), how: str = "inner",
               lo_inclusive: bool = True, hi_inclusive: bool = True) -> DataFrame:
    """Pairs (interval, point) with ``lo <= point_time <= hi`` (inclusivity per flags), same keys."""
    by = list(by)
    lo_b = F.floor(F.unix_micros(F.col(lo)) / bucket_us).cast("long")
    hi_b = F.floor(F.unix_micros(F.col(hi)) / bucket_us).cast("long")
    iv = intervals.withColumn("_b", F.explode(F.sequence(lo_b, F.greatest(lo_b, hi_b))))
    pt = points.withColumn("_b", F.floor(F.unix_micros(F.col(point_time)) / bucket_us).cast("long"))
    pt = pt.select(*[F.col(c).alias(f"_p_{c}") if c in by else F.col(c) for c in pt.columns])
    cond = [F.col("_b") == F.col("_pb")] + [F.col(c) == F.col(f"_p_{c}") for c in by]
    pt = pt.withColumnRenamed("_b", "_pb")
    t = F.col(point_time)
    cond.append(t >= F.col(lo) if lo_inclusive else t > F.col(lo))
    cond.append(t <= F.col(hi) if hi_inclusive else t < F.col(hi))
    c = cond[0]
    for x in cond[1:]:
        c = c & x
    return iv.join(pt, c, how).drop("_b", "_pb", *[f"_p_{k}" for k in by])

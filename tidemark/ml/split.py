"""Train / test splits over whole event groups (M1–M4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chrono_event_split(df: DataFrame, event_cols: Sequence[str], time_col: str, train_frac: float = 0.7) -> DataFrame:
    """M1: distinct events ordered by time; the first round(frac * n) are 'train'.

    Ranks are computed on the distinct-event table (one row per event), not on the rows.
    """
    ev = df.select(*event_cols).distinct()
    w = Window.orderBy(time_col, *[c for c in event_cols if c != time_col])
    ev = ev.select("*", F.row_number().over(w).alias("_r"), F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))
    return ev.select(*event_cols, F.when(F.col("_r") <= F.round(F.col("_n") * train_frac), "train").otherwise("test").alias("split"))


def group_split(df: DataFrame, group_col: str, seed: int, test_frac: float = 0.3) -> DataFrame:
    """M2: ceil(frac * groups) groups go to test, chosen by rank of md5(seed || group)."""
    g = df.select(group_col).distinct().withColumn("_h", F.md5(F.concat(F.lit(str(seed)), F.col(group_col).cast("string"))))
    w = Window.orderBy("_h", group_col)
    g = g.select(group_col, F.row_number().over(w).alias("_r"), F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))
    return g.select(group_col, F.when(F.col("_r") <= F.ceil(F.col("_n") * test_frac), "test").otherwise("train").alias("split"))

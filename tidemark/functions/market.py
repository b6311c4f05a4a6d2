"""Column functions for prices, fees and quotes.

All are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_price(c: Column) -> Column:
    """null -> 0.5; values above 1 are cents -> dollars."""
    return F.when(c.isNull(), F.lit(0.5)).when(c > 1, c / 100).otherwise(c)


def first_truthy(*cols: Column, default=None) -> Column:
    """first value that is neither null nor 0 (Python ``a or b or c``)."""
    parts = [F.nullif(c, F.lit(0)) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def complement_repair(df: DataFrame, ya: str, yb: str, na: str, nb: str, floor: float = 0.01) -> DataFrame:
    """fill a missing (<= 0) side from the opposite side's complement, in the reference's
    order no_ask -> no_bid -> yes_ask -> yes_bid; each step sees the earlier repairs."""
    def fix(target: str, other: str) -> Column:
        o = F.col(other)
        return F.when(F.col(target) <= 0, F.when(o > 0, F.greatest(1 - o, F.lit(floor))).otherwise(F.lit(0.5))) \
            .otherwise(F.col(target))
    df = df.withColumn(na, fix(na, yb))
    df = df.withColumn(nb, fix(nb, ya))
    df = df.withColumn(ya, fix(ya, nb))
    return df.withColumn(yb, fix(yb, na))


def seconds_until(ts_col: str, as_of: str) -> Column:
    """whole seconds from an explicit as-of time to ``ts_col``; missing -> 0."""
    return F.coalesce(F.expr(f"(unix_micros({ts_col}) - unix_micros(TIMESTAMP '{as_of}')) div 1000000"), F.lit(0))


def taker_fee(p: Column, rate: float = 7.0) -> Column:
    """G1: per-contract taker fee ceil(rate * p * (1 - p)) / 100 with p clamped to [0, 1]."""
    pc = clamp(p, 0.0, 1.0)
    return F.ceil(F.lit(rate) * pc * (1 - pc)) / 100


def clamp(c: Column, lo: float, hi: float) -> Column:
    """Clip that keeps null -> null (Spark's greatest/least skip nulls)."""
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def cents(p: Column) -> Column:
    """Limit price in whole cents, half-to-even, clamped to 1..99."""
    return clamp(F.bround(p * 100, 0), 1, 99).cast("long")


def date_prefix(time: str, prefix: str) -> Column:
    """whether the date text of ``time`` starts with ``prefix`` - a year, a month or a day as yyyy, yyyy-MM or
    yyyy-MM-dd - as a range, so that the filter can be pushed down."""
    unit = {4: "1 year", 7: "1 month", 10: "1 day"}[len(prefix)]
    start = F.to_timestamp(F.lit((prefix + "-01-01")[:10]))
    return (F.col(time) >= start) & (F.col(time) < start + F.expr(f"INTERVAL {unit}"))

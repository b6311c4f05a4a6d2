"""Query registry: ID -> (Spark callable(spark, sf_dir) -> DataFrame, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def finalize(df: DataFrame, round_cols: Iterable[str] = (), nd: int = 9) -> DataFrame:
    """Output conventions shared with the oracle: naive timestamps, float -> double,
    and rounding of order-dependent float aggregates."""
    rc = set(round_cols)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast(T.TimestampNTZType())
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast(T.DoubleType())
        if f.name in rc:
            c = F.round(c, nd)
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str, sql: str | None = None, round_cols: Iterable[str] = ()):
    """Decorator: register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(spark, sf_dir), round_cols)
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        REGISTRY[name] = (wrapped, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    import tidemark.plans.catalog  # noqa: F401  (registers every query)
    import tidemark.plans.catalog_market  # noqa: F401
    import tidemark.plans.catalog_trading  # noqa: F401
    import tidemark.plans.catalog_eval  # noqa: F401
    import tidemark.plans.catalog_parse  # noqa: F401
    import tidemark.plans.catalog_ml  # noqa: F401
    import tidemark.plans.catalog_stream  # noqa: F401
    import tidemark.plans.catalog_io  # noqa: F401
    import tidemark.plans.catalog_ts  # noqa: F401
    import tidemark.plans.catalog_more  # noqa: F401
    import tidemark.plans.catalog_models  # noqa: F401
    return REGISTRY

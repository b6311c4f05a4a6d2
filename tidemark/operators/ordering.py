"""Global row order without a one-partition window.

``dense_index`` numbers rows 0..n-1 (optionally per key) in a total order: range-partition on the
order, sort within partitions, count rows per (partition, key) in a small table (size bounded by
partitions x keys), turn counts into offsets, add the local position. No task ever holds more
than its own range.

``rolling_in_chunks`` evaluates row-count windows (lag k, rolling n rows) over a very long
ordered series: rows are cut into chunks of ``chunk_rows`` consecutive indices, and the last
``overlap`` rows of each chunk are copied into the next one as context. Any window reaching back
at most ``overlap`` rows is then exact inside each chunk, and chunks run in parallel.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id(): partition id in the upper 31 bits


def dense_index(df: DataFrame, order: Sequence, by: Sequence[str] = (), name: str = "row_id",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position in ``order`` (within ``by`` groups). Order must be total."""
    by = list(by)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    nparts = num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = (df.repartitionByRange(int(nparts), *[F.col(c) for c in by], *order_cols)
              .sortWithinPartitions(*[F.col(c) for c in by], *order_cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    # Range bounds are sampled per exchange, so the two uses below (counts, rows) must read one
    # materialisation: a reliable checkpoint in the shared checkpoint folder (survives executor loss).
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
    counts = ranged.groupBy(*by, "_pid").agg(F.min("_mid").alias("_first"), F.count("*").alias("_n"))
    w = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_pid", "_first",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    if not by:  # one row per partition; rows stay where they are
        offsets = F.broadcast(offsets)
    return (ranged.join(offsets, [*by, "_pid"])
            .withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long"))
            .drop("_mid", "_pid", "_first", "_off"))


def rolling_in_chunks(df: DataFrame, by: Sequence[str], index_col: str, overlap: int,
                      compute: Callable[[DataFrame, Window], DataFrame],
                      chunk_rows: int = 1 << 20) -> DataFrame:
    """Run ``compute(df, window)`` per chunk of consecutive ``index_col`` values.

    ``compute`` receives the chunk-partitioned frame and a window ordered by ``index_col``; it must
    only look back at most ``overlap`` rows. Context rows are dropped from the result.
    """
    if overlap >= chunk_rows:
        raise ValueError("overlap must be smaller than chunk_rows")
    by = list(by)
    base = df.withColumn("_chunk", F.floor(F.col(index_col) / chunk_rows).cast("long"))
    ctx = (base.where((F.col(index_col) % chunk_rows) >= chunk_rows - overlap)
           .withColumn("_chunk", F.col("_chunk") + 1).withColumn("_ctx", F.lit(True)))
    both = base.withColumn("_ctx", F.lit(False)).unionByName(ctx)
    w = Window.partitionBy(*by, "_chunk").orderBy(index_col)
    return compute(both, w).where(~F.col("_ctx")).drop("_chunk", "_ctx")


def prefix_sums(df: DataFrame, order: Sequence[str], cols: Sequence[str], suffix: str = "_cum",
                num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` in a global ``order`` without a one-partition window.

    Range partitions are summed locally (a window per range partition), and each partition adds
    the totals of the partitions before it (a table with one row per partition).
    """
    nparts = int(num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(nparts, *[F.col(c) for c in order]).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True).withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
    wl = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(c).over(wl).alias(f"_l_{c}") for c in cols])
    tot = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wp = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(wp), F.lit(0)).alias(f"_o_{c}") for c in cols])
    out = local.join(offs, "_pid")
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", F.col(f"_o_{c}") + F.col(f"_l_{c}"))
    return out.drop("_mid", "_pid", *[f"_l_{c}" for c in cols], *[f"_o_{c}" for c in cols])

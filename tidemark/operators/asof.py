"""As-of (backward) joins as one sort-based window pass.

``left ⟕asof right``: every left row gets the latest right row with ``right_time <= left_time``
(same ``by`` keys). Spark has no scalable as-of join (``_joinAsOf`` plans a nested-loop join), so
the join is expressed as a union plus ``last(struct, ignorenulls)`` over a time-ordered window.

Scale: partitioning only by ``by`` would put a whole coin in one task. The window is therefore
partitioned by ``(by, time bucket)``. A right row from an earlier bucket reaches the left rows of
a later bucket through a *carry-in* row: per (by, bucket) the last right payload is aggregated
(map-side partial aggregation), a running ``last`` over the bucket-level table (size bounded by
keys x buckets, not by rows) gives each bucket the payload current at its start, and that payload
is unioned in as a synthetic right row placed before every real row of the bucket.

Several right sides can be joined in the same pass (one shuffle), each carried in its own struct.
A right row whose fields are all null still counts as the match: the payload struct is non-null.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

DAY_US = 86_400 * 1_000_000


@dataclass
class AsofRight:
    df: DataFrame
    time_col: str
    cols: list[str] = field(default_factory=list)   # payload columns brought over
    time_alias: str | None = None                   # also output the matched right time
    tolerance_us: int | None = None                 # null out matches older than this


def _micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def asof_join(left: DataFrame, rights: list[AsofRight] | AsofRight, left_time: str,
              by: list[str] | tuple = (), bucket_us: int = DAY_US, materialize: bool = False) -> DataFrame:
    """Backward, inclusive as-of join of ``left`` with one or more right sides.

    ``materialize``: the unioned input is read twice (carry-in aggregate and main window); with deep
    input lineage, checkpoint it once to the shared checkpoint folder instead of recomputing it.
    """
    if isinstance(rights, AsofRight):
        rights = [rights]
    by = list(by)
    lcols = left.columns
    n = len(rights)
    payload_types = []
    for r in rights:
        st = r.df.select(F.struct(*[F.col(c) for c in r.cols], _micros(r.time_col).alias("_rt"))
                         .alias("p")).schema["p"].dataType
        payload_types.append(st)
    lstruct_type = left.select(F.struct(*lcols).alias("l")).schema["l"].dataType
    bucket = lambda t: F.floor(t / F.lit(bucket_us)).cast("long")

    # Left rows: payload = the whole left row.
    parts = [left.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)],
                         _micros(left_time).alias("_t"), F.lit(1).alias("_side"),
                         F.struct(*lcols).alias("_l"),
                         *[F.lit(None).cast(payload_types[j]).alias(f"_r{j}") for j in range(n)])]
    # Right rows: one payload column per right side.
    for i, r in enumerate(rights):
        parts.append(r.df.select(
            *[F.col(c).alias(f"_k{j}") for j, c in enumerate(by)],
            _micros(r.time_col).alias("_t"), F.lit(0).alias("_side"),
            F.lit(None).cast(lstruct_type).alias("_l"),
            *[(F.struct(*[F.col(c) for c in r.cols], _micros(r.time_col).alias("_rt"))
               if j == i else F.lit(None).cast(payload_types[j])).alias(f"_r{j}") for j in range(n)]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.withColumn("_b", bucket(F.col("_t")))
    if materialize:
        ensure_checkpoint_dir(u.sparkSession)
        u = u.checkpoint(eager=True)
    keys = [f"_k{i}" for i in range(len(by))]

    # Carry-in: last payload per (keys, bucket), then running last over earlier buckets.
    per_bucket = (u.groupBy(*keys, "_b")
                  .agg(F.max("_side").alias("_has_left"),
                       *[F.max_by(F.col(f"_r{j}"), F.when(F.col(f"_r{j}").isNotNull(),
                                                           F.struct("_t", f"_r{j}")))
                         .alias(f"_r{j}") for j in range(n)]))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (per_bucket
             .select(*keys, "_b", "_has_left",
                     *[F.last(f"_r{j}", ignorenulls=True).over(wb).alias(f"_r{j}") for j in range(n)])
             .where("_has_left = 1")
             .select(*keys, "_b", (F.col("_b") * F.lit(bucket_us) - 1).alias("_t"),
                     F.lit(0).alias("_side"), F.lit(None).cast(lstruct_type).alias("_l"),
                     *[f"_r{j}" for j in range(n)]))
    u = u.unionByName(carry)

    # One sort per (keys, bucket): right rows sort before left rows at equal time (inclusive <=).
    w = (Window.partitionBy(*keys, "_b").orderBy("_t", "_side", *[f"_r{j}" for j in range(n)])
         .rowsBetween(Window.unboundedPreceding, 0))
    matched = u.select("_t", "_side", "_l",
                       *[F.last(f"_r{j}", ignorenulls=True).over(w).alias(f"_m{j}") for j in range(n)]
                       ).where("_side = 1")
    out = [F.col(f"_l.{c}").alias(c) for c in lcols]
    for j, r in enumerate(rights):
        m = F.col(f"_m{j}")
        ok = m.isNotNull()
        if r.tolerance_us is not None:
            ok = ok & ((F.col("_t") - m["_rt"]) <= F.lit(r.tolerance_us))
        out += [F.when(ok, m[c]).alias(c) for c in r.cols]
        if r.time_alias:
            out.append(F.when(ok, F.timestamp_micros(m["_rt"])).alias(r.time_alias))
    return matched.select(*out)

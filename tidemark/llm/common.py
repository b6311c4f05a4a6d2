"""Shared helpers of the training-data operators: column hygiene, scratch tables, Arrow batching."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_checkpoint_dir

#: Texts that one Arrow slice hands to Python at a time, in bytes (a single longer text is one slice).
SLICE_BYTES = 8 << 20


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns an operator is about to add (Spark resolves names without case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def sheltered(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns that ``names`` would clash with under other names, and a function that gives a
    result the columns of ``df`` again."""
    taken = {n.lower() for n in names}
    other = {c: f"__td_kept_{i}" for i, c in enumerate(df.columns) if c.lower() in taken}
    back = [F.col(f"`{other.get(c, c)}`").alias(c) for c in df.columns]
    return df.withColumnsRenamed(other), lambda out: out.select(*back)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and every later use reads
    the same rows whatever executor is lost."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes in each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        block = (np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64)) - 1) // limit
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The strings of ``column``, null as the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def added(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    return T.StructType([*df.schema.fields, *fields])


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *new.values()], names=[*batch.schema.names, *new])


def folded(rows: DataFrame, by: list[str], fold: Callable[[tuple, Iterator[tuple]], Iterable[tuple]], schema: str, then: tuple[str, ...] = ()) -> DataFrame:
    """Rows dealt out by ``by`` and sorted by it, and by ``then``, go through ``fold(key, the key's rows in
    turn)``; a key's rows are never held together. ``fold`` gives output rows as tuples."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names, out = rows.columns, T.StructType.fromDDL(schema)
    kinds = {T.IntegerType(): pa.int32(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary(), T.BooleanType(): pa.bool_()}
    types, fields, places = [kinds[f.dataType] for f in out], out.names, [names.index(c) for c in by]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (tuple(c[i].as_py() for c in b.columns) for b in batches for i in range(b.num_rows))
        for key, group in groupby(every, lambda r: tuple(r[p] for p in places)):
            for row in fold(key, group):
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names=fields)

    return rows.repartition(n, *by).sortWithinPartitions(*by, *then).mapInArrow(run, out)

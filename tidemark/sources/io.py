"""Sources and sinks (S1–S8): typed CSV scans, database extracts, appends, logs, artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # keep microseconds through text files


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and an explicit schema (never inferred)."""
    return spark.read.schema(schema).option("header", True).option("timestampFormat", TS_FORMAT).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Result table as CSV with a header."""
    df.write.mode(mode).option("header", True).option("timestampFormat", TS_FORMAT).csv(path)


def append_rows(df: DataFrame, path: str, columns: list[str]) -> None:
    """Append with a fixed column order; the header comes with each part file, so readers
    with ``header=True`` see it once per file (Spark skips it)."""
    df.select(*columns).write.mode("append").option("header", True).option("timestampFormat", TS_FORMAT).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def append_batch(df: DataFrame, path: str, columns: list[str], batch: int) -> bool:
    """Append ``df`` as batch number ``batch``, whole or not at all, in a fixed column order.

    The rows go to the batch's own folder; only when they are all there does a row with the batch and its row
    count go to the manifest, and readers see batches of the manifest alone. A write that fails leaves no row
    there, so its parts are held back (``held_back``) and replaced by the retry; a batch that is in the manifest is
    not written again. Returns whether it was written now."""
    spark = df.sparkSession
    folder, manifest = f"{path}/data/batch={batch}", f"{path}/manifest/batch={batch}"
    if path_exists(spark, f"{manifest}/_SUCCESS"):
        return False
    df.select(*columns).write.mode("overwrite").option("header", True).option("timestampFormat", TS_FORMAT).csv(folder)
    # the schema comes from the rows' own, so nothing is inferred
    rows = spark.read.schema(df.select(*columns).schema).option("header", True).option("timestampFormat", TS_FORMAT).csv(folder)
    rows.agg(F.count("*").alias("n_rows")).write.mode("overwrite").parquet(manifest)
    return True


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``batch`` and ``n_rows`` of every batch that is there as a whole."""
    if not path_exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], "n_rows long, batch long")
    return spark.read.schema("n_rows long, batch long").parquet(f"{path}/manifest")


def read_appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all whole batches; without any, none."""
    if not path_exists(spark, f"{path}/data"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, batch long").option("header", True).option("timestampFormat", TS_FORMAT).csv(f"{path}/data")
    return rows.join(committed(spark, path).select("batch"), "batch", "left_semi").drop("batch")


def held_back(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S6 failure report: ``batch`` and ``n_rows`` found so far of batches that have not been written whole."""
    if not path_exists(spark, f"{path}/data"):
        return spark.createDataFrame([], "batch long, n_rows long")
    rows = spark.read.schema(f"{schema}, batch long").option("header", True).csv(f"{path}/data")
    return rows.groupBy("batch").agg(F.count("*").alias("n_rows")).join(committed(spark, path).select("batch"), "batch", "left_anti")


#: Fixed value: decimals of the closed-lot log.
CLOSED_LOT_DIGITS = {"price": 4, "pnl": 4}


def append_closed_lots(lots: DataFrame, path: str, columns: list[str], batch: int) -> bool:
    """Closed lots appended as one batch, prices and PnL at four decimals."""
    return append_batch(log_projection(lots.select(*columns), CLOSED_LOT_DIGITS), path, columns, batch)


def jdbc_extract(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
                 partitions: int, properties: dict | None = None) -> DataFrame:
    """Full-table extract from a database, split into ranges of ``partition_column``."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def paged_extract(df: DataFrame, columns: list[str] | str = "*", limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """S3: projection plus an optional row limit (the limit is the feature: a capped extract)."""
    out = df if columns == "*" else df.select(*columns)
    if limit is not None:
        out = (out.orderBy(*order) if order else out).limit(limit)
    return out


def log_projection(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Append-only log rows with the reference's rounding per column."""
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def save_artifacts(draws: DataFrame, scaler: DataFrame, path: str) -> None:
    """Model artifacts as parquet tables: draws(draw_id, intercept, beta) and scaler(feature, pos, mean, std)."""
    draws.write.mode("overwrite").parquet(f"{path}/draws")
    scaler.write.mode("overwrite").parquet(f"{path}/scaler")


def check_feature_order(spark: SparkSession, scaler: DataFrame, expected: list[str]) -> DataFrame:
    """S8 check: full outer join of saved and expected feature names on position; mismatches
    (first 5 reported by the caller) are rows where the names differ or one side is missing."""
    exp = spark.createDataFrame(list(enumerate(expected)), "pos long, expected string")
    j = scaler.select("pos", F.col("feature").alias("saved")).join(exp, "pos", "full_outer")
    return j.where(~F.col("saved").eqNullSafe(F.col("expected"))).orderBy("pos")

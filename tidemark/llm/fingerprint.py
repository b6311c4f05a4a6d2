"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A document is the set of the digests of its paragraphs: its lines, long lines in runs of ``RUN`` words. Each
digest goes into one cell of each of three tables; a cell holds how many digests it has, their exclusive or,
and the exclusive or of their checksums. Subtracting the sketches of two versions cancels what both have.
Peeling then recovers the rest: a cell with one digest gives it away, the digest leaves its two other cells,
and so on, table after table. Where cells remain, the sketch was too small for the difference, and the
pair is tried again with a larger one and other hashes, until nothing remains.

DataFrame functions only. Texts are shuffled once, by id; the versions' digests are written to the shared
folder in buckets by id, so that cells are grouped within the tasks that read them, without a shuffle, in
every round and every attempt. An attempt reads only the pairs that failed before, joined within the buckets,
and writes one file per bucket; what the driver sees of it is the number of failed pairs. A sketch is a
function of its set, so retries and lost executors change nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import work_path, written
from tidemark.session import settings

#: Words in a run of a long line.
RUN = 20
#: Cells of each of the three tables of the fingerprint.
WIDTH = 12
TABLES = 3
#: Peeling steps of an attempt, each over one table. Too few only means another attempt.
STEPS = 9
#: Cells of a table of the second sketch, as a part of all digests of a pair; every further sketch has twice as
#: many. Where all digests differ, a cell gets 4/3 on average, and ``STEPS`` steps over large random sets leave
#: less than one digest in 10**8.
GROWN = 0.75
#: Joins by id and other columns stay within the buckets by id.
WITHIN_BUCKETS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
#: What a text is compared with; a pair has the place in this list.
KINDS = ["edited", "next"]
#: Stands for a null id: below every other.
NO_ID = -(1 << 63)


# --- digests and cells
def paragraphs(text: Column) -> Column:
    space, word = r"[\x20\x09\x0B-\x0D]", r"[^\x20\x09-\x0D]"
    return F.regexp_extract_all(text, F.lit(rf"{word}+(?:{space}+{word}+){{0,{RUN - 1}}}"), F.lit(0))


def digests(text: Column) -> Column:
    """The set of a text's paragraph digests. Paragraphs that differ in white space between words differ;
    a repeated paragraph counts once; a text without words has none."""
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))


def checksum(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check")).bitwiseAND(F.lit((1 << 32) - 1))


def cell(key: Column, table: Column, width: Column, attempt: int) -> Column:
    """The cell of ``key`` in ``table``; tables lie one after the other."""
    return table * width + F.pmod(F.xxhash64(key, F.lit(attempt), table), width)


def in_cells(rows: DataFrame, by: list[str], attempt: int) -> DataFrame:
    """``by``, ``width``, ``key``, ``sign`` -> cells that are not empty: ``c``, ``n``, ``x``, ``y``. Digests of
    the second version have sign -1, so equal digests cancel: this is the difference of both sketches."""
    table = F.explode(F.array(*[F.lit(t).cast("long") for t in range(TABLES)])).alias("t")
    rows = rows.select(*by, "width", "key", "sign", table)
    rows = rows.select(*by, "width", "sign", F.col("key").alias("x"), cell(F.col("key"), F.col("t"), F.col("width"), attempt).alias("c"), checksum(F.col("key")).alias("y"))
    return merged(rows.withColumnRenamed("sign", "n"), [*by, "width", "c"])


def merged(rows: DataFrame, by: list[str]) -> DataFrame:
    return (rows.groupBy(*by).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
            .where("n <> 0 or x <> 0 or y <> 0"))


def sketch(keys: Column) -> Column:
    """All cells of the fingerprint of a set of digests, in order, as an array of ``n``, ``x``, ``y``."""
    empty = F.struct(*[F.lit(0).cast("long").alias(c) for c in "nxy"])

    def of(table: int) -> Column:
        t = F.lit(table).cast("long")
        placed = F.transform(keys, lambda k: F.struct(cell(k, t, F.lit(WIDTH).cast("long"), 0).alias("c"), k.alias("x"), checksum(k).alias("y")))
        numbers = F.sequence(t * WIDTH, (t + 1) * WIDTH - 1)
        # the digests are placed once: as the only element of an outer array
        return F.transform(F.array(placed), lambda p: F.transform(numbers, lambda c: F.aggregate(
            F.filter(p, lambda e: e["c"] == c), empty,
            lambda s, e: F.struct((s["n"] + 1).alias("n"), s["x"].bitwiseXOR(e["x"]).alias("x"), s["y"].bitwiseXOR(e["y"]).alias("y")))))[0]

    return F.flatten(F.array(*[of(t) for t in range(TABLES)]))


def fingerprint(keys: Column) -> Column:
    """The sketch as text: count, digests and checksums of each cell in hex."""
    return F.array_join(F.transform(sketch(keys), lambda s: F.lower(F.concat_ws(".", F.hex(s["n"]), F.hex(s["x"]), F.hex(s["y"])))), " ")


def peeled(cells: DataFrame, by: list[str], attempt: int, with_digests: bool) -> DataFrame:
    """Recover digests from a difference. A row with ``c`` = -1 is a digest ``found`` with sign ``n``, or the
    number ``n`` of all digests found; any other row is a cell that could not be emptied."""
    rows = cells.withColumn("found", F.lit(0).cast("long"))
    one = F.col("n")
    for step in range(STEPS):
        t = step % TABLES
        width, key = F.col("width"), F.col("x")
        pure = ((F.col("c") >= t * width) & (F.col("c") < (t + 1) * width) & (F.abs("n") == 1) & (F.col("y") == checksum(key))
                & (F.col("c") == cell(key, F.lit(t).cast("long"), width, attempt)))
        same = F.struct("c", "n", "x", "y", "found")
        # a pure cell leaves: its digest is a finding, and is taken out of its cells in the other tables
        zero = F.lit(0).cast("long")
        finding = F.struct(F.lit(-1).cast("long").alias("c"), (one if with_digests else zero + 1).alias("n"), zero.alias("x"), zero.alias("y"), (key if with_digests else zero).alias("found"))
        gone = [F.struct(cell(key, F.lit(o).cast("long"), width, attempt).alias("c"), (-one).alias("n"), key.alias("x"), F.col("y").alias("y"), F.lit(0).cast("long").alias("found"))
                for o in range(TABLES) if o != t]
        rows = rows.select(*by, "width", F.inline(F.when(pure, F.array(finding, *gone)).otherwise(F.array(same))))
        rows = merged(rows, [*by, "width", "c", "found"])
    return rows


def differences(pairs: DataFrame, by: list[str], left: str, right: str, with_digests: bool = False) -> DataFrame:
    """How many digests only one of two versions has, found by ever larger sketches.

    ``left`` and ``right`` are arrays of distinct digests (null: empty) of rows that ``by`` names; tasks group
    them without a shuffle if ``pairs`` is bucketed by the first of ``by``. Returns a written table of ``by``
    and ``d``, and ``digests`` if asked for: each digest ``found`` with its sign ``n`` (1: only left, -1: only
    right). Equal sets have no row; an empty table gives an empty one."""
    attempt, done = 0, []
    none = F.array().cast("array<bigint>")
    pairs = pairs.select(*by, F.coalesce(left, none).alias("l"), F.coalesce(right, none).alias("r"))
    todo = pairs
    while True:
        both = F.size("l") + F.size("r")
        width = F.lit(WIDTH) if attempt == 0 else F.ceil(both * F.lit(GROWN * 2 ** (attempt - 1))) + 4
        rows = todo.select(*by, width.cast("long").alias("width"), F.size("l").alias("k"), F.posexplode(F.concat("l", "r")).alias("i", "key"))
        rows = rows.select(*by, "width", "key", F.when(F.col("i") < F.col("k"), 1).otherwise(-1).cast("long").alias("sign"))
        out = peeled(in_cells(rows, by, attempt), by, attempt, with_digests)
        is_found = F.col("c") < 0
        got = [F.count(F.when(is_found, 1)) if with_digests else F.sum(F.when(is_found, F.col("n")).otherwise(0))]
        got = [got[0].cast("long").alias("d"), F.count(F.when(~is_found, 1)).alias("stuck")]
        if with_digests:
            got.append(F.collect_list(F.when(is_found, F.struct("found", "n"))).alias("digests"))
        with settings(pairs.sparkSession, WITHIN_BUCKETS):
            out = written_bucketed(out.groupBy(*by).agg(*got), by[0])
        done.append(out.where("stuck = 0").drop("stuck"))
        failed = out.where("stuck > 0").select(*by)
        if failed.isEmpty():
            break
        todo = pairs.join(failed, by, "left_semi")
        attempt += 1
    found = done[0]
    for d in done[1:]:
        found = found.unionByName(d)
    return found


def n_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written_bucketed(df: DataFrame, key: str) -> DataFrame:
    """Write ``df`` to the shared folder in hash buckets by ``key`` and read it back; Spark then groups by
    ``key`` without a shuffle. The table's name goes at once, its files stay like any scratch table's."""
    spark = df.sparkSession
    name = f"tidemark_scratch_{uuid.uuid4().hex}"
    df.write.bucketBy(n_buckets(spark), key).option("path", work_path(spark, "buckets")).format("parquet").saveAsTable(name)
    out = spark.table(name)
    out.schema  # resolved now
    spark.sql(f"drop table {name}")
    return out


# --- documents and their edited texts
def next_ids(docs: DataFrame) -> DataFrame:
    """``id``, ``next_id``, ``take`` for each distinct id: the next larger id, after the largest the smallest;
    and the most code points that a row of ``id`` takes from it. Ids are range-partitioned, so the order of
    all is that of the partitions; only a partition's first id is seen outside of it."""
    ids = docs.groupBy("id").agg(F.max(F.floor(F.length("text") / 4)).alias("take"))
    ids = written(ids.repartitionByRange("id").select("id", "take", F.spark_partition_id().alias("part")), "ids")
    firsts = ids.groupBy("part").agg(F.min("id").alias("first"))
    firsts = firsts.select(F.col("part").alias("__p"), F.coalesce(F.lead("first").over(W.orderBy("part")), F.min("first").over(W.partitionBy(F.lit(0)))).alias("__after"))
    follows = F.lead("id").over(W.partitionBy("part").orderBy("id"))
    return ids.withColumn("__n", follows).join(firsts, F.col("part") == F.col("__p")).select("id", "take", F.coalesce("__n", "__after").alias("next_id"))


def versions(docs: DataFrame) -> DataFrame:
    """A written table, bucketed by ``id``, with a row for each row of ``doc_id``, ``text``: ``row``, ``n_chars``,
    ``edited_sha256`` and the digests ``own``, ``edited``, ``next``."""
    docs = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    follow = next_ids(docs).withColumnRenamed("id", "owner")
    given = (follow.join(docs, F.col("next_id") == F.col("id"))
             .select("owner", F.struct(F.expr("substring(text, 1, cast(take as int))").alias("head"), digests(F.col("text")).alias("next")).alias("given"))
             .groupBy("owner").agg(F.min("given").alias("given")))
    joined = docs.join(given, F.col("id") == F.col("owner"))
    n = F.length("text")
    take = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - take), F.substring("given.head", F.lit(1), take))
    rows = joined.withColumn("edited_text", edited).select(
        "id", F.monotonically_increasing_id().alias("row"), n.cast("long").alias("n_chars"), F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("edited_text")).alias("edited"), F.col("given.next").alias("next"))
    return written_bucketed(rows, "id")


def compare(docs: DataFrame) -> DataFrame:
    """One row for each row of ``doc_id``, ``text``: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    Likeness is 1 - differing digests / digests of both, 1 where neither has any. Null text is empty; ids in
    ascending order with null first; rows that repeat an id all have the next larger id's smallest text as
    the next document, and an only id has itself. Other columns are ignored; an empty table gives an empty
    result."""
    def kind(k: str) -> Column:
        return F.lit(KINDS.index(k)).cast("tinyint")

    rows = versions(docs)
    pairs = rows.select("id", "row", F.explode(F.array(F.struct(kind("edited").alias("kind"), F.col("own").alias("a"), F.col("edited").alias("b")),
                                                       F.struct(kind("next").alias("kind"), F.col("own").alias("a"), F.col("next").alias("b")))).alias("s")).select("id", "row", "s.kind", "s.a", "s.b")
    found = differences(pairs, ["id", "row", "kind"], "a", "b")
    counts = found.groupBy("id", "row").agg(*[F.sum(F.when(F.col("kind") == kind(k), F.col("d")).otherwise(0)).alias(f"d_{k}") for k in KINDS])
    out = rows.join(counts, ["id", "row"], "left")

    def likeness(k: str) -> Column:
        both = F.size("own") + F.size(k)
        return F.when(both == 0, 1.0).otherwise(1.0 - F.coalesce(F.col(f"d_{k}"), F.lit(0)) / both)

    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
                      fingerprint(F.col("edited")).alias("edited_fingerprint"), likeness("edited").alias("near_edited"), likeness("next").alias("near_next"))

"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in a pseudo-random order, form blocks of equal size. Time is counted in slots of
one block. The targets are a flow: all sources flow in proportion to their weights, a source that runs out
stops, and the others share its part from there on. Block i (from 0) of a source is released in the slot in
which i blocks of it have flowed and due when i + 1 have; in every slot the released block with the earliest
deadline goes next, ties by name. Weights are exact ratios of integers, so every source is always less than one
block from its target. No document is dropped or repeated.

Sources sorted by when they run out (stock / weight) give the flow as one row per source, so releases,
deadlines and the state before any slot are found from that table alone (``Course``). The driver holds and sends
out this row per source (its name and three integers, however many run out), never a schedule; tasks
schedule spans of slots on their own, in memory that grows with the sources only.
Numbering the documents of a source is by hash buckets of bounded size with bucket offsets, so the hottest
source is spread over as many tasks as any. Blocks get slots, and buckets their blocks, before any text moves: the
rows of ``docs`` are shuffled once by bucket.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import sheltered, without

BLOCK = 64
#: Slots that a task schedules at a time: at least and, for very small weights, at most.
SPAN, LONG_SPAN = 1 << 12, 1 << 20
#: Slots that leave a task in one Arrow batch.
BATCH_SLOTS = 1 << 13
#: Documents of all sources together that share a hash bucket, about.
BUCKET_ROWS = 2_000
SEED = 9


# --- the schedule, from the table of sources
def whole_weights(weights: Mapping[str, float]) -> dict[str, int]:
    """Integers in exactly the proportions of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*[w.denominator for w in exact.values()])
    out = {s: int(w * scale) for s, w in exact.items()}
    common = math.gcd(*out.values())
    return {s: w // common for s, w in out.items()}


def quotas(weights: Mapping[str, float], period: int) -> dict[str, int]:
    """Blocks per period, in proportion to the weights: at least one each, ``period`` in all (or one each,
    where there are more sources); the largest remainders are rounded up, ties by name."""
    period = max(period, len(weights))
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, math.floor(x)) for s, x in exact.items()}
    step = 1 if sum(out.values()) < period else -1
    order = sorted(exact, key=lambda s: (step * (out[s] - exact[s]), s))  # the farthest off first
    while sum(out.values()) != period:
        for s in order:
            if sum(out.values()) != period and out[s] + step >= 1:
                out[s] += step
    return out


class Course:
    """The flow of sources with positive integer weights, from slot ``base`` on; slots are counted from there.

    Sources are numbered in the order in which they run out. Before source j runs out, and after those before
    it, time t has slot ``done[j] + t * rate[j]``; source i has had ``t * weight[i]`` blocks."""

    def __init__(self, base: int, stock: Mapping[str, int], weights: Mapping[str, int]) -> None:
        self.base = base
        self.names = sorted(stock, key=lambda s: (Fraction(stock[s], weights[s]), s))
        self.stock = [stock[s] for s in self.names]
        self.weight = [weights[s] for s in self.names]
        self.done = [0, *accumulate(self.stock)]
        self.rate = list(accumulate(reversed(self.weight)))[::-1]
        self.slots = self.done[-1]
        #: Slots to schedule at a time: about as many as finding the state before them takes.
        self.step = max(SPAN, 4 * len(self.names), min(LONG_SPAN, self.rate[0] // min(self.weight)))

    def stretch(self, i: int, k: int, least: int = 0, most: int | None = None) -> int:
        """The source that runs out first after k blocks of source i have flowed, from ``least`` to ``most``."""
        w, stock, weight, most = self.weight[i], self.stock, self.weight, i if most is None else most
        if stock[least] * w >= k * weight[least]:
            return least
        if stock[most - 1] * w < k * weight[most - 1]:
            return most
        return bisect_left(range(most), True, lo=least, key=lambda j: stock[j] * w >= k * weight[j])

    def border(self, i: int, k: int, j: int | None = None) -> tuple[int, int]:
        """The slot in which k blocks of source i have flowed, rounded down (release of block k) and up
        (deadline of block k - 1)."""
        j = self.stretch(i, k) if j is None else j
        whole, rest = divmod(k * self.rate[j], self.weight[i])
        return self.done[j] + whole, self.done[j] + whole + (rest > 0)

    def state(self, slot: int) -> list[int]:
        """The blocks that each source has had before ``slot``: all that are due by then and, of the others that
        are released, in order of deadlines, each that still fits between its release and ``slot``. It fits if
        from no slot on, up to its release, more blocks are taken than there are slots left."""
        j = bisect_left(range(len(self.names) - 1), True, key=lambda j: (slot - self.done[j]) * self.weight[j] <= self.stock[j] * self.rate[j])
        gone, rate = slot - self.done[j], self.rate[j]
        out = [*self.stock[:j], *[gone * w // rate for w in self.weight[j:]]]
        more = slot - sum(out)
        if more == 0:
            return out
        begun = {i: self.border(i, out[i])[0] for i in range(j, len(out)) if gone * self.weight[i] % rate}
        ends = sorted(set(begun.values()))
        # the fewest slots left over, from a slot on, between one end and the next: due blocks by their releases,
        # the latest first, one of each source at a time
        room, taken = np.full(len(ends), more, dtype=np.int64), 0
        due = [(-self.border(i, n - 1, self.stretch(i, n - 1, 0, min(i, j)))[0], i, n - 1) for i, n in enumerate(out) if n]
        heapq.heapify(due)

        def take() -> int:
            at, i, k = due[0]
            if k:
                heapq.heapreplace(due, (-self.border(i, k - 1, self.stretch(i, k - 1, 0, min(i, j)))[0], i, k - 1))
            else:
                heapq.heappop(due)
            return -at

        for e in range(len(ends) - 1, 0, -1):
            while due and -due[0][0] >= ends[e]:
                take()
                taken += 1
            low = slot - ends[e] - taken
            while due and -due[0][0] > ends[e - 1]:
                at = take()
                taken += 1
                low = min(low, slot - at - taken)
            room[e] = low
        for _, _, i in sorted((self.border(i, out[i] + 1)[1], self.names[i], i) for i in begun):
            upto = bisect_left(ends, begun[i]) + 1
            if more and room[:upto].min() > 0:
                room[:upto] -= 1
                out[i] += 1
                more -= 1
        return out

    def span(self, lo: int, hi: int) -> Iterator[tuple[int, str, int, int, int]]:
        """Slot, source, block, its release and its deadline for the slots from ``lo`` to before ``hi``: earliest
        deadline first among released blocks, ties by name."""
        waiting = [(self.border(i, k)[0], i, k) for i, k in enumerate(self.state(lo)) if k < self.stock[i]]
        heapq.heapify(waiting)
        ready: list[tuple[int, str, int, int, int, int]] = []
        last = [0] * len(self.names)
        for slot in range(lo, hi):
            while waiting and waiting[0][0] <= slot:
                at, i, k = heapq.heappop(waiting)
                last[i] = self.stretch(i, k + 1, last[i])
                following, due = self.border(i, k + 1, last[i])
                heapq.heappush(ready, (due, self.names[i], k, at, following, i))
            due, name, k, at, following, i = heapq.heappop(ready)
            yield slot, name, k, at, due
            if k + 1 < self.stock[i]:
                heapq.heappush(waiting, (following, i, k + 1))


def courses(stock: Mapping[str, int], weights: Mapping[str, float], period: int | None = None) -> list[Course]:
    """The schedule of all blocks. Sources without a positive weight come when all others have run out, with
    equal weights. ``period``: weights are first rounded to whole blocks in so many slots."""
    heavy = {s: weights[s] for s, n in stock.items() if n and weights.get(s, 0) > 0}
    light = {s: n for s, n in stock.items() if n and s not in heavy}
    out = []
    if heavy:
        whole = whole_weights(heavy) if period is None else quotas(heavy, period)
        out.append(Course(0, {s: stock[s] for s in heavy}, whole))
    if light:
        out.append(Course(out[0].slots if out else 0, light, dict.fromkeys(light, 1)))
    return out


# --- documents
def key(source: str) -> Column:
    """A text for every source, null included."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("null"))


def scheduled(docs: DataFrame, source: str = "source", weights: Mapping[str | None, float] | None = None,
              block: int = BLOCK, period: int | None = None) -> DataFrame:
    """Add ``block`` (number within the source, from 0), ``release``, ``deadline``, ``slot`` (long) and
    ``place`` (within the block) to each row.

    ``weights`` names target weights by source (null is a source); without it a source weighs the square
    root of its documents. ``period`` rounds the weights to whole blocks in so many slots. Rows that repeat an
    id are rows of their own. Every row gets a place; columns named like the new ones are replaced; an empty
    table gives an empty result."""
    spark = docs.sparkSession
    docs = without(docs, ["block", "release", "deadline", "slot", "place"])
    keyed = docs.withColumn("__s", key(source)).withColumn("__h", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 40)))
    sizes = {r["__s"]: r["n"] for r in keyed.groupBy("__s").agg(F.count("*").alias("n")).collect()}  # a row per source
    stock = {s: -(-n // block) for s, n in sizes.items()}
    given = {s: math.sqrt(n) for s, n in sizes.items()} if weights is None else {"null" if s is None else f"={s}": w for s, w in weights.items()}
    # spans of slots, dealt out to tasks that schedule them
    plan = courses(stock, given, period)
    shared = spark.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, lo in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                course = shared.value[n]
                turns = course.span(lo, min(lo + course.step, course.slots))
                while rows := list(islice(turns, BATCH_SLOTS)):
                    slot, name, k, at, due = zip(*rows, strict=True)
                    numbers = [pa.array(k, pa.int64()), *[pa.array(np.array(x, dtype=np.int64) + course.base) for x in (at, due, slot)]]
                    yield pa.RecordBatch.from_arrays([pa.array(name, pa.string()), *numbers], names=["__s3", "__block", "release", "deadline", "slot"])

    spans = spark.createDataFrame([(n, c.slots, c.step) for n, c in enumerate(plan)], "n long, slots long, step long")
    spans = spans.select("n", F.explode(F.expr("sequence(0L, slots - 1, step)")).alias("lo"))
    spans = spans.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "n", "lo")
    turns = spans.mapInArrow(run, "__s3 string, __block long, release long, deadline long, slot long")

    # buckets of a source: the rows of the buckets before, and the turns of the blocks that reach into the bucket
    n_buckets = max(1, -(-sum(sizes.values()) // BUCKET_ROWS))
    keyed = keyed.withColumn("__b", F.floor(F.col("__h") * n_buckets / (1 << 40)).cast("long"))
    before = keyed.groupBy(F.col("__s").alias("__s2"), F.col("__b").alias("__b2")).agg(F.count("*").alias("__n"))
    rows_before = F.sum("__n").over(W.partitionBy("__s2").orderBy("__b2").rowsBetween(W.unboundedPreceding, -1))
    before = before.withColumn("__before", F.coalesce(rows_before, F.lit(0)))
    reach = before.withColumn("__block", F.explode(F.expr(f"sequence(__before div {block}, (__before + __n - 1) div {block})")))
    turn = F.struct("__block", "release", "deadline", "slot")
    buckets = (reach.join(turns.withColumnRenamed("__block", "__block3"), (F.col("__s2") == F.col("__s3")) & (F.col("__block") == F.col("__block3")))
               .groupBy("__s2", "__b2").agg(F.min("__before").alias("__before"), F.array_sort(F.collect_list(turn)).alias("__turns")))

    # numbers within the source: rows of the buckets before, then the place within the bucket
    within = W.partitionBy("__s", "__b").orderBy("__h", "doc_id")
    numbered = (keyed.withColumn("__r", F.row_number().over(within) - 1)
                .join(buckets, (F.col("__s") == F.col("__s2")) & (F.col("__b") == F.col("__b2")))
                .withColumn("__i", F.col("__before") + F.col("__r")))
    turn = F.get("__turns", F.expr(f"cast(__i div {block} - __before div {block} as int)"))
    numbered = numbered.withColumn("__turn", turn).withColumn("place", F.col("__i") % block)
    return numbered.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__turn.__block").alias("block"), "__turn.release", "__turn.deadline", "__turn.slot", "place")


def mixed(docs: DataFrame, source: str = "source") -> DataFrame:
    """The rows and columns of ``docs`` in the order of the schedule: partitions hold ranges of slots, one after
    the other, and rows are sorted in each. Written, part after part has that order; see ``position``."""
    docs, restored = sheltered(docs, ["block", "release", "deadline", "slot", "place"])
    placed = scheduled(docs, source)
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return restored(placed.repartitionByRange(ranges, "slot", "place").sortWithinPartitions("slot", "place"))


def position(docs: DataFrame, name: str = "position") -> DataFrame:
    """Add a long that sorts the rows as they were written: by number of the part file, then row. A reader packs
    files into tasks by size, so its own order says nothing. Rows not read from Parquet files have no such
    order: null."""
    docs = without(docs, [name])
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    part, piece = (F.coalesce(F.regexp_extract(file, x, 1).try_cast("long"), F.lit(0)) for x in (r"^part-(\d+)", r"-c(\d+)\."))
    try:
        return docs.select("*", (part * (1 << 43) + piece * (1 << 33) + row).alias(name))
    except AnalysisException:  # no such files
        return docs.select("*", F.lit(None).cast("long").alias(name))

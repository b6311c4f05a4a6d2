"""Approximate nearest neighbours by cosine: an NN-descent graph, searched greedily.

Index. Rows with equal vectors are one node; nodes carry their direction in one byte a component. Every node starts
with ``DEGREE`` neighbours at random. In each round a node's neighbourhood - its neighbours and the nearest of
the nodes that have it as theirs - is brought together by joins, and of every two members of which one is new,
each learns of the other if that is nearer than its worst neighbour. Rounds end when few neighbours change.

Search. A query begins at the nearest of ``PIVOTS`` nodes, and at its own node if it has one. In each round the
nearest ``EXPAND`` nodes of its beam whose neighbours have not been seen are joined with the graph, and the
neighbours found go into the beam of the nearest ``BEAM``. A query is done when its beam holds no node that has
not been expanded. The nearest of the beam are scored again with the vectors as given, in double precision.

Neighbourhoods are bounded by ``DEGREE`` and ``REVERSE``: a node that very many others have as neighbour takes the
nearest of these, limited before the shuffle. That is the method's own bound: every row is indexed, and the
recall is measured by tests. Copies of a vector are one node, so they fill no beam and no neighbourhood; they come
back with the smallest ids first. Nothing but the pivots goes to every task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import folded, written
from tidemark.llm.fingerprint import written_bucketed

#: Neighbours of a node, nodes that have it as theirs, and members of a neighbourhood that each one learns of.
DEGREE, REVERSE, LEARN = 24, 24, 4
#: Rounds end when less than this share of the neighbours is new.
CHANGED = 0.05
ROUNDS = 30
#: Start nodes to choose from, and how many a query begins with.
PIVOTS, STARTS = 256, 8
#: Nodes of a query's beam, those it expands in a round, and those scored again.
BEAM, EXPAND, RESCORE = 400, 100, 64
#: Rows that a task should at least have.
TASK_ROWS = 100_000
#: Neighbourhoods that are multiplied at once.
BLOCK = 256
#: The likeness of a neighbour that has not been measured.
UNKNOWN = -3.0


@dataclass(frozen=True)
class Index:
    """``nodes``: ``node``, ``h1``, ``h2`` (hashes of the vector), ``vector``, ``code``; ``members``: ``node``,
    ``vec_id``; ``graph``: ``node``, ``ids`` and ``codes`` of its neighbours, in buckets by node; the
    ``dimension`` and the number of nodes."""

    nodes: DataFrame
    members: DataFrame
    graph: DataFrame
    dimension: int
    size: int


# --- vectors
def usable(vector: Column) -> Column:
    """Whether a vector has a direction: neither null nor all zero, every component there and finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def keyed(rows: DataFrame) -> DataFrame:
    """Two hashes that stand for ``vector``, from its components without zeros at the end."""
    return rows.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64("vector", F.lit(12)))


def trimmed(vector: Column) -> Column:
    """Components as doubles, without zeros at the end: vectors of different length compare as if filled up."""
    last = F.array_max(F.transform(vector, lambda x, i: F.when(x != 0, i + 1).otherwise(0)))
    return F.slice(F.transform(vector, lambda x: x.cast("double") + 0.0), 1, last)


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Vectors of an Arrow list column as rows, filled up with zeros."""
    offsets = column.offsets.to_numpy()
    size, values = np.diff(offsets), column.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), d))
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], size)] = values[offsets[0]:offsets[-1]]
    return out


def coded(rows: DataFrame, d: int) -> DataFrame:
    """Add ``code``: the direction of ``vector``, a signed byte for each of ``d`` components."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("vector"), d)
                x = np.rint(x * (127 / np.abs(x).max(axis=1, keepdims=True))).astype(np.int8)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in x], pa.binary())], names=[*b.schema.names, "code"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{kinds}, code binary")


def directions(codes: Iterable[bytes], d: int) -> np.ndarray:
    """Codes as unit vectors, one row each."""
    x = np.frombuffer(b"".join(codes), dtype=np.int8).reshape(-1, d).astype(np.float32)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


# --- the graph
def reversed_edges(edges: DataFrame) -> DataFrame:
    """For every node the nearest ``REVERSE`` of those that have it as neighbour."""
    near = W.partitionBy("w").orderBy(F.col("sim").desc(), "u")
    return edges.withColumn("__r", F.row_number().over(near)).where(F.col("__r") <= REVERSE).select(F.col("w").alias("v"), F.col("u").alias("m"), "new")


def in_tasks(rows: DataFrame, expected: int) -> DataFrame:
    """``rows`` in as many tasks as ``expected`` rows need, where that is fewer than there are partitions: whole
    partitions are read one after the other, without a shuffle."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(rows.sparkSession.sparkContext.defaultParallelism, expected // TASK_ROWS)
    return rows.coalesce(wanted) if wanted < n else rows


def with_codes(members: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """Members ``m`` of ``v`` with the columns of their nodes, dealt out and sorted by ``v``."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    expected = size * (DEGREE + REVERSE)
    rows = in_tasks(members.join(nodes.withColumnRenamed("node", "m").hint("merge"), "m"), expected)
    return in_tasks(rows.repartition(n, "v").sortWithinPartitions("v"), expected)


def groups_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups of equal ``v``; rows come sorted by it, and groups are small."""
    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        v = t.column("v").to_numpy()
        cut = int(np.searchsorted(v, v[-1])) if (v[1:] >= v[:-1]).all() else int(np.flatnonzero(v != v[-1])[-1]) + 1
        if cut:
            yield t.slice(0, cut)
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def met(rows: DataFrame, d: int) -> DataFrame:
    """``u``, ``w``, ``sim``: what the members of every neighbourhood learn, of members with ``new``, ``least``
    (the likeness to beat) and ``code``."""
    def block(ids: np.ndarray, new: np.ndarray, least: np.ndarray, x: np.ndarray, group: np.ndarray, n: int) -> pa.RecordBatch:
        size = np.bincount(group, minlength=n)
        at = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
        full = np.zeros((n, int(size.max()), d), dtype=np.float32)
        full[group, at] = x
        member, fresh, bound = np.full(full.shape[:2], -1), np.zeros(full.shape[:2], dtype=bool), np.full(full.shape[:2], np.inf)
        member[group, at], fresh[group, at], bound[group, at] = ids, new, least
        sim = full @ full.transpose(0, 2, 1)
        sim[~(fresh[:, :, None] | fresh[:, None, :]) | (member[:, :, None] == member[:, None, :]) | (member[:, None, :] < 0)] = UNKNOWN
        some = min(LEARN, sim.shape[2])
        best = np.partition(sim, -some, axis=2)[:, :, -some]
        g, i, j = np.nonzero((sim >= best[:, :, None]) & (sim > bound[:, :, None]) & (sim > UNKNOWN))
        return pa.RecordBatch.from_arrays([pa.array(member[g, i]), pa.array(member[g, j]), pa.array(sim[g, i, j])], names=["u", "w", "sim"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches):
            v, ids, new, least = (t.column(c).to_numpy() for c in ("v", "m", "new", "least"))
            starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
            codes = t.column("code").to_pylist()
            for i in range(0, len(starts), BLOCK):
                lo, hi = starts[i], starts[i + BLOCK] if i + BLOCK < len(starts) else len(v)
                own = starts[i:i + BLOCK] - lo
                group = np.searchsorted(own, np.arange(hi - lo), side="right") - 1
                if new[lo:hi].any():
                    yield block(ids[lo:hi], new[lo:hi], least[lo:hi], directions(codes[lo:hi], d), group, len(own))

    return rows.select("v", "m", "new", "least", "code").mapInArrow(run, "u long, w long, sim float")


def descended(nodes: DataFrame, size: int, d: int) -> DataFrame:
    """``u``, ``w``, ``sim``: the nearest ``DEGREE`` neighbours found of every node."""
    degree = min(DEGREE, size - 1)
    step = F.col("j") if size - 1 <= DEGREE else F.pmod(F.xxhash64("node", "j"), F.lit(size - 1))
    edges = nodes.select("node", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(degree - 1).cast("long"))).alias("j"))
    edges = edges.select(F.col("node").alias("u"), ((F.col("node") + 1 + step) % size).alias("w")).distinct()
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = written_bucketed(edges.withColumn("sim", F.lit(UNKNOWN).cast("float")).withColumn("new", F.lit(True)), "u")
    for turn in range(ROUNDS):
        members = edges.select(F.col("u").alias("v"), F.col("w").alias("m"), "new").unionByName(reversed_edges(edges))
        if turn == 0:  # likenesses to the node itself are known from the first round on
            members = members.unionByName(nodes.select(F.col("node").alias("v"), F.col("node").alias("m"), F.lit(False).alias("new")))
        worst = edges.groupBy("u").agg(F.when(F.count("*") < degree, UNKNOWN).otherwise(F.min("sim")).cast("float").alias("least"))
        found = met(with_codes(members, nodes.select("node", "code").join(worst.hint("merge"), F.col("node") == F.col("u")).drop("u"), size), d)
        both = edges.select("u", "w", "sim", F.lit(False).alias("new")).unionByName(found.withColumn("new", F.lit(True)))
        # one shuffle for both steps, and none for the next round's worst neighbours
        both = both.repartition(n, "u").groupBy("u", "w").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
        near = W.partitionBy("u").orderBy(F.col("sim").desc(), "w")
        nearest = both.withColumn("__r", F.row_number().over(near)).where(F.col("__r") <= degree).drop("__r")
        edges = written_bucketed(in_tasks(nearest, 2 * size * degree), "u")
        released(nodes.sparkSession)
        if edges.where("new").count() <= CHANGED * size * degree:
            break
    return edges.drop("new")


def released(spark: SparkSession) -> None:
    """Ask the driver to let go of finished rounds, so that Spark removes their shuffle files now."""
    spark.sparkContext._jvm.System.gc()


def numbered(rows: DataFrame) -> DataFrame:
    """A written copy of ``rows`` with ``node``, numbers from 0 without gaps."""
    rows = written(rows.withColumn("__m", F.monotonically_increasing_id()), "nodes")
    part = F.shiftright("__m", 33)
    sizes = rows.groupBy(part.alias("__p")).agg(F.count("*").alias("n"))  # a row per task
    before = sizes.select("__p", F.coalesce(F.sum("n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return rows.join(before, part == F.col("__p")).withColumn("node", F.col("__before") + F.col("__m") % (1 << 33)).drop("__p", "__before", "__m")


def build(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> Index:
    """The index of all rows. Rows with a null id, a null or zero vector, or one with null or non-finite components
    take no part; of rows that repeat an id, the one with the smallest vector does. Shorter vectors count as filled
    up with zeros. Other columns are ignored; an empty table gives an empty index."""
    rows = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector")).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("vector", trimmed(F.col("vector"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = written(keyed(rows), "vectors")
    size, d = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    spark = rows.sparkSession
    if not size:
        nothing = "node long, h1 long, h2 long, vector array<double>, code binary", "node long, vec_id long", "node long, ids binary, codes binary"
        return Index(*[spark.createDataFrame([], s) for s in nothing], 0, 0)
    classes = rows.groupBy("h1", "h2").agg(F.min_by("vector", "vec_id").alias("vector"))
    nodes = written_bucketed(coded(numbered(classes).select("node", "h1", "h2", "vector"), d), "node")
    members = written(rows.select("vec_id", "h1", "h2").join(nodes.select("node", "h1", "h2"), ["h1", "h2"]).select("node", "vec_id"), "members")
    size = nodes.count()
    if size == 1:
        return Index(nodes, members, spark.createDataFrame([], "node long, ids binary, codes binary"), d, 1)
    edges = descended(nodes, size, d)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches):
            v, m, codes = t.column("v").to_numpy(), t.column("m").to_numpy(), t.column("code").to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])).tolist()
            cuts = [*starts, len(v)]
            yield pa.RecordBatch.from_arrays([pa.array(v[starts]), pa.array([m[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                                              pa.array([b"".join(codes[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], names=["node", "ids", "codes"])

    members_of = edges.select(F.col("u").alias("v"), F.col("w").alias("m")).unionByName(reversed_edges(edges.withColumn("new", F.lit(False))).drop("new")).distinct()
    graph = with_codes(members_of, nodes.select("node", "code"), size).select("v", "m", "code").mapInArrow(run, "node long, ids binary, codes binary")
    return Index(nodes, members, written_bucketed(graph, "node"), d, size)


# --- search
#: Fixed value: the columns of a query's beam, nearest first.
STATE = "qid long, code binary, ids binary, sims binary, done binary, open boolean"


def beam(qid: int, code: bytes, ids: np.ndarray, sims: np.ndarray, done: np.ndarray) -> tuple:
    """A query's state from nodes in any order; a node that comes twice has been expanded if either has."""
    order = np.lexsort((~done, ids))
    ids, sims, done = ids[order], sims[order], done[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]])
    ids, sims, done = ids[first], sims[first], done[first]
    order = np.lexsort((ids, -sims))[:BEAM]
    return qid, code, ids[order].tobytes(), sims[order].tobytes(), done[order].tobytes(), bool((~done[order]).any())


def read_beam(ids: bytes, sims: bytes, done: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(ids, dtype=np.int64), np.frombuffer(sims, dtype=np.float32), np.frombuffer(done, dtype=bool)


def begun(queries: DataFrame, index: Index) -> DataFrame:
    """The first states of ``qid``, ``code`` and ``own`` (its node or null)."""
    d = index.dimension
    pivots = index.nodes.select("node", "code").orderBy(F.xxhash64("node", F.lit(5)), "node").limit(PIVOTS).collect()
    shared = queries.sparkSession.sparkContext.broadcast(([r["node"] for r in pivots], [bytes(r["code"]) for r in pivots]))  # PIVOTS rows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, codes = shared.value
        nodes, vectors = np.array(nodes, dtype=np.int64), directions(codes, d)
        out = []
        for b in batches:
            for qid, code, own in zip(*[c.to_pylist() for c in b.columns], strict=True):
                sims = vectors @ directions([code], d)[0]
                near = np.argsort(-sims, kind="stable")[:STARTS]
                ids, sims = nodes[near], sims[near]
                if own is not None:
                    ids, sims = np.concatenate([ids, [own]]), np.concatenate([sims, np.ones(1, dtype=np.float32)])
                out.append(beam(qid, code, ids, sims.astype(np.float32), np.zeros(len(ids), dtype=bool)))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), *[pa.binary()] * 4, pa.bool_()], strict=True)], names=["qid", "code", "ids", "sims", "done", "open"])

    return queries.select("qid", "code", "own").mapInArrow(run, STATE)


def expanded(states: DataFrame, graph: DataFrame, d: int, n_queries: int) -> DataFrame:
    """One round: the nearest nodes that are not done meet the graph, and the states take in what they find."""
    def front(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for qid, code, *parts in zip(*[b.column(c).to_pylist() for c in ("qid", "code", "ids", "sims", "done")], strict=True):
                ids, sims, done = read_beam(*parts)
                least = float(sims[-1]) if len(sims) == BEAM else UNKNOWN
                rows += [(i, qid, code, least) for i in ids[np.flatnonzero(~done)[:EXPAND]].tolist()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.binary(), pa.float32()], strict=True)], names=["node", "qid", "code", "least"])

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            qids, out, kept = b.column("qid"), [], []
            for i, (code, least, ids, codes) in enumerate(zip(*[b.column(c).to_pylist() for c in ("code", "least", "ids", "codes")], strict=True)):
                ids, sims = np.frombuffer(ids, dtype=np.int64), directions([codes], d) @ directions([code], d)[0]
                hit = sims > least
                if hit.any():
                    kept.append(i)
                    out.append((ids[hit].tobytes(), sims[hit].tobytes()))
            k = len(kept)
            ids, sims = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([qids.take(pa.array(kept, pa.int64())), pa.array(ids, pa.binary()), pa.array(sims, pa.binary())], names=["qid", "ids", "sims"]) if k else pa.RecordBatch.from_arrays(
                [pa.nulls(0, pa.int64()), pa.nulls(0, pa.binary()), pa.nulls(0, pa.binary())], names=["qid", "ids", "sims"])

    fronts = states.where("open").mapInArrow(front, "node long, qid long, code binary, least float")
    met_nodes = fronts.join(graph.hint("merge"), "node").select("qid", "code", "least", "ids", "codes")
    found = in_tasks(met_nodes, n_queries * EXPAND).mapInArrow(near, "qid long, ids binary, sims binary")
    rows = states.withColumn("kind", F.lit(0)).unionByName(found.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def merged(key: tuple, group: Iterator[tuple]) -> Iterator[tuple]:
        _, _, qid, code, *parts, is_open = next(group)
        if not is_open:
            yield qid, code, *parts, False
            return
        ids, sims, done = read_beam(*parts)
        done = done.copy()
        done[np.flatnonzero(~done)[:EXPAND]] = True
        all_ids, all_sims, held = [ids], [sims], 0
        for r in group:  # at most EXPAND rows
            all_ids.append(np.frombuffer(r[4], dtype=np.int64))
            all_sims.append(np.frombuffer(r[5], dtype=np.float32))
            held += len(all_ids[-1])
        yield beam(qid, code, np.concatenate(all_ids), np.concatenate(all_sims), np.concatenate([done, np.zeros(held, dtype=bool)]))

    rows = rows.select(F.col("qid").alias("key"), "kind", "qid", "code", "ids", "sims", "done", "open")
    return in_tasks(folded(rows, ["key"], merged, STATE, then=("kind",)), n_queries * EXPAND)


def scored(states: DataFrame, queries: DataFrame, index: Index) -> DataFrame:
    """``qid``, ``node``, ``score``: the nearest of every beam, by the vectors as given."""
    d = index.dimension

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for qid, ids in zip(b.column("qid").to_pylist(), b.column("ids").to_pylist(), strict=True):
                ids = np.frombuffer(ids, dtype=np.int64)[:RESCORE]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), qid)), pa.array(ids)], names=["qid", "node"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                width = max(d, *[int(np.diff(b.column(c).offsets.to_numpy()).max()) for c in ("one", "two")])
                x, y = matrix(b.column("one"), width), matrix(b.column("two"), width)
                x, y = (z / np.abs(z).max(axis=1, keepdims=True) if (np.abs(z).max(axis=1) > 1e100).any() or (np.abs(z).max(axis=1) < 1e-100).any() else z for z in (x, y))
                score = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
                yield pa.RecordBatch.from_arrays([b.column("qid"), b.column("node"), pa.array(score)], names=["qid", "node", "score"])

    pairs = states.mapInArrow(best, "qid long, node long")
    pairs = pairs.join(index.nodes.select("node", F.col("vector").alias("two")).hint("merge"), "node")
    pairs = pairs.join(queries.select("qid", F.col("vector").alias("one")).hint("merge"), "qid")
    return pairs.select("qid", "node", "one", "two").mapInArrow(run, "qid long, node long, score double")


def search(index: Index, queries: DataFrame, k: int = 5, query_id: str = "vec_id", vector: str = "embedding", own: bool = False) -> DataFrame:
    """The ``k`` nearest rows found for every query: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (cosine),
    nearest first, ties to the smaller id. ``own``: queries are rows of the index by their id, which is then no
    candidate. Queries without id or direction have no result, repeated ids are one query as in ``build``; where
    the index has fewer rows, all come back."""
    rows = queries.select(F.col(f"`{query_id}`").cast("long").alias("query_id"), F.col(f"`{vector}`").alias("vector")).where(F.col("query_id").isNotNull() & usable(F.col("vector")))
    rows = written(keyed(rows.withColumn("vector", trimmed(F.col("vector"))).groupBy("query_id").agg(F.min("vector").alias("vector"))), "queries")
    if not index.size:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    classes = rows.groupBy("h1", "h2").agg(F.min("query_id").alias("qid"), F.min_by("vector", "query_id").alias("vector"))
    at_home = index.nodes.select("h1", "h2", F.col("node").alias("own"))
    classes = classes.join(at_home, ["h1", "h2"], "left")
    d = index.dimension
    cut = F.slice("vector", 1, d)  # what the index has no component for counts in the length only
    some = F.exists(cut, lambda x: x != 0)
    whole = classes.withColumn("__v", F.col("vector")).withColumn("vector", F.when(some, cut).otherwise(F.array(F.lit(1.0))))
    classes = written(coded(whole, d).withColumn("vector", F.col("__v")).drop("__v"), "query-classes")
    states = written(begun(classes, index), "beams")
    n_queries = classes.count()
    while states.where("open").limit(1).count():
        states = written(expanded(states, index.graph, d, n_queries), "beams")
        released(rows.sparkSession)
    found = scored(states, classes, index)
    # of every node the smallest ids, of every query one more than asked for
    first = W.partitionBy("node").orderBy("vec_id")
    members = index.members.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= k + 1).select("node", "vec_id")
    nearest = W.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id")
    found = found.join(members, "node").withColumn("__r", F.row_number().over(nearest)).where(F.col("__r") <= k + 1).select("qid", "vec_id", "score")
    asked = rows.select("query_id", "h1", "h2").join(classes.select("qid", "h1", "h2"), ["h1", "h2"]).select("query_id", "qid")
    out = asked.join(found, "qid")
    out = out.where("vec_id <> query_id") if own else out
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return out.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

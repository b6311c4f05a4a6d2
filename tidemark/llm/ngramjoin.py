"""Near-duplicate documents: a Jaccard self-join on word shingles with rare-first prefix filtering.

Two documents link when their shingle sets have a Jaccard similarity of at least 0.75; a result row names
the smallest document that links lead to.

1. Documents with equal sets are one class (grouped by a 128-bit digest of the set, with map-side minima).
2. A count sketch of fixed size over the shingles of all documents orders shingles from rare to frequent.
   Any order common to all documents gives the same links; the sketch only makes prefixes selective.
3. Of a set of n shingles, the rarest n - ceil(0.75 n) + 1 form its prefix: linked sets share a prefix
   shingle. Prefix rows are dealt out by shingle, a task's equal sets once. Shingles that a single class
   has go at once; shingles that the same classes have - a passage, a copied text - are one from here on,
   with the earliest place of each class.
4. A shingle's classes are first paired with one leader only, the class that shares most, which is linear in
   the rows. After the length and positional filters, a pair is verified once, with a suffix filter and
   then the whole sets.
5. Within a shingle, classes that the verified links have not yet joined are then paired with each other -
   group against group, so members of one component never meet. Linked sets that are still apart share a
   prefix shingle, so no link between components is missed; pairs verified before are not verified again.
6. Components of the verified links, and the smallest document of each.
7. The number of links of each class: links lie inside components, so the sets of a component are dealt into
   layers by size and these into blocks of bounded size; every pair of blocks whose sizes let sets link is a group
   of its own in which all overlaps are counted. No pair is written; copies count by the size of their class.

Sets are fetched for the classes of candidate pairs only: a Bloom filter of fixed size with their documents
picks rows before shingling. Fixed sizes: the sketch and the filter, which the driver sums up and sends to
the tasks. No text is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark.llm.common import added, slices, texts_of, with_columns, written
from tidemark.llm.components import components

WORDS = 5
#: Counters of the sketch, a power of two, and the rows that carry them.
SKETCH_BITS = 20
CHUNKS = 64
#: Bits of the Bloom filter, a power of two (8 MB).
BLOOM_BITS = 26
#: When the links of a component are counted: sets and bytes of sets in a block at most, about, and the share of
#: the square root of a layer's sets that it has as blocks, so that copies grow slowly and many tasks have a part.
BLOCK_SETS, BLOCK_BYTES, BLOCK_SHARE = 4096, 16 << 20, 1 / 8
#: Sets of a layer differ in size by less than this ratio; over 4/3, so linked sets lie at most a layer apart.
LAYER = 1.4
#: Odd multipliers that set apart the places of a shingle.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


# --- sets
def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: shifts and odd multiplications, one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles of five words. With fewer words the whole
    sequence is one; without words there are none. A-Z count as lower case; words end at ASCII space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII only, both
    n = len(words)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    with np.errstate(over="ignore"):
        if n < WORDS:
            return mixed((h * _PLACES[:n]).sum(keepdims=True) + np.uint64(n))
        return np.unique(mixed(sum(h[i:n - WORDS + 1 + i] * _PLACES[i] for i in range(WORDS))))


def digest_of(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def name_of(digest: bytes) -> int:
    """48 bits of a digest, to find candidates by. Unrelated sets of one name only give candidates that
    verification refuses; a link could hide only between near duplicates of one name, 1 pair in 2^48."""
    return int.from_bytes(digest[:6], "little")


def name_column(digest: Column) -> Column:
    """``name_of`` as a column expression."""
    return F.conv(F.hex(F.concat(*[F.substring(digest, i, 1) for i in range(6, 0, -1)])), 16, 10).cast("long")


def bucket(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def needed(n: int, m: int) -> int:
    """The least overlap of linked sets of n and m elements: 100 o >= 75 (n + m - o)."""
    return -(-3 * (n + m) // 7)


def suffix_distance(a: np.ndarray, b: np.ndarray, depth: int) -> int:
    """A lower bound on the elements that only one of two sorted arrays has: both are cut at the middle
    value of one, and the halves differ at least by their sizes."""
    if depth == 0 or len(a) == 0 or len(b) == 0:
        return abs(len(a) - len(b))
    mid = a[len(a) // 2]
    i, j = len(a) // 2, int(np.searchsorted(b, mid))
    return suffix_distance(a[:i], b[:j], depth - 1) + suffix_distance(a[i:], b[j:], depth - 1)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    n, m = len(a), len(b)
    need = needed(n, m)
    if min(n, m) < need or suffix_distance(a, b, 4) > n + m - 2 * need:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (n + m - both)


# --- passes over the texts
def first_pass(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: ``doc_id``, ``digest`` (null: no words), ``n`` of each document; and from each task
    the sketch's ``counts`` by ``chunk``, equal sets counted once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, sketch = set(), np.zeros(1 << SKETCH_BITS, dtype=np.int32)
        for b in slices(batches, "text"):
            digests, sizes = [], []
            for t in texts_of(b, "text"):
                s = shingles(t)
                d = digest_of(s) if len(s) else None
                digests.append(d)
                sizes.append(len(s))
                if d is not None and d not in seen:
                    seen.add(d)
                    np.add.at(sketch, bucket(s), 1)
            k = len(sizes)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                                             names=["doc_id", "digest", "n", "chunk", "counts"])
        parts = [(i, p) for i, p in enumerate(sketch.reshape(CHUNKS, -1)) if p.any()]
        k = len(parts)
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64()), pa.array([i for i, _ in parts], pa.int32()), pa.array([p.tobytes() for _, p in parts], pa.binary())],
                                         names=["doc_id", "digest", "n", "chunk", "counts"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, digest binary, n long, chunk int, counts binary")


def summed_sketch(parts: DataFrame) -> np.ndarray:
    """The tasks' sketches added up chunk by chunk in a stream; the sum has a fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[chunk] = total.get(chunk, 0) + np.frombuffer(counts, dtype=np.int32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([np.minimum(t, (1 << 24) - 1).astype(np.int32).tobytes() for t in total.values()], pa.binary())], names=["chunk", "counts"])

    sketch = np.zeros((CHUNKS, (1 << SKETCH_BITS) // CHUNKS), dtype=np.int32)
    rows = parts.where("chunk is not null").select("chunk", "counts").repartition(CHUNKS // 4, "chunk").mapInArrow(run, "chunk int, counts binary")
    for r in rows.collect():  # one row per chunk
        sketch[r["chunk"]] = np.frombuffer(r["counts"], dtype=np.int32)
    return sketch.reshape(-1)


def prefixes(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``token``, ``name``, ``n``, ``pos``: the rarest shingles of every set, a task's equal sets once."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        for b in slices(batches, "text"):
            tokens, names, sizes, places = [], [], [], []
            for t in texts_of(b, "text"):
                s = shingles(t)
                d = digest_of(s) if len(s) else None
                if d is None or d in seen:
                    continue
                seen.add(d)
                k = prefix_length(len(s))
                # s ascends and the sort is stable, so ties fall to the smaller shingle
                rank = np.argsort((counts[bucket(s)].astype(np.uint64) << np.uint64(40)) | (s >> np.uint64(24)), kind="stable")
                tokens.append((s[rank[:k]] >> np.uint64(16)).astype(np.int64))
                names.append(np.full(k, name_of(d), dtype=np.int64))
                sizes.append(np.full(k, len(s), dtype=np.int32))
                places.append(np.arange(1, k + 1, dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, names, sizes, places)], names=["token", "name", "n", "pos"])

    return docs.select("text").mapInArrow(run, "token long, name long, n int, pos int")


def bloom_rows(ids: Column) -> list[Column]:
    """Three bits of the filter for an id, as columns."""
    return [F.pmod(F.xxhash64(ids, F.lit(i)), F.lit(1 << BLOOM_BITS)) for i in range(3)]


def bloom(ids: DataFrame) -> np.ndarray:
    """The bits of all ``rep``s, or-ed by Spark into words of 64; at most 2^BLOOM_BITS / 64 rows arrive."""
    bits = ids.select(F.explode(F.array(*bloom_rows(F.col("rep")))).alias("bit"))
    words = bits.groupBy(F.expr("bit div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("x"))
    out = np.zeros((1 << BLOOM_BITS) // 64, dtype=np.int64)
    got = words.toArrow()
    out[got.column("w").to_numpy()] = got.column("x").to_numpy()
    return out.view(np.uint64)


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``digest``, ``members`` (the sorted set) of the documents named in ``wanted`` (``rep``), and perhaps a
    few more, which later joins leave out."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom(wanted))
    rows = docs.select("text", F.array(*bloom_rows(F.col("doc_id").cast("long"))).alias("bits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for b in slices(batches, "text"):
            at = b.column(1).flatten().to_numpy().reshape(-1, 3)
            hit = ((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)
            if not hit.any():
                continue
            digests, members = [], []
            for t in texts_of(b.filter(pa.array(hit)), "text"):
                s = shingles(t)
                d = digest_of(s) if len(s) else None
                if d is not None and d not in seen:
                    seen.add(d)
                    digests.append(d)
                    members.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(members, pa.binary())], names=["digest", "members"])

    return rows.mapInArrow(run, "digest binary, members binary")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``a``, ``b`` of those pairs of class ids whose sets link. Each pair is verified once."""
    of = classes.select("cid", "digest", "rep")
    named = (pairs.join(of.select(F.col("cid").alias("a"), F.struct("digest", "rep").alias("one")), "a")
             .join(of.select(F.col("cid").alias("b"), F.struct("digest", "rep").alias("two")), "b"))
    named = written(named, "named-pairs")
    sets = sets_of(docs, named.select("one.rep").unionByName(named.select("two.rep")).distinct())
    sets = sets.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "digest")  # one shuffle for both joins
    one, two = F.col("one.digest"), F.col("two.digest")
    both = (named.select("a", "b", one.alias("d1"), two.alias("d2"))
            .join(sets.select(F.col("digest").alias("d1"), F.col("members").alias("left")), "d1")
            .join(sets.select(F.col("digest").alias("d2"), F.col("members").alias("right")), "d2").select("a", "b", "left", "right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "left"):
            rows = zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)
            yield b.filter(pa.array([linked(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)) for x, y in rows], pa.bool_())).select(["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


# --- numbers of links
def link_counts(one: list[np.ndarray], two: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """For each set of ``one`` the ``rows`` of those sets of ``two`` that link with it, added up."""
    values, owner = np.concatenate(two), np.repeat(np.arange(len(two)), [len(s) for s in two])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    sizes, out = np.array([len(s) for s in two]), np.zeros(len(one), dtype=np.int64)
    for i, s in enumerate(one):
        lo, hi = np.searchsorted(values, s, "left"), np.searchsorted(values, s, "right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(two))
        out[i] = rows[100 * both >= 75 * (len(s) + sizes - both)].sum()
    return out


def links_of(docs: DataFrame, members: DataFrame, placed: DataFrame) -> DataFrame:
    """``cid``, ``n_links``: for each class, how many other rows have a text that links with its.

    A component's sets are laid in layers by size and the layers cut into blocks as large as a task bears; blocks
    meet within a layer and with the next one, so a set is copied as often as three layers have blocks."""
    rows = members.where("digest is not null").groupBy(F.col("digest").alias("__d")).agg(F.count("*").alias("rows"), F.min("n").alias("n"))
    classes = placed.join(rows, F.col("digest") == F.col("__d")).drop("__d")
    classes = written(classes.withColumn("layer", F.floor(F.log("n") / math.log(LAYER)).cast("long")), "class-rows")
    blocks = F.ceil(F.greatest(F.sqrt(F.count("*")) * BLOCK_SHARE, F.count("*") / BLOCK_SETS, 8 * F.sum("n") / BLOCK_BYTES)).cast("long")
    layers = classes.groupBy("comp", "layer").agg(F.count("*").alias("__k"), blocks.alias("__blocks"))
    by_comp = F.col("comp").alias("__comp")
    # each layer with its own blocks and its neighbours', in components of several sets
    near = layers.withColumn("__step", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).groupBy(by_comp, (F.col("layer") + F.col("__step")).alias("__layer")).agg(
        F.sum("__k").alias("__near"), *[F.coalesce(F.max(F.when(F.col("__step") == -d, F.col("__blocks"))), F.lit(0)).alias(f"__at{d + 1}") for d in (-1, 0, 1)])
    several = written(classes.join(near, (F.col("comp") == F.col("__comp")) & (F.col("layer") == F.col("__layer"))).where("__near > 1 and __at1 > 0")
                      .withColumn("block", F.pmod(F.xxhash64("cid"), "__at1")).drop("__comp", "__layer", "__near"), "classes-to-link")
    sets = sets_of(docs, several.select("rep").distinct()).dropDuplicates(["digest"])
    own = F.shiftleft("layer", 32) + F.col("block")
    ids = [F.expr(f"transform(sequence(0L, __at{d + 1} - 1), x -> shiftleft(layer + {d}, 32) + x)") for d in (-1, 0, 1)]
    others = F.concat(*[F.when(F.col(f"__at{i}") > 0, x).otherwise(F.array().cast("array<bigint>")) for i, x in enumerate(ids)])
    dealt = (several.select("digest", "cid", "comp", "rows", own.alias("block"), F.explode(others).alias("other")).join(sets, "digest")
             .select("cid", "comp", "rows", "block", "members", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))

    def run(group: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, dtype=np.uint64) for x in group.column("members").to_pylist()]
        cids, rows, block = (group.column(c).to_numpy() for c in ("cid", "rows", "block"))
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        x, y = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        out = np.zeros(len(sets), dtype=np.int64)
        if len(x) and len(y):
            out[x] = link_counts([sets[i] for i in x], [sets[i] for i in y], rows[y])
            if lo == hi:
                out -= rows  # every set links with itself
            else:
                out[y] = link_counts([sets[i] for i in y], [sets[i] for i in x], rows[x])
        return pa.table({"cid": cids, "n": out})

    found = dealt.groupBy("comp", "lo", "hi").applyInArrow(run, "cid long, n long").groupBy("cid").agg(F.sum("n").alias("__n"))
    return classes.select("cid", "rows").join(found, "cid", "left").select(F.col("cid").alias("__cid"), (F.col("rows") - 1 + F.coalesce("__n", F.lit(0))).alias("n_links"))


# --- candidates
def may_link(n: str, i: str, m: str, j: str) -> Column:
    """Length and positional filters for sets of n and m whose common shingle is at places i and j: the
    smaller set must be three quarters of the larger, and what can still be common must be enough. The
    positional bound holds at a pair's first common shingle, where the pair is found if anywhere."""
    n, i, m, j = (F.col(x) for x in (n, i, m, j))
    return (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (7 * (1 + F.least(n - i, m - j)) >= 3 * (n + m))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``doc_id`` (long) and ``text``: a row per document with its ``digest``; and per class ``digest``,
    ``rep``, ``cid``, ``comp`` and ``least``, the smallest id in the component."""
    first = written(first_pass(docs), "shingle-sets")
    members = first.where("chunk is null").select("doc_id", "digest", "n")
    classes = members.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("name", name_column(F.col("digest"))), "classes")

    # shingles in the prefixes of two names or more; shingles that the same names have count as one
    by_token = W.partitionBy("token")
    rows = prefixes(docs, summed_sketch(first))
    low, high = F.min("name").over(by_token), F.max("name").over(by_token)
    rows = rows.withColumn("__low", low).withColumn("__high", high).where("__low <> __high").dropDuplicates(["token", "name"])
    same = F.xxhash64("__low", "__high", F.bit_xor(F.xxhash64("name")).over(by_token), F.count("*").over(by_token))
    rows = rows.select("name", "n", "pos", F.count("*").over(by_token).alias("k"), same.alias("token"))
    rows = written(rows.groupBy("token", "name").agg(F.min("n").alias("n"), F.min("pos").alias("pos"), F.max("k").alias("k")), "shared-names")
    # how much of a set others share: of a text and its edited copies, the text shares most
    central = rows.groupBy(F.col("name").alias("__name")).agg(F.sum("k").alias("central"))
    names = classes.select("cid", "name").join(central, F.col("name") == F.col("__name")).drop("name")
    shared = written(rows.join(names, F.col("name") == F.col("__name")).select("token", "cid", "n", "pos", "central"), "shared-shingles")

    # one leader for each shingle
    leaders = shared.groupBy(F.col("token").alias("__t")).agg(F.min(F.struct(-F.col("central"), "cid", "n", "pos")).alias("__lead"), F.count("*").alias("__k")).where("__k > 1")
    led = shared.join(leaders, F.col("token") == F.col("__t")).select(
        "n", "pos", F.col("cid").alias("y"), F.col("__lead.cid").alias("x"), F.col("__lead.n").alias("m"), F.col("__lead.pos").alias("j"))
    pairs = written(ordered(led.where(may_link("n", "pos", "m", "j"))), "leader-pairs")
    links = written(verified(docs, classes, pairs), "leader-links")
    # rows that repeat an id with another text join their classes
    several = (members.where("doc_id is not null and digest is not null").join(classes.select("digest", "cid"), "digest")
               .groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("b"), F.collect_set("cid").alias("all")).where("a <> b")
               .select("a", F.explode("all").alias("b")).where("a <> b"))
    known = written(links.unionByName(several), "known-links")
    found = components(known)

    # classes that are still apart within a shingle, component against component
    placed = shared.join(found.select(F.col("node").alias("__node"), "component"), F.col("cid") == F.col("__node"), "left")
    placed = placed.select("token", "cid", "n", "pos", F.coalesce("component", "cid").alias("comp"))
    # a group may only meet another where its members could: by sizes, and by what the best placed can still share
    reach = F.max(7 * (1 + F.col("n") - F.col("pos")) - 3 * F.col("n"))
    groups = placed.groupBy("token", "comp").agg(F.min("n").alias("low"), F.max("n").alias("high"), reach.alias("reach"))
    several_groups = groups.groupBy("token").agg(F.count("*").alias("__k")).where("__k > 1").select("token")
    groups = written(groups.join(several_groups, "token"), "token-groups")
    one, two = (groups.select("token", *[F.col(c).alias(f"{c}{i}") for c in ("comp", "low", "high", "reach")]) for i in (1, 2))
    apart = (one.join(two, "token").where("comp1 < comp2 and 4 * high1 >= 3 * low2 and 4 * high2 >= 3 * low1 and reach1 >= 3 * low2 and reach2 >= 3 * low1")
             .select("token", F.col("comp1").alias("c1"), F.col("comp2").alias("c2")))
    side1 = placed.select("token", F.col("comp").alias("c1"), F.col("cid").alias("x"), "n", "pos")
    side2 = placed.select("token", F.col("comp").alias("c2"), F.col("cid").alias("y"), F.col("n").alias("m"), F.col("pos").alias("j"))
    more = apart.join(side1, ["token", "c1"]).join(side2, ["token", "c2"]).where(may_link("n", "pos", "m", "j"))
    more = written(ordered(more.select("x", "y")).join(pairs, ["a", "b"], "left_anti"), "other-pairs")
    found = components(known.unionByName(verified(docs, classes, more)))

    # the smallest document of each component, back to the rows
    placed = classes.join(found, F.col("cid") == F.col("node"), "left").select("digest", "rep", "cid", F.coalesce("component", "cid").alias("comp"))
    least = placed.groupBy(F.col("comp").alias("__comp")).agg(F.min("rep").alias("least"))
    return members, written(placed.join(least, F.col("comp") == F.col("__comp")).drop("__comp"), "placed-classes")


def answered(members: DataFrame, placed: DataFrame) -> DataFrame:
    """The rows of ``members`` with ``cid`` and ``component_id``."""
    answer = placed.select(F.col("digest").alias("__digest"), "least", "cid")
    return members.join(answer, F.col("digest") == F.col("__digest"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "cid", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, the smallest id among the
    documents that links lead to, and ``n_links``, how many other rows have a text that links with this one.

    Null or empty texts and texts without words have no shingles and link with nothing; their component is
    their own id. Rows that repeat an id are one document: whatever any of them links with, it links with.
    Null ids are never the smallest; they get the smallest id that their text leads to, or null. Other
    columns are ignored; an empty table gives an empty result."""
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    members, placed = grouped(docs)
    links = links_of(docs, members, placed)
    return answered(members, placed).join(links, F.col("cid") == F.col("__cid"), "left").select(
        "doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def digested(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__digest``, null for texts without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = [shingles(t) for t in texts_of(b, "text")]
            yield with_columns(b, {"__digest": pa.array([digest_of(s) if len(s) else None for s in sets], pa.binary())})

    return docs.mapInArrow(run, added(docs, [T.StructField("__digest", T.BinaryType())]))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when of every component only its smallest document does; of rows that
    repeat this id one stays. A row with a null id goes where its component has a document with an id; of
    components with null ids only one row stays, the smallest by the digest of its set and the hash of its
    text. Rows with a null id and no words link with nothing and stay."""
    members, placed = grouped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    kept = written(answered(members, placed).where("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct(), "kept-documents")
    order = W.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.join(kept, F.col("doc_id") == F.col("__id"))
    one = named.withColumn("__row", F.row_number().over(order)).where("__row = 1").select(*columns)
    # rows without an id: the winner of a component is found with map-side minima
    unnamed = digested(docs.where("doc_id is null"))
    alone = placed.where("least is null").select(F.col("digest").alias("__d"), F.col("comp").alias("__comp"))
    winners = (unnamed.select(F.struct(*columns).alias("__doc"), "__digest", F.xxhash64("text").alias("__h")).join(alone, F.col("__digest") == F.col("__d"))
               .groupBy("__comp").agg(F.min_by("__doc", F.struct("__digest", "__h")).alias("__doc")).select("__doc.*"))
    return one.unionByName(winners).unionByName(unnamed.where("__digest is null").select(*columns))

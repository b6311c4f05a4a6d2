"""Fingerprints (2), WARC (7), n-gram join (8), mixing (9) and the pipeline."""

import hashlib
import math
import pickle
import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import fingerprint, mixing, ngramjoin, quality, warc
from tidemark.llm.components import components
from tidemark.session import settings

from .conftest import SF, TEXTS
from .test_filters import brute_measure


# --- fingerprints
def paragraph_set(text):
    return set(re.findall(r"[^\x20\x09-\x0D]+(?:[\x20\x09\x0B-\x0D]+[^\x20\x09-\x0D]+){0,19}", text or ""))


def likeness(a, b):
    return 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))


def brute_fingerprints(rows):
    """(doc_id, text) -> counts by (doc_id, n_chars, digest of the edited text, likenesses)."""
    order = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i))
    least = {i: min((t or "" for j, t in rows if j == i), key=str.encode) for i in order}
    out = Counter()
    for i, t in rows:
        t, after = t or "", least[order[(order.index(i) + 1) % len(order)]]
        k = len(t) // 4
        edited = t[:len(t) - k] + after[:k]
        own = paragraph_set(t)
        out[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(likeness(own, paragraph_set(edited)), 9), round(likeness(own, paragraph_set(after)), 9))] += 1
    return out


def test_fingerprints_against_brute_force(spark, corner_docs, no_docs):
    docs = corner_docs.select("doc_id", "text", "near_next")
    got = fingerprint.compare(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == brute_fingerprints([tuple(r)[:2] for r in docs.collect()])
    by_text = {}
    texts = {i: t or "" for i, t in enumerate(TEXTS)}
    for r in got:
        if r.doc_id is not None:
            assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert fingerprint.compare(no_docs).count() == 0
    alone = fingerprint.compare(spark.createDataFrame([(7, "abcd efgh")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0


def test_differences_are_recovered_by_larger_sketches(spark):
    rng = random.Random(3)
    sets = []
    for i, (common, only) in enumerate([(0, 0), (5, 0), (3, 1), (40, 6), (10, 30), (500, 200), (0, 3000)]):
        keys = [rng.getrandbits(63) for _ in range(common + 2 * only)]
        sets.append((i, keys[:common + only], keys[:common] + keys[common + only:]))
    pairs = spark.createDataFrame([*sets, (99, None, [5])], "id long, a array<bigint>, b array<bigint>")
    got = {r.id: r for r in fingerprint.differences(pairs, ["id"], "a", "b", with_digests=True).collect()}
    for i, a, b in [*sets, (99, [], [5])]:
        want = {(x, 1) for x in set(a) - set(b)} | {(x, -1) for x in set(b) - set(a)}
        assert ({tuple(x) for x in got[i].digests} if i in got else set()) == want
        assert (got[i].d if i in got else 0) == len(want)
    assert fingerprint.differences(pairs.limit(0), ["id"], "a", "b").count() == 0


def test_larger_sketches_stay_within_the_buckets(spark, monkeypatch):
    rng = random.Random(8)
    sets = [(i % 90, i, [rng.getrandbits(63) for _ in range(i % 150)], [rng.getrandbits(63) for _ in range(i % 70)]) for i in range(300)]
    plans, write = [], fingerprint.written_bucketed

    def seen(df, key):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, key)

    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        pairs = write(spark.createDataFrame(sets, "id long, row long, a array<bigint>, b array<bigint>"), "id")
        monkeypatch.setattr(fingerprint, "written_bucketed", seen)
        got = {(r.id, r.row): r.d for r in fingerprint.differences(pairs, ["id", "row"], "a", "b").collect()}
    assert got == {(i, r): len(a) + len(b) for i, r, a, b in sets if a or b}
    assert 1 < len(plans) <= 3  # nearly all pairs are done with the second sketch
    assert not any("Exchange hashpartitioning" in p for p in plans)


# --- WARC
def pages_frame(spark):
    big = "<p>é" + "x" * 1500
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (3, None, big), (4, "http://c/", "small"), (5, "http://d/", "small"), (6, "", None), (7, "u", ""),
            (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" + "z" * 2_000_000), (3, "again", big), (None, "no id", big), (None, "no id", "y" * 1000)]
    return spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, payload int"), rows, big


def test_archives_round_trip(spark):
    pages, rows, big = pages_frame(spark)
    manifest = warc.write_archives(pages)
    assert sum(r.n_records for r in manifest.collect()) == len(rows)
    got = warc.read_archives(manifest, with_payload=True).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.record_type == ("revisit" if r.payload is None else "response")
        if r.payload is not None:
            assert r.payload_bytes == len(r.payload) and r.payload_digest == hashlib.sha1(r.payload).hexdigest()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter((i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in rows)
    assert sorted((str(r.page_id), r.refers_to) for r in got if r.record_type == "revisit") == [("1", 3), ("2", 3), ("None", 3)]
    empty = warc.write_archives(pages.limit(0))
    assert warc.read_archives(empty).count() == 0


def test_revisits_of_other_or_missing_responses_fail(spark, tmp_path):
    html, other = b"<p>" + b"x" * 2000, b"<p>" + b"y" * 2000
    for name, target, held in (("right", 3, html), ("digest", 3, other), ("length", 3, html + b"x"), ("missing", 4, html)):
        path = tmp_path / name
        path.write_bytes(warc.record(3, "http://a.example/", held, None) + warc.record(1, "http://a.example/", html, target))
        manifest = spark.createDataFrame([(str(path), 2)], "path string, n_records long")
        if name == "right":
            assert warc.read_archives(manifest).count() == 2
        else:
            with pytest.raises(warc.Damaged):
                warc.read_archives(manifest).count()


def test_each_record_is_a_gzip_member_and_damage_is_found():
    data = warc.record(5, "http://a/", b"p" * 3000, None) + warc.record(6, None, b"p" * 3000, 5)
    first = zlib.decompressobj(31)
    assert first.decompress(data).endswith(b"p\r\n\r\n") and first.unused_data.startswith(b"\x1f\x8b")
    for size in (1, 7, 1 << 16):
        chunks = (data[i:i + size] for i in range(0, len(data), size))
        found = [warc.read_record(m, True) for m in warc.members(chunks)]
        assert [(f["page_id"], f["record_type"], f["payload_bytes"], f["refers_to"]) for f in found] == [(5, "response", 3000, None), (6, "revisit", 3000, 5)]
    with pytest.raises(warc.Damaged):
        [warc.read_record(m, False) for m in warc.members(iter([data[:-20]]))]
    plain = zlib.decompress(warc.record(5, None, b"p" * 3000, None), 31)
    for broken in (plain.replace(b"pppp", b"pppq", 1), plain + b"more", plain.replace(b"WARC/1.1", b"WARC/9.9"), plain[:-10]):
        gz = zlib.compressobj(wbits=31)
        with pytest.raises(warc.Damaged):
            [warc.read_record(m, False) for m in warc.members(iter([gz.compress(broken) + gz.flush()]))]


# --- n-gram join
def shingle_set(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute_components(rows):
    """(doc_id, text) rows with distinct non-null ids or repeats of a whole row -> doc_id: (n, component)."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    has = {}
    for i, s in sets.items():
        for g in s:
            has.setdefault(g, []).append(i)
    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in has[g] if j < i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited(rng, words, share):
    words = list(words)
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return words


def test_components_against_brute_force(spark, corner_docs, no_docs):
    rng = random.Random(11)
    base = [[f"v{rng.randrange(3000)}" for _ in range(rng.randrange(6, 400))] for _ in range(25)]
    passage = [f"shared{i}" for i in range(80)]
    texts = [" ".join(edited(rng, b, rng.choice([0, .005, .01, .02, .03, .04, .05, .06]))) for b in base for _ in range(8)]
    texts += [" ".join([f"u{k}x{i}" for i in range(rng.randrange(5, 60))] + passage) for k in range(60)]  # one passage in many documents
    chain = [f"c{i}" for i in range(200)]
    texts += [" ".join(chain[k * 8:k * 8 + 120]) for k in range(10)] + ["A B c", "a b C", "a b c d", "\t", ""]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string").repartition(7)
    got = ngramjoin.similar(docs).collect()
    assert len(got) == len(rows) + 5
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = ngramjoin.similar(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(real)
    corners = ngramjoin.similar(corner_docs).collect()
    assert len(corners) == corner_docs.count()
    assert {r.doc_id: r.component_id for r in corners if r.doc_id is not None} == {i: c for i, (_, c) in brute_components(list(enumerate(TEXTS))).items()}
    assert ngramjoin.similar(no_docs).count() == 0
    kept = ngramjoin.keep_one(corner_docs)
    assert kept.columns == corner_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([*range(len(TEXTS)), None, None])


def test_every_link_inside_a_component_is_counted(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "BLOCK_SETS", 7)  # several blocks in the large component
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    chain = [f"c{i}" for i in range(200)]
    texts = [" ".join(edited(rng, words, .01)) for _ in range(40)] + [" ".join(chain[k * 8:k * 8 + 120]) for k in range(10)]
    texts += [texts[0], texts[0], "on its own here", "", None]
    got = {r.doc_id: r.n_links for r in ngramjoin.similar(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets = [set(ngramjoin.shingles(t or "").tolist()) for t in texts]
    want = {i: sum(1 for j, b in enumerate(sets) if i != j and a and b and 100 * len(a & b) >= 75 * len(a | b)) for i, a in enumerate(sets)}
    assert got == want and 0 < want[44] < 9 and want[0] > 2


def test_two_texts_of_one_id_join_their_components(spark):
    a, b, c = "a b c d e f", "g h i j k l", "m n o p q r"
    docs = spark.createDataFrame([(5, a), (5, b), (1, b), (9, a), (2, c)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in ngramjoin.similar(docs).collect()} == {(5, 1), (1, 1), (9, 1), (2, 2)}
    assert sorted(r.doc_id for r in ngramjoin.keep_one(docs).collect()) == [1, 2]


def test_rows_without_an_id_are_near_duplicates_too(spark):
    named, alone, other = ([f"{x}{i}" for i in range(60)] for x in "abc")
    near = [*alone[:59], "changed"]
    rows = [(7, " ".join(named), "a"), (None, " ".join(named), "b"), (None, " ".join([*named[:59], "changed"]), "c"), (None, " ".join(alone), "d"),
            (None, " ".join(alone), "e"), (None, " ".join(near), "f"), (None, " ".join(other), "g"), (None, "", "h"), (None, None, "i")]
    got = ngramjoin.keep_one(spark.createDataFrame(rows, "doc_id long, text string, tag string")).collect()
    tags = {r.tag for r in got}
    assert len(got) == 5 and {"a", "g", "h", "i"} < tags and len(tags & {"d", "e", "f"}) == 1
    assert all(r.text == {x: y for _, y, x in rows}[r.tag] for r in got)


def test_filters_never_refuse_a_link():
    import numpy as np
    rng = np.random.default_rng(4)
    for _ in range(400):
        whole = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 120)).astype(np.uint64))
        a, b = (whole[rng.random(len(whole)) < rng.choice([.8, .9, 1])] for _ in "ab")
        if len(a) and len(b):
            both = len(np.intersect1d(a, b))
            assert ngramjoin.linked(a, b) == (100 * both >= 75 * (len(a) + len(b) - both))
            assert ngramjoin.suffix_distance(a, b, 4) <= len(a) + len(b) - 2 * both


def test_components_of_graphs(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(900, 990)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(5, 5)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}


# --- mixing
def flow(stock, weights):
    """Earliest deadline first over all blocks, from a flow in which sources that run out stop: slot, source, block,
    release, deadline."""
    bounds, had, now, alive = {s: [Fraction(0)] for s in stock}, dict.fromkeys(stock, Fraction(0)), Fraction(0), set(stock)
    while alive:
        total = sum(Fraction(weights[s]) for s in alive)
        time = min((stock[s] - had[s]) * total / Fraction(weights[s]) for s in alive)
        for s in alive:
            rate = Fraction(weights[s]) / total
            while len(bounds[s]) <= had[s] + rate * time:
                bounds[s].append(now + (len(bounds[s]) - had[s]) / rate)
            had[s] += rate * time
        now += time
        alive = {s for s in alive if had[s] < stock[s]}
    jobs = sorted((math.floor(b[k]), math.ceil(b[k + 1]), s, k) for s, b in bounds.items() for k in range(stock[s]))
    out, ready = [], []
    for slot in range(len(jobs)):
        ready = sorted(ready + [(due, s, k, at) for at, due, s, k in jobs if at == slot])
        due, s, k, at = ready.pop(0)
        out.append((slot, s, k, at, due))
    return out


def test_schedule_is_that_of_a_plain_simulation():
    rng = random.Random(2)
    for _ in range(60):
        stock = {f"s{i}": rng.randrange(1, 40) for i in range(rng.randrange(1, 12))}
        weights = {s: rng.choice([rng.random() ** 4 + 1e-4, rng.randrange(1, 6)]) for s in stock}
        want = flow(stock, weights)
        (course,) = mixing.courses(stock, weights)
        assert list(course.span(0, course.slots)) == want
        for lo in rng.sample(range(course.slots + 1), min(6, course.slots)):
            given = Counter(s for _, s, *_ in want[:lo])
            assert course.state(lo) == [given[s] for s in course.names]


def test_every_source_stays_within_a_block_of_its_target():
    rng = random.Random(2)
    for _ in range(300):
        stock = {f"s{i}": rng.randrange(0, 300) for i in range(rng.randrange(1, 15))}
        weights = {s: rng.choice([0, rng.random() ** 4 + 1e-4]) for s in stock}
        plan = mixing.courses(stock, weights, rng.choice([None, 1, 20, 100]))
        assert {s: sum(c.stock[c.names.index(s)] for c in plan if s in c.names) for s in stock} == stock
        assert [c.base for c in plan] == [0, *[c.slots for c in plan]][:len(plan)]
        for c in plan:
            given = Counter()
            for slot, s, k, at, due in c.span(0, c.slots):
                assert k == given[s] and at <= slot < due
                given[s] += 1
            assert given == Counter(dict(zip(c.names, c.stock, strict=True)))
            # until a source runs out, the targets are the weights
            first = min(Fraction(n, w) for n, w in zip(c.stock, c.weight, strict=True)) * c.rate[0]
            given = Counter()
            for slot, s, *_ in c.span(0, math.floor(first)):
                given[s] += 1
                assert all(abs(given[x] * c.rate[0] - (slot + 1) * w) < c.rate[0] for x, w in zip(c.names, c.weight, strict=True))


def test_driver_holds_a_row_for_each_source():
    rng = random.Random(4)
    stock = {f"host{i}": 1 + rng.randrange(400) for i in range(20_000)} | {"hot": 2_000_000}
    tracemalloc.start()
    (course,) = mixing.courses(stock, {s: n ** 0.5 for s, n in stock.items()})
    assert len(pickle.dumps(course)) < 100 * len(stock)
    given = Counter(dict(zip(course.names, course.state(100_000), strict=True)))
    for _, s, k, _, _ in course.span(100_000, 104_000):
        assert k == given[s]
        given[s] += 1
    assert dict(zip(course.names, course.state(104_000), strict=True)) == {s: given[s] for s in course.names}
    (course,) = mixing.courses({"a": 500_000, "b": 500_000, "rare": 2}, {"a": 1.0, "b": 0.7, "rare": 1e-5})
    assert sum(course.state(300_001)) == 300_001
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_every_document_has_one_place(spark, corner_docs, no_docs):
    docs = spark.createDataFrame([(i, "abc"[i % 3] if i % 7 else None, "x") for i in range(5000)], "doc_id long, source string, slot string")
    got = mixing.scheduled(docs, block=16, period=60, weights={"a": 3, "b": 1, None: 2, "c": 0}).toPandas()
    assert len(got) == 5000 and got.doc_id.is_unique and not got.duplicated(["slot", "place"]).any()
    assert (got.release <= got.slot).all() and (got.slot < got.deadline).all()
    assert got.groupby("slot").source.nunique(dropna=False).max() == 1
    early = got[got.slot < 60].drop_duplicates("slot").source.fillna("none").value_counts()
    assert early.to_dict() == {"a": 30, "none": 20, "b": 10}
    assert got[got.source == "c"].slot.min() > got[got.source != "c"].slot.max()
    assert mixing.scheduled(no_docs).count() == 0
    mixed = mixing.mixed(corner_docs)
    assert mixed.columns == corner_docs.columns and mixed.count() == corner_docs.count() and {r.slot for r in mixed.collect()} <= {"extra", "x"}


def test_weights_are_exact_over_many_sources_and_spans():
    rng = random.Random(3)
    many = {f"s{i:04}": 1 + rng.randrange(40) for i in range(1100)} | {"hot": 90_000}
    twenty = {f"s{i}": 100_000 ** 0.5 for i in range(20)} | {"big": 1000.0}
    for weights, slots in ((many, 30_000), (twenty, 200_000)):
        (course,) = mixing.courses(dict.fromkeys(weights, 1 << 30), weights)
        total, given = course.rate[0], Counter()
        for lo in range(0, slots, 7_000):  # spans on their own continue each other
            assert course.state(lo) == [given[s] for s in course.names]
            for slot, s, k, at, due in course.span(lo, min(lo + 7_000, slots)):
                assert k == given[s] and at <= slot < due
                given[s] += 1
        assert all(abs(given[s] * total - slots * w) < total for s, w in zip(course.names, course.weight, strict=True))


def test_scheduled_rows_keep_to_the_weights_given(spark):
    n, weights = 1050, {"hot": 700.0} | {f"s{i}": 1.0 for i in range(1049)}
    docs = spark.range(14_000 + 9 * (n - 1)).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 14_000, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % (n - 1))).alias("source"))
    got = mixing.scheduled(docs, weights=weights, block=1).orderBy("slot").toPandas()
    assert got.slot.tolist() == list(range(len(got)))
    early = got[:15_000]  # no source runs out in these slots
    for at in range(0, 15_000, 500):
        counts = early.source[:at].value_counts()
        assert all(abs(counts.get(s, 0) - at * w / sum(weights.values())) < 1 for s, w in weights.items())
    assert ((early.release <= early.slot) & (early.slot < early.deadline)).all()


def in_schedule(sources):
    """The sources of rows in the order of the schedule, from the rows' sources."""
    left = Counter(sources)
    plan = mixing.courses({s: -(-n // mixing.BLOCK) for s, n in left.items()}, {s: n ** 0.5 for s, n in left.items()})
    out = []
    for c in plan:
        for _, s, *_ in c.span(0, c.slots):
            n = min(left[s], mixing.BLOCK)
            left[s] -= n
            out += [s] * n
    return out


# --- pipeline
def test_leading_parts_of_the_corpus_hold_the_target_weights(spark, tmp_path):
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("en").alias("lang"),
                                      F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 10)).alias("source"), F.lit(1).cast("long").alias("n_chars"))
    stages = dict(corpus_pipeline.STAGES)
    stages["mix_sources"](spark, rows, SF).write.parquet(str(tmp_path / "mixed"))
    parts = [pq.read_table(p).column("source").to_pylist() for p in sorted((tmp_path / "mixed").glob("part-*"))]
    stages["bpe"](spark, spark.read.parquet(str(tmp_path / "mixed")), SF).write.parquet(str(tmp_path / "done"))
    done = spark.read.parquet(str(tmp_path / "done")).orderBy("position").toPandas()
    want = in_schedule([s for p in parts for s in p])
    assert sum(map(bool, parts)) > 1 and [s for p in parts for s in p] == want == done.source.tolist()
    assert done.position.is_unique
    weights = {"hot": 24_000 ** 0.5, "s8": 3_000 ** 0.5, "s9": 3_000 ** 0.5}
    for at in range(0, 9_000, 64):
        counts = Counter(want[:at])
        assert all(abs(counts[s] - at * w / sum(weights.values())) < mixing.BLOCK for s, w in weights.items())


def test_positions_of_the_whole_run(spark):
    got = corpus_pipeline.run(spark, SF).orderBy("position").toPandas()
    keys = [f"={s}" if s is not None else "null" for s in got.source]
    assert got.position.is_unique and keys == in_schedule(keys)


def test_pipeline_against_brute_force(spark, vocabulary):
    got = corpus_pipeline.run(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    docs = docs[[any(c.isalpha() for c in t or "") for t in docs.text]]
    found = [brute_measure(t) for t in docs.text]
    docs["failed"] = [n < quality.MIN_WORDS or 100 * r > quality.MAX_REPEAT_PERCENT * n for n, _, _, _, r in found]
    docs = docs[~docs.failed]
    groups = brute_components(list(zip(docs.doc_id, docs.text, strict=True)))
    docs = docs[[groups[i][1] == i for i in docs.doc_id]]
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert got.round_trip.all()
    merged = got.merge(docs, on="doc_id", suffixes=("", "_was"))
    assert (merged.text == merged.text_was).all() and (merged.source == merged.source_was).all()
    from tokenizers import Tokenizer
    want = Tokenizer.from_file(vocabulary).encode_batch(got.text.tolist(), add_special_tokens=False)
    assert [len(w.ids) for w in want] == got.n_tokens.tolist()


def test_pipeline_stages_keep_columns_and_bear_corners(spark, corner_docs, no_docs):
    for docs in (corner_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            out.count()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert last.where(~F.col("round_trip")).count() == 0 and last.count() == docs.count()

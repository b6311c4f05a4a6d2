"""Cross-tokenizer alignment (11), nearest neighbours (12) and spelling variants (13) against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, neighbours, spelling
from tidemark.llm.bpe import byte_letters
from tidemark.llm.queries import ORACLES

from .conftest import SF

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- alignment
def brute_alignment(texts):
    """Whole texts by the libraries, links pair by pair."""
    import sentencepiece
    from tokenizers import Tokenizer
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    byte_of = {c: x for x, c in enumerate(byte_letters())}
    found, count = [], Counter()
    for t in texts:
        if not t:
            found.append(None)
            continue
        e, b = one.encode(" " + t, add_special_tokens=False), two.encode(t)
        a_bytes = [bytes(byte_of[c] for c in x) for x in e.tokens]
        b_bytes = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + t).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append(None)
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        ids, groups, i, j = e.ids, [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            x, y = [], []
            while i < len(a_ends) and a_ends[i] <= end:
                x.append(ids[i])
                i += 1
            while j < len(b_ends) and b_ends[j] <= end:
                y.append(b[j])
                j += 1
            groups.append((x, y))
        links = Counter()
        for x, y in groups:
            for (p, n) in Counter(x).items():
                for (q, m) in Counter(y).items():
                    links[p, q] += n * m
        count.update(links.keys())
        found.append((len(ids), len(b), groups, links))
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()),
                    ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)))
    return out


@pytest.mark.parametrize("table_bytes", [alignment.TABLE_BYTES, 0])
def test_alignment_in_small_slices(spark, corner_docs, table_bytes, monkeypatch):
    """Texts are aligned in slices of their own small size, pairs of many slices are added up before they are handed on."""
    assert alignment.ALIGN_BYTES <= 4 << 20
    monkeypatch.setattr(alignment, "ALIGN_BYTES", 200)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 64)
    got = alignment.align(corner_docs.coalesce(1), A, B, table_bytes=table_bytes)
    rows = got.select("text", *alignment.NUMBERS, "groups").collect()
    assert [tuple(r)[1:] for r in rows] == brute_alignment([r.text for r in rows])


def test_units_grow_without_a_copy_of_all():
    x, rooms = alignment.Grown(np.zeros((1, 2), dtype=np.int64)), set()
    for i in range(1, 500):
        x.add(np.full((1, 2), i))
        rooms.add(len(x.room))
    assert len(rooms) < 12 and x.seen[:, 0].tolist() == list(range(500))
    memo = alignment.Memo()
    assert [memo[u] for u in ("a", "b" * 100, "a", "b" * 100, "c" * 70)] == [0, 1, 0, 1, 2] and memo.long == 170


@pytest.mark.parametrize("table_bytes", [alignment.TABLE_BYTES, 0])
def test_alignment_against_the_libraries(spark, corner_docs, no_docs, table_bytes):
    extra = spark.createDataFrame([(900, "▁ is no space"), (901, "a\r\n b \n\n  c▁"), (902, " leading"), (903, "trailing  "), (904, "\nline"), (905, "x▁y")], "doc_id long, text string")
    docs = corner_docs.unionByName(extra, allowMissingColumns=True).withColumn("Groups", F.lit("taken"))
    got = alignment.align(docs, A, B, table_bytes=table_bytes)
    assert [c for c in got.columns if c.lower() == "groups"] == ["groups"]
    rows = got.select("text", *alignment.NUMBERS, "groups").collect()
    assert [tuple(r)[1:] for r in rows] == brute_alignment([r.text for r in rows])
    assert alignment.align(no_docs, A, B, table_bytes=table_bytes).count() == 0


def test_perfect_hash_is_minimal_and_keys_are_verified():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 48, 20_000))
    h = alignment.PerfectHash.unpacked(alignment.PerfectHash.of(keys).packed())
    at = h.index(keys)
    assert sorted(at.tolist()) == list(range(len(keys)))
    stored = np.empty(len(keys), dtype=np.int64)
    stored[at] = keys
    table = alignment.Table(h.packed(), stored.tobytes(), np.arange(1, len(keys) + 1).tobytes())
    assert (table.look_up(keys) == at + 1).all()
    assert not table.look_up(np.setdiff1d(np.arange(5000, dtype=np.int64), keys)).any()


# --- neighbours
def brute_neighbours(rows, queries, k):
    out = []
    for q, v in queries:
        near = []
        for i, w in rows:
            if i != q:
                n = max(len(v), len(w))
                x, y = (np.array([*z, *[0.0] * (n - len(z))], dtype=float) for z in (v, w))
                near.append((-round(float(x @ y / math.sqrt((x @ x) * (y @ y))), 9), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(near)[:k])]
    return sorted(out)


def test_neighbours_of_few_rows_are_exact(spark):
    rng = random.Random(7)
    good = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(20)] + [(i, [1.0, 2.0, 0.0, 0.0, 0.0, 3.0]) for i in range(20, 32)] + [(40, [0.5, 1.0])]
    odd = [(50, None), (51, [0.0] * 6), (52, [1.0, None]), (53, [1.0, float("nan")]), (54, [float("inf"), 1.0]), (55, []), (None, [1.0] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in good + odd], "vec_id long, embedding array<double>, node string")
    got = neighbours.search(neighbours.build(df), df, own=True).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got) == brute_neighbours(good, good, 5)
    none = df.limit(0)
    assert neighbours.search(neighbours.build(none), df).count() == 0
    one = df.where("vec_id = 3")
    assert neighbours.search(neighbours.build(one), one, own=True).count() == 0
    outside = spark.createDataFrame([(1, [0.3, 0.1, 0.2, 0.1, 0.9, 0.4])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in neighbours.search(neighbours.build(df), outside, k=3).orderBy("rank").collect()] == [i for _, _, i, _ in brute_neighbours(good, [(-1, outside.first().embedding)], 3)]


def test_recall_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = {(q, i) for q, _, i, _ in brute_neighbours(rows, [r for r in rows if r[0] % 50 == 0], 5)}
    got = {(r.query_id, r.vec_id) for r in neighbours.search(neighbours.build(df), df.where("vec_id % 50 = 0"), own=True).collect()}
    assert len(want & got) >= 0.9 * len(want)


# --- spelling
def brute_variants(rows):
    n = Counter()
    for i, t in rows:
        for word, k in spelling.words_of(i, t):
            n[word] += k
    n = {w: k for w, k in n.items() if k >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form, n_near = {}, {}
    for w in n:
        others = [v for v in n if abs(len(v) - len(w)) < 2 and near(w, v)]
        n_near[w] = len(others)
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], n_near[w], n.get(form[w])))
    return sorted(out, key=str)


def test_variants_against_brute_force(spark, corner_docs, no_docs):
    rng = random.Random(11)
    words = ["letters", "létters", "lettersx", "letter", "Letters", "silent", "listen", "enlist", "aaaaa", "aaaaaa", "baaaaa", "ÀÉÎÕÜ", "àéîõü", "×÷×÷×", "stone", "stones", "atone", "tones"]
    rows = [(i, " ".join(rng.choices(words, range(1, len(words) + 1), k=300))) for i in range(12)]
    rows += [(3, rows[3][1]), (None, "silent silent listen"), (77, None), (78, ""), (79, "one" + "y" * 5000 + " " + ("z" * 5000 + " ") * 3)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    assert sorted(map(tuple, spelling.group_variants(docs).collect()), key=str) == brute_variants(rows)
    corners = [(r.doc_id, r.text) for r in corner_docs.collect()]
    assert sorted(map(tuple, spelling.group_variants(corner_docs).collect()), key=str) == brute_variants(corners)
    assert spelling.group_variants(no_docs).count() == 0


def test_runs_lose_the_letter_that_their_hash_names():
    text = " ".join(f"wörter{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600))
    got, want = Counter(dict(spelling.words_of(5, text))), Counter()
    for run in text.split():
        h = zlib.crc32(f"5:{run}".encode())
        want[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    assert got.total() == want.total() and set(got) == set(want) and any(len(w) == 7 for w in got)


def test_variants_equal_the_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.sql(ORACLES["op13_spelling_variants"]).select("word, form, root, n, n_near, form_n").fetchall(), key=str)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(map(tuple, spelling.group_variants(docs).collect()), key=str) == want

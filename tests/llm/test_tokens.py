"""BPE (1) and token counts (4) against the tokenizer libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import bpe, tokencount

from .conftest import TEXTS


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary)


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), dtype="<u4")


def some_texts():
    rng = random.Random(5)
    alphabet = ["ab", " ", "  ", "\n", "'s", "'", "é", "9", "<|endoftext|>", "\u00a0", "\u3000", "\x00", "th", "ing", "!", "日", "\t"]
    yield from ("".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(3000))
    yield from ("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(1, 300))) for _ in range(500))
    yield from (f"a{chr(c)}b {chr(c)}{chr(c)}1{chr(c)} x" for c in range(1, 0x3400, 7) if not 0xD800 <= c < 0xE000)


def test_ids_and_text_equal_the_library(library, vocabulary):
    mine, table, texts = bpe.load(vocabulary), bpe.load_decoder(vocabulary), [t or "" for t in TEXTS] + list(some_texts())
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        got = ids_of(mine, text)
        assert got.tolist() == found.ids, text[:80]
        assert table.decode(got) == library.decode(found.ids, skip_special_tokens=False)


def test_every_token_of_the_vocabulary_encodes_to_itself(vocabulary):
    mine = bpe.load(vocabulary)
    assert all(mine.merge(b) == [r] for r, b in enumerate(mine.bytes))


def test_broken_utf8_decodes_like_the_library(library, vocabulary):
    mine = bpe.load_decoder(vocabulary)
    rng = np.random.default_rng(1)
    for _ in range(300):
        ids = rng.integers(0, 50_257, rng.integers(1, 12)).astype("<u4")
        assert mine.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_round_trip_of_corner_documents(corner_docs, no_docs, library, vocabulary):
    rows = bpe.round_trip(corner_docs, vocabulary).collect()
    assert len(rows) == corner_docs.count()
    by_id = {i: t or "" for i, t in enumerate(TEXTS)}
    for r in rows:
        if r.doc_id is not None:
            ids = np.array(library.encode(by_id[r.doc_id], add_special_tokens=False).ids, dtype="<u4")
            assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
            assert r.decoded_sha256 == hashlib.sha256(by_id[r.doc_id].encode()).hexdigest()
    assert bpe.round_trip(no_docs, vocabulary).count() == 0
    wide = bpe.encode(corner_docs, vocabulary)
    assert sorted(wide.columns) == sorted(corner_docs.columns) and dict(wide.dtypes)["ids"] == "binary"
    back = bpe.decode(wide.select("doc_id", "text", "ids"), vocabulary)
    assert all(r.decoded == (r.text or "") for r in back.collect())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"])
def test_counts_equal_each_library(corner_docs, no_docs, library, name):
    path = public_tokenizers.path(name)
    got = {r.doc_id: r for r in tokencount.count_tokens(corner_docs, path).collect() if r.doc_id is not None}
    for i, text in enumerate(TEXTS):
        text = text or ""
        if name.endswith(".json"):
            from tokenizers import Tokenizer
            want = len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
        elif name.endswith(".model"):
            import sentencepiece
            want = len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
        else:
            want = tokencount.counter(path).count([text])[0]
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (want, len(text.encode()), want > 1024), text[:60]
    assert tokencount.count_tokens(no_docs, path).count() == 0


def test_long_texts_are_cut_where_counts_add_up(library, vocabulary):
    rng = random.Random(2)
    text = "".join(rng.choice(["word", " x", "\n", "  ", " \n ", "'s", "12", " é", "\u00a0", "<|endoftext|>"]) for _ in range(120_000))
    parts = tokencount.sections(text)
    assert len(parts) > 3 and "".join(parts) == text
    assert tokencount.counter(vocabulary).count([text]) == [len(library.encode(text, add_special_tokens=False).ids)]
    assert sum(tokencount.counter(vocabulary).count(parts)) == len(library.encode(text, add_special_tokens=False).ids)
    assert tokencount.sections("y" * 200_000) == ["y" * 200_000]


def test_long_words_are_not_remembered(vocabulary):
    counter = tokencount.JsonCounter(vocabulary)
    rng = random.Random(6)
    long = ["".join(rng.choices("abcdefgh", k=5000)) for _ in range(40)]
    assert counter.count(["a short text " + x for x in long]) == counter.lengths(["a short text " + x for x in long])
    assert sum(map(len, counter.memo)) < 100 and "a" in counter.memo

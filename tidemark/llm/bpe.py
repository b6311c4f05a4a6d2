"""Byte-level BPE: exact encoding by backtracking in linear time, decoding by an offset table.

Encoding. An Aho-Corasick automaton over all tokens gives, in one pass over a pre-token, the longest
token that starts at each byte. The encoder appends the longest token that may follow the last one;
if none may, it takes the last one back, marks the position as a dead end and tries the next shorter
token there. A pair of neighbours is allowed when merging by rank would never join bytes across their
border; that is decided from the merge table and remembered in a pair-compatibility table. Every
position is marked dead at most once, so the work is linear in the bytes, and the result equals
merging by rank.

Decoding. All tokens lie in one byte blob; an offset table gives the place of each id, and numpy
gathers the bytes of a whole text at once.

Spark deals out the rows; a task holds one vocabulary (a fixed file), a bounded memo of pieces and one
Arrow slice. No shuffle. A lost executor only means that its splits are encoded again.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import added, slices, texts_of, with_columns, without

#: Fixed value: how byte-level BPE files of this kind cut a text into pre-tokens. White space is the
#: Unicode property, spelled out, as Python's own \s has four control characters more.
_WS = r"\t-\r \x85\xa0  -     　"
PRE_TOKEN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+"
             rf"|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: A space or line feed after white space: cutting before it could change the pre-tokens.
_DOUBLE = re.compile(rf"[{_WS}][ \n]")
#: Pieces that a task remembers before it starts afresh.
MEMO = 250_000
#: Longer pieces are not remembered.
MEMO_CHARS = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others, in order, for the letters from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return [other.get(b, chr(b)) for b in range(256)]


def read_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class Decoder:
    """The bytes of all tokens in one blob, and the offset table by id."""

    def __init__(self, path: str) -> None:
        spec = read_spec(path)
        byte_of = {ord(c): chr(b) for b, c in enumerate(byte_letters())}
        blob = {i: n.translate(byte_of).encode("latin-1") for n, i in spec["model"]["vocab"].items()}
        blob |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens") or []}
        lengths = np.zeros(max(blob) + 2, dtype=np.int64)
        for i, b in blob.items():
            lengths[i + 1] = len(b)
        self.offsets = np.cumsum(lengths)
        self.blob = np.frombuffer(b"".join(blob[i] for i in sorted(blob)), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """Bytes of all ids in a row, as UTF-8; bytes that are not UTF-8 become U+FFFD."""
        if not len(ids):
            return ""
        at = self.offsets[ids]
        size = self.offsets[ids.astype(np.int64) + 1] - at
        ends = np.cumsum(size)
        return self.blob[np.repeat(at - (ends - size), size) + np.arange(ends[-1])].tobytes().decode("utf-8", "replace")


class Encoder:
    """A vocabulary file (``.json``: byte-level, merges by rank) made ready for encoding."""

    def __init__(self, path: str) -> None:
        spec = read_spec(path)
        byte_of = {ord(c): chr(b) for b, c in enumerate(byte_letters())}
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        # Inside, a token is its rank: the 256 bytes first, then the merges in order.
        letters = byte_letters()
        names = list(letters)
        rank = {c: i for i, c in enumerate(names)}
        self.left, self.right = list(range(256)), list(range(256))
        pairs: dict[tuple[int, int], int] = {}
        for m in merges:
            a, b = m if isinstance(m, list) else m.split(" ")
            if a + b not in rank:
                rank[a + b] = len(names)
                names.append(a + b)
                self.left.append(rank[a])
                self.right.append(rank[b])
            pairs.setdefault((rank[a], rank[b]), rank[a + b])
        self.pair = {a * len(names) + b: r for (a, b), r in pairs.items()}
        self.bytes = [n.translate(byte_of) for n in names]  # Latin-1 strings: one letter a byte
        self.size = [len(b) for b in self.bytes]
        self.ids = np.array([vocab[n] for n in names], dtype="<u4")
        self.id_bytes = [i.tobytes() for i in self.ids]
        self.tokens = ahocorasick.Automaton()
        for r, b in enumerate(self.bytes):
            self.tokens.add_word(b, r)
        self.tokens.make_automaton()
        self.shorter = [self.longest_prefix(b) for b in self.bytes]
        self.follows: dict[int, bool] = {}  # the pair-compatibility table, as far as it was asked for
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pre = regex.compile(PRE_TOKEN)
        self.memo: dict[str, bytes] = {}
    def longest_prefix(self, token: str) -> int:
        """The longest token that is a proper prefix of ``token``; -1 if there is none."""
        return next((r for n in range(len(token) - 1, 0, -1) if (r := self.tokens.get(token[:n], -1)) >= 0), -1)

    # --- encoding
    def compatible(self, a: int, b: int) -> bool:
        """Whether merging by rank keeps the border between the neighbours ``a`` and ``b``.

        Both are taken apart from the later merge to the earlier one; at each step the two parts that
        touch the border must not form a merge that comes before the merge just undone."""
        base = len(self.bytes)
        key, fits, bound = a * base + b, True, base + 1
        while True:
            if self.pair.get(a * base + b, bound) < bound:
                fits = False
                break
            if a < 256 and b < 256:
                break
            if a > b:  # undone first: the later merge; of equal ones the right
                bound, a = a, self.right[a]
            else:
                bound, b = b + 1, self.left[b]
        if len(self.follows) >= MEMO:
            self.follows.clear()
        self.follows[key] = fits
        return fits

    def merge(self, piece: str) -> list[int]:
        """Ranks of one pre-token, given as a Latin-1 string of its bytes."""
        whole = self.tokens.get(piece, -1)
        if whole >= 0:
            return [whole]
        n, size, shorter, follows, base = len(piece), self.size, self.shorter, self.follows, len(self.bytes)
        longest = [0] * (n + 1)
        for end, r in self.tokens.iter(piece):  # for one start, later ends are longer tokens
            longest[end + 1 - size[r]] = r
        alive, out, pos, token, last = bytearray(b"\x01") * (n + 1), [], 0, longest[0], -1
        while True:
            end = pos + size[token]
            if alive[end]:
                fits = last < 0 or follows.get(last * base + token)
                if fits is None:
                    fits = self.compatible(last, token)
                if fits:
                    out.append(token)
                    if end == n:
                        return out
                    pos, last, token = end, token, longest[end]
                    continue
            while (token := shorter[token]) < 0:
                alive[pos] = 0
                token = out.pop()
                last = out[-1] if out else -1
                pos -= size[token]

    def piece_ids(self, piece: str) -> bytes:
        # a run of letters with at most one space before it is one pre-token, the usual case
        known, ids, out = self.memo.get, self.id_bytes, []
        parts = [piece] if piece.removeprefix(" ").isalpha() else self.pre.findall(piece)
        for p in parts:
            if (one := known(p)) is None:
                one = b"".join([ids[r] for r in self.merge(p if p.isascii() else p.encode().decode("latin-1"))])
                self.remember(p, one)
            out.append(one)
        if len(parts) == 1:
            return out[0]
        joint = b"".join(out)
        self.remember(piece, joint)
        return joint

    def remember(self, piece: str, ids: bytes) -> None:
        if len(piece) <= MEMO_CHARS:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[piece] = ids

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens. Words recur, so the text is cut before white space
        wherever that keeps the pre-tokens, and the pieces' ids are remembered."""
        if not text:
            return b""
        if "\x00" in text or _DOUBLE.search(text):
            pieces = self.pre.findall(text)
        else:
            pieces = text.replace(" ", "\x00 ").replace("\n", "\x00\n").split("\x00")
        known, new = self.memo.get, self.piece_ids
        return b"".join([known(p) or new(p) for p in pieces])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; strings of special tokens give their ids."""
        if self.split is None:
            return self.plain(text)
        parts = self.split.split(text)
        if len(parts) == 1:
            return self.plain(text)
        return b"".join(np.array([self.special[p]], dtype="<u4").tobytes() if i % 2 else self.plain(p) for i, p in enumerate(parts))

    def forget(self) -> None:
        """Let go of what was remembered: a worker may wait long, or go on with another operator."""
        self.memo.clear()
        self.follows.clear()


@lru_cache(maxsize=1)
def load(path: str) -> Encoder:
    """One vocabulary for each worker process."""
    return Encoder(path)


@lru_cache(maxsize=1)
def load_decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens") -> DataFrame:
    """Add ``ids`` (binary: little-endian unsigned 32-bit integers) and ``n_tokens`` (long) of the whole text.

    Null and empty texts give no ids. Columns named like the new ones are replaced; every other column,
    repeated rows and the row count stay as they are. Empty tables give empty tables."""
    df = without(df, [ids, n_tokens])

    def run(batches):
        bpe = load(path)
        for b in slices(batches, text):
            out = [bpe.encode(t) for t in texts_of(b, text)]
            yield with_columns(b, {ids: pa.array(out, pa.binary()), n_tokens: pa.array([len(x) // 4 for x in out], pa.int64())})
        bpe.forget()

    return df.mapInArrow(run, added(df, [T.StructField(ids, T.BinaryType()), T.StructField(n_tokens, T.LongType())]))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``, decoded from the binary column ``ids``; null gives the empty text, a column named
    like the new one is replaced."""
    df = without(df, [text])

    def run(batches):
        table = load_decoder(path)
        for b in slices(batches, ids):
            out = [table.decode(np.frombuffer(x or b"", dtype="<u4")) for x in b.column(b.schema.get_field_index(ids)).to_pylist()]
            yield with_columns(b, {text: pa.array(out, pa.string())})

    return df.mapInArrow(run, added(df, [T.StructField(text, T.StringType())]))


def encode_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass of one worker per task: adds ``ids``, ``n_tokens`` and the text that
    the ids decode to. Rows and columns as with these."""
    df = without(df, [ids, n_tokens, decoded])

    def run(batches):
        bpe, table = load(path), load_decoder(path)
        for b in slices(batches, text):
            out = [bpe.encode(t) for t in texts_of(b, text)]
            back = [table.decode(np.frombuffer(x, dtype="<u4")) for x in out]
            yield with_columns(b, {ids: pa.array(out, pa.binary()), n_tokens: pa.array([len(x) // 4 for x in out], pa.int64()), decoded: pa.array(back, pa.string())})
        bpe.forget()

    return df.mapInArrow(run, added(df, [T.StructField(ids, T.BinaryType()), T.StructField(n_tokens, T.LongType()), T.StructField(decoded, T.StringType())]))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: digests of its ids and of the text decoded from them."""
    done = encode_decode(docs.select("doc_id", "text"), path)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

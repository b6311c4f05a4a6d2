"""Cross-tokenizer alignment: how the tokens of two vocabularies fall together over a corpus.

A text is encoded by vocabulary A (byte-level, ``.json``) and vocabulary B (pieces, ``.model``) and cut into groups
at the byte offsets where tokens of both end. An A and a B token whose byte ranges share a group are linked; the
count of an id pair is the number of documents that hold it linked.

1. First pass: a task adds up the documents of its pairs and hands on packed rows by segment, the upper bits of
   a pair's hash. The segments' number is fixed: there are at most as many pairs as A and B have ids multiplied.
2. The distinct pairs of a segment get a minimal perfect hash: levels of bits, in which a pair has the first
   level where it meets no other; its index is the number of bits set before its own.
3. The counts of a segment are a dense vector indexed by that hash. Packed rows are added to vectors of shares of
   the segment and these are added up, a tree of two levels.
4. Second pass: the texts are aligned again and their pairs are looked up; the pair that is stored at the index
   must be the one asked for. The table goes to the tasks where its measured size is under ``TABLE_BYTES``;
   beyond, packed pairs go to the segments and their sums come back by row.

Encoding goes by units, cut before a space or line feed that follows other text, where no token of either
vocabulary can cross the cut; so both tokens end there, and a text's alignment is that of its units in a row. What
a unit gives is remembered within bounds. A vocabulary that may cross such a cut is given whole texts.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import byte_letters
from tidemark.llm.common import added, folded, slices, texts_of, with_columns, without, written
from tidemark.llm.ngramjoin import mixed
from tidemark.llm.tokencount import words

#: Segments, a power of two, and shares of a segment whose vectors are added up first.
SEGMENT_BITS, SHARES = 8, 16
#: The table of pairs and counts is sent to the tasks up to this size.
TABLE_BYTES = 64 << 20
#: Units that a task remembers, longer ones, which it keeps only while they are few, and pairs that it adds up
#: before it hands them on.
MEMO, MEMO_CHARS, HELD_PAIRS = 400_000, 64, 1 << 19
#: Texts that are aligned at a time, in bytes: what a slice needs besides the memo is many times its text.
ALIGN_BYTES = 4 << 20
#: Units are encoded in stretches of about so many characters; groups with more links than this are not spelled out.
STRETCH_CHARS, LONG_GROUP = 1 << 15, 1 << 12
#: Bits that hold a pair, as A id times B ids plus B id.
KEY_BITS = 40
#: Bits of a level for each pair that is left.
LOAD = 2


# --- units of texts
class Names:
    """Of a vocabulary's ids: bytes in one blob, their places, and the ids as text before each mark."""

    def __init__(self, tokens: list[bytes], marks: str) -> None:
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.text = [np.array([f"{i}{m}" for i in range(len(tokens))], dtype=object) for m in marks]

    def joined(self, ids: np.ndarray, size: np.ndarray) -> bytes:
        ends = np.cumsum(size)
        return self.blob[np.repeat(self.at[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


class Block(NamedTuple):
    """Units of a stretch: whether they are whole, their numbers of tokens, groups and links, how many distinct
    pairs each has, these, how often each is linked, and the groups as text."""

    whole: np.ndarray
    numbers: np.ndarray
    n_pairs: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    groups: list[str]


NONE = np.empty(0, dtype=np.int64)
BROKEN = Block(np.zeros(1, dtype=bool), np.zeros((1, 4), dtype=np.int64), np.zeros(1, dtype=np.int64), NONE, NONE, [""])


class Grown:
    """A flat array that grows at its end, with room for as much again, so that a slice's units cost no copy of all."""

    def __init__(self, first: np.ndarray) -> None:
        self.room, self.n = first, len(first)

    @property
    def seen(self) -> np.ndarray:
        return self.room[:self.n]

    def add(self, more: np.ndarray) -> None:
        end = self.n + len(more)
        if end > len(self.room):
            room = np.empty((2 * end, *self.room.shape[1:]), dtype=self.room.dtype)
            room[:self.n] = self.seen
            self.room = room
        self.room[self.n:end] = more
        self.n = end


class Units:
    """Units by number: the text of their groups and, in flat arrays, numbers and linked pairs (a << 32 | b) with
    how often each is linked in the unit. A unit whose bytes A or B do not give back is not ``whole``."""

    def __init__(self) -> None:
        self.groups: list[str] = []
        # whether whole; n_a, n_b, n_groups, n_links; pairs and times; where a unit's pairs start
        self.flat = [Grown(x) for x in (np.empty(0, dtype=bool), np.empty((0, 4), dtype=np.int64), NONE, NONE, np.zeros(1, dtype=np.int64))]
        self.show()

    def show(self) -> None:
        self.whole, self.numbers, self.pairs, self.times, self.starts = (x.seen for x in self.flat)

    def add(self, blocks: list[Block]) -> None:
        """Units of blocks, in order; the pairs of a block are sorted by unit."""
        whole, numbers, n_pairs, pairs, times = (np.concatenate(x) for x in list(zip(*blocks, strict=True))[:5])
        for x, more in zip(self.flat, (whole, numbers, pairs, times, self.starts[-1] + np.cumsum(n_pairs)), strict=True):
            x.add(more)
        self.show()
        for b in blocks:
            self.groups += b.groups

    def parts(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For units in a row: positions of their pairs, and the row of each."""
        n = self.starts[unit + 1] - self.starts[unit]
        ends = np.cumsum(n)
        return np.repeat(self.starts[unit] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0), np.repeat(np.arange(len(unit)), n)


class Memo(dict):
    """Units by number, in order of appearance; new ones are kept in ``new`` until they are aligned. ``long``: the
    characters of long ones."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.long = 0

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        self.new.append(unit)
        if len(unit) > MEMO_CHARS:
            self.long += len(unit)
        return n


class Aligner:
    """Both vocabularies, ready for aligning units."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {ord(c): chr(x) for x, c in enumerate(byte_letters())}
        names = {t["id"]: t["content"].encode() for t in spec.get("added_tokens") or []} | {i: n.translate(byte_of).encode("latin-1") for n, i in spec["model"]["vocab"].items()}
        self.a_names = Names([names.get(i, b"") for i in range(max(names) + 1)], ",|")
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_names = Names([bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)], ",;")
        pre = spec.get("pre_tokenizer") or {}
        a_splits = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        crossing = re.compile("[^▁]▁|[^\n]\n")
        self.splits = bool(a_splits and self.b.decode(self.b.encode("a  b \nc")) == "a  b \nc" and not any(crossing.search(p) for p in pieces))
        self.forget()

    def forget(self) -> None:
        self.memo, self.units = Memo(), Units()
        self.placed = Grown(NONE)  # of the units by number

    def units_of(self, text: str) -> list[str]:
        """A space and the text, cut into units that begin with a space or a line feed."""
        text = " " + text
        if not self.splits:
            return [text]
        out = words(text)
        return out if out[0] else out[1:]

    def encoded(self, stretches: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B. B adds a space itself, in place of the first of a stretch. Before a line feed, which is a
        token of its own, the space that it adds is one too."""
        a = self.a.encode_batch_fast(stretches, add_special_tokens=False)
        b = self.b.encode([s if s[0] == "\n" else s[1:] for s in stretches], num_threads=1)
        space = self.b.piece_to_id("▁")
        for s, x, y in zip(stretches, a, b, strict=True):
            y = y[1:] if s[0] == "\n" else y or [space]  # of nothing, B makes no space
            yield np.array(x.ids, dtype=np.int64), np.array(y, dtype=np.int64)

    def learn(self, with_groups: bool) -> None:
        """Align the memo's new units. Units that end with other text stay apart when they are joined, so many
        are encoded in one stretch; where its bytes do not come back, its units are encoded one by one."""
        stretches, part, held = [], [], 0
        new = self.memo.new
        for i, u in enumerate(new):
            if not self.splits or u[-1].isspace():
                stretches.append([i])
                continue
            part.append(i)
            held += len(u)
            if held >= STRETCH_CHARS:
                stretches.append(part)
                part, held = [], 0
        if part:
            stretches.append(part)
        done, blocks = [], []
        while stretches:
            again = []
            for own, (a, b) in zip(stretches, self.encoded(["".join([new[i] for i in x]) for x in stretches]), strict=True):
                block = self.aligned([new[i] for i in own], a, b, with_groups)
                if block is None and len(own) > 1:
                    again += [[i] for i in own]
                    continue
                done += own
                blocks.append(BROKEN if block is None else block)
            stretches = again
        place = np.empty(len(new), dtype=np.int64)
        place[done] = self.placed.n + np.arange(len(new))
        self.placed.add(place)
        self.units.add(blocks)
        new.clear()

    def aligned(self, own: list[str], a: np.ndarray, b: np.ndarray, with_groups: bool) -> Block | None:
        """The units of a stretch; None if its bytes are not those of its tokens."""
        a_size, b_size = self.a_names.size[a], self.b_names.size[b]
        whole = "".join(own).encode()
        sizes = [len(u) for u in own] if len(whole) == sum(map(len, own)) else [len(u.encode()) for u in own]
        if self.a_names.joined(a, a_size) != whole or self.b_names.joined(b, b_size) != whole:
            return None
        a_end, b_end, unit_end = np.cumsum(a_size), np.cumsum(b_size), np.cumsum(sizes)
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        k, n = len(both), len(own)
        a_group, b_group, unit = np.searchsorted(both, a_end), np.searchsorted(both, b_end), np.searchsorted(unit_end, both)
        n_a, n_b = np.bincount(a_group, minlength=k), np.bincount(b_group, minlength=k)
        a_from, b_from = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        # all pairs of small groups at once; of a long group, its distinct ids with their numbers
        small = n_a * n_b <= LONG_GROUP
        token = np.flatnonzero(small[a_group])
        times = n_b[a_group[token]]
        ends = np.cumsum(times)
        row = np.repeat(token, times)
        other = np.repeat(b_from[a_group[token]] - (ends - times), times) + np.arange(ends[-1] if len(ends) else 0)
        base = len(self.b_names.size)
        keys = unit[a_group[row]] << KEY_BITS | a[row] * base + b[other]
        if small.all():
            keys.sort()
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            times = np.diff(np.concatenate([first, [len(keys)]]))
        else:
            keys, times = [keys], [np.ones(len(row), dtype=np.int64)]
            for g in np.flatnonzero(~small).tolist():
                x, x_times = np.unique(a[a_from[g]:a_from[g] + n_a[g]], return_counts=True)
                y, y_times = np.unique(b[b_from[g]:b_from[g] + n_b[g]], return_counts=True)
                keys.append((unit[g] << KEY_BITS) | (x[:, None] * base + y[None, :]).reshape(-1))
                times.append((x_times[:, None] * y_times[None, :]).reshape(-1))
            keys, times = np.concatenate(keys), np.concatenate(times)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            times = np.add.reduceat(times[order], first)
        keys = keys[first]
        pair = keys & ((1 << KEY_BITS) - 1)
        pair = pair // base << 32 | pair % base
        numbers = np.stack([np.bincount(unit, w, minlength=n).astype(np.int64) for w in (n_a, n_b, np.ones(k), n_a * n_b)], axis=1)
        groups = [""] * n
        if with_groups:
            text = np.empty(len(a) + len(b), dtype=object)
            last = np.arange(len(a)) == (a_from + n_a - 1)[a_group]
            text[np.arange(len(a)) + b_from[a_group]] = np.where(last, self.a_names.text[1][a], self.a_names.text[0][a])
            last = np.arange(len(b)) == (b_from + n_b - 1)[b_group]
            text[np.arange(len(b)) + (a_from + n_a)[b_group]] = np.where(last, self.b_names.text[1][b], self.b_names.text[0][b])
            text, cuts = text.tolist(), np.cumsum(numbers[:, 0] + numbers[:, 1]).tolist()
            groups = ["".join(text[lo:hi])[:-1] for lo, hi in zip([0, *cuts], cuts, strict=False)]
        return Block(np.ones(n, dtype=bool), numbers, np.bincount(keys >> KEY_BITS, minlength=n), pair, times, groups)


@lru_cache(maxsize=1)
def load(a_path: str, b_path: str) -> Aligner:
    """One pair of vocabularies for each worker process."""
    return Aligner(a_path, b_path)


class Aligned(NamedTuple):
    """Texts of a batch as units: ``doc`` and ``unit`` of every occurrence, of ``n`` texts."""

    doc: np.ndarray
    unit: np.ndarray
    n: int


def aligned(texts: list[str], aligner: Aligner, with_groups: bool) -> Aligned:
    """The texts' units by number; texts with a unit that is not whole have none."""
    cut = [aligner.units_of(t) if t else [] for t in texts]
    sizes = list(map(len, cut))
    unit = np.fromiter(map(aligner.memo.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=sum(sizes))
    if aligner.memo.new:
        aligner.learn(with_groups)
    unit = aligner.placed.seen[unit]
    doc = np.repeat(np.arange(len(texts)), sizes)
    broken = np.zeros(len(texts), dtype=bool)
    broken[doc[~aligner.units.whole[unit]]] = True
    keep = ~broken[doc]
    return Aligned(doc[keep], unit[keep], len(texts))


def settle(aligner: Aligner) -> None:
    """After a batch: forget everything where the memo is full, in units or in the bytes of long ones."""
    if len(aligner.memo) >= MEMO or aligner.memo.long > STRETCH_CHARS:
        aligner.forget()


def document_pairs(got: Aligned, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair and number of occurrences of every distinct pair in every document of a batch."""
    base = len(units.whole) + 1
    seen, times = np.unique(got.doc * base + got.unit, return_counts=True)
    place, row = units.parts(seen % base)
    distinct, number = np.unique(units.pairs[place], return_inverse=True)
    held, back = np.unique((seen[row] // base) * (len(distinct) + 1) + number, return_inverse=True)
    total = np.zeros(len(held), dtype=np.int64)
    np.add.at(total, back, times[row] * units.times[place])
    return held // (len(distinct) + 1), distinct[held % (len(distinct) + 1)], total


def document_counts(got: Aligned, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a batch, and in how many of its documents each is."""
    base = len(units.whole) + 1
    seen = np.unique(got.doc * base + got.unit)
    used, own = np.unique(seen % base, return_inverse=True)
    place, row = units.parts(used)
    distinct, number = np.unique(units.pairs[place], return_inverse=True)
    n = np.bincount(row, minlength=len(used))
    starts, n = (np.cumsum(n) - n)[own], n[own]
    ends = np.cumsum(n)
    at = np.repeat(starts - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    held = np.sort(np.repeat(seen // base, n) * (len(distinct) + 1) + number[at])
    held = held[np.concatenate([[True], held[1:] != held[:-1]])] if len(held) else held
    return distinct, np.bincount(held % (len(distinct) + 1), minlength=len(distinct))


@contextmanager
def no_collector() -> Iterator[None]:
    """Aligning makes no cycles, and Python's collector would walk over all words of a batch again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


# --- minimal perfect hashing
def spread(keys: np.ndarray) -> np.ndarray:
    return mixed(keys.astype(np.uint64))


def segment_of(keys: np.ndarray) -> np.ndarray:
    return (spread(keys) >> np.uint64(64 - SEGMENT_BITS)).astype(np.int32)


def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mixed(spread(keys) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Levels of bits; the index of a key is the number of bits set before its own."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks, base = [], 0
        for bits in levels:
            self.ranks.append((base + np.cumsum(bits) - bits).astype(np.int32))
            base += int(bits.sum())

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys: those that meet another in a level go on to the next."""
        levels, left = [], keys
        while len(left):
            size = max(64, LOAD * len(left))
            at = place(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Indexes of keys; -1 for those that no level has (a key that is not in the set may get any index)."""
        out, left = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = place(keys[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        return out

    def packed(self) -> bytes:
        return b"".join(len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def unpacked(cls, data: bytes) -> PerfectHash:
        levels, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at:at + 8], "little")
            end = at + 8 + (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data[at + 8:end], dtype=np.uint8), count=size).astype(bool))
            at = end
        return cls(levels)


class Table:
    """The counts of a segment: stored pairs and counts by index."""

    def __init__(self, bits: bytes, keys: bytes, counts: bytes) -> None:
        self.hash, self.keys, self.counts = PerfectHash.unpacked(bits), np.frombuffer(keys, dtype=np.int64), np.frombuffer(counts, dtype=np.int64)

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Counts of pairs; 0 where the pair stored at the index is another."""
        at = self.hash.index(keys)
        ok = at >= 0
        ok[ok] = self.keys[at[ok]] == keys[ok]
        out = np.zeros(len(keys), dtype=np.int64)
        out[ok] = self.counts[at[ok]]
        return out


def packed_by_segment(keys: np.ndarray, *values: np.ndarray) -> Iterator[tuple]:
    """``segment``, keys and values as bytes, for each segment that the keys fall in."""
    if not len(keys):
        return
    seg = segment_of(keys)
    order = np.argsort(seg, kind="stable")
    found, starts = np.unique(seg[order], return_index=True)
    for s, lo, hi in zip(found.tolist(), starts.tolist(), [*starts.tolist()[1:], len(seg)], strict=True):
        at = order[lo:hi]
        yield s, keys[at].tobytes(), *[v[at].tobytes() for v in values]


# --- first pass
def pair_parts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``segment``, ``share``, ``keys``, ``counts``: packed pairs and the numbers of documents that hold them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task = load(a_path, b_path), TaskContext.get().partitionId()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def together() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            counts = np.zeros(len(keys), dtype=np.int64)
            np.add.at(counts, at, np.concatenate([n for _, n in held]))
            return keys, counts

        def rows(turn: int) -> pa.RecordBatch:
            seg, k, n = zip(*packed_by_segment(*together()), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(seg, pa.int32()), pa.array([(task + turn) % SHARES] * len(seg), pa.int32()), pa.array(k, pa.binary()), pa.array(n, pa.binary())],
                                              names=["segment", "share", "keys", "counts"])

        turn = size = 0
        for b in slices(batches, "text", ALIGN_BYTES):
            with no_collector():
                counts = document_counts(aligned(texts_of(b, "text"), aligner, False), aligner.units)
            if len(counts[0]):
                held.append(counts)
                size += len(counts[0])
            settle(aligner)
            if size >= HELD_PAIRS:  # mostly the same pairs again, slice after slice
                held = [together()]
                size = len(held[0][0])
            if size >= HELD_PAIRS // 2 and len(held) == 1:
                yield rows(turn)
                held, turn, size = [], turn + 1, 0
        if held:
            yield rows(turn)
        aligner.forget()

    return docs.select("text").mapInArrow(run, "segment int, share int, keys binary, counts binary")


def union_of(packed: Iterator[bytes]) -> np.ndarray:
    """Distinct keys of packed rows; at most about twice as many are held as there are."""
    have, waiting, n = np.empty(0, dtype=np.int64), [], 0
    for x in packed:
        waiting.append(np.frombuffer(x, dtype=np.int64))
        n += len(waiting[-1])
        if n > max(1 << 16, len(have)):
            have, waiting, n = np.unique(np.concatenate([have, *waiting])), [], 0
    return np.unique(np.concatenate([have, *waiting]))


def headed(table: DataFrame, columns: list[str], rows: DataFrame) -> DataFrame:
    """``rows`` of segments and shares, and for each share the columns of the segment's row of ``table`` with
    ``kind`` 0, so that sorted by it they come first."""
    heads = table.select("segment", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"), F.lit(0).alias("kind"), *columns)
    return heads.unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)


def count_table(parts: DataFrame) -> DataFrame:
    """A written row per segment: ``segment``, ``bits`` (the perfect hash), ``keys`` and ``counts`` by index."""
    def distinct(key: tuple, group: Iterator[tuple]) -> Iterator[tuple]:
        yield key[0], union_of(r[2] for r in group).tobytes()

    def hashed(key: tuple, group: Iterator[tuple]) -> Iterator[tuple]:
        keys = union_of(r[1] for r in group)
        bits = PerfectHash.of(keys)
        stored = np.empty(len(keys), dtype=np.int64)
        stored[bits.index(keys)] = keys
        yield key[0], bits.packed(), stored.tobytes()

    some = folded(parts.select("segment", "share", "keys"), ["segment", "share"], distinct, "segment int, keys binary")
    hashes = written(folded(some, ["segment"], hashed, "segment int, bits binary, keys binary"), "pair-hashes")

    def summed(key: tuple, group: Iterator[tuple]) -> Iterator[tuple]:
        _, _, _, bits, size, _, _ = next(group)
        index, total = PerfectHash.unpacked(bits).index, np.zeros(size, dtype=np.int64)
        for *_, keys, counts in group:
            total[index(np.frombuffer(keys, dtype=np.int64))] += np.frombuffer(counts, dtype=np.int64)  # a row's keys are distinct
        yield key[0], total.tobytes()

    def added_up(key: tuple, group: Iterator[tuple]) -> Iterator[tuple]:
        total = np.frombuffer(next(group)[1], dtype=np.int64).copy()
        for _, x in group:
            total += np.frombuffer(x, dtype=np.int64)
        yield key[0], total.tobytes()

    rows = headed(hashes.withColumn("size", F.expr("octet_length(keys) div 8")).drop("keys"), ["bits", "size"], parts)
    vectors = folded(rows.select("segment", "share", "kind", "bits", "size", "keys", "counts"), ["segment", "share"], summed, "segment int, counts binary", then=("kind",))
    totals = folded(vectors, ["segment"], added_up, "segment int, counts binary")
    return written(hashes.join(totals.hint("merge"), "segment").select("segment", "bits", "keys", "counts"), "pair-counts")


def best_counts(table: DataFrame) -> np.ndarray:
    """The highest count of each A id's pairs, indexed by id: as long as the vocabulary."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                a, at = np.unique(np.frombuffer(keys, dtype=np.int64) >> 32, return_inverse=True)
                most = np.zeros(len(a), dtype=np.int64)
                np.maximum.at(most, at, np.frombuffer(counts, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(most)], names=["a", "most"])

    got = table.select("keys", "counts").mapInArrow(run, "a long, most long").groupBy("a").agg(F.max("most").alias("most")).toArrow()
    a = got.column("a").to_numpy()
    out = np.zeros(int(a.max()) + 1 if len(a) else 1, dtype=np.int64)
    out[a] = got.column("most").to_numpy()
    return out


# --- second pass
#: The columns that alignment adds.
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def base_columns(got: Aligned, units: Units) -> dict[str, pa.Array]:
    """Of each text of a batch the numbers of tokens, groups and links, and the groups as text."""
    cuts = np.searchsorted(got.doc, np.arange(got.n + 1))
    sums = np.concatenate([np.zeros((1, 4), dtype=np.int64), np.cumsum(units.numbers[got.unit], axis=0)])
    totals = sums[cuts[1:]] - sums[cuts[:-1]]
    known, numbers, cuts = units.groups.__getitem__, got.unit.tolist(), cuts.tolist()
    groups = pa.array([";".join(map(known, numbers[lo:hi])) for lo, hi in zip(cuts, cuts[1:], strict=False)], pa.string())
    return {**{c: pa.array(np.ascontiguousarray(totals[:, i])) for i, c in enumerate(NUMBERS[:4])}, "groups": groups}


def sums(doc: np.ndarray, pairs: np.ndarray, times: np.ndarray, counts: np.ndarray, best: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n_best`` and ``count_sum`` of ``n`` documents from their pairs' counts."""
    n_best, count_sum = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    np.add.at(count_sum, doc, times * counts)
    np.add.at(n_best, doc, times * (counts == best[pairs >> 32]))
    return n_best, count_sum


def look_up(tables: Mapping[int, Table], keys: np.ndarray) -> np.ndarray:
    """Counts of distinct pairs from the tables of their segments."""
    counts, seg = np.zeros(len(keys), dtype=np.int64), segment_of(keys)
    order = np.argsort(seg, kind="stable")
    found, starts = np.unique(seg[order], return_index=True)
    for s, part in zip(found.tolist(), np.split(order, starts[1:]), strict=bool(len(found))):
        counts[part] = tables[s].look_up(keys[part])
    return counts


def looked_up(docs: DataFrame, a_path: str, b_path: str, table: DataFrame, best: np.ndarray) -> DataFrame:
    """The second pass with the table at hand in every task."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((best, [tuple(r) for r in table.select("segment", "bits", "keys", "counts").collect()]))  # under TABLE_BYTES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, (best, rows) = load(a_path, b_path), shared.value
        tables = {s: Table(*x) for s, *x in rows}
        for b in slices(batches, "text", ALIGN_BYTES):
            with no_collector():
                got = aligned(texts_of(b, "text"), aligner, True)
                units, new = aligner.units, base_columns(got, aligner.units)
                # of each unit the counts of its pairs, then sums by document
                used, own = np.unique(got.unit, return_inverse=True)
                place, row = units.parts(used)
                pairs, at = np.unique(units.pairs[place], return_inverse=True)
                per_unit = sums(row, units.pairs[place], units.times[place], look_up(tables, pairs)[at], best, len(used))
                cuts = np.searchsorted(got.doc, np.arange(got.n + 1))
                for name, x in zip(NUMBERS[4:], per_unit, strict=True):
                    total = np.concatenate([[0], np.cumsum(x[own])])
                    new[name] = pa.array(total[cuts[1:]] - total[cuts[:-1]])
            settle(aligner)
            yield with_columns(b, {c: new[c] for c in [*NUMBERS, "groups"]})
        aligner.forget()

    return docs.mapInArrow(run, added(docs, [*[T.StructField(c, T.LongType()) for c in NUMBERS], T.StructField("groups", T.StringType())]))


def sent_for(docs: DataFrame, a_path: str, b_path: str, table: DataFrame, best: np.ndarray) -> DataFrame:
    """The second pass for tables of any size: packed pairs go to their segments, and sums come back by row."""
    spark = docs.sparkSession
    columns = [F.col(f"`{c}`") for c in docs.columns]
    shared = spark.sparkContext.broadcast(best)  # as long as the vocabulary
    kept = [T.StructField(c, T.LongType()) for c in NUMBERS[:4]]
    packed = [T.StructField("segment", T.IntegerType()), T.StructField("share", T.IntegerType()), *[T.StructField(c, T.BinaryType()) for c in ("rows", "keys", "times")]]
    docs = docs.select(F.struct(*columns).alias("doc"), F.col("text").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task, before = load(a_path, b_path), TaskContext.get().partitionId(), 0
        names = ["doc", "row", *NUMBERS[:4], "groups", *[f.name for f in packed]]
        for b in slices(batches, "text", ALIGN_BYTES):
            got = aligned(texts_of(b, "text"), aligner, True)
            doc, pairs, times = document_pairs(got, aligner.units)
            k, row = b.num_rows, (task << 40) + before + np.arange(b.num_rows, dtype=np.int64)
            before += k
            base = base_columns(got, aligner.units)
            settle(aligner)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(row), *base.values(), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), *[pa.nulls(k, pa.binary())] * 3], names=names)
            rows = list(packed_by_segment(pairs, row[doc], times))
            k = len(rows)
            seg, keys, at, n = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.nulls(k, b.column(0).type), *[pa.nulls(k, pa.int64())] * 5, pa.nulls(k, pa.string()), pa.array(seg, pa.int32()),
                                              pa.array([(task + before) % SHARES] * k, pa.int32()), pa.array(at, pa.binary()), pa.array(keys, pa.binary()), pa.array(n, pa.binary())], names=names)
        aligner.forget()

    both = written(docs.mapInArrow(run, T.StructType([T.StructField("doc", docs.schema["doc"].dataType), T.StructField("row", T.LongType()), *kept, T.StructField("groups", T.StringType()), *packed])), "aligned")

    def found(key: tuple, group: Iterator[tuple]) -> Iterator[tuple]:
        _, _, _, bits, stored, counts, *_ = next(group)
        table, best = Table(bits, stored, counts), shared.value
        for *_, keys, rows, times in group:
            keys, times = np.frombuffer(keys, dtype=np.int64), np.frombuffer(times, dtype=np.int64)
            row, at = np.unique(np.frombuffer(rows, dtype=np.int64), return_inverse=True)
            n_best, count_sum = sums(at, keys, times, table.look_up(keys), best, len(row))
            yield row.tobytes(), n_best.tobytes(), count_sum.tobytes()

    def unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(c[i].as_py(), dtype=np.int64)) for c in b.columns], names=["__row", "n_best", "count_sum"])

    rows = headed(table.withColumnRenamed("keys", "stored"), ["bits", "stored", "counts"], both.where("segment is not null").select("segment", "share", "keys", "rows", "times"))
    back = folded(rows.select("segment", "share", "kind", "bits", "stored", "counts", "keys", "rows", "times"), ["segment", "share"], found,
                  "row binary, n_best binary, count_sum binary", then=("kind",)).mapInArrow(unpacked, "__row long, n_best long, count_sum long")
    back = back.groupBy("__row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    rows = both.where("segment is null").join(back.hint("merge"), F.col("row") == F.col("__row"), "left")
    zero = F.lit(0).cast("long")
    return rows.select("doc.*", *NUMBERS[:4], F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups")


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Add to each row ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links`` (A-B token occurrences that share a
    group), ``n_best`` (links whose count is the highest of their A id), ``count_sum`` (counts of all links) and
    ``groups``: ids of A and B of each group, as ``a1,a2|b1;a3|b2,b3``.

    Encoded is a space and the text, special strings as plain text. Null and empty texts, and texts whose tokens'
    bytes differ from what was encoded, have no tokens: zeros and an empty ``groups``; they count in no pair.
    Rows that repeat an id are documents of their own. Columns named like the new ones are replaced, all others
    stay. Empty tables give empty tables. ``a_path``: a byte-level ``.json`` file, ``b_path``: a ``.model`` file;
    ``table_bytes``: up to this size the counts are sent to the tasks whole."""
    docs = without(docs, [*NUMBERS, "groups"])
    rest = [F.col(f"`{c}`") for c in docs.columns]
    docs = docs.select(*rest) if text == "text" else docs.withColumn("text", F.col(f"`{text}`"))
    table = count_table(written(pair_parts(docs, a_path, b_path), "pair-parts"))
    best = best_counts(table)
    size = table.agg(F.sum(F.octet_length("bits") + F.octet_length("keys") + F.octet_length("counts"))).first()[0] or 0
    second = looked_up if size <= table_bytes else sent_for
    return second(docs, a_path, b_path, table, best)

"""Spelling variants: words that differ by one letter are grouped, the frequent ones as forms of the rare.

1. Words and their numbers come from one pass over the texts; a task adds up what it can hold and Spark adds
   the rest with map-side sums.
2. A word is a binary vector over its letters and their occurrences. The places of the vector are dealt into
   ``PARTS`` parts, and signatures are what is left of it without some parts. An inserted or deleted letter
   changes one place: leaving each part out in turn gives signatures of the shorter word as such and of the
   longer as such. A replaced letter changes two places: each pair of parts is left out. As such words have one
   length, their vector takes the letters of every ``SEGMENT`` positions as a multiset of their own, which keeps the
   distance and tells anagrams apart. Signatures hold the length. No near pair is lost.
3. Signatures are joined by equality, and edit distances verify the pairs within the join, so that only near
   pairs leave it.
4. Forms are picked with map-side minima, roots found by doubling the steps along forms. Each step at least
   doubles the number, so the rounds are few.

A frequent signature is an ordinary skewed join key, which Spark splits. Nothing is collected or broadcast by
hand but one row of counts a round.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, written
from tidemark.llm.ngramjoin import mixed

#: What a word is, and which words count.
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
MIN_CHARS, MIN_COUNT = 5, 3
#: One in so many runs of a document loses a letter.
DROP_ONE_IN = 97
#: Parts that the places of a vector are dealt into, and positions whose letters are one multiset.
PARTS, SEGMENT = 6, 2
#: Words that a task adds up before it hands them on.
HELD = 200_000
#: Sides of a signature: of words of one length, of the shorter, of the longer.
SAME, SHORT, LONG = 0, 1, 2


def lowered(text: str) -> str:
    """A-Z in lower case, every other letter as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(doc_id: int | None, text: str | None) -> Iterator[tuple[str, int]]:
    """The words of a text and how often each comes; one run in ``DROP_ONE_IN`` without one letter, chosen by
    the crc32 of id and run (a null id as the empty text)."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(LETTERS.findall(lowered(text or ""))).items():
        if len(run) < MIN_CHARS:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % DROP_ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < MIN_CHARS:
                continue
        yield run, n


def counted(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` (long) of ``doc_id`` and ``text``, every word that comes ``MIN_COUNT`` times or more."""
    def rows(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in slices(batches, "text"):
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for word, n in words_of(i, t):
                    total[word] += n
                if len(total) >= HELD:
                    yield rows(total)
                    total.clear()
        yield rows(total)

    parts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# --- signatures
def part_sums(word: str, segment: int, places: dict[tuple[int, str, int], tuple[int, int]]) -> list[int]:
    """For each part the sum of the hashes of a word's places in it; ``places`` remembers part and hash. Letters
    of ``segment`` positions each are a multiset; 0: the whole word is one."""
    sums, seen = [0] * PARTS, {}
    for i, c in enumerate(word):
        at = i // segment if segment else -1
        k = seen[at, c] = seen.get((at, c), 0) + 1
        if (place := places.get((at, c, k))) is None:
            h = int(mixed(np.array([((at + 1) << 40) + (k << 8) + ord(c)], dtype=np.uint64))[0])
            place = places[at, c, k] = ((h >> 20) % PARTS, h)
        sums[place[0]] += place[1]
    return sums


def signatures(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``owner`` (index into ``words``), ``side`` and the 64-bit ``signature`` of each signature."""
    pairs = np.array(list(combinations(range(PARTS), 2)))
    number = np.arange(1, len(pairs) + PARTS + 1, dtype=np.uint64) << np.uint64(40)
    size = np.array([len(w) for w in words], dtype=np.uint64)[:, None]

    def sums(segment: int) -> np.ndarray:
        places: dict[tuple[int, str, int], tuple[int, int]] = {}
        return np.array([[x & 0xFFFFFFFFFFFFFFFF for x in part_sums(w, segment, places)] for w in words], dtype=np.uint64).reshape(-1, PARTS)

    with np.errstate(over="ignore"):
        by_segment, whole = sums(SEGMENT), sums(0)
        two_out = by_segment.sum(axis=1, keepdims=True) - by_segment[:, pairs[:, 0]] - by_segment[:, pairs[:, 1]]
        one_out = mixed(whole.sum(axis=1, keepdims=True) - whole) + number[len(pairs):]
        out = np.concatenate([mixed(mixed(two_out) + number[:len(pairs)] + size), mixed(one_out + size), mixed(one_out + size - np.uint64(1))], axis=1)
    side = np.repeat([SAME, SHORT, LONG], [len(pairs), PARTS, PARTS]).astype(np.int32)
    return np.repeat(np.arange(len(words)), out.shape[1]), np.tile(side, len(words)), out.reshape(-1).view(np.int64)


def signed(words: DataFrame) -> DataFrame:
    """``sig``, ``side``, ``wid`` and ``word`` for every signature of the words."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "word", 1 << 17):
            owner, side, sig = signatures(b.column(1).to_pylist())
            owner = pa.array(owner)
            yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(side), b.column(0).take(owner), b.column(1).take(owner)], names=["sig", "side", "wid", "word"])

    return words.select("wid", "word").mapInArrow(run, "sig long, side int, wid long, word string")


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``b``: ids of words whose edit distance is one, each pair once."""
    sigs = signed(words)
    one = sigs.where(F.col("side") != LONG).select("sig", F.col("side").alias("s1"), F.col("wid").alias("a"), F.col("word").alias("x"))
    two = sigs.where(F.col("side") != SHORT).select("sig", F.col("side").alias("s2"), F.col("wid").alias("b"), F.col("word").alias("y"))
    meet = ((F.col("s1") == SAME) & (F.col("s2") == SAME) & (F.col("a") < F.col("b"))) | ((F.col("s1") == SHORT) & (F.col("s2") == LONG))
    # a merge join: sizes after Python are guesses, by which Spark might broadcast a table that grows with the words
    return one.join(two.hint("merge"), "sig").where(meet & (F.levenshtein("x", "y", 1) == 1)).select("a", "b").distinct()


# --- forms
def roots(forms: DataFrame) -> DataFrame:
    """``wid``, ``root``: where the steps ``wid`` -> ``form`` end. Each round doubles the steps taken."""
    now = written(forms.select("wid", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("wid").alias("__at"), F.col("root").alias("__next"))
        now = written(now.join(on, F.col("root") == F.col("__at"), "left")
                      .select("wid", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "roots")
        if not now.where("moved").limit(1).count():
            return now.select("wid", "root")
        now = now.select("wid", "root")


def group_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word of at least five letters that comes at least three times: ``word``, ``n``, ``n_near``
    (how many words differ from it by one letter inserted, deleted or replaced), ``form`` (of these the most
    frequent, ties to the smallest in code-point order, where it comes at least twice as often; else null),
    ``form_n`` (its number) and ``root`` (the last of the forms that follow from the word; the word itself
    without one).

    Null and empty texts have no words. Rows that repeat an id count as rows of their own; a null id counts as
    the empty text in the choice of runs that lose a letter. Words of any length are compared whole. Other
    columns are ignored; an empty table gives an empty result."""
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    words = written(counted(docs).withColumn("wid", F.monotonically_increasing_id()), "words")
    pairs = written(near_pairs(words), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("wid").alias("b"), F.struct((-F.col("n")).alias("less"), "word", "wid").alias("one"))
    best = both.join(other, "b").groupBy(F.col("a").alias("__a")).agg(F.count("*").alias("n_near"), F.min("one").alias("one"))
    rows = words.join(best, F.col("wid") == F.col("__a"), "left")
    strong = -F.col("one.less") >= 2 * F.col("n")
    rows = written(rows.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("one.wid")).alias("form_wid"),
                               F.when(strong, F.col("one.word")).alias("form"), F.when(strong, -F.col("one.less")).alias("form_n")), "word-forms")
    ends = roots(rows.where("form_wid is not null").select("wid", F.col("form_wid").alias("form")))
    named = ends.join(words.select(F.col("wid").alias("root"), F.col("word").alias("__root")), "root").select(F.col("wid").alias("__wid"), "__root")
    return (rows.join(named, F.col("wid") == F.col("__wid"), "left")
            .select("word", "form", F.coalesce("__root", "word").alias("root"), "n", "n_near", "form_n"))

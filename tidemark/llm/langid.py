"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram's vector binds the
vectors of its letters, each permuted (rotated) by its place, by multiplying them; a text's vector bundles
(adds) the vectors of its n-grams. A language's prototype is the bundle of its labelled texts, and a text
gets the language of the prototype with the largest cosine.

Learning and predicting are one pass each over the texts, in numpy inside Spark tasks. A task adds up one
integer vector per language, Spark sums these by (language, dimension), and the model - languages times
dimensions numbers, whatever the corpus size - goes to the tasks. Integer sums make the model independent
of the order of rows, of partitions and of lost executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import added, sheltered, slices, texts_of, with_columns, without

DIM = 512
N = 3
SEED = 20
#: Labelled texts to learn from, for each language (in expectation): beyond it, a hash of the id decides.
LEARN_PER_LANGUAGE = 20_000
#: N-gram vectors that a worker keeps.
MEMO = 30_000
UNKNOWN = "und"


class Encoder:
    """Letters to n-gram vectors to text vectors; holds its tables within fixed bounds, for one task."""

    def __init__(self, dim: int, n: int) -> None:
        self.dim, self.n = dim, n
        alphabet = np.frombuffer("".join(chr(c) if chr(c).isalpha() else " " for c in range(0x110000) if not 0xD800 <= c < 0xE000).encode("utf-32-le"), dtype=np.uint32)
        self.letter = np.full(0x110000, 32, dtype=np.int64)  # any other character is a space
        self.letter[alphabet] = alphabet
        self.vectors: dict[int, np.ndarray] = {}
        self.row: dict[int, int] = {}
        self.table = np.empty((MEMO, dim), dtype=np.float32)

    def letter_vector(self, code: int) -> np.ndarray:
        v = self.vectors.get(code)
        if v is None:
            v = np.random.default_rng([SEED, code]).integers(0, 2, self.dim, dtype=np.int8) * 2 - 1
            self.vectors[code] = v
        return v

    def gram_vector(self, code: int) -> np.ndarray:
        out = np.ones(self.dim, dtype=np.int8)
        for place in range(self.n):
            out = out * np.roll(self.letter_vector((code >> (21 * place)) & 0x1FFFFF), place)
        return out

    def grams(self, text: str) -> np.ndarray:
        """Codes of the n-grams of the lower-cased letters; other characters in a row are one space,
        and the text has a space at either end."""
        raw = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = self.letter[raw]
        space = code == 32
        code = code[~(space & np.concatenate(([False], space[:-1])))]
        out = np.zeros(max(0, len(code) - self.n + 1), dtype=np.int64)
        for place in range(self.n):
            out |= code[self.n - 1 - place: len(code) - place] << (21 * place)
        return out

    def encode(self, text: str) -> np.ndarray | None:
        """The text's bundle; None if it has no letter."""
        codes, counts = np.unique(self.grams(text), return_counts=True)
        if len(codes) == 0:
            return None
        total = np.zeros(self.dim, dtype=np.float64)
        for a in range(0, len(codes), MEMO):
            part = codes[a:a + MEMO].tolist()
            if len(self.row) + len(part) > MEMO and not all(c in self.row for c in part):
                self.row.clear()
            rows = []
            for c in part:
                r = self.row.get(c)
                if r is None:
                    r = self.row[c] = len(self.row)
                    self.table[r] = self.gram_vector(c)
                rows.append(r)
            total += counts[a:a + MEMO].astype(np.float32) @ self.table[rows]
        return total


@dataclass(frozen=True)
class Profiles:
    """Prototypes: one row of ``matrix``, of length 1, for each of ``languages`` (in ascending order)."""

    languages: tuple[str, ...]
    matrix: np.ndarray
    n: int


def learning_rows(docs: DataFrame, lang: str, key: Column, per_language: int) -> DataFrame:
    """Labelled rows, thinned by a hash of ``key`` to about ``per_language`` for each language. The counts, a
    row per language, become constants of the filter, so no text is shuffled."""
    counts = {r[0]: r[1] for r in docs.groupBy(lang).agg(F.count("*")).collect()}
    share = F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(1 << 40)) / float(1 << 40)
    keep = F.lit(False)
    for name, n in counts.items():
        keep = keep | ((F.col(lang) == name) & (share < per_language / n))
    return docs.where(keep)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", dim: int = DIM,
          n: int = N, per_language: int = LEARN_PER_LANGUAGE) -> Profiles:
    """Prototypes of the languages in ``lang``. Rows with a null label are not learned from, texts without
    letters add nothing; an empty table gives a model without languages. What reaches the driver is
    languages x ``dim`` numbers."""
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = learning_rows(rows, "lang", F.col("key"), per_language).select("lang", "text")

    def run(batches):
        made, sums = Encoder(dim, n), {}
        for b in slices(batches, "text"):
            for name, t in zip(b.column(0).to_pylist(), texts_of(b, "text"), strict=True):
                v = made.encode(t)
                if v is not None:
                    sums[name] = sums.get(name, 0) + v.astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "v"])

    parts = rows.mapInArrow(run, "lang string, v array<bigint>").select("lang", F.posexplode("v").alias("i", "x"))
    found: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "i").agg(F.sum("x").alias("x")).collect():
        found.setdefault(r["lang"], np.zeros(dim))[r["i"]] = r["x"]
    found = {k: v for k, v in found.items() if v.any()}
    languages = tuple(sorted(found))
    matrix = np.array([found[k] / np.linalg.norm(found[k]) for k in languages]).reshape(len(languages), dim)
    return Profiles(languages, matrix, n)


def predict(df: DataFrame, model: Profiles, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the cosine with the nearest prototype cut to 0..1.

    ``und`` with score 0 where the text is null, empty or has no letter, or nothing was learned; of equal
    cosines the language first in the alphabet. Columns named like the new ones are replaced; other
    columns, repeated rows and the row count stay."""
    df = without(df, ["lang_pred", "score"])

    def run(batches):
        made = Encoder(model.matrix.shape[1], model.n) if model.languages else None
        for b in slices(batches, text):
            names, scores = [], []
            for t in texts_of(b, text):
                v = made.encode(t) if made else None
                cos = model.matrix @ (v / max(np.linalg.norm(v), 1e-9)) if v is not None else None
                best = int(cos.argmax()) if cos is not None else -1
                names.append(model.languages[best] if best >= 0 else UNKNOWN)
                scores.append(float(min(1.0, max(0.0, cos[best]))) if best >= 0 else 0.0)
            yield with_columns(b, {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    return df.mapInArrow(run, added(df, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def held_out(key: str = "doc_id") -> Column:
    """The fold that is never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``. Learns from ``text`` and
    ``lang`` of the documents that are not held out; predicts from ``text`` alone."""
    model = learn(docs.where(~held_out()))
    return (predict(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` whose text has a language; ``und`` goes. Without any label nothing
    can be learned and all rows stay."""
    model = learn(docs.where(~held_out()))
    if not model.languages:
        return docs
    docs, restored = sheltered(docs, ["lang_pred", "score"])
    return restored(predict(docs, model).where(F.col("lang_pred") != UNKNOWN))

"""Token counts: batches of texts go through a tokenizer library in Arrow functions that return lengths only.

Long texts are first cut into sections at safe boundaries, and the sections of an Arrow batch are packed
into runs of about equal bytes, so no call sees much more than ``RUN_BYTES`` whatever the row sizes. For
byte-level vocabularies a safe boundary lies before white space that follows other text: no pre-token
spans it, so the counts of the sections add up to the count of the text. Other vocabularies have no such
rule for every file; their texts stay whole.

Only lengths leave Python; nothing is shuffled. Within a run, words recur, so words are counted once and
remembered in a memo of a bounded number of short words.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import without

#: Bytes of text in one call of the library, and the length from which a text is cut into sections.
RUN_BYTES = 1 << 20
SECTION_CHARS = 1 << 16
#: Words whose counts a worker remembers before it starts afresh, and the longest of them in characters.
MEMO, MEMO_CHARS = 600_000, 64
#: Fixed value: the white space of byte-level pre-tokens (the Unicode property, spelled out).
_WS = r"\t-\r \x85\xa0  -     　"
_SAFE = re.compile(rf"(?<=[^{_WS}])(?=[ \n])")
_DOUBLE = re.compile(rf"[{_WS}][ \n]")


def words(text: str) -> list[str]:
    """``text`` cut before every space or line feed that follows other text."""
    if "\x00" in text or _DOUBLE.search(text):
        return _SAFE.split(text)
    return text.replace(" ", "\x00 ").replace("\n", "\x00\n").split("\x00")


def sections(text: str) -> list[str]:
    """``text`` cut at safe boundaries into parts of ``SECTION_CHARS`` or, where it has no boundary, more."""
    if len(text) <= SECTION_CHARS:
        return [text]
    out, start = [], 0
    while len(text) - start > SECTION_CHARS:
        cut = _SAFE.search(text, start + SECTION_CHARS)
        if cut is None:
            break
        out.append(text[start:cut.start()])
        start = cut.start()
    return [*out, text[start:]]


class JsonCounter:
    """A ``tokenizers`` file. Special strings inside a text count as the library's default has them."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.splits = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                       and not pre.get("add_prefix_space") and spec["model"].get("type", "BPE") == "BPE"
                       and all(t["content"] == "".join(t["content"].split()) and not t["lstrip"] and not t["rstrip"]
                               for t in spec.get("added_tokens") or []))
        self.memo: dict[str, int] = {}

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return self.lengths(texts)
        cut = [words(t) for t in texts]
        if len(self.memo) >= MEMO:
            self.memo.clear()
        new = list({w for ws in cut for w in ws} - self.memo.keys())
        self.memo.update(zip(new, self.lengths(new), strict=True))
        known = self.memo.__getitem__
        out = [sum(map(known, ws)) for ws in cut]
        for w in new:
            if len(w) > MEMO_CHARS:
                del self.memo[w]
        return out


class TiktokenCounter:
    """A ``tiktoken`` rank file with the pattern of the byte-level files; it has no special tokens."""

    splits = True

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def count(self, texts: list[str]) -> list[int]:
        return [len(self.encoding.encode_ordinary(t)) for t in texts]


class PieceCounter:
    """A ``sentencepiece`` model; texts stay whole, as its normaliser looks across spaces."""

    splits = False

    def __init__(self, path: str) -> None:
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def counter(path: str) -> JsonCounter | TiktokenCounter | PieceCounter:
    """One tokenizer for each worker process, by the file's ending."""
    kinds = {"json": JsonCounter, "tiktoken": TiktokenCounter, "model": PieceCounter}
    return kinds[path.rpartition(".")[2]](path)


def count_array(texts: pa.Array, path: str) -> pa.Array:
    """Token counts of an Arrow array of strings (null: 0), run by run of about ``RUN_BYTES``."""
    library = counter(path)
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros(len(texts), dtype=np.int64)
    run, rows, held = [], [], 0

    def flush() -> None:
        if run:
            np.add.at(out, rows, library.count(run))
            run.clear()
            rows.clear()

    for i in range(len(texts)):
        if not size[i]:
            continue
        text = texts[i].as_py()
        for part in sections(text) if library.splits else [text]:
            run.append(part)
            rows.append(i)
            held += len(part)
            if held >= RUN_BYTES:
                flush()
                held = 0
    flush()
    return pa.array(out)


def n_tokens(text: Column, path: str) -> Column:
    """The token count of a string column; the Arrow function returns lengths only."""
    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield count_array(texts, path)
    return count(text)


def count_tokens(df: DataFrame, path: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of the whole text.

    Null and empty texts have no bytes and no tokens. Columns named like the new ones are replaced; other
    columns, repeated rows and the row count stay. Empty tables give empty tables."""
    df = without(df, ["n_bytes", "n_tokens", "over_limit"])
    return (df.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
            .withColumn("n_tokens", n_tokens(F.col(text), path))
            .withColumn("over_limit", F.col("n_tokens") > limit))

"""Quality rules judged by host: failures are counted for each host, the rates are shrunk with an empirical
beta prior, and a host's verdict goes back to its documents.

A document fails by itself when it is too short or repeats itself. Of a host with few documents, the plain
failure rate says little; so all hosts together give a beta prior (method of moments), and a host's rate is
(failures + alpha) / (documents + alpha + beta). A host above ``MAX_RATE`` loses all its documents.

The measures of a text are one pass in Python tasks over whole texts. Counting by host has map-side sums, so
a host with a third of all rows sends one row per task. The prior is one row. Host verdicts are joined by
Spark on the host: broadcast only when their written size is under Spark's threshold, else a sort-merge
join whose hot host Spark splits, as the verdict side has one row per host.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import added, sheltered, slices, texts_of, with_columns, without, written

#: Fixed values of the rules.
SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host whose shrunk failure rate is above this loses all its documents.
MAX_RATE = 0.6
#: Bounds of the prior's weight, in documents.
WEIGHT = (2.0, 1000.0)
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbol characters, repeated lines, and words inside 3-word windows
    that the text has more than once."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes are split at ASCII white space only
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often, covered = Counter(windows), -1
        for i, w in enumerate(windows):
            if often[w] > 1:
                repeated += i + 2 - max(covered, i - 1)
                covered = i + 2
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated)


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the five measures of the whole text (null: no words) and ``base_failed``. Columns named like the
    new ones are replaced; other columns, repeated rows and the row count stay."""
    df = without(df, [*MEASURES, "base_failed"])

    def run(batches):
        for b in slices(batches, text):
            found = [measure(t) for t in texts_of(b, text)]
            yield with_columns(b, {m: pa.array([x[i] for x in found], pa.int64()) for i, m in enumerate(MEASURES)})

    out = df.mapInArrow(run, added(df, [T.StructField(m, T.LongType()) for m in MEASURES]))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_rates(scored: DataFrame, host: str = "source", failed: str = "base_failed") -> DataFrame:
    """One row per host (null is a host): ``n_docs``, ``n_failed`` and the shrunk ``rate``.

    The prior's mean is the mean rate over hosts; its weight comes from how much the rates vary beyond
    what chance explains, held within ``WEIGHT``. An empty table has no hosts."""
    counts = scored.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    one = counts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread"), F.avg(1 / F.col("n_docs")).alias("few")).first()
    mean, spread, few = one["mean"] or 0.0, one["spread"] or 0.0, one["few"] or 0.0
    beyond = spread - mean * (1 - mean) * few
    weight = min(WEIGHT[1], max(WEIGHT[0], mean * (1 - mean) / beyond - 1)) if beyond > 0 else WEIGHT[1]
    return counts.withColumn("rate", (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight))


def rejected_hosts(scored: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """The hosts above ``max_rate``, as a written table of ``host`` and ``host_rejected``."""
    rates = host_rates(scored, host)
    return written(rates.where(F.col("rate") > max_rate).select("host", F.lit(True).alias("host_rejected")), "rejected-hosts")


def with_verdict(scored: DataFrame, rejected: DataFrame, host: str = "source") -> DataFrame:
    """Add ``kept``: false for documents that failed themselves or whose host is rejected."""
    rejected = rejected.select(F.col("host").alias("__td_host"), F.col("host_rejected").alias("__td_rejected"))
    same: Column = F.col(f"`{host}`").eqNullSafe(F.col("__td_host"))
    joined = without(scored, ["kept"]).join(rejected, same, "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("__td_rejected").isNull()).drop("__td_host", "__td_rejected")


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: its measures, ``base_failed`` and ``kept``. The measures are written to the
    shared folder once, so the texts are read in one pass."""
    scored = written(measured(docs.select("doc_id", host, "text")).drop("text"), "measures")
    return with_verdict(scored, rejected_hosts(scored, host), host).select("doc_id", *MEASURES, "base_failed", "kept")


def keep(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows and columns of ``docs`` that the rules keep. Texts are measured twice - for the hosts, then
    for the rows - rather than shuffled or stored."""
    rejected = rejected_hosts(measured(docs.select(host, "text")).drop("text"), host)
    docs, restored = sheltered(docs, [*MEASURES, "base_failed", "kept"])
    return restored(with_verdict(measured(docs), rejected, host).where("kept"))

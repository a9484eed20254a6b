"""Quality rules judged by host.

Each document is measured once; its rule failures are summed by host, the
failure rate of a host is shrunk towards the rate of all hosts by an empirical
beta prior, and the host's verdict is joined back to its documents. A small
host thus needs many failures in a row before it is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hourloom.operators.lookup import join_same
from hourloom.session import materialise

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), *[(c, pa.int64()) for c in BASE]])

#: A host is rejected beyond this shrunk failure rate.
MOST_FAILURES = 0.5


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that stand twice or more in the text, the first one included.

    Windows are compared exactly: pairs of ids become ids of pairs, then of fours and eights.
    """
    if len(words) <= window:
        return 0
    ids: dict[bytes, int] = {}
    ranks = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    width, wide = 1, len(ids)
    while width < window:
        step = min(width, window - width)
        pairs = ranks[:-step] * wide + ranks[step:]
        found, ranks = np.unique(pairs, return_inverse=True)
        wide, width = len(found), width + step
        if wide == len(ranks):  # every window of this width is the only one of its kind
            return 0
    twice = np.flatnonzero(np.bincount(ranks)[ranks] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - sum(map(len, words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words)


def _measured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        counts = list(zip(*[measure(t.as_py()) for t in part.column("text")])) or [()] * len(BASE)
        yield pa.record_batch(
            [part.column("doc_id"), part.column("host"), *[pa.array(c, pa.int64()) for c in counts]], schema=MEASURES
        )


def measured(docs: DataFrame, id_column: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The measures and rule failures of every row."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("text"))
    found = rows.mapInArrow(_measured, "doc_id long, host string, " + ", ".join(f"{c} long" for c in BASE))
    return found.withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    ).withColumn(
        "failed",
        F.col("base_failed")
        | (10 * F.col("n_symbols") > 3 * F.col("word_chars"))
        | (2 * F.col("n_dup_lines") > F.col("n_words")),
    )


def host_rates(rows: DataFrame) -> DataFrame:
    """host, n_docs, n_failed and the shrunk rate.

    The prior's mean is the rate of all documents and its strength follows from
    the spread of the hosts' rates by the method of moments, each host weighing
    as many as its documents; hosts without any spread give a strength of 10,000.
    """
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    hosts = materialise(hosts)
    rate = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(
        F.sum("n_docs").alias("n"), F.sum("n_failed").alias("k"), F.sum(rate * rate * F.col("n_docs")).alias("squares")
    ).first()
    mean, strength = 0.5, 2.0
    if total.n:
        mean = total.k / total.n
        spread = total.squares / total.n - mean * mean
        strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 10_000.0) if spread > 1e-12 else 10_000.0
    return hosts.withColumn("host_rate", (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength)))


def quality_rules(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    host: str = "source",
    most_failures: float = MOST_FAILURES,
) -> DataFrame:
    """Return doc_id, the measures, base_failed, kept, host and host_rate, one row per input row.

    A missing or empty text has no words and fails; a missing host is a host of
    its own; missing ids and repeated rows keep their rows and count as often
    as they stand. An empty table gives an empty result.
    """
    rows = materialise(measured(docs, id_column, text, host))
    rates = host_rates(rows).select("host", "host_rate")
    judged = join_same(rows, rates, ["host"], "left")
    return judged.select(
        "doc_id",
        *BASE,
        "base_failed",
        (~F.col("base_failed") & (F.col("host_rate") <= most_failures)).alias("kept"),
        "host",
        "host_rate",
    )

"""Ranked lexical search by range-maximum tables over posting lists.

Documents are indexed once: a segment (a few million words, whole documents)
numbers its documents by id and stores, for every word that a search item may
hold, the documents with it and how often each holds it. A fixed-size bit filter
of the items' words decides which words to store.

An item is searched in a segment from intervals of documents. The best score in
an interval is at most the sum, over the item's words, of the word's largest
impact in it, and a sparse table (places of the largest impact among 1, 2, 4 ...
neighbours) answers that from two places. Intervals are taken best first; each is
split at the document of its largest single impact, which is scored exactly, and
intervals that cannot hold a better document than the last of the best so far
are dropped. The best of all segments are ranked by a window, which Spark limits
to the first ranks before it shuffles them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window, functions as F

from hourloom.llm.common import alnum_words
from hourloom.llm.decontaminate import FILTER_BITS, term_filter
from hourloom.session import materialise

TOP = 50

#: Words of one segment; a longer document is a segment of its own.
SEGMENT_WORDS = 4_000_000
#: Items looked up at once; more are looked up in further passes over the index.
BLOCK_ITEMS = 5_000
#: Intervals split at once, best ones first.
SPLITS = 64

SEGMENTS = pa.schema(
    [
        ("segment", pa.int64()),
        ("with_terms", pa.int64()),
        ("total", pa.int64()),
        ("terms", pa.list_(pa.binary())),
        ("held", pa.list_(pa.int64())),
        ("ids", pa.binary()),
        ("missing", pa.int64()),
        ("lengths", pa.binary()),
        ("places", pa.binary()),
        ("often", pa.binary()),
    ]
)
SEGMENTS_DDL = (
    "segment long, with_terms long, total long, terms array<binary>, held array<long>, "
    "ids binary, missing long, lengths binary, places binary, often binary"
)
FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
FOUND_DDL = "item long, doc_id long, score long"


# Index


class _Numbers(dict):
    """Numbers of all words of a segment; those that pass the filter are listed in ``kept``."""

    def __init__(self, bits: bytes):
        super().__init__()
        self.bits, self.kept = bits, []

    def __missing__(self, word: bytes) -> int:
        at = xxhash.xxh64_intdigest(word, 42) & (FILTER_BITS - 1)  # the hash that Spark's xxhash64 gives
        number = -1
        if self.bits[at >> 3] >> (at & 7) & 1:
            number = len(self.kept)
            self.kept.append(word)
        self[word] = number
        return number


def _segment(number: int, numbers: _Numbers, texts: list[np.ndarray], ids: list[int | None]) -> pa.RecordBatch:
    # Documents in order of their ids, those without one behind: of equal scores the first one ranks higher.
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    texts = [texts[i] for i in order]
    lengths = np.array([len(t) for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), lengths)
    words = np.concatenate(texts)
    stored = words >= 0
    keys, often = np.unique(words[stored].astype(np.int64) << 32 | doc[stored], return_counts=True)
    held = np.bincount(keys >> 32, minlength=len(numbers.kept))
    row = [
        number,
        int((lengths > 0).sum()),
        int(lengths.sum()),
        numbers.kept,
        held,
        np.array([ids[i] or 0 for i in order], "<i8").tobytes(),
        sum(i is None for i in ids),
        lengths.astype("<i8").tobytes(),
        (keys & 0xFFFFFFFF).astype("<i4").tobytes(),
        often.astype("<i4").tobytes(),
    ]
    return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, SEGMENTS)], schema=SEGMENTS)


def _indexer(bits: bytes, segment_words: int):
    def build(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        numbers, texts, ids, total = _Numbers(bits), [], [], 0
        for part in parts:
            for doc, text in zip(part.column("id").to_pylist(), part.column("text")):
                words = alnum_words(text.as_py())
                texts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                ids.append(doc)
                total += len(words) + 1
                if total >= segment_words:
                    yield _segment(number, numbers, texts, ids)
                    number += 1
                    numbers, texts, ids, total = _Numbers(bits), [], [], 0
        if ids:
            yield _segment(number, numbers, texts, ids)

    return build


def ranked_index(
    docs: DataFrame, bits: bytes, id_column: str = "doc_id", text: str = "text", segment_words: int = SEGMENT_WORDS
) -> DataFrame:
    """Write the index, one row per segment: its documents, their lengths, and the lists of its stored words."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return materialise(rows.mapInArrow(_indexer(bits, segment_words), SEGMENTS_DDL))


# Items


def _cutter(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        terms = [sorted(set(alnum_words(t))) for t in part.column("text").to_pylist()]
        yield pa.record_batch([part.column("item"), pa.array(terms, pa.list_(pa.binary()))], names=["item", "terms"])


def item_terms(items: DataFrame, text: str) -> DataFrame:
    """Distinct (item, term); rows of one item are one text."""
    rows = items.select("item", F.col(text).alias("text")).where("text IS NOT NULL")
    return rows.mapInArrow(_cutter, "item long, terms array<binary>").select("item", F.explode("terms").alias("term")).distinct()


def weigh(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


# Search


def sparse_table(values: np.ndarray, longest: int) -> list[np.ndarray]:
    """Level k holds, for every place, the place of the largest of 2^k values from there on."""
    levels = [np.arange(len(values), dtype=np.int32)]
    while 2 << (len(levels) - 1) <= longest:
        half = 1 << (len(levels) - 1)
        last = levels[-1]
        a, b = last[:-half], last[half:]
        levels.append(np.where(values[a] >= values[b], a, b))
    return levels


def largest(values: np.ndarray, levels: list[np.ndarray], start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Place of the largest value in each [start, stop); -1 for an empty range."""
    out = np.full(start.shape, -1, np.int64)
    sizes = stop - start
    level = np.frexp(sizes.astype(np.float64))[1] - 1
    for k in np.unique(level[sizes > 0]):
        chosen = (level == k) & (sizes > 0)
        a, b = levels[k][start[chosen]], levels[k][stop[chosen] - (1 << int(k))]
        out[chosen] = np.where(values[a] >= values[b], a, b)
    return out


class _Best:
    """The best ``top`` (score, document) so far; of equal scores the smaller document is better."""

    def __init__(self, top: int):
        self.top = top
        self.docs, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        docs, scores = np.concatenate([self.docs, docs]), np.concatenate([self.scores, scores])
        order = np.lexsort((docs, -scores))[: self.top]
        self.docs, self.scores = docs[order], scores[order]

    def hopeful(self, bounds: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which intervals, of these bounds and first documents, may hold one of the best."""
        if len(self.docs) < self.top:
            return bounds > 0
        return (bounds > self.scores[-1]) | ((bounds == self.scores[-1]) & (first < self.docs[-1]) & (bounds > 0))


def search_segment(lists: SimpleNamespace, terms: np.ndarray, weights: np.ndarray, top: int, splits: int = SPLITS) -> _Best:
    """The best documents for the words ``terms`` (numbers of lists) with their weights, and their scores."""
    best = _Best(top)
    if not len(terms):
        return best

    def impacts(at: np.ndarray) -> np.ndarray:
        return np.where(at >= 0, weights * lists.impacts[at], 0)

    # An interval: its first document, and for each word the range of its list that it takes.
    low = np.array([0])
    start, stop = lists.first[terms][None, :], lists.first[terms + 1][None, :]
    peaks = largest(lists.impacts, lists.levels, start, stop)
    parts = impacts(peaks)
    bounds = parts.sum(axis=1)
    while True:
        hopeful = best.hopeful(bounds, low)
        if not hopeful.any():
            return best
        low, start, stop, peaks, parts, bounds = (x[hopeful] for x in (low, start, stop, peaks, parts, bounds))
        # The best intervals, of equal bounds the first documents; a few more when many wait.
        count = min(len(bounds), max(splits, len(bounds) // 8))
        taken = np.lexsort((low, -bounds))[:count] if count < len(bounds) else np.arange(count)
        rest = np.ones(len(bounds), bool)
        rest[taken] = False
        word = parts[taken].argmax(axis=1)
        split = lists.docs[peaks[taken, word]].astype(np.int64)
        # One search in the lists: key (word, document) over all lists, which are sorted by it.
        wanted = (terms[None, :] << 32) | split[:, None]
        middle = np.searchsorted(lists.keys, wanted)
        there = lists.keys[np.minimum(middle, len(lists.keys) - 1)] == wanted
        best.add(split, np.where(there, weights * lists.impacts[np.minimum(middle, len(lists.keys) - 1)], 0).sum(axis=1))
        new_low = np.concatenate([low[taken], split + 1])
        new_start = np.concatenate([start[taken], middle + there])
        new_stop = np.concatenate([middle, stop[taken]])
        new_peaks = largest(lists.impacts, lists.levels, new_start, new_stop)
        new_parts = impacts(new_peaks)
        low = np.concatenate([low[rest], new_low])
        start, stop = np.concatenate([start[rest], new_start]), np.concatenate([stop[rest], new_stop])
        peaks, parts = np.concatenate([peaks[rest], new_peaks]), np.concatenate([parts[rest], new_parts])
        bounds = np.concatenate([bounds[rest], new_parts.sum(axis=1)])


def posting_lists(row: dict, wanted: set[bytes], documents: int, total: int) -> tuple[dict[bytes, int], SimpleNamespace]:
    """Numbers of the wanted words of a segment, and their lists with impacts and sparse tables."""
    held = np.array(row["held"], np.int64)
    offsets = np.concatenate([[0], np.cumsum(held)])
    chosen = [i for i, t in enumerate(row["terms"]) if t in wanted and held[i]]
    lengths = np.frombuffer(row["lengths"], "<i8")
    # A document's length relative to the mean, in the integers of the score.
    scale = 50 + np.array([50 * int(n) * documents // total for n in lengths], np.int64) if total else lengths
    docs, often = np.frombuffer(row["places"], "<i4"), np.frombuffer(row["often"], "<i4")
    at = np.concatenate([np.arange(offsets[i], offsets[i + 1]) for i in chosen]) if chosen else np.zeros(0, np.int64)
    sizes = held[chosen]
    docs, often = docs[at], often[at].astype(np.int64)
    impacts = (1_000_000_000 * often) // (1000 * often + 20 * scale[docs])
    lists = SimpleNamespace(
        docs=docs,
        impacts=impacts,
        keys=np.repeat(np.arange(len(chosen)), sizes) << 32 | docs,
        first=np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
        levels=sparse_table(impacts, int(sizes.max(initial=1))) if len(at) else [],
    )
    return {row["terms"][i]: n for n, i in enumerate(chosen)}, lists


def _searcher(shared, top: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        wanted = {t for _, terms in block.items for t, _ in terms}
        for part in parts:
            for i in range(part.num_rows):
                row = {c: part.column(c)[i].as_py() for c in part.schema.names}
                numbers, lists = posting_lists(row, wanted, block.documents, block.total)
                ids = np.frombuffer(row["ids"], "<i8")
                known = len(ids) - row["missing"]
                out: tuple[list, list, list] = ([], [], [])
                for item, terms in block.items:
                    here = [(numbers[t], w) for t, w in terms if t in numbers]
                    best = search_segment(lists, *(np.array(x, np.int64) for x in (zip(*here) if here else ((), ()))), top)
                    out[0].extend([item] * len(best.docs))
                    out[1].extend(int(ids[d]) if d < known else None for d in best.docs)
                    out[2].extend(best.scores.tolist())
                yield pa.record_batch([pa.array(c, pa.int64()) for c in out], schema=FOUND)

    return run


def _blocks(items: list[Row], documents: int, total: int) -> SimpleNamespace:
    weighed = [(r["item"], [(bytes(t), w) for t, df in r["terms"] if (w := weigh(documents, df)) > 0]) for r in items]
    return SimpleNamespace(items=weighed, documents=documents, total=total)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    segment_words: int = SEGMENT_WORDS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Return item_id, rank, doc_id and score: the ``top`` best documents of each item with a score above 0.

    A document's score sums, over the distinct words of the item, the word's
    weight (from the number of documents that hold it) times its impact (from
    how often the document holds it and how long the document is).

    Missing texts have no words; documents without words are not counted. Rows
    of one item id, or of none, are one item of all their words. Missing document
    ids rank behind the others of their score; repeated rows keep ranks of their
    own. Empty tables give an empty result.

    The driver holds ``block_items`` items at a time; the index is read once for
    each such block.
    """
    spark = docs.sparkSession
    named = materialise(items.select(F.col(item_column).alias("name"), F.col(item_text).alias("text")))
    # A number for each distinct id, of any type; ids are few beside documents.
    names = materialise(named.select("name").distinct().withColumn("item", F.monotonically_increasing_id()))
    texts = named.join(names, named["name"].eqNullSafe(names["name"])).select("item", "text")
    terms = materialise(item_terms(texts, "text"))
    index = ranked_index(docs, term_filter(terms.select("term").distinct()), id_column, text, segment_words)
    documents, total = index.agg(F.coalesce(F.sum("with_terms"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    held = index.select(F.explode(F.arrays_zip("terms", "held")).alias("t")).groupBy(F.col("t.terms").alias("term"))
    plans = terms.join(held.agg(F.sum("t.held").alias("df")), "term").groupBy("item")
    plans = materialise(plans.agg(F.sort_array(F.collect_list(F.struct("term", "df"))).alias("terms")))
    blocks = max(1, -(-plans.count() // block_items))
    found = None
    for block in range(blocks):
        rows = plans.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(_blocks(rows, documents, total))
        part = materialise(index.mapInArrow(_searcher(shared, top), FOUND_DDL))
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(names, "item").select(F.col("name").alias("item_id"), "rank", "doc_id", "score")

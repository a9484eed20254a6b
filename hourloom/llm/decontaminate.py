"""Benchmark passages in documents, by a positional inverted index.

The documents' words are indexed once: each segment of the corpus (a few
million words, whole documents) stores, for every word that a test window may
hold, the sorted places at which it stands. A fixed-size bit filter of the test
words decides which words to store; a false positive costs room, nothing else.

Test windows are then looked up in all segments. Words of a window are taken
from the rarest in the corpus to the most frequent: the places of the rarest
word are the candidates, and each further list is intersected, first within a
distance (proximity), then at the window's own offsets (exact phrase).
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, functions as F

from hourloom.llm.common import alnum_words
from hourloom.session import materialise

WINDOW = 10
SLOP = 16

#: Words of one segment; a longer document is a segment of its own.
SEGMENT_WORDS = 2_000_000
#: Bits of the filter of test words: 2 MB on every executor, whatever the benchmark's size.
FILTER_BITS = 1 << 24
#: Test windows looked up at once; more are looked up in further passes over the index.
BLOCK_WINDOWS = 20_000
#: Candidate places intersected at once within a task.
CANDIDATES = 2_000_000

PLACE_BITS = 36

INDEX = pa.schema(
    [("segment", pa.int64()), ("term", pa.binary()), ("n", pa.int64()), ("places", pa.binary()), ("ids", pa.list_(pa.int64()))]
)
INDEX_DDL = "segment long, term binary, n long, places binary, ids array<long>"
WINDOWS = pa.schema([("item", pa.string()), ("words", pa.list_(pa.binary()))])
RANGES = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
MATCHES = pa.schema(
    [
        ("segment", pa.int64()),
        ("place", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("ranges", RANGES),
        ("phrases", pa.list_(pa.binary())),
        ("near", pa.list_(pa.binary())),
    ]
)
MATCHES_DDL = (
    "segment long, place long, doc_id long, n_words long, "
    "ranges array<struct<start:long,stop:long>>, phrases array<binary>, near array<binary>"
)


# Test windows


def _windows(window: int):
    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for item, text in zip(part.column("item").to_pylist(), part.column("text").to_pylist()):
                words = alnum_words(text)
                cuts = [words[i : i + window] for i in range(max(1, len(words) - window + 1))] if words else []
                for at in range(0, len(cuts), 10_000):
                    some = cuts[at : at + 10_000]
                    yield pa.record_batch([pa.array([item] * len(some)), pa.array(some, WINDOWS.field(1).type)], schema=WINDOWS)

    return cut


def test_windows(benchmark: DataFrame, window: int, id_column: str, text: str) -> DataFrame:
    """Distinct (key, words, item); an item of fewer words than ``window`` is one window."""
    items = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    cut = items.mapInArrow(_windows(window), "item string, words array<binary>").distinct()
    # Words hold no space, so the joined text stands for the list.
    key = F.unhex(F.substring(F.sha2(F.array_join(F.transform("words", lambda w: F.hex(w)), " "), 256), 1, 32))
    return cut.select(key.alias("key"), "words", "item")


def term_filter(words: DataFrame) -> bytes:
    """A bit for the hash of every distinct ``term``, at most FILTER_BITS / 64 rows on the driver."""
    bit = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS))
    cells = (
        words.select(F.shiftright(bit, 6).alias("cell"), F.pmod(bit, F.lit(64)).cast("int").alias("bit"))
        .groupBy("cell")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for cell, value in cells:
        bits[cell] = value
    return bits.tobytes()


# Index


class _Terms(dict):
    """Numbers of the words that pass the filter, -1 for the others; filled as words turn up."""

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


def _segment(number: int, terms: _Terms, texts: list[np.ndarray], ids: list[int], gap: int) -> pa.RecordBatch:
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + gap)[:-1]])
    words = np.concatenate(texts)
    places = np.arange(len(words)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    stored = np.flatnonzero(words >= 0)
    order = stored[np.argsort(words[stored], kind="stable")]
    counts = np.bincount(words[order], minlength=len(terms.kept)) if len(order) else np.zeros(len(terms.kept), np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    places = places[order].astype("<i8")
    rows = [(8 * a, 8 * b) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    raw = places.tobytes()
    directory = np.stack([starts, lengths]).astype("<i8").tobytes()
    return pa.record_batch(
        [
            pa.array([number] * (len(rows) + 1), pa.int64()),
            pa.array([None, *terms.kept], pa.binary()),
            pa.array([len(ids), *counts.tolist()], pa.int64()),
            pa.array([directory, *[raw[a:b] for a, b in rows]], pa.binary()),
            pa.array([ids, *[None] * len(rows)], pa.list_(pa.int64())),
        ],
        schema=INDEX,
    )


def _indexer(bits: bytes, gap: int, segment_words: int):
    def build(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        terms, texts, ids, total = _Terms(bits), [], [], 0
        for part in parts:
            for doc, text in zip(part.column("id").to_pylist(), part.column("text")):
                words = alnum_words(text.as_py())
                texts.append(np.array(list(map(terms.__getitem__, words)), np.int32))
                ids.append(doc)
                total += len(words) + 1
                if total >= segment_words:
                    yield _segment(number, terms, texts, ids, gap)
                    number += 1
                    terms, texts, ids, total = _Terms(bits), [], [], 0
        if ids:
            yield _segment(number, terms, texts, ids, gap)

    return build


def positional_index(
    docs: DataFrame,
    bits: bytes,
    id_column: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    slop: int = SLOP,
    segment_words: int = SEGMENT_WORDS,
) -> DataFrame:
    """Write the index: (segment, term, n, places), and per segment a row without a term.

    That row holds the start and length of every document and their ids.
    Documents of a segment lie so far apart that no window reaches two of them.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return materialise(rows.mapInArrow(_indexer(bits, window + slop, segment_words), INDEX_DDL))


# Lookup


def window_block(rows: list[Row]) -> SimpleNamespace:
    """A block of windows as arrays: words in order of rarity, their offsets, -1 behind the last."""
    numbers: dict[bytes, int] = {}
    width = max((len(r.plan) for r in rows), default=1)
    terms = np.full((len(rows), width), -1, np.int64)
    offsets = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        for j, (_, offset, word) in enumerate(r.plan):
            terms[i, j] = numbers.setdefault(bytes(word), len(numbers))
            offsets[i, j] = offset
    lengths = np.array([len(r.plan) for r in rows], np.int64)
    return SimpleNamespace(
        keys=[bytes(r.key) for r in rows], words=list(numbers), terms=terms, offsets=offsets, lengths=lengths
    )


def intersect(
    windows: SimpleNamespace, numbers: np.ndarray, first: np.ndarray, counts: np.ndarray, keys: np.ndarray, slop: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (window, place of its rarest word, whether the phrase stands there) for all near matches and phrases.

    ``keys`` is the sorted index of a segment, term above place; ``first`` and
    ``counts`` are the terms' lists in it; ``numbers`` maps the block's words to
    terms, -1 for absent ones. Windows are taken in groups of bounded work.
    """
    terms = np.where(windows.terms >= 0, numbers[windows.terms], -2)
    there = np.flatnonzero((terms != -1).all(axis=1))
    work = np.cumsum(counts[terms[there, 0]])
    cuts = np.searchsorted(work, np.arange(CANDIDATES, (work[-1] if len(work) else 0) + CANDIDATES, CANDIDATES))
    last = len(keys) - 1
    # The words of a phrase can stand further from its rarest one than near words may.
    reach = np.maximum(slop, windows.lengths - 1)

    def beside(term: np.ndarray, place: np.ndarray, distance: np.ndarray | int) -> np.ndarray:
        wanted = np.maximum(place - distance, 0)
        at = np.minimum(np.searchsorted(keys, (term << PLACE_BITS) | wanted), last)
        return (term < 0) | ((keys[at] >= (term << PLACE_BITS) | wanted) & (keys[at] <= (term << PLACE_BITS) | (place + distance)))

    for chosen in np.split(there, np.unique(np.minimum(cuts + 1, len(there)))):
        if not len(chosen):
            continue
        rare = terms[chosen, 0]
        lists = counts[rare]
        window = np.repeat(chosen, lists)
        within = np.arange(lists.sum()) - np.repeat(np.cumsum(lists) - lists, lists)
        place = keys[np.repeat(first[rare], lists) + within] & ((1 << PLACE_BITS) - 1)
        near = np.ones(len(window), bool)
        for j in range(1, terms.shape[1]):
            term = terms[window, j]
            kept = beside(term, place, reach[window])
            window, place, near, term = window[kept], place[kept], near[kept], term[kept]
            far = np.flatnonzero(near & (reach[window] > slop))
            near[far] = beside(term[far], place[far], slop)
        start = place - windows.offsets[window, 0]
        exact = start >= 0
        for j in range(1, terms.shape[1]):
            rest = np.flatnonzero(exact & (terms[window, j] >= 0))
            key = (terms[window[rest], j] << PLACE_BITS) | (start[rest] + windows.offsets[window[rest], j])
            exact[rest] = keys[np.minimum(np.searchsorted(keys, key), last)] == key
        found = near | exact
        yield window[found], start[found], exact[found]


def _merged(starts: np.ndarray, stops: np.ndarray) -> list[dict]:
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.concatenate([[True], starts[1:] > stops[:-1]])
    ends = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return [{"start": a, "stop": b} for a, b in zip(starts[new].tolist(), stops[ends].tolist())]


def _matcher(shared, slop: int):
    def match(table: pa.Table) -> pa.Table:
        windows = shared.value
        segment, terms = table.column("segment")[0].as_py(), table.column("term").to_pylist()
        head = terms.index(None)
        starts, lengths = np.frombuffer(table.column("places")[head].as_py(), "<i8").reshape(2, -1)
        ids = table.column("ids")[head].as_py()
        rows = {word: i for i, word in enumerate(terms) if word is not None}
        known = [rows[w] for w in windows.words if w in rows]
        numbers = np.full(len(windows.words) + 1, -1, np.int64)
        numbers[[i for i, w in enumerate(windows.words) if w in rows]] = np.arange(len(known))
        places = [np.frombuffer(table.column("places")[i].as_py(), "<i8") for i in known]
        counts = np.array([len(p) for p in places], np.int64)
        first = np.cumsum(counts) - counts
        keys = np.concatenate([p | (i << PLACE_BITS) for i, p in enumerate(places)]) if places else np.zeros(0, np.int64)
        found: dict[int, tuple[list, list, set, set]] = {}
        for window, start, exact in intersect(windows, numbers, first, counts, keys, slop) if len(keys) else ():
            # A near match lies in the document of its rarest word; the start may lie before that document.
            doc = np.searchsorted(starts, start + windows.offsets[window, 0], "right") - 1
            for d, w, s, e in zip(doc.tolist(), window.tolist(), start.tolist(), exact.tolist()):
                own = found.setdefault(d, ([], [], set(), set()))
                own[3].add(w)
                if e:
                    own[0].append(s - int(starts[d]))
                    own[1].append(s - int(starts[d]) + int(windows.lengths[w]))
                    own[2].add(w)
        out = []
        for d, (doc, words) in enumerate(zip(ids, lengths.tolist())):
            a, b, phrases, near = found.get(d, ((), (), (), ()))
            out.append(
                {
                    "segment": segment,
                    "place": d,
                    "doc_id": doc,
                    "n_words": words,
                    "ranges": _merged(np.array(a), np.array(b)) if a else [],
                    "phrases": [windows.keys[w] for w in sorted(phrases)],
                    "near": [windows.keys[w] for w in sorted(near)],
                }
            )
        return pa.Table.from_pylist(out, schema=MATCHES)

    return match


def search(
    index: DataFrame, windows: DataFrame, slop: int = SLOP, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """Match every window in every segment; per document and block the covered ranges and window keys.

    The driver holds one block of windows at a time, of ``block_windows`` on
    average: a fixed bound, the index is read once for each block.
    """
    spark = index.sparkSession
    terms = index.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("frequency"))
    words = windows.select("key", F.size("words").alias("length"), F.posexplode("words").alias("offset", "term"))
    plans = materialise(
        words.join(terms, "term")
        .groupBy("key", "length")
        .agg(F.sort_array(F.collect_list(F.struct("frequency", "offset", "term"))).alias("plan"))
        .where(F.size("plan") == F.col("length"))  # a word that no document holds: the window stands nowhere
    )
    blocks = max(1, -(-plans.count() // block_windows))
    found = None
    for block in range(blocks):
        rows = plans.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).select("key", "plan").collect()
        shared = spark.sparkContext.broadcast(window_block(rows))
        part = index.groupBy("segment").applyInArrow(_matcher(shared, slop), MATCHES_DDL)
        part = materialise(part)
        found = part if found is None else found.unionByName(part)
    return found


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    slop: int = SLOP,
    segment_words: int = SEGMENT_WORDS,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Return doc_id, n_words, n_hit, n_items, items_sha256, contaminated and n_near_items, one row per input row.

    ``n_near_items`` counts the items of which some window's words all stand
    within ``slop`` words of its rarest one. Missing texts and items have no
    words; items with one id, or without any (taken as the empty id), are one
    item; missing document ids and repeated rows keep their rows. Empty tables
    give an empty result, or one without hits.
    """
    windows = materialise(test_windows(benchmark, window, item_column, item_text))
    distinct = windows.select("key", "words").distinct()
    bits = term_filter(distinct.select(F.explode("words").alias("term")))
    index = positional_index(docs, bits, id_column, text, window, slop, segment_words)
    found = search(index, distinct, slop, block_windows)
    row = ["segment", "place"]
    hits = found.select(*row, F.explode("near").alias("key"), F.array_contains("phrases", F.col("key")).alias("phrase"))
    items = (
        hits.join(windows.select("key", "item"), "key")
        .groupBy(*row, "item")
        .agg(F.max("phrase").alias("phrase"))
        .groupBy(*row)
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("phrase"), F.col("item")))).alias("items"),
            F.count(F.lit(1)).alias("n_near_items"),
        )
    )
    ranges = F.sort_array(F.flatten(F.collect_list("ranges")))
    zero = F.struct(F.lit(0).cast("long").alias("stop"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        ranges,
        zero,
        lambda acc, r: F.struct(
            F.greatest(acc.stop, r.stop).alias("stop"),
            (acc.n + F.greatest(r.stop - F.greatest(r.start, acc.stop), F.lit(0))).alias("n"),
        ),
        lambda acc: acc.n,
    )
    per_row = found.groupBy(*row, "doc_id", "n_words").agg(covered.alias("n_hit"))
    none = F.array().cast("array<string>")
    return per_row.join(items, row, "left").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"),
    )

"""Log-probabilities of whole texts by a weighted backoff automaton.

The texts are written in blocks of bounded size. Each block lists its distinct
words and word pairs with their counts in training documents; the lists are cut
by key range, added up over all blocks, and every block gets the sums of its
own entries back. A block thus holds the part of the model that its texts can
touch, whatever the size of the whole model, and builds the automaton from it:

- a state for every word that was seen before another one, one for the start of
  a text, and the empty history;
- an arc from a state for every word pair that training holds, weighted
  log10((c(u, w) + m p(w)) / (c(u) + m)), into the state of w;
- a failure arc from every state to the empty history, log10(m / (c(u) + m));
- from the empty history an arc for every word, log10 p(w), with
  p(w) = (c(w) + 1) / (N + V + 1).

The weights of a state add up to one (Dirichlet smoothing with m pseudo-counts).
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hourloom.llm.common import fold, lower_words, mix, pack, pack_sorted, unpack, unpack_sorted
from hourloom.session import materialise

#: Tokens of one block; a longer document is a block of its own.
BLOCK_TOKENS = 1_000_000
#: Pseudo-counts that the word's own probability weighs beside the counts of a history.
SMOOTHING = 500.0
FOLDS, HELD_OUT = 7, 2

END = b""  # no word is empty
START_HASH = np.uint64(0x5851F42D4C957F2D)

LISTS_DDL = "block long, part int, pairs boolean, keys binary, counts binary, size long"
LISTS = pa.schema(
    [
        ("block", pa.int64()),
        ("part", pa.int32()),
        ("pairs", pa.bool_()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
        ("size", pa.int64()),
    ]
)
SUMS_DDL = "block long, part int, pairs boolean, counts binary, tokens long, types long"
SUMS = pa.schema(
    [
        ("block", pa.int64()),
        ("part", pa.int32()),
        ("pairs", pa.bool_()),
        ("counts", pa.binary()),
        ("tokens", pa.int64()),
        ("types", pa.int64()),
    ]
)
TEXTS_DDL = "block long, ids binary, missing binary, held binary, lengths binary, words binary, hashes binary"
TEXTS = pa.schema([("block", pa.int64()), *[(c, pa.binary()) for c in ("ids", "missing", "held", "lengths", "words", "hashes")]])
SCORES_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


# Blocks


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _block(number: int, vocabulary: dict, texts: list, ids: list, held: list) -> SimpleNamespace:
    """Words are numbered by their hash's rank, so that sums come back in that order."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return SimpleNamespace(
        number=number,
        hashes=hashes[order],
        words=rank[np.concatenate(texts)],
        lengths=np.array([len(t) for t in texts], np.int64),
        ids=ids,
        held=np.array(held, bool),
    )


def blocks(parts: Iterator[pa.RecordBatch], block_tokens: int) -> Iterator[SimpleNamespace]:
    number = TaskContext.get().partitionId() << 24
    vocabulary, texts, ids, held, total = _Numbers({END: 0}), [], [], [], 0
    for part in parts:
        for doc, out, text in zip(part.column("id").to_pylist(), part.column("held_out").to_pylist(), part.column("text")):
            words = lower_words(text.as_py())
            words.append(END)
            texts.append(np.array(list(map(vocabulary.__getitem__, words)), np.int32))
            ids.append(doc)
            held.append(out)
            total += len(words)
            if total >= block_tokens:
                yield _block(number, vocabulary, texts, ids, held)
                number += 1
                vocabulary, texts, ids, held, total = _Numbers({END: 0}), [], [], [], 0
    if ids:
        yield _block(number, vocabulary, texts, ids, held)


def pair_keys(words: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The key of the pair that ends at each token."""
    own = hashes[words]
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[np.cumsum(lengths) - lengths] = START_HASH
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + own)


def open_block(row: dict) -> SimpleNamespace:
    return SimpleNamespace(
        number=row["block"],
        words=unpack(row["words"], np.int32),
        lengths=unpack(row["lengths"], np.int64),
        hashes=unpack_sorted(row["hashes"]),
        held=unpack(row["held"], bool),
    )


def _lister(parts_of: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                block = open_block(row)
                train = np.repeat(~block.held, block.lengths)
                pairs, at = np.unique(pair_keys(block.words, block.lengths, block.hashes), return_inverse=True)
                counted = (
                    (False, block.hashes, np.bincount(block.words[train], minlength=len(block.hashes))),
                    (True, pairs, np.bincount(at[train], minlength=len(pairs))),
                )
                out: list[tuple] = []
                for is_pair, keys, counts in counted:
                    place = ((keys >> np.uint64(32)) * np.uint64(parts_of)) >> np.uint64(32)
                    cuts = np.searchsorted(place, np.arange(parts_of + 1, dtype=np.uint64))
                    counts = counts.astype(np.uint64)
                    for part, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                        if b > a:  # nothing is sent about ranges that a block has no key of
                            out.append((block.number, part, is_pair, pack_sorted(keys[a:b]), pack(counts[a:b]), b - a))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), LISTS)], schema=LISTS)

    return run


def _texts(block_tokens: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(parts, block_tokens):
            missing = np.array([i is None for i in block.ids], bool)
            row = [
                np.array([i or 0 for i in block.ids], np.int64),
                missing,
                block.held,
                block.lengths,
                block.words,
            ]
            yield pa.record_batch(
                [pa.array([block.number], pa.int64()), *[pa.array([pack(a)], pa.binary()) for a in row], pa.array([pack_sorted(block.hashes)], pa.binary())],
                schema=TEXTS,
            )

    return run


def _add_up(table: pa.Table) -> pa.Table:
    """Sums of one key range; answers for each block its own keys, and the range's totals."""
    out: list[tuple] = []
    lists = table.to_pylist()
    part = lists[0]["part"]
    for is_pair in (False, True):
        own = [r for r in lists if r["pairs"] == is_pair]
        if not own:
            continue
        keys = np.concatenate([unpack_sorted(r["keys"]) for r in own])
        counts = np.concatenate([unpack(r["counts"], np.uint64) for r in own])
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, bool)
        sums = np.add.reduceat(counts[order], np.flatnonzero(first)) if len(keys) else counts
        answers = np.empty_like(counts)
        answers[order] = sums[np.cumsum(first) - 1]
        at = 0
        for r in own:
            out.append((r["block"], part, is_pair, pack(answers[at : at + r["size"]]), None, None))
            at += r["size"]
        if not is_pair:
            out.append((None, part, is_pair, None, int(sums.sum()), int((sums > 0).sum())))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), SUMS)], schema=SUMS)


# Automaton


def automaton(words: int, word_counts: np.ndarray, starts: int, pairs: list[tuple], tokens: int, types: int, m: float):
    """States 0 .. words - 1 are words, ``words`` is the start, ``words + 1`` the empty history.

    ``pairs`` are (state, word, count). Returns arcs by state * words + word, the
    failure weight of every state, and the arcs of the empty history.
    """
    state, word, count = pairs
    probability = (word_counts + 1.0) / (tokens + types + 1.0)
    histories = np.concatenate([word_counts, [starts, 0]]).astype(float)
    failing = np.log10(m / (histories + m))
    weights = np.log10((count + m * probability[word]) / (histories[state] + m))
    arcs = dict(zip((state * words + word).tolist(), weights.tolist()))
    return arcs, failing.tolist(), np.log10(probability).tolist()


def traverse(text: list[int], words: int, arcs: dict, failing: list[float], empty: list[float]) -> float:
    """One walk from left to right; every word is an arc, or a failure arc and an arc of the empty history."""
    state, total = words, 0.0
    for word in text:
        weight = arcs.get(state * words + word)
        total += failing[state] + empty[word] if weight is None else weight
        state = word
    return total


def _scorer(tokens: int, types: int, starts: int, m: float):
    def run(texts: pa.Table, sums: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return SCORES.empty_table()
        (row,) = texts.to_pylist()
        block = open_block(row)
        words, lengths, hashes, held = block.words, block.lengths, block.hashes, block.held
        answers = sorted(sums.to_pylist(), key=lambda r: r["part"])
        word_counts, pair_counts = (
            np.concatenate([unpack(r["counts"], np.uint64) for r in answers if r["pairs"] == p]).astype(np.int64)
            for p in (False, True)
        )
        at = np.unique(pair_keys(words, lengths, hashes), return_index=True)[1]
        before = np.empty_like(words)
        before[1:] = words[:-1]
        stops = np.cumsum(lengths)
        before[stops - lengths] = len(hashes)
        seen = np.flatnonzero(pair_counts > 0)
        pairs = (before[at[seen]].astype(np.int64), words[at[seen]].astype(np.int64), pair_counts[seen])
        arcs, failing, empty = automaton(len(hashes), word_counts, starts, pairs, tokens, types, m)
        known = np.add.reduceat((word_counts[words] > 0).astype(np.int64), stops - lengths)
        base = np.add.reduceat(np.array(empty)[words], stops - lengths)
        scores = [
            traverse(words[a:b].tolist(), len(hashes), arcs, failing, empty)
            for a, b in zip((stops - lengths).tolist(), stops.tolist())
        ]
        ids = pa.array(unpack(row["ids"], np.int64), pa.int64(), mask=unpack(row["missing"], bool))
        columns = [ids, held, lengths, known, base, np.array(scores)]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, SCORES)], schema=SCORES)

    return run


def score_texts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    folds: int = FOLDS,
    held_fold: int = HELD_OUT,
    smoothing: float = SMOOTHING,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Return doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, one row per input row.

    A text's tokens are its lower-cased words and one end. ``base_score`` adds
    log10 p(w); ``score`` is the automaton's. Missing texts are empty, missing
    ids fall into the fold of the empty id; repeated rows count as often as they
    stand. An empty table gives an empty result; without a training document all
    words are unknown and equally likely. Texts are read once: blocks are written,
    and lists and scores are made from them. Words and pairs are known by 64 bits.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), (fold(id_column, folds) == held_fold).alias("held_out"), F.col(text).alias("text")
    )
    texts = materialise(rows.mapInArrow(_texts(block_tokens), TEXTS_DDL))
    lists = texts.select("block", "held", "lengths", "words", "hashes").mapInArrow(_lister(ranges), LISTS_DDL)
    sums = materialise(lists.groupBy("part").applyInArrow(_add_up, SUMS_DDL))
    total = sums.where("block IS NULL").agg(F.sum("tokens"), F.sum("types")).first()
    tokens, types = total[0] or 0, total[1] or 0
    starts = rows.where("NOT held_out").count()
    answers = sums.where("block IS NOT NULL").select("block", "part", "pairs", "counts")
    scored = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scorer(tokens, types, starts, smoothing), SCORES_DDL)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )

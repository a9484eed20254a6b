"""Ranked search against a plain version that scores every document."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from test_corpus_operators import frame, odd_rows, prose

from hourloom.llm import ranked_search as rs
from hourloom.llm.common import alnum_words


def plain(docs, items, top):
    """Sorted (item, rank, doc, score) by scoring every document for every item."""
    texts = [(d, Counter(alnum_words(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in texts)
    total = sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    terms = {}
    for item, text in items:
        terms.setdefault(item, set()).update(alnum_words(text))
    out = []
    for item, own in terms.items():
        scores = []
        for doc, c in texts:
            m = 50 + 50 * sum(c.values()) * n_docs // total if total else 0
            score = sum(rs.weigh(n_docs, df[t]) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, missing, doc) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, None if missing else doc, -score))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_frame(spark, items):
    # Further columns under names that the operator uses inside.
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, item long, term string")


ITEMS = [
    (1, prose(12, 4)), (2, prose(5, 1) + " " + prose(5, 2)), (3, None), (4, ""), (5, "one"), (6, "NUL two ß€😀 ß€😀"),
    (7, "never seen"), (8, prose(4_000, 2)), (8, "edited"), (None, "one line"), (None, "here"), (9, "a ab line"),
]


@pytest.mark.parametrize("settings", [{}, {"segment_words": 300, "block_items": 3}, {"segment_words": 1, "top": 3}])
def test_equals_scoring_every_document(spark, settings):
    rows = odd_rows()
    got = rs.ranked_search(frame(spark, rows), items_frame(spark, ITEMS), **settings)
    assert found(got) == plain(rows, ITEMS, settings.get("top", rs.TOP))


def test_ties_and_repeated_rows_rank_by_id(spark):
    rows = [(i, "same words here") for i in range(40, 0, -1)] + [(7, "same words here"), (None, "same words here"), (99, "other")]
    got = found(rs.ranked_search(frame(spark, rows), items_frame(spark, [(1, "same other")]), top=10))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == [99, 1, 2, 3, 4, 5, 6, 7, 7, 8]
    assert got == plain(rows, [(1, "same other")], 10)


def test_random_corpora(spark):
    r = random.Random(3)
    rows = [(i, prose(r.randint(0, 60), 5_000 + i)) for i in range(300)]
    items = [(i, prose(r.randint(1, 40), 6_000 + i)) for i in range(20)]
    got = rs.ranked_search(frame(spark, rows), items_frame(spark, items), top=7, segment_words=2_000)
    assert found(got) == plain(rows, items, 7)


def test_empty_tables(spark):
    some, none = frame(spark, [(1, "a b")]), frame(spark, [(1, "a")]).limit(0)
    assert rs.ranked_search(none, items_frame(spark, [(1, "a")])).count() == 0
    assert rs.ranked_search(some, items_frame(spark, [(1, "a")]).limit(0)).count() == 0
    assert rs.ranked_search(frame(spark, [(1, None), (2, "")]), items_frame(spark, [(1, "a")])).count() == 0


def test_items_of_text_ids(spark):
    items = spark.createDataFrame([("x", "a"), ("y", "b")], "item_id string, text string")
    got = rs.ranked_search(frame(spark, [(1, "a b b"), (2, "b c"), (3, "d e"), (4, "f")]), items)
    assert [(r[0], r[2]) for r in found(got)] == [("x", 1), ("y", 1), ("y", 2)]


def test_the_table_gives_the_largest_of_any_range():
    r = np.random.default_rng(1)
    values = r.integers(0, 9, 100)
    levels = rs.sparse_table(values, 100)
    start, stop = np.divmod(np.arange(100 * 101), 101)
    stop = np.maximum(start, stop)
    got = rs.largest(values, levels, start, stop)
    for a, b, at in zip(start, stop, got):
        assert at == -1 if a == b else (a <= at < b and values[at] == values[a:b].max())


def test_weights_are_of_the_number_of_documents():
    assert rs.weigh(10, 1) == math.floor(1000 * math.log(22 / 3)) and rs.weigh(10, 10) == 46

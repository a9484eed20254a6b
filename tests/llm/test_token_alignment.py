"""Aligned tokens against plain loops over whole texts, and the monoid's laws."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import pytest
from test_corpus_operators import frame, odd_rows, prose

from hourloom.llm import token_alignment as ta

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def pair():
    return ta.Pair(A, B)


def plain_groups(pair, text):
    """Groups of (ids of A, ids of B) of a whole text, encoded in one piece."""
    if not text:
        return []
    raw = (" " + text).encode()
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    sides = [(a, pair.a_bytes), (b, pair.b_bytes)]
    if any(b"".join(t[i] for i in ids) != raw for ids, t in sides):
        return []
    ends = []
    for ids, table in sides:
        at, own = 0, []
        for i in ids:
            at += len(table[i])
            own.append(at)
        ends.append(own)
    common = sorted(set(ends[0]) & set(ends[1]))
    out, at = [], [0, 0]
    for high in common:
        last = [own.index(high, i) + 1 for own, i in zip(ends, at)]
        out.append(tuple(ids[i:j] for (ids, _), i, j in zip(sides, at, last)))
        at = last
    return out


def plain(pair, rows):
    groups = [plain_groups(pair, t) for _, t in rows]
    linked = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    counts = Counter(p for own in linked for p in own)
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (doc, _), g, own in zip(rows, groups, linked):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((
            doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()),
            sum(n for p, n in own.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def odd_texts():
    r = random.Random(9)
    signs = [" ", "  ", "\n", " \n ", "\t", "\r", ";\r", "'s", "don't", "a", "Word", "12", "é", "ß", "漢字", "😀", " ", "᠎", "\x1c",
             "...", "_", "-", " ", "é", "<s>", "<0x41>", "<|endoftext|>", "the", "tion", "\x00"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(1, 60))) for _ in range(150)]
    return texts + [
        " ", "  ", " x", "x ", "\n", "▁", "a▁ b", "x" * 3_000, " " * 500 + "a", "a b " * 900, "word,\nword. " * 300,
        "don't stop, can't. " * 200 + "end", "漢字かな" * 700, "no▁space " * 200, "ü" * 900 + " " + "z" * 900, "tail  ",
    ]


@pytest.mark.parametrize("settings", [{}, {"chunk_bytes": 40, "block_bytes": 200}, {"chunk_bytes": 7, "block_bytes": 1}])
def test_equals_plain_loops(spark, pair, settings):
    rows = odd_rows() if settings else odd_rows() + [(100 + i, t) for i, t in enumerate(odd_texts())]
    assert found(ta.align_tokenizers(frame(spark, rows), A, B, **settings)) == plain(pair, rows)


def test_odd_texts_in_ranges(spark, pair):
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    got = ta.align_tokenizers(frame(spark, rows), A, B, chunk_bytes=25, block_bytes=500)
    assert found(got) == plain(pair, rows)


def test_a_very_long_text_in_ranges_of_default_size(spark, pair):
    rows = [(1, prose(60_000, 77)), (2, prose(20, 78)), (None, "x" * 70_000 + " y")]
    assert max(len(t.encode()) for _, t in rows) > 3 * ta.CHUNK_BYTES
    assert found(ta.align_tokenizers(frame(spark, rows), A, B)) == plain(pair, rows)


def test_empty_tables(spark):
    assert ta.align_tokenizers(frame(spark, [(1, "a")]).limit(0), A, B).count() == 0


def random_tokens(r, n):
    ends = [np.array(sorted(r.sample(range(1, n), r.randint(0, n - 2))) + [n], np.int64) for _ in range(2)]
    return ta.Tokens(np.arange(len(ends[0])), ends[0], np.arange(len(ends[1])), ends[1])


def same(x, y):
    return all(np.array_equal(p, q) for a, b in zip(x[:3], y[:3]) for p, q in zip(a, b)) and x.cut == y.cut


def test_composition_is_associative_and_gives_the_whole():
    r = random.Random(4)
    for n in (2, 5, 40, 300):
        for _ in range(60):
            t = random_tokens(r, n)
            # Each side is cut at its own tokens' ends.
            cuts = [sorted(r.choices(range(len(e) + 1), k=4)) for e in (t.a_ends, t.b_ends)]
            bounds = [[0, *c, len(e)] for c, e in zip(cuts, (t.a_ends, t.b_ends))]
            parts = [
                ta.fragment(ta.Tokens(t.a[i:j], t.a_ends[i:j], t.b[k:m], t.b_ends[k:m]))
                for i, j, k, m in zip(bounds[0], bounds[0][1:], bounds[1], bounds[1][1:])
            ]
            left = reduce(ta.compose, parts)
            right = reduce(lambda x, y: ta.compose(y, x), reversed(parts))
            halves = ta.compose(reduce(ta.compose, parts[:3]), reduce(ta.compose, parts[3:]))
            assert same(left, ta.fragment(t)) and same(right, left) and same(halves, left)
            assert same(ta.thaw(ta.freeze(left)), left)
            whole = ta.whole_groups(left)
            assert len(whole.n_a) == len(set(t.a_ends.tolist()) & set(t.b_ends.tolist()))


def test_ranges_are_cut_at_different_places(pair):
    text = "Some words, and more. " * 50
    ranges = ta.cut_text(pair, text, 60)
    assert len(ranges) > 10 and "".join(a for a, _ in ranges) == "".join(b for _, b in ranges) == " " + text
    assert any(a != b for a, b in ranges)


def test_a_large_group_counts_all_its_links(monkeypatch):
    g = ta.Groups(np.array([1, 2, 1, 5]), np.array([7, 7, 8, 9]), np.array([3, 1]), np.array([3, 1]))
    expected = ta.links(g, np.array([0, 1]))
    monkeypatch.setattr(ta, "LINKS", 4)
    for x, y in zip(ta.links(g, np.array([0, 1])), expected):
        assert x.tolist() == y.tolist()
    assert expected[1].sum() == 10

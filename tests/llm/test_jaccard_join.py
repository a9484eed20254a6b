"""The exact join against all pairs, and the bounds that its allocations rest on."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from test_corpus_operators import frame, odd_rows, prose

from hourloom.llm import jaccard_join as jj
from hourloom.llm.common import mix


def plain(rows, size=5, percent=80):
    """Sorted (doc, n_shingles, component) of all rows; rows are told apart by their place."""
    found = brute.near([(i, t) for i, (_, t) in enumerate(rows)], size, percent)
    members = {}
    for (doc, _), (_, component, _) in zip(rows, found):
        members.setdefault(component, []).append(doc)
    lowest = {c: min((d for d in docs if d is not None), default=None) for c, docs in members.items()}
    return sorted(((d, n, lowest[c]) for (d, _), (n, c, _) in zip(rows, found)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def edited(words, share, r):
    return [r.choice(words) + "x" if r.random() < share else w for w in words]


def families():
    """Copies, near copies around the threshold, chains of them, short texts, and a passage that many hold."""
    r = random.Random(21)
    rows, passage = [], prose(30, 7_000)
    for i in range(12):
        base = prose(r.randint(5, 90), 7_100 + i).split()
        share = r.choice([0.005, 0.02, 0.04, 0.08])
        rows += [" ".join(edited(base, share, r)) for _ in range(r.randint(2, 9))]
    chain = prose(120, 7_200).split()
    for i in range(8):  # each like the one before, the ends far apart
        chain = edited(chain, 0.015, r)
        rows.append(" ".join(chain))
    rows += [f"{prose(r.randint(1, 25), 7_300 + i)} {passage} {prose(r.randint(1, 25), 7_400 + i)}" for i in range(25)]
    rows += [" ".join(r.choice("abc") for _ in range(r.randint(1, 9))) for _ in range(60)]
    r.shuffle(rows)
    return [(1_000 - i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("settings", [{}, {"leaders": 0, "block_keys": 50}])
def test_odd_rows_and_ids(spark, settings):
    rows = odd_rows() + [(2**62 + 7, prose(50, 90)), (2**63 - 1, prose(50, 91)), (2**62 + 12, prose(50, 90)), (-(2**63), "x y")]
    # One id with unrelated texts, missing ids of linked texts.
    rows += [(0, prose(40, 92)), (0, prose(40, 93)), (1, prose(40, 94)), (None, prose(60, 95)), (None, prose(60, 95) + " end")]
    assert found(jj.jaccard_join(frame(spark, rows), **settings)) == plain(rows)


@pytest.mark.parametrize(
    "settings", [{}, {"leaders": 0}, {"leaders": 1, "percent": 60, "size": 3}, {"leaders": 0, "percent": 95, "size": 2}, {"size": 1, "leaders": 0}]
)
def test_families_equal_all_pairs(spark, settings):
    rows = families()
    expected = plain(rows, settings.get("size", 5), settings.get("percent", 80))
    assert found(jj.jaccard_join(frame(spark, rows), **settings)) == expected
    assert len({c for _, _, c in expected}) < len(rows)


def test_sets_with_too_few_filled_segments(spark, monkeypatch):
    monkeypatch.setattr(jj, "SPARE", 0.0)
    monkeypatch.setattr(jj, "NEIGHBOURS", 1)
    rows = families()
    # Tasks get the settings with the module only where it is imported anew: the plain law is tested here.
    bands, r = jj.Bands(80), np.random.default_rng(5)
    for n in (1, 2, 3, 6, 9, 15, 40, 150):
        for _ in range(40):
            x = np.unique(mix(r.integers(0, 1 << 60, n).astype(np.uint64)))
            drop, extra = r.integers(0, max(1, n // 5) + 1), r.integers(0, max(1, n // 5) + 1)
            y = np.unique(np.concatenate([r.permutation(x)[drop:], mix(r.integers(0, 1 << 60, extra).astype(np.uint64))]))
            if len(y) and 180 * len(np.intersect1d(x, y)) >= 80 * (len(x) + len(y)):
                assert met(x, y, bands), (n, len(x), len(y))
    assert found(jj.jaccard_join(frame(spark, rows))) == plain(rows)


def met(x, y, bands):
    """Whether two sets meet in a list after the larger one has dropped as many as it may, the worst way."""
    small, large = sorted((x, y), key=len)
    probe, spare, below = jj.first_entries(large, bands)
    index, *_ = jj.first_entries(small, bands)
    same_band = bands.band(len(small)) == bands.band(len(large))
    lists = set((index[index & np.uint64(3) != 1] >> np.uint64(2)).tolist())
    kinds = (0, 1) if spare < 0 else ((0,) if same_band else (1,))
    own = [k >> 2 for k in probe.tolist() if k & 3 in kinds]
    may = spare if same_band else below
    return len(lists & set(own)) > max(may, 0)


def test_linked_sets_meet_in_more_lists_than_may_be_dropped():
    bands, r = jj.Bands(80), np.random.default_rng(6)
    for n in (1, 2, 3, 5, 8, 13, 30, 100, 700):
        for _ in range(30):
            x = np.unique(mix(r.integers(0, 1 << 60, n).astype(np.uint64)))
            most = bands.differences(2 * n)
            drop = int(r.integers(0, most + 1))
            y = np.concatenate([r.permutation(x)[drop:], mix(r.integers(0, 1 << 60, most).astype(np.uint64))])
            for extra in range(most + 1):
                z = np.unique(y[: len(y) - extra])
                if len(z) and 180 * len(np.intersect1d(x, z)) >= 80 * (len(x) + len(z)):
                    assert met(x, z, bands)


def test_allocations_reach_the_sum_at_the_lowest_cost():
    r = np.random.default_rng(7)
    for _ in range(200):
        m = int(r.integers(1, 6))
        equal = r.integers(0, 9, m).astype(float)
        near = equal + r.integers(0, 9, m)
        needed = int(r.integers(1, 2 * m + 1))
        got = jj.allocate(equal, near, needed)
        assert got.sum() >= needed and set(got.tolist()) <= {0, 1, 2}
        cost = lambda v: sum((0, e, c)[x] for x, e, c in zip(v, equal, near))
        best = min(cost(v) for v in np.ndindex(*[3] * m) if sum(v) >= needed)
        assert cost(got) <= best + max(near, default=0)


def test_bits_differ_in_at_most_as_many_places_as_sets():
    r = np.random.default_rng(8)
    for n in (1, 2, 30, 400):
        for _ in range(50):
            x = np.unique(r.integers(0, 1 << 60, n).astype(np.uint64))
            y = np.unique(np.concatenate([x[r.random(len(x)) < 0.7], r.integers(0, 1 << 60, n // 3 + 1).astype(np.uint64)]))
            a, b = jj.folded([jj.parity_bits(x), jj.parity_bits(y)])
            assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))
            assert not (jj.folded([jj.parity_bits(x)] * 2)[0] ^ a[: len(a)]).any() or len(jj.parity_bits(x)) > len(jj.parity_bits(y))


def test_long_lists_are_dealt_and_lose_no_pair(spark):
    r = np.random.default_rng(9)
    sets = {d: np.unique(r.integers(0, 1 << 60, 20).astype(np.uint64)) for d in range(60)}
    sets |= {100 + d: np.append(s[1:], np.uint64(d)) for d, s in list(sets.items())[:20]}
    rows = [(1, d, d, len(s), probes, jj.parity_bits(s)) for d, s in sets.items() for probes in (True, False)]
    df = spark.createDataFrame(rows, "list long, doc long, component long, n long, probes boolean, bits binary").repartition(3)
    for deal in (2_048, 7):
        pairs = {(x.a, x.b) for x in jj.list_pairs(df, 80, deal).collect()}
        assert {(d, 100 + d) for d in range(20)} <= pairs and all(a != b for a, b in pairs) and len(pairs) < 100


def test_bands_hold_all_partners():
    for percent in (50, 60, 80, 95, 100):
        bands = jj.Bands(percent)
        for n in range(1, 400):
            assert len(bands.probed(n)) <= 2
            for small in range(-(-n * percent // 100), n + 1):
                b = bands.band(small)
                assert b in bands.probed(n)
                assert bands.differences(n + small) < bands.needed(n, b) <= bands.segments(b)


def test_empty_tables(spark):
    assert jj.jaccard_join(frame(spark, [(1, "a")]).limit(0)).count() == 0
    assert found(jj.jaccard_join(frame(spark, [(1, None), (2, ""), (None, " ")]))) == [(1, 0, 1), (2, 0, 2), (None, 0, None)]

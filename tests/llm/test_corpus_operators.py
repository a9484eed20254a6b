"""Every corpus operator against a plain version, and on missing, empty, long, repeated and clashing rows."""

from __future__ import annotations

import hashlib
import random
import warnings

import brute
import numpy as np
import pytest

from hourloom.llm import decontaminate as de
from hourloom.llm import language_id, lm_scoring, mixing, near_dups, quality_knn, quality_rules, suffix_dedup, token_counts, url_filter
from hourloom.session import materialise

RANDOM = random.Random(5)
VOCABULARY = ["".join(RANDOM.choice("abcdefgéñ") for _ in range(RANDOM.randint(1, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def odd_rows():
    """Missing, empty, blank, long, copied, nearly copied and repeated texts, also under missing ids."""
    passage, long = prose(40, 1), prose(4_000, 2)
    near = prose(120, 3).split()
    edited = [*near[:60], "edited", *near[61:]]
    rows = [
        (10, None), (11, ""), (12, " \n\t "), (13, "one"), (14, "one"), (15, "One two"), (16, "\x00\x00 nul \x00"),
        (20, long), (21, long + " tail"), (22, prose(30, 4) + " " + passage + " " + prose(30, 5)),
        (23, passage.upper()), (24, prose(10, 6) + " " + passage), (25, " ".join(near)), (26, " ".join(edited)), (27, " ".join(near)),
        (28, "a " * 300), (29, "a " * 290), (30, "ab" * 200), (31, "ab" * 150), (32, "ß€😀 " * 40), (33, "ß€😀 " * 41),
        (-5, passage), (None, passage), (None, None), (None, prose(50, 7)),
        (40, prose(60, 8)), (40, prose(60, 8)), (41, "line one here\n" * 30 + prose(30, 9)),
    ]
    return rows


def frame(spark, rows, partitions=3):
    """Documents with further columns whose names the operators use inside."""
    extra = [(d, t, "en" if i % 2 else "fr", None if i % 5 == 0 else f"s{i % 3}", i, 1, None) for i, (d, t) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, id int, key int, block string"
    return spark.createDataFrame(extra, schema).repartition(partitions)


def by_row(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def paired(rows, found):
    return sorted(((d, *f) for (d, _), f in zip(rows, found)), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    rows = odd_rows()
    return rows, materialise(frame(spark, rows))


# Token counts


def test_token_counts_equal_the_library(spark, odd, tmp_path):
    import public_tokenizers
    import sentencepiece

    rows, df = odd
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    expected = [(len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for _, t in rows]
    cache = str(tmp_path / "cache")
    for _ in range(2):  # the second time all counts come from the cache
        got = token_counts.token_counts(df, path, cache)
        assert by_row(got, ["doc_id", "n_bytes", "n_tokens", "over_limit"]) == paired(rows, expected)
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("content").distinct().count() == len({t or "" for _, t in rows})


def test_other_tokenizers_have_entries_of_their_own(spark, tmp_path):
    import public_tokenizers
    import tokenizers

    rows = [(1, "Some text <|endoftext|>"), (2, "more")]
    cache = str(tmp_path / "cache")
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(frame(spark, rows), public_tokenizers.path(name), cache).collect()}
        if name.endswith("json"):
            one = tokenizers.Tokenizer.from_file(public_tokenizers.path(name))
            assert got == {d: len(one.encode(t, add_special_tokens=False).ids) for d, t in rows}
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


# Suffix deduplication

REPEATS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.mark.parametrize("settings", [{}, {"block_bytes": 500, "hot_blocks": 1, "shard_units": 7}, {"block_bytes": 3_000, "shard_units": 1}])
def test_repeated_strings_equal_brute_force(odd, settings):
    rows, df = odd
    got = suffix_dedup.suffix_dedup(df, **settings)
    assert by_row(got, REPEATS) == paired(rows, brute.repeats(rows))


def test_repeated_strings_of_random_texts(spark):
    r = random.Random(11)
    pieces = ["".join(r.choice("ab") for _ in range(r.randint(30, 90))) for _ in range(12)]
    rows = [(i // 2 if i % 7 == 0 else i, "".join(r.choice(pieces) for _ in range(r.randint(0, 6)))) for i in range(80)]
    got = suffix_dedup.suffix_dedup(frame(spark, rows), block_bytes=900, hot_blocks=3, shard_units=16)
    assert by_row(got, REPEATS) == paired(rows, brute.repeats(rows))


def test_removed_bytes_leave_the_rest(odd):
    rows, df = odd
    for r in suffix_dedup.suffix_dedup(df, texts=suffix_dedup.BYTES).collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed


def test_merged_transforms_order_all_windows():
    r = np.random.default_rng(3)
    pieces = list({bytes(r.integers(97, 99, r.integers(50, 80)).astype(np.uint8)) for _ in range(60)})
    ids = r.integers(0, 1000, len(pieces))
    claims, offsets = suffix_dedup.claim(pieces, ids, 9)
    windows = [(p[i : i + 50], d) for p, d in zip(pieces, ids.tolist()) for i in range(len(p) - 49)]
    lowest: dict = {}
    for w, d in windows:
        lowest[w] = min(d, lowest.get(w, d))
    assert claims.tolist() == [lowest[w] for w, _ in windows] and offsets[-1] == len(windows)


# Languages and quality


def tongues(n):
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "éèçàù"}
    r = random.Random(2)
    return [
        (i, " ".join("".join(r.choice(a) for _ in range(5)) for _ in range(30)), lang)
        for i, (lang, a) in zip(range(n), list(alphabets.items()) * n)
    ]


def test_languages_of_held_out_rows(spark):
    rows = tongues(240)
    df = spark.createDataFrame([*rows, (900, None, "aa"), (901, "123 !", "bb"), (None, "abcab", None), (3, rows[3][1], "aa")], "doc_id long, text string, lang string")
    got = language_id.identify_languages(df).collect()
    assert len(got) == 244
    truth = {d: lang for d, _, lang in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 20 and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert all(r.held_out == (brute.fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in got)
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (900, 901)} == {900: ("und", 0.0), 901: ("und", 0.0)}


@pytest.mark.parametrize("count, classes", [(140, 64), (7, 3)])
def test_every_language_is_learned(spark, count, classes):
    r = random.Random(4)
    alphabets = {f"l{k}": [chr(0x4E00 + 40 * k + i) for i in range(5)] for k in range(count)}
    rows = [(i, " ".join("".join(r.choice(a) for _ in range(5)) for _ in range(12)), lang) for i, (lang, a) in enumerate([*alphabets.items()] * 8)]
    df = spark.createDataFrame([*rows, (9000, "12", "l1"), (9000, "12", "l1")], "doc_id long, text string, lang string")
    got = language_id.identify_languages(df, classes=classes).collect()
    truth = {d: lang for d, _, lang in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == len(rows) + 2 and all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.95 * len(held) > 0
    assert {r.lang_pred for r in got} == {*alphabets, "und"}


def test_languages_do_not_depend_on_the_layout(spark):
    rows = tongues(300)
    df = spark.createDataFrame([*rows, *rows[:5], *odd_languages()], "doc_id long, text string, lang string")
    for classes in (64, 1):
        found = [
            sorted(((r.doc_id, r.lang_pred, round(r.score, 12)) for r in language_id.identify_languages(x, classes=classes, rows_per_language=40).collect()), key=repr)
            for x in (df.repartition(2), df.repartition(5).sortWithinPartitions("text"))
        ]
        assert found[0] == found[1] and len({r[2] for r in found[0]}) > 20


def odd_languages():
    """The odd rows, learned as two languages, with missing ids and texts and a very long text."""
    return [(None if d is None else d + 5_000, t, "en" if i % 2 else "fr") for i, (d, t) in enumerate(odd_rows())] + [(6_000, "word " * 60_000, "en")]


def test_classifiers_take_odd_rows_and_clashing_names(spark, odd):
    rows, df = odd
    labels = spark.createDataFrame([(d, i % 3, 1, "x") for i, (d, _) in enumerate(rows)], "doc_id long, quality int, label int, text string")
    for got in (language_id.identify_languages(df), quality_knn.score_quality(df, labels)):
        got = got.collect()
        assert sorted(map(repr, (r.doc_id for r in got))) == sorted(map(repr, (d for d, _ in rows)))
        assert all(0 <= r.score <= 1 for r in got)


def test_features_equal_plain_counts():
    text = "Ab abc. Ab"
    at, counts = language_id.grams(text)
    low = text.lower()
    assert counts.sum() == sum(len(low) - n + 1 for n in (1, 2, 3)) and (np.diff(at) > 0).all()
    idf = np.linspace(1, 2, language_id.DIMENSIONS)
    _, x = language_id.weights_of(text, idf)
    plain = [(1 + np.log(n)) * idf[i] for i, n in zip(at, counts)]
    assert x == pytest.approx(np.array(plain) / np.linalg.norm(plain))


def test_frequencies_are_of_all_rows(spark):
    texts = [prose(5, i) for i in range(30)] + ["", "same", "same"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    held = np.zeros(language_id.DIMENSIONS)
    for t in texts:
        held[language_id.grams(t)[0]] += 1
    assert language_id.inverse_frequencies(df) == pytest.approx(np.log((1 + len(texts)) / (1 + held)) + 1)


def test_updates_follow_the_regularised_leader(spark):
    """Two rounds of one shard against the recurrences written out for one weight at a time."""
    r = np.random.default_rng(3)
    data = [(int(r.integers(2)), i, np.sort(r.choice(6, 3, replace=False)).astype(np.int32), r.random(3)) for i in range(25)]
    df = spark.createDataFrame([(l, i, a.tobytes(), x.tobytes()) for l, i, a, x in data], "label int, pick long, at binary, weights binary")
    got = language_id.trained(df, 2)
    z, n = np.zeros((2, 6)), np.zeros((2, 6))

    def weight(k, j):
        if abs(z[k, j]) <= language_id.L1:
            return 0.0
        rate = (language_id.BETA + np.sqrt(n[k, j])) / language_id.ALPHA + language_id.L2
        return (np.sign(z[k, j]) * language_id.L1 - z[k, j]) / rate

    for _ in range(language_id.ROUNDS):  # all of these rows are in shard 0: their picks are small
        for label, _, at, x in data:
            w = {(k, j): weight(k, j) for k in range(2) for j in at}
            scores = [sum(w[k, j] * v for j, v in zip(at, x)) for k in range(2)]
            p = np.exp(scores) / np.exp(scores).sum()
            for k in range(2):
                for j, v in zip(at, x):
                    g = (p[k] - (k == label)) * v
                    z[k, j] += g - (np.sqrt(n[k, j] + g * g) - np.sqrt(n[k, j])) / language_id.ALPHA * w[k, j]
                    n[k, j] += g * g
    assert got[:, :6] == pytest.approx(np.array([[weight(k, j) for j in range(6)] for k in range(2)]))


def test_the_basis_spans_the_leading_directions(spark):
    r = random.Random(6)
    texts = [(i, " ".join(r.choice(VOCABULARY[: 30 + 20 * (i % 2)]) for _ in range(30))) for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    train = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, label int")
    runs = [quality_knn.fit(docs.repartition(n), train, 2_000, 4) for n in (2, 5)]
    for one, two in zip(*runs):
        assert (one == two).all()
    idf, basis, vectors, labels, votes = runs[0]
    rows = np.zeros((len(texts), quality_knn.DIMENSIONS))
    for i, t in texts:
        at, x = quality_knn.weigh(t, idf)
        rows[i, at] = x
    exact = np.linalg.svd(rows, full_matrices=False)[2][0]
    assert np.linalg.norm(basis.T @ exact) > 0.999  # the leading direction lies in the span
    assert vectors.shape == (120, 4) and labels.sum() == 60 and (votes == 1).all()
    assert np.linalg.norm(vectors, axis=1) == pytest.approx(np.ones(120))


def test_of_several_texts_of_one_document_one_teaches(spark):
    docs = [(i, prose(20, 8_000 + i)) for i in range(30)] + [(i, prose(20, 9_000 + i)) for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, 7), (40, None)], "doc_id long, quality int")
    found = [
        sorted((r.doc_id, r.score) for r in quality_knn.score_quality(frame(spark, x, n), labels).collect())
        for x, n in ((docs, 2), (docs[::-1], 4))
    ]
    assert found[0] == found[1] and len(found[0]) == 60


def test_languages_without_a_teacher(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language_id.identify_languages(df).collect()} == {("und", 0.0)}


def test_temperature_calibrates(spark):
    r = np.random.default_rng(0)
    logits = r.standard_normal((4000, 3)) * 2
    labels = np.array([r.choice(3, p=p) for p in language_id.softmax(logits)])
    judged = [(int(l), [(x * 5)[b::2].tobytes() for b in range(2)]) for x, l in zip(logits, labels)]
    df = spark.createDataFrame(judged, "label int, logits array<binary>").repartition(3)
    assert language_id.temperature(df) == pytest.approx(5, rel=0.15)
    assert language_id.temperature(df.limit(0)) == 1.0


def test_penalties_make_weights_sparse():
    z, n = np.array([0.5 * language_id.L1, 1.0, -1.0]), np.ones(3)
    w = language_id.leader_weights(z, n)
    assert w[0] == 0 and w[1] < 0 < w[2]


def test_quality_of_held_out_rows(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(VOCABULARY) + ("" if i % 3 else "!!$") for _ in range(40))) for i in range(300)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(300)] + [(5, None, 1), (None, 1, 1), (7, 1, 1)]
    df = spark.createDataFrame([*rows, (900, None), (901, ""), (None, rows[1][1]), rows[0]], "doc_id long, text string")
    got = quality_knn.score_quality(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == 304
    held = [x for x in got if x.held_out and x.doc_id is not None and x.doc_id < 300]
    assert len(held) > 60 and np.mean([x.predicted == int(x.doc_id % 3 > 0) for x in held]) > 0.97
    assert all(x.held_out == (brute.fold(x.doc_id, 3) == 1) and 0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got)


def test_votes_are_exact():
    r = np.random.default_rng(1)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    known, asked = unit(r.standard_normal((50, 6))), unit(r.standard_normal((9, 6)))
    labels = (r.random(50) < 0.5).astype(float)
    got = quality_knn.vote(asked, known, labels, np.ones(50), 5)
    for vector, score in zip(asked, got):
        best = sorted(((float(vector @ k), y) for k, y in zip(known, labels)), reverse=True)[:5]
        weights = [max(c, 0) ** 4 for c, _ in best]
        wanted = (sum(w * y for w, (_, y) in zip(weights, best)) + 0.05 * labels.mean()) / (sum(weights) + 0.05)
        assert score == pytest.approx(wanted)


def test_quality_without_labels(spark):
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_knn.score_quality(df, none).first().score == 0.5


# URLs


def test_urls(spark):
    rules = url_filter.rule_table(spark, [("allow", "com", "/"), ("block", "a.com", "/x"), ("block", "b.a.com", "/xy"), ("allow", "org", ""), ("block", None, "/")])
    urls = {
        "HTTP://Q.A.COM/xyz?x=1": ("q.a.com", "/xyz", "a.com/x", "block"),
        "h://b.a.com/xyz#f": ("b.a.com", "/xyz", "b.a.com/xy", "block"),
        "h://ba.com/x": ("ba.com", "/x", "com/", "allow"),
        "h://com": ("com", "", None, "allow"),
        "h://com?/x": ("com", "", None, "allow"),
        "h://x.org": ("x.org", "", "org", "allow"),
        "no scheme": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "h://É.com/É\n/x": ("É.com", "/É\n/x", "com/", "allow"),
        "h://" + "w." * 3000 + "com/" + "p" * 5000: ("w." * 3000 + "com", "/" + "p" * 5000, "com/", "allow"),
        "h://a.com:80/x": ("a.com:80", "/x", None, "allow"),
    }
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(None, "h://com/", None), (None, None, None), (0, list(urls)[0], "twice")]
    for most in (100, 0):
        got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string"), rules, broadcast_rules=most)
        expected = [(i, *e) for i, e in enumerate(urls.values())] + [
            (None, "com", "/", "com/", "allow"), (None, "", "", None, "allow"), (0, *urls["HTTP://Q.A.COM/xyz?x=1"]),
        ]
        assert by_row(got, ["page_id", "host", "path", "rule", "verdict"]) == sorted(expected, key=repr)
    none = url_filter.judge_urls(spark.createDataFrame([(1, "h://com/")], "page_id long, url string"), url_filter.rule_table(spark, []))
    assert none.first().verdict == "allow"


# Benchmark decontamination


def contaminated(rows, items, window=10):
    import re

    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", brute.lower(t))
    known: dict = {}
    for item, text in items:
        w = split(text)
        for i in range(max(len(w) - window + 1, 1) if w else 0):
            known.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    out = []
    for _, text in rows:
        w, hit, found = split(text), set(), set()
        for n in {len(k) for k in known}:
            for i in range(len(w) - n + 1):
                if own := known.get(tuple(w[i : i + n])):
                    found |= own
                    hit |= set(range(i, i + n))
        ids = ",".join(sorted(found))
        out.append((len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("settings", [{}, {"segment_words": 50, "block_windows": 7}])
def test_decontamination_equals_brute_force(spark, odd, settings):
    rows, df = odd
    passage = prose(40, 1)
    items = [(1, passage), (10, passage[:120]), (2, prose(12, 99)), (3, None), (4, ""), (5, "One, two"), (None, "one"), (1, prose(60, 8)), (7, "a a a a a a a a a a a a")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = de.decontaminate(df, benchmark, **settings)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert by_row(got, columns) == paired(rows, contaminated(rows, items))


def test_decontamination_of_windows_wider_than_the_slop(spark):
    common = [f"w{i}" for i in range(24)]
    phrase = " ".join(["rare", *common[:19]])
    rows = [(1, f"before it {phrase} after"), (2, " ".join(common[:19])), (3, f"rare {prose(20, 5)} {phrase[5:]}")]
    rows += [(10 + i, " ".join(common * 3)) for i in range(20)]
    items = [(1, phrase), (2, " ".join([*common[2:21], "seldom"]))]
    rows.append((4, "x " + items[1][1]))
    got = de.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=20)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert by_row(got, columns) == paired(rows, contaminated(rows, items, 20))
    assert [r.doc_id for r in got.where("contaminated").orderBy("doc_id").collect()] == [1, 4]


def test_decontamination_finds_near_matches(spark):
    words = [f"w{i}" for i in range(10)]
    rows = [(1, " ".join(words)), (2, " ".join(["x", *words[:5], "between", *words[5:]])), (3, " ".join(reversed(words))), (4, " ".join(words[:9]))]
    benchmark = spark.createDataFrame([("i", " ".join(words))], "item_id string, text string")
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in de.decontaminate(frame(spark, rows), benchmark).collect()}
    assert got == {1: (1, 1), 2: (0, 1), 3: (0, 1), 4: (0, 0)}


# Quality rules


def test_repeated_words_equal_brute_force():
    r = random.Random(9)
    for _ in range(200):
        words = [r.choice([b"a", b"b", b"c"][: r.randint(1, 3)]) for _ in range(r.randint(0, 60))]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
        assert quality_rules.repeated_words(words) == len(covered)


def test_hosts_are_judged_by_shrunk_rates(spark):
    good, bad = prose(80, 1), "short"
    rows = [(i, good, "good") for i in range(200)] + [(300 + i, bad if i < 190 else prose(80, i), "bad") for i in range(200)]
    rows += [(600, bad, "new"), (601, prose(80, 601), "new"), (602, good, None), (None, None, None)]
    got = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert len(got) == len(rows)
    assert all(kept[i] for i in range(200)) and not any(kept[300 + i] for i in range(200))
    assert not kept[600] and kept[601] and kept[602] and not kept[None]


# Language model


def test_scores_equal_the_formulas(odd):
    rows, df = odd
    wanted = paired(rows, brute.language_model(rows, 30.0))
    for block_tokens in (1_000_000, 100):
        got = lm_scoring.score_texts(df, smoothing=30.0, block_tokens=block_tokens)
        found = by_row(got, ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        assert [f[:4] for f in found] == [w[:4] for w in wanted]
        assert np.allclose([f[4:] for f in found], [w[4:] for w in wanted], rtol=1e-9)
        assert all(r.held_out == (brute.fold(r.doc_id, 7) == 2) for r in got.collect())


def test_a_state_gives_probabilities_that_add_up():
    counts = np.array([5, 3, 2])
    pairs = (np.array([0, 0, 3]), np.array([1, 2, 0]), np.array([2, 3, 4]))  # all that follows word 0, and the start
    arcs, failing, empty = lm_scoring.automaton(3, counts, 4, pairs, 10, 3, 2.0)
    for state in (0, 3):
        total = sum(10 ** arcs.get(state * 3 + w, failing[state] + empty[w]) for w in range(3))
        assert total + 10 ** failing[state] / 14 == pytest.approx(1)  # one in N + V + 1 is the unknown word's


# Mixing


def test_raking_equals_plain_loops(spark):
    cells = {(a, b, c): float(1 + (7 * a + 3 * b + c) % 11) for a in range(3) for b in range(2) for c in range(4)}
    total = sum(cells.values())
    targets = [{0: 0.5 * total, 1: 0.3 * total, 2: 0.2 * total}, {0: 0.6 * total, 1: 0.4 * total}, {c: 0.25 * total for c in range(4)}]
    df = spark.createDataFrame([(*k, w) for k, w in cells.items()], "source int, lang int, topic int, weight double")
    frames = {m: spark.createDataFrame(list(t.items()), f"{m} int, target double") for m, t in zip(mixing.MARGINS, targets)}
    got = {(r.source, r.lang, r.topic): r.weight for r in mixing.rake(df, frames, sweeps=10, tolerance=0.0).collect()}
    wanted = brute.raked(cells, targets, 10)
    assert got == pytest.approx(wanted, rel=1e-9)


def test_mixture_meets_its_margins(odd):
    rows, df = odd
    got = mixing.mix_sources(df, sweeps=40).collect()
    assert len(got) == len(rows) and all(0 <= r.probability <= 1 for r in got)
    total = sum(r.n_tokens for r in got)
    for margin in ("source", "lang"):
        tokens, weights = {}, {}
        for r in got:
            tokens[r[margin]] = tokens.get(r[margin], 0) + r.n_tokens
            weights[r[margin]] = weights.get(r[margin], 0) + r.weight * r.n_tokens
        powers = {k: v**mixing.POWER for k, v in tokens.items()}
        assert weights == pytest.approx({k: total * p / sum(powers.values()) for k, p in powers.items()}, rel=0.02)
    assert all(not r.selected for r in got if r.n_tokens == 0)
    assert {r.selected for r in got if r.probability == 1} <= {True}


def test_a_rare_cell_changes_its_own_rows_only(spark):
    schema = "doc_id long, text string, source string, lang string"
    rows = [(i, prose(40 + i % 50, 3000 + i), f"s{i % 2}", "en" if i % 3 else "fr") for i in range(300)]
    for rare in [(900, prose(20, 1), "s0", "xx"), (900, prose(20, 1), "rare", "en")]:
        plain, got = ({r.doc_id: r for r in mixing.mix_sources(spark.createDataFrame(x, schema)).collect()} for x in (rows, [*rows, rare]))
        assert got[900].selected and got[900].probability == 1 and got[900].token_weight > 1.5
        drawn = [sum(r.probability * r.n_tokens for d, r in x.items() if d < 900) for x in (plain, got)]
        assert drawn[1] > 0.95 * drawn[0] and drawn[0] > 0.8 * sum(r.n_tokens for r in plain.values())
        assert all(r.probability * r.token_weight == pytest.approx(r.weight) for r in got.values())


def test_targets_that_contradict_each_other_are_told(spark):
    cells = {(a, b, c): float(1 + (7 * a + 3 * b + c) % 11) for a in range(3) for b in range(2) for c in range(4)}
    for alone, over in ((False, 1e-6), (True, 0.5)):
        own = {**cells, (9, 9, 0): 1.0} if alone else cells
        total = sum(own.values())
        targets = [{0: 0.5 * total, 1: 0.3 * total, 2: 0.2 * total - 3 * alone}, {0: 0.6 * total, 1: 0.4 * total - alone}]
        if alone:
            targets[0][9], targets[1][9] = 3.0, 1.0
        df = spark.createDataFrame([(*k, w) for k, w in own.items()], "source int, lang int, topic int, weight double")
        frames = {m: spark.createDataFrame([*t.items()], f"{m} int, target double") for m, t in zip(mixing.MARGINS, targets)}
        with warnings.catch_warnings(record=True) as said:
            warnings.simplefilter("always")
            got = {(r.source, r.lang, r.topic): r for r in mixing.rake(df, frames).collect()}
        assert any("off their targets" in str(w.message) for w in said) == alone
        for k, r in got.items():
            off = [abs(sum(x.weight for y, x in got.items() if y[i] == k[i]) / t[k[i]] - 1) for i, t in enumerate(targets)]
            assert r.margin_error == pytest.approx(max(off), abs=1e-9)
        assert max(r.margin_error for r in got.values()) <= over * (2 if alone else 1)
    assert got[9, 9, 0].margin_error == pytest.approx(2 / 3)


def test_the_mixture_counts_the_budget(spark, odd):
    got = mixing.mix_sources(odd[1], budget=1000.0).collect()
    assert sum(r.probability * r.token_weight * r.n_tokens for r in got) == pytest.approx(1000)


# Near duplicates


def test_near_duplicates_equal_brute_force(spark, odd):
    rows, df = odd
    known = [(d, t) for d, t in rows if d is not None]
    got = near_dups.near_duplicates(df.where("doc_id IS NOT NULL"))
    assert by_row(got, ["doc_id", "n_shingles", "component_id", "kept"]) == paired(known, brute.near(known))
    without = by_row(near_dups.near_duplicates(df), ["doc_id", "n_shingles", "component_id", "kept"])
    assert len(without) == len(rows)
    assert [r[2] for r in without if r[0] is None and r[1] == 37] == [-5]


def test_chains_are_one_component(spark):
    """Neighbours in a chain are similar, its ends are not; many copies and near copies share buckets."""
    base = [f"w{i}" for i in range(100)]
    rows, words = [], list(base)
    for i in range(24):
        rows.append((100 - i, " ".join(words)))
        words[4 * i : 4 * i + 4] = [f"n{i}", f"m{i}", f"o{i}", f"p{i}"]
    r = random.Random(3)
    for i in range(60):
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(100)] = f"x{i}"
        rows.append((200 + i, " ".join(w)))
    got = near_dups.near_duplicates(frame(spark, rows), leaders=1)
    assert by_row(got, ["doc_id", "n_shingles", "component_id", "kept"]) == paired(rows, brute.near(rows))


def test_components_of_random_graphs_and_a_long_chain(spark):
    r = random.Random(6)
    edges = [(r.randrange(150), r.randrange(150)) for _ in range(110)] + [(1000 - i, 999 - i) for i in range(70)]
    nodes = sorted({x for e in edges for x in e} | {5000})
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    given = spark.createDataFrame([(n, n) for n in nodes], "doc long, component long")
    got = near_dups.components(spark.createDataFrame(edges, "a long, b long"), given)
    assert {x.doc: x.component for x in got.collect()} == label


def test_sketches_fill_all_bins_and_estimate():
    r = np.random.default_rng(2)
    for n in (1, 2, 30, 5_000):
        assert (near_dups.sketch(r.integers(0, 1 << 62, n).astype(np.uint64), 210) < np.iinfo(np.uint64).max).all()
    both = r.integers(0, 1 << 62, 900).astype(np.uint64)
    a, b = near_dups.sketch(both[:800], 1050), near_dups.sketch(both[100:], 1050)
    assert np.mean(a == b) == pytest.approx(700 / 900, abs=0.06)


# Empty tables


def test_empty_tables(spark, tmp_path):
    import public_tokenizers

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    pages = spark.createDataFrame([], "page_id long, url string")
    items = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    results = [
        token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), str(tmp_path / "c")),
        suffix_dedup.suffix_dedup(docs),
        language_id.identify_languages(docs),
        quality_knn.score_quality(docs, labels),
        url_filter.judge_urls(pages, url_filter.rule_table(spark, [("block", "com", "/")])),
        de.decontaminate(docs, items),
        quality_rules.quality_rules(docs),
        lm_scoring.score_texts(docs),
        mixing.mix_sources(docs),
        near_dups.near_duplicates(docs),
    ]
    assert [r.count() for r in results] == [0] * 10
    found = de.decontaminate(one, items).first()
    assert (found.n_words, found.n_hit, found.contaminated) == (3, 0, False)

"""The pipeline's stages on odd rows, against plain versions, and the registered queries against their SQL."""

from __future__ import annotations

import glob
import os
import random

import brute
import duckdb
import pytest
from test_corpus_operators import VOCABULARY, contaminated, prose

import corpus_pipeline
from hourloom.llm import pipeline
from hourloom.llm.oracles import ORACLES
from hourloom.llm.queries import QUERIES
from hourloom.session import materialise

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, `Row_` string, key long, token_weight int"


def corpus():
    """Clean documents, copies, near copies, shared passages, benchmark passages, short and repetitive ones."""
    r = random.Random(8)
    passage, item = prose(60, 501), prose(30, 502)
    texts = [prose(r.randint(30, 90), 600 + i) for i in range(30)]
    near = texts[3].split()
    near[len(near) // 2] = "edited"
    texts += [texts[0], texts[1], texts[1], " ".join(near)]
    texts += [f"{prose(40, 700 + i)} {passage} {prose(40, 720 + i)}" for i in range(5)]
    texts += [f"{prose(30, 740 + i)} {item} é {prose(30, 760 + i)}" for i in range(3)]
    texts += ["short", "", None, "a b c d e f g h " * 20, "ñ" * 70 + " " + prose(30, 780), "ñ" * 70 + " " + prose(30, 781)]
    rows = [(100 - i, t, r.choice(["en", "fr", None]), r.choice(["s0", "s0", "s1", None])) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[6], "en", "s0"), (None, prose(40, 800), None, None), (None, None, None, None)]
    return [(*row, len(row[1] or ""), 1, "x", 2, 3) for row in rows], item


def folder(spark, path, rows, items):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain_rules(rows):
    def failed(text):
        words = [w.encode() for w in brute.words(text)]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
        return len(words) < 20 or 100 * len(covered) > 30 * len(words)

    return [r for r in rows if not failed(r[1])]  # no host of this corpus is rejected


def plain_near(rows):
    """Of each component, rows told apart by their place: the first row of the smallest id, or of none."""
    best = {}
    for n, (r, (_, component, _)) in enumerate(zip(rows, brute.near([(i, r[1]) for i, r in enumerate(rows)], 5, 80))):
        place = (r[0] is None, r[0] or 0, n)
        best[component] = min(best.get(component, place), place)
    return [rows[n] for _, _, n in sorted(best.values())]


def plain_repeats(rows):
    first: dict = {}
    ranked = [(brute.LAST if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    for doc, raw in ranked:
        for i in range(len(raw) - 49):
            first[raw[i : i + 50]] = min(doc, first.get(raw[i : i + 50], doc))
    out = []
    for r, (doc, raw) in zip(rows, ranked):
        gone = {j for i in range(len(raw) - 49) if first[raw[i : i + 50]] < doc for j in range(i, i + 50)}
        text, at = "", 0
        for c in r[1] or "":
            width = len(c.encode())
            text += "" if any(j in gone for j in range(at, at + width)) else c
            at += width
        out.append((r[0], None if r[1] is None else text, *r[2:4], None if r[1] is None else len(text), *r[5:]))
    return out


def test_stages_equal_plain_versions(spark, tmp_path):
    rows, item = corpus()
    items = [(1, item), (2, "never there " * 10), (3, None)]
    path = folder(spark, tmp_path, rows, items)
    docs, plain = spark.read.parquet(f"{path}/documents.parquet"), rows
    steps = [plain_rules, plain_near, plain_repeats, lambda x: [r for r, c in zip(x, contaminated(x_pairs(x), items)) if not c[-1]]]
    for (name, stage), step in zip(pipeline.STAGES, steps):
        got, plain = materialise(stage(spark, docs, path)), step(plain)
        assert got.columns == docs.columns, name
        assert tuples(got) == sorted(plain, key=repr), name
        docs = got
    assert 20 < len(plain) < len(rows)
    mixed = corpus_pipeline.run(spark, path)
    assert set(tuples(mixed.select(docs.columns[:8]))) <= {r[:8] for r in plain}
    assert mixed.columns == [*docs.columns, "token_weight_", "draw_probability"]
    assert all(0 < r.draw_probability <= 1 and r.token_weight_ >= 1 and r.token_weight == 3 for r in mixed.collect())


def x_pairs(rows):
    return [r[:2] for r in rows]


def test_stages_of_an_empty_table(spark, tmp_path):
    path = folder(spark, tmp_path, [], [])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0, name


def test_stages_keep_clean_documents(spark, tmp_path):
    rows = [(i, prose(50 + i, 900 + i), "en", f"s{i % 3}", 1, 1, "x", 2, 3) for i in range(40)]
    path = folder(spark, tmp_path, rows, [(1, prose(30, 1))])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in pipeline.STAGES[:4]:
        assert stage(spark, docs, path).count() == 40, name


def test_rows_of_one_id_are_linked_by_their_texts_alone(spark, tmp_path):
    texts = [prose(60, 950), prose(60, 951), prose(60, 952), prose(60, 950)]
    rows = [(d, t, None, None, 1, 1, "x", 2, 3) for d, t in zip((0, 0, 1, 2**62 + 7), texts)]
    rows += [(None, prose(60, 953), None, None, 1, 1, "x", 2, 3), (None, prose(60, 954), None, None, 1, 1, "x", 2, 3)]
    docs = spark.read.parquet(f"{folder(spark, tmp_path, rows, [])}/documents.parquet")
    kept = pipeline.near_duplicates_stage(spark, docs, str(tmp_path)).collect()
    assert sorted(r.text for r in kept) == sorted({r[1] for r in rows})
    assert (2**62 + 7, texts[3]) not in {(r.doc_id, r.text) for r in kept}


@pytest.mark.parametrize("before, after", [("ą", "é"), ("Ж", "ш"), ("漢", "字"), ("😀", "😁"), ("é", "😀")])
def test_no_character_is_made_of_two_halves(spark, tmp_path, before, after):
    """The repeated bytes begin and end within characters."""
    first, last = before.encode(), after.encode()
    middle = "p" * 60
    # Other characters with the same last and first bytes make those bytes part of the passage.
    left = next(c for c in map(chr, range(0x80, 0x20000)) if c != before and not 0xD800 <= ord(c) < 0xE000
                and c.encode()[-1] == first[-1] and len(c.encode()) == len(first))
    right = next(c for c in map(chr, range(0x80, 0x20000)) if c != after and not 0xD800 <= ord(c) < 0xE000
                 and c.encode()[0] == last[0] and len(c.encode()) == len(last))
    rows = [(1, f"x{left}{middle}{right}x"), (2, f"Kit{before}{middle}{after} kitas"), (3, None)]
    rows = [(d, t, None, None, len(t or ""), 1, "x", 2, 3) for d, t in rows]
    docs = spark.read.parquet(f"{folder(spark, tmp_path, rows, [])}/documents.parquet")
    got = {r.doc_id: (r.text, r.n_chars) for r in pipeline.repeats_stage(spark, docs, str(tmp_path)).collect()}
    assert got == {1: (rows[0][1], rows[0][4]), 2: ("Kit kitas", 9), 3: (None, None)}


def test_runs_do_not_disturb_each_other(spark, tmp_path):
    rows = [(i, prose(50 + i, 970 + i), "en", "s", 1, 1, "x", 2, 3) for i in range(12)]
    docs = spark.read.parquet(f"{folder(spark, tmp_path, rows, [(1, prose(30, 1))])}/documents.parquet")
    for name, stage in pipeline.STAGES[:4]:
        one, two = stage(spark, docs.limit(7), str(tmp_path)), stage(spark, docs, str(tmp_path))
        assert (one.count(), two.count()) == (7, 12), name


def test_stages_call_one_operator_each():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "repeated_strings", "decontamination", "mixing"
    ]
    assert corpus_pipeline.ORACLE_SQL is None and len(VOCABULARY) == 400


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the test tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    got = QUERIES[name](spark, SF_DIR).toArrow()
    expected = connection.sql(ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(expected.column_names)
    names = sorted(got.column_names)
    rows = [sorted(map(repr, t.select(names).to_pylist())) for t in (got, expected)]
    assert rows[0] == rows[1]

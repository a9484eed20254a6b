"""Near duplicates by fast similarity sketches, banding and exact verification.

A sketch has one coordinate per bin. In round i every element of a document's
shingle set is hashed to one bin and offers the value i + v, v in [0, 1); a bin
keeps its smallest offer. In the second half of the rounds all elements offer
to one bin, a different one each round, so that every bin is filled for sure,
also by a set of one element. Small sets take more rounds, large ones few.

Sketches are cut into bands; documents that agree in a band are in one bucket.
Buckets are not expanded into pairs: every member is verified against one
leader of its bucket, links are merged into components, and further turns with
other leaders concern only members that are not yet in their leader's
component. Members of buckets that the leaders leave in several components meet
by their rarest shingles, in an order and up to a rank that no link can escape.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from hourloom.llm.common import lower_words, mix
from hourloom.session import materialise

SIZE = 4
BANDS = 42
ROWS = 5
#: Turns of leaders before the members of buckets of several components meet by their rarest shingles.
LEADERS = 3

#: Places of rows are smaller: they choose leaders under a mask.
PLACES = 1 << 62

SKETCHES = pa.schema(
    [
        ("id", pa.int64()),
        ("row", pa.int64()),
        ("key", pa.int64()),
        ("digest", pa.binary()),
        ("n_shingles", pa.int64()),
        ("bands", pa.list_(pa.int64())),
    ]
)
SKETCHES_DDL = "id long, row long, key long, digest binary, n_shingles long, bands array<long>"
SETS = pa.schema([("doc", pa.int64()), ("elements", pa.binary())])
OVERLAPS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sizes", pa.int64()), ("shared", pa.int64())])
OVERLAPS_DDL = "a long, b long, sizes long, shared long"


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; of fewer words, the whole sequence."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(ids) - size + 1 + i])
    return np.unique(out)


def sketch(elements: np.ndarray, bins: int) -> np.ndarray:
    """The sketch of a non-empty set as integers: the round in the upper bits, the offer below."""
    values = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    at_once = max(1, 4 * bins // len(elements))
    for first in range(0, 2 * bins, at_once):
        rounds = np.arange(first, min(2 * bins, first + at_once), dtype=np.uint64)[:, None]
        hashed = mix(elements[None, :] + (rounds + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
        # Upper 32 bits choose the bin, the offer holds 40 bits that the bin leaves free.
        chosen = ((hashed >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        chosen = np.where(rounds < bins, chosen, rounds - np.uint64(bins)).astype(np.int64).ravel()
        offers = ((rounds << np.uint64(40)) | (mix(hashed) >> np.uint64(24))).ravel()
        np.minimum.at(values, chosen, offers)
        if (values != np.iinfo(np.uint64).max).all():
            break
    return values


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in values.reshape(bands, rows).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def set_digest(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def _sketcher(size: int, bands: int, rows: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            digests, counts, keys = [], [], []
            for text in part.column("text"):
                elements = shingle_set(text.as_py(), size)
                counts.append(len(elements))
                digests.append(set_digest(elements) if len(elements) else None)
                keys.append(band_keys(sketch(elements, bands * rows), bands, rows) if len(elements) else None)
            columns = zip((digests, counts, keys), list(SKETCHES)[3:])
            same = [part.column(c) for c in ("id", "row", "key")]
            yield pa.record_batch([*same, *[pa.array(c, f.type) for c, f in columns]], schema=SKETCHES)

    return run


def _sets(size: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated rows come to one task
        for part in parts:
            docs, sets = [], []
            for doc, digest, text in zip(part.column("doc").to_pylist(), part.column("digest").to_pylist(), part.column("text")):
                if doc in seen:
                    continue
                elements = shingle_set(text.as_py(), size)
                if set_digest(elements) == digest:  # else a text whose key is the same by chance
                    seen.add(doc)
                    docs.append(doc)
                    sets.append(elements.tobytes())
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(sets, pa.binary())], schema=SETS)

    return run


def _overlaps(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        sizes, shared = [], []
        for a, b in zip(part.column("left"), part.column("right")):
            both = np.frombuffer(a.as_py() + b.as_py(), np.uint64).copy()
            both.sort(kind="stable")  # two sorted runs
            sizes.append(len(both))
            shared.append(int((both[1:] == both[:-1]).sum()))
        yield pa.record_batch(
            [part.column("a"), part.column("b"), pa.array(sizes, pa.int64()), pa.array(shared, pa.int64())],
            schema=OVERLAPS,
        )


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact intersection (shared) and sum of sizes of each pair (a, b) of documents.

    A leader's set is sent to all of its members; hot leaders are left to the
    optimizer's split of skewed joins.
    """
    left = sets.select(F.col("doc").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("doc").alias("b"), F.col("elements").alias("right"))
    rows = pairs.select("a", "b").join(right, "b").join(left, "a")
    return rows.select("a", "b", "left", "right").mapInArrow(_overlaps, OVERLAPS_DDL)


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Smallest reachable label: ``labels`` (doc, component) merged along ``edges`` (a, b).

    Labels, not documents, are merged. In each round every label hooks to the
    smallest one beside it and follows two more hooks from there; edges move
    along and those within one label go. The smallest label of a component
    never moves, so in the end all others have come to it.
    """
    one = labels.withColumnRenamed("doc", "a").withColumnRenamed("component", "u")
    two = labels.withColumnRenamed("doc", "b").withColumnRenamed("component", "v")
    links = materialise(edges.select("a", "b").join(one, "a").join(two, "b").where("u <> v").select("u", "v").distinct())
    moved = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("node"), F.least("u", "low").alias("up"))
        hooks = materialise(hooks)
        further = hooks.select(F.col("node").alias("up"), F.col("up").alias("next"))
        step = hooks
        for _ in range(2):
            step = step.join(further, "up").select("node", F.col("next").alias("up"))
        step = materialise(step)
        a, b = (step.select(F.col("node").alias(x), F.col("up").alias(y)) for x, y in (("u", "x"), ("v", "y")))
        links = links.join(a, "u").join(b, "v").where("x <> y").select(F.col("x").alias("u"), F.col("y").alias("v"))
        links = materialise(links.distinct())
        if moved is None:
            moved = step
        else:
            later = step.select(F.col("node").alias("up"), F.col("up").alias("next"))
            moved = moved.join(later, "up", "left").select("node", F.coalesce("next", "up").alias("up"))
    if moved is None:
        return labels
    roots = moved.select(F.col("node").alias("component"), F.col("up").alias("root"))
    return labels.join(roots, "component", "left").select("doc", F.coalesce("root", "component").alias("component"))


def _leaders(members: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each member with its bucket's leader, where their components differ."""
    placed = members.join(labels, "doc")
    # The leader is the member whose number is smallest under a mask: another one each turn.
    masked = F.col("doc").bitwiseXOR(F.lit(turn * 0x5DEECE66D1234567 & (PLACES - 1)))
    leaders = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min(masked).alias("first")
    )
    leaders = leaders.where("low <> high").select(
        "key", F.col("first").bitwiseXOR(F.lit(turn * 0x5DEECE66D1234567 & (PLACES - 1))).alias("leader")
    )
    pairs = placed.join(leaders, "key").where("doc <> leader").select("doc", "component", "leader").distinct()
    of = labels.select(F.col("doc").alias("leader"), F.col("component").alias("of"))
    return pairs.join(of, "leader").where("component <> of").select(F.col("leader").alias("a"), F.col("doc").alias("b"))


def _elements(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        columns = zip(*(part.column(c).to_pylist() for c in ("doc", "component", "elements")))
        for doc, component, elements in columns:
            own, name = np.frombuffer(elements, np.int64), xxhash.xxh64_intdigest(elements) >> 1
            for at in range(0, len(own), 1 << 16):
                some = own[at : at + (1 << 16)]
                n = len(some)
                rows = ([doc] * n, [component] * n, [name] * n, [len(own)] * n, some)
                yield pa.record_batch(
                    [pa.array(c, pa.int64()) for c in rows], names=["doc", "component", "own", "n", "element"]
                )


def _apart(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that may be linked among the members of buckets that still hold several components.

    In any fixed order of the elements, two similar sets share an element early
    in both; in the order from rare to frequent few others do. Each set gives
    its first elements, and a pair is made only where enough elements follow in
    both sets for a link: members of one bucket below the threshold mostly
    differ in more of their rare elements than that.
    """
    placed = members.join(labels, "doc")
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    left = placed.join(mixed.select("key"), "key").select("doc", "component").distinct()
    rows = sets.join(left, "doc").mapInArrow(_elements, "doc long, component long, own long, n long, element long")
    rows = materialise(rows)
    counts = rows.groupBy("element").agg(
        F.count(F.lit(1)).alias("held"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    counts = materialise(counts.where("held > 1").select("element", "held", (F.col("low") != F.col("high")).alias("mixed")))
    ranked = rows.join(counts, "element", "left").withColumn(
        "follow",
        F.col("n")
        + 1
        - F.row_number().over(Window.partitionBy("doc", "own").orderBy(F.coalesce("held", F.lit(1)), "element")),
    )
    early = ranked.where("mixed").where(100 * F.col("follow") >= percent * F.col("n")).select("element", "doc", "component", "n", "follow")
    early = materialise(early)
    shorter = early.where((100 + percent) * F.col("follow") >= 2 * percent * F.col("n"))
    longer = early.select("element", *[F.col(c).alias(f"{c}_") for c in ("doc", "component", "n", "follow")])
    enough = (100 + percent) * F.least("follow", "follow_") >= percent * (F.col("n") + F.col("n_"))
    ordered = (F.col("n") < F.col("n_")) | ((F.col("n") == F.col("n_")) & (F.col("doc") < F.col("doc_")))
    pairs = shorter.join(longer, "element").where(enough & ordered & (F.col("component") != F.col("component_")))
    return pairs.select(F.col("doc").alias("a"), F.col("doc_").alias("b"))


def near_duplicate_rows(
    docs: DataFrame,
    row: Column,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    leaders: int = LEADERS,
) -> DataFrame:
    """(id, row, n_shingles, component, component_id) of every input row.

    ``row`` is carried along. Two documents are linked if 100 * |intersection|
    >= ``percent`` * |union| of their full shingle sets. A node is a distinct
    set, named by the place of one of its rows: ids decide nothing but
    ``component_id``, the smallest one in the component. Rows without shingles
    have no component.
    """
    source = docs.select(F.col(id_column).cast("long").alias("id"), row.cast("long").alias("row"), F.col(text).alias("text"))
    source = source.withColumn("key", F.xxhash64("id", "text"))
    sketches = source.select("id", "row", "key", "text").mapInArrow(_sketcher(size, bands, rows), SKETCHES_DDL)
    sketches = materialise(sketches.withColumn("place", F.monotonically_increasing_id()))
    nodes = sketches.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("place", "key")).alias("first"), F.min("id").alias("id")
    )
    nodes = materialise(nodes.select("digest", F.col("first.place").alias("doc"), "first.key", "id"))
    # Copies leave here: only the first row of each set goes into buckets.
    first = sketches.select(F.col("place").alias("doc"), "bands").join(nodes.select("doc").hint("shuffle_hash"), "doc")
    keys = first.select("doc", F.explode("bands").alias("key"))
    crowded = keys.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low <> high")
    members = materialise(keys.join(crowded.select("key"), "key").distinct())

    involved = materialise(members.select("doc").distinct())
    wanted = nodes.select("doc", "digest", "key").join(involved, "doc")
    texts = source.select("key", "text").join(wanted.hint("shuffle_hash"), "key").select("doc", "digest", "text")
    sets = materialise(texts.mapInArrow(_sets(size), "doc long, elements binary"))
    labels = involved.select("doc", F.col("doc").alias("component"))
    similar = F.col("shared") * (100 + percent) >= F.col("sizes") * percent
    for turn in range(leaders + 1):
        pairs = _leaders(members, labels, turn) if turn < leaders else _apart(members, labels, sets, percent)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = materialise(compare(pairs, sets).where(similar).select("a", "b"))
        labels = materialise(components(links, labels))

    placed = nodes.join(labels, "doc", "left").select("digest", "id", F.coalesce("component", "doc").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    verdicts = materialise(placed.drop("id").join(smallest, "component"))
    done = sketches.join(verdicts, "digest", "left")
    return done.select("id", "row", "n_shingles", "component", "component_id")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = 80, leaders: int = LEADERS
) -> DataFrame:
    """Return doc_id, n_shingles, component_id and kept, one row per input row.

    42 bands of 5 rows miss a pair at 0.8 with probability (1 - 0.8^5)^42 < 6e-8.
    Documents with equal sets are one node; rows of one id with different texts
    are not, unless linked. Missing, empty and blank texts have no shingles and
    are linked with nothing. A missing id is never the smallest one; a component
    without any id has none, and all of its rows are kept. Repeated rows are
    copies of each other and all kept or all dropped. Any 64-bit id will do.
    Empty tables give an empty result.
    """
    done = near_duplicate_rows(docs, F.lit(0), id_column, text, size, percent, leaders=leaders)
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return done.select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )

"""Exact Jaccard join of shingle sets by a partition of the universe.

Two linked sets differ in at most H elements, H given by their sizes. Sets are
taken in bands of sizes; each band cuts the universe of shingle hashes into m
segments, m > H. Allocate 0, 1 or 2 to every segment so that the sum exceeds H:
then some segment of two linked sets has fewer differences than its allocation,
that is, equal subsets (1), or subsets equal but for one element (2), which meet
by their one-deletion neighbours. A set is indexed in its own band and probes
this one and the next smaller one, where the sizes of its partners are.

First all sets list the subsets of their segments. Blocks send them, by ranges
of hashes, to where lists meet; only subsets that another set indexes come back,
with the length of their list. That is the cost of an allocation: each set drops
as many of its longest lists as the sum allows, most sets all of them.

What is left are lists of sets that look alike. They are not expanded into
pairs: in a few turns, each list's members are compared with one leader and
linked sets become one component. Sets of lists that still hold several
components are allocated anew, now with the one-deletion neighbours of every
segment, and only lists of other components cost anything. Probes and index
entries of the lists that it leaves are compared by bits of parity, which differ
in at most as many places as the sets in elements; long lists are dealt over
tasks. Every pair that remains is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from hourloom.llm.common import mix, pack, pack_sorted, unpack, unpack_sorted
from hourloom.llm.near_dups import compare, components, shingle_set
from hourloom.operators.lookup import lookup
from hourloom.session import materialise, settled

SIZE, PERCENT = 5, 80
#: Turns of leaders before the second allocation.
LEADERS = 3
#: Segments beyond the least number, as a share: a set may lack so many without one-deletion neighbours.
SPARE = 0.15
#: Segments of each band whose one-deletion neighbours are indexed from the start, for sets with many empty segments.
NEIGHBOURS = 8
#: Subsets of one block of documents.
BLOCK_KEYS = 2_000_000

#: Probes, and index entries, of a list that one task compares.
DEAL = 2_048

#: Places of parity an element, in sets of up to SMALL elements and in larger ones: fewer tell sets apart less sharply.
SMALL, BITS_OF_SMALL, BITS_OF_LARGE = 256, 8, 2

#: Kinds of entries in a list.
BOTH, PROBE, INDEX = 0, 1, 2

MESSAGE = pa.schema(
    [
        ("part", pa.int32()),
        ("keys", pa.binary()),
        ("nodes", pa.binary()),
        *[(c, pa.list_(pa.int64())) for c in ("ids", "rows", "own", "sizes", "spare", "spare_below")],
    ]
)
MESSAGE_DDL = (
    "part int, keys binary, nodes binary, ids array<long>, rows array<long>, own array<long>, sizes array<long>, "
    "spare array<long>, spare_below array<long>"
)
ENTRY = pa.schema(
    [("node", pa.int64()), ("list", pa.int64()), ("kind", pa.int8()), ("cost", pa.int64())]
    + [(c, pa.int64()) for c in ("id", "row", "n", "spare", "spare_below")]
)
ENTRY_DDL = "node long, list long, kind byte, cost long, id long, row long, n long, spare long, spare_below long"
SETS = pa.schema([("doc", pa.int64()), ("elements", pa.binary())])
SLOTS_DDL = "node long, component long, n long, band int, segment int, kind byte, list long"
CHOSEN = pa.schema([("node", pa.int64()), ("component", pa.int64()), ("n", pa.int64()), ("list", pa.int64())])
CHOSEN_DDL = "node long, component long, n long, list long"


# Bands and segments


class Bands:
    """Bands of sizes and the number of segments of each, for a similarity in percent."""

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("the similarity must be above 0 and at most 100 percent")
        self.percent = percent
        lows = [1]
        while lows[-1] < 1 << 40:
            lows.append(max(lows[-1] + 1, lows[-1] * 21 // 20, lows[-1] * 100 // percent))
        self.lows = np.array(lows, np.int64)

    def differences(self, total: int) -> int:
        """The most elements in which linked sets of ``total`` elements together differ."""
        return (100 - self.percent) * total // (100 + self.percent)

    def band(self, n: int) -> int:
        return int(np.searchsorted(self.lows, n, "right")) - 1

    def segments(self, band: int) -> int:
        high = int(self.lows[band + 1]) - 1
        least = self.differences(high + high * 100 // self.percent) + 1
        return least + int(SPARE * least) + (least > 1)

    def needed(self, n: int, band: int) -> int:
        """The sum of allocations that a set of ``n`` elements needs to find all its partners of a band, none larger."""
        return self.differences(n + min(n, int(self.lows[band + 1]) - 1)) + 1

    def probed(self, n: int) -> list[int]:
        """The own band, and the one below if a partner may be there."""
        own = self.band(n)
        least = -(-n * self.percent // 100)
        return [b for b in range(self.band(least), own)][::-1] + [own] if own else [own]


def list_names(sums: np.ndarray, segments: np.ndarray, band: int, neighbours: bool = False) -> np.ndarray:
    """The names of lists: of a subset's sum of hashes, its segment and band; those of one-deletion neighbours are apart."""
    place = segments.astype(np.uint64) + np.uint64(band << 40) + np.uint64(int(neighbours) << 60)
    return mix(sums + mix(place + np.uint64(0x9E3779B97F4A7C15)))


def subsets(elements: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sum of hashes of every segment, 0 for an empty one; each element's segment and hash; the segments that hold any."""
    segment = (((elements >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    hashes = mix(elements ^ np.uint64(0xD1B54A32D192ED03))
    sums = np.zeros(m, np.uint64)
    sums[segment[first]] = np.add.reduceat(hashes, first)
    return sums, segment, hashes, segment[first]


def first_entries(elements: np.ndarray, bands: Bands) -> tuple[np.ndarray, int, int]:
    """Names of lists with the kind in the lowest two bits, and how many lists a set may drop, in its own band and below.

    A set without enough filled segments adds the one-deletion neighbours of
    the first segments, and if that is still not enough its empty segments; it
    drops nothing (-1).
    """
    n = len(elements)
    out, spare = [], [0, 0]

    def add(names: np.ndarray, kind: int) -> None:
        out.append((names >> np.uint64(16) << np.uint64(2)) | np.uint64(kind))

    for band in bands.probed(n):
        own = band == bands.band(n)
        m = bands.segments(band)
        sums, segment, hashes, filled = subsets(elements, m)
        near = segment < NEIGHBOURS
        less = sums[segment[near]] - hashes[near]
        add(list_names(sums[filled], filled, band), BOTH if own else PROBE)
        empty = np.flatnonzero(np.bincount(filled, minlength=m) == 0)
        if own:
            add(list_names(less, segment[near], band, True), INDEX)
            add(list_names(sums[empty], empty, band), INDEX)
        needed = bands.needed(n, band)
        spare[not own] = len(filled) - needed
        if len(filled) < needed:
            spare[not own] = -1
            few = filled[filled < NEIGHBOURS]
            add(list_names(sums[few], few, band, True), PROBE)
            add(list_names(less, segment[near], band), PROBE)
            if len(filled) + len(few) < needed:
                add(list_names(sums[empty], empty, band), PROBE)
    return np.concatenate(out), *spare


def set_name(elements: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)


# First allocation


def _block(entries: list[np.ndarray], nodes: list[int], parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    keys = np.concatenate(entries)
    owner = np.repeat(np.array(nodes, np.int64), [len(e) for e in entries])
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    # Copies within a block list their subsets once.
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])
    keys, owner = keys[new], owner[new]
    # Parts are ranges of the 48 bits of a name.
    cuts = np.searchsorted(keys >> np.uint64(2), (np.arange(1, parts, dtype=np.uint64) << np.uint64(48)) // np.uint64(parts))
    for part, (k, o) in enumerate(zip(np.split(keys, cuts), np.split(owner, cuts))):
        if len(k):
            yield part, pack_sorted(k), pack(o)


def _listing(size: int, percent: int, parts: int, block_keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, number = Bands(percent), TaskContext.get().partitionId()
        entries, nodes, total = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for part, keys, owner in _block(entries, nodes, parts):
                yield pa.record_batch([pa.array([v], f.type) for v, f in zip([part, keys, owner, *[None] * 6], MESSAGE)], schema=MESSAGE)

        for batch in batches:
            own, sizes, spares = [], [], ([], [])
            for text in batch.column("text"):
                elements = shingle_set(text.as_py(), size)
                sizes.append(len(elements))
                own.append(set_name(elements) if len(elements) else None)
                if len(elements):
                    some, *left = first_entries(elements, bands)
                    entries.append(some)
                    nodes.append(own[-1])
                    total += len(some)
                for column, value in zip(spares, left if len(elements) else (0, 0)):
                    column.append(value)
                if total >= block_keys:
                    yield from flush()
                    entries, nodes, total = [], [], 0
            # What is to be known of the documents goes along, to any part.
            values = [number % parts, None, None, batch.column("id").to_pylist(), batch.column("row").to_pylist(), own, sizes, *spares]
            yield pa.record_batch([pa.array([v], f.type) for v, f in zip(values, MESSAGE)], schema=MESSAGE)
        if entries:
            yield from flush()

    return run


def _meeting(table: pa.Table) -> pa.Table:
    """The lists of a part that a probe finds another set in, entry by entry, and the documents' own rows."""
    keys, nodes, out = [], [], []
    for r in table.to_pylist():
        if r["keys"] is not None:
            keys.append(unpack_sorted(r["keys"]))
            nodes.append(unpack(r["nodes"], np.int64))
            continue
        known = [r["own"], *[[None] * len(r["own"])] * 3, *[r[c] for c in ("ids", "rows", "sizes", "spare", "spare_below")]]
        out.append(pa.table([pa.array(c, f.type) for c, f in zip(known, ENTRY)], schema=ENTRY))
    if keys:
        keys, nodes = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])
        keys, nodes = keys[new], nodes[new]
        names, kinds = keys >> np.uint64(2), (keys & np.uint64(3)).astype(np.int8)
        first = np.concatenate([[True], names[1:] != names[:-1]])
        group = np.cumsum(first) - 1
        size = int(group[-1]) + 1
        indexed = np.bincount(group[kinds != PROBE], minlength=size)
        probing = np.bincount(group[kinds != INDEX], minlength=size)
        # A set that is alone in a list, as index and probe, finds nobody.
        several = np.zeros(size, bool)
        several[group[1:][(group[1:] == group[:-1]) & (nodes[1:] != nodes[:-1])]] = True
        # Entries of one list are sorted by kind and then node; unequal neighbours show that several sets are there.
        alive = (several & (indexed > 0) & (probing > 0))[group]
        group, kinds = group[alive], kinds[alive]
        n = len(group)
        cost = indexed[group] - (kinds == BOTH)
        columns = [nodes[alive], names[alive].astype(np.int64), kinds, cost, *[pa.nulls(n, pa.int64())] * 5]
        out.append(pa.table([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, ENTRY)], schema=ENTRY))
    return pa.concat_tables(out) if out else ENTRY.empty_table()


def first_allocation(entries: DataFrame, members: DataFrame) -> DataFrame:
    """(list, doc, probes): the lists in which some set still probes, with all their index entries."""
    nodes = members.where("node IS NOT NULL").groupBy("node").agg(F.max("spare").alias("spare"), F.max("spare_below").alias("spare_below"))
    probes = entries.where(F.col("kind") != INDEX).join(nodes, "node")
    # A set without enough filled segments in either band keeps all of its probes, of which that band may have both kinds.
    dropped = F.when(F.col("kind") == BOTH, F.col("spare")).otherwise(F.when(F.col("spare") >= 0, F.col("spare_below")))
    may_drop = F.greatest(F.coalesce(dropped, F.lit(0)), F.lit(0))
    # The longest lists go first, as many as the set can do without: of a set's own entries only.
    longest = F.row_number().over(Window.partitionBy("node", "kind").orderBy(F.desc("cost"), "list"))
    kept = probes.withColumn("place", longest).where((F.col("place") > may_drop) & (F.col("cost") > 0))
    kept = materialise(kept.select("list", F.col("node").alias("doc")))
    alive = kept.select("list").distinct()
    index = entries.where(F.col("kind") != PROBE).join(alive, "list").select("list", F.col("node").alias("doc"))
    both = kept.withColumn("probes", F.lit(True)).unionByName(index.withColumn("probes", F.lit(False)))
    return materialise(both.groupBy("list", "doc").agg(F.max("probes").alias("probes")))


# Components by leaders


def _sets(size: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [shingle_set(t.as_py(), size) for t in part.column("text")]
            docs = pa.array([set_name(e) for e in found], pa.int64())
            yield pa.record_batch([docs, pa.array([e.tobytes() for e in found], pa.binary())], schema=SETS)

    return run


def led_pairs(members: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of every probe and index entry of a list with the list's leader, where their components differ."""
    placed = members.join(labels, "doc")
    masked = F.xxhash64("doc", F.lit(turn))  # another leader each turn
    lists = placed.groupBy("list").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min(F.struct(masked, "doc", "component")).alias("first")
    )
    lists = lists.where("low <> high").select("list", F.col("first.doc").alias("a"), F.col("first.component").alias("of"))
    return placed.join(lists, "list").where("component <> of").select("a", F.col("doc").alias("b")).distinct()


# Second allocation


def _slots(percent: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for part in parts:
            for doc, component, blob in zip(*(part.column(c).to_pylist() for c in ("doc", "component", "elements"))):
                elements = np.frombuffer(blob, np.uint64)
                n = len(elements)
                for band in bands.probed(n):
                    m = bands.segments(band)
                    sums, segment, hashes, _ = subsets(elements, m)
                    less, every = sums[segment] - hashes, np.arange(m)
                    # Kinds: 0 and 1 are indexed, 2 probes equal subsets, 3 and 4 those with one element more or less.
                    slots = [
                        (2, every, list_names(sums, every, band)),
                        (3, every, list_names(sums, every, band, True)),
                        (4, segment, list_names(less, segment, band)),
                    ]
                    if band == bands.band(n):
                        slots += [(0, *slots[0][1:]), (1, segment, list_names(less, segment, band, True))]
                    kind = np.concatenate([np.full(len(s), k, np.int8) for k, s, _ in slots])
                    places = np.concatenate([s for _, s, _ in slots]).astype(np.int32)
                    names = np.concatenate([x for _, _, x in slots]).view(np.int64)
                    size = len(kind)
                    columns = [
                        pa.array(np.full(size, doc)), pa.array(np.full(size, component)), pa.array(np.full(size, n)),
                        pa.array(np.full(size, band, np.int32)), pa.array(places), pa.array(kind), pa.array(names),
                    ]
                    yield pa.record_batch(columns, names=[c.split()[0] for c in SLOTS_DDL.split(", ")])

    return run


def allocate(equal: np.ndarray, near: np.ndarray, needed: int) -> np.ndarray:
    """Allocations 0, 1 or 2 of segments whose sum reaches ``needed`` at a low cost.

    ``equal`` is the cost of 1, ``near`` the cost of 2 for each segment.
    """
    # Steps by cost for one more: both steps at once where the second is cheaper than the first.
    together = near - equal < equal
    segments = np.arange(len(equal))
    steps = np.concatenate([np.where(together, near / 2, equal), np.where(together, near / 2, near - equal)])
    which = np.concatenate([segments, segments])
    order = np.argsort(steps, kind="stable")[:needed]
    out = np.bincount(which[order], minlength=len(equal))
    return np.where(together & (out == 1), 2, out)


def _allocation(percent: int):
    def run(table: pa.Table) -> pa.Table:
        bands = Bands(percent)
        node, component, n = (table.column(c)[0].as_py() for c in ("node", "component", "n"))
        band, segment, kind, cost, names = (table.column(c).to_numpy() for c in ("band", "segment", "kind", "cost", "list"))
        chosen = np.zeros(len(kind), bool)
        for b in np.unique(band):
            here = np.flatnonzero(band == b)
            m = bands.segments(int(b))
            equal = np.bincount(segment[here], np.where(kind[here] == 2, cost[here], 0), m)
            near = np.bincount(segment[here], cost[here], m)
            given = allocate(equal, near, bands.needed(n, int(b)))[segment[here]]
            chosen[here] = np.where(kind[here] == 2, given > 0, given > 1)
        lists = np.unique(names[chosen])
        size = len(lists)
        columns = [np.full(size, node), np.full(size, component), np.full(size, n), lists]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, CHOSEN)], schema=CHOSEN)

    return run


def parity_bits(elements: np.ndarray) -> bytes:
    """How often, modulo 2, elements fall on each of 2^k places, two or more an element, eight of a small set.

    Two sets' bits differ in at most as many places as the sets in elements.
    """
    places = BITS_OF_SMALL if len(elements) <= SMALL else BITS_OF_LARGE
    size = max(64, 1 << int(places * len(elements) - 1).bit_length())
    counts = np.bincount((mix(elements) & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _with_bits(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        found = [parity_bits(np.frombuffer(e, np.uint64)) for e in part.column("elements").to_pylist()]
        yield pa.record_batch([part.column("doc"), pa.array(found, pa.binary())], names=["doc", "bits"])


def folded(blobs: list[bytes]) -> np.ndarray:
    """Bits of all sets over as many places as the smallest has: halves are added up modulo 2."""
    least = min(map(len, blobs))
    out = np.empty((len(blobs), least // 8), np.uint64)
    for i, blob in enumerate(blobs):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(blob, np.uint64).reshape(-1, least // 8), axis=0)
    return out


def _unlike(group: list[tuple], percent: int) -> tuple[list[int], list[int]]:
    """Pairs of a probe and an index entry of other components whose sizes and bits allow a link."""
    probes, index = [g for g in group if g[2]], [g for g in group if not g[2]]
    if not probes or not index:
        return [], []
    bits = folded([g[5] for g in (*probes, *index)])
    others = np.array([g[0] for g in index]), np.array([g[1] for g in index]), np.array([g[3] for g in index])
    a, b = [], []
    for i, (doc, component, _, n, *_) in enumerate(probes):
        rest = np.flatnonzero((others[1] != component) & (others[2] <= n) & (100 * others[2] >= percent * n))
        apart = np.bitwise_count(bits[len(probes) + rest] ^ bits[i]).sum(axis=1, dtype=np.int64)
        rest = rest[(100 + percent) * apart <= (100 - percent) * (others[2][rest] + n)]
        a.extend([doc] * len(rest))
        b.extend(others[0][rest].tolist())
    return a, b


def _listed_pairs(percent: int):
    """Pairs of each list, whose rows follow one another."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group = None, []

        def pairs() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, pa.int64()) for c in _unlike(group, percent)], names=["a", "b"])

        for part in parts:
            columns = (part.column(c).to_pylist() for c in ("list", "of_probes", "of_index", "doc", "component", "probes", "n", "place", "bits"))
            for *name, doc, component, probes, n, place, bits in zip(*columns):
                if name != current:
                    if group:
                        yield pairs()
                    current, group = name, []
                group.append((doc, component, probes, n, place, bits))
        if group:
            yield pairs()

    return run


def list_pairs(rows: DataFrame, percent: int, deal: int = DEAL) -> DataFrame:
    """Pairs (a, b) of (list, doc, component, n, probes, bits): each probe with the index entries of its list.

    A long list is dealt by probes and by index entries, each part of one with
    each part of the other, so that no task holds more than a few thousand of
    them; sets are compared by their bits, and only pairs that may be linked
    leave the task.
    """
    parts = lambda c: F.greatest(F.ceil(c / deal), F.lit(1)).cast("int")
    lists = rows.groupBy("list").agg(F.count_if("probes").alias("p"), F.count_if(~F.col("probes")).alias("i"))
    lists = lists.where("p > 0 AND i > 0").select("list", parts(F.col("p")).alias("p"), parts(F.col("i")).alias("i"))
    placed = rows.join(lists, "list").withColumn("place", F.abs(F.xxhash64("doc") % 1_000_003))
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    own = lambda c: F.array((F.col("place") % F.col(c)).cast("int"))
    dealt = placed.withColumn("of_probes", F.explode(F.when(F.col("probes"), own("p")).otherwise(every("p"))))
    dealt = dealt.withColumn("of_index", F.explode(F.when(F.col("probes"), every("i")).otherwise(own("i"))))
    group = ["list", "of_probes", "of_index"]
    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(_listed_pairs(percent), "a long, b long")


def second_pairs(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that may be linked among the members of lists that still hold several components."""
    placed = members.join(labels, "doc")
    mixed = placed.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    left = placed.join(mixed.select("list"), "list").select("doc", "component").distinct()
    alike = materialise(sets.join(left, "doc"))
    slots = materialise(alike.mapInArrow(_slots(percent), SLOTS_DDL))
    index = slots.where("kind < 2").select("list", F.col("node").alias("doc"), "component", "n")
    lists = index.groupBy("list").agg(F.count(F.lit(1)).alias("cost"), F.min("component").alias("low"), F.max("component").alias("high"))
    probes = slots.where("kind >= 2").join(lists, "list").where("low <> component OR high <> component")
    chosen = materialise(probes.drop("low", "high").groupBy("node").applyInArrow(_allocation(percent), CHOSEN_DDL))
    probing = chosen.select("list", F.col("node").alias("doc"), "component", "n", F.lit(True).alias("probes"))
    found = index.join(chosen.select("list").distinct(), "list", "left_semi").withColumn("probes", F.lit(False))
    rows = materialise(probing.unionByName(found))
    bits = alike.select("doc", "elements").mapInArrow(_with_bits, "doc long, bits binary")
    return list_pairs(rows.join(bits, "doc"), percent)


# The join


def jaccard_join(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    percent: int = PERCENT,
    leaders: int = LEADERS,
    block_keys: int = BLOCK_KEYS,
) -> DataFrame:
    """Return doc_id, n_shingles and component_id, one row per input row.

    Documents whose sets of shingles of ``size`` words have 100 * |intersection|
    >= ``percent`` * |union| are linked; a component's id is the smallest
    document id in it. Documents with equal sets are one node, named by 64 bits.
    Rows of one id with different texts are apart unless linked. Missing, empty
    and blank texts have no shingles, are linked with nothing and are components
    of their own. A missing id is never the smallest; a component of such
    documents alone has none. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    source = source.select("id", F.xxhash64("id", "text").alias("row"), "text")
    lists = source.mapInArrow(_listing(size, percent, parts, block_keys), MESSAGE_DDL)
    found = materialise(lists.groupBy("part").applyInArrow(_meeting, ENTRY_DDL))
    members = found.where("list IS NULL").select("id", "row", "node", "n", "spare", "spare_below")
    entries = found.where("list IS NOT NULL").select("node", "list", "kind", "cost")
    placed = first_allocation(entries, members)

    involved = materialise(placed.select("doc").distinct())
    labels = involved.select("doc", F.col("doc").alias("component"))
    first = members.join(involved.withColumnRenamed("doc", "node"), "node").groupBy("node").agg(F.min("row").alias("row"))
    texts = source.join(first.select("row").hint("shuffle_hash"), "row").dropDuplicates(["row"])
    sets = materialise(texts.select("text").mapInArrow(_sets(size), "doc long, elements binary"))
    similar = F.col("shared") * (100 + percent) >= F.col("sizes") * percent

    def merged(turn: int) -> DataFrame:
        pairs = led_pairs(placed, labels, turn) if turn < leaders else second_pairs(placed, labels, sets, percent)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return components(materialise(compare(pairs, sets).where(similar).select("a", "b")), labels)

    for turn in range(leaders + 1):
        labels = settled(lambda: merged(turn))  # noqa: B023 - called at once; what a turn writes goes with it

    nodes = members.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("low"))
    nodes = nodes.join(labels.withColumnRenamed("doc", "node"), "node", "left")
    nodes = nodes.select("node", "low", F.coalesce("component", "node").alias("component"))
    lowest = nodes.groupBy("component").agg(F.min("low").alias("component_id"))
    verdicts = nodes.join(lowest, "component").select("node", "component_id")
    # A text with a great many copies is one node of many rows.
    judged = lookup(members.select("id", "node", "n"), verdicts, ["node"])
    alone = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return judged.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), alone.alias("component_id"))

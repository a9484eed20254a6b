"""Language identification by sparse multinomial logistic regression.

Texts become TF-IDF weights of hashed character n-grams. The regression is
fitted by follow-the-regularised-leader with elastic-net penalties: shards of a
bounded sample run side by side from a common state, and the states are
averaged after each round. Every language of the training rows is learned: more
than fit one state are dealt over blocks, and each block is a regression of its
own languages and a class for sample rows of all others, against which its
languages' scores are measured. A temperature, fitted on sample rows that took
no part, calibrates the probabilities over the languages of all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hourloom.llm.common import fold
from hourloom.session import materialise

DIMENSIONS = 1 << 15
ORDERS = 3
#: Sample rows of each language, and languages that are trained and scored together.
ROWS_PER_LANGUAGE = 1_500
CLASSES = 64
SHARDS, ROUNDS = 8, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
CALIBRATION = 5  # every fifth sample row sets the temperature
#: Temperatures tried in one pass over the calibration rows, and passes, each between the neighbours of the best.
TEMPERATURES, PASSES = 33, 4
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"

FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of the whole lower-cased text and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint32(1)
    counts = np.zeros(DIMENSIONS, np.int64)
    for order in range(1, ORDERS + 1):
        if len(points) < order:
            break
        hashed = np.full(len(points) - order + 1, order, np.uint32)
        for i in range(order):
            hashed = (hashed ^ points[i : len(points) - order + 1 + i]) * FACTORS[i]
            hashed ^= hashed >> np.uint32(15)
        counts += np.bincount((hashed * FACTORS[3]) >> np.uint32(32 - 15), minlength=DIMENSIONS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weights_of(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, counts = grams(text)
    values = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt((values * values).sum())
    return at, values / norm if norm else values


def _frequencies(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros(DIMENSIONS, np.int64)
    for part in parts:
        for text in part.column("text"):
            found[grams(text.as_py() or "")[0]] += 1
    at = np.flatnonzero(found)
    yield pa.record_batch([pa.array(at, pa.int32()), pa.array(found[at], pa.int64())], names=["gram", "n"])


def inverse_frequencies(train: DataFrame) -> np.ndarray:
    """Smoothed idf of all training rows; the driver gets one number per dimension."""
    rows = train.select("text").mapInArrow(_frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    total = train.count()
    found = np.zeros(DIMENSIONS)
    for gram, n in rows.collect():
        found[gram] = n
    return np.log((1 + total) / (1 + found)) + 1


def _vectors(idf):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            both = [weights_of(t.as_py() or "", idf.value) for t in part.column("text")]
            at = pa.array([a.astype(np.int32).tobytes() for a, _ in both], pa.binary())
            values = pa.array([v.astype(np.float64).tobytes() for _, v in both], pa.binary())
            kept = [part.column(c) for c in ("label", "pick", "key")]
            yield pa.record_batch([*kept, at, values], names=["label", "pick", "key", "at", "weights"])

    return run


def leader_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The closed form of follow-the-regularised-leader with both penalties."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _shards(state, classes: int):
    """The state after the rows of each shard, one row per class; rows come sorted by shard."""

    def learn(z: np.ndarray, n: np.ndarray, label: int, at: np.ndarray, x: np.ndarray) -> None:
        zs, ns = z[:, at], n[:, at]
        w = leader_weights(zs, ns)
        error = softmax(w @ x)
        error[label] -= 1
        g = error[:, None] * x
        grown = ns + g * g
        z[:, at] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / ALPHA * w
        n[:, at] = grown

    def rows(shard: int, z: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([shard] * classes, pa.int32()), pa.array(range(classes), pa.int32())]
        columns += [pa.array([row.tobytes() for row in a], pa.binary()) for a in (z, n)]
        return pa.record_batch(columns, names=["shard", "label", "z", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for part in parts:
            for shard, label, at, x in zip(*(part.column(c) for c in ("shard", "label", "at", "weights"))):
                if current != shard.as_py():
                    if current is not None:
                        yield rows(current, z, n)
                    current = shard.as_py()
                    z, n = (a.copy() for a in state.value)
                learn(z, n, label.as_py(), np.frombuffer(at.as_py(), np.int32), np.frombuffer(x.as_py(), np.float64))
        if current is not None:
            yield rows(current, z, n)

    return run


def _averaged(table: pa.Table) -> pa.Table:
    table = table.sort_by("shard")
    mean = {c: np.mean([np.frombuffer(v.as_py(), np.float64) for v in table.column(c)], axis=0).tobytes() for c in ("z", "n")}
    return pa.table({"label": table.column("label")[:1], "z": [mean["z"]], "n": [mean["n"]]})


def trained(taught: DataFrame, classes: int) -> np.ndarray:
    """Weights of (classes, dimensions) from rows (label, pick, at, weights); the driver gets averaged states only."""
    sharded = taught.withColumn("shard", F.pmod(F.shiftright("pick", 8), F.lit(SHARDS)).cast("int"))
    sharded = sharded.select("shard", "label", "pick", "at", "weights")
    sharded = sharded.repartition(SHARDS, "shard").sortWithinPartitions("shard", "pick", "label", "at")
    state = (np.zeros((classes, DIMENSIONS)), np.zeros((classes, DIMENSIONS)))
    for _ in range(ROUNDS):
        shared = taught.sparkSession.sparkContext.broadcast(state)
        done = sharded.mapInArrow(_shards(shared, classes), "shard int, label int, z binary, n binary")
        done = sorted(done.groupBy("label").applyInArrow(_averaged, "label int, z binary, n binary").collect())
        if done:
            state = tuple(np.stack([np.frombuffer(r[c], np.float64) for r in done]) for c in ("z", "n"))
        shared.destroy()
    return leader_weights(*state)


def block_rows(taught: DataFrame, block: int, blocks: int, expected: list[int]) -> tuple[DataFrame, int]:
    """The rows that a block learns from, labelled by their place in it, and its classes.

    With several blocks the last class stands for all other languages, by about as many rows as the block has.
    """
    classes = len(expected[block::blocks])
    if blocks == 1:
        return taught, classes
    own = F.pmod("label", F.lit(blocks)) == block
    share = min(1.0, sum(expected[block::blocks]) / max(1, sum(expected) - sum(expected[block::blocks])))
    other = F.pmod(F.xxhash64("pick", F.lit(block)), F.lit(1 << 30)) < share * (1 << 30)
    place = F.when(own, F.floor(F.col("label") / blocks)).otherwise(classes).cast("int")
    return taught.where(own | other).withColumn("label", place), classes + 1


def scores_of(weights: np.ndarray, at: np.ndarray, x: np.ndarray, blocks: int) -> np.ndarray:
    """A score for each language of a block; with several blocks, what it has more than all others."""
    scores = weights[:, at] @ x
    return scores if blocks == 1 else scores[:-1] - scores[-1]


def _logits(parts: Iterator[pa.RecordBatch], weights, blocks: int) -> Iterator[pa.RecordBatch]:
    for part in parts:
        found = [
            scores_of(weights.value, np.frombuffer(a.as_py(), np.int32), np.frombuffer(v.as_py(), np.float64), blocks).tobytes()
            for a, v in zip(part.column("at"), part.column("weights"))
        ]
        yield pa.record_batch([part.column("key"), part.column("label"), pa.array(found, pa.binary())], names=["key", "label", "logits"])


def _judged(calibration: DataFrame, weights: list, blocks: int) -> DataFrame:
    """(label, logits) of every calibration row, the logits of all languages in the order of their labels."""
    parts = [
        calibration.select("key", "label", "at", "weights")
        .mapInArrow(lambda rows, w=w: _logits(rows, w, blocks), "key long, label int, logits binary")
        .withColumn("block", F.lit(b))
        for b, w in enumerate(weights)
    ]
    if blocks == 1:
        return parts[0].select("label", F.array("logits").alias("logits"))
    found = F.sort_array(F.collect_list(F.struct("block", "logits"))).alias("found")
    joined = reduce(DataFrame.unionAll, parts).groupBy("key", "label").agg(found)
    return joined.select("label", F.transform("found", lambda f: f["logits"]).alias("logits"))


def losses(logits: np.ndarray, label: int, temperatures: np.ndarray) -> np.ndarray:
    """The negative log-likelihood of a row's label at each temperature."""
    cooled = logits[None, :] / temperatures[:, None]
    top = cooled.max(axis=1)
    return np.log(np.exp(cooled - top[:, None]).sum(axis=1)) + top - cooled[:, label]


def _losses(temperatures: np.ndarray):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(temperatures))
        for part in parts:
            for label, blobs in zip(part.column("label").to_pylist(), part.column("logits").to_pylist()):
                scores = np.zeros(sum(map(len, blobs)) // 8)
                for block, blob in enumerate(blobs):
                    scores[block :: len(blobs)] = np.frombuffer(blob, np.float64)
                total += losses(scores, label, temperatures)
        yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["place", "loss"])

    return run


def temperature(judged: DataFrame) -> float:
    """The temperature of least loss over all rows of (label, logits); as many sums come to the driver as are tried at once."""
    low, high, best = np.log(0.02), np.log(20.0), 0.0
    for _ in range(PASSES):
        tried = np.linspace(low, high, TEMPERATURES)
        sums = judged.mapInArrow(_losses(np.exp(tried)), "place int, loss double").groupBy("place").agg(F.sum("loss").alias("loss"))
        found = {r["place"]: r["loss"] for r in sums.collect()}
        if not any(found.values()):
            return 1.0
        place = min(found, key=lambda p: (round(found[p], 6), p))
        best = tried[place]
        low, high = tried[max(0, place - 1)], tried[min(TEMPERATURES - 1, place + 1)]
    return float(f"{np.exp(best):.5g}")  # sums of losses depend on their order in the last places


def fit(train: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, classes: int = CLASSES):
    """(labels, idf, weights of each block as broadcasts, temperature) from rows (text, lang, key) with a language.

    ``key`` is a hash of id and text.

    Frequencies cover all rows; the regression sees ``rows_per_language`` rows
    of each language on average, picked by their keys: the same ones however
    the rows lie, and a repeated row once. Label i is in block i modulo the number
    of blocks. All sampled rows whose turn it is set the temperature.
    """
    spark = train.sparkSession
    counts = train.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    labels = [r["lang"] for r in counts]
    if not labels:
        return labels, np.zeros(DIMENSIONS), [spark.sparkContext.broadcast(np.zeros((0, DIMENSIONS)))], 1.0
    idf = inverse_frequencies(train)
    shared_idf = spark.sparkContext.broadcast(idf)
    known = spark.createDataFrame(
        [(r["lang"], i, min(1.0, rows_per_language / r["count"])) for i, r in enumerate(counts)], "lang string, label int, share double"
    )
    pick = F.xxhash64("key").bitwiseAND(F.lit((1 << 40) - 1))
    picked = train.withColumn("pick", pick).join(F.broadcast(known), "lang").where(F.col("pick") < F.col("share") * (1 << 40))
    vectors = picked.select("label", "pick", "key", "text").dropDuplicates(["label", "key"]).mapInArrow(
        _vectors(shared_idf), "label int, pick long, key long, at binary, weights binary"
    )
    # The first row of every language teaches, so that none is left to the calibration alone.
    first = F.min("key").over(Window.partitionBy("label"))
    vectors = materialise(vectors.withColumn("first", F.col("key") == first))
    turn = (F.pmod("pick", F.lit(CALIBRATION)) == 0) & ~F.col("first")
    blocks = -(-len(labels) // classes)
    expected = [min(r["count"], rows_per_language) for r in counts]
    weights = [
        spark.sparkContext.broadcast(trained(*block_rows(vectors.where(~turn), b, blocks, expected))) for b in range(blocks)
    ]
    judged = materialise(_judged(vectors.where(turn), weights, blocks))
    t = temperature(judged)
    return labels, idf, weights, t


def _predict(model, weights, block: int, blocks: int):
    """The best language of a block, its score ``top`` and the sum of exp(score - top)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, idf, t = model.value
        for part in parts:
            found = []
            for text in part.column("text"):
                text = text.as_py()
                if not labels or not text or not any(map(str.isalpha, text)):
                    found.append((-1, UNKNOWN, 0.0, 0.0))
                    continue
                scores = scores_of(weights.value, *weights_of(text, idf), blocks) / t
                label = int(scores.argmax()) * blocks + block
                found.append((label, labels[label], float(scores.max()), float(np.exp(scores - scores.max()).sum())))
            kinds = (pa.int32(), pa.string(), pa.float64(), pa.float64())
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.record_batch(
                [*(part.column(c) for c in ("key", "doc_id", "held_out")), *columns],
                names=["key", "doc_id", "held_out", "label", "lang_pred", "top", "total"],
            )

    return run


def identify_languages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = FOLDS,
    held_fold: int = HELD_OUT,
    rows_per_language: int = ROWS_PER_LANGUAGE,
    classes: int = CLASSES,
) -> DataFrame:
    """Return doc_id, held_out, lang_pred and score, one row per input row.

    Rows of the held-out fold and rows without a language teach nothing; every
    language of the others is learned, in blocks of at most ``classes``. Missing
    texts and texts without a letter are ``und`` with score 0, and so is every
    text if no row teaches. A missing id is in the fold of the empty id. Ties
    between languages go to the more frequent one. Scores do not depend on how
    the rows are partitioned but for the last digits of sums, and rows that repeat
    teach once.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (fold(id_column, folds) == held_fold).alias("held_out"),
        F.col(lang).cast("string").alias("lang"),
        F.col(text).alias("text"),
        F.monotonically_increasing_id().alias("key"),
    )
    known = rows.where("NOT held_out AND lang IS NOT NULL")
    train = known.select("text", "lang", F.xxhash64("doc_id", "text").alias("key"))
    labels, idf, weights, t = fit(train, rows_per_language, classes)
    model, blocks = docs.sparkSession.sparkContext.broadcast((labels, idf, t)), len(weights)
    rows = rows.select("key", "doc_id", "held_out", "text")
    if blocks > 1:
        rows = materialise(rows)  # read once for each block
    passes = [
        rows.mapInArrow(
            _predict(model, w, b, blocks),
            "key long, doc_id long, held_out boolean, label int, lang_pred string, top double, total double",
        )
        for b, w in enumerate(weights)
    ]
    found = passes[0]
    if blocks > 1:
        best = F.min(F.struct(-F.col("top"), "label", "lang_pred"))
        parts = F.collect_list(F.struct("top", "total"))
        found = reduce(DataFrame.unionAll, passes).groupBy("key", "doc_id", "held_out").agg(best.alias("best"), parts.alias("parts"))
        total = F.aggregate("parts", F.lit(0.0), lambda sum_, p: sum_ + p["total"] * F.exp(p["top"] + F.col("best.col1")))
        found = found.select("doc_id", "held_out", "best.lang_pred", total.alias("total"))
    score = F.when(F.col("total") > 0, 1 / F.col("total")).otherwise(0.0)
    return found.select("doc_id", "held_out", "lang_pred", score.alias("score"))

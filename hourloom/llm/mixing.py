"""Mixing sources to target weights by iterative proportional fitting.

Documents are measured once (tokens and topic) and summed to cells of (source,
language, topic). The cells' token weights are raked: scaled to the targets of
one margin after the other until all margins hold. Cells and margins stay
tables, written after every sweep; margins are sums that combine before the
shuffle. A cell's raked weight over its tokens, scaled to a budget, is how often a
token shall come: up to one it is the probability of the cell's documents, beyond
that all of them are drawn and each of their tokens weighs more than one.
"""

from __future__ import annotations

import warnings
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hourloom.llm.common import lower_words
from hourloom.operators.lookup import join_same
from hourloom.session import materialise

MARGINS = ("source", "lang", "topic")
TOPICS = 8
TOPIC_WORD_BYTES = 5
#: Targets are the shares of the tokens to this power: large groups weigh less, small ones more.
POWER = 0.8
SWEEPS = 200
TOLERANCE = 1e-6
SEED = 20_240_601

#: Bits of the number that decides whether a document is drawn.
DRAW_BITS = 52


def topic_of(words: list[bytes], topics: int = TOPICS) -> int:
    """The topic whose words are most frequent; words of five bytes or more are dealt to topics by crc32.

    Ties go to the smaller topic, texts without such words to topic 0.
    """
    votes = [0] * topics
    for word, n in Counter(words).items():
        if len(word) >= TOPIC_WORD_BYTES:
            votes[zlib.crc32(word) % topics] += n
    return votes.index(max(votes))


def _measure(topics: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words = [lower_words(t.as_py()) for t in part.column("text")]
            kept = {c: part.column(c) for c in part.schema.names if c != "text"}
            found = {
                "topic": pa.array([topic_of(w, topics) for w in words], pa.int32()),
                "n_tokens": pa.array([len(w) for w in words], pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(kept | found)

    return run


def measured(
    docs: DataFrame,
    row: Column,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topics: int = TOPICS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, row, source, lang, topic, n_tokens and the draw of every row, a number in [0, 1)."""
    draw = F.xxhash64(F.lit(seed), F.col(id_column), F.col(text)).bitwiseAND(F.lit((1 << DRAW_BITS) - 1)) / F.lit(float(1 << DRAW_BITS))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        row.cast("long").alias("row"),
        F.col(source).cast("string").alias("source"),
        F.col(lang).cast("string").alias("lang"),
        draw.alias("draw"),
        F.col(text).alias("text"),
    )
    return rows.mapInArrow(_measure(topics), "doc_id long, row long, source string, lang string, draw double, topic int, n_tokens long")


def tempered_targets(cells: DataFrame, margin: str, power: float = POWER) -> DataFrame:
    """(margin, target): the tokens of each value to a power, scaled to the tokens of the table."""
    shares = cells.groupBy(margin).agg(F.sum("weight").alias("share")).withColumn("share", F.pow("share", F.lit(power)))
    total = cells.agg(F.sum("weight")).first()[0] or 0.0
    powers = shares.agg(F.sum("share")).first()[0] or 1.0
    return shares.select(margin, (F.col("share") * F.lit(float(total)) / F.lit(float(powers))).alias("target"))


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, tolerance: float = TOLERANCE
) -> DataFrame:
    """Scale ``weight`` until the sums of every margin equal its targets; adds ``margin_error``.

    ``targets`` maps a margin to (margin, target). Values without a target keep
    their weight; a target whose cells have no weight cannot be met and is left.
    Ends when no factor of a sweep is further than ``tolerance`` from one, or
    when a whole sweep leaves all weights within a hundredth of it: the targets
    then contradict each other. ``margin_error`` is how far the margins of a
    cell are off at the end, as a share of their targets; a warning gives the
    largest if it is over the tolerance.
    """
    names = cells.columns
    for margin, target in targets.items():
        cells = join_same(cells, target.withColumnRenamed("target", f"_{margin}"), [margin], "left")
    cells = materialise(cells.withColumns({"_off": F.lit(0.0), "_before": F.col("weight")}))
    for _ in range(sweeps):
        cells = cells.withColumns({"_off": F.lit(0.0), "_before": F.col("weight")})
        for margin in targets:
            # Each step is written: it is read twice by the next one.
            sums = cells.groupBy(margin).agg(F.sum("weight").alias("_sum"))
            wanted = F.coalesce(F.col(f"_{margin}") / F.col("_sum"), F.lit(1.0))
            factor = F.when(F.col("_sum") > 0, wanted).otherwise(1.0)
            cells = join_same(cells, sums, [margin], "left").withColumn("_factor", factor)
            cells = cells.withColumns(
                {"weight": F.col("weight") * F.col("_factor"), "_off": F.greatest("_off", F.abs(F.col("_factor") - 1))}
            )
            cells = materialise(cells.drop("_sum", "_factor"))
        moved = F.when(F.col("_before") > 0, F.abs(F.col("weight") / F.col("_before") - 1)).otherwise(0.0)
        off, change = cells.agg(F.max("_off"), F.max(moved)).first()
        if off is None or off <= tolerance or change <= tolerance / 100:
            break
    cells = cells.select(*names).withColumn("margin_error", F.lit(0.0))
    worst = []
    for margin, target in targets.items():
        sums = cells.groupBy(margin).agg(F.sum("weight").alias("_sum"))
        gap = F.abs(F.coalesce("_sum", F.lit(0.0)) / F.col("target") - 1)
        error = join_same(target, sums, [margin], "left").select(margin, F.when(F.col("target") > 0, gap).otherwise(0.0).alias("_error"))
        error = materialise(error)
        worst.append(error.agg(F.lit(margin).alias("margin"), F.max("_error").alias("error")))
        cells = join_same(cells, error, [margin], "left")
        cells = cells.withColumn("margin_error", F.greatest("margin_error", F.coalesce("_error", F.lit(0.0)))).drop("_error")
        cells = materialise(cells)
    found = {r["margin"]: r["error"] or 0.0 for r in (reduce(DataFrame.unionAll, worst).collect() if worst else [])}
    if any(error > tolerance for error in found.values()):
        said = ", ".join(f"{margin} {error:.2g}" for margin, error in found.items())
        warnings.warn(f"margins are off their targets by a share of up to: {said}", stacklevel=2)
    return cells


def mix_sources(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    power: float = POWER,
    sweeps: int = SWEEPS,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    row: Column | None = None,
    budget: float | None = None,
) -> DataFrame:
    """Return doc_id, row, source, lang, topic, n_tokens, weight, probability, token_weight, margin_error and selected.

    One row per input row.

    ``weight`` is what a token of the document's cell counts after raking,
    scaled so that the tokens of the table count ``budget``, their own number
    unless given. ``probability`` is the weight, at most one; ``token_weight``
    is the rest, weight over probability, for each token that is drawn: one, or
    more in cells that have too few tokens. So a rare cell does not thin out
    the others. ``selected`` draws by a hash of the id and the text, so that a repeated run
    draws the same rows and repeated rows share their fate. Missing sources and
    languages are values of their own. ``row`` is a number that is carried along. Cells without any token (empty texts)
    have weight, probability, token weight and margin error 0. ``margin_error`` is how
    far the row's source, language or topic is off its target at the end, as a
    share of the target: targets can contradict each other. Without ``targets`` the tempered shares of
    the table are the targets. An empty table gives an empty result.
    """
    rows = materialise(measured(docs, F.lit(0) if row is None else row, id_column, text, source, lang))
    cells = rows.groupBy(*MARGINS).agg(F.sum("n_tokens").cast("double").alias("tokens")).where("tokens > 0")
    cells = materialise(cells.withColumn("weight", F.col("tokens")))
    if targets is None:
        targets = {m: materialise(tempered_targets(cells, m, power)) for m in MARGINS}
    raked = rake(cells, targets, sweeps)
    tokens, weights = raked.agg(F.sum("tokens"), F.sum("weight")).first()
    scale = (tokens if budget is None else budget) / weights if weights else 1.0
    raked = raked.select(*MARGINS, "margin_error", (F.col("weight") / F.col("tokens") * F.lit(float(scale))).alias("weight"))
    mixed = join_same(rows, raked, list(MARGINS), "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    mixed = mixed.withColumn("probability", F.least("weight", F.lit(1.0)))
    token_weight = F.when(F.col("weight") > 0, F.greatest("weight", F.lit(1.0))).otherwise(0.0)
    return mixed.select(
        "doc_id", "row", *MARGINS, "n_tokens", "weight", "probability", token_weight.alias("token_weight"),
        F.coalesce("margin_error", F.lit(0.0)).alias("margin_error"), (F.col("draw") < F.col("probability")).alias("selected"),
    )

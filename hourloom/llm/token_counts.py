"""Token counts through a cache of digests.

A text's count depends on its content and on the tokenizer alone, so counts are
stored under both digests. Documents are keyed by the digest of their content,
joined to the stored counts, and only one text of each missing digest is
encoded; the new counts are appended to the cache, and every document takes its
count from there. The texts travel once, dealt by document and not by content,
so that copies of one text never meet in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hourloom.llm.common import rank_id, whole
from hourloom.operators.lookup import lookup
from hourloom.session import materialise

CACHE_SCHEMA = "content binary, n_tokens long, tokenizer string"
COUNTS = pa.schema([("content", pa.binary()), ("n_tokens", pa.int64())])
TEXTS_AT_ONCE = 32


def tokenizer_digest(path: str) -> str:
    """Hex digest of the library, its version and the vocabulary file."""
    if path.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    with open(path, "rb") as file:
        found = hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode() + file.read())
    return found.hexdigest()


def load_counter(path: str):
    """A function from texts to token counts, without added, begin or end tokens."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]


def encoder(path: str, version: str):
    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_digest(path) != version:
            raise RuntimeError(f"{path} differs between the driver and this executor")
        count = load_counter(path)
        for part in parts:
            seen: dict[bytes, int] = {}
            content, texts = part.column("content").to_pylist(), part.column("text")
            distinct = [i for i, key in enumerate(content) if seen.setdefault(key, i) == i]
            counts: list[int] = []
            for at in range(0, len(distinct), TEXTS_AT_ONCE):
                counts += count([texts[i].as_py() for i in distinct[at : at + TEXTS_AT_ONCE]])
            yield pa.record_batch(
                [pa.array([content[i] for i in distinct], pa.binary()), pa.array(counts, pa.int64())],
                schema=COUNTS,
            )

    return encode


def open_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer, one row per content."""
    spark.sql("SELECT CAST(NULL AS BINARY) AS content, 0L AS n_tokens, '' AS tokenizer").where("false").write.mode(
        "append"
    ).parquet(folder)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(folder)
    # Two jobs may have stored one content; their counts are equal.
    return stored.where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    cache: str,
    id_column: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """Return doc_id, n_bytes, n_tokens, over_limit and the content digest, one row per input row.

    The normal form of a content is the text itself, a missing one as the empty
    text: any stronger form could change a count. Missing ids, repeated rows
    and copies each keep their row; an empty table gives an empty result and
    leaves the cache as it is. Only the two named columns are read.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    texts = docs.select(F.col(id_column).alias("doc_id"), whole(text).alias("text"))
    texts = texts.withColumn("content", F.unhex(F.sha2("text", 256)))
    keyed = materialise(texts.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")))
    missing = (
        keyed.groupBy("content")
        .agg(F.min(rank_id("doc_id")).alias("one"))
        .join(open_cache(spark, cache, version), "content", "left_anti")
    )
    todo = texts.withColumn("one", rank_id("doc_id")).join(missing.hint("shuffle_hash"), ["one", "content"])
    counted = todo.select("content", "text").mapInArrow(encoder(tokenizer_path, version), "content binary, n_tokens long")
    counted.withColumn("tokenizer", F.lit(version)).write.mode("append").parquet(cache)
    # A content that very many documents hold is dealt over several tasks.
    known = lookup(keyed, open_cache(spark, cache, version), ["content"], broadcast_rows=0)
    return known.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
        F.lower(F.hex("content")).alias("content_sha256"),
    )

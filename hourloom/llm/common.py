"""What the corpus operators share: word splitting on bytes, keys, folds, small frames."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A missing document id sorts behind every other one.
LAST_ID = (1 << 63) - 1

#: A-Z to a-z and nothing else, as bytes.lower() does; and the same with all ASCII but letters and digits as space.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole(text: str) -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def rank_id(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID))


def text_key(text: str) -> Column:
    """128 bits of SHA-256 of the whole text."""
    return F.unhex(F.substring(F.sha2(whole(text), 256), 1, 32))


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a missing id counts as empty text."""
    return (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def lower_words(text: str | None) -> list[bytes]:
    """Maximal runs of anything but ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(ALNUM).split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pack(values: np.ndarray) -> bytes:
    """Zstandard over the bytes of the values, first bytes first: small numbers cost little."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def unpack(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)

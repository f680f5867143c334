"""What the operators of this package share: tables in the scratch folder, splits, words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubrica.sources.sinks import scratch_folder

#: Rows of text in an Arrow batch: some MB of them, so that a worker's memory stays small.
BATCH_ROWS = 256

#: Words that a worker remembers before it starts anew.
CACHE_ENTRIES = 300_000


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the scratch folder that all executors share, and read it.

    Its lineage ends there, so a lost executor costs no more than the step at hand.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_prefix(df: DataFrame) -> str:
    """A beginning that no column name of df has, whatever its case, for columns that are added for a while."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def remainder(key: Column, modulus: int = 5) -> Column:
    """CRC-32 of a key as text, modulo; NULL keys give -1, so they are never held out."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus)), F.lit(-1)).cast("int")


def batches_of(spark, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of Arrow batches; a text may have megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def texts(column) -> list[bytes]:
    """UTF-8 of a text column of an Arrow batch; NULL counts as empty."""
    return [v or b"" for v in column.cast("binary").to_pylist()]


def portions(column, size: int):
    """A text column of an Arrow batch in slices of about `size` bytes at most, but for longer texts."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    edges = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(column)]
    return [column.slice(a, b - a) for a, b in zip(edges, edges[1:]) if b > a]


class WordHashes(dict):
    """64-bit hashes of words (UTF-8), remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a text column of an Arrow batch, A-Z in lower case, NULL counting as empty.

    Returns the hashes of the distinct words, as WordHashes has them, the place there of each word, one text
    after the other, and the number of words of each text.  Only distinct words become Python objects.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    coded = split.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    at, n = coded.indices.to_numpy().astype(np.int64), split.value_lengths().to_numpy().astype(np.int64)
    blank = np.flatnonzero(distinct == b"")
    if len(blank):  # white space at the ends of a text, or a text of nothing else
        there = at != blank[0]
        n = np.bincount(np.repeat(np.arange(len(n)), n)[there], minlength=len(n))
        at = at[there]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct)), at, n


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(hashes: np.ndarray, salt: int = 0) -> np.ndarray:
    """A second, well spread hash of 64-bit hashes."""
    h = (hashes ^ np.uint64(salt)) * _MIX
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words, in order."""
    if len(words) < n:
        return words[:0]
    count = len(words) - n + 1
    h = words[:count].copy()
    for k in range(1, n):
        h = mixed(h) + words[k:k + count]
    return mixed(h)


def as_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)

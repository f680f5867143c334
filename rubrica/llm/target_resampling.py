"""Importance resampling towards a target set, with Arrow kernels over batches of texts."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches_of, materialise

#: What stands between words: ASCII without digits and, A-Z being lowered, without letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
#: Bytes of text that the kernels take at a time; a longer text goes alone.
SLICE = 1 << 20


def slices(column: pa.Array, limit: int = SLICE):
    """A text column, NULL as empty, in slices of about `limit` bytes."""
    column = pc.fill_null(column, "")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield column.slice(at, end - at)
        at = end


def runs(column: pa.Array, longest: int = 3):
    """(distinct, which, parent, n_words): for each length, CRC-32 of the distinct runs of words, which of
    them each run is, and the text of each run; words per text.

    The dictionary of the words gives each an index.  The index of a run, shifted, and that of the
    word behind it make one number, and the distinct ones of those are the longer runs; so
    each distinct pair of run and word takes one CRC, continued from that of its run.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(column), pattern=SEPARATORS)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)
    words = flat.filter(real).dictionary_encode()
    parent = parent.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
    word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    spellings = words.dictionary.cast(pa.binary()).to_pylist()
    behind, size = [b" " + w for w in spellings], max(1, len(spellings))
    crc = np.fromiter(map(zlib.crc32, spellings), np.int64, len(spellings))
    start, run = np.arange(len(word)), word
    found = [(crc, run, parent)]
    for n in range(1, longest):
        goes_on = start + n < len(word)
        goes_on[goes_on] = parent[start[goes_on] + n] == parent[start[goes_on]]
        start, run = start[goes_on], run[goes_on]
        coded = pa.array(run * size + word[start + n]).dictionary_encode()
        left, last = np.divmod(coded.dictionary.to_numpy(zero_copy_only=False), size)
        crc = np.fromiter(map(zlib.crc32, map(behind.__getitem__, last.tolist()), crc[left].tolist()), np.int64, len(left))
        run = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        found.append((crc, run, parent[start]))
    return found, np.bincount(parent, minlength=len(column))


def bucket_counts(rows: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """Runs in each bucket over all texts; each task sends one sum per bucket."""
    batches_of(rows.sparkSession)

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch.column("t")):
                for crc, run, _ in runs(part)[0]:
                    of_run = np.bincount(run, minlength=len(crc))
                    total += np.bincount(crc % buckets, weights=of_run, minlength=buckets).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(total)], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    sums = rows.select(F.col(text_col).alias("t")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    for bucket, n in sums.collect():
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of the smoothed target and raw models, per bucket."""
    size = len(raw)
    ratio = ((target + 1.0) * (raw.sum() + size)) / ((raw + 1.0) * (target.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(key: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) from a hash of seed and id; a NULL id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(i, n_words, n_features, weight) of each row."""
    batches_of(docs.sparkSession)

    def weigh(batches):
        for batch in batches:
            rows = []
            for part in slices(batch.column("t")):
                found, n_words = runs(part)
                n, weight = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                for crc, run, parent in found:
                    # Runs come in the order of their texts, so a text's gains are one segment.
                    edges = np.searchsorted(parent, np.arange(len(part) + 1))
                    sums = np.concatenate([[0], np.cumsum(gain[crc % len(gain)].take(run))])
                    n += np.diff(edges)
                    weight += np.diff(sums[edges])
                rows.append((n_words, n, weight))
            columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), *map(pa.array, columns)], ["i", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return rows.mapInArrow(weigh, f"i {kind}, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order) -> DataFrame:
    """rows with `rank` from 1 in a total order, without a task that sees them all.

    Ranges of the order are sorted each by itself and written with their row numbers; the
    numbers of the ranges before come from one count per range.
    """
    at = F.monotonically_increasing_id()
    placed = materialise(rows.orderBy(*order).withColumn("__at", at), "ranked")
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    before, offsets = 0, []
    for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect():
        offsets.append((r["p"], before))
        before += r["n"]
    offsets = rows.sparkSession.createDataFrame(offsets, "__part long, __before long")
    joined = placed.join(F.broadcast(offsets), part == F.col("__part"))
    return joined.withColumn("rank", place + F.col("__before") + 1).drop("__at", "__part", "__before")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = BUCKETS, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of each row: a sample of docs that resembles target.

    Words are runs of a-z, 0-9 and characters beyond ASCII, A-Z counting as lower case;
    features are all runs of one to three words, hashed into `buckets` by CRC-32.  Both models
    count all rows.  A text weighs the sum of its features' gains, floor(1000 * log ratio of
    the models); Gumbel noise from a hash of seed and id is added, and of the N texts with at
    least `least_words` words the percent * N / 100 highest scores are drawn; rank is NULL for the rest.

    NULL and empty texts have no features and weight 0.  A NULL id is hashed as an empty
    one and comes last among ties; ties go to the smaller id; rows repeated with their id
    are rows of their own, ranked one after the other.  An empty target is a uniform model; an
    empty table gives no rows.  Other columns are not read.  Two scans of docs; the driver
    gets one number per bucket, and one per range of the ranking.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text, buckets))
    scored = weighed(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("i"), seed))
    scored = materialise(scored, "scored")
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("i"), F.desc("weight"), F.desc("n_features"), F.desc("n_words")]
    inside = ranked(scored.where(able), order)
    inside = inside.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return inside.unionByName(rest).select(F.col("i").alias(id_col), "n_features", "weight", "score", "rank")

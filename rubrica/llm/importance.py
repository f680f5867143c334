"""Quality by importance resampling with hashed n-gram models (Xie et al., 2023)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, batches_of, materialise, ngram_hashes, remainder, texts
from .mixing import uniform

#: Buckets that words and word pairs are hashed into, and labelled rows that the target is learned from.
BUCKETS, SAMPLE = 1 << 14, 20_000
#: Bins per step of the search for the threshold, and rows that end it.
BINS, FEW = 4_096, 4_096


def features(words: WordHashes, text: bytes, buckets: int) -> np.ndarray:
    """Buckets of the words and the word pairs of a text; A-Z count as lower case."""
    h = words.of(text.lower().split())
    return (np.concatenate([ngram_hashes(h, 1), ngram_hashes(h, 2) + np.uint64(1)]) % np.uint64(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each bucket over all texts t, and over those with `good`."""

    def rows(batches):
        words, total = WordHashes(), np.zeros((2, buckets), np.int64)
        for batch in batches:
            for text, good in zip(texts(batch.column("t")), batch.column("good").to_pylist()):
                counts = np.bincount(features(words, text, buckets), minlength=buckets)
                total[0] += counts
                if good:
                    total[1] += counts
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(buckets)), pa.array(total[0]), pa.array(total[1])], ["bucket", "n", "n_good"])

    out = np.zeros((2, buckets), np.int64)
    sums = docs.mapInArrow(rows, "bucket long, n long, n_good long").groupBy("bucket").agg(F.sum("n"), F.sum("n_good"))
    for bucket, n, good in sums.collect():
        out[:, bucket] = n, good
    return out[0], out[1]


def threshold(keyed: DataFrame, keep: int) -> tuple[float, float, int]:
    """(lo, hi, rest): keys above hi are kept, and the `rest` largest of those in [lo, hi].

    Each step counts keys in bins of equal width and goes into the bin of the last kept
    key, until it holds FEW rows or equal keys alone.
    """
    lo, hi, rest = *keyed.agg(F.min("key"), F.max("key")).first(), keep
    while True:
        inside = keyed.where(F.col("key").between(lo, hi))
        width = (hi - lo) / BINS
        if not width or width + lo == lo:
            return lo, hi, rest
        bins = F.least(F.floor((F.col("key") - lo) / width), F.lit(BINS - 1)).alias("bin")
        parts = inside.groupBy(bins).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        for r in sorted(parts.collect(), key=lambda r: -r["bin"]):
            if rest <= r["n"]:
                break
            rest -= r["n"]
        if r["n"] <= FEW or (r["lo"], r["hi"]) == (lo, hi):
            return r["lo"], r["hi"], rest
        lo, hi = r["lo"], r["hi"]


def resampled(
    docs: DataFrame, labels: DataFrame, share: float | None = None, buckets: int = BUCKETS, sample: int = SAMPLE,
    seed: str = "resample", id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, held_out, n_features, log_weight, score, key, kept) of each row.

    The target model is learned from at most `sample` rows labelled of quality 1 whose
    CRC-32 remainder is not 0, the raw model from all texts.  The log weight of a text is
    the sum of log ratios over its words and word pairs; with Gumbel noise from a hash of
    seed and id, the largest keys are a sample by weight without replacement.  `share` of
    all rows is kept, by default the share of quality 1 among labels that are not held
    out.  score is the logistic of the mean log ratio, 0.5 without words.

    NULL and empty texts have weight 0; NULL labels and ids are not learned from; rows of
    one id get the same noise; ties of keys go by id, NULL first; without labels every
    weight is 0 and all rows are kept; an empty table gives no rows.  Two scans of texts;
    the driver gets the buckets' sums and counts of bins.
    """
    batches_of(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    own = labels.select(F.col(id_col).alias("i"), F.col("quality").cast("int").alias("quality")).where(
        F.col("i").isNotNull() & F.col("quality").isin(0, 1) & (remainder(F.col("i")) != 0))
    if share is None:
        share = own.agg(F.avg("quality")).first()[0]
        share = 1.0 if share is None else share
    picked = materialise(
        own.where("quality = 1").orderBy(F.xxhash64("i"), "i").limit(sample).select("i").distinct().withColumn("good", F.lit(True)), "target")
    raw, good = bucket_counts(rows.join(F.broadcast(picked), "i", "left").select("t", "good"), buckets)
    ratio = np.zeros(buckets)
    if good.sum():
        ratio = np.log((good + 1.0) / (good.sum() + buckets)) - np.log((raw + 1.0) / (raw.sum() + buckets))

    def weighed(batches):
        words = WordHashes()
        for batch in batches:
            found = [features(words, t, buckets) for t in texts(batch.column("t"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([float(ratio[f].sum()) for f in found], pa.float64())], ["i", "n_features", "log_weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = rows.mapInArrow(weighed, f"i {kind}, n_features long, log_weight double")
    noise = -F.log(-F.log(uniform(F.col("i"), seed) + F.lit(2.0 ** -54)))
    scored = materialise(scored.withColumn("key", F.col("log_weight") + noise), "scored")
    total = scored.count()
    keep = total if not good.sum() else int(round(share * total))
    lo, hi, rest = threshold(scored, keep) if keep and total else (float("inf"), float("inf"), 0)
    edge = F.col("key").between(F.lit(lo), F.lit(hi))
    tied = scored.where(edge).withColumn("place", F.row_number().over(Window.orderBy(F.desc("key"), "i")))
    out = (scored.where(~edge).withColumn("kept", F.col("key") > F.lit(hi))
           .unionByName(tied.withColumn("kept", F.col("place") <= rest).drop("place")))
    mean = F.when(F.col("n_features") > 0, F.col("log_weight") / F.col("n_features")).otherwise(F.lit(0.0))
    return out.select(
        F.col("i").alias(id_col), (remainder(F.col("i")) == 0).alias("held_out"), "n_features", "log_weight",
        (1 / (1 + F.exp(-mean))).alias("score"), "key", "kept")

"""Language-model scoring with a log-frequency Bloom filter (Talbot and Osborne, 2007)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_long, batches_of, materialise, mixed, portions, remainder, word_hashes

#: Bits of the filter at least, of its segments, probes per entry, and entries per bit at most.
BITS, SEGMENT_BITS, PROBES, LOAD = 1 << 28, 1 << 18, 4, 0.15
#: Bits of the filter at most; n-grams beyond them are joined.
MOST_BITS = 1 << 30
#: Words whose exact counts every worker holds; the others are joined.
FREQUENT = 1 << 18
#: Word pairs seen less often are left to the smoothing; 1 keeps all.
MIN_PAIR = 1
#: Levels per doubling of a count.
FINENESS = 2
#: Weights of the pair model that are tried.
GRID = (0.0, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)
#: Tokens that a task counts at once.
CHUNK = 1 << 21

#: No word holds white space, so these are no words.
END, BEGIN = b" ", b"\t"
LEVELS = 48 * FINENESS

#: Places (twice the token's, plus one for its pair) and keys that the filter does not hold.
OPEN = pa.list_(pa.struct([("place", pa.int64()), ("key", pa.int64())]))


def pairs_of(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Keys of tokens and of those before them."""
    return mixed(mixed(before, 1) + tokens, 2)


class Tokens:
    """Token hashes of texts: words with A-Z in lower case, then the end."""

    begin, end = (np.uint64(xxhash.xxh3_64_intdigest(v)) for v in (BEGIN, END))

    def of(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct token keys of a text column of an Arrow batch in order, the place there of each token, and the tokens of each text."""
        found, at, n = word_hashes(column)
        keys, place = np.unique(np.append(found, self.end), return_inverse=True)
        return keys, place[np.insert(at, np.cumsum(n), len(found))], n + 1

    def pairs(self, one: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Keys of each token with the one before, from the keys of the tokens."""
        before = np.roll(one, 1)
        before[np.cumsum(n) - n] = self.begin
        return pairs_of(before, one)


def _counted(batches):
    """Partial counts (pair, key, n) of a task, a bounded number of tokens at a time."""
    tokens, held, size = Tokens(), ([], []), 0

    def flush():
        for kind in (0, 1):
            if held[kind]:
                keys, n = np.unique(np.concatenate(held[kind]), return_counts=True)
                held[kind].clear()
                for at in range(0, len(keys), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys[part]), bool(kind))), pa.array(as_long(keys[part])), pa.array(n[part].astype(np.int64))],
                        ["pair", "key", "n"])

    for batch in batches:
        for some in portions(batch.column("t"), CHUNK):
            keys, at, n = tokens.of(some)
            held[0].append(keys[at])
            held[1].append(tokens.pairs(held[0][-1], n))
            size += len(at)
            if size >= CHUNK:
                yield from flush()
                size = 0
    yield from flush()


def quantised(n: np.ndarray) -> np.ndarray:
    """Level of a count: 1 + floor(log), to the base of FINENESS levels per doubling."""
    return np.floor(FINENESS * np.log2(n) + 1e-9).astype(np.int64) + 1


def least_of(level: np.ndarray) -> np.ndarray:
    """The smallest count of a level; 0 for level 0.  Counts up to 3 have levels of their own."""
    return np.where(level > 0, np.ceil(np.exp2((level - 1) / FINENESS) - 1e-9), 0.0)


def most_of(level: np.ndarray) -> np.ndarray:
    """The largest count of a level; 0 for level 0."""
    return np.where(level > 0, np.ceil(np.exp2(level / FINENESS) - 1e-9) - 1, 0.0)


def positions(keys: np.ndarray, level: int, segment_bits: int):
    """Bits of an entry (key, level) within its segment, one array per probe."""
    h = mixed(keys, 2 * level + 1)
    step = mixed(keys, 2 * level + 2) | np.uint64(1)
    for _ in range(PROBES):
        yield (h % np.uint64(segment_bits)).astype(np.int64)
        h = h + step


class Filter:
    """Levels of keys, read by membership probes: level l is there if all levels below are."""

    def __init__(self, bits: np.ndarray, segment_bits: int):
        if segment_bits & (segment_bits - 1):
            raise ValueError("a segment has a power of two of bits")
        self.bits, self.segment_bits = bits, segment_bits
        self.segments = len(bits) * 8 // segment_bits

    def level(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        segment = segment_of(keys, self.segments)
        # One segment after the other, each of which stays in the processor's cache meanwhile.
        live = np.argsort(segment.astype(np.uint16) if self.segments <= 1 << 16 else segment, kind="stable")
        key, base = keys[live], segment[live] * self.segment_bits
        for level in range(1, LEVELS):
            # Most keys that are not there end at the first probe; the rest takes the others.
            h = mixed(key, 2 * level + 1)
            left = np.flatnonzero(self._set(base, h))
            live, key, base, h = live[left], key[left], base[left], h[left]
            step = mixed(key, 2 * level + 2) | np.uint64(1)
            there = np.ones(len(left), bool)
            for _ in range(PROBES - 1):
                h += step
                there &= self._set(base, h)
            live, key, base = live[there], key[there], base[there]
            if not len(live):
                break
            out[live] = level
        return out

    def _set(self, base: np.ndarray, h: np.ndarray) -> np.ndarray:
        at = base + (h & np.uint64(self.segment_bits - 1)).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return (keys % np.uint64(segments)).astype(np.int64)


def build(grams: DataFrame, bits: int, segment_bits: int) -> np.ndarray:
    """The filter over (key, n): every segment is filled by one task, the driver joins them."""
    segments = bits // segment_bits

    def segment(key, pdf):
        keys, level = pdf["key"].to_numpy().view(np.uint64), quantised(pdf["n"].to_numpy())
        flags = np.zeros(segment_bits, bool)
        for at in range(1, int(level.max()) + 1):
            for bit in positions(keys[level >= at], at, segment_bits):
                flags[bit] = True
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

    # Keys are unsigned: the remainder of a negative long is brought to that of key + 2^64.
    shift = (1 << 64) % segments
    which = F.pmod(F.pmod(F.col("key"), F.lit(segments)) + F.when(F.col("key") < 0, F.lit(shift)).otherwise(F.lit(0)), F.lit(segments))
    # Written first: the driver then fetches a few splits of files, not each shuffle partition by a job.
    parts = materialise(
        grams.withColumn("segment", which).groupBy("segment").applyInPandas(segment, "segment long, bits binary"), "filter")
    out = np.zeros(bits // 8, np.uint8)
    width = segment_bits // 8
    for row in parts.toLocalIterator():
        out[row["segment"] * width:(row["segment"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return out


def level_of(n: Column) -> Column:
    """quantised() of a column."""
    return F.floor(F.log2(n) * FINENESS + 1e-9) + 1


class Reader:
    """Levels of the tokens of a batch, and of their pairs, as the filter has them; below `lowest` they are open, 0 for now."""

    def __init__(self, probes: Filter, lowest: int):
        self.tokens, self.probes, self.lowest = Tokens(), probes, lowest

    def read(self, column) -> None:
        self.one, self.at_one, self.n = self.tokens.of(column)
        self.starts = np.cumsum(self.n) - self.n
        two, at_two = np.unique(self.tokens.pairs(self.one[self.at_one], self.n), return_inverse=True)
        levels = [self.probes.level(keys) for keys in (self.one, two)]
        self.word, self.joint = (np.where(v >= self.lowest, v, 0).astype(np.uint8)[at] for v, at in zip(levels, (self.at_one, at_two)))
        # No entry of the filter is lost: what is below its lowest level is not in it.
        self.open = pa.array([[]] * len(self.n), OPEN)
        if self.lowest > 1:
            where = [np.flatnonzero(v == 0) for v in (self.word, self.joint)]
            token, key = np.concatenate(where), np.concatenate([self.one[self.at_one[where[0]]], two[at_two[where[1]]]])
            place = 2 * (token - np.repeat(self.starts, self.n)[token]) + np.repeat([0, 1], [len(w) for w in where])
            order = np.argsort(token, kind="stable")
            offsets = np.searchsorted(token[order], np.append(self.starts, self.n.sum())).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array(place[order]), pa.array(as_long(key[order]))], fields=list(OPEN.value_type))
            self.open = pa.ListArray.from_arrays(pa.array(offsets), entries)

    def packed(self, levels: np.ndarray) -> pa.Array:
        """A byte per token, by text."""
        offsets = np.append(self.starts, self.n.sum()).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(self.n), [None, pa.py_buffer(offsets), pa.py_buffer(levels)])


def resolved(read: DataFrame, rest: DataFrame) -> DataFrame:
    """`read` with the levels of its open entries from the n-grams `rest` (key, level), which the filter leaves out."""
    names = [n for n in read.columns if n != "open"]
    kind = ", ".join(f"{n} {read.schema[n].dataType.simpleString()}" for n in names)

    def filled(batches):
        for batch in batches:
            found = batch.column("found").to_pylist()
            levels = {name: [np.frombuffer(v, np.uint8).copy() for v in batch.column(name).to_pylist()] for name in ("word", "joint")}
            for k, packed in enumerate(found):
                if packed:
                    place, level = np.divmod(np.array(packed, np.int64), 128)
                    for name, odd in (("word", 0), ("joint", 1)):
                        own = place % 2 == odd
                        levels[name][k][place[own] // 2] = level[own]
            columns = {name: pa.array([v.tobytes() for v in each], pa.binary()) for name, each in levels.items()}
            yield pa.RecordBatch.from_arrays([columns[n] if n in columns else batch.column(n) for n in names], names)

    entries = read.select("row", F.explode("open").alias("o")).select("row", "o.place", "o.key")
    found = (entries.join(rest, "key").groupBy("row")
             .agg(F.collect_list(F.col("place") * 128 + F.col("level")).alias("found")))
    return materialise(read.select(names).join(found, "row", "left").mapInArrow(filled, kind), "resolved")


class PairModel:
    """Probabilities of the tokens of a batch, by their levels; `means` are the mean counts of words by level.

    The means add up to all tokens, so the word model's masses add up to 1.  The pair model
    divides the least count of a pair's level by the largest of its history's, so the masses of all
    pairs of a history add up to 1 at most.  No pair is more frequent than its words, so a level above theirs is a
    false hit of the filter and lowered to it.
    """

    def __init__(self, word: np.ndarray, before: np.ndarray, joint: np.ndarray, denominator: float, means: np.ndarray):
        self.single = (means[word] + 0.5) / denominator
        self.history, self.joint = most_of(before), least_of(np.minimum(joint, np.minimum(word, before)))
        self.bucket = before // (2 * FINENESS)

    def pair(self, less: float = 0.0) -> np.ndarray:
        """Relative frequency of each token after the one before, with `less` of each count."""
        return np.maximum(self.joint - less, 0.0) / np.maximum(self.history - less, 1.0)


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the texts, and the levels of tokens, of the tokens before them, and of the pairs."""
    each = batch.column("word").to_pylist()
    starts = np.cumsum([0, *map(len, each)])
    word, joint = (np.frombuffer(b"".join(v), np.uint8).astype(np.int64) for v in (each, batch.column("joint").to_pylist()))
    before = np.roll(word, 1)
    before[starts[:-1]] = word[starts[1:] - 1]  # as many begins as ends
    return starts[:-1], word, before, joint


def fitted(levels: DataFrame, denominator: float, means: np.ndarray, buckets: int) -> np.ndarray:
    """The weight of the pair model for each bucket of the count of the token before.

    Each learning text is scored with its own pair left out of the counts; the weight of
    largest likelihood is taken.  Tasks count how often levels meet, so the texts are read once.
    """

    def met(batches):
        total = np.zeros(128 ** 3, np.int64)
        for batch in batches:
            _, word, before, joint = unpacked(batch)
            code, k = np.unique((joint * 128 + before) * 128 + word, return_counts=True)
            total[code] += k
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], ["code", "k"])

    rows = levels.mapInArrow(met, "code long, k long").groupBy("code").agg(F.sum("k").alias("k")).collect()
    code, k = (np.array([r[n] for r in rows], np.int64) for n in ("code", "k"))
    own = PairModel(code % 128, code // 128 % 128, code // 128 ** 2, denominator, means)
    pair, total = own.pair(1.0), np.zeros((buckets, len(GRID)))
    for at, weight in enumerate(GRID):
        total[:, at] = np.bincount(own.bucket, k * np.log(weight * pair + (1 - weight) * own.single), buckets)
    return np.array(GRID)[total.argmax(axis=1)]


def scored(
    docs: DataFrame, fold: int = 1, modulus: int = 5, bits: int = BITS, segment_bits: int = SEGMENT_BITS,
    frequent: int = FREQUENT, min_pair: int = MIN_PAIR, id_col: str = "doc_id", text_col: str = "text",
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Tokens are words, A-Z in lower case, and one end per text.  Counts of tokens and of
    token pairs are learned from rows whose CRC-32 remainder is not `fold`.  base_score
    uses exact token counts: those of the commonest words, `frequent` at most, are in every worker,
    rarer tokens of a text are joined with the count table.  score is the log10
    probability of a pair model: counts are quantised by logarithm and stored as a
    unary run of entries in a Bloom filter, which workers probe level by
    level; P(w | v) = a c(v, w) / c(v) + (1 - a) P(w), where the weight a depends on c(v) and
    is fitted on all learning texts; it sums to 1 at most, but for false hits of the filter (see PairModel).  The filter has `bits`, or as many as
    its entries need, up to `most_bits` (or `bits`, if more); levels that do not fit are left out of it, and tokens and
    pairs not found in it are joined with the counts of those levels.  So all n-grams count at every size.

    NULL texts count as empty and have the end alone; NULL ids are learned from; repeated
    rows and ids are scored row by row; an empty table gives no rows; other columns are
    not read.  Counts are combined in each task and move as 64-bit keys, so a word of any
    frequency costs one row per chunk.  The driver holds the filter and
    `frequent` counts.
    """
    spark = docs.sparkSession
    batches_of(spark)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    held_out = remainder(F.col("i"), modulus) == fold
    grams = materialise(
        rows.where(~held_out).select("t").mapInArrow(_counted, "pair boolean, key long, n long")
        .groupBy("pair", "key").agg(F.sum("n").alias("n")).where(~F.col("pair") | (F.col("n") >= min_pair)), "grams")
    words = grams.where("not pair").select("key", "n")
    level = level_of(F.col("n"))
    by_level = grams.groupBy("pair", level.alias("l")).agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect()
    steps = {r["l"]: r["k"] for r in by_level if not r["pair"]}
    total, distinct = sum(r["n"] for r in by_level if not r["pair"]), sum(steps.values())
    below = math.log10(total + 0.5 * (distinct + 1))
    means = np.zeros(128)
    for r in by_level:
        if not r["pair"]:
            means[r["l"]] = r["n"] / r["k"]
    # The lowest level from which on all n-grams fit the filter, and its bits.
    sizes = {}
    for r in by_level:
        sizes[r["l"]] = sizes.get(r["l"], 0) + r["k"]
    entries, lowest = 0, max(sizes, default=0) + 1
    for step in sorted(sizes, reverse=True):
        if entries + sizes[step] * step > max(bits, most_bits) * LOAD:
            break
        entries, lowest = entries + sizes[step] * step, step
    bits = max(bits, -(-math.ceil(entries / LOAD) // segment_bits) * segment_bits)
    kept = level_of(F.col("n")) >= lowest
    shared = spark.sparkContext.broadcast(build(grams.where(kept), bits, segment_bits))
    # The commonest words, down to the lowest level that leaves no more than `frequent`.
    have = 0
    least = max(steps, default=0) + 1
    for step in sorted(steps, reverse=True):
        have += steps[step]
        if have > frequent:
            break
        least = step
    top = words.where(level >= least).toPandas()
    keys = top["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    common = spark.sparkContext.broadcast((keys[order], top["n"].to_numpy(np.int64)[order]))
    denominator = total + 0.5 * (distinct + 1)

    def judged(batches):
        own = Reader(Filter(shared.value, segment_bits), lowest)
        known, counts = common.value
        logs = np.log10(counts + 0.5)
        for batch in batches:
            own.read(batch.column("t"))
            n, starts, one, at_one = own.n, own.starts, own.one, own.at_one
            if len(known):
                place = np.minimum(np.searchsorted(known, one), len(known) - 1)
                hit = known[place] == one
                log_one = np.where(hit, logs[place], 0.0)
            else:
                hit, log_one = np.zeros(len(one), bool), np.zeros(len(one))
            base = np.add.reduceat(log_one[at_one], starts)
            sure = np.add.reduceat(hit[at_one].astype(np.int64), starts)
            rare = np.flatnonzero(~hit[at_one])
            offsets = np.searchsorted(rare, np.append(starts, n.sum())).astype(np.int32)
            tail = pa.ListArray.from_arrays(pa.array(offsets), pa.array(as_long(one[at_one[rare]])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), batch.column("held_out"), pa.array(n), pa.array(sure), pa.array(base),
                 own.packed(own.word), own.packed(own.joint), own.open, tail],
                ["i", "held_out", "n_tokens", "sure", "base", "word", "joint", "open", "tail"])

    kind = docs.schema[id_col].dataType.simpleString()
    first = materialise(
        rows.withColumn("held_out", held_out).mapInArrow(
            judged, f"i {kind}, held_out boolean, n_tokens long, sure long, base double, word binary, joint binary, "
            "open array<struct<place:long,key:long>>, tail array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "judged")
    full = first.drop("tail")
    if lowest > 1:
        full = resolved(full, grams.where(~kept).select("key", level_of(F.col("n")).alias("level")))
    weights = fitted(full.where(~F.col("held_out")).select("word", "joint"), denominator, means, LEVELS // (2 * FINENESS) + 1)

    def marked(batches):
        for batch in batches:
            starts, word, before, joint = unpacked(batch)
            own = PairModel(word, before, joint, denominator, means)
            weight = weights[own.bucket]
            score = np.add.reduceat(np.log10(weight * own.pair() + (1 - weight) * own.single), starts)
            names = ["i", "held_out", "n_tokens", "sure", "base", "row"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(score)], [*names, "score"])

    scores = full.select("i", "held_out", "n_tokens", "sure", "base", "row", "word", "joint").mapInArrow(
        marked, f"i {kind}, held_out boolean, n_tokens long, sure long, base double, row long, score double")
    rare = first.select("row", F.explode("tail").alias("key")).groupBy("row", "key").agg(F.count("*").alias("k"))
    rest = (rare.join(words, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
            .groupBy("row").agg(F.sum(F.col("k") * F.log10(F.col("n") + 0.5)).alias("more"),
                                F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(F.lit(0))).alias("found")))
    return scores.join(rest, "row", "left").select(
        F.col("i").alias(id_col), "held_out", "n_tokens",
        (F.col("sure") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(below)).alias("base_score"), "score")

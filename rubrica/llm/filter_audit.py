"""How quality filters interact: one byte pass measures each text, then every order of the filters is audited."""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches_of, materialise, texts

#: Bytes of text that are measured at a time; a longer text is cut there, between words.
PIECE = 1 << 20

#: Byte classes.
SPACE, CAPITAL, MARK, FOLLOWING, OTHER = range(5)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[0x20, *range(0x09, 0x0E)]] = SPACE
CLASS[ord("A"):ord("Z") + 1] = CAPITAL
CLASS[[ord(c) for c in "#$%&*|"]] = MARK
CLASS[0x80:0xC0] = FOLLOWING

#: What a byte adds to the counts.
POINT, UPPER, SYMBOL, START, END = 1, 2, 4, 8, 16
#: States: 0 between words, 1 in a word.  Rows are states, columns byte classes.
NEXT = np.array([[0, 1, 1, 1, 1], [0, 1, 1, 1, 1]], np.uint8)
OUT = np.array([
    [POINT, POINT | UPPER | START, POINT | SYMBOL | START, START, POINT | START],
    [POINT | END, POINT | UPPER, POINT | SYMBOL, 0, POINT],
], np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: The first n bytes of a little-endian word of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Longer words are compared in one piece each.
_LONG = 256


class Transducer:
    """Counts of texts from one pass of a byte automaton over them.

    The state after a byte is the same from either state, so the states of all bytes are
    one lookup of their classes, shifted by a byte, and the outputs one more.
    """

    def __init__(self, piece: int = PIECE):
        self.piece = piece
        self._up = self._down = np.ones(1, np.uint64)

    def measure(self, batch: list[bytes]) -> np.ndarray:
        """(n_words, n_distinct, n_capitals, n_points, n_marks) of each text, one row per text."""
        out = np.zeros((len(batch), 5), np.int64)
        at = 0
        while at < len(batch):
            end, size = at + 1, len(batch[at])
            while end < len(batch) and size + len(batch[end]) < self.piece:
                size += len(batch[end])
                end += 1
            out[at:end] = self._group(batch[at:end])
            at = end
        return out

    def _group(self, batch: list[bytes]) -> np.ndarray:
        # A space behind each text ends its last word and starts the next text in state 0.
        joined = np.frombuffer(b" ".join(batch) + b" " * 9, np.uint8)
        bounds = np.cumsum([0] + [len(t) + 1 for t in batch])
        out = np.zeros((len(batch), 5), np.int64)
        words = []
        at, total = 0, int(bounds[-1])
        while at < total:
            end = self._cut(joined, at, total)
            words.append(self._pass(joined, at, end, bounds, out))
            at = end
        start, length, key = (np.concatenate(x) for x in zip(*words))
        doc = np.searchsorted(bounds, start, "right") - 1
        out[:, 0] = np.bincount(doc, minlength=len(batch))
        out[:, 3] -= 1  # the space behind the text
        first = first_of_each(joined, start, length, key, doc)
        out[:, 1] = np.bincount(doc[first], minlength=len(batch))
        return out

    def _cut(self, joined, at: int, total: int) -> int:
        """The end of the piece that starts at `at`: behind a space."""
        if total - at <= self.piece:
            return total
        spaces = np.flatnonzero(CLASS[joined[at:at + self.piece]] == SPACE)
        if len(spaces):
            return at + int(spaces[-1]) + 1
        end = at + self.piece
        while CLASS[joined[end]] != SPACE:
            end += 1
        return end + 1

    def _pass(self, joined, at, end, bounds, out):
        """Adds the counts of a piece to `out`; gives start, length and hash of its words."""
        piece = joined[at:end]
        classes = CLASS[piece]
        states = np.zeros(len(piece), np.uint8)
        states[1:] = NEXT[0][classes[:-1]]
        adds = OUT[states, classes]
        lo, hi = np.searchsorted(bounds, [at, end - 1], "right") - 1
        edges = np.maximum(bounds[lo:hi + 1], at) - at
        for column, bit in ((2, UPPER), (3, POINT), (4, SYMBOL)):
            out[lo:hi + 1, column] += np.add.reduceat((adds & bit) != 0, edges, dtype=np.int64)
        first, last = np.flatnonzero(adds & START), np.flatnonzero(adds & END)
        up, down = self._powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece + np.uint64(1)) * down[:len(piece)], out=sums[1:])
        return first + at, last - first, (sums[last] - sums[first]) * up[first]

    def _powers(self, n: int):
        if len(self._up) < n:
            self._up, self._down = (
                np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n - 1, x))])
                for x in (_BASE, _INVERSE))
        return self._up, self._down


def first_of_each(joined, start, length, key, doc) -> np.ndarray:
    """Whether each word is the first of its spelling in its text.

    Words go into an open hash table, all at once; where a slot is taken, text, length and
    bytes are compared with its holder, and only words that differ from it go on to the next.
    """
    first = np.zeros(len(start), bool)
    if not len(start):
        return first
    key = (key ^ (doc.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0xD6E8FEB86659FD93)
    bits = max(3, int(2 * len(start) - 1).bit_length())
    table = np.full(1 << bits, -1, np.int64)
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    left = np.arange(len(start))
    while len(left):
        at = slot[left]
        free = table[at] < 0
        table[at[free][::-1]] = left[free][::-1]  # of several the first stays
        holder = table[at]
        won = holder == left
        first[left[won]] = True
        alike = ~won & (key[holder] == key[left]) & (doc[holder] == doc[left]) & (length[holder] == length[left])
        alike[alike] = same_bytes(joined, start[left[alike]], start[holder[alike]], length[left[alike]])
        left = left[~won & ~alike]
        slot[left] = (slot[left] + 1) & (len(table) - 1)
    return first


def same_bytes(joined, a, b, length) -> np.ndarray:
    """Whether the spans of equal length at a and b hold the same bytes, eight at a time."""
    same = np.ones(len(a), bool)
    eights = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))
    for i in np.flatnonzero(length > _LONG):
        same[i] = np.array_equal(joined[a[i]:a[i] + length[i]], joined[b[i]:b[i] + length[i]])
    left = np.flatnonzero(length <= _LONG)
    done = 0
    while len(left):
        held = _FIRST[np.minimum(length[left] - done, 8)]
        equal = (eights[a[left] + done] & held) == (eights[b[left] + done] & held)
        same[left[~equal]] = False
        done += 8
        left = left[equal & (length[left] > done)]
    return same


FILTERS = "ABCDE"
MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_marks")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(i, part, digest, n_words, n_distinct, n_capitals, n_points, n_marks) of each row; see `audited`."""
    batches_of(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("i"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("t"))

    def measure(batches):
        transducer = Transducer()
        for batch in batches:
            counts = transducer.measure(texts(batch.column("t")))
            columns = [batch.column(c) for c in ("i", "part", "digest")]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(counts[:, k]) for k in range(5)], ["i", "part", "digest", *MEASURES])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(measure, f"i {kind}, part string, digest binary, " + ", ".join(f"{m} long" for m in MEASURES))


def failures() -> dict[str, Column]:
    """The filters that look at one text alone, each the condition of its failure."""
    words, distinct, capitals, points, marks = (F.col(m) for m in MEASURES)
    return {
        "A": words < 100, "B": 100 * distinct < 80 * words, "C": 100 * capitals > 10 * points, "D": marks > 0,
    }


def with_earlier_copy(rows: DataFrame, most: int = 1000) -> DataFrame:
    """rows (i, digest, ...) with `copied`: whether a smaller id has the same digest.

    Digests are counted with a combine in each task.  Those that hold a `most`-th of all
    rows or more are at most `most`, so they are broadcast; the rows of the others are
    joined by shuffle, where no key then has a larger share.
    """
    groups = materialise(rows.groupBy("digest").agg(F.min("i").alias("least"), F.count("*").alias("n")).where("n > 1"), "copies")
    total = rows.count()
    hot = F.col("n") * most >= total
    named = lambda part: part.select(F.col("digest").alias("d"), "least")
    joined = rows.join(F.broadcast(named(groups.where(hot))), F.col("digest") == F.col("d"), "left")
    copied = F.coalesce(F.col("i") > F.col("least"), F.lit(False)).alias("copied")
    columns = [*rows.columns, copied]
    cold = joined.where("d is null").drop("d", "least").join(named(groups.where(~hot)), F.col("digest") == F.col("d"), "left")
    return joined.where("d is not null").select(columns).unionByName(cold.select(columns))


def audited(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    Five filters over whole texts, words being runs without white space: A under 100 words;
    B fewer than 80 distinct words in 100; C over 10 capitals A-Z in 100 code points; D any of
    #$%&*|; E the same text as a row of smaller id.  One row per part, order of the filters
    and step.  The texts are read once; per part at most 128 counts, by filters failed and labels, go on,
    and every order is worked out from them.

    A NULL text is empty, a NULL part the empty string.  A NULL id is neither smaller than
    another nor has smaller ones; rows repeated with their id do not make each other copies.
    Rows without label, or with NULL labels, are neither good nor toxic; labels repeated for an id count
    as good or toxic if one of them says so.  Other columns are not read.  An empty table
    gives no rows.  Texts are taken as the same if their SHA-256 is.  A worker holds a few
    times the longest text.
    """
    found = materialise(measured(docs, id_col, text_col, part_col), "measured")
    found = with_earlier_copy(found)
    bits = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate([*failures().values(), F.col("copied")])]
    failed = sum(bits[1:], bits[0])
    of_label = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    said = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l")).agg(of_label("quality"), of_label("toxic"))
    rows = found.select("i", "part", failed.alias("failed")).join(said, F.col("i") == F.col("l"), "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    counts = rows.groupBy("part", "failed", flag("quality").alias("good"), flag("toxic").alias("bad")).agg(F.count("*").alias("n"))
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "good", "bad", "n")).alias("kinds"))

    steps = []
    for order in permutations(FILTERS):
        before = 0
        for place, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            steps.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(place).alias("step"),
                                  F.lit(before).alias("before"), F.lit(bit).alias("bit")))
            before |= bit
    rows = parts.select("part", "kinds", F.explode(F.array(*steps)).alias("s")).select("part", "kinds", "s.*")

    def total(where, value=lambda k: k["n"]) -> Column:
        add = lambda acc, k: acc + F.when(where(k), value(k)).otherwise(F.lit(0))
        return F.aggregate("kinds", F.lit(0).cast("long"), lambda acc, k: add(acc, k).cast("long"))

    bit, before = F.col("bit"), F.col("before")
    fails = lambda k: k["failed"].bitwiseAND(bit) != 0
    earlier = lambda k: k["failed"].bitwiseAND(before) != 0
    removed = lambda k: fails(k) & ~earlier(k)
    return rows.select(
        "part", "filter_order", "step",
        total(lambda k: ~fails(k) & ~earlier(k)).alias("kept"), total(removed).alias("removed"),
        total(lambda k: fails(k) & earlier(k)).alias("redundant"),
        total(lambda k: k["failed"] == bit).alias("unique_fails"),
        total(lambda k: removed(k) & k["good"]).alias("good_lost"),
        total(lambda k: removed(k) & k["bad"]).alias("toxic_lost"),
        # Of all orders, one in as many as it fails has this filter first.
        total(fails, lambda k: k["n"] * F.lit(120) / F.bit_count(k["failed"])).alias("shapley"))

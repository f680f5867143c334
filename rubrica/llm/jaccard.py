"""Near-duplicate texts by an exact Jaccard join of word n-grams."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bloom_lm import LOAD, Filter, build
from .common import WordHashes, as_long, batches_of, free_prefix, materialise, ngram_hashes, portions, word_hashes
from .components import components

#: Words of a shingle; links need 100 * intersection >= PERCENT * union.
WORDS, PERCENT = 5, 75
#: Frequent shingles whose order is known, a matter of speed alone: how many, and how often
#: a task must meet one in CHUNK shingles to report it.
FREQUENT, REPORTED, CHUNK = 1 << 16, 3, 1 << 22
#: How much wider the bitmaps are that compare groups of more than two, and all candidates.
WIDER = 4
#: Sets that a set is tried with before all others: neighbours, then heads of groups (speed alone).
PARTNERS = 3
#: Sets that a worker knows it has seen (speed alone: later steps drop copies anyway).
SEEN = 1 << 15
#: Ids that are sent to every executor, 8 bytes each; more are joined by shuffle.
BROADCAST_IDS = 1 << 17
#: Earlier keys of a set that a tile row carries, by which pairs met before are told (speed alone).
EARLIER = 8
#: Bits of the filter that finds the texts of candidates at most, for each of them, and of its segments (speed alone).
WANTED_BITS, WANTED_EACH, WANTED_SEGMENT = 1 << 26, 32, 1 << 18
#: Buckets that prefix shingles are dealt to so that those of one set alone are found, bytes of texts that are
#: hashed at once, shingles that a task holds meanwhile, and bits of the filter of the others at most (speed alone).
BUCKETS, TEXTS, HELD, MET_BITS = 1 << 10, 1 << 24, 1 << 21, 1 << 30
#: Rows of a shingle's group in one tile, and rows of small tiles that are compared at once.
TILE, CANDIDATE_ROWS = 4_096, 1 << 14


def shingles(words: WordHashes, text: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles; of a shorter text, of all its words."""
    h = words.of(text.lower().split())
    return np.unique(ngram_hashes(h, min(WORDS, len(h)))) if len(h) else h


def sets_of(column):
    """The shingles of each text of a column of an Arrow batch."""
    for some in portions(column, TEXTS):
        hashes, at, n = word_hashes(some)
        words = hashes[at]
        runs = ngram_hashes(words, WORDS)
        for end, size in zip(np.cumsum(n).tolist(), n.tolist()):
            start = end - size
            yield np.unique(runs[start:end - WORDS + 1] if size >= WORDS else ngram_hashes(words[start:end], size) if size else words[:0])


def fingerprint(sets: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(sets.tobytes()) - (1 << 63)


def width_of(n):
    """Bits of the bitmap of a set of n: a power of two, one to two bits per element."""
    return np.maximum(64, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))


def bitmap(sets: np.ndarray, times: int = 1) -> bytes:
    width = int(width_of(len(sets))) * times
    flags = np.zeros(width, bool)
    flags[(sets & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(flags).tobytes()


class Order:
    """An order of elements common to all sets: those not known to be frequent by hash, then the frequent ones, rarest first."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = frequent  # rarest first
        self.rank = np.argsort(frequent)
        self.keys = frequent[self.rank]

    def prefix(self, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first elements, of which sets that link share at least one, and the ranks of frequent ones, or -1.

        Sets of n elements link only if they share ceil(0.75 n) of them; so the first n
        minus that, plus one, hold a shared one.
        """
        n = len(sets)
        size = n - (PERCENT * n + 99) // 100 + 1
        if not len(self.keys):
            return sets[:size], np.full(size, -1)
        at = np.minimum(np.searchsorted(self.keys, sets), len(self.keys) - 1)
        hot = self.keys[at] == sets
        rare = sets[~hot][:size]
        ranks = np.sort(self.rank[at[hot]])[:size - len(rare)]
        return np.concatenate([rare, self.frequent[ranks]]), np.concatenate([np.full(len(rare), -1), ranks])


def _profiles(batches):
    """(i, n, set_id, bits, wide) of each text, and (shingle, seen) of those that the task meets often."""
    held, seen, size = [], set(), 0

    def flush():
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= REPORTED
        rows = int(often.sum())
        return pa.RecordBatch.from_arrays(
            [pa.nulls(rows, kind), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary()),
             pa.array(as_long(found[often])), pa.array(counts[often].astype(np.int64))], names)

    names, kind = ["i", "n", "set_id", "bits", "wide", "shingle", "seen"], None
    for batch in batches:
        kind = batch.column("i").type
        sets = list(sets_of(batch.column("t")))
        ids = [fingerprint(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("i"), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64()),
             pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()),
             pa.array([bitmap(s, WIDER) if len(s) else None for s in sets], pa.binary()),
             pa.nulls(len(sets), pa.int64()), pa.nulls(len(sets), pa.int64())], names)
        for s, i in zip(sets, ids):
            if i is not None and i not in seen:
                seen.add(i)
                held.append(s)
                size += len(s)
        if size >= CHUNK or len(seen) >= SEEN:
            yield flush()
            held, seen, size = [], set(), 0
    if held:
        yield flush()


def code_of(keys: np.ndarray) -> np.ndarray:
    """The bucket of keys and 32 more of their bits.  Equal keys have equal codes."""
    return keys >> np.uint64(64 - 32 - (BUCKETS.bit_length() - 1))


def _dealt(held: list[np.ndarray]) -> pa.RecordBatch:
    """The codes of keys by bucket, 4 bytes each: those met here once, and twice those met more often."""
    code, n = np.unique(code_of(np.concatenate(held)), return_counts=True)
    code = np.repeat(code, np.minimum(n, 2))
    edges = np.searchsorted(code, np.arange(BUCKETS + 1).astype(np.uint64) << np.uint64(32))
    codes = pa.Array.from_buffers(
        pa.binary(), BUCKETS, [None, pa.py_buffer((4 * edges).astype(np.int32)), pa.py_buffer(code.astype(np.uint32))])
    there = pa.array(np.diff(edges) > 0)
    return pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)).filter(there), codes.filter(there)], ["bucket", "codes"])


def _several(key, pdf):
    """The codes of a bucket that came more than once."""
    codes, n = np.unique(np.frombuffer(b"".join(pdf["codes"]), np.uint32), return_counts=True)
    return pd.DataFrame({"key": (key[0] << 32) + codes[n > 1].astype(np.int64), "n": 1})


class Bitmaps:
    """Bitmaps of rows, as matrices by width.  A wide one folds to a narrow one by halves."""

    def __init__(self, bits: list[bytes]):
        self.width = 8 * np.array([len(b) for b in bits], np.int64)
        self.row = np.zeros(len(bits), np.int64)
        self.matrix = {}
        for w in np.unique(self.width):
            some = np.flatnonzero(self.width == w)
            self.row[some] = np.arange(len(some))
            self.matrix[w] = np.frombuffer(b"".join([bits[i] for i in some]), np.uint64).reshape(len(some), -1)

    def differing(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bits in which rows i and j differ, i the narrower or as wide; a lower bound of the elements in one set only."""
        out = np.zeros(len(i), np.int64)
        for w in np.unique(self.width[i]):
            for wide in (w, 2 * w):
                at = np.flatnonzero((self.width[i] == w) & (self.width[j] == wide))
                if len(at):
                    a, b = self.matrix[w][self.row[i[at]]], self.matrix[wide][self.row[j[at]]]
                    if wide > w:
                        b = b[:, :w // 64] | b[:, w // 64:]
                    out[at] = np.bitwise_count(a ^ b).sum(axis=1)
        return out


def may_link(maps: Bitmaps, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the bitmaps' bound of the overlap of rows i and j allows a link: 7 * overlap >= 3 * (sizes)."""
    total = n[i] + n[j]
    return (100 + PERCENT) * (total - maps.differing(i, j)) >= 2 * PERCENT * total


def _bounded(batches):
    """Pairs (set_id, n, bits) and (other, less, fewer), the other not larger, to those that may link."""
    for batch in batches:
        rows = batch.num_rows
        if rows:
            n = np.concatenate([batch.column("less").to_numpy(), batch.column("n").to_numpy()])
            maps = Bitmaps(batch.column("fewer").to_pylist() + batch.column("bits").to_pylist())
            good = pa.array(may_link(maps, n, np.arange(rows), np.arange(rows, 2 * rows)))
            yield pa.RecordBatch.from_arrays([batch.column("other").filter(good), batch.column("set_id").filter(good)], ["a", "b"])


def met(earlier: np.ndarray, key: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the keys ahead of theirs that rows i and j of a key carry hold a common one; unused places hold the key."""
    out = np.zeros(len(i), bool)
    for k in range(earlier.shape[1]):
        own = earlier[i, k]
        out |= (own != key[i]) & (earlier[j] == own[:, None]).any(axis=1)
    return out


def most_of(n, place):
    """The size of the largest set that can link with a set of n, if its element at `place` is their first common one.

    They share n - place elements at most, and need 3 / 7 of both sizes.
    """
    return (4 * n - 7 * place) // 3


def paired(run: np.ndarray, part: np.ndarray, label: np.ndarray, n: np.ndarray, most: np.ndarray, bits: list[bytes],
           cross: np.ndarray, key: np.ndarray, earlier: np.ndarray):
    """Pairs (i, j) of rows of one run, sorted by n, that may link.

    Sizes bound the ratio, places of the key in both sets the sizes, labels must differ, rows of crossed tiles must be of different
    parts, and the bitmaps must allow the overlap.  A pair that shares an earlier key has
    met there, under the same conditions: at its first common key nothing holds it back.
    """
    maps = Bitmaps(bits)
    left = np.arange(len(run))
    step = 0
    while len(left):
        step += 1
        left = left[left + step < len(run)]
        right = left + step
        # Rows of a run are sorted by size: what is too small now stays so.
        left = left[(run[left] == run[right]) & (100 * n[left] >= PERCENT * n[right])]
        right = left + step
        ok = (label[left] != label[right]) & (~cross[left] | (part[left] != part[right]))
        ok &= (n[right] <= most[left]) & (n[left] <= most[right])
        i, j = left[ok], right[ok]
        if len(i):
            new = ~met(earlier, key, i, j)
            i, j = i[new], j[new]
        if len(i):
            good = may_link(maps, n, i, j)
            yield i[good], j[good]


def _candidates(batches):
    """Arrow batches sorted by (key, one, two, n) to pairs (a, b); a run may go over several batches."""
    tile = ("key", "one", "two")

    def pairs(tables):
        table = pa.concat_tables(tables).combine_chunks()
        if not table.num_rows:
            return
        col = {c: table.column(c).to_numpy() for c in (*tile, "part", "label", "set_id", "n", "most")}
        change = np.zeros(table.num_rows, bool)
        for c in tile:
            change[1:] |= col[c][1:] != col[c][:-1]
        for i, j in paired(np.cumsum(change), col["part"], col["label"], col["n"].astype(np.int64), col["most"],
                           table.column("bits").to_pylist(), col["one"] != col["two"], col["key"],
                           table.column("earlier").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)):
            a, b = col["set_id"][i], col["set_id"][j]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    last, waiting = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        ends = tuple(table.column(c)[-1].as_py() for c in tile)
        same = np.ones(table.num_rows, bool)
        for c, v in zip(tile, ends):
            same &= table.column(c).to_numpy() == v
        cut = int(np.argmax(same))  # where the last run begins
        if cut or ends != last:  # what came before is whole runs
            waiting.append(table.slice(0, cut))
            if sum(t.num_rows for t in waiting) >= CANDIDATE_ROWS:
                yield from pairs(waiting)
                waiting = []
            table = table.slice(cut)
        waiting.append(table)
        last = ends
    if waiting:
        yield from pairs(waiting)


def _ends(pairs: DataFrame) -> DataFrame:
    """The sets of pairs (a, b), each once."""
    return pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()


def _of_pairs(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The classes that pairs are of, in a table of their own, so that the joins of the pairs move no other."""
    ends = materialise(_ends(pairs), "ends")
    few = ends.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return materialise(classes.join(F.broadcast(ends) if few else ends, "set_id", "left_semi"), "asked")


def _verified(candidates: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that link: wide bitmaps first, then exact intersection of sorted arrays.

    Sets of the candidates alone are made again, from one text each.  A Bloom filter of
    bounded size over their ids spares the other texts, so that no text is shuffled; what
    passes by chance goes in the exact join.
    """
    candidates = materialise(candidates, "pairs")
    asked = _of_pairs(classes, candidates)
    one = asked.select(F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("wide").alias("wa"))
    two = asked.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("wb"))
    small = F.col("na") <= F.col("nb")

    def either(x: str, y: str) -> list:
        return [F.when(small, F.col(x)).otherwise(F.col(y)), F.when(small, F.col(y)).otherwise(F.col(x))]

    columns = [c.alias(k) for names, pair in ((("other", "set_id"), ("a", "b")), (("less", "n"), ("na", "nb")), (("fewer", "bits"), ("wa", "wb")))
               for k, c in zip(names, either(*pair))]
    candidates = materialise(
        candidates.join(one, "a").join(two, "b").select(*columns).mapInArrow(_bounded, "a long, b long"), "bounded")
    wanted = materialise(_ends(candidates), "wanted")
    ids = asked.join(wanted, "set_id").select(F.xxhash64("least").alias("key"), F.lit(1).alias("n"))
    segments = -(-min(WANTED_BITS, WANTED_EACH * wanted.count()) // WANTED_SEGMENT)
    passing = rows.sparkSession.sparkContext.broadcast(build(ids, max(1, segments) * WANTED_SEGMENT, WANTED_SEGMENT))

    def sets(batches):
        known = Filter(passing.value, WANTED_SEGMENT)
        for batch in batches:
            some = known.level(batch.column("h").to_numpy().view(np.uint64)) > 0
            made = list(sets_of(batch.column("t").filter(pa.array(some))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([fingerprint(s) if len(s) else None for s in made], pa.int64()),
                 pa.array([as_long(s) for s in made], pa.list_(pa.int64()))], ["set_id", "elements"])

    bodies = materialise(
        rows.where("i is not null").select(F.xxhash64("i").alias("h"), "t").mapInArrow(sets, "set_id long, elements array<long>")
        .join(wanted, "set_id", "left_semi").dropDuplicates(["set_id"]), "sets")
    left = bodies.select(F.col("set_id").alias("a"), F.col("elements").alias("x"))
    right = bodies.select(F.col("set_id").alias("b"), F.col("elements").alias("y"))

    def exact(batches):
        for batch in batches:
            shared = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(
                batch.column("x").to_numpy(zero_copy_only=False), batch.column("y").to_numpy(zero_copy_only=False))]
            total = batch.column("total").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array((100 + PERCENT) * np.array(shared, np.int64) >= PERCENT * total))

    both = candidates.select("a", "b").join(left, "a").join(right, "b")
    return both.select("a", "b", "x", "y", (F.size("x") + F.size("y")).alias("total")).mapInArrow(exact, "a long, b long")


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of each row, components of links of similar shingle sets.

    A set holds the distinct five-word shingles, A-Z in lower case; a shorter text is one
    shingle; a text without words has none and links with nothing.  Sets are compared as
    classes of equal sets (64-bit fingerprints of 64-bit shingle hashes).  Method: every
    set goes into the tiles of those prefix shingles that several sets have, ordered by size, so that a row meets
    only rows of its size band; hashed bitmaps, as wide as the band asks, bound the overlap
    from above by a bit count; what is left is intersected exactly.  No link is lost.

    So that groups of near copies cost no pair each, neighbours in size are tried first,
    then each set with the heads of its groups, and only rows of different components
    are compared in full.  Groups of frequent shingles are cut into parts of about TILE
    rows, and pairs of parts are tiles.

    NULL texts count as empty.  A NULL id takes no part in links and is its own component;
    the smallest id names a component; repeated rows come back repeated.  An empty table
    gives no rows.  The driver holds FREQUENT shingles with counts, which order prefixes, and
    a Bloom filter of MET_BITS at most over the shingles that several sets have; one that is too full lets more through.
    """
    spark = docs.sparkSession
    batches_of(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    profiles = materialise(
        rows.mapInArrow(_profiles, f"i {kind}, n long, set_id long, bits binary, wide binary, shingle long, seen long"), "profiles")
    each = profiles.where("shingle is null")
    classes = materialise(
        each.where("set_id is not null and i is not null").groupBy("set_id").agg(
            F.min("i").alias("least"), F.max("n").alias("n"), F.max("bits").alias("bits"), F.max("wide").alias("wide")), "classes")
    often = (profiles.where("shingle is not null").groupBy("shingle").agg(F.sum("seen").alias("seen"))
             .orderBy(F.desc("seen"), "shingle").limit(FREQUENT).toPandas())
    keys, seen = often["shingle"].to_numpy(np.int64).view(np.uint64), often["seen"].to_numpy(np.int64)
    rarest = np.lexsort((keys, seen))
    shared = spark.sparkContext.broadcast((keys[rarest], -(-seen[rarest] // TILE)))

    def firsts(batches):
        """The distinct sets of each batch: fingerprint, size, prefix, and ranks of its frequent shingles."""
        done, order = set(), Order(shared.value[0])
        for batch in batches:
            found = []
            for i, s in zip(batch.column("i").to_pylist(), sets_of(batch.column("t"))):
                if i is None or not len(s) or (own := fingerprint(s)) in done:
                    continue
                if len(done) >= SEEN:
                    done.clear()
                done.add(own)
                found.append((own, len(s), *order.prefix(s)))
            yield found

    def dealt(batches):
        held, size = [], 0
        for found in firsts(batches):
            held += [first for _, _, first, _ in found]
            size += sum(len(first) for _, _, first, _ in found)
            if size >= HELD:
                yield _dealt(held)
                held, size = [], 0
        if held:
            yield _dealt(held)

    # Most prefix shingles are of one set alone and meet no other: only the others move with their sets.
    several = materialise(
        rows.mapInArrow(dealt, "bucket long, codes binary").groupBy("bucket").applyInPandas(_several, "key long, n long"), "several")
    segments = max(1, min(MET_BITS // WANTED_SEGMENT, -(-int(several.count() / LOAD) // WANTED_SEGMENT)))
    meeting = spark.sparkContext.broadcast(build(several, segments * WANTED_SEGMENT, WANTED_SEGMENT))

    def prefixes(batches):
        parts, known = shared.value[1], Filter(meeting.value, WANTED_SEGMENT)
        for found in firsts(batches):
            if not found:
                continue
            own, n, first, ranks = zip(*found)
            lengths = np.array([len(f) for f in first])
            keys, ranks = np.concatenate(first), np.concatenate(ranks)
            place = np.arange(len(keys)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            some = np.flatnonzero(known.level(code_of(keys)) > 0)
            sizes = np.repeat(np.array(n, np.int64), lengths)[some]
            columns = (
                as_long(keys[some]), np.repeat(np.array(own, np.int64), lengths)[some], sizes, most_of(sizes, place[some]),
                np.where(ranks[some] >= 0, parts[ranks[some]], 1) if len(parts) else np.ones(len(some), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns], ["key", "set_id", "n", "most", "parts"])

    keyed = rows.mapInArrow(prefixes, "key long, set_id long, n long, most long, parts long").select(
        "key", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("set_id"), "parts")).otherwise(F.lit(0)).cast("int").alias("part"),
        F.col("n").cast("int").alias("n"), F.col("most").cast("int").alias("most"), "set_id", F.col("parts").cast("int").alias("parts"))
    # Copies that several tasks met go; then a row is of use only if a smaller one of its group
    # goes up to its size, or the next larger one is near in size and within what it goes up to, or if its group has several parts.
    order = Window.partitionBy("key", "part").orderBy("n", "set_id")
    fits = lambda small, large: F.coalesce(100 * small >= PERCENT * large, F.lit(False))
    single = keyed.withColumn("again", F.coalesce(F.lag("set_id").over(order) == F.col("set_id"), F.lit(False))).where("not again")
    reach = F.coalesce(F.max("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    above = F.lead("n").over(order)
    near = (reach >= F.col("n")) | fits(F.col("n"), above) & (above <= F.col("most")) | (F.col("parts") > 1)
    tiles = materialise(single.drop("again").withColumn("near", near).where("near").drop("near"), "tiles")

    def bounded(met: DataFrame) -> DataFrame:
        """Of the sets (other) that each set has met, those met most often whose bitmaps let them link."""
        place = F.row_number().over(Window.partitionBy("set_id").orderBy(F.desc("times"), "other"))
        chosen = materialise(met.withColumn("place", place).where(F.col("place") <= PARTNERS).select("set_id", "other"), "chosen")
        asked = _of_pairs(classes.select("set_id", "n", "bits"), chosen.toDF("a", "b"))
        two = asked.select(F.col("set_id").alias("other"), F.col("n").alias("less"), F.col("bits").alias("fewer"))
        both = chosen.join(asked, "set_id").join(two, "other")
        ordered = F.col("less") <= F.col("n")
        columns = [F.when(ordered, F.col(x)).otherwise(F.col(y)).alias(name) for name, x, y in (
            ("set_id", "set_id", "other"), ("other", "other", "set_id"), ("n", "n", "less"), ("less", "less", "n"),
            ("bits", "bits", "fewer"), ("fewer", "fewer", "bits"))]
        return both.select(*columns).mapInArrow(_bounded, "a long, b long")

    # Neighbours in size, over all groups.
    before = F.array(*[
        F.struct(F.lag("set_id", k).over(order).alias("other"), F.lag("n", k).over(order).alias("less"), F.lag("most", k).over(order).alias("up"))
        for k in range(1, PARTNERS + 1)])
    beside = (tiles.select("set_id", "n", "most", before.alias("before")).select("set_id", "n", "most", F.inline("before"))
            .where(fits(F.col("less"), F.col("n")) & (F.col("set_id") != F.col("other")))
            .where((F.col("n") <= F.col("up")) & (F.col("less") <= F.col("most")))
            .groupBy("set_id", "other").agg(F.count("*").alias("times")))

    def joined(stars: DataFrame, more: DataFrame) -> DataFrame:
        """Components of earlier links, known by their stars, and of further ones."""
        return components(stars.toDF("a", "b").unionByName(more))

    stars = components(_verified(bounded(beside), classes, rows))

    def labelled(tiles: DataFrame) -> DataFrame:
        """Tile rows with component labels that may meet a row of another component.

        A key has, among the rows of other labels, a smallest set and one that goes up to the largest size; without a
        row's own label these are the extreme ones of the key, or the next of another label.  What is left out
        now is of no use later, as components only grow.
        """
        own = tiles.drop("label").join(stars.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
            "label", F.coalesce("component", "set_id")).drop("component")
        by_label = materialise(own.groupBy("key", "label").agg(
            F.min("n").alias("low"), F.max("most").alias("high"), F.count("*").alias("size")), "by_label")
        ends = by_label.groupBy("key").agg(
            F.min(F.struct("low", "label")).alias("low1"), F.max(F.struct("high", "label")).alias("high1"),
            F.sum("size").alias("size"), F.min("label").alias("first"), F.max("label").alias("last")).where("first < last")
        second = by_label.drop("size").join(ends, "key").groupBy("key").agg(
            F.first("low1").alias("low1"), F.first("high1").alias("high1"), F.first("size").alias("size"),
            F.min(F.when(F.col("label") != F.col("low1.label"), F.col("low"))).alias("low2"),
            F.max(F.when(F.col("label") != F.col("high1.label"), F.col("high"))).alias("high2"))
        other = lambda edge, one, two: F.when(F.col(f"{one}.label") != F.col("label"), F.col(f"{one}.{edge}")).otherwise(F.col(two))
        meets = (other("low", "low1", "low2") <= F.col("most")) & (other("high", "high1", "high2") >= F.col("n"))
        return materialise(own.join(second, "key").where(meets).select(
            "key", "part", "n", "most", "set_id", "parts", "label", "size"), "labelled")

    # The head of a group is the set of most rows.  Near copies of one text each lack some of its keys, so
    # that text, if it is there, is the head of most of their groups, and links most of them.
    left = labelled(tiles)
    weight = left.groupBy("set_id").agg(F.count("*").alias("weight"))
    weighed = left.join(weight, "set_id")
    head = weighed.groupBy("key").agg(F.max(F.struct("weight", "set_id", "n", "most", "label")).alias("h"))
    tried = (weighed.join(head, "key").where(F.col("label") != F.col("h.label"))
             .where(fits(F.least("n", "h.n"), F.greatest("n", "h.n")) & (F.col("n") <= F.col("h.most")) & (F.col("h.n") <= F.col("most")))
             .groupBy("set_id", F.col("h.set_id").alias("other")).agg(F.count("*").alias("times")))
    stars = joined(stars, _verified(bounded(tried), classes, rows))
    left = labelled(left.drop("size"))
    # In full: each part against itself and against the others.
    # Keys in the order of their places, which is that of all sets; so what a pair meets under first lets it pass if a later key does.
    by_set = Window.partitionBy("set_id").orderBy(F.desc("most"))
    own = left.join(classes.select("set_id", F.col("bits").alias("narrow"), "wide"), "set_id").withColumn(
        "earlier", F.array(*[F.coalesce(F.lag("key", k).over(by_set), "key") for k in range(1, EARLIER + 1)]))
    crossed = (own.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
               .withColumn("one", F.least("part", "other")).withColumn("two", F.greatest("part", "other"))
               .withColumn("bits", F.when(F.col("size") > 2, F.col("wide")).otherwise(F.col("narrow")))
               .select("key", "one", "two", "part", "label", "set_id", "n", "most", "bits", "earlier")
               .repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "n", "set_id"))
    rest = materialise(crossed.mapInArrow(_candidates, "a long, b long").distinct(), "candidates")

    stars = joined(stars, _verified(rest, classes, rows))

    members = classes.select("set_id", "least").join(stars.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id"))
    named = members.join(members.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("set_id", "component_id")
    return each.select("i", "n", F.when(F.col("i").isNotNull(), F.col("set_id")).alias("set_id")).join(named, "set_id", "left").select(
        F.col("i").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", F.col("i")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id names their component, with all their columns, whatever those are called.

    Rows without words, and of a NULL id, are components of their own and stay; rows repeated
    with the id that names a component all stay.  An empty table gives no rows.
    """
    named = free_prefix(docs) + "id"
    kept = jaccard_groups(docs, id_col, text_col).where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(
        F.col(id_col).alias(named)).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col(named)), "left_semi")

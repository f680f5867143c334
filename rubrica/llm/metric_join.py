"""Near-duplicate vectors by an exact metric range join over pivot cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import components

#: Pivots, the vectors they are chosen from, and the home vectors of a tile.
PIVOTS, SAMPLE, BLOCK = 16, 2_048, 2_048
#: Lengths of vectors, the commonest, that have pivots.
LENGTHS = 1_000
_SLACK = 1e-9


def unit(vectors: list) -> list[np.ndarray]:
    """Vectors of length 1 in double precision; scaled first, so that squares neither overflow nor vanish."""
    out = []
    for v in vectors:
        x = np.asarray(v, np.float64)
        x = x / np.abs(x).max()
        out.append(x / np.sqrt(x @ x))
    return out


def spread_pivots(sample: list[np.ndarray], count: int) -> np.ndarray:
    """Farthest-first choice of pivots."""
    x = np.stack(sample)
    chosen, near = [0], np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < min(count, len(x)) and near.max() > 1e-6:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


class Cells:
    """Pivot cells of vectors of one dimension, each in blocks of bounded size."""

    def __init__(self, pivots: np.ndarray, radius: float):
        self.pivots, self.radius = pivots, radius
        self.apart = np.linalg.norm(pivots[:, None] - pivots[None], axis=2)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to the pivots."""
        return np.maximum(2.0 - 2.0 * (x @ self.pivots.T), 0.0)

    def home(self, squares: np.ndarray) -> np.ndarray:
        return squares.argmin(axis=1)

    def visited(self, squares: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Cells of higher number that may hold a vector within the radius.

        Of two linked vectors in cells i and j, the first is no farther than the radius
        from the plane halfway between both pivots (triangle inequality with the point
        where their line crosses it); that distance is (dj^2 - di^2) / (2 dij).
        """
        own = np.take_along_axis(squares, home[:, None], 1)
        reach = squares - own <= 2 * self.radius * self.apart[home] + _SLACK
        return reach & (np.arange(len(self.pivots)) > home[:, None])


def _tile(home, own_counts, visitor, visitor_counts, threshold):
    """Links between visitors and the home vectors of a tile: weights on both sides, pairs to connect."""
    close = visitor @ home.T >= threshold
    return close @ own_counts, visitor_counts @ close, close


class Forest:
    """Which home vectors of a tile are known to be connected."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def connect(self, close: np.ndarray, pairs: list) -> np.ndarray:
        """For rows of links to home vectors: the first one of each row, or -1; other links that connect anew go to pairs."""
        first = np.where(close.any(axis=1), close.argmax(axis=1), -1)
        for row in range(len(close)):
            if first[row] < 0:
                continue
            labels = self.label[close[row]]
            if (labels != labels[0]).any():
                linked = np.flatnonzero(close[row])
                fresh, at = np.unique(self.label[linked], return_index=True)
                pairs.extend((linked[i], first[row]) for i in at if linked[i] != first[row])
                self.label[np.isin(self.label, fresh)] = fresh[0]
        return first


def _joined(threshold: float):
    """Arrow batches sorted by (tile, role) to rows (a, b, links): link counts of a, or a pair (a, b) to connect."""

    def rows(batches):
        tile, home, nodes, weights, forest, degree, fresh = None, [], None, None, None, None, True

        def batch_of(a, b, n):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(a, np.int64)), pa.array(b, pa.int64()) if b is None else pa.array(np.asarray(b, np.int64)),
                 pa.array(np.asarray(n, np.int64))], ["a", "b", "links"])

        def counts(ids, degrees):
            some = degrees > 0
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.nulls(int(some.sum()), pa.int64()), pa.array(degrees[some].astype(np.int64))],
                ["a", "b", "links"])

        def close_home():
            """All home vectors of the tile are here: their links among themselves."""
            nonlocal nodes, weights, forest, degree, matrix
            matrix = np.concatenate([h[0] for h in home])
            nodes = np.concatenate([h[1] for h in home])
            weights = np.concatenate([h[2] for h in home])
            forest, pairs = Forest(len(nodes)), []
            close = matrix @ matrix.T >= threshold
            np.fill_diagonal(close, True)
            degree = close @ weights - weights
            first = forest.connect(close, pairs)
            ends = [(i, f) for i, f in enumerate(first) if i != f] + pairs
            if ends:
                i, j = np.array(ends).T
                yield batch_of(nodes[i], nodes[j], np.zeros(len(i)))

        matrix = None
        for batch in batches:
            tiles = batch.column("tile").to_numpy()
            roles = batch.column("role").to_numpy()
            ids, w = batch.column("node").to_numpy(), batch.column("m").to_numpy()
            vectors = batch.column("unit").to_pylist()
            cuts = np.flatnonzero(np.append(True, (np.diff(tiles) != 0) | (np.diff(roles) != 0)))
            for lo, hi in zip(cuts, [*cuts[1:], len(tiles)]):
                if tile != tiles[lo]:
                    if tile is not None and home:
                        if nodes is None:
                            yield from close_home()
                        yield counts(nodes, degree)
                    tile, home, nodes = tiles[lo], [], None
                part = np.frombuffer(b"".join(vectors[lo:hi]), np.float64).reshape(hi - lo, -1)
                if roles[lo] == 0:
                    home.append((part, ids[lo:hi], w[lo:hi]))
                    continue
                if not home:
                    continue
                if nodes is None:
                    yield from close_home()
                mine, theirs, close = _tile(matrix, weights, part, w[lo:hi], threshold)
                degree = degree + theirs
                yield counts(ids[lo:hi], mine)
                pairs: list = []
                first = forest.connect(close, pairs)
                some = np.flatnonzero(first >= 0)
                a, b = [ids[lo + some]], [nodes[first[some]]]
                if pairs:
                    i, j = np.array(pairs).T
                    a.append(nodes[i])
                    b.append(nodes[j])
                a, b = np.concatenate(a), np.concatenate(b)
                if len(a):
                    yield batch_of(a, b, np.zeros(len(a)))
        if tile is not None and home:
            if nodes is None:
                yield from close_home()
            yield counts(nodes, degree)

    return rows


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, pivots: int = PIVOTS, sample: int = SAMPLE, block: int = BLOCK,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(id, n_links, component_id, kept) of each row; links are pairs with cosine >= threshold.

    Equal vectors form a class first, so copies cost a count.  Unit vectors go to the cell
    of their nearest pivot, and to those cells of higher number whose boundary plane lies
    within the radius of the threshold; so each linked pair meets in exactly one cell.  A
    cell is cut into blocks of about `block` home vectors.  A tile is a block and all its
    visitors, which stream past it; it emits link counts, and of the links only those that
    connect something new.  All cosines are of double precision.

    NULL and empty vectors, zero vectors and such with NULL or non-finite components link
    with nothing, nor do vectors of different lengths; each is a component of its own.
    Rows of one vector link with each other, NULL ids too; the smallest id that is not
    NULL names a component, and a row without id is kept if nothing else names it.  An
    empty table gives no rows.  The commonest LENGTHS lengths of vectors have pivots, each
    other length is one cell.  The driver holds `sample` vectors at most, counts of cells, and
    pivots of each length.  Comparisons grow with the square of the input where vectors have no clusters
    that pivots could tell apart; rows moved grow with the visitors.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    radius = float(np.sqrt(max(2.0 - 2.0 * threshold, 0.0))) + _SLACK
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    good = F.expr(
        "v is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) "
        "and exists(v, x -> x <> 0)")
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    classes = materialise(
        rows.where("good").groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("m"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    sizes = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d")
    dims = [r["d"] for r in sizes.collect()]
    cells = {d: Cells(np.eye(1, d), radius) for d in dims[LENGTHS:]}
    for d in dims[:LENGTHS]:
        own = classes.where(F.size("v") == d).orderBy(F.xxhash64("v"), "node").limit(sample).select("v").collect()
        cells[d] = Cells(spread_pivots(unit([r["v"] for r in own]), pivots), radius)
    base, first = 0, {}
    for d in dims:
        first[d] = base
        base += len(cells[d].pivots)

    def homes(batches):
        for batch in batches:
            units = unit(batch.column("v").to_pylist())
            cell = [first[len(u)] + int(cells[len(u)].home(cells[len(u)].distances(u[None]))[0]) for u in units]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("m"), pa.array([u.tobytes() for u in units], pa.binary()),
                 pa.array(cell, pa.int32())], ["node", "m", "unit", "cell"])

    placed = materialise(classes.select("v", "node", "m").mapInArrow(homes, "node long, m long, unit binary, cell int"), "placed")
    blocks = {r["cell"]: -(-r["n"] // block) for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    starts, tiles = {}, 0
    for c in sorted(blocks):
        starts[c], tiles = tiles, tiles + blocks[c]

    def tiled(batches):
        for batch in batches:
            node, cell = batch.column("node").to_numpy(), batch.column("cell").to_numpy()
            raw, who, tile, role = batch.column("unit").to_pylist(), [], [], []
            for i, (u, c) in enumerate(zip(raw, cell)):
                x = np.frombuffer(u, np.float64)
                own = cells[len(x)]
                local = np.array([c - first[len(x)]])
                mine = int(node[i] * 0x9E3779B1 >> 7) % blocks[c]
                visits = [starts[c] + b for b in range(mine + 1, blocks[c])]
                for j in np.flatnonzero(own.visited(own.distances(x[None]), local)[0]):
                    other = first[len(x)] + int(j)
                    visits.extend(range(starts.get(other, 0), starts.get(other, 0) + blocks.get(other, 0)))
                who.extend([i] * (1 + len(visits)))
                tile.extend([starts[c] + mine, *visits])
                role.extend([0] + [1] * len(visits))
            for at in range(0, len(who), 8_192):
                some = pa.array(who[at:at + 8_192], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tile[at:at + 8_192], pa.int32()), pa.array(role[at:at + 8_192], pa.int32()),
                     *[batch.column(k).take(some) for k in ("node", "m", "unit")]], ["tile", "role", "node", "m", "unit"])

    pieces = (placed.mapInArrow(tiled, "tile int, role int, node long, m long, unit binary")
              .repartition("tile").sortWithinPartitions("tile", "role"))
    found = materialise(pieces.mapInArrow(_joined(threshold), "a long, b long, links long"), "found")
    degrees = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    stars = components(found.where("b is not null").select("a", "b"))
    members = classes.select("node", "least").join(stars, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = members.groupBy("component").agg(F.min("least").alias("component_id"))
    per_class = (classes.select("v", "node", "m").join(degrees, "node", "left")
                 .join(members.select("node", "component"), "node").join(named, "component")
                 .select("v", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id"))
    linked = rows.where("good").join(per_class, "v").select("id", "n_links", "component_id")
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

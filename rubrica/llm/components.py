"""Connected components of a graph given as a table of links."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Links that a task contracts at least, if there are so many, and nodes that it holds at most (speed alone).
LINKS, NODES = 1 << 14, 1 << 20


def _lowest(pairs: DataFrame) -> DataFrame:
    """The smallest neighbour of each node; partial minima are taken before the shuffle."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _are_stars(links: DataFrame) -> bool:
    """Whether each node either hooks to one smaller node or is hooked to, and never both.

    Sums of counts by node, combined on the map side; one row comes back.
    """
    ends = links.select("u", F.lit(1).alias("hooks"), F.lit(0).alias("hooked")).unionByName(
        links.select(F.col("v").alias("u"), F.lit(0).alias("hooks"), F.lit(1).alias("hooked")))
    by_node = ends.groupBy("u").agg(F.sum("hooks").alias("hooks"), F.max("hooked").alias("hooked"))
    return by_node.agg(F.max(F.col("hooks") + F.col("hooked"))).first()[0] in (None, 1)


def _forests(batches):
    """Links (u, v) to stars: each node with the smallest that the links of the task reach from it, NODES nodes at a time."""
    root = {}

    def least(node):
        while root[node] != node:
            root[node] = node = root[root[node]]
        return node

    def stars():
        found = [(node, least(node)) for node in root]
        found = [(node, top) for node, top in found if node != top]
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k in (0, 1)], ["u", "v"])

    kind = None
    for batch in batches:
        kind = batch.column("u").type
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            one, two = least(root.setdefault(u, u)), least(root.setdefault(v, v))
            root[max(one, two)] = min(one, two)
        if len(root) >= NODES:
            yield stars()
            root.clear()
    if root:
        yield stars()


def _contracted(links: DataFrame) -> DataFrame:
    """Fewer links (u, v) with the same components: each task makes stars of its own, which shortens chains without a shuffle."""
    tasks = 1 + links.count() // LINKS
    kind = links.schema["u"].dataType.simpleString()
    return materialise(links.coalesce(tasks).mapInArrow(_forests, f"u {kind}, v {kind}"), "forests")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of links (a, b); the component is its smallest node.

    Rounds of large-star and small-star (Kiveris et al., 2014): each node hooks its larger
    neighbours, then its smaller ones, to the smallest it knows, until links are stars.
    Stars of earlier links, given with further ones, save their rounds.  Before each round, tasks contract
    the links that they hold, a bounded number, so chains take few rounds.
    No group is gathered: minima are aggregated, and the joins back to them are split by
    AQE where a hub holds many links.  Self links and NULLs are ignored; a table without
    links gives no rows.
    """
    now = _contracted(materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links"))
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = _lowest(large)
        joined = large.join(low, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = _contracted(materialise(small, "links"))
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

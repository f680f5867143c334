"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_prefix, materialise

WEIGHTS = (3, 1, 2)
WORDS = r"[^\x20\x09-\x0D]+"


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on key and seed alone; NULL keys share one."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: int = 2) -> DataFrame:
    """(source, source_size, target) from (source, size): water filling under a cap.

    Sources in order of code points, NULL last, take the weights in turn and divide
    `share` of all sizes.  A source stops at `cap` times its size and the excess goes to
    the others by weight.  Sorted by size per weight, the sources that stop are the first
    ones; the level of the rest follows from sums over that order.  The sources, one
    row each, meet in one task.
    """
    whole = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    w = whole.withColumn("turn", turn).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("turn") - 1) % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "turn")
    before = F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(share) - before * cap) / rest
    leveled = (w.withColumn("level", level).withColumn("place", F.row_number().over(order))
               .withColumn("free", F.col("level") * F.col("weight") <= F.col("source_size") * cap))
    common = F.min_by(F.when(F.col("free"), F.col("level")), F.when(F.col("free"), F.col("place"))).over(everything)
    full = (F.col("source_size") * cap).cast("double")
    return leveled.withColumn("common", common).select(
        "source", "source_size", F.coalesce(F.least(full, F.col("common") * F.col("weight")), full).alias("target"))


def mixed(
    docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: int = 2, seed: str = "mix",
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", prefix: str = "__",
) -> DataFrame:
    """docs with size, source_size, target and copies, the times the mix takes the row; the names begin with `prefix`.

    The size of a text is its number of words.  A row is taken floor(rate) times, rate
    being target over size of its source, and once more with the fraction as probability,
    decided by a hash of seed and id; so reruns agree, and rows of one id are taken alike.
    NULL and empty texts have size 0; NULL sources are one source; a source without words
    has target 0 and is not taken; an empty table gives no rows.  A column of docs that has
    one of the new names is an error.  Two scans; sums are
    combined in each task, and the one row per source is joined as Spark finds fit.
    """
    name = {c: prefix + c for c in ("size", "source", "source_size", "target", "copies")}
    clash = sorted(set(name.values()) & {c.lower() for c in docs.columns})
    if clash:
        raise ValueError(f"docs has columns {clash}; give another prefix")
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")
    goal = materialise(
        targets(docs.select(F.col(source_col).alias("source"), size.alias("size")), weights, share, cap)
        .select(*[F.col(c).alias(name[c]) for c in ("source", "source_size", "target")]), "targets")
    joined = (docs.withColumn(name["size"], size)
              .join(goal, F.col(source_col).eqNullSafe(F.col(name["source"])), "left").drop(name["source"]))
    whole = F.col(name["source_size"])
    rate = F.when(whole > 0, F.col(name["target"]) / whole).otherwise(F.lit(0.0))
    extra = (uniform(F.col(id_col), seed) < rate - F.floor(rate)).cast("long")
    return joined.withColumn(name["copies"], F.floor(rate) + extra)


def taken(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as many times as the mix takes it, with its own columns, whatever they are called.

    Rows of one id are taken alike, so ties and repeated rows are no question; for NULLs and empty tables see `mixed`.
    """
    p = free_prefix(docs)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(p + "copies"))).alias(p + "copy")
    return mixed(docs, **options, prefix=p).where(F.col(p + "copies") > 0).select(*docs.columns, times).drop(p + "copy")

"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_prefix, materialise

#: Bytes of a block; most texts are a few blocks.
BLOCK_BYTES = 8_192


def folded(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; NULL counts as empty.  In ASCII texts that is their lower case."""
    text = F.coalesce(text, F.lit(""))
    ascii_alone = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_alone, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _named(pieces: DataFrame, bucket) -> DataFrame:
    """Give equal keys one integer name, different keys different ones.

    Keys are sorted by (bucket, key); the name of a key is its bucket and its rank there,
    so it depends on the key set alone.  Distinct keys move once, after a combine in each
    task.  Only buckets that hold several keys need ranks: those few keys are sorted, and
    joined back to their places.
    """
    p = pieces.withColumn("bucket", bucket("key"))
    crowded = materialise(
        p.select("bucket", "key").distinct().groupBy("bucket").agg(F.count("*").alias("n"))
        .where("n > 1").select("bucket"), "crowded")
    if crowded.isEmpty():
        return p.drop("key").withColumn("place", F.lit(1))
    ranks = materialise(
        p.join(crowded, "bucket", "left_semi").select("bucket", "key").distinct()
        .withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy("key"))), "ranks")
    return (p.join(ranks, ["bucket", "key"], "left").drop("key")
            .withColumn("place", F.coalesce("place", F.lit(1))))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
    bucket=F.xxhash64,
) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z; of equal texts the row of largest
    id stays.  Each text is cut into blocks of fixed size, blocks get integer names, then
    neighbouring names are paired and the pairs named, until one name is left: equal for
    equal texts of a length, and for no others, whatever `bucket` maps together.  A name is
    a 64-bit hash and, only where several keys share it, the rank of the key among those sorted.

    NULL texts count as empty.  A NULL id is smaller than all others; if a group has no
    other, its keep_id is NULL.  Rows repeated with id and text all come back, and one of
    them is kept.  An empty table gives no rows; other columns are not read.  Shuffles:
    distinct blocks once, then a few integers per block.  A group of any size costs one
    row per task in the naming, and the last join, which AQE splits.
    """
    body = docs.select(F.col(id_col).alias("id"), folded(F.col(text_col)).cast("binary").alias("body"))
    cut = body.select(
        "id", F.sha2("body", 256).alias("sha"), F.octet_length("body").alias("size"),
        F.expr(f"transform(sequence(0, greatest(octet_length(body) - 1, 0) div {block_bytes}), "
               f"i -> substring(body, cast(i * {block_bytes} + 1 as int), {block_bytes}))").alias("blocks"))
    pieces = cut.select("id", "sha", "size", F.posexplode("blocks").alias("pos", "key"))
    # Folding keeps lengths, so the longest text needs none.
    longest = docs.agg(F.max(F.octet_length(F.col(text_col)))).first()[0] or 0
    row = ["id", "sha", "size"]
    names = materialise(
        _named(pieces, bucket).groupBy(*row, "pos", "bucket", "place").agg(F.count("*").alias("copies")), "names")
    left = max(1, -(-longest // block_bytes))
    done = None
    while left > 1:
        # Rows whose text is one name already wait; the others pair up.
        finished = names.where(F.col("single")) if "single" in names.columns else None
        count = F.max("pos").over(Window.partitionBy(*row)) if finished is None else None
        if finished is None:
            names = names.withColumn("single", count == 0)
            finished = names.where("single")
        done = finished if done is None else done.unionByName(finished)
        name = F.struct("bucket", "place")
        pairs = (names.where("not single")
                 .groupBy(*row, F.expr("cast(pos div 2 as int)").alias("half"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, name)).alias("a"),
                      F.max(F.when(F.col("pos") % 2 == 1, name)).alias("b"),
                      F.max("copies").alias("copies"))
                 .select(*row, F.col("half").alias("pos"), "copies", F.struct("a", "b").alias("key")))
        left = -(-left // 2)
        names = materialise(
            _named(pairs, bucket).withColumn("single", F.max("pos").over(Window.partitionBy(*row)) == 0), "names")
    whole = names if done is None else done.unionByName(names)
    identity = ["size", "bucket", "place"]
    whole = whole.select("id", "sha", *identity, "copies")
    groups = whole.groupBy(*identity).agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    each = (whole.join(groups, identity)
            .select("*", F.explode(F.expr("sequence(1L, copies)")).alias("copy")))
    return each.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that exact_groups keeps, with all their columns, whatever those are called.

    NULL texts count as empty, and a NULL id as the smallest.  Of rows that share id and text
    the least by all their other columns stays, so reruns agree; maps and other columns
    that have no order are not looked at.  An empty table gives no rows.  Texts move once,
    the rows of one id and text combined in each task.
    """
    p = free_prefix(docs)
    key, own, row = p + "key", p + "own", p + "row"
    # Ids as text without NULLs, so that the grouping and the join below share one exchange.
    of = lambda c: F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))
    stay = exact_groups(docs, id_col, text_col).where("kept").select(
        of(F.col(id_col)).alias(key), F.col("text_sha256").alias(own)).distinct()
    sortable = [f.name for f in docs.schema if _has_order(f.dataType)]
    others = [c for c in docs.columns if c not in sortable]
    order = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(sortable)])
    least = F.min(order) if not others else F.min_by(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]), order)
    names = docs.columns if others else sortable
    one = docs.groupBy(of(F.col(id_col)).alias(key), F.sha2(folded(F.col(text_col)).cast("binary"), 256).alias(own)).agg(least.alias(row))
    kept = one.join(stay, [key, own], "left_semi")
    at = {c: i for i, c in enumerate(names)}
    return kept.select(*[F.col(f"{row}.c{at[c]}").alias(c) for c in docs.columns])


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))

"""URL verdicts from rules and, beyond them, from a tree of path templates per host."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Levels of a path that get their own branches; what lies deeper is one wildcard.
DEPTH = 4
#: A segment stays a literal with so many pages and such a share of its parent's pages.
SUPPORT, SHARE = 5, 0.05
#: Smoothing of a template's share of blocked pages, and the share that rejects it.
PRIOR, REJECT = 4.0, 0.9


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules, pick) -> Column:
    """pick(rule) of the longest rule (action, host, path) that fits host and path, else NULL."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        _, host, path = rule
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        found = F.when(fits, F.lit(pick(rule))).otherwise(found)
    return found


def shape(segment: Column) -> Column:
    """The wildcard of a variable segment; numbers and extensions stay visible."""
    return (F.when(segment.rlike("^[0-9]+$"), F.lit("{n}"))
            .when(segment.rlike("^[0-9]+[.][a-z]+$"), F.concat(F.lit("{n}"), F.regexp_extract(segment, "[.][a-z]+$", 0)))
            .otherwise(F.lit("{*}")))


def templates(paths: DataFrame, depth: int = DEPTH, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """paths (host, path, n, ...) with `template`: level by level, rare segments become wildcards."""
    state = paths.withColumn("__s", F.split("path", "/")).withColumn("template", F.lit(""))
    for level in range(1, depth + 1):
        state = materialise(state.withColumn("__seg", F.get("__s", F.lit(level))), "templates")
        counts = state.where("__seg is not null").groupBy("host", "template", "__seg").agg(F.sum("n").alias("__n"))
        totals = counts.groupBy("host", "template").agg(F.sum("__n").alias("__all"))
        literal = (counts.join(totals, ["host", "template"])
                   .where((F.col("__n") >= support) & (F.col("__n") >= F.col("__all") * share))
                   .select("host", "template", "__seg", F.lit(True).alias("__literal")))
        piece = F.when(F.col("__literal"), F.col("__seg")).otherwise(shape(F.col("__seg")))
        state = (state.join(literal, ["host", "template", "__seg"], "left")
                 .withColumn("template", F.when(F.col("__seg").isNull(), F.col("template"))
                             .otherwise(F.concat("template", F.lit("/"), piece)))
                 .drop("__seg", "__literal"))
    deeper = F.when(F.size("__s") > depth + 1, F.concat("template", F.lit("/{**}"))).otherwise(F.col("template"))
    return state.withColumn("template", deeper).drop("__s")


def verdicts(
    pages: DataFrame, rules, depth: int = DEPTH, support: int = SUPPORT, share: float = SHARE,
    prior: float = PRIOR, reject: float = REJECT, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, template, purity, verdict) of each page.

    The longest rule that fits decides and labels its pages.  Pages are counted by host
    and path; per host, a tree of path segments keeps frequent segments and turns the
    others into wildcards.  Templates of a host that differ in literals alone and whose
    smoothed shares of blocked labels fall into the same tenth are merged.  Where no rule
    fits, a page is blocked if its merged template's share, smoothed towards that of all
    labelled pages, reaches `reject`.

    A NULL url, or one without "://", has empty host and path, fits no rule unless one is
    empty too, and forms a template of its own.  Repeated rows and NULL ids pass through;
    other columns are not read; an empty table gives no rows.  Counts are combined in each
    task; a hot host is a key of no shuffle by itself except in joins, which AQE splits.
    """
    seen = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    seen = (seen.withColumn("rule", rule_of(rules, lambda r: r[1] + r[2]))
            .withColumn("said", rule_of(rules, lambda r: r[0])))
    labelled, blocked = F.count("said"), F.count(F.when(F.col("said") == "block", 1))
    paths = seen.groupBy("host", "path").agg(
        F.count("*").alias("n"), labelled.alias("labelled"), blocked.alias("blocked"))
    tree = materialise(templates(paths, depth, support, share), "tree")
    sums = [F.sum(c).alias(c) for c in ("labelled", "blocked")]
    each = tree.groupBy("host", "template").agg(*sums)
    whole = tree.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias("all_" + c) for c in ("labelled", "blocked")])
    base = F.when(F.col("all_labelled") > 0, F.col("all_blocked") / F.col("all_labelled")).otherwise(F.lit(0.0))

    def purity() -> Column:
        return (F.col("blocked") + prior * F.col("base")) / (F.col("labelled") + F.lit(prior))

    first = whole.select(base.alias("base")).first()[0]
    each = (each.withColumn("base", F.lit(float(first)))
            .withColumn("skeleton", F.regexp_replace("template", "/[^{/]+", "/*"))
            .withColumn("tenth", F.floor(purity() * 10)))
    alike = ["host", "skeleton", "tenth"]
    merged = each.groupBy(*alike, "base").agg(*sums).select(*alike, purity().alias("purity"))
    judged = each.join(merged, alike).select("host", "template", "purity")
    by_path = tree.select("host", "path", "template").join(judged, ["host", "template"])
    by_method = F.when(F.col("purity") >= reject, F.lit("block")).otherwise(F.lit("allow"))
    return seen.join(by_path, ["host", "path"]).select(
        F.col("id").alias(id_col), "host", "path", "rule", "template", "purity",
        F.coalesce("said", by_method).alias("verdict"))

"""Quality rules: fixed limits on text statistics, then a decision list learned by sequential covering."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, remainder

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Length of the windows whose repetition is counted.
WINDOW = 8
#: Labelled rows that the list is learned from, at most.
SAMPLE = 20_000
#: Shares of rows between the candidate thresholds of a feature.
CUTS = (0.01, 0.02, 0.05, *[k / 20 for k in range(2, 19)], 0.95, 0.98, 0.99)
#: Rules of a list, conditions of a rule, rows of the rejected class that a rule catches at least, and its share of them.
MAX_RULES, MAX_CONDITIONS, SUPPORT, PRECISION = 16, 4, 5, 0.9

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(rows: DataFrame, text_col: str = "t") -> DataFrame:
    """rows with STATISTICS and n_lines, n_distinct, n_chars of the text; see `judged`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = rows.withColumn("__t", text).withColumn(
        "__w", F.filter(F.split("__t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    ).withColumn("__l", F.filter(F.split("__t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("__w")
    # A window is repeated if its hash is; most texts repeat none and go no further.
    hashed = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("__w", i, WINDOW)))
    rows = rows.withColumn("__h", F.when(n > WINDOW, hashed))
    placed = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), placed))
    alike = lambda e, i, step: F.coalesce(F.get("__s", i + step)["h"] == e["h"], F.lit(False))
    repeated = F.filter("__s", lambda e, i: alike(e, i, 1) | ((i > 0) & alike(e, i, -1)))
    rows = rows.withColumn("__p", F.sort_array(F.transform(repeated, lambda e: e["i"])))
    # Windows in order of their places: each adds the words beyond the one before it.
    start = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "__p", start, lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(WINDOW), p - a["at"])).alias("n")),
        lambda a: a["n"])
    length = F.char_length("__t")
    return rows.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.char_length(F.translate("__t", SPACES, "")).cast("long"),
        "n_symbols": (length - F.char_length(F.translate("__t", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "n_lines": F.size("__l").cast("long"),
        "n_distinct": F.size(F.array_distinct("__w")).cast("long"),
        "n_chars": length.cast("long"),
    }).drop("__t", "__w", "__l", "__h", "__s", "__p")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def features() -> dict[str, Column]:
    """What conditions are about: shares, which do not grow with the text, and its length."""
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "words": F.col("n_words").cast("double"), "chars_per_word": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"), "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"), "words_per_line": per("n_words", "n_lines"),
        "distinct_share": per("n_distinct", "n_words"), "word_char_share": per("word_chars", "n_chars"),
    }


@dataclass(frozen=True)
class Condition:
    """feature > cut, or feature <= cut."""

    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


def conjunction(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def number_of(rules) -> Column:
    """1, 2, ... of the first rule that fits, 0 without one."""
    out = F.lit(0)
    for k in range(len(rules), 0, -1):
        out = F.when(conjunction(rules[k - 1]), F.lit(k)).otherwise(out)
    return out


def text_of(rules) -> Column:
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(conjunction(rule), F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def foil(p: int, n: int, of_p: int, of_n: int) -> float:
    """Information gained on the rows that a rule rightly catches, when it goes from (of_p, of_n) to (p, n)."""
    return p * (math.log2(p / (p + n)) - math.log2(of_p / (of_p + of_n))) if p else 0.0


def thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Candidate cuts per feature: exact quantiles, each once."""
    shares = F.array(*map(F.lit, CUTS))
    found = rows.agg(*[F.percentile(c, shares).alias(f) for f, c in features().items()]).first()
    return {f: sorted(set(found[f] or ())) for f in features()}


def candidates(rows: DataFrame, cuts) -> list[tuple[Condition, int, int]]:
    """(condition, p, n): rows of the rejected class and others that each condition holds, from one aggregation."""
    bins = F.array(*[
        F.struct(F.lit(f).alias("f"), sum([F.when(features()[f] > F.lit(c), 1).otherwise(0) for c in cuts[f]], F.lit(0)).alias("b"))
        for f in cuts])
    counted = rows.select("bad", F.explode(bins).alias("x")).groupBy("x.f", "x.b").agg(
        F.count(F.when(F.col("bad"), 1)).alias("p"), F.count(F.when(~F.col("bad"), 1)).alias("n"))
    held = {(r["f"], r["b"]): (r["p"], r["n"]) for r in counted.collect()}
    out = []
    for f in cuts:
        sums = [(0, 0)]
        for b in range(len(cuts[f]) + 1):
            p, n = held.get((f, b), (0, 0))
            sums.append((sums[-1][0] + p, sums[-1][1] + n))
        for k, cut in enumerate(cuts[f]):
            low, all_ = sums[k + 1], sums[-1]
            out.append((Condition(f, False, cut), *low))
            out.append((Condition(f, True, cut), all_[0] - low[0], all_[1] - low[1]))
    return out


def counts(rows: DataFrame, wheres) -> list[tuple[int, int]]:
    """(p, n) of the rows that meet each of some conjunctions."""
    sums = []
    for w in wheres:
        held = conjunction(w)
        sums += [F.count(F.when(held & F.col("bad"), 1)), F.count(F.when(held & ~F.col("bad"), 1))]
    flat = rows.agg(*sums).first()
    return list(zip(flat[::2], flat[1::2]))


def grown(rows: DataFrame, cuts) -> list[Condition]:
    """Conditions added one by one, each the one of most gain, until no other row is caught."""
    rule, (p, n) = [], counts(rows, [[]])[0]
    while p and n and len(rule) < MAX_CONDITIONS:
        found = [(foil(cp, cn, p, n), cp, cn, c) for c, cp, cn in candidates(rows, cuts)]
        gain, cp, cn, best = max(found, key=lambda x: x[0], default=(0.0, 0, 0, None))
        if gain <= 0:
            break
        rule.append(best)
        rows, p, n = rows.where(best.column()), cp, cn
    return rule


def pruned(rows: DataFrame, rule) -> list[Condition]:
    """The beginning of the rule with the best (p - n) / (p + n) on rows it was not grown on; the shortest among equals."""
    starts = [rule[:k] for k in range(1, len(rule) + 1)]
    worth = [(p - n) / (p + n) if p + n else 0.0 for p, n in counts(rows, starts)]
    return starts[worth.index(max(worth))]


def learned(rows: DataFrame) -> list[list[Condition]]:
    """The rules in order, from rows with the statistics, `bad` and `prune`.

    Each rule is grown on the rows that no earlier one caught and pruned on those set
    aside.  Learning ends when no rows are left, a rule catches fewer than SUPPORT of the
    rejected class, or under PRECISION of what it catches is of that class.
    """
    rules, left = [], rows
    cuts = thresholds(rows.where("not prune"))
    while len(rules) < MAX_RULES:
        rule = grown(left.where("not prune"), cuts)
        if not rule:
            break
        rule = pruned(left.where("prune"), rule)
        p, n = counts(left, [rule])[0]
        if p < SUPPORT or p < PRECISION * (p + n):
            break
        rules.append(rule)
        left = left.where(~conjunction(rule))
    return rules


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> DataFrame:
    """Statistics, `bad` and `prune` of the learning rows: one row per id, at most `sample`."""
    fold = remainder(F.col("i"))
    said = labels.select(F.col(id_col).alias("i"), F.col("quality").cast("int").alias("q")).where(
        F.col("i").isNotNull() & F.col("q").isin(0, 1) & (fold != 0))
    picked = materialise(
        said.groupBy("i").agg(F.min("q").alias("q")).orderBy(F.xxhash64("i"), "i").limit(sample)
        .select(F.col("i").alias("j"), (F.col("q") == 0).alias("bad"), (fold == 4).alias("prune")), "picked")
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    joined = with_statistics(texts.join(F.broadcast(picked), F.col("i") == F.col("j")))
    kept = [*STATISTICS, "n_lines", "n_distinct", "n_chars", "bad", "prune"]
    one = joined.groupBy("i").agg(F.min(F.struct(*kept)).alias("s")).select("s.*")
    return materialise(one.where(~base_failed()), "labelled")


def judged(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, STATISTICS, base_failed, held_out, rule_number, rule, kept) of each row.

    A text fails at once with under 20 words, or with more than 30 % of them in windows of 8
    words that it holds twice.  For the others a decision list is learned from the
    rows labelled 0 or 1 in `quality` whose CRC-32 remainder is not 0, at most `sample` of
    them, chosen by a hash of the id: conjunctions of thresholds on shares, each grown for
    quality 0 by information gain and pruned on the rows of remainder 4.  The list is a chain of
    conditional expressions; a text goes if one of its rules fits.

    NULL and empty texts have no words and fail.  NULL ids and labels are not learned from; an id
    labelled twice counts as 0 if one label says so, and one of its texts is learned from; without
    labels of both kinds the list is empty.  Repeated rows pass through; other
    columns are not read; an empty table gives no rows.  Windows are compared by 64-bit
    hashes.  One scan of all texts without a shuffle, and one of the labelled ones.
    """
    rules = learned(labelled(docs, labels, id_col, text_col, sample))
    rows = with_statistics(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")))
    held = rows.withColumn("base_failed", base_failed()).withColumn("rule_number", number_of(rules))
    by_list = ~F.col("base_failed") & (F.col("rule_number") > 0)
    return held.select(
        F.col("i").alias(id_col), *STATISTICS, "base_failed", (remainder(F.col("i")) == 0).alias("held_out"),
        F.when(by_list, F.col("rule_number")).otherwise(F.lit(0)).alias("rule_number"), F.when(by_list, text_of(rules)).alias("rule"),
        (~F.col("base_failed") & (F.col("rule_number") == 0)).alias("kept"))

"""Filter audit, target resampling and quality rules against brute force in plain Python."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rubrica.llm import filter_audit, oracles, quality_rules, target_resampling

from .test_operators import docs, none, rows  # noqa: F401  (fixtures)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def label_rows(rows):
    rng = random.Random(3)
    made = [(i, rng.choice([0, 1, 1, None]), rng.choice([0, 0, 1, None]), "x") for i, *_ in rows]
    return made + [(None, 1, 1, "x"), (3, 1, 1, "x")]


LABELS = "doc_id long, quality int, toxic int, n_words string"


@pytest.fixture(scope="module")
def labels(spark, rows):  # noqa: F811
    return spark.createDataFrame(label_rows(rows), LABELS)


# -- filter audit ------------------------------------------------------------------


def measures(text):
    words = WORD.findall(text)
    return (len(words), len(set(words)), sum("A" <= c <= "Z" for c in text), len(text), sum(c in "#$%&*|" for c in text))


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 20])
def test_transducer(piece):
    rng = random.Random(piece)
    letters = "aAbZé ß中😀 \t\n\x0b\x0c\r\x1c\xa0#$%&*|"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += ["", " ", "a", "word " * 500, "x" * 900 + " " + "x" * 900 + " " + "x" * 899 + "y", "a b\x00 a b\x00 a b"]
    got = filter_audit.Transducer(piece).measure([t.encode() for t in texts])
    assert [tuple(r) for r in got.tolist()] == [measures(t) for t in texts]


def test_words_of_one_hash_are_told_apart():
    text = np.frombuffer(b"aa bb aa cc bb" + b" " * 9, np.uint8)
    start, length = np.array([0, 3, 6, 9, 12]), np.full(5, 2)
    first = filter_audit.first_of_each(text, start, length, np.zeros(5, np.uint64), np.zeros(5, np.int64))
    assert first.tolist() == [True, True, False, True, False]


def audit(rows, labels):
    good = {i for i, q, t, *_ in labels if i is not None and q == 1}
    bad = {i for i, q, t, *_ in labels if i is not None and t == 1}
    ids = collections.defaultdict(list)
    for i, t, *_ in rows:
        if i is not None:
            ids[t or ""].append(i)
    fails = collections.defaultdict(list)
    for i, t, lang, *_ in rows:
        words, distinct, capitals, points, marks = measures(t or "")
        copied = i is not None and min(ids[t or ""]) < i
        held = [words < 100, 100 * distinct < 80 * words, 100 * capitals > 10 * points, marks > 0, copied]
        fails[lang or ""].append((i, {f for f, h in zip("ABCDE", held) if h}))
    out = set()
    for part, members in fails.items():
        alone = {f: sum(m == {f} for _, m in members) for f in "ABCDE"}
        first = collections.Counter()
        lines = []
        for order in itertools.permutations("ABCDE"):
            left = list(members)
            for step, f in enumerate(order, 1):
                gone = [(i, m) for i, m in left if f in m]
                left = [(i, m) for i, m in left if f not in m]
                first[f] += len(gone)
                redundant = sum(f in m for _, m in members) - len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), redundant, alone[f],
                              sum(i in good for i, _ in gone), sum(i in bad for i, _ in gone)))
        out |= {(*line, first[line[1][line[2] - 1]]) for line in lines}
    return out


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit(spark, docs, none, rows, labels):  # noqa: F811
    got = filter_audit.audited(docs, labels)
    assert got.columns == list(COLUMNS)
    assert [t for _, t in got.dtypes[3:]] == ["bigint"] * 7
    found = {tuple(r) for r in got.collect()}
    assert found == audit(rows, label_rows(rows))
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    con.register("labels", labels.toPandas().astype({"doc_id": "Int64", "quality": "Int64", "toxic": "Int64"}))
    sql = con.execute(oracles.AUDIT)
    assert [c[0] for c in sql.description] == list(COLUMNS)
    assert set(sql.fetchall()) == found
    assert filter_audit.audited(none, labels).count() == 0
    unlabelled = filter_audit.audited(docs, labels.limit(0))
    assert unlabelled.agg(F.sum("good_lost")).first()[0] == 0


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_hot_copies_are_broadcast_and_others_joined(spark, most):
    made = [(i, b"h" if i % 3 == 0 else b"c" if i < 20 else b"%d" % i) for i in range(90)] + [(None, b"h"), (None, b"n")]
    rows = spark.createDataFrame(made, "i long, digest binary")
    got = {(r.i, r.copied) for r in filter_audit.with_earlier_copy(rows, most).collect()}
    least = {}
    for i, d in made:
        if i is not None:
            least[d] = min(i, least.get(d, i))
    assert got == {(i, i is not None and i > least[d]) for i, d in made}


# -- target resampling ---------------------------------------------------------------

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def run_buckets(text, size=10_000):
    words = TOKEN.findall(fold(text))
    found = [" ".join(words[k:k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f.encode()) % size for f in found]


def sampled(rows, target, size=10_000):
    raw, wanted = (collections.Counter(b for t in ts for b in run_buckets(t, size)[1]) for ts in ([t for _, t, *_ in rows], target))
    s, t = sum(raw.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + size) / ((raw[b] + 1) * (t + size)))) for b in range(size)]
    lines = []
    for i, text, *_ in rows:
        n, found = run_buckets(text, size)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        lines.append([i, len(found), weight, score, n])
    able = sorted((r for r in lines if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1], -r[4]))
    for place, r in enumerate(able, 1):
        r.append(place if place <= 5 * len(able) // 100 else None)
    return collections.Counter((*r[:4], r[5] if len(r) == 6 else None) for r in lines)


@pytest.mark.parametrize("limit", [1, 200, 1 << 20])
def test_runs_of_words(limit):
    import pyarrow as pa

    rng = random.Random(limit)
    texts = ["".join(rng.choice("aBé1 .\x00\x7f中[") for _ in range(rng.randint(0, 50))) for _ in range(200)] + [None, "", "a a a a"]
    got = []
    for part in target_resampling.slices(pa.array(texts), limit):
        levels, n_words = target_resampling.runs(part)
        sets = [[] for _ in range(len(part))]
        for crc, run, parent in levels:
            for c, p in zip(crc[run].tolist(), parent.tolist()):
                sets[p].append(c % 10_000)
        got += list(zip(n_words.tolist(), map(sorted, sets)))
    assert got == [(n, sorted(found)) for n, found in map(run_buckets, texts)]


def test_target_resampling(spark, docs, none, rows):  # noqa: F811
    target = [None, "", "w1 w2 w3 w4", "W1 w2, w5 zz"]
    goal = spark.createDataFrame([(k, t, 1) for k, t in enumerate(target)], "item_id long, text string, score int")
    got = target_resampling.resampled(docs, goal)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    found = collections.Counter(map(tuple, got.collect()))
    assert found == sampled(rows, target)
    assert sum(r[4] is not None for r in found) == 5 * sum(len(TOKEN.findall(fold(t))) >= 20 for _, t, *_ in rows) // 100
    assert target_resampling.resampled(none, goal).count() == 0
    flat = collections.Counter(map(tuple, target_resampling.resampled(docs, goal.limit(0)).collect()))
    assert flat == sampled(rows, [])


def test_ranks_without_gaps_over_many_ranges(spark):
    rows = spark.range(5000).selectExpr("id % 700 as score", "id as i").repartition(13)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = target_resampling.ranked(rows, [F.desc("score"), F.asc("i")]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(((r.score, r.i) for r in got), key=lambda x: (-x[0], x[1]))
    assert [(r.score, r.i) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 5001))


# -- quality rules -------------------------------------------------------------------


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = collections.defaultdict(list)
    for k in range(len(words) - 7):
        places[tuple(words[k:k + 8])].append(k)
    covered = {k + j for found in places.values() if len(found) > 1 for k in found for j in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_statistics(spark, docs, none, rows, labels):  # noqa: F811
    rng = random.Random(5)
    odd = ["a b c d e f g h " * 3, "a " * 9, "a " * 8, "x\ny\nx\n \n\n x\nx", "<>#*$%&| é😀\x1c", "\n".join(["one two three four five six seven eight nine"] * 4)]
    odd += [" ".join(rng.choice("ab") for _ in range(rng.randint(8, 60))) for _ in range(40)]
    more = docs.unionByName(spark.createDataFrame([(1000 + k, t) for k, t in enumerate(odd)], "doc_id long, text string"), True)
    got = collections.Counter((r.doc_id, *[r[s] for s in quality_rules.STATISTICS], r.base_failed)
                              for r in quality_rules.judged(more, labels.limit(0)).collect())
    every = [(i, t) for i, t, *_ in rows] + [(1000 + k, t) for k, t in enumerate(odd)]
    want = collections.Counter()
    for i, t in every:
        s = statistics(t)
        want[(i, *s, s[0] < 20 or 100 * s[4] > 30 * s[0])] += 1
    assert got == want
    assert quality_rules.judged(none, labels).count() == 0


def shares(text):
    n, chars, symbols, dup, repeat = statistics(text)
    lines = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
    per = lambda a, b: a / b if b else 0.0
    return {"words": float(n), "chars_per_word": per(chars, n), "symbols_per_word": per(symbols, n), "dup_line_share": per(dup, lines),
            "repeat_share": per(repeat, n), "words_per_line": per(n, lines),
            "distinct_share": per(len(set(WORD.findall(text or ""))), n), "word_char_share": per(chars, len(text or ""))}


def holds(rule, s):
    return all(s[c.feature] > c.cut if c.above else s[c.feature] <= c.cut for c in rule)


def cover(rows):
    """The same sequential covering over plain rows (shares, bad, prune)."""
    count = lambda part: (sum(b for _, b, _ in part), sum(not b for _, b, _ in part))
    grow = [r for r in rows if not r[2]]
    cuts = {f: sorted({float(np.percentile([s[f] for s, *_ in grow], 100 * c)) for c in quality_rules.CUTS}) for f in grow[0][0]}
    rules, left = [], list(rows)
    while len(rules) < quality_rules.MAX_RULES:
        rule, part = [], [r for r in left if not r[2]]
        p, n = count(part)
        while p and n and len(rule) < quality_rules.MAX_CONDITIONS:
            best = (0.0, None)
            for f in cuts:
                for cut in cuts[f]:
                    for above in (False, True):
                        c = quality_rules.Condition(f, above, cut)
                        cp, cn = count([r for r in part if holds([c], r[0])])
                        gain = quality_rules.foil(cp, cn, p, n)
                        if gain > best[0]:
                            best = (gain, c)
            if best[1] is None:
                break
            rule.append(best[1])
            part = [r for r in part if holds([best[1]], r[0])]
            p, n = count(part)
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            p, n = count([r for r in left if r[2] and holds(rule[:k], r[0])])
            worth.append((p - n) / (p + n) if p + n else 0.0)
        rule = rule[:worth.index(max(worth)) + 1]
        p, n = count([r for r in left if holds(rule, r[0])])
        if p < quality_rules.SUPPORT or p < quality_rules.PRECISION * (p + n):
            break
        rules.append(rule)
        left = [r for r in left if not holds(rule, r[0])]
    return rules


def test_learned_list_is_that_of_plain_covering(spark):
    rng = random.Random(11)
    made, said = [], []
    for i in range(400):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.randint(25, 70))]
        kind = rng.random()
        if kind < 0.2:
            words = [w + "###" if rng.random() < 0.5 else w for w in words]
        elif kind < 0.35:
            words = [rng.choice(("aa", "bb", "cc", "dd", "ee", "ff", "gg")) for _ in words]
        made.append((i, " ".join(words), "x"))
        said.append((i, int(kind >= 0.35) if rng.random() > 0.02 else 0, None, None))
    docs, labels = spark.createDataFrame(made, "doc_id long, text string, n_words string"), spark.createDataFrame(said, LABELS)
    judged = {r.doc_id: r for r in quality_rules.judged(docs, labels).collect()}
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    base = lambda t: (lambda s: s[0] < 20 or 100 * s[4] > 30 * s[0])(statistics(t))
    learning = [(shares(t), q == 0, fold(i) == 4) for (i, t, _), (_, q, *_) in zip(made, said) if fold(i) and not base(t)]
    rules = cover(learning)
    assert len(rules) >= 2
    for i, text, _ in made:
        number = next((k for k, r in enumerate(rules, 1) if holds(r, shares(text))), 0) if not base(text) else 0
        assert judged[i].rule_number == number
        assert judged[i].kept == (not base(text) and not number)
        assert judged[i].held_out == (fold(i) == 0)
        assert judged[i].rule == (" and ".join(map(str, rules[number - 1])) if number else None)
    held = [(judged[i].kept, q) for (i, t, _), (_, q, *_) in zip(made, said) if not fold(i) and not base(t)]
    assert sum(k == bool(q) for k, q in held) >= 0.9 * len(held)


def test_no_python_in_the_plan_of_the_rules(spark, labels):
    docs = spark.range(3).selectExpr("id as doc_id", "string(id) as text")
    plan = quality_rules.judged(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan

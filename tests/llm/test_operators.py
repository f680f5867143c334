"""The operators of rubrica.llm against brute force, the tokenizer library and SQL, on small tables with odd rows."""

import collections
import math
import random
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rubrica.llm import (
    blocks, bloom_lm, importance, jaccard, metric_join, mixing, oracles, queries, tokens, toxicity, trie_bpe, url_tree,
)
from rubrica.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, __size string"
WORDS = [f"w{i}" for i in range(40)]


def some_words(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """NULLs in every column, empty and long texts, copies, near copies, repeated rows, clashing columns."""
    rng = random.Random(7)
    texts = [some_words(rng, rng.randint(1, 60)) for _ in range(60)]
    texts += [t.upper() for t in texts[:10]] + [texts[50]] * 7
    base = some_words(rng, 80).split()
    for k in range(25):
        near = list(base)
        for _ in range(rng.randint(1, 3)):
            near[rng.randrange(80)] = f"x{k}"
        texts.append(" ".join(near))
    texts += [None, "", " \n", "ß É", "word " * 30_000, "a b", "A  b", "a b c d", "\x1c|\x1d"]
    out = [(i, t, rng.choice(["en", None]), rng.choice(["s1", "s1", "s1", "s2", None, "Z"]), None, 0.5, "x") for i, t in enumerate(texts)]
    return out + [(None, texts[0], None, None, None, None, None), out[3], out[3]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


FUZZ = "aAbé ΣßﬁЖ中　\t\n'sldv109,.!😀İ́՘꟎Ᲊ"


def fuzz():
    rng = random.Random(1)
    made = ["".join(rng.choice(FUZZ) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    return made + ["", "a" * 3000, "ab" * 999, "the" * 500, "<|endoftext|>", " <|endoftext|>x<|startoftext|>", "AΣ ΑΣ. ŉ'S", "é" * 5]


def test_token_counts(docs, none, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library = tokens.Counter(path), Tokenizer.from_file(path)
    texts = fuzz()
    assert own.count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    got = sorted(tokens.token_counts(docs, path).collect(), key=repr)
    want = sorted(((i, len((t or "").encode()), n, n > 512) for i, t, *_ in rows
                   for n in [len(library.encode(t or "", add_special_tokens=False).ids)]), key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    assert tokens.token_counts(none, path).count() == 0


def test_word_bpe(docs, none, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)

    def want(text):
        ids = library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)

    texts = fuzz()
    assert trie_bpe.Encoder(path).encode(texts) == [want(t) for t in texts]
    got = [(r.doc_id, bytes(r.ids), r.decoded) for r in trie_bpe.encoded(docs, path).collect()]
    assert sorted(got, key=repr) == sorted(((i, *want(t or "")) for i, t, *_ in rows), key=repr)
    assert trie_bpe.encoded(none, path).count() == 0


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(docs, none, rows, weak):
    bucket = (lambda k: F.pmod(F.xxhash64(k), F.lit(5))) if weak else F.xxhash64
    got = blocks.exact_groups(docs, block_bytes=64 if weak else 8192, bucket=bucket).collect()
    fold = lambda t: (t or "").encode().lower()
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[fold(t)].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = collections.Counter((i, best[fold(t)], len(groups[fold(t)])) for i, t, *_ in rows)
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert blocks.without_copies(docs).count() == len(groups)
    assert blocks.exact_groups(none).count() == 0


def linked(sets):
    """Components by brute force; the smallest id names them."""
    ids = [i for i in sets if i is not None]
    name = {i: i for i in ids}
    changed = True
    pairs = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(name[a], name[b])
            changed |= name[a] != low or name[b] != low
            name[a] = name[b] = low
    return name


def test_jaccard(docs, none, rows, monkeypatch):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    name = linked(sets)
    for tile in (4096, 2):  # parts of frequent shingles' groups, which need a task to meet shingles often
        monkeypatch.setattr(jaccard, "TILE", tile)
        got = jaccard.jaccard_groups(docs.coalesce(1)).collect()
        assert len(got) == len(rows)
        assert all(r.n_shingles == len(sets[r.doc_id]) and r.component_id == name.get(r.doc_id) for r in got)
    assert jaccard.jaccard_groups(none).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(0, k) for k in range(400, 500)]
    name = {v: v for p in links for v in p if p[0] != p[1]}
    for _ in name:
        for a, b in links:
            if a != b:
                name[a] = name[b] = min(name[a], name[b])
    assert {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()} == name


def test_near_vectors_of_many_lengths(spark, monkeypatch):
    """Lengths beyond those that have pivots are compared as well."""
    rng = np.random.default_rng(6)
    made = [(rng.normal(size=d)).tolist() for d in range(1, 9) for _ in range(6 * d)]
    vectors = made + [[2 * x for x in v] for v in made]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    whole = {r.vec_id: r for r in metric_join.near_vectors(table, pivots=5, block=16).collect()}
    monkeypatch.setattr(metric_join, "LENGTHS", 2)
    got = {r.vec_id: r for r in metric_join.near_vectors(table, pivots=5, block=16).collect()}
    assert got == whole and all(r.n_links >= 1 for r in got.values())


def test_near_vectors(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=8)
    vectors = [(rng.normal(size=8) * 3).tolist() for _ in range(60)] + [(centre + rng.normal(size=8) * 0.2).tolist() for _ in range(60)]
    vectors += [vectors[0]] * 4 + [None, [], [0.0] * 8, [None] + [1.0] * 7, [float("nan")] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0]]
    ids = [*range(len(vectors))]
    table = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in metric_join.near_vectors(table, pivots=5, block=16).collect()}
    links = collections.defaultdict(set)
    usable = {i: np.array(v) for i, v in zip(ids, vectors) if v and None not in v and np.isfinite(v).all() and any(v)}
    for a, x in usable.items():
        for b, y in usable.items():
            if a != b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                links[a].add(b)
    name = dict(zip(ids, ids))
    for _ in ids:
        for a in links:
            name[a] = min([name[a], *(name[b] for b in links[a])])
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (len(links[i]), name[i], name[i] == i) for i in ids}
    assert metric_join.near_vectors(table.where("false")).count() == 0


def in_sql(name, table, sql):
    con = duckdb.connect()
    con.register(name, table)
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    return collections.Counter(tuple(sorted(zip(names, r), key=lambda x: x[0])) for r in cursor.fetchall())


def in_spark(df):
    return collections.Counter(tuple(sorted(r.asDict().items())) for r in df.collect())


def test_mixing(spark, docs, none, rows):
    mixed = mixing.mixed(docs.drop("__size"))
    shown = mixed.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                         F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"))
    assert in_spark(shown) == in_sql("documents", docs.select("doc_id", "text", "source").toArrow(), oracles.MIX)
    copies = {r["doc_id"]: r["__copies"] for r in mixed.collect()}
    assert max(copies.values()) <= 2
    assert mixing.taken(docs.drop("__size")).count() == sum(copies[i] for i, *_ in rows)
    assert mixing.taken(none.drop("__size")).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "https://A.example.com/en/1?x=1", "http://www.example.com/en/2", "ftp://net", "http://x.net/es/1#a://b",
            "http://x.net/fr", "http://x.org/a/b/c/d/e/f/g", "x://h/://y/en/"]
    urls += [f"http://h.org/{k}/post-{i}.html" for k in ("en", "de") for i in range(12)]
    urls += [f"http://q.net/{'es' if i % 9 else 'en'}{i % 2}/{i}" for i in range(40)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, urls[4], None), (4, urls[4], "y")], "page_id long, url string, rule string")
    got = url_tree.verdicts(pages, queries.RULES).withColumn("purity", F.round("purity", 6))
    assert in_spark(got) == in_sql("pages", pages.select("page_id", "url").toArrow(), oracles.urls(queries.RULES))
    assert url_tree.verdicts(pages.where("false"), queries.RULES).count() == 0


def test_language_model(docs, none, rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    words = [(i, (t or "").encode().lower().split() + [b" "]) for i, t, *_ in rows]
    count = collections.Counter(w for i, ws in words if not held(i) for w in ws)
    total, distinct = sum(count.values()), len(count)
    want = collections.Counter((i, held(i), len(ws), sum(count[w] > 0 for w in ws), total, round(sum(
        math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws), 4)) for i, ws in words)
    got = bloom_lm.scored(docs, bits=1 << 20, segment_bits=1 << 12, frequent=20).collect()
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert bloom_lm.scored(none).count() == 0


def test_language_model_has_every_gram(docs, monkeypatch):
    """A filter too small for the n-grams, or for any, gives the scores of one that holds them all."""
    def scores(bits, most, load=0.01):
        monkeypatch.setattr(bloom_lm, "LOAD", load)
        got = bloom_lm.scored(docs, bits=bits, segment_bits=1 << 12, most_bits=most).collect()
        return sorted((r.doc_id or -1, r.n_tokens, round(r.score, 6)) for r in got)

    want = scores(1 << 12, 1 << 30)
    assert scores(1 << 17, 1 << 17) == want
    assert scores(1 << 12, 1 << 12, 1e-9) == want


def exact_scores(rows, fold=1):
    """(id, score) of the pair model on exact counts of all n-grams, weights fitted on all learning rows."""
    learned = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != fold
    words = [(i, (t or "").encode().lower().split() + [b" "]) for i, t, *_ in rows]
    befores = [[b" ", *ws[:-1]] for _, ws in words]
    one = collections.Counter(w for i, ws in words if learned(i) for w in ws)
    two = collections.Counter(p for (i, ws), vs in zip(words, befores) if learned(i) for p in zip(vs, ws))
    level = lambda n: 1 + math.floor(bloom_lm.FINENESS * math.log2(n) + 1e-9) if n else 0
    # Counts of one level are not told apart: of pairs the least of them stands for all, of histories the largest, of words their mean.
    alike = collections.defaultdict(list)
    for n in range(1, 1 << 17):
        alike[level(n)].append(n)
    held = collections.defaultdict(list)
    for n in one.values():
        held[level(n)].append(n)
    mean = {k: sum(v) / len(v) for k, v in held.items()}
    denominator = sum(one.values()) + 0.5 * (len(one) + 1)

    def mass(v, w, less, a):
        joint = alike[level(two[v, w])][0] if two[v, w] else 0
        history = alike[level(one[v])][-1] if one[v] else 0
        single = mean[level(one[w])] if one[w] else 0
        return a * max(joint - less, 0) / max(history - less, 1) + (1 - a) * (single + 0.5) / denominator

    # What may follow a word, and any unknown word, has a mass of 1 at most, whatever the weight.
    follows = collections.defaultdict(set)
    for v, w in two:
        follows[v].add(w)
    for v in [*follows, "unknown"]:
        for a in bloom_lm.GRID:
            rest = (1 - a) * (sum(mean[level(n)] + 0.5 for w, n in one.items() if w not in follows[v]) + 0.5) / denominator
            assert sum(mass(v, w, 0.0, a) for w in follows[v]) + rest <= 1 + 1e-9

    bucket = lambda v: level(one[v]) // (2 * bloom_lm.FINENESS)
    sums = collections.defaultdict(lambda: [0.0] * len(bloom_lm.GRID))
    for (i, ws), vs in zip(words, befores):
        for v, w in zip(vs, ws) if learned(i) else ():
            for k, a in enumerate(bloom_lm.GRID):
                sums[bucket(v)][k] += math.log(mass(v, w, 1.0, a))
    weight = {b: bloom_lm.GRID[max(range(len(s)), key=s.__getitem__)] for b, s in sums.items()}
    return [(i, sum(math.log10(mass(v, w, 0.0, weight.get(bucket(v), 0.0))) for v, w in zip(vs, ws))) for (i, ws), vs in zip(words, befores)]


def test_language_model_scores(spark, docs, rows, monkeypatch):
    """The scores of exact counts, pairs that training holds once included."""
    learned = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
    pairs = collections.Counter(
        p for i, t, *_ in rows if learned(i) for ws in [(t or "").lower().split()] for p in zip(ws, ws[1:]))
    assert sum(n == 1 for n in pairs.values()) > 50
    monkeypatch.setattr(bloom_lm, "LOAD", 0.01)
    got = bloom_lm.scored(docs, bits=1 << 20, segment_bits=1 << 12).collect()
    key = lambda r: (r[0] or -1, r[1])
    got, want = sorted(((r.doc_id, r.score) for r in got), key=key), sorted(exact_scores(rows), key=key)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], rtol=1e-6, atol=1e-6)


def test_language_model_learns_weights_from_all_rows(spark):
    """Words that only a few rows of NULL id hold, among many others, have the weights of their own counts."""
    rows = [(i, "a") for i in range(9_000)] + [(None, "u v " * 8)] * 40
    got = bloom_lm.scored(spark.createDataFrame(rows, "doc_id long, text string"), bits=1 << 20, segment_bits=1 << 12).collect()
    (want,) = {round(s, 6) for i, s in exact_scores(rows) if i is None}
    assert {round(r.score, 6) for r in got if r.doc_id is None} == {want}


def test_filter_has_every_entry(spark):
    pairs = [(k * 7919 - 10**6, 1 + k % 50) for k in range(3000)]
    bits = bloom_lm.build(spark.createDataFrame(pairs, "key long, n long"), 1 << 18, 1 << 12)
    level = bloom_lm.Filter(bits, 1 << 12).level(np.array([k for k, _ in pairs]).view(np.uint64))
    want = bloom_lm.quantised(np.array([n for _, n in pairs]))
    assert (level >= want).all() and (level == want).mean() > 0.8


def test_toxicity(spark, none):
    rng = random.Random(2)
    made = []
    for i in range(600):
        w = some_words(rng, 30).split()
        bad = i % 3 == 0
        for _ in range(3 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["idiotic", "wretched"]))
        made.append((i, " ".join(w), int(bad)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in made] + [(900, None), (901, ""), (902, "w1 idiotik w2 wretchd"), (903, "w1 w2"), (None, "idiotic"),
                                 (904, 'he said "idiotic" w3')], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in made] + [(None, 1, 1), (900, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(got[i].predicted == y for i, _, y in made)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].predicted for i in (900, 901, 902, 903, None, 904)] == [0, 0, 1, 0, 1, 0]
    assert got[0].held_out == (zlib.crc32(b"0") % 5 == 0)
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(docs, labels.where("false")).collect()} == {0.010000000000000009}


def test_automaton_is_levenshtein():
    def distance(a, b):
        row = [*range(len(b) + 1)]
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    rng = random.Random(4)
    terms = ["".join(rng.choice("abc") for _ in range(rng.randint(3, 12))) for _ in range(25)]
    automaton = toxicity.Automaton(sorted(set(terms)))
    for _ in range(800):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 13)))
        want = min(((d, t) for t in terms if (d := distance(word, t)) <= toxicity.edits(len(t))), default=None)
        assert automaton.nearest(word) == want


def test_importance(spark, docs, none, rows):
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(90)] + [(None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = importance.resampled(docs, labels, share=0.6).collect()
    keep = round(0.6 * len(rows))
    assert len(got) == len(rows) and sum(r.kept for r in got) == keep
    assert min(r.key for r in got if r.kept) >= max(r.key for r in got if not r.kept)
    assert [r.log_weight for r in got if r.n_features == 0] == [0.0] * sum(not (t or "").encode().split() for _, t, *_ in rows)
    assert all(r.kept for r in importance.resampled(docs, labels.where("false")).collect())
    assert importance.resampled(none, labels).count() == 0


def test_pipeline(spark, tmp_path):
    rng = random.Random(9)
    texts = [some_words(rng, 30 + k) for k in range(120)]
    bad = {k for k in range(0, 120, 4)}
    texts = [t + " wretched idiotic wretched" * (k in bad) for k, t in enumerate(texts)]
    texts += [texts[1].upper(), texts[2] + " tail", None, ""]
    docs = spark.createDataFrame([(k, t, "en", f"s{k % 3}", None) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, int(k in bad)) for k in range(120)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = docs
    expected = [
        {k for k in range(124)} - bad,
        {k for k in range(124)} - bad - {1, 122},  # the upper-case copy and the last empty text stay
        {k for k in range(124)} - bad - {1, 122, 121},  # of the near copies the smaller id stays
    ]
    expected[1] = expected[1] - set()
    expected[2] = expected[1] - {121 if 2 in expected[1] else 2}
    for (name, stage), want in zip(corpus_pipeline.STAGES[:3], expected):
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.select("doc_id").collect()} == want, name
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in final.collect()} <= expected[2]

"""Toxicity and importance resampling recomputed in plain Python: lexicon, hits, scores; weights, keys, choice."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from rubrica.llm import importance, toxicity
from rubrica.llm.common import WordHashes

from .test_operators import WORDS, docs, rows, some_words  # noqa: F401  (fixtures)


def fold_of(i):
    return -1 if i is None else zlib.crc32(str(i).encode()) % 5


# -- importance resampling ----------------------------------------------------------


@pytest.mark.parametrize("share, buckets", [(None, 1 << 10), (0.3, 1 << 6)])
def test_importance_is_that_of_plain_python(spark, docs, rows, share, buckets):  # noqa: F811
    rng = random.Random(8)
    said = [(i, rng.choice([0, 1, 1, None])) for i in sorted({i for i, *_ in rows if i is not None})] + [(None, 1)]
    labels = spark.createDataFrame(said, "doc_id long, quality int")
    words = WordHashes()
    found = [(i, importance.features(words, (t or "").encode(), buckets)) for i, t, *_ in rows]
    good_ids = {i for i, q in said if q == 1 and i is not None and fold_of(i)}
    raw, good = np.zeros(buckets), np.zeros(buckets)
    for i, f in found:
        raw += np.bincount(f, minlength=buckets)
        if i in good_ids:
            good += np.bincount(f, minlength=buckets)
    ratio = np.log((good + 1) / (good.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))
    lines = []
    for i, f in found:
        weight = sum(float(ratio[b]) for b in f)
        u = int(hashlib.md5(f"resample:{'' if i is None else i}".encode()).hexdigest()[:13], 16) / (1 << 52)
        score = 1 / (1 + math.exp(-(weight / len(f) if len(f) else 0.0)))
        lines.append((i, len(f), weight, score, weight - math.log(-math.log(u + 2.0 ** -54))))
    learned = [q for i, q in said if q is not None and i is not None and fold_of(i)]
    keep = round((sum(learned) / len(learned) if share is None else share) * len(rows))
    want = sorted(lines, key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    got = importance.resampled(docs, labels, share=share, buckets=buckets).collect()
    key = lambda r: (-r[4], r[0] is not None, r[0] or 0, not r[5])
    got = sorted(((r.doc_id, r.n_features, r.log_weight, r.score, r.key, r.kept) for r in got), key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2:5] for r in got], [r[2:5] for r in want], atol=1e-9)
    assert [r[5] for r in got] == [k < keep for k in range(len(got))]


def test_features_are_words_and_pairs():
    words = WordHashes()
    one = lambda t: importance.features(words, t, 1 << 30)
    assert len(one(b"")) == 0 and len(one(b"a")) == 1 and len(one(b"a b a b")) == 7
    assert collections.Counter(one(b"a B a b").tolist()) == collections.Counter(one(b"A b\na\tb").tolist())
    assert len(set(one(b"a b c").tolist())) == 5 and set(one(b"a b").tolist()) < set(one(b"a b c").tolist())


# -- toxicity -----------------------------------------------------------------------


def distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            before, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, before + (x != y))
    return line[-1]


def nearest(word, terms):
    """The term of fewest edits within what its length tolerates, the first of equals."""
    near = [(distance(word, t), t) for t in terms]
    return min(((d, t) for d, t in near if d <= (0 if len(t) < 5 else 1 if len(t) < 10 else 2)), default=None)


SAYING = {"said", "says", "saying", "wrote", "writes", "quote", "quoted", "called", "term", "word", "phrase"}


def reported(text, start, end):
    """Straight quotation marks around the window of a term, or a word of saying shortly before."""
    before, after = text[max(0, start - 80):start], text[end:end + 80]
    return (before.count('"') % 2 == 1 and '"' in after) or bool(SAYING & set(re.findall(r"[a-z]+", before[-40:])))


def test_toxicity_is_that_of_plain_python(spark):
    rng = random.Random(21)
    bad_words = ["wretched", "idiotic", "scum"]
    made = []
    for i in range(500):
        ws = some_words(rng, 40).split()
        bad = i % 4 == 0
        for _ in range(3 * bad):
            ws.insert(rng.randrange(len(ws)), rng.choice(bad_words))
        made.append((i, " ".join(ws), int(bad)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)

    contexts = set()
    for i, t, y in made:
        if fold_of(i):
            ws = t.split()
            contexts |= set(zip(ws, ["", *ws], [y] * len(ws)))
    bad, good = (collections.Counter(w for w, _, y in contexts if y == v) for v in (1, 0))
    share = sum(bad.values()) / (sum(bad.values()) + sum(good.values()))
    terms = {}
    for w in bad:
        p, precise = bad[w] / (bad[w] + good[w]), (bad[w] + 0.5) / (bad[w] + good[w] + 1)
        nats = bad[w] * math.log(p / share) + (good[w] * math.log((1 - p) / (1 - share)) if good[w] else 0.0)
        if len(w) > 1 and p > share and nats >= toxicity.EVIDENCE and precise >= toxicity.PRECISION:
            terms[w] = precise
    assert set(terms) == set(bad_words) and not model.stems
    assert {w: round(p, 9) for w, p in model.terms.items()} == {w: round(p, 9) for w, p in terms.items()}

    scorer = toxicity.Scorer(model)
    texts = [t for _, t, _ in made[:40]] + ["", "w1", "scum", "scam", "wretchd w2", "wretchhd w2", "idiotics", "WRETCHED!"]
    for _ in range(60):
        ws = some_words(rng, 25).split()
        for _ in range(rng.randint(1, 2)):
            w = list(rng.choice(bad_words))
            w[rng.randrange(len(w))] = rng.choice("abcxyz")
            ws.insert(rng.randrange(len(ws)), rng.choice(["%s", '"%s"', 'he said %s', '"w1 %s w2"', '" %s']) % "".join(w))
        texts.append(" ".join(ws))
    for text in texts:
        clean = 1 - model.base
        for m in re.finditer(r"[a-z0-9]+", text.lower()):
            near = None if m[0] in model.innocent else nearest(m[0], sorted(terms))
            if near:
                weight = terms[near[1]] * model.misspelt[near[0]]
                clean *= 1 - weight * (model.quoted if reported(text.lower(), m.start(), m.end()) else 1.0)
        assert scorer.score(text) == pytest.approx(1 - clean), text
    assert len(WORDS) == 40

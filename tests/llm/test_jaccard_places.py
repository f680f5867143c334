"""The Jaccard join where many texts share passages: what it leaves out by places and sizes links nothing."""

import random

import pytest

from rubrica.llm import jaccard
from rubrica.llm.common import WordHashes


def test_no_link_is_beyond_the_size_that_a_place_allows():
    """For every n, m and number of shared elements: a link's first common place, in both sets, allows the other's size."""
    for n in range(1, 60):
        for m in range(n, 80):
            for shared in range(1, n + 1):
                if (100 + jaccard.PERCENT) * shared >= jaccard.PERCENT * (n + m):
                    # The first common element has at least shared - 1 others behind it.
                    assert m <= jaccard.most_of(n, n - shared) and n <= jaccard.most_of(m, m - shared)
    assert jaccard.most_of(100, 0) == 133 and jaccard.most_of(100, 15) < 100


def components(sets):
    """Smallest index of each component of linked sets, by all pairs."""
    own = list(range(len(sets)))

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((find(i), find(j)))
                own[b] = a
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("seed, reported, tile", [(1, 3, 4096), (2, 2, 8), (3, 10**9, 4096)])
def test_texts_of_shared_passages(spark, monkeypatch, seed, reported, tile):
    """Near copies about the bound, passages that a third of the texts share, known as frequent or not, in one part or several."""
    monkeypatch.setattr(jaccard, "REPORTED", reported)
    monkeypatch.setattr(jaccard, "TILE", tile)
    rng = random.Random(seed)
    passages = [[f"p{k}w{j}" for j in range(rng.randint(6, 25))] for k in range(12)]
    texts = []
    for _ in range(40):
        base = [f"b{rng.randrange(10**6)}" for _ in range(rng.randint(10, 60))]
        for passage in rng.sample(passages, rng.randint(0, 3)) + [passages[0]] * (rng.random() < 0.4):
            at = rng.randrange(len(base) + 1)
            base[at:at] = passage
        texts.append(base)
        for _ in range(rng.randint(0, 6)):
            near = list(base)
            for _ in range(rng.randint(1, 4)):
                near[rng.randrange(len(near))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.5:
                cut = rng.randint(0, len(near) // 3)
                near = near[cut:] if rng.random() < 0.5 else near[:len(near) - cut]
            texts.append(near)
    rng.shuffle(texts)
    words = WordHashes()
    sets = [set(jaccard.shingles(words, " ".join(t).encode()).tolist()) for t in texts]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs).collect()}
    want = components(sets)
    assert len(want) - len(set(want)) >= 15
    assert [got[i] for i in range(len(texts))] == want

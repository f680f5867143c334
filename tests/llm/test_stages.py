"""The stages of the corpus pipeline: columns of any name, ties, and the whole run against plain Python."""

import collections
import hashlib
import random
import struct

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rubrica.llm import blocks, jaccard, mixing, toxicity
from rubrica.llm.common import free_prefix

from .test_operators import WORDS, docs, none, rows, some_words  # noqa: F401  (fixtures)

#: Names that operators of this package use for themselves.
CLASHING = ("__size", "__own", "__id", "__sha", "__copies", "__copy", "__target", "__source", "__source_size", "__key", "__row",
            "___x", "set_id", "component_id", "keep_id", "kept", "score", "label", "i", "t", "n", "key")


@pytest.fixture(scope="module")
def clashing(docs):  # noqa: F811
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return plain.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHING})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def counted(df, columns=None):
    return collections.Counter(tuple(map(str, r)) for r in df.select(*[F.col(f"`{c}`") for c in columns or df.columns]).collect())


STAGES = {
    "toxicity": lambda df, labels: toxicity.without_toxic(df, labels),
    "exact_dedup": lambda df, labels: blocks.without_copies(df),
    "ngram_jaccard": lambda df, labels: jaccard.one_of_each(df),
    "mixing": lambda df, labels: mixing.taken(df),
}


@pytest.mark.parametrize("name", STAGES)
def test_columns_of_any_name_come_through(clashing, docs, labels, name):  # noqa: F811
    got = STAGES[name](clashing, labels)
    assert got.schema.simpleString() == clashing.schema.simpleString()
    found, given = counted(got), counted(clashing)
    assert found and set(found) <= set(given)
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    assert counted(got, plain) == counted(STAGES[name](docs.select(plain), labels))
    assert STAGES[name](clashing.limit(0), labels).count() == 0


def test_mixing_names_its_columns_anew_or_says_so(docs, none):  # noqa: F811
    with pytest.raises(ValueError, match="__size"):
        mixing.mixed(docs)
    assert free_prefix(docs) == "___"
    assert {"___size", "___copies"} <= set(mixing.mixed(none, prefix="___").columns)


def test_the_survivor_of_repeated_ids_does_not_depend_on_the_order(spark):
    rows = [(1, "A b", s, [k], {"k": 1}) for k, s in enumerate((None, "z", "y", "z"))] + [(0, "a B", "a", [1], None), (None, "a b", "b", None, None)]
    schema = "doc_id long, text string, source string, parts array<int>, more map<string, int>"
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = blocks.without_copies(spark.createDataFrame(rows, schema).repartition(1 + seed)).collect()
        assert [(r.doc_id, r.text, r.source, r.parts, r.more) for r in got] == [(1, "A b", None, [0], {"k": 1})]
    nulls = spark.createDataFrame([(None, "x", s, None, None) for s in ("b", "a")], schema)
    assert [r.source for r in blocks.without_copies(nulls).collect()] == ["a"]


def taken(rows, weights=(3, 1, 2), share=1.5, cap=2):
    """Times that each row (id, text, source) is taken: targets by filling up step by step, then the hash."""
    size = collections.Counter()
    for _, text, source in rows:
        size[source] += len((text or "").encode().split())
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = {}, share * sum(size.values()), list(names)
    while open_:
        full = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > cap * size[s]]
        if not full:
            target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            break
        target |= {s: cap * size[s] for s in full}
        left -= sum(cap * size[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    out = []
    for i, _, source in rows:
        rate = target[source] / size[source] if size[source] else 0.0
        u = int(hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest()[:13], 16) / (1 << 52)
        out.append(int(rate) + (u < rate - int(rate)))
    return out


def test_the_whole_run_is_that_of_plain_python(spark, tmp_path):
    rng = random.Random(12)
    texts = ["déjà vu " + some_words(rng, 25 + k) for k in range(150)]
    bad = set(range(0, 150, 5))
    texts = [t + f" wretched {rng.choice(WORDS)} wretched {rng.choice(WORDS)} wretched" * (k in bad) for k, t in enumerate(texts)]
    near = [texts[k].rsplit(" ", 1)[0] for k in (41, 42, 43)]
    texts += [texts[1].upper().replace("DÉJÀ", "DéJà"), *near, None, "", "one two"]
    rows = [(k, t, "en", rng.choice(("s0", "s0", "s0", "s1", None)), None) for k, t in enumerate(texts)]  # noqa: F811
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, int(k in bad)) for k in range(150)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    gone = bad | {1, 154, 151, 152, 153}  # toxic; the lesser of equal texts; near copies of a smaller id
    kept = [(i, t, s) for i, t, _, s, _ in rows if i not in gone]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for (i, text, _), times in zip(kept, taken(kept)):
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda b: hashlib.sha256(b).hexdigest()
        line = (i, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(library.decode(ids, skip_special_tokens=False).encode()))
        want[line] += times
    want = +want
    assert max(want.values()) == 2
    got = collections.Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want

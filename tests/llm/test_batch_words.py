"""Words of whole Arrow batches against words of single texts."""

import numpy as np
import pyarrow as pa
import xxhash

from rubrica.llm import bloom_lm, common
from rubrica.llm.common import WordHashes, portions, word_hashes

TEXTS = [
    "A b C a\tb", "", None, " \n", "x", " lead and trail ", "É é ÀB\x1cc\x0bd\x85e f", "".join(map(chr, range(1, 128))),
    "same same " * 50,
]


def words_of(text):
    return (text or "").encode().lower().split()


def test_words_of_a_batch_are_those_of_its_texts():
    for column in (pa.array(TEXTS), pa.array([None, "", " "]), pa.array([], pa.string()), pa.array(["pad", *TEXTS]).slice(1)):
        hashes, at, n = word_hashes(column)
        each = [words_of(t) for t in column.to_pylist()]
        assert n.tolist() == [len(w) for w in each]
        assert hashes[at].tolist() == WordHashes().of([w for ws in each for w in ws]).tolist()


def test_a_repeated_word_is_hashed_once_a_batch(monkeypatch):
    seen = []
    whole = xxhash.xxh3_64_intdigest
    monkeypatch.setattr(common.xxhash, "xxh3_64_intdigest", lambda word: seen.append(word) or whole(word))
    batch = pa.RecordBatch.from_arrays([pa.array(["same same"] * 1000 + ["other"])], ["t"])
    counts = pa.Table.from_batches(list(bloom_lm._counted([batch])))
    assert sorted(seen) == [b"other", b"same"]
    assert sorted(n for pair, n in zip(*map(pa.ChunkedArray.to_pylist, (counts["pair"], counts["n"]))) if not pair) == [1, 1001, 2000]


def test_tokens_of_a_batch_and_their_pairs():
    tokens = bloom_lm.Tokens()
    keys, at, n = tokens.of(pa.array(TEXTS))
    assert np.all(np.diff(keys.astype(object)) > 0)
    one = keys[at]
    two, start = tokens.pairs(one, n), 0
    word = WordHashes()
    for text, size in zip(TEXTS, n.tolist()):
        own = word.of([*words_of(text), b" "])
        assert one[start:start + size].tolist() == own.tolist()
        assert two[start:start + size].tolist() == bloom_lm.pairs_of(np.append(np.uint64(word[b"\t"]), own[:-1]), own).tolist()
        start += size


def test_portions_hold_all_texts_in_order():
    column = pa.array(["x" * k for k in (5, 1, 0, 30, 2, 2, 2)] + [None])
    parts = portions(column, 8)
    assert [t for p in parts for t in p.to_pylist()] == column.to_pylist()
    assert len(parts) > 2 and portions(pa.array([], pa.string()), 8) == []

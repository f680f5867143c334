"""Which prefix shingles several sets have."""

import numpy as np
import pandas as pd
import pyarrow as pa

from rubrica.llm import jaccard
from rubrica.llm.common import WordHashes

TEXTS = ["A b c d e f g a b c d e", "", None, " \t", "one two", "x " * 40, "É é a B\x1cc\x0bd e f"]


def test_shingles_of_a_batch_are_those_of_its_texts():
    words = WordHashes()
    got = [s.tolist() for s in jaccard.sets_of(pa.array(TEXTS))]
    assert got == [jaccard.shingles(words, (t or "").encode()).tolist() for t in TEXTS]


def test_keys_of_several_sets_are_found_over_all_tasks():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 64, 4_000, np.uint64, endpoint=False)
    keys[:3] = 0, (1 << 64) - 1, 1 << 63
    alone, here, apart = keys[3:2_000], keys[2_000:3_000], np.append(keys[3_000:], keys[:3])
    # `here` comes twice within one task, `apart` in two.
    tasks = [jaccard._dealt([alone, here, here, apart]), jaccard._dealt([apart[:700]]), jaccard._dealt([apart[700:]])]
    sent = pd.concat([t.to_pandas() for t in tasks])
    found = pd.concat([jaccard._several((bucket,), part) for bucket, part in sent.groupby("bucket")])
    assert sorted(found["key"]) == sorted(jaccard.code_of(np.append(here, apart)).tolist())
    assert set(found["n"]) == {1}

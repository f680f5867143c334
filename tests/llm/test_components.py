"""Connected components against union by hand, with tasks that hold few links and nodes at once."""

import random

import pytest

from rubrica.llm import components as module


def by_hand(links):
    root = {}
    for a, b in links:
        if a != b:
            for x in (a, b):
                root.setdefault(x, x)
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {k: new if v == old else v for k, v in root.items()}
    return root


@pytest.mark.parametrize("held, nodes", [(1 << 14, 1 << 20), (7, 5)])
def test_components_of_chains_stars_and_repeats(spark, monkeypatch, held, nodes):
    monkeypatch.setattr(module, "LINKS", held)
    monkeypatch.setattr(module, "NODES", nodes)
    some = random.Random(3)
    names = some.sample(range(-10**6, 10**6), 160)
    links = [*zip(names[:60], names[1:60]), *((names[60], x) for x in names[61:90]), (names[95], names[95])]
    links += [tuple(some.sample(names[100:], 2)) for _ in range(40)]
    links += links[::3] + [(b, a) for a, b in links[::5]]
    some.shuffle(links)
    table = spark.createDataFrame([*links, (names[0], None), (None, names[1])], "a long, b long").repartition(4)
    got = [(r["node"], r["component"]) for r in module.components(table).collect()]
    assert sorted(got) == sorted(by_hand(links).items())
    assert module.components(table.where("false")).count() == 0

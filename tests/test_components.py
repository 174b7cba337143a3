import random

import pytest

from admesh.operators.components import components, roots


@pytest.mark.parametrize("pairs", [
    [], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(30)] + [(50, 51)],
    [(5, 9), (9, 2), (7, 8), (8, 2), (30, 31), (31, 5)]])
def test_components(table, run, pairs):
    names = {x: x for p in pairs for x in p}
    for _ in names:
        for a, b in pairs:
            names[a] = names[b] = min(names[a], names[b])
    links = table(pairs, "a bigint, b bigint")
    assert {r.id: r.component for r in components(links, run).collect()} == names


def test_roots_of_a_forest(table, run):
    r = random.Random(3)
    parents = {i: r.randrange(max(0, i - 3), i) for i in range(1, 60) if i % 7}

    def root(i):
        return root(parents[i]) if i in parents else i
    got = {x.id: x.component for x in roots(table(sorted(parents.items()), "id bigint, parent bigint"), run).collect()}
    assert got == {i: root(i) for i in parents.keys() | set(parents.values())}

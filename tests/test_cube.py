import random
from decimal import Decimal
from itertools import product

import pytest

from admesh.operators.cube import user_cube

FACT = "ad string, segment string, month string, id bigint, spent decimal(18,4), utility double"


def facts(seed, n=400):
    r = random.Random(seed)
    ids = [r.choice([1, 2, 3, 40_000, -5, 10**12 + 7, None]) if r.random() < 0.5 else r.randrange(10**6) for _ in range(30)]
    return [(r.choice(["a", "b", None]), r.choice(["s", "t"]), r.choice(["1", "2", "3", None]), r.choice(ids),
             Decimal(r.randrange(10**6)) / 100 if r.random() < 0.9 else None, r.choice([0.25, 0.5, 1.0, None])) for _ in range(n)]


def brute(rows):
    out = {}
    for masks in product([0, 1], repeat=3):
        for row in rows:
            key = (*(None if m else v for m, v in zip(masks, row)), masks[0] * 4 + masks[1] * 2 + masks[2])
            out.setdefault(key, []).append(row)
    found = []
    for key, group in out.items():
        spent = [r[4] for r in group if r[4] is not None]
        score = [r[5] for r in group if r[5] is not None]
        found.append((*key, len({r[3] for r in group} - {None}), float(sum(spent)) if spent else None,
                      sum(score) / len(score) if score else None))
    return sorted(found, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(table, seed):
    rows = facts(seed)
    got = user_cube(table(rows, FACT), ["ad", "segment", "month"], "spent", "utility").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_facts_are_folded_before_they_are_multiplied(table):
    plan = user_cube(table(facts(1), FACT), ["ad", "segment", "month"], "spent", "utility")
    text = plan._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    expand = next(i for i, x in enumerate(lines) if "Expand" in x)
    assert any("bitmap_construct_agg" in x for x in lines[expand:]) and "Join" not in text


def test_an_empty_table_gives_no_rows(table):
    got = user_cube(table([], FACT), ["ad", "segment", "month"], "spent", "utility").collect()
    assert [r for r in got if r.users] == []

import datetime as dt
import random

import pytest

from admesh.operators import graph
from admesh.operators.cover import cover_users

PURCHASE = "user_id bigint, item_id bigint, day date, spent double"


def greedy(bought, candidates, k):
    reach = {c: {c} for c in candidates}
    for item in {(i, d) for _, i, d, _ in bought}:
        bucket = {u for u, i, d, _ in bought if (i, d) == item}
        for c in candidates:
            if c in bucket:
                reach[c] |= bucket
    covered, picks = set(), []
    while len(picks) < k:
        best = max(reach, key=lambda c: (len(reach[c] - covered), -c), default=None)
        if best is None or not reach[best] - covered:
            break
        gain = len(reach[best] - covered)
        covered |= reach[best]
        picks.append((len(picks) + 1, best, gain, len(covered)))
    return picks


def purchases(seed, people=60, items=30, n=160):
    r = random.Random(seed)
    return [(r.randrange(people), r.randrange(items), dt.date(2020, 1, 1), 1.0) for _ in range(n)]


@pytest.mark.parametrize("batch", [1, 3, 1000])
@pytest.mark.parametrize("seed, k", [(1, 6), (2, 4)])
def test_matches_plain_greedy(table, run, seed, k, batch):
    bought = purchases(seed)
    candidates = [u for u in range(60) if u % 3] + [300, 300]
    got = cover_users(table([(c,) for c in candidates], "id bigint"), graph.incidence(table(bought, PURCHASE), run), run, k, batch)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == greedy(bought, sorted(set(candidates)), k)


def test_it_ends_when_everyone_is_reached(table, run):
    bought = [(u, 1, dt.date(2020, 1, 1), 1.0) for u in range(5)]
    got = cover_users(table([(0,), (1,), (9,)], "id bigint"), graph.incidence(table(bought, PURCHASE), run), run, 10)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(1, 0, 5, 5), (2, 9, 1, 6)]


def test_bounds_spare_most_counts(table, run, monkeypatch):
    bought = [(u, u // 10, dt.date(2020, 1, 1), 1.0) for u in range(100)] + [(0, i, dt.date(2020, 1, 1), 1.0) for i in range(5)]
    asked, write = [], run.write

    def seen(df, name):
        out = write(df, name)
        if name == "counted":
            asked.append(out.count())
        return out
    monkeypatch.setattr(run, "write", seen)
    got = cover_users(table([(u,) for u in range(100)], "id bigint"), graph.incidence(table(bought, PURCHASE), run), run, 2, 4)
    assert [r.id for r in got.orderBy("rank").collect()] == [0, 50] and max(asked) < 100


def test_no_candidates(table, run):
    assert cover_users(table([], "id bigint"), graph.incidence(table([], PURCHASE), run), run).collect() == []

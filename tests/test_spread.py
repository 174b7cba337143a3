"""Distances, components and communities against brute force over pairs."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from admesh.operators import graph
from admesh.operators.spread import communities, hop_distance, user_components

PURCHASE = "user_id bigint, item_id bigint, day date, spent double"


def purchases(seed, people=60, items=40, n=110):
    """A sparse graph of several components, with one bucket that many share and users without co-buyers."""
    r = random.Random(seed)
    bought = [(r.randrange(people), r.randrange(items), dt.date(2020, r.choice([1, 2]), 1), 1.0) for _ in range(n)]
    return bought + [(u, 999, dt.date(2021, 1, 1), 1.0) for u in range(200, 230)] + [(500, 1000, dt.date(2021, 1, 1), 1.0)]


def chain(length):
    """Users in a line: each shares one bucket with the next."""
    return [(u, b, dt.date(2020, 1, 1), 1.0) for b in range(length) for u in (b, b + 1)]


def buckets_of(bought):
    out = defaultdict(set)
    for user, item, day, _ in bought:
        out[item, day.month, day.year].add(user)
    return [b for b in out.values() if len(b) > 1]


def neighbours_of(bought):
    near = defaultdict(set)
    for bucket in buckets_of(bought):
        for u in bucket:
            near[u] |= bucket - {u}
    return near


def distances(bought, users, picks):
    near = neighbours_of(bought)
    hops = {u: 0 for u in picks if u in users}
    edge = list(hops)
    while edge:
        edge = list(dict.fromkeys(v for u in edge for v in near[u] if v not in hops))
        hops |= {v: 1 + min(hops[w] for w in near[v] if w in hops) for v in edge}
    return {u: hops.get(u) for u in users}


def frames(table, run, bought, extra=()):
    users = sorted({p[0] for p in bought} | set(extra))
    return users, table([(u,) for u in users], "id bigint"), graph.incidence(table(bought, PURCHASE), run)


def named(df, column):
    rows = df.collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: r[column] for r in rows}


@pytest.mark.parametrize("bought, picks", [
    (purchases(1), [3, 200]), (purchases(2), [5]), (purchases(3), []), (chain(45), [0]), (chain(20), [9, 10]),
    (purchases(1), [500, 7777])])
def test_hops_match_breadth_first_search(table, run, bought, picks):
    users, known, incidence = frames(table, run, bought, extra=[900])
    got = hop_distance(known, table([(p,) for p in picks + picks], "id bigint"), incidence, run)
    assert named(got, "hops") == distances(bought, users, picks)


def test_a_bucket_is_opened_once(table, run, monkeypatch):
    bought = purchases(1)
    users, known, incidence = frames(table, run, bought)
    opened, write = [], run.write

    def seen(df, name):
        out = write(df, name)
        if name == "opened" and "others" in out.columns:
            opened.extend((r.item_id, r.month) for r in out.collect())
        return out
    monkeypatch.setattr(run, "write", seen)
    hop_distance(known, table([(u,) for u in users[:3]], "id bigint"), incidence, run).collect()
    assert opened and len(opened) == len(set(opened))


@pytest.mark.parametrize("bought", [purchases(1), purchases(2), chain(33), [(1, 1, dt.date(2020, 1, 1), 1.0)]])
def test_components_match_search(table, run, bought):
    users, known, incidence = frames(table, run, bought, extra=[900])
    want = {}
    for u in users:
        if u not in want:
            for v, hops in distances(bought, users, [u]).items():
                if hops is not None:
                    want[v] = u
    assert named(user_components(known, incidence, run), "component") == want


def propagated(bought, users, rounds):
    label = {u: u for u in users}
    buckets = buckets_of(bought)
    for _ in range(rounds):
        votes = defaultdict(Counter)
        for bucket in buckets:
            count = Counter(label[u] for u in bucket)
            winner = min(count, key=lambda x: (-count[x], x))
            for u in bucket:
                votes[u][winner] += 1
        label |= {u: min(c, key=lambda x: (-c[x], x)) for u, c in votes.items()}
    return label


@pytest.mark.parametrize("rounds", [0, 1, 4])
@pytest.mark.parametrize("bought", [purchases(1), purchases(4, n=300), chain(12)])
def test_communities_match_plain_propagation(table, run, bought, rounds):
    users, known, incidence = frames(table, run, bought, extra=[900])
    assert named(communities(known, incidence, run, rounds), "community") == propagated(bought, users, rounds)


def test_two_dense_groups_with_one_bridge_are_two_communities(table, run):
    groups = [range(10), range(50, 60)]
    bought = [(u, g * 100 + i, dt.date(2020, 1, 1), 1.0) for g, group in enumerate(groups) for i in range(5) for u in group]
    bought += [(9, 777, dt.date(2020, 1, 1), 1.0), (50, 777, dt.date(2020, 1, 1), 1.0)]
    users, known, incidence = frames(table, run, bought)
    assert named(communities(known, incidence, run), "community") == {u: 0 if u < 50 else 50 for u in users}


def test_empty_graphs(table, run):
    users, known = [1, 2], table([(1,), (2,)], "id bigint")
    incidence = graph.incidence(table([], PURCHASE), run)
    assert named(hop_distance(known, table([(1,)], "id bigint"), incidence, run), "hops") == {1: 0, 2: None}
    assert named(user_components(known, incidence, run), "component") == {1: 1, 2: 2}
    assert named(communities(known, incidence, run), "community") == {1: 1, 2: 2}

import random

import pytest
from pyspark.sql import functions as F

from admesh.operators import select

SCORE = "id bigint, utility double"


def test_utility_is_relative_to_the_most_central_user(table):
    affinity = table([(1, 0.5), (2, None), (3, 1.0), (9, 1.0)], "id bigint, affinity double")
    centrality = table([(1, 0.2), (2, 0.4), (3, 0.4), (4, 0.8)], "id bigint, centrality double")
    got = {r.id: r.utility for r in select.utility(affinity, centrality, F.lit(0.8)).collect()}
    assert got == {1: 0.125, 2: 0.0, 3: 0.5}
    flat = table([(1, 0.0)], "id bigint, centrality double")
    assert select.utility(affinity, flat, F.lit(0.0)).first().utility == 0.0


def test_lower_id_first_among_equals(table):
    scores = table([(5, 0.1), (4, 0.3), (3, 0.3), (2, 0.2), (1, 0.3)], SCORE)
    assert [r.id for r in select.top_users(scores, 4).collect()] == [1, 3, 4, 2]


@pytest.mark.parametrize("k", [3, 1500])
def test_top_users_per_ad_matches_brute_force(table, k):
    r = random.Random(4)
    data = [("hot" if i % 3 else f"ad{i % 7}", i, r.randrange(50) / 10) for i in range(4000)]
    got = select.top_users_per_ad(table(data, "ad string, id bigint, utility double"), k).collect()
    want = set()
    for ad in {d[0] for d in data}:
        best = sorted((-u, i) for a, i, u in data if a == ad)[:k]
        want |= {(ad, i, rank) for rank, (_, i) in enumerate(best, 1)}
    assert {(x.ad, x.id, x["rank"]) for x in got} == want


def sharing(table, *buckets):
    """Incidence rows of buckets given as groups of users."""
    rows = [(u, i, "2020-01-01", len(g) - 1) for i, g in enumerate(buckets) for u in g]
    return table(rows, "id bigint, item_id bigint, month string, others bigint")


def test_non_adjacent_picks_beat_all_co_buyers(table, run):
    near = sharing(table, (0, 1, 2, 3), (4, 5), (0, 1))
    scores = table([(0, 0.9), (1, 0.5), (2, 0.9), (3, 0.1), (4, 0.2), (5, 0.2), (6, 0.0)], SCORE)
    # 0 ties with 2 and 4 with 5: the lower id wins. 6 shares no bucket.
    assert sorted(r.id for r in select.non_adjacent(scores, near, run).collect()) == [0, 4, 6]


def test_non_adjacent_ignores_users_without_a_score(table, run):
    scores = table([(1, 0.0)], SCORE)
    assert [r.id for r in select.non_adjacent(scores, sharing(table, (1, 2)), run).collect()] == [1]


@pytest.mark.parametrize("seed", [1, 2])
def test_selection_over_buckets_matches_brute_force(table, run, seed):
    r = random.Random(seed)
    buckets = [r.sample(range(40), r.randrange(2, 7)) for _ in range(25)]
    scores = {u: r.randrange(6) / 10 for u in range(30)}
    near = {(a, b) for g in buckets for a in g for b in g if a != b}
    want = [u for u in scores if not any(
        (u, v) in near and (scores[v], -v) > (scores[u], -u) for v in scores)]
    got = select.non_adjacent(table(sorted(scores.items()), SCORE), sharing(table, *buckets), run)
    picks = sorted(x.id for x in got.collect())
    assert picks == sorted(want) and not any((a, b) in near for a in picks for b in picks)
    reached = {b for a, b in near if a in picks} - set(picks)
    ids = table([(p,) for p in picks], "id bigint")
    assert select.reach(ids, sharing(table, *buckets)).first().reach == len(reached)


def test_reach_counts_each_unpicked_user_once(table):
    near = sharing(table, (1, 2, 3), (2, 4), (5, 6))
    assert select.reach(table([(1,), (2,)], "id bigint"), near).first().reach == 2
    assert select.reach(table([], "id bigint"), near).first().reach == 0


def test_ad_summary(table):
    scores = table([("A", 1, 0.1), ("A", 2, 0.4), ("B", 1, 0.0)], "ad string, id bigint, utility double")
    assert sorted(tuple(r) for r in select.ad_summary(scores).collect()) == [("A", 2, 0.25, 0.4), ("B", 1, 0.0, 0.0)]

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from admesh.functions.columns import quantile_bounds, range_of
from admesh.operators import graph
from admesh.operators.pagerank import pagerank

EDGE = "src bigint, dst bigint, weight bigint"
PURCHASE = "user_id bigint, item_id bigint, day date, spent double"
NO_LIMIT = 10**9


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def chained(purchases):
    """Edges by brute force: sort each month's buyers of an item, link neighbours."""
    first = {}
    for user, item, day, _ in purchases:
        key = item, (day.year, day.month), user
        first[key] = min(day, first.get(key, day))
    buckets = defaultdict(list)
    for (item, month, user), day in first.items():
        buckets[item, month].append((day, user))
    weights = Counter()
    for buyers in buckets.values():
        buyers.sort()
        for (_, a), (_, b) in zip(buyers, buyers[1:]):
            weights[min(a, b), max(a, b)] += 1
    return sorted((a, b, w) for (a, b), w in weights.items())


def random_purchases(seed, n=400, people=40):
    r = random.Random(seed)
    # Ids far apart, and some of them in the same slot.
    ids = [r.randrange(200) if i % 2 else r.randrange(-10**9, 10**9) for i in range(people)]
    return [(r.choice(ids), r.choice([1, 1, 1, 2, 3]), dt.date(2020, r.choice([1, 2]), r.randrange(1, 6)), 1.0)
            for _ in range(n)]


@pytest.mark.parametrize("popular", [0, 60, NO_LIMIT])
@pytest.mark.parametrize("seed", [1, 2])
def test_edges_match_brute_force_however_items_are_split(table, run, seed, popular):
    bought = random_purchases(seed)
    assert rows(graph.edges(table(bought, PURCHASE), run, popular)) == chained(bought)


def test_hot_bucket_gives_a_chain_not_all_pairs(table, run):
    bought = [(u, 7, dt.date(2020, 1, 1), 1.0) for u in range(50) for _ in range(3)]
    for popular in (0, NO_LIMIT):
        assert rows(graph.edges(table(bought, PURCHASE), run, popular)) == [(u, u + 1, 1) for u in range(49)]


def test_edges_are_simple_and_links_symmetric(table, run):
    edges = run.write(graph.edges(table(random_purchases(3), PURCHASE), run), "edges")
    pairs = [(r.src, r.dst) for r in edges.collect()]
    assert all(a < b for a, b in pairs) and len(set(pairs)) == len(pairs)
    links = {(r.src, r.dst, r.weight) for r in graph.symmetric(edges).collect()}
    assert links == {(b, a, w) for a, b, w in links}


def test_interactions_are_distinct(table):
    bought = [(1, 2, dt.date(2020, 1, d), 1.0) for d in (1, 2, 3)] + [(1, 2, dt.date(2020, 2, 1), 1.0)]
    assert rows(graph.interactions(table(bought, PURCHASE))) == [
        (1, 2, dt.date(2020, 1, 1)), (1, 2, dt.date(2020, 2, 1))]


@pytest.mark.parametrize("spread", [1, 10**6])
def test_neighbour_lists_are_paged_by_position(table, run, spread):
    """A hub's pages are full and start at 0 however sparse the ids are."""
    star = [(0, leaf * spread, 1) for leaf in range(1, 30)] + [(spread, 2 * spread, 1)]
    pages = graph.neighbours(table(star, EDGE), run, page_size=10).collect()
    hub = sorted((r.page, r.neighbours) for r in pages if r.id == 0)
    assert hub == [(i, [x * spread for x in range(1 + 10 * i, min(11 + 10 * i, 30))]) for i in range(3)]
    assert {r.id // spread: r.neighbours for r in pages if 0 < r.id <= 3 * spread} == {
        1: [0, 2 * spread], 2: [0, spread], 3: [0]}
    assert all(r.page == 0 for r in pages if r.id)
    whole = graph.neighbours(table(star, EDGE), run).filter("id = 0").first()
    assert (whole.page, whole.neighbours) == (0, [x * spread for x in range(1, 30)])


def test_a_sparse_hub_of_5000_has_two_pages(spark, run):
    star = spark.range(1, 5001).selectExpr("0L as src", "id * 1000000 as dst", "1L as weight")
    pages = graph.neighbours(star, run).filter("id = 0").selectExpr("page", "size(neighbours) as n")
    assert rows(pages) == [(0, 4096), (1, 904)]


def test_ranges_are_even_however_ids_are_spread(spark):
    """99 % of the ids lie in 1 % of their range."""
    ids = spark.range(20_000).selectExpr("if(id % 100 = 0, id * 50000, id) as x").cache()
    bounds = quantile_bounds(ids, "x", 64)
    sizes = ids.groupBy(range_of(F.col("x"), bounds).alias("r")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("r").collect()
    assert len(sizes) > 50 and max(r.n for r in sizes) < 2 * 20_000 / 64
    assert all(a.high < b.low for a, b in zip(sizes, sizes[1:]))
    assert range_of(F.col("x"), [])._jc.toString() == "0"


def test_clustered_ids_of_a_hot_item_are_linked_right(table, run):
    bought = [(u if u % 100 else u * 10**6, 7, dt.date(2020, 1, 1 + u % 3), 1.0) for u in range(1_000)]
    assert rows(graph.edges(table(bought, PURCHASE), run, popular=0)) == chained(bought)


def users(table, *ids):
    return table([(i,) for i in ids], "id bigint")


def of_pairs(pairs):
    """Purchases in which each pair shares an item of its own."""
    return [(u, 1000 + k, dt.date(2020, 1, 1), 1.0) for k, pair in enumerate(pairs) for u in pair]


def weights(bought):
    """Shared (item, month) buckets of every two users, by brute force."""
    buckets = defaultdict(set)
    for user, item, day, _ in bought:
        buckets[item, day.year, day.month].add(user)
    out = Counter()
    for members in buckets.values():
        for a in members:
            for b in members:
                out[a, b] += a != b
    return +out


def incidence(table, run, bought):
    return run.write(graph.incidence(table(bought, PURCHASE), run), "incidence")


@pytest.mark.parametrize("seed", [1, 2])
def test_degrees_count_all_co_buyers(table, run, seed):
    bought = random_purchases(seed)
    want = Counter()
    for (a, _), w in weights(bought).items():
        want[a] += w
    assert rows(graph.degrees(incidence(table, run, bought))) == sorted(want.items())


def test_a_hot_bucket_gives_rows_not_pairs(table, run):
    bought = [(u, 7, dt.date(2020, 1, 1), 1.0) for u in range(50) for _ in range(3)] + [(99, 8, dt.date(2020, 1, 1), 1.0)]
    got = incidence(table, run, bought).collect()
    assert len(got) == 50 and {r.others for r in got} == {49}


@pytest.mark.parametrize("seed", [1, 2])
def test_co_buyers_are_all_pairs_of_a_bucket_once(table, run, seed):
    bought = random_purchases(seed) + [(u, 7, dt.date(2020, 1, 1), 1.0) for u in range(50)]
    got = rows(graph.co_buyers(incidence(table, run, bought), run))
    assert got == sorted({(a, b) for a, b in weights(bought) if a < b})


def test_star_centrality(table, run):
    star = incidence(table, run, of_pairs([(0, 1), (0, 2), (0, 3)]))
    central = graph.degree_centrality(users(table, 0, 1, 2, 3, 9), graph.degrees(star))
    assert {r.id: (r.degree, r.centrality) for r in central.collect()} == {
        0: (3, 0.75), 1: (1, 0.25), 2: (1, 0.25), 3: (1, 0.25), 9: (0, 0.0)}


def test_no_co_buyers_and_a_single_user_divide_by_nothing(table, run):
    none = incidence(table, run, [(1, 2, dt.date(2020, 1, 1), 1.0)])
    assert rows(graph.degree_centrality(users(table, 1), graph.degrees(none))) == [(1, 0, 0.0)]
    assert rows(pagerank(users(table, 1, 2), none, run)) == [(1, pytest.approx(0.15)), (2, pytest.approx(0.15))]


def ranked(people, links, rounds):
    degree = Counter()
    for (a, _), w in links.items():
        degree[a] += w
    rank = dict.fromkeys(people, 1.0)
    for _ in range(rounds):
        new = dict.fromkeys(people, 0.15)
        for (a, b), w in links.items():
            new[b] += 0.85 * rank[a] * w / degree[a]
        rank = new
    return rank


def test_triangle_keeps_rank_one_and_the_isolated_user_the_floor(table, run):
    triangle = incidence(table, run, of_pairs([(1, 2), (2, 3), (1, 3)]))
    got = {r.id: r.pagerank for r in pagerank(users(table, 1, 2, 3, 4), triangle, run).collect()}
    assert got == pytest.approx({1: 1.0, 2: 1.0, 3: 1.0, 4: 0.15})


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_pagerank_matches_brute_force_over_all_pairs(table, run, rounds):
    bought = random_purchases(5)
    people = sorted({b[0] for b in bought}) + [10**12]
    got = pagerank(users(table, *people), incidence(table, run, bought), run, rounds)
    want = ranked(people, weights(bought), rounds)
    assert {x.id: x.pagerank for x in got.collect()} == pytest.approx(want)


def test_pagerank_does_not_depend_on_partitioning(spark, table, run):
    bought, before = random_purchases(6), spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for n in (3, 13):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(rows(pagerank(users(table, *{b[0] for b in bought}), incidence(table, run, bought), run, 4)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]

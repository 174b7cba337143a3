"""Every registered query against its DuckDB twin, and the shape of its plan."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry
from admesh.sources import facts

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


AUDIENCE = list(entry._audience_queries())


def test_every_query_has_a_twin():
    assert AUDIENCE == list(entry._audience_oracles())


@pytest.mark.parametrize("name", AUDIENCE)
def test_matches_duckdb(spark, duck, name):
    ours, theirs = compare(spark, duck, FOLDER, name)
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
    assert ours[1]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", AUDIENCE)
def test_stays_declarative(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in text


def test_entry_returns_the_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 20
    assert [(-r.utility, r.id) for r in rows] == sorted((-r.utility, r.id) for r in rows)


def test_ranking_is_trimmed_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(entry.queries()["select_users_all_ads"](spark, FOLDER))


def test_scans_read_only_what_they_need(spark):
    purchases = plan(facts.purchases(spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_discount:double>" in purchases
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in purchases
    assert "EqualTo(p_brand,Brand#2)" in plan(facts.items(spark, FOLDER).filter("ad = 'Brand#2'"))


def joins_without_a_shuffle(text):
    """Sort-merge joins of the plan with a side that is not shuffled right below."""
    lines = [line.replace("*(", "  ").replace("+- ", "   ").replace(":- ", "   ") for line in text.splitlines()]
    depth = [len(line) - len(line.lstrip(" :0123456789)")) for line in lines]
    bad = []
    for i, line in enumerate(lines):
        if "SortMergeJoin" not in line:
            continue
        sides = [j for j in range(i + 1, len(lines)) if depth[j] > depth[i]]
        end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
        near = min(depth[j] for j in sides if j < end)
        for j in (j for j in sides if j < end and depth[j] == near):
            below = [lines[x] for x in range(j, min(j + 3, end))]
            if not any("Exchange" in x for x in below):
                bad.append(line.strip()[:120])
    return bad


@pytest.mark.parametrize("name", ["neighbour_affinity", "select_non_adjacent", "vertex_table"])
def test_joins_shuffle_both_sides_so_that_skew_is_split(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry.queries()[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and joins_without_a_shuffle(text) == []


def test_read_neighbours_are_all_co_buyers(spark):
    buckets = {}
    for r in entry.queries()["interactions"](spark, FOLDER).collect():
        buckets.setdefault((r.item_id, r.month), []).append(r.user_id)
    want = {(a, b) for users in buckets.values() for a in users for b in users if a != b}
    got = [tuple(r) for r in entry.queries()["read_neighbours"](spark, FOLDER).collect()]
    assert len(got) == len(want) and set(got) == want


def test_replaced_neighbour_lists_are_whole(spark):
    links = {tuple(r) for r in entry.queries()["edges_symmetric"](spark, FOLDER).select("src", "dst").collect()}
    got = {(r.id, int(d)) for r in entry.queries()["replace_neighbours"](spark, FOLDER).collect() if r.neighbours
           for d in r.neighbours.split(",")}
    assert got == links | {(src, src) for src, _ in links}

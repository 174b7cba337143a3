import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

from admesh.functions.columns import sale_value
from admesh.operators import affinity
from admesh.sources import facts
from admesh.sources.tables import SCHEMAS

PURCHASE = "user_id bigint, item_id bigint, day date, spent decimal(20,8)"
DAY = dt.date(2020, 1, 1)


@pytest.fixture
def items(table):
    return table([(1, "A"), (2, "A"), (3, "B")], "item_id bigint, ad string")


@pytest.fixture
def bought(table):
    return table([(1, 1, DAY, Decimal(30)), (1, 2, DAY, Decimal(10)), (1, 3, DAY, Decimal(60)), (2, 3, DAY, Decimal(5)),
                  (3, 1, DAY, Decimal(0)), (4, 99, DAY, Decimal(8)), (4, 1, DAY, Decimal(2))], PURCHASE)


def of_ad(items, ad):
    return items.filter(F.col("ad") == ad)


def test_sale_values_are_exact(table):
    got = table([(104999.91, 0.07), (914.44, 0.125), (900.68, -0.0), (0.0001, 0.0001)], "p double, d double").select(
        sale_value(F.col("p"), F.col("d")).alias("v")).collect()
    assert [r.v for r in got] == [Decimal("97649.9163"), Decimal("800.135"), Decimal("900.68"), Decimal("0.00009999")]


def test_spend_affinity(bought, items):
    got = {r.id: (r.affinity, r.bought) for r in affinity.spend_affinity(bought, of_ad(items, "A")).collect()}
    # User 3 spent nothing, so the share is unknown; item 99 belongs to no ad but counts as spend.
    assert got == {1: (0.4, 2), 2: (0.0, 0), 3: (None, 1), 4: (0.2, 1)}


def test_all_ads_agree_with_one_ad(bought, items):
    got = {(r.ad, r.id): r.affinity for r in affinity.spend_affinity_all_ads(bought, items).collect()}
    assert got == {("A", 1): 0.4, ("B", 1): 0.6, ("B", 2): 1.0, ("A", 3): None, ("A", 4): 0.2}


def test_spend_does_not_depend_on_partitioning(spark, items, table):
    purchases = table([(i % 5, i % 3 + 1, DAY, Decimal(i * 7919 % 10**9) / 7) for i in range(2000)], PURCHASE)
    one, many = (
        {r.id: r.affinity for r in affinity.spend_affinity(p, of_ad(items, "A")).collect()}
        for p in (purchases.coalesce(1), purchases.repartition(13)))
    assert one == many


def test_event_affinity(table):
    events = table([(1, 7, "view"), (1, 7, "click"), (1, 7, "purchase"), (1, 7, "error"),
                    (2, 7, "view"), (3, 7, "signup")], "user_id bigint, ad bigint, event_type string")
    got = {(r.id, r.ad): r.affinity for r in affinity.event_affinity(events).collect()}
    assert got == {(1, 7): pytest.approx(2 / 3), (2, 7): 0.0, (3, 7): None}


def test_neighbour_affinity_is_a_mean_over_co_buyers(table, run):
    # Users 1 and 2 share two buckets, so they count twice for each other.
    placed = [(1, 5), (2, 5), (1, 6), (2, 6), (1, 7), (3, 7), (4, 7)]
    sizes = {5: 1, 6: 1, 7: 2}
    near = table([(u, i, DAY, sizes[i]) for u, i in placed], "id bigint, item_id bigint, month date, others bigint")
    known = table([(1, 0.9), (2, 0.6), (3, None)], "id bigint, affinity double")
    got = {r.id: r.neighbour_affinity for r in affinity.neighbour_affinity(near, known, run).collect()}
    assert got == {1: 0.3, 2: 0.9, 3: 0.45, 4: 0.45}


def test_orders_without_a_customer_and_odd_ads_are_left_out(spark, tmp_path):
    def write(name, rows):
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    day = dt.datetime(2020, 1, 5)
    write("customer", [(1, "c", 0, 0.0, "BUILDING")])
    write("orders", [(10, 1, "O", 1.0, day, "p"), (11, 2, "O", 1.0, day, "p"), (12, None, "O", 1.0, day, "p")])
    write("lineitem", [(o, 7, 1, 1, 1.0, 80.0, 0.125, 0.0, "N", "O", day) for o in (10, 11, 12, 13)])
    write("events", [(i, day, 1, "click", 0.0, p) for i, p in enumerate(
        ['{"k": 69}', '{"k": 69.0}', '{"k": "70"}', '{"k": 1e2}', '{"k": null}', "{}", None, '{"k": -3}'])])
    bought = facts.purchases(spark, str(tmp_path)).collect()
    assert [(r.user_id, r.spent) for r in bought] == [(1, Decimal(70))]
    assert sorted(r.ad for r in facts.exposures(spark, str(tmp_path)).collect()) == [-3, 69, 70]
    duck = duckdb.connect()
    for name in ("customer", "orders", "lineitem", "events"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    names = "users", "purchases", "exposures"
    steps = ", ".join(f"{n} AS ({entry._STEPS[n]})" for n in names)
    assert duck.sql(f"WITH {steps} SELECT user_id, spent FROM purchases").fetchall() == [(1, Decimal(70))]
    assert sorted(duck.sql(f"WITH {steps} SELECT ad FROM exposures").fetchall()) == [(-3,), (69,), (70,)]

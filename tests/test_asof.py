import datetime as dt
import random

import pytest

from admesh.operators.asof import next_after

LEFT, RIGHT = "id int, key bigint, at timestamp_ntz", "key bigint, at timestamp_ntz, value bigint"


def moments(r, n, days):
    return [dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randrange(24 * days)) for _ in range(n)]


def brute(left, right):
    out = {}
    for id_, key, at in left:
        later = [(t, v) for k, t, v in right if None not in (k, t, v, key, at) and k == key and t >= at]
        out[id_] = min(later)[1] if later else None
    return out


@pytest.mark.parametrize("span", ["day", "month", "year"])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(table, seed, span):
    r = random.Random(seed)
    left = [(i, r.choice([1, 1, 1, 2, 3, 4]), at) for i, at in enumerate(moments(r, 300, 200))]
    right = sorted({(r.choice([1, 1, 2, 3]), at) for at in moments(r, 60, 220)})
    right = [(k, at, i) for i, (k, at) in enumerate(right)]
    got = next_after(table(left, LEFT), table(right, RIGHT), "key", "at", "value", span)
    assert got.columns == ["id", "key", "at", "value"]
    rows = got.collect()
    assert len(rows) == 300 and {x.id: x.value for x in rows} == brute(left, right)


def test_a_value_is_carried_over_empty_spans(table):
    at = dt.datetime
    left = [(1, 7, at(2020, 1, 1)), (2, 7, at(2023, 6, 1)), (3, 7, at(2024, 1, 5)), (4, 7, at(2024, 1, 6)), (5, 8, at(2020, 1, 1))]
    right = [(7, at(2024, 1, 5), 50)]
    got = next_after(table(left, LEFT), table(right, RIGHT), "key", "at", "value", "day").collect()
    assert {x.id: x.value for x in got} == {1: 50, 2: 50, 3: 50, 4: None, 5: None}


def test_nulls_repeats_clashing_columns_and_empty_tables(table):
    at = dt.datetime(2024, 1, 1)
    left = [(1, 7, at), (1, 7, at), (2, None, at), (3, 7, None)]
    right = [(7, at, 1), (None, at, 2), (8, None, 3), (9, at, None)]
    want = [(1, 7, at, 1), (1, 7, at, 1), (2, None, at, None), (3, 7, None, None)]
    got = next_after(table(left, LEFT), table(right, RIGHT), "key", "at", "value").collect()
    assert sorted(map(tuple, got), key=str) == want
    wide = table([x + ("r", 5, "v") for x in left], LEFT + ", row string, known int, value string")
    again = next_after(wide, table(right, RIGHT), "key", "at", "value").collect()
    assert sorted(((x.id, x.key, x["at"], x.value) for x in again), key=str) == want and again[0].row == "r"
    assert next_after(table([], LEFT), table(right, RIGHT), "key", "at", "value").collect() == []
    assert {x.value for x in next_after(table(left, LEFT), table([], RIGHT), "key", "at", "value").collect()} == {None}


def test_a_hot_key_is_split_by_time(table):
    plan = next_after(table([], LEFT), table([], RIGHT), "key", "at", "value")._jdf.queryExecution().executedPlan().toString()
    line = [x for x in plan.splitlines() if "Window" in x and "found" in x or "Window" in x and "last(known" in x]
    assert line and all("span" in x for x in line)
    assert "Join" not in plan

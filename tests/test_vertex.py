import pytest
from pyspark.sql import functions as F

from admesh.operators import vertex

ROWS = [(1, 0, 0.5, 0.1, 0.2, [2, 3]), (2, 0, None, 0.3, 0.0, [1]), (2, 1, None, 0.3, 0.0, [5000]),
        (3, 0, 0.0, None, None, None)]


@pytest.fixture
def vertices(spark):
    return spark.createDataFrame(ROWS, vertex.SCHEMA)


def records(df):
    return sorted(tuple(r) for r in df.collect())


def column(df, name):
    return {(r.id, r.page): r[name] for r in df.collect()}


def test_unscored_vertices_have_the_schema_and_only_nulls(table):
    df = vertex.unscored(table([(4,), (5,)], "id bigint"))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        (f.name, f.dataType.simpleString()) for f in vertex.SCHEMA]
    assert records(df) == [(4, 0, None, None, None, None), (5, 0, None, None, None, None)]


@pytest.mark.parametrize("attribute", vertex.SCORES)
def test_replace_overwrites_with_null_too(vertices, table, attribute):
    updates = table([(1, None), (2, 0.9), (7, 0.7)], f"id bigint, {attribute} double")
    after = vertex.replace(vertices, updates, attribute)
    old = column(vertices, attribute)
    assert column(after, attribute) == {(1, 0): None, (2, 0): 0.9, (2, 1): 0.9, (3, 0): old[3, 0]}
    assert after.columns == vertices.columns
    assert records(after.drop(attribute)) == records(vertices.drop(attribute))


def test_replace_neighbours_replaces_the_whole_list(vertices, table):
    updates = table([(1, 0, None), (2, 0, [8, 9])], "id bigint, page bigint, neighbours array<bigint>")
    after = vertex.replace(vertices, updates, "neighbours")
    assert column(after, "neighbours") == {(1, 0): None, (2, 0): [8, 9], (3, 0): None}
    assert column(after, "centrality") == {(1, 0): 0.1, (2, 0): 0.3, (3, 0): None}


def test_replace_id_leaves_neighbour_lists_alone(vertices, table):
    after = vertex.replace_id(vertices, table([(2, 20)], "id bigint, new_id bigint"))
    assert column(after, "neighbours") == {(1, 0): [2, 3], (20, 0): [1], (20, 1): [5000], (3, 0): None}


def test_read_gives_one_row_per_user_or_neighbour(vertices):
    assert records(vertex.read(vertices, "id")) == [(1,), (2,), (3,)]
    assert records(vertex.read(vertices, "centrality").filter("id < 3")) == [(1, 0.1), (2, 0.3)]
    assert records(vertex.read(vertices, "neighbours")) == [(1, 2), (1, 3), (2, 1), (2, 5000)]


def test_a_null_new_id_is_an_error(vertices, table):
    with pytest.raises(Exception, match="a new id is NULL"):
        vertex.replace_id(vertices, table([(2, None)], "id bigint, new_id bigint")).collect()


def test_scored_vertices_tell_unknown_from_none(table):
    scores = table([(1, 0.5, 0.25), (2, None, 0.5), (3, None, 0.0)], "id bigint, affinity double, centrality double")
    near = table([(1, 0, [2]), (2, 0, [1]), (2, 1, [9])], "id bigint, page bigint, neighbours array<bigint>")
    assert records(vertex.scored(scores, near, F.lit(0.5))) == [
        (1, 0, 0.5, 0.25, 0.25, [2]), (2, 0, None, 0.5, 0.0, [1]), (2, 1, None, 0.5, 0.0, [9]),
        (3, 0, None, 0.0, 0.0, [])]


def test_reading_an_attribute_needs_no_shuffle(vertices):
    plan = vertex.read(vertices, "affinity")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

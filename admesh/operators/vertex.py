"""Vertex records as tables.

A user's record is one row, page 0, whose neighbour list continues on further
rows with the same scores and the next ``page`` once it is longer than a page.
NULL means "not computed"; 0.0 and the empty array mean "computed, none".
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from admesh.functions.columns import utility_score

SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("page", T.LongType(), False),
    T.StructField("affinity", T.DoubleType()),
    T.StructField("centrality", T.DoubleType()),
    T.StructField("utility", T.DoubleType()),
    T.StructField("neighbours", T.ArrayType(T.LongType(), False)),
])
SCORES = ("affinity", "centrality", "utility")


def unscored(users: DataFrame) -> DataFrame:
    """Vertices known by id only."""
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMA if f.name not in ("id", "page")]
    return users.select("id", F.lit(0).cast("bigint").alias("page"), *empty)


def heads(scores: DataFrame, largest: Column) -> DataFrame:
    """The scores of vertices, one row each, from ``id, affinity, centrality``; ``largest`` is the greatest centrality."""
    utility = utility_score(F.coalesce("affinity", F.lit(0.0)), F.col("centrality"), largest)
    return scores.select("id", "affinity", "centrality", utility.alias("utility"))


def with_lists(heads: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Vertices with all attributes from their scores and neighbour lists; users without a list get an empty one.

    Pass tables rather than queries: both are read twice, and a join of two
    scans lets the skew join split a hub's pages.
    """
    alone = heads.join(neighbours.filter(F.col("page") == 0), "id", "left_anti").select(
        "*", F.lit(0).cast("bigint").alias("page"), F.array().cast("array<bigint>").alias("neighbours"))
    return (
        neighbours.join(heads, "id").unionByName(alone)
        .select("id", "page", *SCORES, "neighbours")
    )


def scored(scores: DataFrame, neighbours: DataFrame, largest: Column) -> DataFrame:
    """Vertices with all attributes from ``id, affinity, centrality`` and neighbour lists, see the parts above."""
    return with_lists(heads(scores, largest), neighbours)


def read(vertices: DataFrame, attribute: str) -> DataFrame:
    """One attribute per user, of vertices or their heads; neighbours come as one row per neighbour."""
    if attribute == "neighbours":
        return vertices.select("id", F.explode("neighbours").alias("neighbour"))
    vertices = vertices.filter(F.col("page") == 0) if "page" in vertices.columns else vertices
    return vertices.select(*dict.fromkeys(["id", attribute]))


def replace(vertices: DataFrame, updates: DataFrame, attribute: str) -> DataFrame:
    """Overwrite one attribute from ``updates``, NULL values included.

    Score updates hold one row per id. Neighbour updates hold a user's whole
    new list as ``id, page, neighbours`` from page 0 on; they are read twice, so
    pass a table rather than a query. Ids without an update keep the old value.
    """
    if attribute == "neighbours":
        kept = vertices.join(updates.filter(F.col("page") == 0), "id", "left_anti")
        heads = vertices.filter(F.col("page") == 0).select("id", *SCORES)
        return kept.unionByName(heads.join(updates.select("id", "page", "neighbours"), "id"))
    changed = updates_with_hit(updates, attribute)
    return (
        vertices.join(changed, "id", "left")
        .withColumn(attribute, F.when(F.col("hit"), F.col("new")).otherwise(F.col(attribute)))
        .drop("new", "hit")
    )


def replace_id(vertices: DataFrame, new_ids: DataFrame) -> DataFrame:
    """Re-key vertices from ``id, new_id``. Other users' neighbour lists keep the old id.

    An id is a key, so a NULL ``new_id`` is an error, raised when the rows are
    read. Two vertices given the same id are two rows with that id, as two
    records would be.
    """
    given = updates_with_hit(new_ids, "new_id")
    key = F.when(F.col("hit"), F.coalesce("new", F.raise_error("a new id is NULL").cast("bigint")))
    return vertices.join(given, "id", "left").withColumn("id", key.otherwise(F.col("id"))).drop("new", "hit")


def updates_with_hit(updates: DataFrame, column: str) -> DataFrame:
    """``id, new, hit``; ``hit`` tells a NULL update from none."""
    return updates.select("id", F.col(column).alias("new"), F.lit(True).alias("hit"))

"""Triangles and cores of the edge listing ``src, dst`` (each edge once, ``src < dst``)."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from admesh.functions.columns import ratio
from admesh.operators.graph import symmetric
from admesh.storage import RunFolder


def listing_degrees(edges: DataFrame) -> DataFrame:
    """``id, degree`` of every user in the listing: its number of edges."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def triangles(users: DataFrame, edges: DataFrame, run: RunFolder) -> DataFrame:
    """``id, degree, triangles, clustering`` of every user.

    Clustering is the share of a user's pairs of neighbours that are linked, 0
    with fewer than two. Every edge is turned towards its end of higher degree,
    so a user of whatever degree keeps at most sqrt(2 m) of its m edges as its
    own, and a hub none but those to other hubs. A triangle is found once, from
    its lowest end, where the own neighbours of both ends of an edge agree.
    """
    degrees = run.write(listing_degrees(edges), "listing_degrees")
    links = edges.select("src", "dst")
    for end in ("src", "dst"):
        links = links.join(degrees.select(F.col("id").alias(end), F.struct("degree", "id").alias(f"{end}_rank")), end)
    upward = links.select(F.least("src_rank", "dst_rank").alias("low"), F.greatest("src_rank", "dst_rank").alias("high"))
    own = run.write(
        upward.select(F.col("low.id").alias("id"), F.col("high.id").alias("higher"))
        .groupBy("id").agg(F.collect_list("higher").alias("own")), "own_neighbours")
    sides = own.select(F.col("id").alias("a"), F.explode("own").alias("b"), F.col("own").alias("of_a")).join(
        own.select(F.col("id").alias("b"), F.col("own").alias("of_b")), "b")
    both = sides.select("a", "b", F.array_intersect("of_a", "of_b").alias("third")).filter(F.size("third") > 0)
    corners = both.select(F.inline(F.concat(
        F.array(F.struct(F.col("a").alias("id"), F.size("third").alias("n")),
                F.struct(F.col("b").alias("id"), F.size("third").alias("n"))),
        F.transform("third", lambda c: F.struct(c.alias("id"), F.lit(1).alias("n"))))))
    counted = corners.groupBy("id").agg(F.sum("n").alias("triangles"))
    none = F.lit(0).cast("bigint")
    degree = F.coalesce("degree", none)
    return (
        users.join(degrees, "id", "left").join(counted, "id", "left")
        .select("id", degree.alias("degree"), F.coalesce("triangles", none).alias("triangles"),
                F.round(F.coalesce(ratio(2 * F.coalesce("triangles", none), degree * (degree - 1)), F.lit(0.0)), 6)
                .alias("clustering"))
    )


def core_numbers(users: DataFrame, edges: DataFrame, run: RunFolder) -> DataFrame:
    """``id, core`` of every user: the largest k such that it lies in a part of the listing where all have k neighbours.

    Cores start at the degrees and sink: a user's becomes the largest h for
    which h of its neighbours have h at least, until nothing changes (Lu et al.,
    "The H-index of a network node and its relation to degree and coreness"). A
    round looks only at users with a neighbour that changed in the round before.
    A hub's neighbours are counted by value on the map side.
    """
    links = run.write(symmetric(edges.select("src", "dst")), "links")
    known = run.write(
        links.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("core")).withColumn("changed", F.lit(True)), "cores")
    while known.filter("changed").head(1):
        moved = known.filter("changed").select(F.col("id").alias("dst"))
        asked = run.write(
            links.join(moved, "dst", "left_semi").select(F.col("src").alias("id")).distinct(), "asked")
        values = links.withColumnRenamed("src", "id").join(asked, "id", "left_semi").join(
            known.select(F.col("id").alias("dst"), F.col("core").alias("value")), "dst")
        counted = values.groupBy("id", "value").agg(F.count(F.lit(1)).alias("n"))
        at_least = F.sum("n").over(Window.partitionBy("id").orderBy(F.desc("value")))
        index = counted.select("id", F.least("value", at_least).alias("h")).groupBy("id").agg(F.max("h").alias("h"))
        lower = (F.col("h") < F.col("core")) & F.col("h").isNotNull()
        known = run.write(
            known.drop("changed").join(index, "id", "left")
            .select("id", F.when(lower, F.col("h")).otherwise(F.col("core")).alias("core"),
                    F.coalesce(lower, F.lit(False)).alias("changed")), "cores")
    return users.join(known.select("id", "core"), "id", "left").select(
        "id", F.coalesce("core", F.lit(0).cast("bigint")).alias("core"))

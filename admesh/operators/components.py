"""Connected components of a link table by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admesh.storage import RunFolder


def components(links: DataFrame, run: RunFolder) -> DataFrame:
    """``id, component`` of every linked node; the component is its smallest id.

    ``links`` holds undirected ``a, b``. In turn every node hands its larger
    neighbours, then its smaller ones, to the smallest id around it (Kiveris et
    al., "Connected Components in MapReduce and Beyond"), until each node hangs
    on its component's smallest id. Minima are summed on the map side and joined
    back, so a hub's neighbours are never gathered; every turn is written, which
    bounds the lineage.
    """
    edges = run.write(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())
        large = run.write(large, "large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = run.write(small, "small")
        if not edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").head(1):
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct())


def roots(parents: DataFrame, run: RunFolder) -> DataFrame:
    """``id, component`` of a forest ``id, parent`` in which every parent is smaller than its child.

    Every turn hangs each node on its parent's parent, which halves the depth;
    a root need not be listed as an id. Cheaper than ``components`` where each
    node has one link only.
    """
    known = run.write(parents.select("id", F.col("parent").alias("component")), "parents")
    while True:
        above = known.select(F.col("id").alias("component"), F.col("component").alias("above"))
        raised = run.write(known.join(above, "component", "left").select(
            "id", F.coalesce("above", "component").alias("component"), F.col("above").isNotNull().alias("moved")), "raised")
        known = raised.select("id", "component")
        if not raised.filter("moved").head(1):
            return known.union(known.select("component", "component").distinct())

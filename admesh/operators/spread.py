"""Measures that spread over the user graph: distances, components, communities.

All of them move along (item, month) buckets. A bucket takes something from its
users and gives something back, so a round handles one row per purchase at most
and a bestseller's bucket is never turned into pairs of users.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admesh.operators.components import components
from admesh.storage import RunFolder

BUCKET = ["item_id", "month"]


def hop_distance(users: DataFrame, picks: DataFrame, incidence: DataFrame, run: RunFolder) -> DataFrame:
    """``id, hops`` of every user: steps between co-buyers from the nearest pick, NULL if none leads there.

    A round starts from the users reached in the round before, opens those of
    their buckets that are still closed, and reaches the buckets' other users. A
    bucket is opened once and a user reached once. Once the opened buckets hold
    half of the remaining rows, the rest is written anew, so all rounds together
    write no more than twice the purchases; the search ends with an empty round.
    """
    rest = run.write(incidence.select("id", *BUCKET, "others"), "closed")
    held = rest.count()
    frontier = run.write(
        picks.select("id").distinct().join(users, "id", "left_semi").withColumn("hops", F.lit(0).cast("bigint")), "frontier")
    known, opened, passed, hops = frontier, None, 0, 0
    while frontier.head(1):
        hops += 1
        touched = rest.join(frontier.select("id"), "id", "left_semi").select(*BUCKET, "others").distinct()
        if opened is not None:
            touched = touched.join(opened.select(*BUCKET), BUCKET, "left_anti")
        touched = run.write(touched, "opened")
        reached = rest.join(touched.select(*BUCKET), BUCKET, "left_semi").select("id").distinct()
        frontier = run.write(
            reached.join(known.select("id"), "id", "left_anti").withColumn("hops", F.lit(hops).cast("bigint")), "frontier")
        known = known.union(frontier)
        opened = touched if opened is None else opened.union(touched)
        passed += touched.agg(F.coalesce(F.sum(F.col("others") + 1), F.lit(0))).first()[0]
        if 2 * passed >= held > 0:
            rest = run.write(rest.join(opened.select(*BUCKET), BUCKET, "left_anti"), "closed")
            held, passed, opened = held - passed, 0, None
            known = run.write(known, "reached")
        elif hops % 16 == 0:  # keeps the plan of a long search short
            known, opened = run.write(known, "reached"), run.write(opened, "opened")
    return users.join(run.write(known, "reached"), "id", "left").select("id", "hops")


def user_components(users: DataFrame, incidence: DataFrame, run: RunFolder) -> DataFrame:
    """``id, component`` of every user: the smallest id that chains of co-buyers lead to, its own without co-buyers.

    A bucket links its users with its smallest id, one link per purchase, and
    the links are contracted until every user hangs on its component's smallest.
    """
    placed = run.write(incidence.select("id", *BUCKET), "placed")
    least = run.write(placed.groupBy(*BUCKET).agg(F.min("id").alias("least")), "least")
    links = placed.join(least, BUCKET).filter("id != least").select(F.col("id").alias("a"), F.col("least").alias("b"))
    found = run.write(components(links, run), "components")
    return users.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def communities(users: DataFrame, incidence: DataFrame, run: RunFolder, rounds: int = 5) -> DataFrame:
    """``id, community`` of every user after ``rounds`` of label propagation between users and buckets.

    Users start with their ids as labels. In a round every bucket takes the most
    frequent label of its users, then every user the most frequent label of its
    buckets, the lowest of equally frequent ones each time. Labels are counted
    on the map side, so a hot bucket or user is a histogram. Users without
    co-buyers keep their ids.
    """
    placed = run.write(incidence.select("id", *BUCKET), "placed")
    labels = run.write(placed.select("id").distinct().withColumn("label", F.col("id")), "labels")
    for _ in range(rounds):
        named = placed.join(labels, "id").select(*BUCKET, "label")
        given = run.write(_most_frequent(named, BUCKET), "given")
        labels = run.write(_most_frequent(placed.join(given, BUCKET).select("id", "label"), ["id"]), "labels")
    return users.join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("community"))


def _most_frequent(named: DataFrame, by: list[str]) -> DataFrame:
    """The most frequent ``label`` of every group, the lowest of equally frequent ones."""
    counted = named.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("n"))
    first = F.max(F.struct("n", (-F.col("label")).alias("minus")))
    return counted.groupBy(*by).agg(first.alias("first")).select(*by, (-F.col("first.minus")).alias("label"))

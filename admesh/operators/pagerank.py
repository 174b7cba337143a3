"""PageRank over all co-buyers, by way of their buckets."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admesh.functions.columns import exact_sum
from admesh.storage import RunFolder


def pagerank(users: DataFrame, incidence: DataFrame, run: RunFolder, rounds: int = 10, damping: float = 0.85) -> DataFrame:
    """``id, pagerank`` of every user after a fixed number of rounds.

    Every round each user's rank becomes ``1 - damping + damping * sum(rank *
    weight / degree)`` over the co-buyers, starting from 1; weight counts shared
    buckets. A round sums the users' shares per bucket and the buckets per user,
    less the user's own share in each, so it moves one row per purchase at most.
    Shares are summed as decimals and do not depend on the order of rows. What a
    round joins is written or a plain scan, so that a hot bucket or user is
    split by the skew join; the writes also bound plan and lineage.
    """
    placed = run.write(incidence.select("id", "item_id", "month"), "placed")
    ranks = run.write(
        incidence.groupBy("id").agg(F.sum("others").alias("degree"), F.count(F.lit(1)).alias("buckets"))
        .withColumn("pagerank", F.lit(1.0)), "ranks")
    for _ in range(rounds):
        share = (F.col("pagerank") / F.col("degree")).alias("share")
        sums = run.write(
            placed.join(ranks.select("id", share), "id").groupBy("item_id", "month")
            .agg(exact_sum(F.col("share")).alias("whole")), "sums")
        received = placed.join(sums, ["item_id", "month"]).groupBy("id").agg(exact_sum(F.col("whole")).alias("all"))
        own = F.col("buckets") * F.col("pagerank") / F.col("degree")
        ranks = run.write(
            ranks.join(received, "id")
            .select("id", "degree", "buckets", (F.lit(1.0 - damping) + damping * (F.col("all") - own)).alias("pagerank")),
            "ranks")
    alone = 1.0 if rounds == 0 else 1.0 - damping
    return (
        users.join(ranks.select("id", "pagerank"), "id", "left")
        .select("id", F.coalesce("pagerank", F.lit(alone)).alias("pagerank"))
    )

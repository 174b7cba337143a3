"""From scores to the users to show an ad to."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admesh.functions.columns import exact_sum, utility_score
from admesh.storage import RunFolder

SALTS = 512


def utility(affinity: DataFrame, centrality: DataFrame, largest: Column) -> DataFrame:
    """Join scores on ``id`` and add ``utility``; keeps the other affinity columns.

    ``largest`` is the greatest centrality of all users.
    """
    return (
        affinity.join(centrality.select("id", "centrality"), "id")
        .withColumn("utility", utility_score(F.coalesce("affinity", F.lit(0.0)), F.col("centrality"), largest))
    )


def top_users(scores: DataFrame, k: int) -> DataFrame:
    """The k best users, lower id first among equals."""
    return scores.orderBy(F.desc("utility"), F.asc("id")).limit(k)


def top_users_per_ad(scores: DataFrame, k: int) -> DataFrame:
    """The k best users of every ad with their ``rank``."""
    best_first = [F.desc("utility"), F.asc("id")]
    trimmed = scores.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    if k > int(trimmed):
        # Beyond the built-in trimming, rank within salted parts of an ad first:
        # the k best of an ad are among the k best of its parts.
        part = Window.partitionBy("ad", F.pmod(F.xxhash64("id"), F.lit(SALTS))).orderBy(*best_first)
        scores = scores.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= k)
    ad = Window.partitionBy("ad").orderBy(*best_first)
    return (
        scores.withColumn("rank", F.row_number().over(ad).cast("bigint"))
        .filter(F.col("rank") <= k)
    )


def non_adjacent(scores: DataFrame, incidence: DataFrame, run: RunFolder) -> DataFrame:
    """Users ahead of all the scored users who share a bucket with them, so no two picks are adjacent.

    A user must be the best of every bucket it is in. A map-side maximum finds a
    bucket's best, so its buyers are never compared in pairs. Scores are written
    because they are used twice; the buckets' best because a scan on either side
    lets the skew join split a hot bucket.
    """
    # Compares like the selection: higher utility, then lower id.
    standing = F.struct("utility", (-F.col("id")).alias("minus_id"))
    scores = run.write(scores, "scores")
    placed = run.write(
        incidence.select("id", "item_id", "month").join(scores.select("id", standing.alias("standing")), "id"), "placed")
    best = run.write(placed.groupBy("item_id", "month").agg(F.max("standing").alias("best")), "best")
    beaten = placed.join(best, ["item_id", "month"]).filter("standing < best").select("id").distinct()
    return scores.join(beaten, "id", "left_anti")


def reach(picks: DataFrame, incidence: DataFrame) -> DataFrame:
    """One row, ``reach``: how many unpicked users share a bucket with a pick."""
    picked = picks.select("id")
    buckets = incidence.join(picked, "id", "left_semi").select("item_id", "month").distinct()
    return (
        incidence.join(buckets, ["item_id", "month"], "left_semi")
        .select("id").distinct().join(picked, "id", "left_anti")
        .agg(F.count(F.lit(1)).alias("reach"))
    )


def ad_summary(scores: DataFrame) -> DataFrame:
    """Users, mean and largest utility of every ad."""
    return scores.groupBy("ad").agg(
        F.count(F.lit(1)).alias("users"),
        F.round(exact_sum(F.col("utility")) / F.count("utility"), 6).alias("mean_utility"),
        F.max("utility").alias("max_utility"))

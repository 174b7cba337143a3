"""How strongly a user is drawn to an ad."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from admesh.functions.columns import exact_sum, ratio
from admesh.storage import RunFolder


def spend_affinity(purchases: DataFrame, items_of_ad: DataFrame) -> DataFrame:
    """Share of each buyer's spend that went to one ad's items: ``id, affinity, bought``.

    ``bought`` counts the purchases of the ad's items.
    """
    advertised = items_of_ad.select("item_id", F.lit(True).alias("advertised"))
    return (
        purchases.join(advertised, "item_id", "left")
        .groupBy(F.col("user_id").alias("id"))
        .agg(F.sum("spent").alias("total"),
             F.coalesce(F.sum(F.when(F.col("advertised"), F.col("spent"))), F.lit(0)).alias("on_ad"),
             F.count("advertised").alias("bought"))
        .select("id", ratio(F.col("on_ad"), F.col("total")).alias("affinity"), "bought")
    )


def spend_affinity_all_ads(purchases: DataFrame, items: DataFrame) -> DataFrame:
    """Spend share of every (ad, user) pair with a purchase: ``ad, id, affinity``.

    The window sees at most one row per ad for each user.
    """
    spend = (
        purchases.join(items, "item_id", "left")
        .groupBy("ad", F.col("user_id").alias("id"))
        .agg(F.sum("spent").alias("on_ad"))
    )
    total = F.sum("on_ad").over(Window.partitionBy("id"))
    return (
        spend.select("ad", "id", ratio(F.col("on_ad"), total).alias("affinity"))
        .filter(F.col("ad").isNotNull())
    )


def event_counts(exposures: DataFrame) -> DataFrame:
    """``id, ad, taken, shown``: a user's clicks and purchases on an ad, and these with the views."""
    def seen(*kinds: str):
        return F.count(F.when(F.col("event_type").isin(*kinds), True))
    return exposures.groupBy(F.col("user_id").alias("id"), "ad").agg(
        seen("click", "purchase").alias("taken"), seen("view", "click", "purchase").alias("shown"))


def event_affinity(exposures: DataFrame) -> DataFrame:
    """Share of a user's exposures to an ad that ended in a click or purchase."""
    return event_counts(exposures).select("id", "ad", ratio(F.col("taken"), F.col("shown")).alias("affinity"))


def neighbour_affinity(incidence: DataFrame, affinity: DataFrame, run: RunFolder) -> DataFrame:
    """Mean affinity of each user's co-buyers, weighted by shared buckets; a missing affinity counts as 0.

    Affinities are summed per bucket, then per user, less the user's own in each
    bucket. All join sides are written, so hot buckets and users are split.
    """
    own = run.write(
        incidence.join(affinity.select("id", "affinity"), "id", "left")
        .withColumn("affinity", F.coalesce("affinity", F.lit(0.0))), "own_affinity")
    sums = run.write(own.groupBy("item_id", "month").agg(exact_sum(F.col("affinity")).alias("whole")), "bucket_affinity")
    others = exact_sum(F.col("whole")) - exact_sum(F.col("affinity"))
    return (
        own.join(sums, ["item_id", "month"]).groupBy("id")
        .agg(F.round(others / F.sum("others"), 6).alias("neighbour_affinity"))
    )

"""Breakdowns by every combination of some columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admesh.functions.columns import SHARE, ratio


def user_cube(facts: DataFrame, by: list[str], spent: str, score: str) -> DataFrame:
    """Distinct users, spend and mean score of every combination of ``by``, subtotals included.

    ``facts`` holds ``id``, the columns of ``by``, money and a score. Columns that
    are not part of a combination are NULL; ``grouping_id`` has a bit set for each
    of them, the first column's highest, so a NULL of the data is told apart.

    Facts are folded to one row per finest combination and range of ids first,
    its users as a bitmap. The bitmaps of subtotals are unions, so what is
    multiplied by the number of combinations are these rows, not the facts, and
    users are counted exactly although they occur in many. Sums are decimals and
    do not depend on the order of rows. A NULL id counts no user, a NULL money or
    score adds nothing.
    """
    folded = (
        facts.groupBy(*by, F.bitmap_bucket_number("id").alias("range"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("users"), F.sum(spent).alias("spent"),
             F.sum(F.col(score).cast(SHARE)).alias("score"), F.count(score).alias("scores")))
    united = (
        folded.withColumn("part", F.col("range"))  # grouped with every combination, so never rolled up
        .groupingSets([[*(c for i, c in enumerate(by) if mask >> i & 1), "part"] for mask in range(1 << len(by))], *by, "part")
        .agg((F.grouping_id() / 2).cast("bigint").alias("grouping_id"), F.bitmap_or_agg("users").alias("users"),
             F.sum("spent").alias("spent"), F.sum("score").alias("score"), F.sum("scores").alias("scores")))
    return (
        united.groupBy(*by, "grouping_id")
        .agg(F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0).cast("bigint")).alias("users"), F.sum("spent").cast("double").alias("spent"),
             ratio(F.sum("score"), F.sum("scores")).alias(f"mean_{score}"))
        .select(*by, "grouping_id", "users", "spent", f"mean_{score}"))

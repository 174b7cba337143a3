"""Users, ads, purchases and exposures, as seen by the operators."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.functions.columns import sale_value
from admesh.sources.tables import table


def users(spark: SparkSession, folder: str) -> DataFrame:
    """One row per user: ``id``."""
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))


def items(spark: SparkSession, folder: str) -> DataFrame:
    """The ad (brand) each item belongs to: ``item_id, ad``."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("ad"))


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line of a known user: ``user_id, item_id, day, spent``."""
    lines = (
        table(spark, folder, "lineitem")
        .filter(F.col("l_partkey").isNotNull())
        .select("l_orderkey", F.col("l_partkey").alias("item_id"),
                sale_value(F.col("l_extendedprice"), F.col("l_discount")).alias("spent"))
    )
    orders = (
        table(spark, folder, "orders")
        .filter(F.col("o_custkey").isNotNull() & F.col("o_orderdate").isNotNull())
        .select("o_orderkey", F.col("o_custkey").alias("user_id"),
                F.col("o_orderdate").cast("date").alias("day"))
        .join(users(spark, folder), F.col("user_id") == F.col("id"), "left_semi")
    )
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("user_id", "item_id", "day", "spent")
    )


def with_ad(events: DataFrame) -> DataFrame:
    """The events of known users that name an ad, with ``ad``: the whole number in the event's JSON."""
    number = F.get_json_object("props", "$.k")
    return (
        events.filter(F.col("user_id").isNotNull())
        .withColumn("ad", F.when(number.rlike("^-?[0-9]+$"), number.try_cast("bigint")))
        .filter(F.col("ad").isNotNull())
    )


def exposures_of(events: DataFrame) -> DataFrame:
    """``user_id, ad, event_type`` of raw events."""
    return with_ad(events).select("user_id", "ad", "event_type")


def exposures(spark: SparkSession, folder: str) -> DataFrame:
    """Ad events: ``user_id, ad, event_type``."""
    return exposures_of(table(spark, folder, "events"))


def ad_events(spark: SparkSession, folder: str) -> DataFrame:
    """Ad events with their time: ``event_id, at, id, ad, event_type``."""
    return with_ad(table(spark, folder, "events")).select(
        "event_id", F.col("ts").alias("at"), F.col("user_id").alias("id"), "ad", "event_type")


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """``id, segment`` of every user."""
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))

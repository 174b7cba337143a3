"""As-of join: each row with the next row of another table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def next_after(left: DataFrame, right: DataFrame, by: str, time: str, value: str, span: str = "month") -> DataFrame:
    """``left`` with ``value``: that of the next row of ``right`` with the same ``by``, at the same ``time`` or later.

    ``value`` is NULL where none follows or where the row's key or time is NULL.
    ``right`` holds ``by, time, value`` with one row per key and time; rows with a
    NULL among them are left out. Every row of ``left`` gives one row, in its
    columns; a column called ``value`` is replaced.

    Both sides are put in one line per key, latest first, and the value last
    seen is carried along. A long line is cut into calendar spans (a unit of
    ``date_trunc``), so a key with a large part of all rows is many groups. Each
    span that follows none of ``right`` starts with a carry row: the first value
    of the nearest later span that has one, found from one row per key and span.
    """
    columns = [c for c in left.columns if c != value]
    kept = right.select(by, time, value).filter(
        F.col(by).isNotNull() & F.col(time).isNotNull() & F.col(value).isNotNull())
    order = T.StructType([kept.schema[time], kept.schema[value]])

    def placed(df, rank, row, known):
        """``by``, span, time, rank within equal times, the left row, and the value of a right one."""
        return df.select(F.col(by).alias("key"), F.date_trunc(span, F.col(time)).alias("span"), F.col(time).alias("at"),
                         F.lit(rank).alias("rank"), row.alias("row"), known.alias("known"))
    row = F.struct(*(F.col(c) for c in columns))
    lefts = placed(left, 1, row, F.lit(None).cast(kept.schema[value].dataType))
    rights = placed(kept, 0, F.lit(None).cast(T.StructType([left.schema[c] for c in columns])), F.col(value))

    # One row per key and span: its first right row, if any, and that of the nearest later span.
    heads = (
        rights.groupBy("key", "span").agg(F.min(F.struct("at", "known")).cast(_named(order)).alias("head"))
        .unionByName(lefts.select("key", "span").distinct().withColumn("head", F.lit(None).cast(_named(order))))
        .groupBy("key", "span").agg(F.max("head").alias("head")))
    later = Window.partitionBy("key").orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    carries = (
        heads.withColumn("next", F.last("head", ignorenulls=True).over(later)).filter(F.col("next").isNotNull())
        .select("key", "span", F.lit(None).cast(left.schema[time].dataType).alias("at"), F.lit(-1).alias("rank"),
                F.lit(None).cast(T.StructType([left.schema[c] for c in columns])).alias("row"), F.col("next.known").alias("known")))
    line = (
        Window.partitionBy("key", "span").orderBy(F.desc_nulls_first("at"), "rank")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    every = lefts.unionByName(rights).unionByName(carries)
    named = F.col("key").isNotNull() & F.col("at").isNotNull()
    return (
        every.withColumn("found", F.when(named, F.last("known", ignorenulls=True).over(line)))
        .filter("rank = 1").select("row.*", F.col("found").alias(value)))


def _named(order: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(n, f.dataType) for n, f in zip(("at", "known"), order.fields)])

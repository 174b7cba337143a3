"""The user graph: purchases as a bipartite graph, and a listing of consecutive buyers.

Two users are neighbours once for every (item, month) *bucket* that both bought
in. Measures over all co-buyers are sums over buckets, so no pair is ever built:
a bucket of a million buyers is a million rows.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from admesh.functions.columns import quantile_bounds, range_of, ratio
from admesh.storage import RunFolder

PAGE = 4096
POPULAR = 1_000_000
SLOTS = 4096
RANGES = 4096


def interactions(purchases: DataFrame) -> DataFrame:
    """The distinct ``user_id, item_id, month`` of all purchases."""
    return purchases.select("user_id", "item_id", F.trunc("day", "month").alias("month")).distinct()


def incidence(purchases: DataFrame, run: RunFolder) -> DataFrame:
    """``id, item_id, month, others`` of buckets with several buyers; ``others`` counts a user's co-buyers.

    Both join sides are scans of written tables, so a bucket that holds a large
    part of the rows is split like any skewed join.
    """
    bought = run.write(interactions(purchases).withColumnRenamed("user_id", "id"), "interactions")
    sizes = run.write(
        bought.groupBy("item_id", "month").agg((F.count(F.lit(1)) - 1).alias("others")).filter("others > 0"), "buckets")
    return bought.join(sizes, ["item_id", "month"]).select("id", "item_id", "month", "others")


def degrees(incidence: DataFrame) -> DataFrame:
    """``id, degree`` of every user with a co-buyer; a pair counts once per shared bucket."""
    return incidence.groupBy("id").agg(F.sum("others").alias("degree"))


def degree_centrality(users: DataFrame, degrees: DataFrame) -> DataFrame:
    """``id, degree, centrality`` of every user; centrality is ``degree / (n - 1)``."""
    others = users.agg(F.count(F.lit(1)) - 1).scalar()
    degree = F.coalesce("degree", F.lit(0).cast("bigint"))
    return (
        users.join(degrees, "id", "left")
        .select("id", degree.alias("degree"),
                F.coalesce(ratio(degree, others), F.lit(0.0)).alias("centrality"))
    )


def edges(purchases: DataFrame, run: RunFolder, popular: int = POPULAR) -> DataFrame:
    """Undirected edges between consecutive buyers of an item in a month: a listing, not all co-buyers.

    The buyers of an item in a month are ordered by first day, then id; each is
    linked to the next. Weight counts the (item, month) pairs in which two users
    are linked. The edge count stays below the row count of ``purchases``
    however popular an item is.

    An item with at most ``popular`` purchases is small enough to place each of
    its months whole, so one shuffle serves both the grouping and the window. A
    popular item's repeated purchases are folded on the map side and its buyers
    ordered within (item, day, slot), a slot being a range of ids between two
    quantiles of the popular items' buyers; only the ends of these runs, at most
    2 * 31 * SLOTS per item and month, are then ordered across slots and days.
    """
    by_month = Window.partitionBy("item_id", "month").orderBy("day", "user_id")
    by_slot = Window.partitionBy("item_id", "day", "slot").orderBy("user_id")
    buyer_before = F.lag("user_id")

    # Written, so that the joins below are planned on its real size.
    popular_items = run.write(
        purchases.groupBy("item_id").count().filter(F.col("count") > popular).select("item_id"), "popular_items")
    bought = purchases.select("item_id", F.trunc("day", "month").alias("month"), "day", "user_id")
    hot = bought.join(popular_items, "item_id", "left_semi")
    slot = range_of(F.col("user_id"), quantile_bounds(hot, "user_id", SLOTS) if popular_items.head(1) else [])

    ordinary = (
        _buyers(bought.join(popular_items, "item_id", "left_anti").repartition("item_id", "month"))
        .withColumn("before", buyer_before.over(by_month))
    )
    runs = (
        # Without the month, which the day gives back, so both uses share one shuffle.
        _buyers(hot).drop("month")
        .withColumn("slot", slot)
        .withColumn("before", buyer_before.over(by_slot))
        .withColumn("after", F.lead("user_id").over(by_slot))
    )
    run_starts = (
        runs.filter(F.col("before").isNull() | F.col("after").isNull())
        .withColumn("month", F.trunc("day", "month"))
        .withColumn("previous", buyer_before.over(by_month))
        .filter(F.col("before").isNull())
        .withColumn("before", F.col("previous"))
    )
    steps = (
        ordinary.select("before", "user_id")
        .unionByName(runs.select("before", "user_id"))
        .unionByName(run_starts.select("before", "user_id"))
        .filter(F.col("before").isNotNull())
    )
    return (
        steps.groupBy(F.least("before", "user_id").alias("src"), F.greatest("before", "user_id").alias("dst"))
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def _buyers(bought: DataFrame) -> DataFrame:
    """Each buyer of an item in a month once, with the first day."""
    return bought.groupBy("item_id", "month", "user_id").agg(F.min("day").alias("day"))


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, in one pass over the edges."""
    more = [c for c in edges.columns if c not in ("src", "dst")]
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), *more)
    return edges.select(F.inline(F.array(F.struct("src", "dst", *more), back)))


def co_buyers(incidence: DataFrame, run: RunFolder) -> DataFrame:
    """``src, dst`` of every two co-buyers, once, the lower id first.

    For whole neighbour lists only: the rows grow with the square of a bucket's
    buyers, as the lists do. Both join sides are scans of one written table, so
    a hot bucket is split on both sides.
    """
    placed = run.write(incidence.select("id", "item_id", "month"), "placed")
    ahead = placed.withColumnRenamed("id", "src")
    return (
        ahead.join(placed.withColumnRenamed("id", "dst"), ["item_id", "month"])
        .filter("src < dst").select("src", "dst").distinct()
    )


def neighbours(edges: DataFrame, run: RunFolder, page_size: int = PAGE) -> DataFrame:
    """Sorted neighbour lists: ``id, page, neighbours``, cut into pages as below."""
    return lists(symmetric(edges.select("src", "dst")), run, page_size)


def lists(links: DataFrame, run: RunFolder, page_size: int = PAGE) -> DataFrame:
    """Every ``src``'s sorted list of ``dst``, from distinct links of one direction: ``id, page, neighbours``.

    A list is cut by position into pages of ``page_size`` neighbours, so page 0
    always exists and every page but the last is full. Only a hub's links need
    their positions worked out: links are counted per range of ids, the counts
    summed up, and positions numbered within the ranges. Ranges lie between
    quantiles of the hubs' neighbours, at most RANGES of them, so no task orders
    a whole hub or more than RANGES counts of it, however sparse the ids are.
    """
    hubs = run.write(
        links.groupBy("src").agg(F.count(F.lit(1)).alias("degree")).filter(F.col("degree") > page_size).select("src"),
        "hubs")
    many = links.join(hubs, "src", "left_semi")
    many = many.withColumn("range", range_of(F.col("dst"), quantile_bounds(many, "dst", RANGES) if hubs.head(1) else []))
    ahead = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = many.groupBy("src", "range").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("src", "range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("src", "range").orderBy("dst")) - 1
    paged = many.withColumn("within", within).join(offsets, ["src", "range"]).select(
        "src", F.floor((F.col("offset") + F.col("within")) / page_size).cast("bigint").alias("page"), "dst")
    ordinary = links.join(hubs, "src", "left_anti").select("src", F.lit(0).cast("bigint").alias("page"), "dst")
    return (
        ordinary.unionByName(paged).groupBy(F.col("src").alias("id"), "page")
        .agg(F.sort_array(F.collect_list("dst")).alias("neighbours"))
    )

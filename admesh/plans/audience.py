"""Audience selection over one folder of tables."""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.functions.columns import whole_seconds
from admesh.operators import affinity, graph, select, spread, structure, vertex
from admesh.operators.asof import next_after
from admesh.operators.cover import cover_users
from admesh.operators.cube import user_cube
from admesh.operators.pagerank import pagerank
from admesh.sinks.store import Store
from admesh.sources import facts
from admesh.storage import RunFolder
from admesh.streaming.affinity import SCHEMA as COUNTS
from admesh.streaming.affinity import affinities, update_affinity


class Audience:
    """Queries over the tables of ``folder``.

    A table that several branches or queries read is written once to the run's
    folder, when the first query that needs it is built, and scanned from there.
    A query that reads the purchases once scans the sources instead. ``close``
    deletes the written tables once the results are stored elsewhere.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.run = RunFolder(spark)

    def close(self) -> None:
        self.run.remove()

    @cached_property
    def users(self) -> DataFrame:
        return facts.users(self.spark, self.folder)

    @cached_property
    def items(self) -> DataFrame:
        return facts.items(self.spark, self.folder)

    @cached_property
    def exposures(self) -> DataFrame:
        return facts.exposures(self.spark, self.folder)

    @cached_property
    def purchases(self) -> DataFrame:
        """Written, for queries that use both spend and graph."""
        return self.run.write(facts.purchases(self.spark, self.folder), "purchases")

    def _purchases_once(self) -> DataFrame:
        """The written purchases if there are any, else the sources."""
        return self.__dict__.get("purchases") or facts.purchases(self.spark, self.folder)

    @cached_property
    def incidence(self) -> DataFrame:
        return graph.incidence(self._purchases_once(), self.run)

    @cached_property
    def degrees(self) -> DataFrame:
        """Written: read for the scores and for their maximum."""
        return self.run.write(graph.degrees(self.incidence), "degrees")

    @cached_property
    def edges(self) -> DataFrame:
        # Read for ordinary, popular and id ranges, so the purchases are written.
        return graph.edges(self.purchases, self.run)

    @cached_property
    def listing(self) -> DataFrame:
        """The edges, written: read for hubs and lists, and more than once for triangles and cores."""
        return self.run.write(self.edges, "edges")

    @cached_property
    def neighbours(self) -> DataFrame:
        return self.run.write(graph.neighbours(self.listing, self.run), "neighbours")

    @cached_property
    def all_neighbours(self) -> DataFrame:
        """Neighbour lists of all co-buyers instead of the listing's; their pairs are written, as the lists read them more than once."""
        pairs = self.run.write(graph.co_buyers(self.incidence, self.run), "co_buyers")
        return self.run.write(graph.neighbours(pairs, self.run), "all_neighbours")

    @cached_property
    def pagerank(self) -> DataFrame:
        """Written: read for the scores and for their maximum."""
        return self.run.write(pagerank(self.users, self.incidence, self.run), "pagerank")

    def interactions(self) -> DataFrame:
        return graph.interactions(self._purchases_once())

    def degree_centrality(self) -> DataFrame:
        return graph.degree_centrality(self.users, self.degrees)

    def centrality(self, measure: str = "degree") -> tuple[DataFrame, Column]:
        """``id, centrality`` by ``degree`` or ``pagerank``, and the greatest centrality."""
        if measure == "pagerank":
            return (self.pagerank.withColumnRenamed("pagerank", "centrality"),
                    self.pagerank.agg(F.max("pagerank")).scalar())
        others = self.users.agg(F.count(F.lit(1)) - 1).scalar()
        greatest = self.degrees.agg(F.max("degree")).scalar()
        return (self.degree_centrality().select("id", "centrality"),
                F.coalesce(graph.ratio(greatest, others), F.lit(0.0)))

    def _spend_affinity(self, ad: str, purchases: DataFrame) -> DataFrame:
        # Written, so that the join with all purchases is planned on its real size.
        items_of_ad = self.run.write(self.items.filter(F.col("ad") == ad).select("item_id"), "items_of_ad")
        return affinity.spend_affinity(purchases, items_of_ad)

    def affinity_spend(self, ad: str) -> DataFrame:
        """Spend affinity of every user, NULL without purchases."""
        known = self._spend_affinity(ad, self._purchases_once())
        return self.users.join(known.select("id", "affinity"), "id", "left")

    def affinity_events(self) -> DataFrame:
        return affinity.event_affinity(self.exposures)

    def utility(self, measure: str = "degree") -> DataFrame:
        """Score of every (ad, user) pair with a purchase of the ad's items."""
        spend = affinity.spend_affinity_all_ads(self.purchases, self.items)
        return select.utility(spend, *self.centrality(measure))

    def candidates(self, ad: str, measure: str = "degree") -> DataFrame:
        """Scores of the users who bought one ad's items."""
        buyers = self._spend_affinity(ad, self.purchases).filter(F.col("bought") > 0).drop("bought")
        return select.utility(buyers, *self.centrality(measure))

    def select_users(self, ad: str, k: int = 20, measure: str = "degree") -> DataFrame:
        """The k users to show one ad to."""
        return select.top_users(self.candidates(ad, measure), k)

    def select_users_all_ads(self, k: int = 5) -> DataFrame:
        """The k users to show each ad to."""
        return select.top_users_per_ad(self.utility(), k)

    def select_non_adjacent(self, ad: str) -> DataFrame:
        return select.non_adjacent(self.candidates(ad), self.incidence, self.run)

    def _picks(self, ad: str, k: int) -> DataFrame:
        """The k best users' ids, written: few rows that are read more than once."""
        return self.run.write(self.select_users(ad, k).select("id"), "picks")

    def audience_reach(self, ad: str, k: int = 20) -> DataFrame:
        return select.reach(self._picks(ad, k), self.incidence)

    def hop_distance(self, ad: str, k: int = 20) -> DataFrame:
        """Every user's steps between co-buyers from the nearest of an ad's picks."""
        return spread.hop_distance(self.users, self._picks(ad, k), self.incidence, self.run)

    def components(self) -> DataFrame:
        return spread.user_components(self.users, self.incidence, self.run)

    def communities(self, rounds: int = 5) -> DataFrame:
        return spread.communities(self.users, self.incidence, self.run, rounds)

    def triangles(self) -> DataFrame:
        return structure.triangles(self.users, self.listing, self.run)

    def core_numbers(self) -> DataFrame:
        return structure.core_numbers(self.users, self.listing, self.run)

    def cover_users(self, ad: str, k: int = 20) -> DataFrame:
        """The k buyers of an ad's items who together reach most users."""
        buyers = self._spend_affinity(ad, self.purchases).filter(F.col("bought") > 0).select("id")
        return cover_users(buyers.join(self.users, "id", "left_semi"), self.incidence, self.run, k)

    def next_purchase(self) -> DataFrame:
        """Each view or click of an ad with the user's next purchase event, of whatever ad, and the seconds between."""
        events = facts.ad_events(self.spark, self.folder)
        bought = (
            events.filter(F.col("event_type") == "purchase").groupBy("id", "at")
            .agg(F.min(F.struct("event_id", "ad", "at")).alias("purchase")))
        seen = events.filter(F.col("event_type").isin("view", "click")).select("event_id", "id", "ad", "at")
        return next_after(seen, bought, "id", "at", "purchase").select(
            "event_id", "id", "ad", F.col("purchase.event_id").alias("purchase_id"), F.col("purchase.ad").alias("purchase_ad"),
            whole_seconds(F.col("at"), F.col("purchase.at")).alias("seconds"))

    def audience_cube(self) -> DataFrame:
        """Users, spend and mean utility by every combination of ad, segment and month."""
        by_month = (
            self.purchases.join(self.items, "item_id")
            .groupBy("ad", F.col("user_id").alias("id"), F.trunc("day", "month").alias("month")).agg(F.sum("spent").alias("spent")))
        scores = self.utility().select("ad", "id", "utility")
        rows = by_month.filter(F.col("ad").isNotNull()).join(scores, ["ad", "id"]).join(
            facts.segments(self.spark, self.folder), "id")
        return user_cube(rows, ["ad", "segment", "month"], "spent", "utility")

    def vertex_store(self, ad: str) -> Store:
        """An ad's vertex table in a store of its own, which lives as long as this run's tables."""
        store = Store(self.spark, self.run.place("vertices"), vertex.SCHEMA)
        store.write(self.vertex_table(ad))
        return store

    def affinity_stream(self) -> DataFrame:
        """W9 from a stream of the event files that are there now; ``events.parquet`` is a file or a directory of files."""
        store = Store(self.spark, self.run.place("affinities"), COUNTS)
        # A table's files come in no order of time, so they are one batch: no event is late.
        update_affinity(self.spark, f"{self.folder}/events*.parquet", store, self.run.place("progress"), self.run, files=None)
        return affinities(store)

    def neighbour_affinity(self, ad: str) -> DataFrame:
        known = self._spend_affinity(ad, self.purchases)
        return affinity.neighbour_affinity(self.incidence, known, self.run)

    def ad_summary(self) -> DataFrame:
        return select.ad_summary(self.utility())

    def vertex_ids(self) -> DataFrame:
        return vertex.unscored(self.users)

    def vertex_heads(self, ad: str) -> DataFrame:
        """The vertex table's scores without the neighbour lists, one row per user."""
        others = self.users.agg(F.count(F.lit(1)) - 1).scalar()
        _, greatest = self.centrality()
        scores = (
            self.users.join(self._spend_affinity(ad, self._purchases_once()).select("id", "affinity"), "id", "left")
            .join(self.degrees, "id", "left")
            .select("id", "affinity",
                    F.coalesce(graph.ratio(F.coalesce("degree", F.lit(0)), others), F.lit(0.0)).alias("centrality"))
        )
        return vertex.heads(scores, greatest)

    def vertex_table(self, ad: str, heads: DataFrame | None = None, whole: bool = False) -> DataFrame:
        """All attributes of every user; ``heads`` takes the place of the computed scores.

        The neighbours are those of the listing, or all co-buyers if ``whole``.
        """
        self.purchases  # written before the scores read them, as the listing needs them too
        heads = self.vertex_heads(ad) if heads is None else heads
        return vertex.with_lists(self.run.write(heads, "heads"), self.all_neighbours if whole else self.neighbours)

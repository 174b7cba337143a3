
from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.functions.columns import id_list
from admesh.operators import graph, vertex
from admesh.operators.affinity import event_affinity
from admesh.plans.audience import Audience
from admesh.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


AD = "Brand#2"


def entry(spark: SparkSession) -> DataFrame:
    """The 20 users to show the ad for ``Brand#2`` to."""
    return _audience(spark, "/root/testdata/sf0.001").select_users(AD, 20)


_AUDIENCES: dict[tuple[str, str], Audience] = {}


def _audience(spark: SparkSession, folder: str) -> Audience:
    """One audience per session and folder, so that the queries share its written tables."""
    key = spark.sparkContext.applicationId, folder
    if key not in _AUDIENCES:
        _AUDIENCES[key] = Audience(spark, folder)
    return _AUDIENCES[key]


def forget_audiences() -> None:
    """Delete the tables written so far; queries built earlier stop working."""
    while _AUDIENCES:
        _AUDIENCES.popitem()[1].close()


def _on(query: Callable[[Audience], DataFrame]) -> Query:
    return lambda spark, folder: query(_audience(spark, folder))


def _as_text(vertices: DataFrame) -> DataFrame:
    return vertices.withColumn("neighbours", id_list(F.col("neighbours")))


def _set_centrality(audience: Audience) -> DataFrame:
    """The scored table with PageRank as every user's centrality, NULL for users without co-buyers."""
    known = audience.degrees.select("id", F.lit(True).alias("linked"))
    updates = audience.pagerank.join(known, "id", "left").select(
        "id", F.when(F.col("linked"), F.round("pagerank", 6)).alias("centrality"))
    return audience.vertex_table(AD, vertex.replace(audience.vertex_heads(AD), updates, "centrality"))


def _seen(audience: Audience) -> DataFrame:
    """Event affinity to ad 7."""
    return event_affinity(audience.exposures.filter(F.col("ad") == 7))


def _set_utility(audience: Audience) -> DataFrame:
    """The scored table with the event affinity to ad 7 as every user's utility, NULL without events."""
    updates = audience.users.join(_seen(audience), "id", "left").select("id", F.col("affinity").alias("utility"))
    return audience.vertex_table(AD, vertex.replace(audience.vertex_heads(AD), updates, "utility"))


def _set_affinity(audience: Audience) -> DataFrame:
    return vertex.replace(audience.vertex_ids(), audience.affinity_spend(AD), "affinity")


def _set_neighbours(audience: Audience) -> DataFrame:
    """The scored table where every user's list becomes its neighbours and itself, NULL for users without neighbours."""
    links = graph.symmetric(audience.listing.select("src", "dst"))
    own = links.select("src").distinct().select("src", F.col("src").alias("dst"))
    closed = audience.run.write(graph.lists(links.unionByName(own), audience.run), "closed")
    alone = audience.users.join(closed.filter(F.col("page") == 0), "id", "left_anti").select(
        "id", F.lit(0).cast("bigint").alias("page"), F.lit(None).cast("array<bigint>").alias("neighbours"))
    return vertex.replace(
        audience.vertex_table(AD), audience.run.write(closed.unionByName(alone), "updates"), "neighbours")


def _vertex_store(audience: Audience) -> DataFrame:
    """The stored vertex table after the event affinities to ad 7 have replaced those users' affinity in place."""
    store = audience.vertex_store(AD)
    updates = audience.run.write(_seen(audience), "updates")
    store.update(updates, lambda old: vertex.replace(old, updates, "affinity"), audience.run)
    return store.read()


def _replace_id(audience: Audience) -> DataFrame:
    """Re-key the users of one market segment to ids that lead with their country."""
    new_ids = (
        table(audience.spark, audience.folder, "customer").filter(F.col("c_mktsegment") == "BUILDING")
        .select(F.col("c_custkey").alias("id"),
                (F.col("c_nationkey") * F.lit(10**12) + F.col("c_custkey")).alias("new_id"))
    )
    return _as_text(vertex.replace_id(audience.vertex_ids(), new_ids))


def _vertex_update(audience: Audience) -> DataFrame:
    """Spend affinity, overwritten by the event affinity to ad 7 where there were events."""
    return vertex.read(vertex.replace(_set_affinity(audience), _seen(audience), "affinity"), "affinity")


def _rounded(scores: DataFrame, column: str) -> DataFrame:
    """Ten rounds of PageRank end a few units in the last place apart in different engines."""
    return scores.withColumn(column, F.round(column, 6))


def _text_operators():
    """The training-data operators' queries, or None where that subpackage is not installed."""
    if importlib.util.find_spec("admesh.llm") is None or importlib.util.find_spec("corpus_pipeline") is None:
        return None
    from admesh.llm import registry

    return registry


def queries() -> dict[str, Query]:
    text = _text_operators()
    return _audience_queries() | (text.queries() if text else {})


def _audience_queries() -> dict[str, Query]:
    return {
        "vertex_ids": _on(lambda a: _as_text(a.vertex_ids())),
        "vertex_table": _on(lambda a: _as_text(a.vertex_table(AD))),
        "vertex_update": _on(_vertex_update),
        "read_id": _on(lambda a: vertex.read(a.vertex_ids(), "id")),
        "read_affinity": _on(lambda a: vertex.read(_set_affinity(a), "affinity")),
        "read_centrality": _on(lambda a: vertex.read(a.vertex_heads(AD), "centrality")),
        "read_utility": _on(lambda a: vertex.read(a.vertex_heads(AD), "utility")),
        "read_neighbours": _on(lambda a: vertex.read(a.vertex_table(AD, whole=True), "neighbours")),
        "replace_id": _on(_replace_id),
        "replace_affinity": _on(lambda a: _as_text(_set_affinity(a))),
        "replace_centrality": _on(lambda a: _as_text(_set_centrality(a))),
        "replace_utility": _on(lambda a: _as_text(_set_utility(a))),
        "replace_neighbours": _on(lambda a: _as_text(_set_neighbours(a))),
        "interactions": _on(lambda a: a.interactions()),
        "edges": _on(lambda a: a.edges),
        "edges_symmetric": _on(lambda a: graph.symmetric(a.edges)),
        "neighbours": _on(lambda a: _as_text(a.neighbours)),
        "degree_centrality": _on(lambda a: a.degree_centrality()),
        "pagerank": _on(lambda a: _rounded(a.pagerank, "pagerank")),
        "affinity_spend": _on(lambda a: a.affinity_spend(AD)),
        "affinity_events": _on(lambda a: a.affinity_events()),
        "utility": _on(lambda a: a.utility()),
        "utility_pagerank": _on(lambda a: _rounded(a.utility(measure="pagerank"), "centrality")),
        "select_users": _on(lambda a: a.select_users(AD, 20)),
        "select_users_pagerank": _on(lambda a: _rounded(a.select_users(AD, 20, "pagerank"), "centrality")),
        "select_users_all_ads": _on(lambda a: a.select_users_all_ads(5)),
        "neighbour_affinity": _on(lambda a: a.neighbour_affinity(AD)),
        "ad_summary": _on(lambda a: a.ad_summary()),
        "select_non_adjacent": _on(lambda a: a.select_non_adjacent(AD)),
        "audience_reach": _on(lambda a: a.audience_reach(AD, 20)),
        "hop_distance": _on(lambda a: a.hop_distance(AD, 20)),
        "components": _on(lambda a: a.components()),
        "communities": _on(lambda a: a.communities(5)),
        "triangles": _on(lambda a: a.triangles()),
        "core_numbers": _on(lambda a: a.core_numbers()),
        "next_purchase": _on(lambda a: a.next_purchase()),
        "audience_cube": _on(lambda a: a.audience_cube()),
        "affinity_stream": _on(lambda a: a.affinity_stream()),
        "vertex_store": _on(lambda a: _as_text(_vertex_store(a))),
        "cover_users": _on(lambda a: a.cover_users(AD, 20)),
    }


# Named steps of the oracle queries; each may use the ones before it.
_STEPS = {
    "users": "SELECT c_custkey AS id FROM customer",
    "purchases": """
        SELECT o_custkey AS user_id, l_partkey AS item_id,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(min(o_orderdate) AS DATE) AS day,
               sum(CAST(l_extendedprice AS DECIMAL(18, 4)) * (1 - CAST(l_discount AS DECIMAL(8, 4)))) AS spent
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
        WHERE l_partkey IS NOT NULL AND o_orderdate IS NOT NULL
        GROUP BY 1, 2, 3""",
    # Every two users who bought an item in the same month; weight counts the (item, month) they share.
    "pairs": """
        SELECT a.user_id AS src, b.user_id AS dst, count(*) AS weight
        FROM purchases a JOIN purchases b ON a.item_id = b.item_id AND a.month = b.month AND a.user_id <> b.user_id
        GROUP BY 1, 2""",
    "degrees": "SELECT src AS id, CAST(sum(weight) AS BIGINT) AS degree FROM pairs GROUP BY 1",
    "degree_centrality": """
        SELECT id, coalesce(degree, 0) AS degree,
               coalesce(coalesce(degree, 0) / nullif((SELECT CAST(count(*) - 1 AS DOUBLE) FROM users), 0), 0.0)
                   AS centrality
        FROM users LEFT JOIN degrees USING (id)""",
    # The listing of consecutive buyers of an item in a month.
    "steps": """
        SELECT user_id, lag(user_id) OVER (PARTITION BY item_id, month ORDER BY day, user_id) AS before FROM purchases""",
    "edges": """
        SELECT least(before, user_id) AS src, greatest(before, user_id) AS dst, count(*) AS weight
        FROM steps WHERE before IS NOT NULL GROUP BY 1, 2""",
    "links": "SELECT src, dst, weight FROM edges UNION ALL SELECT dst, src, weight FROM edges",
    "positions": f"""
        SELECT src AS id, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {graph.PAGE} AS page, dst
        FROM links""",
    "lists": """
        SELECT id, page, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS neighbours
        FROM positions GROUP BY 1, 2""",
    "spend": """
        SELECT user_id AS id, CAST(sum(spent) AS DOUBLE) AS total,
               CAST(sum(CASE WHEN p_brand = 'Brand#2' THEN spent ELSE 0 END) AS DOUBLE) AS on_ad,
               count(CASE WHEN p_brand = 'Brand#2' THEN 1 END) AS bought
        FROM purchases LEFT JOIN part ON p_partkey = item_id GROUP BY 1""",
    "affinity": """
        SELECT id, on_ad / nullif(total, 0) AS affinity FROM users LEFT JOIN spend USING (id)""",
    "spend_by_ad": """
        SELECT p_brand AS ad, user_id AS id, CAST(sum(spent) AS DOUBLE) AS on_ad
        FROM purchases LEFT JOIN part ON p_partkey = item_id GROUP BY 1, 2""",
    "affinity_by_ad": """
        SELECT ad, s.id, s.on_ad / nullif(total, 0) AS affinity
        FROM spend_by_ad s JOIN spend t ON t.id = s.id WHERE ad IS NOT NULL""",
    "exposures": """
        SELECT user_id AS id, TRY_CAST(props->>'$.k' AS BIGINT) AS ad, event_type
        FROM events WHERE user_id IS NOT NULL AND regexp_full_match(props->>'$.k', '-?[0-9]+')
            AND TRY_CAST(props->>'$.k' AS BIGINT) IS NOT NULL""",
    "affinity_by_events": """
        SELECT id, ad,
               CAST(count(CASE WHEN event_type IN ('click', 'purchase') THEN 1 END) AS DOUBLE)
                   / nullif(count(CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 1 END), 0) AS affinity
        FROM exposures GROUP BY 1, 2""",
}

_ROUNDS = {"rank_0": "SELECT id, 1.0::DOUBLE AS pagerank FROM users"} | {
    f"rank_{i}": f"""
        SELECT u.id, 0.15 + 0.85 * coalesce(s.shares, 0) AS pagerank
        FROM users u LEFT JOIN (
            SELECT l.dst AS id, sum(r.pagerank * l.weight / d.degree) AS shares
            FROM pairs l JOIN rank_{i - 1} r ON r.id = l.src JOIN degrees d ON d.id = l.src
            GROUP BY 1) s ON s.id = u.id"""
    for i in range(1, 11)
}
_PAGERANK = {"pagerank_centrality": "SELECT id, pagerank AS centrality FROM rank_10"}


def _utility(affinity: str, centrality: str) -> str:
    return f"""
        SELECT a.*, c.centrality,
               round(coalesce(coalesce(affinity, 0) * c.centrality
                   / nullif((SELECT max(centrality) FROM {centrality}), 0), 0), 6) AS utility
        FROM ({affinity}) a JOIN {centrality} c ON c.id = a.id"""


_BUYERS = "SELECT id, affinity FROM affinity JOIN spend USING (id) WHERE bought > 0"
_SCORES = {
    "scores": _utility(_BUYERS, "degree_centrality"),
    "scores_by_ad": _utility("SELECT ad, id, affinity FROM affinity_by_ad", "degree_centrality"),
    "picks": "SELECT * FROM scores ORDER BY utility DESC, id LIMIT 20",
}
_PAGERANK_SCORES = {
    "scores": _utility(_BUYERS, "pagerank_centrality"),
    "scores_by_ad": _utility("SELECT ad, id, affinity FROM affinity_by_ad", "pagerank_centrality"),
}
_VERTICES = {
    "vertices": """
        SELECT u.id, coalesce(l.page, 0) AS page, a.affinity, c.centrality,
               round(coalesce(coalesce(a.affinity, 0) * c.centrality
                   / nullif((SELECT max(centrality) FROM degree_centrality), 0), 0), 6) AS utility,
               coalesce(l.neighbours, '') AS neighbours
        FROM users u JOIN affinity a ON a.id = u.id JOIN degree_centrality c ON c.id = u.id
        LEFT JOIN lists l ON l.id = u.id""",
}

# A user's neighbours and the user itself.
_CLOSED = {
    "closed": "SELECT src, dst FROM links UNION SELECT src, src FROM links",
    "closed_lists": f"""
        SELECT id, page, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS neighbours FROM (
            SELECT src AS id, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {graph.PAGE} AS page, dst FROM closed)
        GROUP BY 1, 2""",
}


# Breadth-first levels: a user's first one stays.
_HOPS = {
    "hops(id, hops) USING KEY (id)": """
        SELECT id, 0::BIGINT FROM picks
        UNION
        SELECT p.dst, min(h.hops) + 1 FROM hops h JOIN pairs p ON p.src = h.id
        WHERE p.dst NOT IN (SELECT id FROM recurring.hops) GROUP BY 1""",
}
_COMPONENTS = {
    "reached(id, component) USING KEY (id)": """
        SELECT id, id FROM users
        UNION
        SELECT p.dst, min(h.component) FROM reached h JOIN pairs p ON p.src = h.id JOIN recurring.reached r ON r.id = p.dst
        WHERE h.component < r.component GROUP BY 1""",
}
# Each bucket takes its users' most frequent label, then each user its buckets' most frequent label.
_COMMUNITIES = {
    "placed": """
        SELECT user_id AS id, item_id, month FROM purchases
        WHERE (item_id, month) IN (SELECT (item_id, month) FROM purchases GROUP BY ALL HAVING count(*) > 1)""",
    "labels_0": "SELECT id, id AS label FROM users",
} | {name: body for i in range(1, 6) for name, body in {
    f"given_{i}": f"""
        SELECT item_id, month, label FROM (
            SELECT item_id, month, label, row_number() OVER (PARTITION BY item_id, month ORDER BY count(*) DESC, label) AS place
            FROM placed JOIN labels_{i - 1} USING (id) GROUP BY 1, 2, 3) WHERE place = 1""",
    f"votes_{i}": f"""
        SELECT id, label FROM (
            SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, label) AS place
            FROM placed JOIN given_{i} USING (item_id, month) GROUP BY 1, 2) WHERE place = 1""",
    f"labels_{i}": f"SELECT u.id, coalesce(v.label, u.id) AS label FROM users u LEFT JOIN votes_{i} v ON v.id = u.id",
}.items()}
_TRIANGLES = {
    "corners": """
        SELECT unnest([a.src, a.dst, b.dst]) AS id FROM edges a JOIN edges b ON b.src = a.dst
        JOIN edges c ON c.src = a.src AND c.dst = b.dst""",
    "counted": "SELECT id, count(*) AS n FROM corners GROUP BY 1",
    "linked": "SELECT src AS id, count(*) AS degree FROM links GROUP BY 1",
}
_CORE_ROUNDS = 40
_CORES = {"cores_0": "SELECT src AS id, count(*) AS core FROM links GROUP BY 1"} | {
    f"cores_{i}": f"""
        SELECT id, max(least(core, place)) AS core FROM (
            SELECT l.src AS id, c.core, row_number() OVER (PARTITION BY l.src ORDER BY c.core DESC) AS place
            FROM links l JOIN cores_{i - 1} c ON c.id = l.dst) GROUP BY 1"""
    for i in range(1, _CORE_ROUNDS + 1)
}
# Every user reaches itself and its co-buyers; each round picks the candidate with most users not reached before.
_COVER = {
    "reach": "SELECT src AS id, dst AS met FROM pairs UNION SELECT id, id FROM users",
    "buyers": "SELECT s.id FROM spend s JOIN users USING (id) WHERE bought > 0",
    "pick_0": "SELECT NULL::BIGINT AS id, 0::BIGINT AS gain WHERE false",
    "met_0": "SELECT NULL::BIGINT AS id WHERE false",
} | {name: body for i in range(1, 21) for name, body in {
    f"pick_{i}": f"""
        SELECT id, count(*) AS gain FROM reach JOIN buyers USING (id) WHERE met NOT IN (SELECT id FROM met_{i - 1})
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    f"met_{i}": f"SELECT id FROM met_{i - 1} UNION SELECT met FROM reach WHERE id IN (SELECT id FROM pick_{i})",
}.items()}


def _sql(query: str, *more: dict[str, str]) -> str:
    steps = dict(_STEPS)
    for extra in more:
        steps |= extra
    recursive = "RECURSIVE " if any("USING KEY" in name for name in steps) else ""
    hint = {name: "MATERIALIZED " for name in steps if name.startswith(("cores_", "pick_", "met_", "labels_"))}
    named = ",\n".join(f"{name} AS {hint.get(name, '')}({body})" for name, body in steps.items())
    return f"WITH {recursive}{named}\n{query}"


def _unscored(page="CAST(0 AS BIGINT)", affinity="CAST(NULL AS DOUBLE)", centrality="CAST(NULL AS DOUBLE)",
              utility="CAST(NULL AS DOUBLE)", neighbours="CAST(NULL AS VARCHAR)", key="u.id", source="") -> str:
    return f"""SELECT {key} AS id, {page} AS page, {affinity} AS affinity, {centrality} AS centrality,
        {utility} AS utility, {neighbours} AS neighbours FROM users u {source}"""


def oracle_sql() -> dict[str, str]:
    text = _text_operators()
    return _audience_oracles() | (text.oracle_sql() if text else {})


def _audience_oracles() -> dict[str, str]:
    return {
        "vertex_ids": _sql(_unscored()),
        "vertex_table": _sql("SELECT * FROM vertices", _VERTICES),
        "vertex_update": _sql("""
            SELECT u.id, CASE WHEN e.id IS NOT NULL THEN e.affinity ELSE a.affinity END AS affinity
            FROM users u JOIN affinity a ON a.id = u.id
            LEFT JOIN affinity_by_events e ON e.id = u.id AND e.ad = 7"""),
        "read_id": _sql("SELECT id FROM users"),
        "read_affinity": _sql("SELECT id, affinity FROM affinity"),
        "read_centrality": _sql("SELECT id, centrality FROM degree_centrality"),
        "read_utility": _sql("SELECT id, utility FROM vertices WHERE page = 0", _VERTICES),
        "read_neighbours": _sql("SELECT src AS id, dst AS neighbour FROM pairs"),
        "replace_id": _sql(_unscored(
            key="CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey * 1000000000000 + u.id ELSE u.id END",
            source="JOIN customer ON c_custkey = u.id")),
        "replace_affinity": _sql(_unscored(affinity="a.affinity", source="JOIN affinity a ON a.id = u.id")),
        "replace_centrality": _sql("""
            SELECT v.id, page, affinity, CASE WHEN v.id IN (SELECT id FROM degrees) THEN round(pagerank, 6) END AS centrality,
                utility, neighbours
            FROM vertices v JOIN rank_10 r ON r.id = v.id""", _VERTICES, _ROUNDS),
        "replace_utility": _sql("""
            SELECT v.id, page, v.affinity, centrality, e.affinity AS utility, neighbours
            FROM vertices v LEFT JOIN affinity_by_events e ON e.id = v.id AND e.ad = 7""", _VERTICES),
        "replace_neighbours": _sql("""
            SELECT v.id, coalesce(c.page, 0) AS page, affinity, centrality, utility, c.neighbours
            FROM (SELECT DISTINCT id, affinity, centrality, utility FROM vertices) v LEFT JOIN closed_lists c ON c.id = v.id""",
            _VERTICES, _CLOSED),
        "interactions": _sql("SELECT user_id, item_id, month FROM purchases"),
        "edges": _sql("SELECT * FROM edges"),
        "edges_symmetric": _sql("SELECT * FROM links"),
        "neighbours": _sql("SELECT * FROM lists"),
        "degree_centrality": _sql("SELECT * FROM degree_centrality"),
        "pagerank": _sql("SELECT id, round(pagerank, 6) AS pagerank FROM rank_10", _ROUNDS),
        "affinity_spend": _sql("SELECT * FROM affinity"),
        "affinity_events": _sql("SELECT * FROM affinity_by_events"),
        "utility": _sql("SELECT * FROM scores_by_ad", _SCORES),
        "utility_pagerank": _sql(
            "SELECT ad, id, affinity, round(centrality, 6) AS centrality, utility FROM scores_by_ad",
            _ROUNDS, _PAGERANK, _PAGERANK_SCORES),
        "select_users": _sql("SELECT * FROM picks", _SCORES),
        "select_users_pagerank": _sql(
            """SELECT id, affinity, round(centrality, 6) AS centrality, utility
            FROM scores ORDER BY utility DESC, id LIMIT 20""", _ROUNDS, _PAGERANK, _PAGERANK_SCORES),
        "select_users_all_ads": _sql("""
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ad ORDER BY utility DESC, id) AS rank
                           FROM scores_by_ad) WHERE rank <= 5""", _SCORES),
        "neighbour_affinity": _sql("""
            SELECT src AS id, round(sum(coalesce(affinity, 0) * weight) / sum(weight), 6) AS neighbour_affinity
            FROM pairs LEFT JOIN affinity ON id = dst GROUP BY 1"""),
        "ad_summary": _sql("""
            SELECT ad, count(*) AS users, round(avg(utility), 6) AS mean_utility, max(utility) AS max_utility
            FROM scores_by_ad GROUP BY 1""", _SCORES),
        "select_non_adjacent": _sql("""
            SELECT * FROM scores s WHERE NOT EXISTS (
                SELECT 1 FROM pairs l JOIN scores n ON n.id = l.dst
                WHERE l.src = s.id AND (n.utility > s.utility OR (n.utility = s.utility AND n.id < s.id)))""",
            _SCORES),
        "audience_reach": _sql("""
            SELECT count(DISTINCT dst) AS reach FROM pairs
            WHERE src IN (SELECT id FROM picks) AND dst NOT IN (SELECT id FROM picks)""", _SCORES),
        "hop_distance": _sql("SELECT u.id, h.hops FROM users u LEFT JOIN hops h USING (id)", _SCORES, _HOPS),
        "components": _sql("SELECT id, component FROM reached", _COMPONENTS),
        "communities": _sql("SELECT id, label AS community FROM labels_5", _COMMUNITIES),
        "triangles": _sql("""
            SELECT u.id, coalesce(degree, 0) AS degree, coalesce(n, 0) AS triangles,
                round(coalesce(2 * n / nullif(CAST(degree * (degree - 1) AS DOUBLE), 0), 0.0), 6) AS clustering
            FROM users u LEFT JOIN linked USING (id) LEFT JOIN counted USING (id)""", _TRIANGLES),
        # The rounds must have ended: the last one may change nothing.
        "core_numbers": _sql(f"""
            SELECT u.id, CASE WHEN EXISTS (
                    SELECT 1 FROM cores_{_CORE_ROUNDS} a JOIN cores_{_CORE_ROUNDS - 1} b ON a.id = b.id AND a.core <> b.core)
                THEN error('more rounds are needed') ELSE coalesce(core, 0) END AS core
            FROM users u LEFT JOIN cores_{_CORE_ROUNDS} USING (id)""", _CORES),
        "next_purchase": """
            WITH e AS (
                SELECT event_id, ts, user_id AS id, TRY_CAST(props->>'$.k' AS BIGINT) AS ad, event_type
                FROM events WHERE user_id IS NOT NULL AND regexp_full_match(props->>'$.k', '-?[0-9]+')
                    AND TRY_CAST(props->>'$.k' AS BIGINT) IS NOT NULL),
            p AS (
                SELECT id, ts, min(event_id) AS purchase_id, arg_min(ad, event_id) AS purchase_ad
                FROM e WHERE event_type = 'purchase' GROUP BY 1, 2)
            SELECT s.event_id, s.id, s.ad, p.purchase_id, p.purchase_ad, (epoch_us(p.ts) - epoch_us(s.ts)) // 1000000 AS seconds
            FROM (SELECT * FROM e WHERE event_type IN ('view', 'click')) s ASOF LEFT JOIN p ON p.id = s.id AND s.ts <= p.ts""",
        "audience_cube": _sql("""
            SELECT p_brand AS ad, c_mktsegment AS segment, month, grouping(p_brand, c_mktsegment, month) AS grouping_id,
                count(DISTINCT p.user_id) AS users, CAST(sum(spent) AS DOUBLE) AS spent,
                CAST(sum(CAST(utility AS DECIMAL(18, 6))) AS DOUBLE) / count(utility) AS mean_utility
            FROM (SELECT user_id, p_brand, month, sum(spent) AS spent FROM purchases JOIN part ON p_partkey = item_id
                  WHERE p_brand IS NOT NULL GROUP BY 1, 2, 3) p
            JOIN scores_by_ad s ON s.ad = p_brand AND s.id = user_id JOIN customer ON c_custkey = user_id
            GROUP BY CUBE (p_brand, c_mktsegment, month)""", _SCORES),
        "affinity_stream": _sql("SELECT * FROM affinity_by_events"),
        "vertex_store": _sql("""
            SELECT v.id, page, CASE WHEN e.id IS NOT NULL THEN e.affinity ELSE v.affinity END AS affinity, centrality, utility,
                neighbours
            FROM vertices v LEFT JOIN affinity_by_events e ON e.id = v.id AND e.ad = 7""", _VERTICES),
        "cover_users": _sql(
            "SELECT rank, id, gain, CAST(sum(gain) OVER (ORDER BY rank) AS BIGINT) AS reached FROM ("
            + " UNION ALL ".join(f"SELECT {i}::BIGINT AS rank, id, gain FROM pick_{i}" for i in range(1, 21)) + ")", _COVER),
    }

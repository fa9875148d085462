"""Registered consolidation queries and their DuckDB oracles.

Scenario on the provided data: the first collection run holds the reviews
written before 1995-06-01 (``collected``). For the merge (J7/J8) two overlapping runs
are split off the whole table by order number (FIXTURES.md §2): the old one lacks
every third order, the new one the orders after those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.operators import consolidate as C
from critiq.plans.oracle_views import with_views
from critiq.session import keep
from critiq.sources import tables
from critiq.sources.tables import LISTING

# The new run covers these items only, so that items of the old run remain.
NEW_RUN_ITEMS = 8


def old_run(spark: SparkSession, sf: str) -> DataFrame:
    return tables.reviews(spark, sf).filter(F.col("l_orderkey") % 3 != 0)


def new_run(spark: SparkSession, sf: str) -> DataFrame:
    return tables.reviews(spark, sf).filter((F.col("l_orderkey") % 3 != 1) & (F.col("umbrella_item") % NEW_RUN_ITEMS == 0))


def fixture_signature() -> list:
    """Listing signature on the fixtures: (user_id mod 20, review_item) of the first review
    (exact user ids almost never collide in the generated data; FIXTURES.md §2)."""
    return [(F.col("user_id") % 20).alias("sig_user"), F.col("review_item").alias("sig_item")]


def _signatures(spark, sf) -> DataFrame:
    """Signatures of all listings, stored: their users read them twice, and a listing's row is small beside its reviews."""
    return keep(C.listing_signatures(tables.reviews(spark, sf), fixture_signature()), "signatures")


def _flat_sig(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c != "sig"],
                     F.col("sig.sig_user").alias("sig_user"), F.col("sig.sig_item").alias("sig_item"))


def q_pending_items(spark, sf):
    return C.pending_items(tables.catalog(spark, sf), tables.collected(spark, sf))


def q_upsert_merge(spark, sf):
    return C.upsert_merge(old_run(spark, sf), [new_run(spark, sf)], LISTING)


def q_merge_conflicts(spark, sf):
    return C.merge_conflicts(old_run(spark, sf), new_run(spark, sf), LISTING)


def q_format_dedup(spark, sf):
    return _flat_sig(C.format_dedup(_signatures(spark, sf)))


def q_review_dedup(spark, sf):
    return C.review_dedup(tables.reviews(spark, sf))


def q_pooled_filter(spark, sf):
    return C.pooled_filter(tables.reviews(spark, sf), tables.allow_list(spark, sf))


def q_filter_accounting(spark, sf):
    return C.filter_accounting(tables.reviews(spark, sf), tables.allow_list(spark, sf))


def q_blocked_items(spark, sf):
    return C.remove_blocked(tables.reviews(spark, sf), C.duplicate_base_listings(_signatures(spark, sf)))


def q_skip_known_items(spark, sf):
    r = tables.reviews(spark, sf)
    return C.skip_known_items(r.filter(F.col("vrank") != 0), r.filter(F.col("vrank") == 0))


def q_count_reconciliation(spark, sf):
    return C.count_reconciliation(tables.catalog(spark, sf), tables.collected(spark, sf))


def q_collection_progress(spark, sf):
    return C.collection_progress(tables.catalog(spark, sf), tables.collected(spark, sf))


def q_resume_start_page(spark, sf):
    return C.resume_plan(tables.collected(spark, sf))


def q_partial_resume_rows(spark, sf):
    return C.kept_rows(tables.reviews(spark, sf))


QUERIES = {
    "pending_items": q_pending_items,
    "upsert_merge": q_upsert_merge,
    "merge_conflicts": q_merge_conflicts,
    "format_dedup": q_format_dedup,
    "review_dedup": q_review_dedup,
    "pooled_filter": q_pooled_filter,
    "filter_accounting": q_filter_accounting,
    "blocked_items": q_blocked_items,
    "skip_known_items": q_skip_known_items,
    "count_reconciliation": q_count_reconciliation,
    "collection_progress": q_collection_progress,
    "resume_start_page": q_resume_start_page,
    "partial_resume_rows": q_partial_resume_rows,
}

_ORDER = "review_ts, l_orderkey, l_linenumber, review_item, l_suppkey, l_extendedprice"
_SAME = "{a}.publisher = {b}.publisher AND {a}.version = {b}.version AND {a}.umbrella_item = {b}.umbrella_item"

_OLD = ("old_rows", "SELECT * FROM reviews WHERE l_orderkey % 3 <> 0")
_NEW = ("new_rows", f"SELECT * FROM reviews WHERE l_orderkey % 3 <> 1 AND umbrella_item % {NEW_RUN_ITEMS} = 0")

_SIGS = ("sigs", f"""
SELECT publisher, version, vrank, umbrella_item, sig_user, sig_item, n_reviews FROM (
  SELECT publisher, version, vrank, umbrella_item, user_id % 20 AS sig_user, review_item AS sig_item,
         count(*) OVER (PARTITION BY publisher, version, umbrella_item) AS n_reviews,
         row_number() OVER (PARTITION BY publisher, version, umbrella_item ORDER BY {_ORDER}) AS rn
  FROM reviews) t WHERE rn = 1
""")

_BAD = [("pairs", "SELECT DISTINCT umbrella_item, review_item FROM reviews"),
        ("bad", """
SELECT DISTINCT p.umbrella_item, p.review_item FROM pairs p JOIN allow a ON a.item = p.umbrella_item
WHERE NOT EXISTS (SELECT 1 FROM allow b WHERE b.title = a.title AND b.item = p.review_item)
""")]

ORACLE = {
    "pending_items": with_views(["catalog", "collected"], """
SELECT c.* FROM catalog c WHERE c.num_reviews > 0 AND NOT EXISTS (
  SELECT 1 FROM collected r WHERE r.publisher = c.publisher AND r.version = c.version AND r.umbrella_item = c.item)
"""),
    "upsert_merge": with_views(["reviews"], f"""
SELECT o.* FROM old_rows o WHERE NOT EXISTS (SELECT 1 FROM new_rows n WHERE {_SAME.format(a='n', b='o')})
UNION ALL
SELECT * FROM new_rows
""", [_OLD, _NEW]),
    "merge_conflicts": with_views(["reviews"], """
SELECT o.publisher, o.version, o.umbrella_item, o.n_old, n.n_new
FROM (SELECT publisher, version, umbrella_item, count(*) AS n_old FROM old_rows GROUP BY ALL) o
JOIN (SELECT publisher, version, umbrella_item, count(*) AS n_new FROM new_rows GROUP BY ALL) n
  ON o.publisher = n.publisher AND o.version = n.version AND o.umbrella_item = n.umbrella_item
WHERE o.n_old > 0 AND o.n_old <> n.n_new
""", [_OLD, _NEW]),
    "format_dedup": with_views(["reviews"], """
SELECT publisher, version, vrank, umbrella_item, n_reviews, sig_user, sig_item,
  CASE WHEN vrank = 0 THEN 'base' WHEN has_base = 1 THEN 'dup_of_base' WHEN rn = 1 THEN 'kept'
       ELSE 'dup_of_listing' END AS status
FROM (SELECT *, max(CASE WHEN vrank = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY publisher, sig_user, sig_item) AS has_base,
             row_number() OVER (PARTITION BY publisher, sig_user, sig_item ORDER BY vrank, umbrella_item) AS rn
      FROM sigs) t
""", [_SIGS]),
    "review_dedup": with_views(["reviews"], f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, review_item ORDER BY vrank, {_ORDER}) AS rn FROM reviews
) t WHERE rn = 1
"""),
    "pooled_filter": with_views(["reviews", "allow"], """
SELECT r.* FROM reviews r WHERE NOT EXISTS (
  SELECT 1 FROM bad b WHERE b.umbrella_item = r.umbrella_item AND b.review_item = r.review_item)
""", _BAD),
    "filter_accounting": with_views(["reviews", "allow"], """
SELECT publisher, version, umbrella_item, n_before, n_after, n_before - n_after AS n_removed FROM (
  SELECT r.publisher, r.version, r.umbrella_item, count(*) AS n_before,
         count(*) FILTER (WHERE b.review_item IS NULL) AS n_after
  FROM reviews r LEFT JOIN bad b ON b.umbrella_item = r.umbrella_item AND b.review_item = r.review_item
  GROUP BY r.publisher, r.version, r.umbrella_item
  UNION ALL
  SELECT NULL, NULL, NULL, count(*), count(*) FILTER (WHERE b.review_item IS NULL)
  FROM reviews r LEFT JOIN bad b ON b.umbrella_item = r.umbrella_item AND b.review_item = r.review_item
) t
""", _BAD),
    "blocked_items": with_views(["reviews"], f"""
SELECT r.* FROM reviews r WHERE NOT EXISTS (SELECT 1 FROM blocked b WHERE {_SAME.format(a='b', b='r')})
""", [_SIGS, ("blocked", """
SELECT publisher, version, umbrella_item FROM (
  SELECT *, min(umbrella_item) OVER (PARTITION BY publisher, sig_user, sig_item) AS first_item
  FROM sigs WHERE vrank = 0) t WHERE umbrella_item <> first_item
""")]),
    "skip_known_items": with_views(["reviews"], f"""
SELECT r.* FROM reviews r WHERE r.vrank <> 0 AND NOT EXISTS (SELECT 1 FROM hits h WHERE {_SAME.format(a='h', b='r')})
""", [("page1", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY publisher, version, umbrella_item ORDER BY {_ORDER}) AS rn
               FROM reviews WHERE vrank <> 0) t WHERE rn <= 10
"""), ("hits", """
SELECT DISTINCT publisher, version, umbrella_item FROM page1 p
WHERE EXISTS (SELECT 1 FROM reviews k WHERE k.vrank = 0 AND k.user_id = p.user_id AND k.review_item = p.review_item)
""")]),
    "count_reconciliation": with_views(["catalog", "collected"], """
SELECT c.publisher, c.version, c.item, c.num_reviews, coalesce(n.n_collected, 0) AS n_collected,
       c.num_reviews - coalesce(n.n_collected, 0) AS shortfall
FROM catalog c LEFT JOIN (SELECT publisher, version, umbrella_item AS item, count(*) AS n_collected
                          FROM collected GROUP BY ALL) n
  ON c.publisher = n.publisher AND c.version = n.version AND c.item = n.item
"""),
    "collection_progress": with_views(["catalog", "collected"], """
SELECT c.publisher, count(*) FILTER (WHERE d.item IS NOT NULL) AS n_done,
       count(*) FILTER (WHERE d.item IS NULL) AS n_pending, count(*) AS n_total
FROM catalog c LEFT JOIN (SELECT DISTINCT publisher, version, umbrella_item AS item FROM collected) d
  ON c.publisher = d.publisher AND c.version = d.version AND c.item = d.item
GROUP BY ROLLUP (c.publisher)
"""),
    "partial_resume_rows": with_views(["reviews"], f"""
SELECT * EXCLUDE (_n, _pos) FROM (
  SELECT *, count(*) OVER (PARTITION BY publisher, version, umbrella_item) AS _n,
         row_number() OVER (PARTITION BY publisher, version, umbrella_item ORDER BY {_ORDER}) AS _pos
  FROM reviews) t WHERE _pos <= _n - _n % 10
"""),
    "resume_start_page": with_views(["collected"], """
SELECT publisher, version, umbrella_item, count(*) AS n_collected, count(*) - count(*) % 10 AS n_kept,
       count(*) // 10 + 1 AS start_page
FROM collected GROUP BY publisher, version, umbrella_item
"""),
}

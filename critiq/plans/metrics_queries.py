"""Registered metric queries and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.operators import metrics
from critiq.plans.oracle_views import with_views
from critiq.sources import tables


def q_dataset_metrics_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.dataset_metrics(tables.reviews(spark, sf))


def q_dataset_metrics_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The same metrics from the stored states of two runs: reviews collected first, and all later ones."""
    reviews = tables.reviews(spark, sf)
    first = F.col("review_ts") < F.unix_timestamp(F.to_timestamp(F.lit(tables.CRAWL_CUTOFF)))
    return metrics.dataset_metrics_merged(metrics.metric_state(reviews.where(first)), metrics.metric_state(reviews.where(~first)))


def q_sentiment_summary(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.sentiment_summary(tables.reviews(spark, sf))


def q_user_item_averages(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.entity_averages(tables.ratings(spark, sf)).withColumn(
        "mean_rating", F.round("mean_rating", 6))


def q_rating_mode_share(spark: SparkSession, sf: str) -> DataFrame:
    r = tables.ratings(spark, sf)
    users = metrics.mode_share(r, "user").select(F.lit("user").alias("entity"), "*")
    items = metrics.mode_share(r, "item").select(F.lit("item").alias("entity"), "*")
    return users.unionByName(items)


# Listing size threshold for the registered query: the reference flags listings
# above 800 reviews; fixture listings hold about 24 (sf0.01), so the registered
# query uses 30 to return the upper tail.
LARGE_LISTING_THRESHOLD = 30


def q_large_listings(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.large_listings(tables.reviews(spark, sf), LARGE_LISTING_THRESHOLD)


def q_user_neighbour_lists(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.neighbour_edges(tables.ratings(spark, sf))


def q_user_union(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.entity_union(tables.reviews(spark, sf))


def q_items_per_publisher(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.listings_per_group(tables.reviews(spark, sf))


QUERIES = {
    "dataset_metrics_rollup": q_dataset_metrics_rollup,
    "dataset_metrics_merged": q_dataset_metrics_merged,
    "sentiment_summary": q_sentiment_summary,
    "user_item_averages": q_user_item_averages,
    "rating_mode_share": q_rating_mode_share,
    "large_listings": q_large_listings,
    "user_neighbour_lists": q_user_neighbour_lists,
    "user_union": q_user_union,
    "items_per_publisher": q_items_per_publisher,
}

_STARS = ",\n".join(
    f"CAST(count(*) FILTER (WHERE rating = {s}) AS BIGINT) AS n_star{s}" for s in range(1, 6))

ORACLE = {
    "dataset_metrics_rollup": with_views(["reviews"], """
SELECT publisher, count(*) AS n_reviews, count(DISTINCT user_id) AS n_users,
       count(DISTINCT review_item) AS n_review_items,
       count(DISTINCT (publisher, umbrella_item)) AS n_pooled_items,
       round(avg(rating), 6) AS mean_rating
FROM reviews GROUP BY ROLLUP (publisher)
"""),
    "sentiment_summary": with_views(["reviews"], f"""
SELECT publisher, count(*) AS n_reviews, round(avg(rating), 6) AS mean_rating,
       round(avg(CASE WHEN rating >= 4 THEN 1.0 ELSE 0.0 END), 6) AS positive_share,
       {_STARS}
FROM reviews GROUP BY ROLLUP (publisher)
"""),
    "user_item_averages": with_views(["ratings"], """
SELECT 'user' AS entity, "user" AS id, round(avg(rating), 6) AS mean_rating, count(*) AS n FROM ratings GROUP BY "user"
UNION ALL
SELECT 'item', item, round(avg(rating), 6), count(*) FROM ratings GROUP BY item
UNION ALL
SELECT 'unknown', CAST(NULL AS BIGINT), round(avg(rating), 6), count(*) FROM ratings
"""),
    "rating_mode_share": with_views(["ratings"], """
SELECT entity, id, mode_rating, mode_share, n FROM (
  SELECT entity, id, rating AS mode_rating, round(c / sum(c) OVER (PARTITION BY entity, id), 6) AS mode_share,
         sum(c) OVER (PARTITION BY entity, id) AS n,
         row_number() OVER (PARTITION BY entity, id ORDER BY c DESC, rating ASC) AS rn
  FROM (SELECT 'user' AS entity, "user" AS id, rating, count(*) AS c FROM ratings GROUP BY "user", rating
        UNION ALL
        SELECT 'item', item, rating, count(*) FROM ratings GROUP BY item, rating) t
) s WHERE rn = 1
"""),
    "large_listings": with_views(["reviews"], f"""
SELECT publisher, version, umbrella_item, count(*) AS n_reviews FROM reviews
GROUP BY publisher, version, umbrella_item HAVING count(*) > {LARGE_LISTING_THRESHOLD}
"""),
    "user_neighbour_lists": with_views(["ratings"], """
SELECT "user", item, count(*) AS n_ratings, round(avg(rating), 6) AS mean_rating
FROM ratings GROUP BY "user", item
"""),
    "user_union": with_views(["reviews"], """
SELECT 'user' AS entity, user_id AS id FROM reviews
UNION
SELECT 'review_item', review_item FROM reviews
"""),
    "items_per_publisher": with_views(["reviews"], """
SELECT publisher, count(*) AS n_listings, CAST(sum(n) AS BIGINT) AS n_reviews FROM (
  SELECT publisher, version, umbrella_item, count(*) AS n FROM reviews
  GROUP BY publisher, version, umbrella_item) t
GROUP BY ROLLUP (publisher)
"""),
}

ORACLE["dataset_metrics_merged"] = ORACLE["dataset_metrics_rollup"]

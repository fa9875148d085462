"""Table access and the review-shaped views derived from the provided tables.

The analytics operate on four logical tables:

* ``reviews``   one row per collected review (publisher, version, listing, ...)
* ``catalog``   one row per listing as advertised by the source (stated totals)
* ``allow``     title -> item ids that may be pooled under that title
* ``documents`` review texts, grouped by (publisher, version)

On a deployment these are parquet tables partitioned by (publisher, version).
For the provided test data they are derived from the TPC-H-like tables with
the rules in FIXTURES.md section 2; every rule is a projection or an equi-join,
so predicate pushdown and column pruning reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.operators.common import dealt_by_size

# Edition order used by deduplication and the proxy view
# (Paperback first; the reference processes versions in this order).
VERSIONS = ["Paperback", "Hardcover", "Kindle", "Omnibus", "Collector or Limited Edition"]
PUBLISHERS = ["PUB_A", "PUB_B"]

# First collection run of the resume/merge scenario: reviews written before this
# day had been collected, later ones were not.
CRAWL_CUTOFF = "1995-06-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one provided parquet table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def version_name(rank: Column) -> Column:
    expr = F.when(rank == 0, F.lit(VERSIONS[0]))
    for i, v in enumerate(VERSIONS[1:], start=1):
        expr = expr.when(rank == i, F.lit(v))
    return expr


def epoch_seconds(ts: Column) -> Column:
    """Seconds since epoch of a timestamp or timestamp_ntz column (UTC)."""
    return F.unix_timestamp(ts.cast("timestamp")).cast("bigint")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review records: lineitem ⋈ orders under the FIXTURES.md binding.

    Columns: publisher, version, vrank, umbrella_item, review_item, user_id,
    rating, review_ts, l_orderkey, l_linenumber, l_suppkey, l_extendedprice.
    The last five plus review_ts give a total order inside a listing.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    vrank = (F.col("l_linenumber") % 5).cast("int")
    return j.select(
        F.when(F.expr("(l_partkey div 4) % 2") == 0, F.lit("PUB_A"))
        .otherwise(F.lit("PUB_B")).alias("publisher"),
        version_name(vrank).alias("version"),
        vrank.alias("vrank"),
        (F.col("l_partkey") - F.col("l_partkey") % 4).alias("umbrella_item"),
        F.col("l_partkey").alias("review_item"),
        F.col("o_custkey").alias("user_id"),
        (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double").alias("rating"),
        epoch_seconds(F.col("l_shipdate")).alias("review_ts"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
    )


# Total order of reviews inside a listing (FIXTURES.md: the last five are unique).
REVIEW_ORDER = ["review_ts", "l_orderkey", "l_linenumber", "review_item", "l_suppkey",
                "l_extendedprice"]

LISTING = ["publisher", "version", "umbrella_item"]


def order_struct(prefix: list[str] | None = None) -> Column:
    """Struct that sorts reviews in collection order (optionally after ``prefix``)."""
    cols = (prefix or []) + REVIEW_ORDER
    return F.struct(*[F.col(c) for c in cols])


def collected(spark: SparkSession, sf_dir: str, cutoff: str = CRAWL_CUTOFF) -> DataFrame:
    """Reviews gathered by the first collection run (written before ``cutoff``)."""
    limit = F.unix_timestamp(F.to_timestamp(F.lit(cutoff))).cast("bigint")
    return reviews(spark, sf_dir).filter(F.col("review_ts") < limit)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as advertised: stated totals run ahead of what can be collected.

    Per listing: rank = listing ordinal, avg_rating rounded to one place as a
    shop page shows it, num_reviews = collected count + (ordinal mod 3).
    """
    r = reviews(spark, sf_dir)
    g = r.groupBy(*LISTING).agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("avg"))
    ordinal = F.expr("umbrella_item div 4")
    return g.select(
        "publisher", "version",
        (ordinal + 1).alias("rank"),
        F.col("umbrella_item").alias("item"),
        F.round("avg", 1).alias("avg_rating"),
        (F.col("n") + ordinal % 3).alias("num_reviews"),
    )


def allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title -> allowed item ids: parts sharing a product name form one title."""
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("title"), F.col("p_partkey").alias("item"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review texts with their group: publisher = lang, version = source."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("publisher"), F.col("source").alias("version"), "text")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``texts`` dealt out in partitions of a bounded size.

    Texts are hash-partitioned by doc_id right after the scan: tokenising is
    the CPU-heavy step, and a file (or row group) may hold many texts, so this
    one shuffle of raw text spreads the work over all tasks. Every later
    per-document aggregation reuses the partitioning.
    """
    return dealt_by_size(texts(spark, sf_dir), "doc_id", "text")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows (F1/F2): user, umbrella item, rating, plus the split key."""
    r = reviews(spark, sf_dir)
    return r.select(
        "publisher",
        F.col("user_id").alias("user"),
        F.col("umbrella_item").alias("item"),
        "rating",
        F.concat_ws("|", "user_id", "review_item", "l_orderkey", "l_linenumber").alias("row_key"),
    )

"""Consolidation of collected reviews.

Design notes for scale:

* Every decision that depends on a whole listing (its first review, its size)
  is an aggregation with map-side partial aggregation (``min_by``, ``count``),
  never a window over the listing, so one listing holding a third of all rows
  is reduced inside each task before the shuffle.
* Keys that feed an anti or semi join are de-duplicated first (``distinct`` is
  a partial aggregation), so the shuffle carries one row per key and map task
  instead of one row per review.
* No explicit broadcast: the key tables here grow with the data, so the join
  strategy is left to AQE, which broadcasts only after measuring a side below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from critiq.sources.tables import LISTING, REVIEW_ORDER, VERSIONS


def _keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


# --------------------------------------------------------------------------- J3, F8, A16, A17, J9

def pending_items(catalog: DataFrame, collected: DataFrame) -> DataFrame:
    """J3 + F8: advertised listings with reviews that nothing has been collected for yet.

    Matching is on equal (publisher, version, item); the reference's substring
    test on file names is not reproduced.
    """
    done = _keys(collected.withColumnRenamed("umbrella_item", "item"), ["publisher", "version", "item"])
    return (catalog.filter(F.col("num_reviews") > 0)
            .join(done, ["publisher", "version", "item"], "left_anti"))


def collected_counts(collected: DataFrame) -> DataFrame:
    return (collected.groupBy("publisher", "version", F.col("umbrella_item").alias("item"))
            .agg(F.count(F.lit(1)).alias("n_collected")))


def count_reconciliation(catalog: DataFrame, collected: DataFrame) -> DataFrame:
    """Stated total next to the collected count, and the shortfall."""
    counts = collected_counts(collected)
    j = catalog.join(counts, ["publisher", "version", "item"], "left")
    n = F.coalesce(F.col("n_collected"), F.lit(0).cast("bigint"))
    return j.select("publisher", "version", "item", "num_reviews",
                    n.alias("n_collected"), (F.col("num_reviews") - n).alias("shortfall"))


def collection_progress(catalog: DataFrame, collected: DataFrame) -> DataFrame:
    """Listings done / pending / all, per publisher and in total."""
    done = _keys(collected.withColumnRenamed("umbrella_item", "item"),
                 ["publisher", "version", "item"]).withColumn("done", F.lit(True))
    j = catalog.join(done, ["publisher", "version", "item"], "left")
    is_done = F.coalesce(F.col("done"), F.lit(False))
    return j.rollup("publisher").agg(
        F.count_if(is_done).cast("bigint").alias("n_done"),
        F.count_if(~is_done).cast("bigint").alias("n_pending"),
        F.count(F.lit(1)).alias("n_total"))


def resume_plan(collected: DataFrame, page_size: int = 10) -> DataFrame:
    """An interrupted listing keeps its full pages and restarts at the next page."""
    c = collected.groupBy(*LISTING).agg(F.count(F.lit(1)).alias("n_collected"))
    return c.select(*LISTING, "n_collected",
                    (F.col("n_collected") - F.col("n_collected") % page_size).alias("n_kept"),
                    (F.expr(f"n_collected div {page_size}") + 1).alias("start_page"))


#: Rows from which on a listing is not sorted whole in one task.
LONG_LISTING = 500_000


def kept_rows(collected: DataFrame, page_size: int = 10, order: Sequence[str] = REVIEW_ORDER,
              long_listing: int = LONG_LISTING) -> DataFrame:
    """J9, row form: the rows of each listing's full pages; those of its last, partial page are collected again.

    ``order`` tells the rows of a listing apart; rows equal in it stay or go together, and
    rows without a value in it or in the listing's names stay. A listing of ordinary length
    moves once, and its rows go by their place from its end. Those of more than
    ``long_listing`` rows are few, so their names are broadcast: see ``_kept_of_long``.
    """
    own = [c for c in order if c not in LISTING]
    rows = collected.select(*LISTING, *own, *[c for c in collected.columns if c not in (*LISTING, *own)])
    sizes = rows.groupBy(*LISTING).agg(F.count(F.lit(1)).alias("_n"))
    long = F.broadcast(sizes.where(F.col("_n") > long_listing).select(*[F.col(c).alias(f"_{c}") for c in LISTING]))
    # Nulls are equal here: else one side reads without them, and both sides' shuffle of the reviews is not shared.
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LISTING]
    listing = Window.partitionBy(*LISTING)
    placed = (rows.join(long, same, "left_anti")
              .withColumn("_from_end", F.rank().over(listing.orderBy(*[F.col(c).desc() for c in order])))
              .withColumn("_partial", F.count(F.lit(1)).over(listing) % page_size))
    unknown = F.greatest(*[F.col(c).isNull() for c in (*LISTING, *own)])
    kept = placed.where(unknown | (F.col("_from_end") > F.col("_partial"))).drop("_from_end", "_partial")
    return kept.unionByName(_kept_of_long(rows.join(long, same, "left_semi"), page_size, order))


def _kept_of_long(rows: DataFrame, page_size: int, order: Sequence[str]) -> DataFrame:
    """``kept_rows`` without sorting a listing whole.

    Only the last page_size - 1 rows of a listing can go. They are found by a per-group limit
    that Spark applies in every task before the shuffle, and leave by an anti join.
    """
    last = Window.partitionBy(*LISTING).orderBy(*[F.col(c).desc() for c in order])
    own = [c for c in order if c not in LISTING]
    tail = rows.select(*LISTING, *own).withColumn("_from_end", F.row_number().over(last)).where(F.col("_from_end") < page_size)
    partial = rows.groupBy(*LISTING).agg((F.count(F.lit(1)) % page_size).alias("_partial")).where("_partial > 0")
    gone = tail.join(partial, LISTING).where("_from_end <= _partial").select(*LISTING, *own)
    return rows.join(gone, [*LISTING, *own], "left_anti")


def with_version_rank(reviews: DataFrame, versions: Sequence[str] = VERSIONS) -> DataFrame:
    """``vrank``: the place of a record's version in the order in which versions are processed; unknown ones come last."""
    place = F.array_position(F.array(*[F.lit(v) for v in versions]), F.col("version")).cast("int")
    return reviews.withColumn("vrank", F.coalesce(F.when(place > 0, place - 1), F.lit(len(versions))))


# --------------------------------------------------------------------------- J7, J8

def upsert_merge(old: DataFrame, batches: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Per key, rows of the latest batch holding the key replace older rows.

    ``batches`` are in load order; a key's rows come whole from the last batch
    that has it, or from ``old`` if no batch has it.
    """
    key = list(key)
    tagged = None
    for i, b in enumerate(batches):
        t = b.withColumn("_batch", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t)
    latest = tagged.groupBy(*key).agg(F.max("_batch").alias("_batch"))
    fresh = tagged.join(latest, key + ["_batch"], "left_semi").drop("_batch")
    kept = old.join(latest.select(*key), key, "left_anti")
    return kept.unionByName(fresh)


def merge_conflicts(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys present in both, non-empty before, with a different row count."""
    key = list(key)
    o = old.groupBy(*key).agg(F.count(F.lit(1)).alias("n_old"))
    n = new.groupBy(*key).agg(F.count(F.lit(1)).alias("n_new"))
    return (o.join(n, key, "inner")
            .filter((F.col("n_old") > 0) & (F.col("n_old") != F.col("n_new"))))


# --------------------------------------------------------------------------- T6, P2, F5

def listing_signatures(reviews: DataFrame, sig: Sequence[Column], order: Sequence[str] = REVIEW_ORDER) -> DataFrame:
    """Signature of each listing = ``sig`` evaluated on its first review in ``order``.

    Output: publisher, version, vrank, umbrella_item, sig (struct), n_reviews.
    """
    first = F.struct(*[F.col(c) for c in order])
    return (reviews.groupBy(*LISTING, "vrank")
            .agg(F.min_by(F.struct(*sig), first).alias("sig"),
                 F.count(F.lit(1)).alias("n_reviews")))


def format_dedup(signatures: DataFrame, base_rank: int = 0) -> DataFrame:
    """Cross-format listing deduplication.

    The base version (rank ``base_rank``, Paperback) is kept whole. Any other
    listing is dropped if a base listing shares its signature; otherwise the
    first listing by (version rank, item) among those sharing the signature is
    kept. Adds ``status``: base | kept | dup_of_base | dup_of_listing.
    """
    per_sig = signatures.groupBy("publisher", "sig").agg(
        F.max((F.col("vrank") == base_rank).cast("int")).alias("has_base"),
        F.min(F.struct(F.col("vrank"), F.col("umbrella_item"))).alias("first"))
    j = signatures.join(per_sig, ["publisher", "sig"])
    is_first = (F.col("first.vrank") == F.col("vrank")) & (F.col("first.umbrella_item") == F.col("umbrella_item"))
    status = (F.when(F.col("vrank") == base_rank, F.lit("base"))
              .when(F.col("has_base") == 1, F.lit("dup_of_base"))
              .when(is_first, F.lit("kept"))
              .otherwise(F.lit("dup_of_listing")))
    return j.select(*LISTING, "vrank", "sig", "n_reviews", status.alias("status"))


def keep_listings(reviews: DataFrame, listings: DataFrame) -> DataFrame:
    """Reviews of the listings present in ``listings``."""
    return reviews.join(_keys(listings, LISTING), LISTING, "left_semi")


def duplicate_base_listings(signatures: DataFrame, base_rank: int = 0) -> DataFrame:
    """Block list (F5): base-version listings whose signature an earlier base listing has."""
    base = signatures.filter(F.col("vrank") == base_rank)
    first = base.groupBy("publisher", "sig").agg(F.min("umbrella_item").alias("first_item"))
    return (base.join(first, ["publisher", "sig"])
            .filter(F.col("umbrella_item") != F.col("first_item"))
            .select("publisher", "version", "umbrella_item"))


def remove_blocked(reviews: DataFrame, blocked: DataFrame) -> DataFrame:
    """delete every review of a blocked (publisher, version, item)."""
    return reviews.join(_keys(blocked, LISTING), LISTING, "left_anti")


# --------------------------------------------------------------------------- review-level dedup

def review_dedup(reviews: DataFrame, key: Sequence[str] = ("user_id", "review_item"),
                 rank: str = "vrank", order: Sequence[str] = REVIEW_ORDER) -> DataFrame:
    """One review per (user, review item): the one from the earliest version, then earliest collected.

    A ``min_by`` aggregation rather than a window: a hot key is reduced map-side.
    """
    key = list(key)
    others = [c for c in reviews.columns if c not in key]
    first = F.struct(F.col(rank), *[F.col(c) for c in order])
    best = reviews.groupBy(*key).agg(F.min_by(F.struct(*others), first).alias("r"))
    return best.select(*key, *[F.col(f"r.{c}").alias(c) for c in others])


# --------------------------------------------------------------------------- P1, A15, A14

def pooled_bad_pairs(reviews: DataFrame, allow: DataFrame) -> DataFrame:
    """P1 core: (umbrella_item, review_item) pairs that some title forbids.

    A pair is bad if a title lists the umbrella item but not the review item.
    Computed on distinct pairs, so its size follows the number of items, not reviews.
    """
    pairs = reviews.select("umbrella_item", "review_item").distinct()
    titles = allow.select("title", F.col("item").alias("umbrella_item"))
    listed = pairs.join(titles, "umbrella_item")
    ok = allow.select("title", F.col("item").alias("review_item"))
    return (listed.join(ok, ["title", "review_item"], "left_anti")
            .select("umbrella_item", "review_item").distinct())


def pooled_filter(reviews: DataFrame, allow: DataFrame) -> DataFrame:
    """Drop reviews pooled under a listed item from an edition its title does not list."""
    return reviews.join(pooled_bad_pairs(reviews, allow), ["umbrella_item", "review_item"], "left_anti")


def filter_accounting(reviews: DataFrame, allow: DataFrame) -> DataFrame:
    """Reviews before and after the pooled filter per listing, plus a total row."""
    bad = pooled_bad_pairs(reviews, allow).withColumn("bad", F.lit(1))
    j = reviews.join(bad, ["umbrella_item", "review_item"], "left")
    per = j.groupBy(*LISTING).agg(
        F.count(F.lit(1)).alias("n_before"),
        F.count_if(F.col("bad").isNull()).cast("bigint").alias("n_after"))
    total = per.agg(F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after")).select(
        *[F.lit(None).cast(per.schema[c].dataType).alias(c) for c in LISTING], "n_before", "n_after")
    out = per.unionByName(total)
    return out.withColumn("n_removed", F.col("n_before") - F.col("n_after"))


# --------------------------------------------------------------------------- J5

def first_page(reviews: DataFrame, page_size: int = 10, order: Sequence[str] = REVIEW_ORDER) -> DataFrame:
    """The first ``page_size`` reviews of each listing in collection order.

    ``row_number() <= k`` is planned with a partial per-group limit before the
    shuffle, so at most k rows per listing and map task are exchanged.
    """
    w = Window.partitionBy(*LISTING).orderBy(*[F.col(c) for c in order])
    return reviews.withColumn("_pos", F.row_number().over(w)).filter(F.col("_pos") <= page_size).drop("_pos")


def skip_known_items(new_reviews: DataFrame, known: DataFrame,
                     key: Sequence[str] = ("user_id", "review_item"), page_size: int = 10,
                     order: Sequence[str] = REVIEW_ORDER) -> DataFrame:
    """Drop every listing whose first page holds a review already known."""
    key = list(key)
    hits = (first_page(new_reviews, page_size, order)
            .join(_keys(known, key), key, "left_semi"))
    return new_reviews.join(_keys(hits, LISTING), LISTING, "left_anti")

"""Dataset and rating metrics.

All metrics are hash aggregations with map-side partial aggregation, so a hot
publisher, user or listing is pre-reduced inside every task before the shuffle.
Totals next to per-group rows come from ``rollup``, for distinct counts from ids
folded before; ``publisher`` is NULL on the total row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dataset_metrics(reviews: DataFrame, group: str = "publisher") -> DataFrame:
    """Reviews, distinct users, distinct review items, pooled listings, mean rating.

    Users and review items are counted as set unions on the total row; pooled
    listings are keyed by (group, umbrella_item), so their total is the sum over
    groups, as in the reference.

    A review becomes one row per set, not one per set and level as distinct counts over a
    rollup make of it: every (group, id) is met once, and only those go into the total.
    Review counts and sums ride on the users' rows.
    """
    ids = ["user_id", "review_item", "umbrella_item"]
    sums = [F.sum(c).alias(c) for c in ("n", "s", "r")]
    met = reviews.groupingSets([[group, i] for i in ids], group, *ids).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"), F.count("rating").alias("r"))
    users, items, pooled = (F.col("_set") == s for s in (0b011, 0b101, 0b110))  # a bit for every id that the set is without
    levels = met.withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False))))
    levels = levels.withColumn("_part", F.when(F.col("_own") | pooled, F.col(group)))
    each = levels.groupBy("_own", "_set", "_part", *ids).agg(*sums)
    total = {c: F.sum(F.when(users, F.col(c))) for c in ("n", "s", "r")}
    return each.groupBy("_own", F.when(F.col("_own"), F.col("_part")).alias(group)).agg(
        F.coalesce(total["n"], F.lit(0)).alias("n_reviews"),
        F.count_if(users & F.col("user_id").isNotNull()).alias("n_users"),
        F.count_if(items & F.col("review_item").isNotNull()).alias("n_review_items"),
        F.count_if(pooled & F.col("umbrella_item").isNotNull() & F.col("_part").isNotNull()).alias("n_pooled_items"),
        F.round(F.try_divide(total["s"], total["r"]), 6).alias("mean_rating")).drop("_own")


# --------------------------------------------------------------------------- mergeable distinct counts

#: Ids of a bitmap.
BITMAP_BITS = 1 << 15


def dense_codes(df: DataFrame, col: str, out: str = "code") -> DataFrame:
    """A number from 0 on for every distinct value, whatever its type: the dictionary of the bitmaps.

    Values are stored once with their place; places become numbers by the offsets of the
    partitions, a table with a row per partition.
    """
    values = df.where(F.col(col).isNotNull()).select(col).distinct().withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    values = values.withColumn("_part", F.shiftright("_place", 33)).withColumn("_row", F.col("_place").bitwiseAND((1 << 33) - 1))
    sizes = values.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    return values.join(F.broadcast(before), "_part").select(col, (F.col("_before") + F.col("_row")).alias(out))


def distinct_state(rows: DataFrame, group: str, entities: Sequence[str]) -> DataFrame:
    """entity, group, bucket, bits: the exact sets of integer ids per group, a bitmap per 32,768 ids.

    One pass and one shuffle whatever the number of sets: a row names its id in each set,
    tasks fold them into bitmaps, and bitmaps are what moves. Ids must be dense (surrogate
    keys, or ``dense_codes`` of any others); nulls are in no set. States of different rows
    merge with ``merge_states``.
    """
    pairs = ", ".join(f"'{e}', cast(`{e}` as bigint)" for e in entities)
    ids = rows.select(group, F.expr(f"stack({len(entities)}, {pairs}) as (entity, id)")).where("id is not null")
    bucket, place = F.shiftright("id", BITMAP_BITS.bit_length() - 1), F.col("id").bitwiseAND(F.lit(BITMAP_BITS - 1))
    return ids.groupBy("entity", group, bucket.alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bits"))


def merge_states(*states: DataFrame) -> DataFrame:
    """Union of sets: bitmaps of the same bucket are or-ed."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    keys = [c for c in both.columns if c != "bits"]
    return both.groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(state: DataFrame, group: str, of: dict[str, str], union: Sequence[str]) -> DataFrame:
    """Set sizes per group and in total (group null): ``of`` maps entities to column names.

    The total of the entities in ``union`` is that of the set over all groups, of the others the sum over groups.
    """
    per_group = state.select("entity", group, F.bitmap_count("bits").alias("n"), F.lit(True).alias("own"))
    whole = state.where(F.col("entity").isin(*union)).groupBy("entity", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    total = whole.select("entity", F.lit(None).cast(state.schema[group].dataType).alias(group), F.bitmap_count("bits").alias("n"), F.lit(False).alias("own"))
    summed = per_group.where(~F.col("entity").isin(*union)).withColumn(group, F.lit(None).cast(state.schema[group].dataType)).withColumn("own", F.lit(False))
    rows = per_group.unionByName(total).unionByName(summed)
    return rows.groupBy("own", group).agg(*[F.coalesce(F.sum(F.when(F.col("entity") == e, F.col("n"))), F.lit(0)).alias(c) for e, c in of.items()])


def metric_state(reviews: DataFrame, group: str = "publisher") -> tuple[DataFrame, DataFrame]:
    """What is stored of a batch of reviews: its sets, and per group the sums that means need."""
    sums = reviews.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"), F.count("rating").alias("r"))
    return distinct_state(reviews, group, ["user_id", "review_item", "umbrella_item"]).checkpoint(), sums.checkpoint()


def dataset_metrics_merged(*batches: tuple[DataFrame, DataFrame], group: str = "publisher") -> DataFrame:
    """``dataset_metrics`` of all reviews from the states of their batches, which may overlap in ids but not in reviews."""
    of = {"user_id": "n_users", "review_item": "n_review_items", "umbrella_item": "n_pooled_items"}
    sets = merge_states(*[b[0] for b in batches]).checkpoint()
    counts = distinct_counts(sets, group, of, ["user_id", "review_item"])
    rows = batches[0][1]
    for b in batches[1:]:
        rows = rows.unionByName(b[1])
    sums = [F.sum(c).alias(c) for c in ("n", "s", "r")]
    per_group = rows.groupBy(group).agg(*sums).withColumn("own", F.lit(True))
    total = rows.groupBy().agg(*sums).select(F.lit(None).cast(rows.schema[group].dataType).alias(group), "n", "s", "r", F.lit(False).alias("own"))
    both = per_group.unionByName(total).alias("a").join(
        counts.alias("b"), (F.col("a.own") == F.col("b.own")) & F.col(f"a.{group}").eqNullSafe(F.col(f"b.{group}")))
    return both.select(f"a.{group}", F.col("n").alias("n_reviews"), *of.values(), F.round(F.col("s") / F.col("r"), 6).alias("mean_rating"))


def sketch_state(rows: DataFrame, group: str, entities: Sequence[str], precision: int = 14) -> DataFrame:
    """group and an HLL sketch per entity, for ids of any type; about 16 KB a sketch, however many ids."""
    return rows.groupBy(group).agg(*[F.hll_sketch_agg(F.col(e).cast("string"), precision).alias(e) for e in entities])


def merge_sketches(group: str | None, *states: DataFrame) -> DataFrame:
    """Sketches of the same group as one; with ``group`` None, one row over all groups."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    sketches = [c for c, kind in both.dtypes if kind == "binary"]
    return (both.groupBy(group) if group else both.groupBy()).agg(*[F.hll_union_agg(c).alias(c) for c in sketches])


def sketch_counts(state: DataFrame) -> DataFrame:
    """Estimated set sizes in place of the sketches."""
    return state.select(*[F.hll_sketch_estimate(c).alias(c) if kind == "binary" else F.col(c) for c, kind in state.dtypes])


def sentiment_summary(reviews: DataFrame, group: str = "publisher") -> DataFrame:
    """Star ratings as the sentiment proxy: mean, positive share, histogram."""
    stars = [F.count_if(F.col("rating") == s).cast("bigint").alias(f"n_star{s}") for s in range(1, 6)]
    return (reviews.rollup(group)
            .agg(F.count(F.lit(1)).alias("n_reviews"),
                 F.round(F.avg("rating"), 6).alias("mean_rating"),
                 F.round(F.avg((F.col("rating") >= 4).cast("double")), 6).alias("positive_share"),
                 *stars))


def entity_averages(ratings: DataFrame, user: str = "user", item: str = "item",
                    rating: str = "rating") -> DataFrame:
    """Per-user and per-item mean rating plus the 'unknown' row (= global mean).

    Output: entity ('user' | 'item' | 'unknown'), id (NULL for unknown), mean_rating, n.
    """
    users = ratings.groupBy(F.col(user).alias("id")).agg(
        F.avg(rating).alias("mean_rating"), F.count(F.lit(1)).alias("n")
    ).select(F.lit("user").alias("entity"), "id", "mean_rating", "n")
    items = ratings.groupBy(F.col(item).alias("id")).agg(
        F.avg(rating).alias("mean_rating"), F.count(F.lit(1)).alias("n")
    ).select(F.lit("item").alias("entity"), "id", "mean_rating", "n")
    unknown = ratings.agg(F.avg(rating).alias("mean_rating"), F.count(F.lit(1)).alias("n")).select(
        F.lit("unknown").alias("entity"), F.lit(None).cast(ratings.schema[user].dataType).alias("id"),
        "mean_rating", "n")
    return users.unionByName(items).unionByName(unknown)


def mode_share(ratings: DataFrame, key: str, rating: str = "rating") -> DataFrame:
    """Most common rating per key (lowest rating on ties) and its share.

    Two hash aggregations: (key, rating) counts, then per key the max of
    (count, -rating) — no window, so a hot key is reduced map-side.
    """
    counts = ratings.groupBy(key, rating).agg(F.count(F.lit(1)).alias("c"))
    best = counts.groupBy(key).agg(
        F.max(F.struct(F.col("c"), (-F.col(rating)).alias("neg"))).alias("m"),
        F.sum("c").alias("total"))
    return best.select(
        F.col(key).alias("id"),
        (-F.col("m.neg")).alias("mode_rating"),
        F.round(F.col("m.c") / F.col("total"), 6).alias("mode_share"),
        F.col("total").alias("n"))


def large_listings(reviews: DataFrame, threshold: int = 800,
                   listing: tuple[str, ...] = ("publisher", "version", "umbrella_item")) -> DataFrame:
    """Listings holding more than ``threshold`` reviews (reference: 800)."""
    return (reviews.groupBy(*listing).agg(F.count(F.lit(1)).alias("n_reviews"))
            .filter(F.col("n_reviews") > threshold))


def neighbour_edges(ratings: DataFrame, user: str = "user", item: str = "item",
                    rating: str = "rating") -> DataFrame:
    """User->item neighbour lists in edge form (one row per (user, item)).

    The reference keeps per-user and per-item Python lists. Kept as an edge
    table instead, so no user's list is ever gathered into one row or one task;
    the reverse (item->user) list is the same table keyed by item.
    """
    return ratings.groupBy(user, item).agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.round(F.avg(rating), 6).alias("mean_rating"))


def entity_union(reviews: DataFrame) -> DataFrame:
    """Union of users and of review items across publishers, distinct."""
    users = reviews.select(F.lit("user").alias("entity"), F.col("user_id").alias("id"))
    items = reviews.select(F.lit("review_item").alias("entity"), F.col("review_item").alias("id"))
    return users.unionByName(items).distinct()


def listings_per_group(reviews: DataFrame, group: str = "publisher") -> DataFrame:
    """Collected listings ((version, umbrella_item) pairs) per publisher and in total."""
    per = reviews.groupBy(group, "version", "umbrella_item").agg(F.count(F.lit(1)).alias("n"))
    return per.rollup(group).agg(
        F.count(F.lit(1)).alias("n_listings"), F.sum("n").alias("n_reviews"))

"""Relational division: users who rated every item of a set, and the
contrarian users among them.

One exact division for item sets of any size, and no user's ratings are ever
collected into one list. A set of item ids is a bitmap of 64-bit words, keyed by
the id's high part; the rating rows of the set are aggregated to one word per
(user, high part), the low parts ORed as bits together with the rating sum and
the row count, and the words to one row per user. "Rated all" is: as many bits
as the set has ids. Ids need no numbering, so nothing about the set runs in one
task; a user has at most as many words as items of the set they rated, and one
word where the ids lie together, as those of a small catalogue do.

A bounded set (the pipeline's comes out of `top_items`, at most `top_n` rows)
travels once, with its own size; one that exceeds its stated bound fails the
job. An unbounded set is joined bare, so that a hot item's partition can be
split, and its size comes from a scalar subquery, a partial count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastes.functions.joins import restrict_to
from tastes.operators.ranking import with_position
from tastes.schemas import (
    AVG_RATING,
    CUSTOMER_ID,
    MOVIE_ID,
    RATING,
    RATING_COLUMNS,
    RATINGS_COUNT,
)

_SET_SIZE = "_item_set_size"
_HIGH = "_high"

# Fixed value: low bits of an id that choose a bit of a 64-bit word.
LOW_BITS = 6


def _rating_rows(ratings: DataFrame) -> DataFrame:
    """The rating columns of rows that have both an item and a user id."""
    return ratings.select(*RATING_COLUMNS).where(
        F.col(MOVIE_ID).isNotNull() & F.col(CUSTOMER_ID).isNotNull()
    )


def _high_part() -> Column:
    """The key of an id's word."""
    return F.shiftright(F.col(MOVIE_ID).cast("long"), LOW_BITS)


def _items_with_size(items: DataFrame, max_items: int) -> DataFrame:
    """Distinct item ids, each carrying the number of distinct ids and its high part.

    Only for item sets that come out of a limit: they meet in one row. More
    ids than the stated bound fail the job. The aggregation by id, of one row
    each, tells Catalyst that ids are distinct: a join with them repeats no row,
    so distinct ratings stay distinct and are not hashed again.
    """
    ids = items.agg(F.collect_set(MOVIE_ID).alias("_ids"))
    size = F.size("_ids")
    checked = F.when(
        size > max_items, F.raise_error(F.lit("item set exceeds its stated bound"))
    ).otherwise(size)
    sized = ids.select(F.explode("_ids").alias(MOVIE_ID), checked.cast("long").alias(_SET_SIZE))
    return sized.groupBy(MOVIE_ID).agg(
        F.max(_SET_SIZE).alias(_SET_SIZE), F.max(_high_part()).alias(_HIGH)
    )


def item_ratings(
    ratings: DataFrame, items: DataFrame, max_items: int | None = None
) -> DataFrame:
    """Distinct rating rows of the given items."""
    if max_items is not None:
        return restrict_to(_rating_rows(ratings), items, MOVIE_ID, max_items).distinct()
    return restrict_to(_rating_rows(ratings).distinct(), items, MOVIE_ID)


def rated_all(
    ratings: DataFrame, items: DataFrame, max_items: int | None = None
) -> DataFrame:
    """Users who rated every item in `items`, with their average over those items.

    "Every item" compares distinct item ids, so rating one item twice does
    not stand in for another. The average is over distinct rating rows, so
    a user's repeat ratings of one item all count; a row without a rating is
    a row but takes no part in the average, as in `rating_stats`.
    """
    sums = (
        F.sum(RATING).alias("_sum"),
        F.count(RATING).alias("_rated"),
        F.count(F.lit(1)).alias("_rows"),
    )
    if max_items is not None:
        # Nothing is computed between this and the sums, the high part comes with
        # the items: so Catalyst drops the duplicate removal of what is a set already.
        rows = _rating_rows(ratings).join(_items_with_size(items, max_items), MOVIE_ID).distinct()
    else:
        # Joined after an aggregation: its order of keys is not the join's, so
        # the join has exchanges of its own, which AQE can split.
        ids = items.select(MOVIE_ID).where(F.col(MOVIE_ID).isNotNull()).distinct()
        size = F.lit(ids.select(F.count(F.lit(1))).scalar()).alias(_SET_SIZE)
        per_item = _rating_rows(ratings).distinct().groupBy(CUSTOMER_ID, MOVIE_ID)
        rows = restrict_to(per_item.agg(*sums, size), items, MOVIE_ID)
        rows = rows.withColumn(_HIGH, _high_part())
        sums = tuple(F.sum(c).alias(c) for c in ("_sum", "_rated", "_rows"))
    bit = F.expr(f"shiftleft(1L, cast({MOVIE_ID} & {(1 << LOW_BITS) - 1} as int))")
    words = rows.groupBy(CUSTOMER_ID, _HIGH).agg(
        F.bit_or(bit).alias("_word"),
        *sums,
        F.max(_SET_SIZE).alias(_SET_SIZE),
    )
    per_user = words.groupBy(CUSTOMER_ID).agg(
        F.sum(F.bit_count("_word")).alias("_items"),
        F.sum("_sum").alias("_sum"),
        F.sum("_rated").alias("_rated"),
        F.sum("_rows").alias("_rows"),
        F.max(_SET_SIZE).alias(_SET_SIZE),
    )
    return per_user.where(F.col("_items") == F.col(_SET_SIZE)).select(
        CUSTOMER_ID,
        (F.col("_sum") / F.nullif(F.col("_rated"), F.lit(0))).alias(AVG_RATING),
        F.col("_rows").alias(RATINGS_COUNT),
    )


def contrarian_order() -> list:
    """Lowest average first; on a tie the lower user id."""
    return [F.col(AVG_RATING).asc(), F.col(CUSTOMER_ID).asc()]


def contrarian_users(
    ratings: DataFrame,
    items: DataFrame,
    top_users: int,
    max_items: int | None = None,
    positioned: bool = False,
) -> DataFrame:
    """The `top_users` users with the lowest average over all of `items`."""
    ranked = (
        rated_all(ratings, items, max_items).orderBy(*contrarian_order()).limit(top_users)
    )
    return with_position(ranked, contrarian_order()) if positioned else ranked

"""Per-item statistics and the top-item ranking.

Plan shape at scale: the only full shuffle is the duplicate removal, hashed
on all four rating columns, so no single item or user lands in one task.
Partial aggregation then shrinks the per-item shuffle to one row per item
and map partition. The ranking is a `TakeOrderedAndProject`: every
partition keeps its best `top_n` rows and one task merges them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastes.schemas import (
    AVG_RATING,
    CUSTOMER_ID,
    ID,
    MOVIE_ID,
    POSITION,
    RATING,
    RATING_COLUMNS,
    RATINGS_COUNT,
    RELEASE_YEAR,
    TITLE,
    TITLE_COLUMNS,
)


def distinct_ratings(ratings: DataFrame, partitions: int | None = None) -> DataFrame:
    """Ratings as a set: exact-duplicate removal over the four columns.

    The same line twice, in one file or in two files of the same movie,
    counts once. A row without an item or a user id is not a rating. Stating
    that here also makes every plan that shares this result carry the same
    null checks, so Spark can reuse its exchange across branches.

    `partitions` is for ratings too many for the session's shuffle partitions:
    the rows are dealt to that many, which AQE does not merge again, so a task's
    hash tables hold a bounded share of them however many rows there are.
    """
    rows = ratings.select(*RATING_COLUMNS).where(
        F.col(MOVIE_ID).isNotNull() & F.col(CUSTOMER_ID).isNotNull()
    )
    if partitions:
        rows = rows.repartition(partitions, *RATING_COLUMNS)
    return rows.distinct()


def unique_titles(titles: DataFrame) -> DataFrame:
    """One title per id: the newest release year, then the first title.

    `row_number() = 1` is planned as a partial `WindowGroupLimit` before the
    shuffle, so a repeated id moves one row per map partition.
    """
    w = Window.partitionBy(ID).orderBy(F.col(RELEASE_YEAR).desc(), F.col(TITLE).asc())
    return (
        titles.select(*TITLE_COLUMNS)
        .withColumn("_title_rank", F.row_number().over(w))
        .where(F.col("_title_rank") == 1)
        .drop("_title_rank")
    )


def rating_stats(ratings: DataFrame) -> DataFrame:
    """Average rating and number of distinct rating rows per item."""
    return distinct_ratings(ratings).groupBy(MOVIE_ID).agg(
        F.avg(RATING).alias(AVG_RATING),
        F.count(F.lit(1)).alias(RATINGS_COUNT),
    )


def popular_items(ratings: DataFrame, min_ratings: int, inclusive: bool = False) -> DataFrame:
    """Items with more than `min_ratings` rating rows (`>=` when inclusive)."""
    count = F.col(RATINGS_COUNT)
    keep = count >= min_ratings if inclusive else count > min_ratings
    return rating_stats(ratings).where(keep)


def top_order() -> list[Column]:
    """Best average first, then the newest year, the first title, the lowest id."""
    return [
        F.col(AVG_RATING).desc(),
        F.col(RELEASE_YEAR).desc(),
        F.col(TITLE).asc(),
        F.col(MOVIE_ID).asc(),
    ]


def with_position(df: DataFrame, order: list[Column]) -> DataFrame:
    """Number the rows of a small, already limited result 1..n in `order`.

    Only for outputs of a `limit`: the window has no partition key and runs
    in one task.
    """
    return df.withColumn(POSITION, F.row_number().over(Window.orderBy(*order)))


def top_items(
    ratings: DataFrame,
    titles: DataFrame,
    min_ratings: int,
    top_n: int,
    inclusive: bool = False,
    positioned: bool = False,
) -> DataFrame:
    """The `top_n` best-rated popular items that have a title.

    The titles join comes before the limit: an untitled item cannot take a
    slot. Fewer than `top_n` qualifying items give all of them.
    """
    stats = popular_items(ratings, min_ratings, inclusive)
    named = unique_titles(titles)
    ranked = (
        stats.join(named, stats[MOVIE_ID] == named[ID])
        .select(MOVIE_ID, AVG_RATING, RATINGS_COUNT, RELEASE_YEAR, TITLE)
        .orderBy(*top_order())
        .limit(top_n)
    )
    return with_position(ranked, top_order()) if positioned else ranked

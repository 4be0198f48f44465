"""Each user's own favourite item.

The rule: a user's maximum rating is taken over all their ratings, before
any titles join; among their rows at that maximum, the titled ones compete
by release year (newest), title (first), rating date (latest) and item id
(lowest). A user whose best-rated items all lack a title drops out; they do
not fall back to a lower rating.

Plan: one scan. Rows are left-joined to the bare titles (a repeated title id
gives a row per title; the pick's own order takes the newest year and the
first title, as `unique_titles` would) and one row per user is
picked by (rating desc, titled first, year desc, title asc, date desc, id
asc). The pick has the user's overall maximum rating, and it is titled
exactly when some row at that maximum is titled, so dropping an untitled
pick gives the rule above. `row_number() = 1` is planned as a partial
`WindowGroupLimit` before the shuffle: a user holding a third of all rows
still moves one row per map partition.

`best_ratings` (all rows at the maximum, ties kept) cannot shrink to one row
per user. It takes the maximum in two levels: `rank() = 1` over (user, salt of
the row), planned as a partial `WindowGroupLimit`, drops almost all rows before
the only shuffle of them, and spreads a hot user over `SALTS` tasks; duplicates
share a salt, so they are removed there without another shuffle. The rows that
are left meet their user's maximum over the salts, read from the same exchange,
in a bare join that AQE can split. An unbounded user set of `user_max_rating`
is joined after the aggregation, one row per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastes.functions.joins import restrict_to
from tastes.schemas import (
    CUSTOMER_ID,
    ID,
    MAX_RATING,
    MOVIE_ID,
    MOVIE_RELEASE_YEAR,
    MOVIE_TITLE,
    RATING,
    RATING_COLUMNS,
    RATING_DATE,
    RELEASE_YEAR,
    TITLE,
    TITLE_COLUMNS,
)

# Shares of a user's rows whose maxima are taken apart first.
SALTS = 16


def user_max_rating(
    ratings: DataFrame, users: DataFrame | None = None, max_users: int | None = None
) -> DataFrame:
    """Highest rating per user, over all of that user's ratings."""
    if max_users is not None:
        rows = restrict_to(ratings.select(*RATING_COLUMNS), users, CUSTOMER_ID, max_users)
        return rows.groupBy(CUSTOMER_ID).agg(F.max(RATING).alias(MAX_RATING))
    maxima = ratings.groupBy(CUSTOMER_ID).agg(F.max(RATING).alias(MAX_RATING))
    return restrict_to(maxima, users, CUSTOMER_ID)


def best_ratings(
    ratings: DataFrame, users: DataFrame | None = None, max_users: int | None = None
) -> DataFrame:
    """Distinct rating rows at their user's maximum rating; all ties kept."""
    rows = ratings.select(*RATING_COLUMNS).where(
        F.col(MOVIE_ID).isNotNull() & F.col(CUSTOMER_ID).isNotNull() & F.col(RATING).isNotNull()
    )
    rows = restrict_to(rows, users, CUSTOMER_ID, max_users)
    salt = F.pmod(F.xxhash64(*RATING_COLUMNS), F.lit(SALTS)).cast("int")
    within = Window.partitionBy(CUSTOMER_ID, "_salt").orderBy(F.col(RATING).desc())
    local = (
        rows.withColumn("_salt", salt)
        .withColumn("_rank", F.rank().over(within))
        .where("_rank = 1")
        .select(*RATING_COLUMNS, "_salt")
        .distinct()
        .drop("_salt")
    )
    # The maximum is named `rating`, so the join keeps rows whose
    # (customerId, rating) is a user's (customerId, maximum).
    maxima = local.groupBy(CUSTOMER_ID).agg(F.max(RATING).alias(RATING))
    return local.join(maxima, [CUSTOMER_ID, RATING], "left_semi")


def favourite_order() -> list:
    """Newest release year, first title, latest rating date, lowest item id."""
    return [
        F.col(RELEASE_YEAR).desc(),
        F.col(TITLE).asc(),
        F.col(RATING_DATE).desc(),
        F.col(MOVIE_ID).asc(),
    ]


def favourites(
    ratings: DataFrame,
    titles: DataFrame,
    users: DataFrame | None = None,
    max_users: int | None = None,
) -> DataFrame:
    """One favourite per user: their best-rated titled item, tie-broken.

    `users=None` means every user; otherwise only users in `users`, at most
    `max_users` of them where that is stated.
    """
    rows = restrict_to(ratings.select(*RATING_COLUMNS), users, CUSTOMER_ID, max_users)
    named = titles.select(*TITLE_COLUMNS)
    joined = rows.join(named, rows[MOVIE_ID] == named[ID], "left")
    pick = Window.partitionBy(CUSTOMER_ID).orderBy(
        F.col(RATING).desc(), F.col(ID).isNull().asc(), *favourite_order()
    )
    return (
        joined.withColumn("_pick", F.row_number().over(pick))
        .where((F.col("_pick") == 1) & F.col(ID).isNotNull())
        .select(
            CUSTOMER_ID,
            MOVIE_ID,
            F.col(TITLE).alias(MOVIE_TITLE),
            F.col(RELEASE_YEAR).alias(MOVIE_RELEASE_YEAR),
            RATING,
            RATING_DATE,
        )
    )

"""The whole question as one lazy plan.

    top items      = top_items(ratings, titles, R, M)            ≤ M rows
    contrarians    = contrarian_users(ratings, top items, U)     ≤ U rows
    report         = favourites(ratings, titles, contrarians)

Two physical layouts, same result:

* `share_ratings=False` (for a stored ratings table that is cheap to scan
  again, such as the parquet copy `run_job` writes): every branch scans the ratings with its own
  filter pushed into the scan (top items, contrarian users), so only the
  statistics branch deduplicates and shuffles all rows; the other branches
  shuffle their filtered rows only.
* `share_ratings=True` (the default; for ratings that are expensive to
  recompute, such as a join of two fact tables or unparsed text, and safe
  for any input): ratings are deduplicated
  once, up front, and all three branches read that result. Spark reuses the
  one dedup exchange in every branch, so the source is computed once; the
  branches' own duplicate removal is dropped by Catalyst as redundant.

In both, the dedup is a partial aggregation, a shuffle hashed on all four
rating columns and a final aggregation: the hash spreads a heavy item or
user over all tasks, and the partial step collapses a repeated line
before it moves.

Both intermediate sets come out of a `limit`, so their size is bounded by a
parameter and they are broadcast into the ratings side: the big side is
filtered map-side and never shuffled for those joins. Nothing is collected
to the driver; the caller's action runs everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastes.operators.division import contrarian_users
from tastes.operators.favourites import favourites
from tastes.operators.ranking import distinct_ratings, top_items
from tastes.params import TasteParams
from tastes.schemas import CUSTOMER_ID, MOVIE_ID, REPORT_COLUMNS


def contrarian_tastes(
    ratings: DataFrame,
    titles: DataFrame,
    params: TasteParams = TasteParams(),
    share_ratings: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Report rows: customerId, movieTitle, movieReleaseYear, ratingDate.

    A row without an item or a user id is not a rating and is ignored. The
    filter is stated once here, so every branch carries the same one: the
    null checks each branch's join would infer are then redundant, and the
    branches stay identical up to the shared exchange. `partitions` is the
    number of partitions of the shared ratings, where the session's is too small.
    """
    ratings = ratings.where(F.col(MOVIE_ID).isNotNull() & F.col(CUSTOMER_ID).isNotNull())
    if share_ratings:
        ratings = distinct_ratings(ratings, partitions)
    top = top_items(
        ratings, titles, params.min_ratings, params.top_items, params.inclusive
    )
    users = contrarian_users(ratings, top, params.top_users, max_items=params.top_items)
    liked = favourites(ratings, titles, users, max_users=params.top_users)
    return liked.select(*REPORT_COLUMNS)

"""Items well loved by users who dislike what most users like, on Spark.

Every step is a function from DataFrames to a DataFrame built from Spark's
own expressions, joins, aggregations and windows; the whole question is one
lazy plan.
"""

from tastes.job import build_report, run_job
from tastes.operators import (
    best_ratings,
    contrarian_users,
    distinct_ratings,
    favourites,
    item_ratings,
    popular_items,
    rated_all,
    rating_stats,
    top_items,
    unique_titles,
    user_max_rating,
)
from tastes.params import JobParams, TasteParams
from tastes.plans import contrarian_tastes, materialize
from tastes.sinks import write_report
from tastes.sources import read_ratings, read_titles

__all__ = [
    "JobParams",
    "TasteParams",
    "best_ratings",
    "build_report",
    "contrarian_tastes",
    "contrarian_users",
    "distinct_ratings",
    "favourites",
    "item_ratings",
    "materialize",
    "popular_items",
    "rated_all",
    "rating_stats",
    "read_ratings",
    "read_titles",
    "run_job",
    "top_items",
    "unique_titles",
    "user_max_rating",
    "write_report",
]

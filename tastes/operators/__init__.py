"""DataFrame → DataFrame operators of the contrarian-tastes question."""

from tastes.operators.division import (
    contrarian_users,
    item_ratings,
    rated_all,
)
from tastes.operators.favourites import best_ratings, favourites, user_max_rating
from tastes.operators.ranking import (
    distinct_ratings,
    popular_items,
    rating_stats,
    top_items,
    unique_titles,
)

__all__ = [
    "best_ratings",
    "contrarian_users",
    "distinct_ratings",
    "favourites",
    "item_ratings",
    "popular_items",
    "rated_all",
    "rating_stats",
    "top_items",
    "unique_titles",
    "user_max_rating",
]

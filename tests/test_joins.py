"""Join helper: restriction never multiplies rows; unbounded joins survive a hot key."""

from __future__ import annotations

import contextlib
import io

import pytest

from tastes.functions.joins import restrict_to
from tastes.operators import best_ratings, favourites, item_ratings, rated_all, user_max_rating
from tastes.schemas import CUSTOMER_ID, ID, MOVIE_ID


def final_plan(df) -> str:
    df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    text = out.getvalue()
    return text[: text.index("== Initial Plan ==")]


@pytest.fixture
def hot(spark, shuffled_joins):
    """Ratings of which half have one user and half one item, and bare sides."""
    ratings = spark.range(0, 60000, 1, 6).selectExpr(
        "case when id % 2 = 0 then 7 else id % 3000 end as movieId",
        "case when id % 4 < 2 then 9 else id % 5000 end as customerId",
        "cast(case when id % 7 = 3 then 4 else 5 end as int) as rating",
        "cast(id as string) as ratingDate",
    )
    items = spark.range(3000).selectExpr("id as movieId")
    users = spark.range(5000).selectExpr("id as customerId")
    titles = spark.range(3000).selectExpr("id", "'2000' as releaseYear", "concat('t', id) as title")
    return ratings, items, users, titles


def test_control_join_is_split(hot):
    ratings, items, _, _ = hot
    assert "skew=true" in final_plan(ratings.join(items, MOVIE_ID))


@pytest.mark.parametrize(
    "query",
    [
        lambda r, i, u, t: restrict_to(r, u, CUSTOMER_ID),
        lambda r, i, u, t: best_ratings(r),
        lambda r, i, u, t: best_ratings(r, u),
        lambda r, i, u, t: favourites(r, t),
        lambda r, i, u, t: favourites(r, t, u),
        lambda r, i, u, t: rated_all(r, i),
        lambda r, i, u, t: item_ratings(r, i),
    ],
)
def test_unbounded_joins_are_split(hot, query):
    assert "skew=true" in final_plan(query(*hot))


def test_user_maxima_are_aggregated_before_the_join(hot):
    ratings, _, users, _ = hot
    text = final_plan(user_max_rating(ratings, users))
    assert text.index("Join") < text.index("HashAggregate")  # the aggregate is below
    assert ID not in ratings.columns


def test_restrict_to_keeps_each_row_once(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    keys = spark.createDataFrame([(1,), (1,), (3,), (3,), (3,)], "k int")
    got = sorted(tuple(r) for r in restrict_to(rows, keys, "k", 5).collect())
    assert got == [(1, "a"), (3, "c")]
    assert restrict_to(rows, None, "k") is rows

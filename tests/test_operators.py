"""Operators: one rule per test, then random fixtures against a brute-force model."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import model
from tastes.operators import (
    best_ratings,
    contrarian_users,
    favourites,
    popular_items,
    rated_all,
    rating_stats,
    top_items,
    unique_titles,
    user_max_rating,
)
from tastes.params import TasteParams
from tastes.plans import contrarian_tastes
from tastes.schemas import REPORT_COLUMNS


def rows(df, *cols):
    df = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in df.collect())


def ratings_of(movie, n, rating=3, first_user=1, date="2005-01-01"):
    return [(movie, first_user + i, rating, date) for i in range(n)]


# --- popularity -----------------------------------------------------------


def test_threshold_is_strict_unless_inclusive(ratings_df):
    r = ratings_df(ratings_of(1, 5) + ratings_of(2, 6))
    assert rows(popular_items(r, 5), "movieId") == [(2,)]
    assert rows(popular_items(r, 5, inclusive=True), "movieId") == [(1,), (2,)]


def test_repeat_ratings_count_as_rows(ratings_df):
    # three rows by two users: more than 2 rows, although only two users
    r = ratings_df([(1, 10, 3, "2005-01-01"), (1, 10, 4, "2005-01-02"), (1, 11, 5, "2005-01-01")])
    assert rows(popular_items(r, 2), "movieId", "ratingsCount") == [(1, 3)]


def test_exact_duplicates_count_once(ratings_df):
    line = (1, 10, 3, "2005-01-01")
    r = ratings_df([line, line, line, (1, 11, 5, "2005-01-01")])
    assert rows(rating_stats(r)) == [(1, 4.0, 2)]


# --- top items --------------------------------------------------------------


def test_untitled_item_cannot_take_a_slot(ratings_df, titles_df):
    r = ratings_df(ratings_of(1, 3, rating=5) + ratings_of(2, 3, rating=4) + ratings_of(3, 3, 1))
    t = titles_df([(2, "2000", "B"), (3, "2000", "C")])
    assert rows(top_items(r, t, 0, 1), "movieId") == [(2,)]


def test_top_tie_breaks(ratings_df, titles_df):
    r = ratings_df(sum((ratings_of(m, 2) for m in (1, 2, 3, 4, 5)), []))
    t = titles_df(
        [
            (1, "1999", "A"),  # older: last
            (2, "2001", "B"),
            (3, "2001", "A"),  # same year, first title: first
            (4, "2001", "B"),  # full tie with 2: higher id after
            (5, "2000", "A"),
        ]
    )
    got = top_items(r, t, 0, 5, positioned=True)
    assert rows(got, "position", "movieId") == [(1, 3), (2, 2), (3, 4), (4, 5), (5, 1)]
    assert rows(top_items(r, t, 0, 2), "movieId") == [(2,), (3,)]


def test_fewer_qualifying_than_m_gives_all(ratings_df, titles_df):
    r = ratings_df(ratings_of(1, 3) + ratings_of(2, 3) + ratings_of(3, 1))
    t = titles_df([(1, "2000", "A"), (2, "2000", "B"), (3, "2000", "C")])
    assert rows(top_items(r, t, 2, 5), "movieId") == [(1,), (2,)]


def test_duplicate_title_id_resolved_to_one(titles_df):
    t = titles_df([(1, "1999", "Old"), (1, "2001", "Zed"), (1, "2001", "Alpha"), (2, "2000", "B")])
    assert rows(unique_titles(t)) == [(1, "2001", "Alpha"), (2, "2000", "B")]


# --- division -----------------------------------------------------------------


@pytest.mark.parametrize("bound", [None, 2, 100])
def test_rated_all_needs_distinct_items(ratings_df, bound):
    items = ratings_df([(1, 0, 0, ""), (2, 0, 0, "")]).select("movieId")
    r = ratings_df(
        [
            (1, 10, 3, "2005-01-01"),
            (1, 10, 4, "2005-01-02"),  # user 10 rated item 1 twice, item 2 never
            (1, 11, 1, "2005-01-01"),
            (1, 11, 5, "2005-01-02"),  # user 11 rated item 1 twice (1 and 5) ...
            (2, 11, 1, "2005-01-01"),  # ... and item 2 once: average 7/3
            (3, 11, 5, "2005-01-01"),  # not in the set: ignored
        ]
    )
    got = rows(rated_all(r, items, bound))
    assert got == [(11, 7 / 3, 3)]


def test_contrarian_users_tie_goes_to_lower_id(ratings_df):
    items = ratings_df([(1, 0, 0, "")]).select("movieId")
    r = ratings_df([(1, 30, 2, "d"), (1, 20, 2, "d"), (1, 10, 4, "d"), (1, 40, 1, "d")])
    got = contrarian_users(r, items, 2, max_items=1, positioned=True)
    assert rows(got, "position", "customerId") == [(1, 40), (2, 20)]


@pytest.mark.parametrize("more", [0, 70])
def test_bound_violation_fails(ratings_df, more):
    items = ratings_df([(1, 0, 0, ""), (2, 0, 0, ""), (3, 0, 0, "")]).select("movieId")
    r = ratings_df([(1, 10, 3, "d")])
    items = items.union(ratings_df([(10 + i, 0, 0, "") for i in range(more)]).select("movieId"))
    with pytest.raises(PySparkException, match="exceeds its stated bound"):
        rated_all(r, items, max_items=2 + max(0, more - 1)).collect()


@pytest.mark.parametrize("bound", [None, 1, 100])
def test_rows_without_a_rating_count_but_take_no_part_in_averages(ratings_df, bound):
    items = ratings_df([(1, 0, 0, "")]).select("movieId")
    r = ratings_df([(1, 10, 4, "d"), (1, 10, None, "d"), (1, 11, None, "d")])
    assert rows(rated_all(r, items, bound)) == [(10, 4.0, 2), (11, None, 1)]
    assert rows(rating_stats(r)) == [(1, 4.0, 3)]


# --- favourites -------------------------------------------------------------------


def test_maximum_is_taken_before_titles_join(ratings_df, titles_df):
    r = ratings_df(
        [
            (1, 10, 5, "2005-01-01"),  # user 10's only maximum is untitled
            (2, 10, 4, "2005-01-01"),
            (2, 11, 5, "2005-01-01"),
        ]
    )
    t = titles_df([(2, "2000", "Titled")])
    assert rows(favourites(r, t), "customerId", "movieId") == [(11, 2)]
    assert rows(user_max_rating(r)) == [(10, 5), (11, 5)]
    assert rows(best_ratings(r), "customerId", "movieId") == [(10, 1), (11, 2)]


def test_favourite_tie_breaks(ratings_df, titles_df):
    r = ratings_df(
        [
            (1, 10, 5, "2005-01-01"),
            (2, 10, 5, "2005-01-01"),
            (3, 10, 5, "2004-01-01"),
            (4, 10, 5, "2005-01-01"),
            (5, 10, 4, "2006-01-01"),  # lower rating: never picked
            (3, 20, 5, "2004-01-01"),
            (4, 20, 5, "2005-06-01"),  # same year and title as 3: later date wins
            (6, 30, 5, "2005-01-01"),
            (7, 30, 5, "2005-01-01"),  # full tie with 6: lower id wins
        ]
    )
    t = titles_df(
        [
            (1, "2001", "B"),
            (2, "2001", "A"),
            (3, "2002", "X"),
            (4, "2002", "X"),
            (5, "2010", "A"),
            (6, "2000", "S"),
            (7, "2000", "S"),
        ]
    )
    got = rows(favourites(r, t), "customerId", "movieId", "ratingDate")
    assert got == [(10, 4, "2005-01-01"), (20, 4, "2005-06-01"), (30, 6, "2005-01-01")]


def test_favourites_restricted_to_users(ratings_df, titles_df):
    r = ratings_df([(1, 10, 5, "d"), (1, 11, 5, "d")])
    t = titles_df([(1, "2000", "A")])
    users = ratings_df([(0, 11, 0, "")]).select("customerId")
    assert rows(favourites(r, t, users, max_users=1), "customerId") == [(11,)]
    assert rows(best_ratings(r, users), "customerId") == [(11,)]


# --- whole question -----------------------------------------------------------------


def test_nothing_popular_gives_empty_report_with_schema(ratings_df, titles_df):
    r = ratings_df(ratings_of(1, 3))
    t = titles_df([(1, "2000", "A")])
    report = contrarian_tastes(r, t, TasteParams(min_ratings=10, top_items=5, top_users=5))
    assert tuple(report.columns) == REPORT_COLUMNS
    assert report.collect() == []


ratings_strategy = st.lists(
    st.tuples(
        st.integers(1, 6),
        st.integers(1, 8),
        st.integers(1, 5),
        st.sampled_from(["2004-01-01", "2005-01-01", "2005-06-30"]),
    ),
    min_size=1,
    max_size=70,
)
titles_strategy = st.lists(
    st.tuples(st.integers(1, 6), st.sampled_from(["1999", "2000"]), st.sampled_from("ABC")),
    max_size=8,
)


@settings(
    max_examples=20,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(
    ratings=ratings_strategy,
    titles=titles_strategy,
    r=st.integers(0, 5),
    m=st.integers(1, 4),
    u=st.integers(1, 5),
)
def test_random_fixtures_match_brute_force(ratings_df, titles_df, ratings, titles, r, m, u):
    rdf, tdf = ratings_df(ratings), titles_df(titles)
    p = TasteParams(min_ratings=r, top_items=m, top_users=u)
    expected_report = model.report(ratings, titles, r, m, u)
    assert rows(contrarian_tastes(rdf, tdf, p, share_ratings=False)) == expected_report
    assert rows(contrarian_tastes(rdf, tdf, p, share_ratings=True)) == expected_report

    top = model.top_items(ratings, titles, r, m)
    assert [x[0] for x in rows(top_items(rdf, tdf, r, m, positioned=True), "position", "movieId")] == list(
        range(1, len(top) + 1)
    )
    assert [x[1] for x in rows(top_items(rdf, tdf, r, m, positioned=True), "position", "movieId")] == top

    items = rdf.where(rdf.movieId.isin(top)).select("movieId") if top else rdf.limit(0)
    expected = sorted(model.rated_all(ratings, top).items()) if top else []
    for bound in (None, m):
        got = [(c, a) for c, a, _n in rows(rated_all(rdf, items, bound))]
        assert got == expected

    fav = model.favourites(ratings, titles)
    assert rows(favourites(rdf, tdf), "customerId", "movieId") == sorted(
        (user, f[0]) for user, f in fav.items()
    )


def test_heavy_user_and_item_match_model(ratings_df, titles_df):
    import random

    rnd = random.Random(7)
    dates = [f"2005-0{m}-1{d}" for m in range(1, 10) for d in range(10)]
    rows_ = [(1, 1, rnd.randint(1, 5), rnd.choice(dates)) for _ in range(600)]  # hot user, hot item
    rows_ += [(rnd.randint(1, 8), rnd.randint(2, 60), rnd.randint(1, 5), rnd.choice(dates)) for _ in range(900)]
    titles = [(m, str(1998 + m % 3), "T" + "ABC"[m % 3]) for m in range(1, 8)]
    rdf, tdf = ratings_df(rows_), titles_df(titles)
    for share in (False, True):
        got = rows(contrarian_tastes(rdf, tdf, TasteParams(10, 3, 5), share_ratings=share))
        assert got == model.report(rows_, titles, 10, 3, 5)
    fav = model.favourites(rows_, titles)
    assert rows(favourites(rdf, tdf), "customerId", "movieId") == sorted((u, f[0]) for u, f in fav.items())


@pytest.mark.parametrize("m,u", [(0, 5), (3, 0)])
def test_zero_items_or_users_give_empty_report(ratings_df, titles_df, m, u):
    r = ratings_df(ratings_of(1, 3) + ratings_of(2, 3))
    t = titles_df([(1, "2000", "A"), (2, "2000", "B")])
    for share in (False, True):
        report = contrarian_tastes(r, t, TasteParams(0, m, u), share_ratings=share)
        assert report.collect() == []


def test_release_years_compare_as_text(ratings_df, titles_df):
    # Years are strings, as in the original data: 'NULL' > '2005' as text.
    r = ratings_df(ratings_of(1, 2) + ratings_of(2, 2))
    t = titles_df([(1, "2005", "A"), (2, "NULL", "B")])
    assert rows(top_items(r, t, 0, 2, positioned=True), "position", "movieId") == [(1, 2), (2, 1)]


def test_bitmask_at_its_largest_set_matches_general_division(ratings_df):
    items = list(range(100, 163))  # 63 items: bits 0..62
    rows_ = [(m, 1, 1 + m % 5, "d") for m in items]  # user 1 rated all of them
    rows_ += [(m, 2, 3, "d") for m in items[:-1]]  # user 2 missed the last one
    rows_ += [(m, 3, 2, "d") for m in items] + [(items[0], 3, 5, "e")]  # user 3: all, one twice
    r = ratings_df(rows_)
    item_df = ratings_df([(m, 0, 0, "") for m in items]).select("movieId")
    bitmask = rows(rated_all(r, item_df, max_items=63))
    general = rows(rated_all(r, item_df, max_items=None))
    assert bitmask == general
    assert [u for u, _avg, _n in bitmask] == [1, 3]


def test_user_max_rating_restricted_to_users(ratings_df):
    r = ratings_df([(1, 10, 2, "d"), (2, 10, 4, "d"), (1, 11, 5, "d"), (1, 12, 1, "d")])
    users = ratings_df([(0, 10, 0, ""), (0, 12, 0, ""), (0, 12, 0, "")]).select("customerId")
    assert rows(user_max_rating(r, users)) == [(10, 4), (12, 1)]
    assert rows(user_max_rating(r, users, max_users=3)) == [(10, 4), (12, 1)]


@pytest.mark.parametrize("max_items", [None, 400])
def test_division_by_sets_of_any_ids(spark, max_items):
    """Ids that are negative, far apart, and more than a word holds."""
    ids = [-(2**62), -65, -64, -1, 0, 63, 64, 2**53, 2**53 + 1, 2**62 + 1, *range(1000, 1200)]
    rows = [(i, 1, 3, "d") for i in ids] + [(i, 2, 4, "d") for i in ids if i != 2**53 + 1]
    rows += [(i, 3, None if i == 0 else 5, "d") for i in ids] + [(7777, 2, 1, "d"), (7777, 3, 1, "d")]
    ratings = spark.createDataFrame(rows, "movieId long, customerId long, rating int, ratingDate string")
    items = spark.createDataFrame([(i,) for i in ids * 2], "movieId long")
    got = sorted(tuple(r) for r in rated_all(ratings, items, max_items).collect())
    assert got == [(1, 3.0, len(ids)), (3, 5.0, len(ids))]

"""Ratings beyond the session's shuffle partitions: dealt to more, and hashed once a branch."""

from __future__ import annotations

import contextlib
import io
import random
import re

from tastes.operators import distinct_ratings, rated_all, top_items
from tastes.params import TasteParams
from tastes.plans import contrarian_tastes
from tastes.sources import tables

PARAMS = TasteParams(min_ratings=3, top_items=4, top_users=6)


def inputs(ratings_df, titles_df):
    rng = random.Random(3)
    rows = [
        (rng.randrange(6), rng.randrange(15), rng.choice([1, 2, 3, 4, 5, None]), f"2000-01-0{rng.randint(1, 3)}")
        for _ in range(600)
    ]
    rows += [(None, 1, 5, "2000-01-01"), (1, None, 5, "2000-01-01"), *rows[:50]]
    return ratings_df(rows), titles_df([(i, f"200{i % 2}", f"title {i}") for i in range(6)])


def test_partitions_of_shared_ratings(spark, ratings_df, titles_df):
    ratings, titles = inputs(ratings_df, titles_df)
    dealt = contrarian_tastes(ratings, titles, PARAMS, partitions=23)
    rows = sorted(dealt.collect())
    assert rows and rows == sorted(contrarian_tastes(ratings, titles, PARAMS).collect())
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        dealt.explain()
    final = out.getvalue().split("== Initial Plan ==")[0]
    exchanges = re.findall(r"(ReusedExchange)?[^\n]*Exchange hashpartitioning\(movieId[^\n]*, 23\), REPARTITION_BY_NUM", final)
    assert len(exchanges) == 3 and final.count("ReusedExchange") >= 2
    assert sorted(distinct_ratings(ratings, 23).collect(), key=str) == sorted(
        distinct_ratings(ratings).collect(), key=str
    )


def test_distinct_ratings_are_hashed_once_a_branch(ratings_df, titles_df):
    ratings, titles = inputs(ratings_df, titles_df)
    by_date = re.compile(r"Aggregate \[[^\]]*ratingDate#\d+[^\]]*\]")

    def hashed(df):
        return len(by_date.findall(df._jdf.queryExecution().optimizedPlan().toString()))

    # Top items, division, favourites: one each.
    assert hashed(contrarian_tastes(ratings, titles, PARAMS)) == 3
    distinct = distinct_ratings(ratings)
    top = top_items(distinct, titles, 3, 4)
    assert hashed(rated_all(distinct, top, 4)) == hashed(top) + 1
    # Ratings that are no set are made one, with the same result.
    unshared = rated_all(ratings, top_items(ratings, titles, 3, 4), 4)
    assert hashed(unshared) == hashed(top) + 1
    assert sorted(unshared.collect()) == sorted(rated_all(distinct, top, 4).collect())


def test_partitions_follow_the_stored_line_items(spark, tmp_path, monkeypatch):
    spark.range(20_000).selectExpr("id as l_orderkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert tables.ratings_partitions(spark, str(tmp_path)) is None
    monkeypatch.setattr(tables, "BYTES_PER_PARTITION", 1000)
    many = tables.ratings_partitions(spark, f"{tmp_path}/")
    size = sum(p.stat().st_size for p in (tmp_path / "lineitem.parquet").iterdir())
    assert many > 8 and (many - 1) * 1000 < size <= many * 1000 + 2000
    monkeypatch.setattr(tables, "BYTES_PER_PARTITION", size)
    assert tables.ratings_partitions(spark, str(tmp_path)) is None

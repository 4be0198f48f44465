"""

Every query reads the driver's parquet tables through one of the two
rating mappings of `tastes.sources.tables` and runs over the whole tables.
The oracle SQL restates the same rules in plain SQL for DuckDB.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tastes.job import run_job
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
    user_max_rating,
)
from tastes.params import JobParams, TasteParams
from tastes.plans import contrarian_tastes
from tastes.schemas import RATING_COLUMNS, REPORT_SCHEMA
from tastes.session import ensure_checkpoint_dir
from tastes.sinks import format_report
from tastes.sources import parse_ratings, parse_titles, read_ratings, read_titles
from tastes.sources.tables import (
    nation_rating_lines,
    nation_ratings,
    nation_raw_lines,
    nation_raw_title_lines,
    nation_title_lines,
    nation_titles,
    part_ratings,
    part_titles,
    ratings_partitions,
    region_nations,
    segment_customers,
)

try:  # The subpackage of text operators may be absent.
    from tastes.llm import queries as llm_queries
except ImportError:
    # Nor need a host have every library that the text operators use.
    llm_queries = None

FLAGSHIP_DIR = "/root/testdata/sf0.001"

FLAGSHIP = TasteParams(min_ratings=50, top_items=5, top_users=25)
NATION = TasteParams(min_ratings=1783, top_items=5, top_users=25)
NATION_FEW_POPULAR = TasteParams(min_ratings=2400, top_items=20, top_users=25)
NATION_MANY_ITEMS = TasteParams(min_ratings=1783, top_items=70, top_users=25)
PART = TasteParams(min_ratings=25, top_items=100, top_users=25)
PART_PIPELINE = TasteParams(min_ratings=25, top_items=1, top_users=25)
SEGMENT = "MACHINERY"
REGION = 0

_MAPPINGS = {
    "nation": (nation_ratings, nation_titles),
    "part": (part_ratings, part_titles),
}


def _inputs(spark: SparkSession, sf_dir: str, mapping: str):
    ratings_of, titles_of = _MAPPINGS[mapping]
    return ratings_of(spark, sf_dir), titles_of(spark, sf_dir)


def _top(spark, sf_dir, mapping, p: TasteParams, positioned=False) -> DataFrame:
    ratings, titles = _inputs(spark, sf_dir, mapping)
    return top_items(ratings, titles, p.min_ratings, p.top_items, p.inclusive, positioned)


def q_rating_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating_stats(nation_ratings(spark, sf_dir))


def q_popular_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular_items(part_ratings(spark, sf_dir), PART.min_ratings)


def q_popular_items_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular_items(part_ratings(spark, sf_dir), PART.min_ratings, inclusive=True)


def q_top_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "part", PART, positioned=True)


def _shared_nation(spark: SparkSession, sf_dir: str):
    """Deduplicated nation ratings, computed once and read by every branch.

    The mapped ratings are a join of two fact tables, expensive to derive
    again; the operators' own dedup of this input is dropped as redundant.
    """
    ratings = distinct_ratings(nation_ratings(spark, sf_dir), ratings_partitions(spark, sf_dir))
    top = top_items(
        ratings, nation_titles(spark, sf_dir), NATION.min_ratings, NATION.top_items
    )
    return ratings, top


def q_top_item_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings, top = _shared_nation(spark, sf_dir)
    return item_ratings(ratings, top, NATION.top_items)


def q_rated_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings, top = _shared_nation(spark, sf_dir)
    return rated_all(ratings, top, NATION.top_items)


def q_contrarian_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings, top = _shared_nation(spark, sf_dir)
    return contrarian_users(ratings, top, NATION.top_users, NATION.top_items, positioned=True)


def q_rated_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    # An item set from a filter, not a limit: no proven bound.
    items = region_nations(spark, sf_dir, REGION)
    return rated_all(nation_ratings(spark, sf_dir), items)


def q_user_max_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_max_rating(part_ratings(spark, sf_dir))


def q_best_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_ratings(part_ratings(spark, sf_dir))


def q_segment_best_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Users from a filter (one market segment): no bound, no broadcast hint.
    return best_ratings(part_ratings(spark, sf_dir), segment_customers(spark, sf_dir, SEGMENT))


def q_favourites(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings, titles = _inputs(spark, sf_dir, "part")
    return favourites(ratings, titles)


def q_segment_favourites(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings, titles = _inputs(spark, sf_dir, "part")
    return favourites(ratings, titles, segment_customers(spark, sf_dir, SEGMENT))


def q_contrarian_tastes(spark: SparkSession, sf_dir: str, mapping: str, p: TasteParams):
    ratings, titles = _inputs(spark, sf_dir, mapping)
    # The mapped ratings are a join of two fact tables: share one copy.
    partitions = ratings_partitions(spark, sf_dir)
    return contrarian_tastes(ratings, titles, p, share_ratings=True, partitions=partitions)


def q_text_rating_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating_stats(parse_ratings(nation_rating_lines(spark, sf_dir)))


def q_text_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_titles(nation_title_lines(spark, sf_dir))


def q_text_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole question from lines of text to lines of the report."""
    ratings = parse_ratings(nation_rating_lines(spark, sf_dir))
    titles = parse_titles(nation_title_lines(spark, sf_dir))
    partitions = ratings_partitions(spark, sf_dir)
    return format_report(
        contrarian_tastes(ratings, titles, NATION, share_ratings=True, partitions=partitions)
    )


def _rating_files(spark: SparkSession, sf_dir: str) -> str:
    """The nation ratings, bad lines included, written as text files: a folder.

    One file per item, its header first, and a titles file, in the session's
    checkpoint folder (a temporary one only where none is set).
    """
    base = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tastes-"))
    folder = f"{base.rstrip('/')}/tastes-{uuid.uuid4().hex}"
    (
        nation_raw_lines(spark, sf_dir)
        .repartition("file")
        .sortWithinPartitions("file", "block", "line")
        .select("file", "value")
        .write.partitionBy("file")
        .text(f"{folder}/ratings")
    )
    nation_raw_title_lines(spark, sf_dir).coalesce(1).write.text(f"{folder}/titles")
    return folder


def q_file_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating files with bad lines, read back through the file source, as a set."""
    return read_ratings(spark, f"{_rating_files(spark, sf_dir)}/ratings").select(*RATING_COLUMNS).distinct()


def q_file_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_titles(spark, f"{_rating_files(spark, sf_dir)}/titles")


def q_job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job from rating files to its CSV file, which is read back."""
    folder = _rating_files(spark, sf_dir)
    run_job(spark, JobParams(f"{folder}/ratings", f"{folder}/titles", f"{folder}/report", NATION))
    return spark.read.schema(REPORT_SCHEMA).csv(f"{folder}/report")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the whole question on the nation mapping at sf0.001."""
    return q_contrarian_tastes(spark, FLAGSHIP_DIR, "nation", FLAGSHIP)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return taste_queries() | (llm_queries.queries() if llm_queries else {})


def taste_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "rating_stats": q_rating_stats,
        "popular_items": q_popular_items,
        "popular_items_inclusive": q_popular_items_inclusive,
        "top_items": q_top_items,
        "top_item_ratings": q_top_item_ratings,
        "rated_all": q_rated_all,
        "contrarian_users": q_contrarian_users,
        "rated_region": q_rated_region,
        "user_max_rating": q_user_max_rating,
        "best_ratings": q_best_ratings,
        "segment_best_ratings": q_segment_best_ratings,
        "favourites": q_favourites,
        "segment_favourites": q_segment_favourites,
        "contrarian_tastes": partial(q_contrarian_tastes, mapping="nation", p=NATION),
        "contrarian_tastes_few_popular": partial(
            q_contrarian_tastes, mapping="nation", p=NATION_FEW_POPULAR
        ),
        "contrarian_tastes_parts": partial(q_contrarian_tastes, mapping="part", p=PART_PIPELINE),
        "text_rating_stats": q_text_rating_stats,
        "text_titles": q_text_titles,
        "text_report": q_text_report,
        "file_ratings": q_file_ratings,
        "file_titles": q_file_titles,
        "job_report": q_job_report,
        # More items than there are: the pipeline's division over all of them.
        "contrarian_tastes_many_items": partial(
            q_contrarian_tastes, mapping="nation", p=NATION_MANY_ITEMS
        ),
    }


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB). The rules, restated once in SQL:
#   ratings are a set of rows; an item is popular with more than R rows;
#   top items: best average, newest year, first title, lowest id, titled only;
#   contrarian users rated every top item (distinct ids), lowest row average,
#   lower id first; a favourite is picked among the rows at the user's own
#   maximum rating (taken before the titles join) by newest year, first
#   title, latest date, lowest item id.

_RATING_COLUMNS = """
    cast(l.l_quantity as integer) % 5 + 1 as rating,
    strftime(l.l_shipdate, '%Y-%m-%d') as "ratingDate"
"""

_SQL_RATINGS = {
    "nation": f"""
  select s.s_nationkey as "movieId", o.o_custkey as "customerId", {_RATING_COLUMNS}
  from lineitem l
  join orders o on l.l_orderkey = o.o_orderkey
  join supplier s on l.l_suppkey = s.s_suppkey""",
    "part": f"""
  select l.l_partkey as "movieId", o.o_custkey as "customerId", {_RATING_COLUMNS}
  from lineitem l
  join orders o on l.l_orderkey = o.o_orderkey""",
}

_SQL_TITLES = {
    "nation": """
  select n_nationkey as id, cast(2000 + n_regionkey as varchar) as "releaseYear",
         n_name as title
  from nation""",
    "part": """
  select p_partkey as id, cast(1990 + p_size % 5 as varchar) as "releaseYear",
         p_name as title
  from part""",
}


def _sql_base(mapping: str, min_ratings: int = 0, top_n: int = 0) -> str:
    return f"""with
ratings as ({_SQL_RATINGS[mapping]}),
titles as ({_SQL_TITLES[mapping]}),
ut as (
  select id, "releaseYear", title from (
    select *, row_number() over (partition by id order by "releaseYear" desc, title asc) as rn
    from titles) x
  where rn = 1),
stats as (
  select "movieId", avg(rating) as "avgRating", count(*) as "ratingsCount"
  from (select distinct * from ratings) d
  group by "movieId"),
top as (
  select * from (
    select s."movieId", s."avgRating", s."ratingsCount", t."releaseYear", t.title,
           cast(row_number() over (order by s."avgRating" desc, t."releaseYear" desc,
                                   t.title asc, s."movieId" asc) as integer) as "position"
    from stats s join ut t on s."movieId" = t.id
    where s."ratingsCount" > {min_ratings}) x
  where "position" <= {top_n}),
top_rows as (
  select distinct r.* from ratings r where r."movieId" in (select "movieId" from top)),
rated_all as (
  select "customerId", avg(rating) as "avgRating", count(*) as "ratingsCount"
  from top_rows
  group by "customerId"
  having count(distinct "movieId") = (select count(*) from top)),
ranked_users as (
  select *, cast(row_number() over (order by "avgRating" asc, "customerId" asc) as integer)
            as "position"
  from rated_all)"""


def _sql_favourites(users_filter: str) -> str:
    """Favourites of the users that `users_filter` (a WHERE on ratings r) keeps."""
    return f""",
user_rows as (select r.* from ratings r where {users_filter}),
maxima as (select "customerId", max(rating) as m from user_rows group by "customerId"),
best as (
  select u.* from user_rows u
  join maxima x on u."customerId" = x."customerId" and u.rating = x.m),
picked as (
  select b."customerId", b."movieId", t.title, t."releaseYear", b.rating, b."ratingDate",
         row_number() over (partition by b."customerId"
                            order by t."releaseYear" desc, t.title asc,
                                     b."ratingDate" desc, b."movieId" asc) as rn
  from best b join ut t on b."movieId" = t.id)"""


def _sql_pipeline(mapping: str, p: TasteParams) -> str:
    users = f'r."customerId" in (select "customerId" from ranked_users where "position" <= {p.top_users})'
    return (
        _sql_base(mapping, p.min_ratings, p.top_items)
        + _sql_favourites(users)
        + """
select "customerId", title as "movieTitle", "releaseYear" as "movieReleaseYear", "ratingDate"
from picked where rn = 1"""
    )


def _as_text(sql: str) -> str:
    """The nation mapping's SQL with a time of day and a comma in the titles."""
    return sql.replace(
        "strftime(l.l_shipdate, '%Y-%m-%d')", "strftime(l.l_shipdate, '%Y-%m-%d') || ' 10:30'"
    ).replace("n_name as title", "n_name || ', nation' as title")


_FAVOURITE_COLUMNS = """
select "customerId", "movieId", title as "movieTitle", "releaseYear" as "movieReleaseYear",
       rating, "ratingDate"
from picked where rn = 1"""


_SEGMENT_USERS = (
    'r."customerId" in (select c_custkey from customer '
    f"where c_mktsegment = '{SEGMENT}')"
)


def oracle_sql() -> dict[str, str]:
    return taste_oracle_sql() | (llm_queries.oracle_sql() if llm_queries else {})


def taste_oracle_sql() -> dict[str, str]:
    return {
        "rating_stats": _sql_base("nation") + "\nselect * from stats",
        "popular_items": _sql_base("part")
        + f'\nselect * from stats where "ratingsCount" > {PART.min_ratings}',
        "popular_items_inclusive": _sql_base("part")
        + f'\nselect * from stats where "ratingsCount" >= {PART.min_ratings}',
        "top_items": _sql_base("part", PART.min_ratings, PART.top_items)
        + '\nselect "movieId", "avgRating", "ratingsCount", "releaseYear", title, "position"'
        + "\nfrom top",
        "top_item_ratings": _sql_base("nation", NATION.min_ratings, NATION.top_items)
        + "\nselect * from top_rows",
        "rated_all": _sql_base("nation", NATION.min_ratings, NATION.top_items)
        + "\nselect * from rated_all",
        "contrarian_users": _sql_base("nation", NATION.min_ratings, NATION.top_items)
        + f'\nselect * from ranked_users where "position" <= {NATION.top_users}',
        "rated_region": _sql_base("nation")
        + f""",
region_items as (select n_nationkey as "movieId" from nation where n_regionkey = {REGION}),
region_rows as (
  select distinct r.* from ratings r
  where r."movieId" in (select "movieId" from region_items))
select "customerId", avg(rating) as "avgRating", count(*) as "ratingsCount"
from region_rows
group by "customerId"
having count(distinct "movieId") = (select count(*) from region_items)""",
        "user_max_rating": _sql_base("part")
        + '\nselect "customerId", max(rating) as "maxRating" from ratings group by "customerId"',
        "best_ratings": _sql_base("part")
        + _sql_favourites("true")
        + "\nselect distinct * from best",
        "segment_best_ratings": _sql_base("part")
        + _sql_favourites(_SEGMENT_USERS)
        + "\nselect distinct * from best",
        "favourites": _sql_base("part") + _sql_favourites("true") + _FAVOURITE_COLUMNS,
        "segment_favourites": _sql_base("part")
        + _sql_favourites(_SEGMENT_USERS)
        + _FAVOURITE_COLUMNS,
        "text_rating_stats": _as_text(_sql_base("nation")) + "\nselect * from stats",
        "text_titles": _as_text(_sql_base("nation")) + "\nselect * from titles",
        "text_report": "select \"customerId\" || ',\"' || \"movieTitle\" || '\",' || "
        '"movieReleaseYear" || \',\' || "ratingDate" as line from ('
        + _as_text(_sql_pipeline("nation", NATION))
        + ")",
        "file_ratings": _as_text(_sql_base("nation"))
        + '\nselect distinct "movieId", cast("customerId" as integer) as "customerId", rating, '
        + '"ratingDate" from ratings',
        "file_titles": _as_text(_sql_base("nation")) + "\nselect * from titles",
        "job_report": 'select cast("customerId" as integer) as "customerId", "movieTitle", '
        '"movieReleaseYear", "ratingDate" from ('
        + _as_text(_sql_pipeline("nation", NATION))
        + ")",
        "contrarian_tastes": _sql_pipeline("nation", NATION),
        "contrarian_tastes_few_popular": _sql_pipeline("nation", NATION_FEW_POPULAR),
        "contrarian_tastes_parts": _sql_pipeline("part", PART_PIPELINE),
        "contrarian_tastes_many_items": _sql_pipeline("nation", NATION_MANY_ITEMS),
    }

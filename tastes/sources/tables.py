"""Ratings and titles derived from the TPC-H-like parquet tables.

The driver's data has no ratings table, so two mappings turn purchases into
ratings: a customer rates what they bought with `quantity % 5 + 1` stars on
the ship date.

* nation mapping (dense, few items): the item is the supplier's nation;
  titles are the nations.
* part mapping (sparse, many ties): the item is the part, titles are the
  parts.

Rows are not deduplicated here: a customer who bought the same quantity
from two suppliers of one nation on one day gives two identical rating
lines, which the operators must count once. Scans read only the columns
used. Line items and orders are both fact tables, so their join is a
sort-merge join by hint: at scale Spark would pick it anyway, and on small
files it keeps a large orders side from being collected to the driver and
broadcast. Dimension joins (supplier) are left to Catalyst and AQE.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastes.schemas import CUSTOMER_ID, ID, MOVIE_ID, RATING, RATING_DATE, RELEASE_YEAR, TITLE

# Fixed values of the mappings.
STAR_LEVELS = 5
FIRST_RELEASE_YEAR = 2000
FIRST_PART_RELEASE_YEAR = 1990
PART_YEAR_SPREAD = 5
# Stored bytes of line items whose ratings make one partition, when sizing from the input.
BYTES_PER_PARTITION = 4 * 1024 * 1024


# The columns read from each driver table, with their stored types. Declaring
# them skips schema inference (a job per table) and reads nothing else.
_LONG, _INT, _DOUBLE, _STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
TABLE_COLUMNS = {
    "lineitem": [
        ("l_orderkey", _LONG),
        ("l_partkey", _LONG),
        ("l_suppkey", _LONG),
        ("l_quantity", _DOUBLE),
        ("l_shipdate", T.TimestampNTZType()),
    ],
    "orders": [("o_orderkey", _LONG), ("o_custkey", _LONG)],
    "supplier": [("s_suppkey", _LONG), ("s_nationkey", _INT)],
    "nation": [("n_nationkey", _INT), ("n_name", _STRING), ("n_regionkey", _INT)],
    "part": [("p_partkey", _LONG), ("p_name", _STRING), ("p_size", _INT)],
    "customer": [("c_custkey", _LONG), ("c_mktsegment", _STRING)],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, t, True) for c, t in TABLE_COLUMNS[name]])
    return spark.read.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings_partitions(spark: SparkSession, sf_dir: str) -> int | None:
    """How many partitions the ratings of all line items need; None if the session has them.

    The number of shuffle partitions is fixed when a query is planned, so without
    this a task's share of the ratings grows with the table. The length of the
    table comes from its file system, no file is read. A non-numeric setting is
    left to its owner.
    """
    setting = spark.conf.get("spark.sql.shuffle.partitions")
    if not setting.isdigit():
        return None
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    wanted = math.ceil(fs.getContentSummary(path).getLength() / BYTES_PER_PARTITION)
    return wanted if wanted > int(setting) else None


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").hint("merge")
    return lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])


def _rating_columns(item: str) -> list:
    return [
        F.col(item).alias(MOVIE_ID),
        F.col("o_custkey").alias(CUSTOMER_ID),
        (F.col("l_quantity").cast("int") % STAR_LEVELS + 1).alias(RATING),
        # TIMESTAMP_NTZ -> DATE -> 'yyyy-MM-dd' never consults a time zone.
        F.col("l_shipdate").cast("date").cast("string").alias(RATING_DATE),
    ]


def nation_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of supplier nations: (movieId INT, customerId BIGINT, rating INT, ratingDate)."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    bought = _purchases(spark, sf_dir)
    return bought.join(supplier, bought["l_suppkey"] == supplier["s_suppkey"]).select(
        *_rating_columns("s_nationkey")
    )


def nation_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of nations: (id INT, releaseYear STRING, title STRING)."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias(ID),
        (F.lit(FIRST_RELEASE_YEAR) + F.col("n_regionkey")).cast("string").alias(RELEASE_YEAR),
        F.col("n_name").alias(TITLE),
    )


def part_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of parts: (movieId BIGINT, customerId BIGINT, rating INT, ratingDate)."""
    return _purchases(spark, sf_dir).select(*_rating_columns("l_partkey"))


def part_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of parts: (id BIGINT, releaseYear STRING, title STRING)."""
    year = F.lit(FIRST_PART_RELEASE_YEAR) + F.col("p_size") % PART_YEAR_SPREAD
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(ID),
        year.cast("string").alias(RELEASE_YEAR),
        F.col("p_name").alias(TITLE),
    )


def nation_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation ratings as lines of rating files, headers first: (file, block, line, value).

    The date carries a time of day, so rating lines hold colons too; lines of
    the highest rating end in a separator.
    """
    file = F.concat(F.lit("mv_"), F.col(MOVIE_ID).cast("string"), F.lit(".txt")).alias("file")
    dated = F.concat(F.col(RATING_DATE), F.lit(" 10:30"))
    ending = F.when(F.col(RATING) == STAR_LEVELS, ",").otherwise("")
    ratings = nation_ratings(spark, sf_dir).select(
        file,
        F.lit(0).alias("block"),
        (F.monotonically_increasing_id() + 1).alias("line"),
        F.concat(F.concat_ws(",", CUSTOMER_ID, RATING, dated), ending).alias("value"),
    )
    items = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(MOVIE_ID))
    headers = items.select(
        file,
        F.lit(0).alias("block"),
        F.lit(0).cast("long").alias("line"),
        F.concat(F.col(MOVIE_ID).cast("string"), F.lit(":")).alias("value"),
    )
    return headers.union(ratings)


def nation_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`nation_rating_lines` and, for every supplier, lines that are no ratings.

    Short, long and blank ones, and one that is short once its trailing
    separators are dropped, in the file of the supplier's nation.
    """
    bad = F.array(
        F.concat_ws(",", "s_suppkey", F.lit("5")),
        F.concat_ws(",", "s_suppkey", F.lit("5"), F.lit("1999-01-01"), F.lit("x")),
        F.lit(""),
        F.lit("   "),
        F.concat_ws(",", "s_suppkey", F.lit("5"), F.lit(""), F.lit("")),
    )
    lines = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("mv_"), F.col("s_nationkey").cast("string"), F.lit(".txt")).alias("file"),
        F.lit(0).alias("block"),
        (F.monotonically_increasing_id() + 1).alias("line"),
        F.explode(bad).alias("value"),
    )
    return nation_rating_lines(spark, sf_dir).union(lines)


def nation_title_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation titles as lines of a titles file: (value); titles hold a comma."""
    title = F.concat(F.col(TITLE), F.lit(", nation"))
    return nation_titles(spark, sf_dir).select(
        F.concat_ws(",", F.col(ID).cast("string"), RELEASE_YEAR, title).alias("value")
    )


def nation_raw_title_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`nation_title_lines` and, for every region, lines that are no titles."""
    bad = F.array(
        F.concat_ws(",", "n_regionkey", F.lit("1999")),
        F.concat_ws(",", "n_regionkey", F.lit("1999"), F.lit("")),
        F.lit(""),
        F.col("n_regionkey").cast("string"),
    )
    regions = table(spark, sf_dir, "nation").select("n_regionkey").distinct()
    return nation_title_lines(spark, sf_dir).union(regions.select(F.explode(bad).alias("value")))


def region_nations(spark: SparkSession, sf_dir: str, region: int) -> DataFrame:
    """Items of the nation mapping that lie in one region: (movieId INT)."""
    return (
        table(spark, sf_dir, "nation")
        .where(F.col("n_regionkey") == region)
        .select(F.col("n_nationkey").alias(MOVIE_ID))
    )


def segment_customers(spark: SparkSession, sf_dir: str, segment: str) -> DataFrame:
    """Users of one market segment: (customerId BIGINT)."""
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") == segment)
        .select(F.col("c_custkey").alias(CUSTOMER_ID))
    )

"""Text sources: a directory of rating files and one titles file.

Rating files (one per item)::

    <movieId>:
    <customerId>,<rating>,<date>
    ...

The files are read line by line, never whole: a blockbuster's file is split
across tasks like any other large text file. A line's place is the start of its
split in the file (`_metadata.file_block_start`) and a number that rises within
the split. The header is the file's first line; its item id goes to all other
lines of the file.

The lines are derived once: one exchange by (file, salt of the line) feeds both
the headers, one row per file, and the join that brings them to the lines. Every
header is repeated once per salt, so a hot file spreads over `HEADER_SALTS`
tasks.

`parse_ratings` and `parse_titles` work on any DataFrame of lines; the
readers add the file scan. Checks run inside the plan, with no extra pass: a
line in a file with no header line or more than one, a line before the header,
and a non-numeric id or rating, fail the job. A colon elsewhere, as in a time
of day, is ordinary text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastes.functions.text import (
    field,
    java_trim,
    split_fields,
    strict_int,
    strip_trailing_separators,
)
from tastes.schemas import CUSTOMER_ID, ID, MOVIE_ID, RATING, RATING_DATE, RELEASE_YEAR, TITLE

# Fixed values of the file formats.
RATING_FILES_GLOB = "*.txt"
HEADER_MARK = ":"
HEADER_PATTERN = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*:"
SEPARATOR = ","
RATING_FIELDS = 3
TITLE_FIELDS = 3

# Copies of every header, so that a hot file's lines are dealt over as many tasks.
HEADER_SALTS = 16

FILE = "file"
BLOCK = "block"
LINE = "line"


def read_ratings(spark: SparkSession, directory: str) -> DataFrame:
    """Ratings of the `*.txt` files directly in `directory` (see `parse_ratings`)."""
    lines = (
        spark.read.option("pathGlobFilter", RATING_FILES_GLOB)
        .text(directory.strip())
        .select(
            "value",
            F.col("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_block_start").alias(BLOCK),
            F.monotonically_increasing_id().alias(LINE),
        )
    )
    return parse_ratings(lines)


def parse_ratings(lines: DataFrame) -> DataFrame:
    """Ratings as rows (movieId INT, customerId INT, rating INT, ratingDate STRING).

    `lines` has the columns `file` and `value` and, where the header's place is
    to be checked, `block` and `line`, by which a file's lines are in order.
    Rating lines that do not have exactly three fields (trailing empty fields
    ignored) are skipped. Exact duplicate lines are kept here; the operators
    count them once.
    """
    ordered = {BLOCK, LINE} <= set(lines.columns)
    place = F.struct(BLOCK, LINE) if ordered else F.lit(0)
    shared = lines.select(
        FILE,
        "value",
        place.alias("_place"),
        F.pmod(F.xxhash64("value"), F.lit(HEADER_SALTS)).cast("int").alias("_salt"),
    ).repartition(FILE, "_salt")
    is_header = F.col("value").rlike(HEADER_PATTERN)
    # Not a plain filter: Spark would move it below the exchange, a different
    # one for each side, and derive the lines twice.
    here = F.spark_partition_id() >= 0

    header_id = strict_int(java_trim(F.substring_index("value", HEADER_MARK, 1)), "movie id")
    headers = (
        shared.where(F.when(here, is_header))
        .groupBy(FILE)
        .agg(
            F.count(F.lit(1)).alias("_headers"),
            F.min(header_id).alias(MOVIE_ID),
            F.min("_place").alias("_first"),
        )
        .select(
            FILE,
            F.when(F.col("_headers") == 1, F.col(MOVIE_ID))
            .otherwise(
                F.raise_error(F.concat(F.lit("more than one header line in "), F.col(FILE)))
            )
            .alias(MOVIE_ID),
            "_first",
            F.explode(F.sequence(F.lit(0), F.lit(HEADER_SALTS - 1))).alias("_salt"),
        )
    )

    fields = split_fields(strip_trailing_separators("value", SEPARATOR), SEPARATOR)
    rows = shared.where(F.when(here, ~is_header)).select(
        FILE, "_salt", "_place", fields.alias("_fields")
    )
    joined = rows.join(headers, [FILE, "_salt"], "left").where(
        (F.size("_fields") == RATING_FIELDS) | (F.col("_place") < F.col("_first"))
    )
    return joined.select(
        F.when(
            F.col(MOVIE_ID).isNull(),
            F.raise_error(F.concat(F.lit("no header line in "), F.col(FILE))),
        )
        .when(
            F.col("_place") < F.col("_first"),
            F.raise_error(F.concat(F.lit("the header is not the first line of "), F.col(FILE))),
        )
        .otherwise(F.col(MOVIE_ID))
        .alias(MOVIE_ID),
        strict_int(java_trim(field(F.col("_fields"), 0)), "customer id").alias(CUSTOMER_ID),
        strict_int(java_trim(field(F.col("_fields"), 1)), "rating").alias(RATING),
        java_trim(field(F.col("_fields"), 2)).alias(RATING_DATE),
    )


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """Titles of one file (see `parse_titles`)."""
    return parse_titles(spark.read.text(path.strip()))


def parse_titles(lines: DataFrame) -> DataFrame:
    """Titles as rows (id INT, releaseYear STRING, title STRING).

    Each line is split into at most three fields, so a title keeps its
    commas, a trailing one too. Quotes are literal text. Lines with fewer
    than three fields or nothing after the second comma are skipped; a title
    of blanks is an empty title. A non-numeric id fails the job. Repeated
    ids are kept here and resolved by the operators.
    """
    fields = split_fields("value", SEPARATOR, TITLE_FIELDS)
    return (
        lines.select(fields.alias("_fields"))
        .where((F.size("_fields") == TITLE_FIELDS) & (field(F.col("_fields"), 2) != ""))
        .select(
            strict_int(java_trim(field(F.col("_fields"), 0)), "title id").alias(ID),
            java_trim(field(F.col("_fields"), 1)).alias(RELEASE_YEAR),
            java_trim(field(F.col("_fields"), 2)).alias(TITLE),
        )
    )

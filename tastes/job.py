"""One report run: text files in, CSV report out."""

from __future__ import annotations

import argparse
import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastes.params import JobParams, TasteParams
from tastes.plans.materialize import Placement, materialize_files
from tastes.plans.pipeline import contrarian_tastes
from tastes.schemas import RATING_COLUMNS
from tastes.sinks.report import write_report
from tastes.sources.text import RATING_FILES_GLOB, read_ratings, read_titles


# Target input bytes per shuffle partition when sizing from the input.
BYTES_PER_PARTITION = 128 * 1024 * 1024
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
# Buckets of the copy where the session's number of shuffle partitions is none.
DEFAULT_BUCKETS = 200


def input_bytes(spark: SparkSession, directory: str) -> int:
    """Total size of the rating files, from the file listing (no file is read).

    A one-row distributed aggregate over Spark's `binaryFile` listing; the
    file contents are not selected, so they are never read.
    """
    row = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", RATING_FILES_GLOB)
        .load(directory.strip())
        .agg(F.sum("length").alias("bytes"))
        .first()
    )
    return int(row["bytes"] or 0)


def wanted_shuffle_partitions(spark: SparkSession, directory: str) -> int:
    """About one partition per 128 MiB of input, never below the session's setting.

    AQE coalesces small partitions but never splits the initial count, so at
    scale the count must start high enough for partitions to fit in memory.
    A non-numeric setting is left to its owner (0).
    """
    setting = spark.conf.get(SHUFFLE_PARTITIONS)
    if not setting.isdigit():
        return 0
    return max(int(setting), math.ceil(input_bytes(spark, directory) / BYTES_PER_PARTITION))


@contextmanager
def shuffle_partitions(spark: SparkSession, wanted: int) -> Iterator[None]:
    """Run a job with `wanted` shuffle partitions (0: as set), then restore the setting."""
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    if wanted:
        spark.conf.set(SHUFFLE_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)


def build_report(spark: SparkSession, params: JobParams) -> DataFrame:
    """The report DataFrame for `params`.

    Lazy but for one step: with `materialize_ratings` the parsed ratings are
    written as parquet before this returns, unless the copy of an earlier run
    over the same files is there. The copy's rows are distinct and lie in as many
    buckets as the session has shuffle partitions, by all rating columns, so that
    no branch has to exchange them to remove duplicates.
    """
    titles = read_titles(spark, params.titles_file)
    parsed = read_ratings(spark, params.ratings_dir)
    ratings = parsed
    if params.materialize_ratings:
        setting = spark.conf.get(SHUFFLE_PARTITIONS)
        buckets = int(setting) if setting.isdigit() else DEFAULT_BUCKETS
        ratings = materialize_files(
            spark,
            params.ratings_dir,
            RATING_FILES_GLOB,
            "ratings",
            lambda: parsed,
            placement=Placement(tuple(RATING_COLUMNS), buckets),
        )
    # A parquet copy is cheap to rescan with pushed-down filters; unparsed
    # text is not, so then the branches share one deduplicated result.
    stored = ratings is not parsed
    return contrarian_tastes(ratings, titles, params.tastes, share_ratings=not stored)


def run_job(spark: SparkSession, params: JobParams) -> None:
    """Compute the report and write it to `params.output_dir`."""
    wanted = params.partitions or wanted_shuffle_partitions(spark, params.ratings_dir)
    with shuffle_partitions(spark, wanted):
        write_report(build_report(spark, params), params.output_dir)


def parse_args(argv: Sequence[str] | None = None) -> JobParams:
    defaults = TasteParams()
    parser = argparse.ArgumentParser(
        prog="tastes",
        description="Items well loved by users who dislike what most users like.",
    )
    # The original job's long and short option names.
    parser.add_argument("--ratings-dir", "--movie-ratings-dir", "-mrd", required=True)
    parser.add_argument("--titles-file", "--movie-titles-file", "-mtf", required=True)
    parser.add_argument("--output-dir", "-o", required=True)
    parser.add_argument(
        "--min-ratings", "--min-rate-users-number", "-mrun", type=int, default=defaults.min_ratings
    )
    parser.add_argument(
        "--top-items", "--top-movies-number", "-tmn", type=int, default=defaults.top_items
    )
    parser.add_argument(
        "--top-users", "--contrarian-users-number", "-cun", type=int, default=defaults.top_users
    )
    parser.add_argument("--partitions", "--partitions-number", "-pn", type=int, default=None)
    parser.add_argument(
        "--inclusive", action="store_true", help="popular means at least R ratings, not more"
    )
    parser.add_argument(
        "--no-materialize",
        action="store_true",
        help="skip the parquet copy; the plan then parses the text once and every "
        "branch reads the shared deduplicated ratings",
    )
    args = parser.parse_args(argv)
    return JobParams(
        ratings_dir=args.ratings_dir,
        titles_file=args.titles_file,
        output_dir=args.output_dir,
        tastes=TasteParams(
            min_ratings=args.min_ratings,
            top_items=args.top_items,
            top_users=args.top_users,
            inclusive=args.inclusive,
        ),
        partitions=args.partitions,
        materialize_ratings=not args.no_materialize,
    )


def main(argv: Sequence[str] | None = None) -> None:
    params = parse_args(argv)
    spark = SparkSession.builder.appName("tastes").getOrCreate()
    run_job(spark, params)

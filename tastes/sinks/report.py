"""The CSV report: one headerless file, four columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastes.schemas import REPORT_COLUMNS


def format_report(report: DataFrame) -> DataFrame:
    """The report's CSV lines (column `line`), as `write_report` writes them."""
    return report.select(F.to_csv(F.struct(*REPORT_COLUMNS), {"sep": ","}).alias("line"))


def write_report(report: DataFrame, output_dir: str) -> None:
    """Write the report as a single CSV part file under `output_dir`.

    Fails if `output_dir` exists. Values with a comma or quote are quoted
    by Spark's CSV writer. The report has at most one row per contrarian
    user, so one file is cheap; `repartition(1)` (not `coalesce(1)`) keeps
    the stages before it parallel and moves only the final rows.
    """
    (
        report.select(*REPORT_COLUMNS)
        .repartition(1)
        .write.mode("errorifexists")
        .option("sep", ",")
        .option("header", "false")
        .csv(output_dir)
    )

"""The CSV report sink."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from tastes.schemas import REPORT_SCHEMA
from tastes.sinks import write_report


def part_files(directory):
    return [p for p in directory.iterdir() if p.name.startswith("part-")]


def test_single_headerless_file_with_quoting(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "One, Two", "2000", "2005-01-01"), (2, "Plain", "1999", "2004-01-01")],
        REPORT_SCHEMA,
    ).repartition(4)
    out = tmp_path / "report"
    write_report(df, str(out))
    files = part_files(out)
    assert len(files) == 1
    lines = sorted(files[0].read_text().splitlines())
    assert lines == ['1,"One, Two",2000,2005-01-01', "2,Plain,1999,2004-01-01"]


def test_existing_output_fails(spark, tmp_path):
    df = spark.createDataFrame([(1, "A", "2000", "2005-01-01")], REPORT_SCHEMA)
    out = tmp_path / "report"
    write_report(df, str(out))
    with pytest.raises(AnalysisException, match="already exists"):
        write_report(df, str(out))


def test_empty_report_writes_a_file(spark, tmp_path):
    df = spark.createDataFrame([], REPORT_SCHEMA)
    out = tmp_path / "report"
    write_report(df, str(out))
    assert (out / "_SUCCESS").exists()

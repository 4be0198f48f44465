"""Parameters and the lineage cut."""

from __future__ import annotations

import sys

import pytest

from tastes.params import JobParams, TasteParams
from tastes.plans import materialize
from tastes.session import checkpoint_dir


def test_taste_params_validation():
    assert TasteParams() == TasteParams(min_ratings=50, top_items=5, top_users=25)
    for bad in ({"min_ratings": -1}, {"top_items": 1.5}, {"top_users": True}):
        with pytest.raises(ValueError):
            TasteParams(**bad)


def test_job_params_require_paths():
    with pytest.raises(ValueError):
        JobParams(ratings_dir=" ", titles_file="t", output_dir="o")
    with pytest.raises(ValueError):
        JobParams(ratings_dir="r", titles_file="t", output_dir="o", partitions=0)


def test_materialize_writes_under_the_checkpoint_folder(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    copy = materialize(spark, df, "numbers")
    assert sorted(r.x for r in copy.collect()) == list(range(10))
    base = checkpoint_dir(spark).removeprefix("file:")
    assert all(base in path for path in copy.inputFiles())


def test_materialize_without_checkpoint_folder_keeps_the_plan(spark, monkeypatch):
    module = sys.modules["tastes.plans.materialize"]
    monkeypatch.setattr(module, "checkpoint_dir", lambda _spark: None)
    df = spark.range(3)
    assert materialize(spark, df, "numbers") is df

from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tastes.schemas import RATINGS_SCHEMA, TITLES_SCHEMA  # noqa: E402
from tastes.session import ensure_checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="*", shuffle_partitions=8, app_name="tastes-tests")
    # Tests only: a checkpoint folder when the session names none.
    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="tastes-ckpt-"))
    yield session
    session.stop()


@pytest.fixture
def shuffled_joins(spark):
    """No side is small enough to broadcast, at planning or at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture
def ratings_df(spark):
    """Build a ratings DataFrame from (movieId, customerId, rating, ratingDate) tuples."""

    def make(rows):
        return spark.createDataFrame(list(rows), RATINGS_SCHEMA)

    return make


@pytest.fixture
def titles_df(spark):
    """Build a titles DataFrame from (id, releaseYear, title) tuples."""

    def make(rows):
        return spark.createDataFrame(list(rows), TITLES_SCHEMA)

    return make

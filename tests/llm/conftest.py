from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_df(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) tuples."""

    def make(rows, partitions=3):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1]) if r[1] else None)
            for r in rows
        ]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make

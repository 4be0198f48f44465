"""Join helper: keep the rows of some keys.

No size hint and no size constant: Catalyst and AQE measure the sides and
broadcast a small one; otherwise the join is shuffled. An unbounded key set
is joined bare, with nothing between its scan and the exchange, a shape in
which AQE can split a hot key's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def restrict_to(
    df: DataFrame, keys: DataFrame | None, column: str, max_keys: int | None = None
) -> DataFrame:
    """Keep rows of `df` whose `column` occurs in `keys`.

    `keys=None` means no restriction. A set with a stated bound comes out of
    a limit and is written as an inner join with its distinct keys: Catalyst
    does not push that below an aggregation in `df`, so a deduplicated result
    that other branches read too is shared, not recomputed. A set without a
    bound is a left semi join on the bare keys.
    """
    if keys is None:
        return df
    if max_keys is not None:
        return df.join(keys.select(column).distinct(), column)
    return df.join(keys.select(column), column, "left_semi")

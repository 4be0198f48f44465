"""Job parameters."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TasteParams:
    """Thresholds of the contrarian-tastes question.

    min_ratings (R): an item is popular with more than R rating rows
        (at least R when `inclusive`).
    top_items (M): number of top items.
    top_users (U): number of contrarian users.
    """

    min_ratings: int = 50
    top_items: int = 5
    top_users: int = 25
    inclusive: bool = False

    def __post_init__(self) -> None:
        for name in ("min_ratings", "top_items", "top_users"):
            value = getattr(self, name)
            if not isinstance(value, int) or isinstance(value, bool) or value < 0:
                raise ValueError(f"{name} must be a non-negative integer, got {value!r}")


@dataclass(frozen=True)
class JobParams:
    """Everything one report run needs.

    partitions: initial shuffle parallelism for this job (AQE coalesces
        from there); None sizes it from the input, one partition per
        128 MiB of rating files, never below the session setting.
    materialize_ratings: write the parsed ratings once as parquet under the
        session's `spark.checkpoint.dir` and let each branch rescan that copy
        with its own filter. Also cuts the lineage, so a lost executor
        re-reads parquet. Without it the text is parsed once in the plan and
        the branches share the deduplicated ratings.
    """

    ratings_dir: str
    titles_file: str
    output_dir: str
    tastes: TasteParams = TasteParams()
    partitions: int | None = None
    materialize_ratings: bool = True

    def __post_init__(self) -> None:
        for name in ("ratings_dir", "titles_file", "output_dir"):
            value = getattr(self, name)
            if not isinstance(value, str) or not value.strip():
                raise ValueError(f"{name} is required")
        if self.partitions is not None and self.partitions <= 0:
            raise ValueError("partitions must be positive")

"""Sources: text files of the original format, and mappings of parquet tables."""

from tastes.sources.tables import (
    nation_ratings,
    nation_titles,
    part_ratings,
    part_titles,
    region_nations,
    segment_customers,
)
from tastes.sources.text import parse_ratings, parse_titles, read_ratings, read_titles

__all__ = [
    "nation_ratings",
    "nation_titles",
    "part_ratings",
    "part_titles",
    "parse_ratings",
    "parse_titles",
    "read_ratings",
    "read_titles",
    "region_nations",
    "segment_customers",
]

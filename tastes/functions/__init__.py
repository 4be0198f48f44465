"""Column expressions and join helpers shared by sources and operators."""

from tastes.functions.joins import restrict_to
from tastes.functions.text import (
    field,
    java_trim,
    split_fields,
    strict_int,
    strip_trailing_separators,
)

__all__ = [
    "field",
    "java_trim",
    "restrict_to",
    "split_fields",
    "strict_int",
    "strip_trailing_separators",
]

"""Composed plans: the whole question, and lineage cuts."""

from tastes.plans.materialize import Placement, files_digest, materialize, materialize_files
from tastes.plans.pipeline import contrarian_tastes

__all__ = [
    "Placement",
    "contrarian_tastes",
    "files_digest",
    "materialize",
    "materialize_files",
]

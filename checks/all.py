"""Imports every check module, so that all queries are registered."""

from checks import (  # noqa: F401
    cleaning_checks, compare_checks, control_checks, lineage_checks, migrate_checks, name_checks, schema_checks,
    scoring_checks, source_checks,
)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

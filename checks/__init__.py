"""Checked queries: each operator on the given tables, next to the SQL that must agree."""

from checks import (explain_checks, model_checks, prepare_checks, profile_checks,  # noqa: F401
                    registry_checks, scoring_checks, serving_checks, source_checks,
                    stream_checks)
from checks.register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

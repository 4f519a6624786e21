"""Tabular risk scoring on Spark DataFrames, Spark ML and Structured Streaming."""

from riskspark.session import get_session
from riskspark.spec import REGIONAL, JobSpec

__all__ = ["JobSpec", "REGIONAL", "get_session"]

"""Importing this module registers every query."""

from tabloom.plans import evaluate_queries, model_queries, prepare_queries, profile_queries  # noqa: F401
from tabloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

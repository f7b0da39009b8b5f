"""Registered queries. Importing this package fills the two dictionaries."""

from duebook.plans.registry import ORACLES, QUERIES
from duebook.plans import clock, corpus, events, lines, matching, publish, scalars, segments, state, typeset  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]

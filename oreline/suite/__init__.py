"""Queries over the driver tables, each with the SQL that gives the same rows."""

from oreline.suite import (  # noqa: F401  (imported for their registrations)
    analytics,
    dimensions,
    facts,
    jobs,
    lake,
    quality,
    streams,
    transforms,
)
from oreline.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

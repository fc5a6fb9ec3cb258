"""Registered queries."""

from millrace.plans import limits, quality, relational, retrieval, sources, streams, timeseries, versioned  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES  # noqa: F401

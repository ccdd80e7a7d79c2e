"""The registered queries, each next to the SQL it must agree with."""

from millrace.plans.catalog import features, ingest, models, quality, service, streams  # noqa: F401
from millrace.plans.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]

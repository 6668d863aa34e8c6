"""All queries on the driver's tables, by name, with their DuckDB equivalents."""

from __future__ import annotations

from millrace.plans import assessments, captions, clusters, evaluations, filters, images, intake, lookups, poses, relations, reports, samples, selections, streams, timelines, vectors
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "assessments", "captions", "clusters", "evaluations", "filters", "images", "intake", "lookups", "poses", "relations", "reports", "samples", "selections", "streams", "timelines", "vectors"]

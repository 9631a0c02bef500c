"""The operators applied to the test tables, and the same results in SQL."""

from __future__ import annotations

from tidemark.workload import clusters, ingest, retention, rosters, segments

_PARTS = (retention, ingest, rosters, clusters, segments)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}

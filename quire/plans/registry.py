"""All queries over the driver's tables, and the DuckDB SQL with the same rows."""

from __future__ import annotations

from quire.plans import documents, records, streams

QUERIES: dict = documents.QUERIES | records.QUERIES | streams.QUERIES
SQL: dict[str, str] = documents.SQL | records.SQL | streams.SQL

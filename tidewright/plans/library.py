"""All queries of the library."""

from __future__ import annotations

from tidewright.plans import messages, registry

QUERIES = {**registry.QUERIES, **messages.QUERIES}
ORACLE_SQL = {**registry.ORACLE_SQL, **messages.ORACLE_SQL}

"""All queries of the library, with the SQL that says what each returns."""

from __future__ import annotations

from . import kernel_queries, match_queries, search_queries, table_queries, text_queries, verdict_queries  # noqa: F401  importing a module registers its queries
from ._register import ORACLE_SQL, QUERIES

FLAGSHIP = "m1_loose_score"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]

"""Every registered query: the Spark plan and, where SQL can state it, its equivalent.

The queries run the operators over the given tables.  Missing values, sentinels and other
defects that the clean tables lack are derived from their columns, for every row alike.
"""

from __future__ import annotations

from tidemark.queries import (  # noqa: F401  (importing a module registers its queries)
    cleaning,
    documents,
    duplicates,
    numbers,
    profiles,
    text,
    typing,
)
from tidemark.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]

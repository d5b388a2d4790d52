"""Every operator as a named query over the given tables, with the SQL that must agree with it."""

from catalogue.registry import QUERIES, oracle_sql
from catalogue import (  # noqa: F401  (each module adds its queries)
    corpus,
    fetching,
    files,
    frontier,
    language,
    links,
    pages,
    robots,
    seeds,
    text,
)

__all__ = ["QUERIES", "oracle_sql"]

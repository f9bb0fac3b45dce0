"""The query catalogue: every job wired to the test tables, with the SQL it must agree with."""

from telemetra.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]

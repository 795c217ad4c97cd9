"""All oracle SQL by query name."""

from __future__ import annotations

from . import inventory_sql, lake_sql, report_sql

ORACLE: dict[str, str] = {**report_sql.SQL, **inventory_sql.SQL, **lake_sql.SQL}

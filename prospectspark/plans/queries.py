"""All queries on the company data and the SQL that gives the same rows."""

from __future__ import annotations

from . import advertisements, files, imports, matching, outreach_queries, pages, scalars, scores

MODULES = (files, scalars, imports, advertisements, matching, scores, outreach_queries, pages)
QUERIES = {name: f for m in MODULES for name, f in m.R.queries.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.R.sql.items()}

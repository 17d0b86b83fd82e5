"""Queries by name, and the SQL that must give the same rows."""

from __future__ import annotations

from lexalign.plans import alignment, cleaning, files, fixtures, progress, repairs, roles, texts

MODULES = (texts, alignment, progress, roles, fixtures, cleaning, repairs, files)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: s for m in MODULES for name, s in m.SQL.items()}

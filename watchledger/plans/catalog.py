"""All registered queries."""

from __future__ import annotations

from watchledger.plans import boards, reports, scoring

CATALOG = [*reports.QUERIES, *scoring.QUERIES, *boards.QUERIES]

_names = [q.name for q in CATALOG]
assert len(_names) == len(set(_names)), "query names must be unique"

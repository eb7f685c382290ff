"""The registered queries of the news engine and their oracles."""

from __future__ import annotations

from inkwell.plans import calendar, documents, fields, files, history, pages, reruns, runs, scoring

_PARTS = (documents, pages, calendar, history, scoring, runs, files, fields, reruns)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}

"""All queries of the engine's own operators, with their SQL oracles."""

from __future__ import annotations

from factloom.plans import facts, flows, flows_sql, headlines, panels, sheets, stacked, texts, texts_sql

FLAGSHIP = "sum_check_national"
QUERIES: dict = {**facts.QUERIES, **texts.QUERIES, **flows.QUERIES, **headlines.QUERIES, **panels.QUERIES, **sheets.QUERIES, **stacked.QUERIES}
ORACLES: dict = {**facts.ORACLES, **texts_sql.ORACLES, **flows_sql.ORACLES, **headlines.ORACLES, **panels.ORACLES, **sheets.ORACLES, **stacked.ORACLES}

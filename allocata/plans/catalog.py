"""All queries of the core, by name, with their SQL where SQL can express them."""

from __future__ import annotations

from allocata.plans import data_quality, metrics, minutes, pages, parsing, registry, state, text

FLAGSHIP = "fund_summary"
MODULES = (metrics, minutes, pages, parsing, registry, state, text, data_quality)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: q for m in MODULES for k, q in m.ORACLE.items()}

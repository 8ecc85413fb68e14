"""All registered queries of the library proper."""

from __future__ import annotations

from cairn.plans import audits, catalog, discoveries, evidence, fields, geo, matching, relational, sources, stages, web
from cairn.plans.registry import Run

_PARTS = (relational.R, matching.R, evidence.R, fields.R, catalog.R, geo.R, web.R, discoveries.R, stages.R, audits.R, sources.R)


def runs() -> dict[str, Run]:
    return {name: run for part in _PARTS for name, run in part.runs.items()}


def sql() -> dict[str, str]:
    return {name: text for part in _PARTS for name, text in part.sql.items()}

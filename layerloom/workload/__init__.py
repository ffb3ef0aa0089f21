"""The registered queries, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from layerloom.workload import casting, catalogs, histories, landed, landings, monitors, raws, references, streams
from layerloom.workload.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "casting",
    "catalogs",
    "histories",
    "landed",
    "landings",
    "monitors",
    "raws",
    "references",
    "streams",
]

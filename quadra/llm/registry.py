"""Registered queries of this subpackage."""

from __future__ import annotations

from quadra.llm import op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13

MODULES = [op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in MODULES for k, s in m.SQL.items()}

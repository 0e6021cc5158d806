"""DuckDB oracle texts: an independent, hand-written SQL statement per query.

The driver registers the parquet tables as views; these statements run
against them. Shared CTEs (the adapter spelled in SQL) live in ``common``.
"""

from __future__ import annotations


def load_all() -> dict[str, str]:
    from vitals.oracle import marts, rules_o, sources_o, stage_o, warehouse_o, quality_o, model_o, landing_o
    out: dict[str, str] = {}
    for m in (marts, rules_o, sources_o, stage_o, warehouse_o, quality_o, model_o, landing_o):
        out.update(m.ORACLE)
    return out

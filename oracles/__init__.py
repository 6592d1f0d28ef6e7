"""SQL of every job, written apart from the DataFrame code, for DuckDB.

Percents use the same exact rounding as the engine (halves up on whole
numbers); everything else is stated in SQL terms of its own.
"""

from __future__ import annotations


def all_queries() -> dict[str, str]:
    from oracles import audits, customers, emails, records, weekly

    out: dict[str, str] = {}
    for module in (customers, audits, records, emails, weekly):
        out.update(module.queries())
    return out

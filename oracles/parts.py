"""Text pieces shared by the oracles."""

from __future__ import annotations

import re

from recordlens import constants as K
from recordlens.sources import fixtures as fx


def query(views: str, steps: list[tuple[str, str]], body: str) -> str:
    """WITH the named fixture views and steps."""
    parts = [f"{v} AS ({fx.view_sql(v)})" for v in views.split()]
    parts += [f"{name} AS ({sql})" for name, sql in steps]
    return f"WITH {', '.join(parts)} {body}"


def pct(part: str, whole: str) -> str:
    return (
        f"CASE WHEN ({whole}) <> 0 THEN CAST((CAST({part} AS BIGINT) * 20000 + CAST({whole} AS BIGINT))"
        f" // (CAST({whole} AS BIGINT) * 2) AS DOUBLE) / 100 END"
    )


def signed_pct(part: str, whole: str) -> str:
    return f"{pct(f'abs({part})', whole)} * sign({part})"


def mean_pct(column: str, digits: int = 2) -> str:
    step = 10 ** (2 - digits)
    total = f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS BIGINT)"
    return (
        f"CASE WHEN count({column}) > 0 THEN CAST(({total} * 2 + count({column}) * {step})"
        f" // (count({column}) * {2 * step}) AS DOUBLE) / {10 ** digits} END"
    )


def words(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def any_of(values) -> str:
    return "(" + "|".join(re.escape(v).replace("\\-", "-") for v in values) + ")"


AUDIT_MARKETS = words(K.AUDIT_MARKETS)
EMAIL_MARKETS = words(K.EMAIL_MARKETS)

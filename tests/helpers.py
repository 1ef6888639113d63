from __future__ import annotations

from datetime import date


def rows(df, *order):
    """Rows as sorted tuples (NULLs last)."""
    found = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(found, key=lambda r: [(x is None, str(type(x)), x if x is not None else 0) for x in r])


def d(text: str) -> date:
    return date.fromisoformat(text)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

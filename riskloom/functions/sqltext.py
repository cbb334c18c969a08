"""Small pieces of SQL text.

Projections over hundreds of columns are given to Spark as SQL text: one call for all of
them, where building Column objects one by one takes seconds on the driver.
"""

from __future__ import annotations

import math

INFINITE = "double('Infinity')"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float | None) -> str:
    """A double literal that keeps every bit."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    value = float(value)
    if math.isinf(value):
        return INFINITE if value > 0 else f"-{INFINITE}"
    return f"{value!r}D" if "e" not in repr(value) else f"double('{value!r}')"


def literal(value) -> str:
    """A literal of a text, a truth value, a whole number or a double; None is NULL."""
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int)):
        return str(value)
    return number(value) if isinstance(value, float) else text(str(value))


def finite(c: str) -> str:
    return f"CASE WHEN NOT isnan({c}) AND abs({c}) <> {INFINITE} THEN {c} END"


def as_double(name: str, alias: str | None = None) -> str:
    return f"CAST({quoted(name)} AS DOUBLE) AS {quoted(alias or name)}"

"""SQL text for expressions with many constants.

One parsed text builds faster from Python than hundreds of Column calls.
"""

from __future__ import annotations

import math


def number(value: float | int | None) -> str:
    """A DOUBLE constant."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    value = float(value)
    if math.isnan(value):
        return "double('NaN')"
    if math.isinf(value):
        return "double('Infinity')" if value > 0 else "double('-Infinity')"
    return f"{value!r}D"


def text(value: str) -> str:
    """A STRING constant."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def per_feature(values: dict[str, str], default: str = "NULL") -> str:
    """Choose an expression by the row's feature."""
    if not values:
        return default
    whens = " ".join(f"WHEN {text(f)} THEN {v}" for f, v in values.items())
    return f"CASE feature {whens} ELSE {default} END"

"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The spellings a binary label may take.
POSITIVE_LABELS = ("yes", "1", "1.0", "true")
NEGATIVE_LABELS = ("no", "0", "0.0", "false")

# The text forms that count as a number, an integer, a boolean, a timestamp.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)\s*$"
NAMED_NUMBER_PATTERN = r"(?i)^\s*([+-]?(inf|infinity)|nan)\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
BOOLEAN_PATTERN = r"^(true|false|True|False)$"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"


def nan_to_null(column: Column, dtype: T.DataType) -> Column:
    """NULL and NaN both mean "missing"; later steps only test for NULL."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    return column


def as_double(column: Column, dtype: T.DataType) -> Column:
    """A numeric column as DOUBLE with missing values as NULL."""
    return nan_to_null(column, dtype).cast("double")


def round_even(column: Column, digits: int) -> Column:
    """Round half to even, the rule of numeric Python libraries."""
    return F.bround(column, digits)


def clip(column: Column, lower=None, upper=None) -> Column:
    """Limit to a range. least/greatest skip NULL, so NULL is kept explicitly."""
    out = column
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(column.isNotNull(), out)


def label_flag(column: Column) -> Column:
    """Binary label: yes/1/true -> 1, no/0/false -> 0, anything else NULL."""
    text = F.lower(F.trim(column.cast("string")))
    return F.when(text.isin(*POSITIVE_LABELS), 1).when(text.isin(*NEGATIVE_LABELS), 0)


def parse_number(column: Column) -> Column:
    """Text to DOUBLE, NULL when it is no number. 'nan' gives NaN, which is missing but no failure.

    A bare try_cast would accept '1d' and '1f', hence the patterns first.
    """
    fits = column.rlike(NUMBER_PATTERN) | column.rlike(NAMED_NUMBER_PATTERN)
    return F.when(fits, F.trim(column).try_cast("double"))


def lexical_class(column: Column) -> Column:
    """What a text value looks like: int, float, bool, timestamp or str (NULL stays NULL)."""
    return (
        F.when(column.rlike(INTEGER_PATTERN), "int")
        .when(column.rlike(NUMBER_PATTERN), "float")
        .when(column.rlike(BOOLEAN_PATTERN), "bool")
        .when(column.rlike(TIMESTAMP_PATTERN), "timestamp")
        .when(column.isNotNull(), "str")
    )


def hash_hex(*columns: Column, seed: str | int = "") -> Column:
    """md5 of the key text followed by the seed: a repeatable random order.

    It depends on the key only, never on the partitioning, so a retried task
    draws the same value again.
    """
    parts = [c.cast("string") for c in columns] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def hash_uniform(*columns: Column, seed: str | int = "") -> Column:
    """Uniform draw in [0, 1) from the first 32 bits of the key's md5."""
    word = F.conv(F.substring(hash_hex(*columns, seed=seed), 1, 8), 16, 10)
    return word.cast("bigint") / F.lit(4294967296.0)


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL when bottom is 0."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def weighted_choice(draw: Column, choices: dict) -> Column:
    """Map a uniform draw onto values with the given weights."""
    weights = list(choices.items())
    total = float(sum(w for _, w in weights))
    edge, out = 0.0, None
    for value, weight in weights[:-1]:
        edge += weight / total
        hit = draw < F.lit(edge)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    last = F.lit(weights[-1][0])
    return last if out is None else out.otherwise(last)

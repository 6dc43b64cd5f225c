"""Reading delimited text without declared types: classes of cells, a type per column, and the rows that do not fit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.sqltext import name

#: Cell texts that stand for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)
#: Lexical classes. A column's type is the least one that holds all classes of its cells: whole numbers are
#: numbers, everything is text, and no other class holds another.
BOOLEAN, WHOLE, NUMBER, TIME, TEXT = 1, 2, 4, 8, 16
TYPES = {BOOLEAN: T.BooleanType(), WHOLE: T.LongType(), NUMBER: T.DoubleType(), TIME: T.TimestampNTZType(), TEXT: T.StringType()}
HOLDS = {BOOLEAN: BOOLEAN, WHOLE: WHOLE, NUMBER: WHOLE | NUMBER, TIME: TIME, TEXT: BOOLEAN | WHOLE | NUMBER | TIME | TEXT}
#: The column that the reader fills with a line of too few or too many cells.
MALFORMED = "_malformed"

_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?)?$"


def cell_class(cell: Column) -> Column:
    """The class of a text cell as one bit; 0 for a missing value."""
    text = F.trim(cell)
    return (
        F.when(cell.isNull() | text.isin(*MISSING), 0)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .when(text.rlike(_WHOLE) & text.try_cast("bigint").isNotNull(), WHOLE)
        .when(text.rlike(_NUMBER), NUMBER)
        .when(text.rlike(_TIME) & text.try_cast("timestamp_ntz").isNotNull(), TIME)
        .otherwise(TEXT)
    )


def least_type(classes: int) -> int:
    """The least type that holds all classes; a column without values is text."""
    return next((kind for kind, held in HOLDS.items() if classes and classes & ~held == 0), TEXT)


@dataclass(frozen=True)
class InferredTable:
    """Rows that fit the types, and the rows that do not with their reasons."""

    kinds: dict[str, int]
    rows: DataFrame
    rejected: DataFrame

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, TYPES[kind]) for c, kind in self.kinds.items()])


def read_cells(spark: SparkSession, path: str, names: Sequence[str] | None = None, **options: object) -> DataFrame:
    """All columns as text, and MALFORMED with the lines of too few or too many cells.

    The names come from the header line of the files, or are given for files without one.
    """
    found = list(names) if names is not None else spark.read.options(**options).csv(path, header=True).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*found, MALFORMED]])
    # Without all columns the parser would not count a line's cells.
    reader = spark.read.options(**options).option("columnPruning", False)
    return reader.csv(path, schema=schema, header=names is None, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED)


def _whole_lines(cells: DataFrame) -> Column:
    """Spark refuses queries that ask for the malformed lines alone, so the first cell is asked for too."""
    if MALFORMED not in cells.columns:
        return F.lit(True)
    return F.col(MALFORMED).isNull() & (F.coalesce(F.col(name(cells.columns[0])), F.lit("")) >= "")


def _columns(cells: DataFrame) -> list[str]:
    return [c for c in cells.columns if c != MALFORMED]


def column_classes(cells: DataFrame) -> dict[str, int]:
    """The classes that each column holds, as bits, from one scan: a bitwise OR per column, merged task by task."""
    names = _columns(cells)
    found = cells.filter(_whole_lines(cells)).agg(*[F.bit_or(cell_class(F.col(name(c)))).alias(f"c{i}") for i, c in enumerate(names)]).first()
    return {c: found[i] or 0 for i, c in enumerate(names)}


def class_counts(cells: DataFrame, names: Sequence[str]) -> dict[str, dict[int, int]]:
    """How many cells of each class the named columns hold."""
    counts = [F.count_if(cell_class(F.col(name(c))) == bit).alias(f"c{i}_{bit}") for i, c in enumerate(names) for bit in TYPES]
    found = cells.filter(_whole_lines(cells)).agg(*counts).first() if names else None
    return {c: {bit: found[f"c{i}_{bit}"] for bit in TYPES} for i, c in enumerate(names)}


def infer(cells: DataFrame, tolerance: float = 0.0) -> dict[str, int]:
    """A type per column: the least one that leaves out no more than tolerance of the column's values.

    With no tolerance the types follow from one scan. Else the columns that hold
    several classes are counted in a second one. Only class bits and counts, a few
    per column, reach the driver.
    """
    classes = column_classes(cells)
    kinds = {c: least_type(bits) for c, bits in classes.items()}
    mixed = [c for c, bits in classes.items() if kinds[c] == TEXT and bits & ~TEXT] if tolerance > 0 else []
    for c, counts in class_counts(cells, mixed).items():
        total = sum(counts.values())
        fits = [kind for kind, held in HOLDS.items() if sum(n for bit, n in counts.items() if not bit & held) <= tolerance * total]
        kinds[c] = fits[0]
    return kinds


def split(cells: DataFrame, kinds: dict[str, int]) -> InferredTable:
    """cells cast to the types of kinds, which may come from another table of the same columns.

    A row with a cell that its type does not hold, or a line with too few or too
    many cells, goes to rejected with all its reasons; no cell becomes null without
    notice. rejected has the cells as text in the struct `cells`, the malformed line, and reasons.
    """
    names = _columns(cells)
    missing = [c for c in names if c not in kinds]
    if missing:
        raise ValueError(f"no type for {', '.join(missing)}")
    values, reasons = [], []
    for c in names:
        cell, text, kind = F.col(name(c)), F.trim(F.col(name(c))), kinds[c]
        bit = cell_class(cell)
        kept = cell if kind == TEXT else text
        values.append(F.when(bit != 0, kept.try_cast(TYPES[kind])).alias(c))
        if kind != TEXT:
            wrong = (bit.bitwiseAND(F.lit(HOLDS[kind])) == 0) & (bit != 0)
            reasons.append(F.when(wrong, F.concat(F.lit(f"{c} is no {TYPES[kind].simpleString()}: "), cell)))
    whole = _whole_lines(cells)
    line = F.col(MALFORMED) if MALFORMED in cells.columns else F.lit(None).cast("string")
    found = F.filter(F.array(F.when(~whole, F.lit("wrong number of cells")), *[F.when(whole, r) for r in reasons]), lambda r: r.isNotNull())
    held = F.struct(*[F.col(name(c)) for c in names])
    # The struct keeps names of the table and of the reasons apart.
    judged = cells.select(held.alias("cells"), line.alias("line"), found.alias("reasons"), F.struct(*values).alias("row"))
    return InferredTable(dict(kinds), judged.filter(F.size("reasons") == 0).select("row.*"), judged.filter(F.size("reasons") > 0).drop("row"))


def read_inferred(spark: SparkSession, path: str, names: Sequence[str] | None = None, tolerance: float = 0.0, **options: object) -> InferredTable:
    """A delimited dataset with types found in it: a scan that folds cell classes, then a typed scan.

    Missing values are null in any type. Empty files without names give no columns.
    """
    cells = read_cells(spark, path, names, **options)
    return split(cells, infer(cells, tolerance))

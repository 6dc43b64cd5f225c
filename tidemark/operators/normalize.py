"""Column-type normalization and cross-table consistency.

Spark columns are typed, so "mixed" describes the text values of a string
column: which of int, float, bool, timestamp and str occur in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.scalars import as_double, lexical_class, nan_to_null, parse_number
from tidemark.operators.drift import as_text

CATEGORICAL_NA = "missing"
NUMERIC_STRATEGIES = ("keep", "zero", "mean")

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _class_of(df: DataFrame, column: str) -> Column:
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return lexical_class(F.col(column))
    present = nan_to_null(F.col(column), dtype)
    if isinstance(dtype, _INTEGRAL):
        name = "int"
    elif isinstance(dtype, T.NumericType):
        name = "float"
    elif isinstance(dtype, T.BooleanType):
        name = "bool"
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        name = "timestamp"
    else:
        name = dtype.typeName()
    return F.when(present.isNotNull(), name)


def _classes_of(df: DataFrame, column: str) -> tuple[str, ...]:
    """The classes that values of a column can have."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return ("int", "float", "bool", "timestamp", "str")
    if isinstance(dtype, T.NumericType):
        return ("int" if isinstance(dtype, _INTEGRAL) else "float",)
    if isinstance(dtype, T.BooleanType):
        return ("bool",)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return ("timestamp",)
    return (dtype.typeName(),)


def _tallied(cells: DataFrame, tallies: Sequence[Column]) -> DataFrame:
    """One row per struct of aggregates: a single aggregate row is unpivoted, so no cell of the table is ever a row."""
    if not tallies:
        raise ValueError("no columns to describe")
    return cells.agg(F.array(*tallies).alias("t")).select(F.explode("t").alias("t")).select("t.*")


def value_classes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, class, n): how many values of each class every column holds."""
    columns = list(df.columns if columns is None else columns)
    cells = df.select(*[_class_of(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    tallies = [
        F.struct(F.lit(c).alias("column"), F.lit(k).alias("class"), F.count_if(F.col(f"c{i}") == k).alias("n"))
        for i, c in enumerate(columns) for k in _classes_of(df, c)
    ]
    return _tallied(cells, tallies).filter("n > 0")


def detect_mixed_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns that hold more than one value class, with the classes found."""
    found = value_classes(df, columns).groupBy("column").agg(F.array_sort(F.collect_set("class")).alias("classes"))
    return found.filter(F.size("classes") > 1)


def categorical_column(column: Column, dtype: T.DataType, na_value: str | None = None) -> Column:
    """Text form of a column; missing stays NULL unless a value is given."""
    text = as_text(column, dtype)
    return text if na_value is None else F.coalesce(text, F.lit(na_value))


def numeric_column(column: Column, dtype: T.DataType) -> Column:
    """DOUBLE form of a column; text that is no number becomes NULL."""
    if isinstance(dtype, T.StringType):
        return nan_to_null(parse_number(column), T.DoubleType())
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return as_double(column, dtype)
    return F.lit(None).cast("double")


def column_types(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """(categorical, numeric): text columns whose every value parses count as numeric.

    One aggregate returns a single row with a flag per text column.
    """
    columns = list(df.columns if columns is None else columns)
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    bad = {}
    if texts:
        misses = [F.count_if(F.col(c).isNotNull() & parse_number(F.col(c)).isNull()).alias(c) for c in texts]
        bad = df.agg(*misses).first().asDict()
    numeric = [
        c for c in columns
        if isinstance(df.schema[c].dataType, T.NumericType) or (c in bad and bad[c] == 0)
    ]
    return [c for c in columns if c not in numeric], numeric


def column_type_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The same classification as a table: column, kind, values, values that do not parse."""
    columns = list(df.columns if columns is None else columns)
    tallies = []
    for c in columns:
        dtype = df.schema[c].dataType
        present = nan_to_null(F.col(c), dtype).isNotNull()
        text, number = isinstance(dtype, T.StringType), isinstance(dtype, T.NumericType)
        fails = present & parse_number(F.col(c)).isNull() if text else present & F.lit(not number)
        unparsed = F.count_if(fails)
        kind = F.when(unparsed == 0, "numeric").otherwise("categorical") if text else F.lit("numeric" if number else "categorical")
        tallies.append(F.struct(F.lit(c).alias("column"), kind.alias("kind"), F.count_if(present).alias("n_values"), unparsed.alias("n_unparsed")))
    return _tallied(df, tallies)


def fill_numeric(df: DataFrame, columns: Sequence[str], strategy: str) -> DataFrame:
    """Missing numbers: keep, zero, or the column mean (one aggregate for all columns)."""
    if strategy not in NUMERIC_STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}, use one of {NUMERIC_STRATEGIES}")
    columns = list(columns)
    if strategy == "keep" or not columns:
        return df
    if strategy == "zero":
        return df.fillna(0, subset=columns)
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("means")).scalar()
    return df.withColumn("_means", means).select(
        *[F.coalesce(F.col(c), F.col(f"_means.{c}")).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def normalize_frame(
    df: DataFrame, categorical: Sequence[str] | None = None, numeric: Sequence[str] | None = None,
    exclude: Sequence[str] = (), na_value: str | None = None, strategy: str = "keep",
) -> DataFrame:
    """Bring every column to text or number. None means detect, [] means none.

    Whole numbers keep BIGINT; everything else numeric becomes DOUBLE.
    """
    if categorical is None or numeric is None:
        detected_cat, detected_num = column_types(df, [c for c in df.columns if c not in exclude])
        categorical = detected_cat if categorical is None else categorical
        numeric = detected_num if numeric is None else numeric
        # A column named in one list is not detected into the other.
        numeric = [c for c in numeric if c not in categorical or c not in detected_num]
    out = []
    for c in df.columns:
        dtype = df.schema[c].dataType
        if c in exclude:
            out.append(F.col(c))
        elif c in numeric:
            integral = isinstance(dtype, _INTEGRAL)
            out.append(F.col(c).cast("bigint").alias(c) if integral else numeric_column(F.col(c), dtype).alias(c))
        elif c in categorical:
            out.append(categorical_column(F.col(c), dtype, na_value).alias(c))
        else:
            out.append(F.col(c))
    shaped = df.select(*out)
    return fill_numeric(shaped, [c for c in numeric if c in df.columns and c not in exclude], strategy)


def normalize_for_ml(df: DataFrame, target: str | None = None) -> DataFrame:
    return normalize_frame(df, exclude=[target] if target else [])


def consistency_issues(first: DataFrame, second: DataFrame, check_columns: bool = True, check_types: bool = True) -> DataFrame:
    """One row per inconsistency: a column missing on one side, or holding other value classes.

    Types are compared by the classes of the stored values, so '12' in a text
    column and 12 in an integer column agree.
    """
    classes = lambda df, name: value_classes(df).groupBy("column").agg(
        F.concat_ws(",", F.array_sort(F.collect_set("class"))).alias(name)
    )
    names = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(c in first.columns).alias("in1"), F.lit(c in second.columns).alias("in2"))
        for c in sorted(set(first.columns) | set(second.columns))
    ])
    listed = first.sparkSession.range(1).select(F.explode(names).alias("c")).select("c.*")
    # Both class tables hold one row per column of the schema.
    joined = listed.join(F.broadcast(classes(first, "classes1")), "column", "left").join(
        F.broadcast(classes(second, "classes2")), "column", "left"
    )
    issue = F.when(~F.col("in2") & F.lit(check_columns), "missing_in_second").when(
        ~F.col("in1") & F.lit(check_columns), "missing_in_first"
    )
    differs = F.col("in1") & F.col("in2") & ~F.col("classes1").eqNullSafe(F.col("classes2"))
    issue = issue.when(differs & F.lit(check_types), "type_mismatch")
    return joined.withColumn("issue", issue).filter("issue IS NOT NULL").select("column", "issue", "classes1", "classes2")


def normalization_report(original: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """What normalizing does per column: types before and after, values kept, changed and lost."""
    categorical, numeric = column_types(original, [c for c in original.columns if c not in exclude])
    cells, tallies = [], []
    for i, c in enumerate(c for c in original.columns if c not in exclude):
        dtype = original.schema[c].dataType
        present = nan_to_null(F.col(c), dtype).isNotNull()
        integral = isinstance(dtype, _INTEGRAL)
        after = F.col(c) if c in numeric and integral else (
            numeric_column(F.col(c), dtype) if c in numeric else categorical_column(F.col(c), dtype)
        )
        changed = present & after.isNotNull() & (after.cast("string") != F.col(c).cast("string"))
        cells += [present.alias(f"present{i}"), changed.alias(f"changed{i}"), (present & after.isNull()).alias(f"lost{i}"), _class_of(original, c).alias(f"class{i}")]
        new_type = ("bigint" if integral else "double") if c in numeric else "string"
        held = [F.coalesce(F.max((F.col(f"class{i}") == k).cast("int")), F.lit(0)) for k in _classes_of(original, c)]
        tallies.append(F.struct(
            F.lit(c).alias("column"), F.lit(dtype.simpleString()).alias("type_before"), F.lit(new_type).alias("type_after"),
            *[F.count_if(f"{n}{i}").alias(f"n_{m}") for n, m in (("present", "values"), ("changed", "changed"), ("lost", "lost"))],
            (sum(held[1:], held[0]) > 1).alias("was_mixed"),
        ))
    return _tallied(original.select(*cells), tallies).withColumn("type_changed", F.col("type_before") != F.col("type_after"))

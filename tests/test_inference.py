"""Types found in delimited text."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.sources import inference as I
from tidemark.sources.tables import new_path


def lines(spark, rows, parts=1):
    path = new_path(spark, "lines")
    spark.createDataFrame([(r,) for r in rows], "value string").repartition(parts).write.text(path)
    return path


CELLS = [
    (None, 0), ("", 0), ("  ", 0), ("NA", 0), ("null", 0), ("true", I.BOOLEAN), ("FALSE", I.BOOLEAN), ("0", I.WHOLE), ("-12", I.WHOLE), (" 7 ", I.WHOLE),
    ("007", I.WHOLE), ("9223372036854775807", I.WHOLE), ("9223372036854775808", I.NUMBER), ("1.", I.NUMBER), (".5", I.NUMBER), ("-1e-3", I.NUMBER), ("inf", I.NUMBER),
    ("1.2.3", I.TEXT), (".", I.TEXT), ("e5", I.TEXT), ("2024-01-31", I.TIME), ("2024-01-31 10:20:30.5", I.TIME), ("2024-02-31", I.TEXT), ("31.1.2024", I.TEXT),
    ("yes", I.TEXT), ("1_000", I.TEXT), ("1,5", I.TEXT), ("１２", I.TEXT), ("0x1F", I.TEXT),
]


def test_classes(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CELLS)], "i int, c string")
    found = {r["i"]: r["bit"] for r in df.select("i", I.cell_class(F.col("c")).alias("bit")).collect()}
    assert [(c, found[i]) for i, (c, _) in enumerate(CELLS)] == CELLS


def test_joining_is_a_lattice():
    """Order and grouping of the parts do not matter, and the type holds every class."""
    assert I.least_type(0) == I.TEXT
    for bits in range(1, 32):
        kind = I.least_type(bits)
        assert bits & ~I.HOLDS[kind] == 0
        narrower = [k for k, held in I.HOLDS.items() if bits & ~held == 0 and held & ~I.HOLDS[kind] == 0]
        assert narrower == [kind]
    for a, b in itertools.product(range(32), repeat=2):
        assert I.HOLDS[I.least_type(a | b)] & ~I.TEXT | I.TEXT == (I.HOLDS[I.least_type(a | b)] | I.TEXT)


def test_header_and_types(spark):
    path = new_path(spark, "csv")
    df = spark.createDataFrame([(i, i / 4, i % 2 == 0, dt.datetime(2024, 1, 1 + i % 28), None if i % 3 else "a,b", None) for i in range(300)], "i int, x double, b boolean, t timestamp_ntz, s string, empty string")
    df.repartition(4).write.csv(path, header=True)
    found = I.read_inferred(spark, path)
    assert found.rows.dtypes == [("i", "bigint"), ("x", "double"), ("b", "boolean"), ("t", "timestamp_ntz"), ("s", "string"), ("empty", "string")]
    assert found.rows.schema.simpleString() == found.schema.simpleString()
    assert found.rejected.count() == 0 and sorted(found.rows.collect(), key=lambda r: r["i"]) == sorted(df.withColumn("i", F.col("i").cast("bigint")).collect(), key=lambda r: r["i"])


def test_ragged_lines_are_rejected_not_cut(spark):
    path = lines(spark, ["1,a,2", "2,b", "3,c,4,5", "4,,6", "", '"5","x, y",7'], parts=2)
    found = I.read_inferred(spark, path, names=["k", "s", "n"])
    assert {tuple(r) for r in found.rows.collect()} == {(1, "a", 2), (4, None, 6), (5, "x, y", 7)}
    assert {(r["line"], tuple(r["reasons"])) for r in found.rejected.collect()} == {("2,b", ("wrong number of cells",)), ("3,c,4,5", ("wrong number of cells",))}


def test_tolerance_and_all_reasons(spark):
    rows = [f"{i},{i / 2},2024-01-01" for i in range(98)] + ["x,y,2024-01-01", "5,z,soon"]
    path = lines(spark, rows, parts=3)
    strict = I.read_inferred(spark, path, names=["i", "v", "d"])
    assert [t for _, t in strict.rows.dtypes] == ["string"] * 3 and strict.rejected.count() == 0
    found = I.read_inferred(spark, path, names=["i", "v", "d"], tolerance=0.02)
    assert [t for _, t in found.rows.dtypes] == ["bigint", "double", "timestamp_ntz"] and found.rows.count() == 98
    reasons = {tuple(r["cells"]): r["reasons"] for r in found.rejected.collect()}
    assert reasons[("x", "y", "2024-01-01")] == ["i is no bigint: x", "v is no double: y"]
    assert reasons[("5", "z", "soon")] == ["v is no double: z", "d is no timestamp_ntz: soon"]
    assert I.read_inferred(spark, path, names=["i", "v", "d"], tolerance=0.019).rows.dtypes[1][1] == "string"


def test_types_of_one_table_judge_another(spark):
    kinds = I.infer(I.read_cells(spark, lines(spark, ["1,t", "2,u"]), ["a", "b"]))
    later = I.split(I.read_cells(spark, lines(spark, ["3,v", "four,w", "5.5,x", "NA,"]), ["a", "b"]), kinds)
    assert {tuple(r) for r in later.rows.collect()} == {(3, "v"), (None, None)}
    assert sorted(r["reasons"][0] for r in later.rejected.collect()) == ["a is no bigint: 5.5", "a is no bigint: four"]
    with pytest.raises(ValueError):
        I.split(I.read_cells(spark, lines(spark, ["1,2"]), ["a", "c"]), kinds)


def test_wide_file_and_odd_names(spark):
    names = [f"c.{i}" for i in range(398)] + ["cells", "reasons"]
    path = lines(spark, [",".join(str(i + k) if i % 2 else f"{i}.5" for i in range(400)) for k in range(20)], parts=2)
    found = I.read_inferred(spark, path, names=names)
    assert found.rows.columns == names and [t for _, t in found.rows.dtypes] == ["double", "bigint"] * 200
    assert found.rows.count() == 20 and found.rejected.count() == 0


def test_empty(spark):
    found = I.read_inferred(spark, lines(spark, []), names=["a", "b"])
    assert found.rows.dtypes == [("a", "string"), ("b", "string")] and found.rows.count() == 0


def test_one_scan_without_a_tolerance(spark):
    cells = I.read_cells(spark, lines(spark, ["1,a", "2,b"]), ["a", "b"])
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    I.infer(cells)
    after = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert len(set(after) - set(before)) <= 2

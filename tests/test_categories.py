"""Codes of categories: places, unseen ones, many of them, saving."""

import json
from collections import Counter

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import functions as F

from tidemark.operators import categories as C, model as M
from tidemark.sources.tables import new_path


def places(codes, df, column="c"):
    return {r[0]: int(r[1]) for r in codes.transform(df.withColumn("c_text", F.col(column))).select(column, "c_index").collect()}


def test_frequent_categories_come_first_and_unseen_ones_are_zero(spark):
    df = spark.createDataFrame([(c,) for c, n in (("x", 5), ("y", 3), ("z", 2), (None, 4)) for _ in range(n)], "c string")
    codes = C.category_codes(df, ["c"])
    odd = spark.createDataFrame([("x",), ("y",), ("z",), ("never",)], "c string")
    assert places(codes, odd) == {"x": 0, "y": 1, "z": 2, "never": 3}
    encoder = OneHotEncoder(inputCols=["c_index"], outputCols=["v"], handleInvalid="keep", dropLast=True)
    made = Pipeline(stages=[codes, encoder]).fit(df.withColumn("c_text", F.coalesce("c", F.lit("x")))).transform(odd.withColumn("c_text", F.col("c")))
    assert {r["c"]: r["v"].toArray().tolist() for r in made.collect()} == {"x": [1, 0, 0], "y": [0, 1, 0], "z": [0, 0, 1], "never": [0, 0, 0]}


def test_rare_categories_share_buckets_by_hash(spark):
    df = spark.createDataFrame([(f"c{i}",) for i in range(50) for _ in range(51 - i)], "c string")
    codes = C.category_codes(df, ["c"], known=10, hashed=4)
    found = places(codes, df.distinct())
    assert [found[f"c{i}"] for i in range(10)] == list(range(10))
    rest = Counter(found[f"c{i}"] for i in range(10, 50))
    assert set(rest) <= set(range(10, 14)) and len(rest) > 1 and json.loads(codes.getOrDefault(codes.sizes)) == {"c": 14}
    assert places(codes, df.distinct()) == found
    none = C.category_codes(df, ["c"], known=10, hashed=0)
    assert places(none, spark.createDataFrame([("c3",), ("c49",)], "c string")) == {"c3": 3, "c49": 10}


def test_a_million_categories(spark):
    df = spark.range(1_200_000).select(F.concat(F.lit("id"), F.col("id") % 1_000_000).alias("c"))
    codes = C.category_codes(df, ["c"])
    table = spark.read.parquet(codes.getOrDefault(codes.table))
    assert table.count() == 1_000_000 and table.agg(F.max("place")).first()[0] == C.KNOWN + C.HASHED - 1
    assert table.filter(F.col("place") < C.KNOWN).count() == C.KNOWN
    found = places(codes, spark.createDataFrame([("id7",), ("id999999",), ("other",)], "c string"))
    assert found["other"] == C.KNOWN + C.HASHED and C.KNOWN <= found["id999999"] < C.KNOWN + C.HASHED


def test_saved_with_its_table_and_used_on_a_stream(spark):
    rows = [(i, "abc"[i % 3], "Yes" if i % 3 == 0 else "No", float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, kind string, label string, x double")
    model = M.fit_forest(df, "label", ["x"], ["kind"], trees=3, depth=3, tried="all")
    path, inbox, out = (new_path(spark, n) for n in ("model", "inbox", "scored"))
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert f"{path}/" in [s for s in loaded.stages if isinstance(s, C.CategoryCodes)][0].getOrDefault("table")
    odd = df.unionByName(spark.createDataFrame([(900, "unseen", "No", None), (901, None, "No", 2.0)], df.schema))
    want = {r["k"]: r["probability"] for r in M.score(model, odd, ["k"]).collect()}
    assert {r["k"]: r["probability"] for r in M.score(loaded, odd, ["k"]).collect()} == want and want[0] == 1.0 and want[1] == 0.0
    odd.write.parquet(inbox)
    query = M.score(loaded, spark.readStream.schema(df.schema).parquet(inbox), ["k"]).writeStream.format("parquet").option("checkpointLocation", new_path(spark, "cp")).trigger(availableNow=True).start(out)
    query.awaitTermination()
    assert {r["k"]: r["probability"] for r in spark.read.parquet(out).collect()} == want


def test_a_column_without_values(spark):
    df = spark.createDataFrame([(1, None, "Yes"), (2, None, "No")] * 10, "k long, kind string, label string")
    assert M.score(M.fit_forest(df, "label", ["k"], ["kind"], trees=2, depth=2), df, ["k"]).count() == 20


def test_the_training_plan_holds_no_vocabulary(spark):
    df = spark.range(20_000).selectExpr("id", "concat('value-', id) AS kind", "IF(id % 2 = 0, 'Yes', 'No') AS label")
    model = M.fit_forest(df, "label", [], ["kind"], trees=1, depth=1)
    codes = next(s for s in model.stages if isinstance(s, C.CategoryCodes))
    assert len(json.dumps({p.name: str(v) for p, v in codes.extractParamMap().items()})) < 500

import zlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import curriculum, quality, secrets, simhash
from tidemark.llm.text import documents
from tidemark.sources.tables import materialized


def test_stages(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns, kept = docs.columns, {}
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(stage(spark, rows, tiny).collect(), docs.schema)
        assert rows.columns == columns
        kept[name] = rows.collect()
    first, second, third, fourth = kept.values()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{tiny}/labels.parquet").collect()}
    ids = {r.doc_id for r in first}
    assert sum(labels[i].quality == 1 and i not in ids for i in labels) <= 2
    assert {r.doc_id for r in second} <= ids and len({r.doc_id for r in second}) == len(second)
    assert len({r.text for r in second}) == len(second)
    assert {r.doc_id for r in third} == {r.doc_id for r in second}
    assert not any(secrets.matches(r.text) for r in third) and all(r.n_chars == len(r.text) for r in third)
    assert {r.doc_id for r in fourth} <= {r.doc_id for r in third} and max(Counter(r.doc_id for r in fourth).values()) == 2
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, tiny).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in fourth)
    assert corpus_pipeline.run(spark, tiny).count() == len(packed)


def test_empty(spark, tiny):
    rows = spark.read.parquet(f"{tiny}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows, tiny).count() == 0


def test_held_out_is_the_remainder(spark):
    ids = spark.range(500).withColumnRenamed("id", "doc_id")
    found = {r.doc_id for r in ids.filter(quality.held_out()).collect()}
    assert found == {i for i in range(500) if zlib.crc32(str(i).encode()) % 5 == 0}


HELPERS = [
    "quality_score", "simhash_row", "fp", "first", "root", "mix_size", "mix_source", "mix_order", "mix_copies", "mix_position", "mix_slice", "mix_start", "mix_whole",
    "for_source", "for_slice", "shift", "mix_target", "mix_weight", "mix_source_size", "masked", "piece", "start", "length", "rank", "slice", "other_3", "a b.c`d",
]


def test_columns_of_any_name_go_through_every_stage(spark, tiny):
    """Every row keeps its own further columns, called like the helpers of the stages, a map and a null among them."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, 0), (7001, None, None, "src0", 0)], docs.schema)
    docs = docs.unionByName(odd)
    marks = [F.concat_ws("/", F.lit(c), F.col("doc_id").cast("string")).alias(f"x{i}") for i, c in enumerate(HELPERS)]
    rows = docs.select("*", *marks, F.create_map(F.lit("k"), F.col("n_chars")).alias("x_map"), F.lit(None).cast("int").alias("x_null"))
    rows = rows.toDF(*docs.columns, *HELPERS, "map", "null")
    plain = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows, plain = (materialized(stage(spark, df, tiny), "stage") for df in (rows, plain))
        assert rows.columns == [*docs.columns, *HELPERS, "map", "null"]
        safe = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
        for r in safe.collect():
            assert [r[i + 5] for i in range(len(HELPERS))] == [c if r[0] is None else f"{c}/{r[0]}" for c in HELPERS] and set(r[-2]) == {"k"}
        assert Counter(r[0] for r in safe.collect()) == Counter(r.doc_id for r in plain.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, rows, tiny).count() == corpus_pipeline.STAGES[-1][1](spark, plain, tiny).count()


def test_rows_without_a_secret_stay_as_they_are(spark):
    rows = [(1, None, None, None, 0), (2, "", None, None, 9), (3, "no secret", None, None, None), (4, "password=hunter2hunter2", None, None, 7)]
    found = {r.doc_id: (r.text, r.n_chars) for r in secrets.redacted(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert found[1] == (None, 0) and found[2] == ("", 9) and found[3] == ("no secret", None)
    assert "hunter2" not in found[4][0] and found[4][1] == len(found[4][0])


def test_names_in_other_letters(spark):
    """Such a table cannot be written by a session that ignores case, but it can be handed on."""
    docs = spark.createDataFrame([(4, "token=abcdefgh", None, "s", 14, "own", 5)], "doc_id long, text string, lang string, source string, n_chars long, Text string, DOC_ID int")
    for stage in (secrets.redacted, simhash.kept_documents, curriculum.drawn):
        found = stage(docs)
        assert found.columns == docs.columns
        rows = found.toDF(*"abcdefg").collect()
        assert {(r.a, r.f, r.g) for r in rows} == {(4, "own", 5)} and all(r.b for r in rows)
    assert documents(docs).collect() == [(4, "token=abcdefgh")]

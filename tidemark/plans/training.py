"""Train, evaluate on held-out rows, record the run."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.metrics import classification_metrics, classification_report, confusion_counts
from tidemark.operators.model import fit_forest, grid_search, random_rows, score, score_aligned, stratified_split
from tidemark.operators.normalize import normalize_frame
from tidemark.operators.shape import labelled_rows
from tidemark.sources.contract import missing_columns
from tidemark.sources.runs import append_run
from tidemark.sources.sinks import write_predictions
from tidemark.sources.tables import materialized


def evaluate(scored: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(metrics row, classification report) of held-out rows that were scored once."""
    return (
        classification_metrics(scored, [], label, "probability", "prediction"),
        classification_report(scored, label, "prediction"),
    )


def run_record(scored: DataFrame, label: str, dataset: str, params: dict[str, object]) -> DataFrame:
    """One run row in the layout of the run table."""
    metrics, report = evaluate(scored, label)
    counts = confusion_counts(scored, [], label, "prediction")
    row = lambda c: F.max(F.when(F.col("class") == c, F.struct("precision", "recall", "f1_score", "support")))
    classes = report.agg(F.struct(
        row("0").alias("class_0"), row("1").alias("class_1"),
        F.max(F.when(F.col("class") == "accuracy", F.col("precision"))).alias("accuracy"),
    ).alias("r")).scalar()
    matrix = counts.select(F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("m")).scalar()
    pairs = [F.lit(str(x)) for item in params.items() for x in item]
    return metrics.select(
        F.lit(uuid.uuid4().hex).alias("run_id"), F.lit(dataset).alias("dataset_version"),
        F.lit(datetime.datetime.now(datetime.timezone.utc).isoformat()).cast("timestamp").alias("timestamp"),
        "roc_auc", classes.alias("r"), matrix.alias("confusion_matrix"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("best_params"),
    ).select("run_id", "dataset_version", "timestamp", "roc_auc", "r.*", "confusion_matrix", "best_params")


def random_split_evaluation(
    df: DataFrame, label: str, key: str, numeric: Sequence[str], categorical: Sequence[str],
    trees: int = 100, depth: int = 10, tried: str = "auto",
) -> tuple[DataFrame, PipelineModel]:
    """(scored held-out rows, model): stratified 80/20 split, one forest."""
    train, test = stratified_split(df, label, key)
    model = fit_forest(train, label, numeric, categorical, trees, depth, tried=tried)
    return materialized(score(model, test, [key, label]), "held-out"), model


def train_and_record(
    df: DataFrame, label: str, key: str, numeric: Sequence[str], categorical: Sequence[str], *,
    dataset: str, runs_path: str, model_path: str | None = None, grid: dict[str, list] | None = None, folds: int = 3,
) -> DataFrame:
    """The training job: clean labels, normalize, split, search, evaluate, save model and run."""
    rows = labelled_rows(df.select(key, label, *numeric, *categorical), label)
    rows = normalize_frame(rows, categorical, numeric, exclude=[key, label])
    train, test = stratified_split(rows, label, key)
    found = grid_search(train, label, key, numeric, categorical, grid, folds)
    if model_path:
        found.model.write().overwrite().save(model_path)
    scored = materialized(score(found.model, test, [key, label]), "held-out")
    record = run_record(scored, label, dataset, found.params)
    append_run(record, runs_path)
    return scored


def batch_inference(
    model: PipelineModel, rows: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], path: str, *,
    required: Sequence[str] | None = None, sample: int | None = None, seed: str | int = "",
) -> DataFrame:
    """The scoring job: check the columns, sample if asked, score, overwrite the prediction table, and read it back.

    A table that lacks a required column (by default the key and all features) is refused.
    """
    lacking = missing_columns(rows, [key, *numeric, *categorical] if required is None else required)
    if lacking:
        raise ValueError(f"required columns are missing: {', '.join(lacking)}")
    if sample is not None:
        rows = random_rows(rows, sample, key, seed=seed)
    write_predictions(score_aligned(model, rows, key, numeric, categorical), key, path, "parquet")
    return rows.sparkSession.read.parquet(path)

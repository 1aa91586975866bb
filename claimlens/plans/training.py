"""Training flow: raw claims in; compared models, lift and segment tables out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.functions.features import existing, feature_columns, numeric_columns, training_frame
from claimlens.functions.names import clean_headers
from claimlens.operators.contracts import check_features
from claimlens.operators.evaluation import lift_table
from claimlens.operators.model import Trained, best_of, fit_and_score, load_model, metrics_table, model_equivalence, save_model
from claimlens.operators.ranking import tile, time_split
from claimlens.operators.reports import segment_table
from claimlens.session import run_folder
from claimlens.sources.tables import create_schema, overwrite, write_and_read


@dataclass(frozen=True)
class TrainingResult:
    trained: list[Trained]
    best: Trained
    train: DataFrame
    test: DataFrame
    metrics: DataFrame
    scored: DataFrame
    lift: DataFrame
    segments: DataFrame


def split_frame(raw: DataFrame, key: str = C.KEY) -> DataFrame:
    """Cleaned, labelled, featured rows tagged TRAIN or TEST, stored once.

    The stored table is what every later pass (fits, evaluation, ranks) reads. The tag is a literal
    comparison on two of its columns, so it costs no shuffle when a side is read.
    """
    frame = training_frame(clean_headers(raw))
    numeric = numeric_columns(frame, feature_columns(frame, key))
    check_features(numeric)
    order = "Fecha_Apertura" if "Fecha_Apertura" in frame.columns else "FSINIESTRO"
    spark = raw.sparkSession
    stored = write_and_read(frame, run_folder(spark, "training"))
    return time_split(stored, order, key, C.TRAIN_SHARE)


def train(raw: DataFrame, key: str = C.KEY, names: list[str] | None = None, model_path: str | None = None) -> TrainingResult:
    """Fit and compare the classifiers, score the test rows with the best, rank them in deciles.

    With ``model_path`` the best model is saved, loaded again and must reproduce its own scores.
    """
    spark = raw.sparkSession
    tagged = split_frame(raw, key)
    train_rows = tagged.filter("tramo = 'TRAIN'").drop("tramo")
    test_rows = tagged.filter("tramo = 'TEST'").drop("tramo")
    trained, by_all = fit_and_score(train_rows, test_rows, test_rows.columns, names=names, key=key)
    best = best_of(trained)
    own = [F.col(f"prediction_{best.name}").alias("prediction"), F.col(f"score_{best.name}").alias("score_fraude")]
    scored = by_all.select(*test_rows.columns, *own)
    if model_path is not None:
        save_model(best.model, model_path)
        doubles = {f: F.col(f).cast("double") for f in C.FEATURES}
        model_equivalence(best.model, load_model(model_path), test_rows.withColumns(doubles), key)
    tiled = tile(scored, "score_fraude", key)
    return TrainingResult(
        trained, best, train_rows, test_rows, metrics_table(spark, trained), tiled, lift_table(tiled), segment_table(tiled)
    )


def save_results(result: TrainingResult, schema: str) -> list[str]:
    """Overwrite the metrics, lift and scored-test tables of a schema; returns their names."""
    spark = result.scored.sparkSession
    create_schema(spark, schema)
    tables = {
        f"{schema}.fraude_model_metrics": result.metrics,
        f"{schema}.fraude_decile_lift": result.lift,
        f"{schema}.fraude_scored_test": existing(result.scored, C.SCORED_TEST_COLUMNS),
    }
    for name, df in tables.items():
        overwrite(df, name)
    return list(tables)

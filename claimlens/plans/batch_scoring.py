"""Incremental batch scoring: new claims in, published scores and an audit row out."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens import config as C
from claimlens.functions.features import scoring_frame, unreadable_dates
from claimlens.functions.scoring import score_rows
from claimlens.operators.contracts import check_features, check_input_columns
from claimlens.operators.merge import new_rows
from claimlens.operators.profile import key_facts, missing_profile, verify_batch
from claimlens.operators.reports import risk_summary
from claimlens.sources.tables import append, drop_partition, replace_partitions, table_or_empty

SCORE_SCHEMA = T.StructType(
    [
        T.StructField(C.KEY, T.StringType()),
        T.StructField("score_fraude", T.DoubleType()),
        T.StructField("nivel_riesgo", T.StringType()),
        T.StructField("accion_sugerida", T.StringType()),
        T.StructField("fecha_scoring", T.TimestampType()),
        T.StructField("version_modelo", T.StringType()),
        T.StructField("id_ejecucion", T.StringType()),
        T.StructField("modo_scoring", T.StringType()),
        T.StructField("estado_scoring", T.StringType()),
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("id_ejecucion", T.StringType(), False),
        T.StructField("fecha_inicio", T.TimestampType(), False),
        T.StructField("fecha_fin", T.TimestampType()),
        T.StructField("version_modelo", T.StringType(), False),
        T.StructField("modo_scoring", T.StringType(), False),
        T.StructField("registros_entrada", T.LongType()),
        T.StructField("registros_exitosos", T.LongType()),
        T.StructField("registros_error", T.LongType()),
        T.StructField("duracion_segundos", T.DoubleType()),
        T.StructField("estado", T.StringType(), False),
        T.StructField("mensaje_error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class ScoringTables:
    """Names of the tables of the flow.

    Scores are partitioned by model version and run, so the incremental read and the publication
    check prune to the partitions they need. Stage and audit are partitioned by run.
    """

    scores: str = "scores_reclamaciones"
    stage: str = "scoring_stage"
    runs: str = "scoring_runs"
    location: str | None = None


@dataclass(frozen=True)
class RunResult:
    run_id: str
    state: str
    received: int
    published: int
    message: str | None = None


def unscored(source: DataFrame, scores: DataFrame, model_version: str) -> DataFrame:
    """Claims that this model version has not scored. A new version scores all again; claims
    without a key stay and are caught by the key check."""
    done = scores.filter(F.col("version_modelo") == model_version).select(C.KEY)
    return source.join(done, C.KEY, "left_anti")


def audit_row(
    spark: SparkSession, run_id: str, start: datetime, version: str, received: int, published: int,
    state: str, message: str | None = None, mode: str = "batch", end: datetime | None = None,
) -> DataFrame:
    end = end or datetime.now(timezone.utc)
    row = (
        run_id, start, end, version, mode, received, published, received - published,
        (end - start).total_seconds(), state, message,
    )
    return spark.createDataFrame([row], RUN_SCHEMA)


def record_run(row: DataFrame, tables: ScoringTables) -> None:
    """Insert or replace the audit row of a run: a run owns its partition of the audit table."""
    replace_partitions(row, tables.runs, ["id_ejecucion"], tables.location)


def publish(staged: DataFrame, tables: ScoringTables, run_id: str, model_version: str) -> int:
    """Insert-only merge on (claim, version, run), done as an append of the missing rows.

    Only this run's partition of the version is read; when it is empty, as in every first try,
    nothing is joined and the staged rows are not shuffled. Returns the staged claims that the
    version and run hold afterwards.
    """
    spark = staged.sparkSession
    own = (F.col("version_modelo") == model_version) & (F.col("id_ejecucion") == run_id)
    target = table_or_empty(spark, tables.scores, SCORE_SCHEMA).filter(own)
    missing = staged if target.isEmpty() else new_rows(staged, target, [C.KEY, "version_modelo", "id_ejecucion"])
    append(missing, tables.scores, ["version_modelo", "id_ejecucion"], tables.location)
    return verify_batch(spark.table(tables.scores).filter(own)).rows


def require_own_run(spark: SparkSession, tables: ScoringTables, run_id: str, model_version: str) -> None:
    """A run id belongs to the version that used it first: neither its scores nor its audit row may be of another."""
    other = (F.col("id_ejecucion") == run_id) & (F.col("version_modelo") != model_version)
    for name, schema in ((tables.runs, RUN_SCHEMA), (tables.scores, SCORE_SCHEMA)):
        if not table_or_empty(spark, name, schema).filter(other).isEmpty():
            raise ValueError(f"run id {run_id!r} belongs to another model version than {model_version!r}")


def score_batch(
    source: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    model_version: str,
    tables: ScoringTables = ScoringTables(),
    limits: C.Thresholds = C.Thresholds(),
    run_id: str | None = None,
    mode: str = "batch",
) -> RunResult:
    """Score what is new, publish it repeatably, and leave an audit row in every case.

    ``scorer`` takes the prepared frame and adds ``score_fraude``: a saved pipeline model, or any
    column expression. Steps: schema contract; anti join, features, score and stage in one job, the only one that
    reads the source (the barrier: everything after reads stored rows); key check and row count of the stage; publish; verify;
    audit; clear the stage. An empty batch is a valid run (NO_DATA). A failure writes a FAILED row
    and is raised again. A repeated run id replaces its stage and publishes only what is missing. A
    run id of another model version is refused: the FAILED row goes under ``run@version``, and the
    rows of the earlier run stay as they are.

    If the scorer names the features it takes (an attribute ``features``), these must be the approved
    ones, in order.
    """
    spark = source.sparkSession
    run_id = (run_id or "").strip() or str(uuid.uuid4())
    start = datetime.now(timezone.utc)
    received = published = 0
    audit_id = run_id
    try:
        audit_id = f"{run_id}@{model_version}"
        require_own_run(spark, tables, run_id, model_version)
        audit_id = run_id
        check_input_columns(source)
        scores = table_or_empty(spark, tables.scores, SCORE_SCHEMA)
        # A repeated run must see its own claims again, so its rows do not count as scored.
        scored = scores.filter((F.col("version_modelo") == model_version) & (F.col("id_ejecucion") != run_id))
        # A new version has scored nothing: then the input need not be shuffled for the anti join.
        incoming = source if scored.isEmpty() else unscored(source, scored, model_version)
        check_features(list(getattr(scorer, "features", C.FEATURES)))
        rows = score_rows(scorer(scoring_frame(incoming)), model_version, run_id, start, limits, mode)
        replace_partitions(rows, tables.stage, ["id_ejecucion"], tables.location)
        # The source is read once, by the write above: rows and keys are counted on the run's stored partition.
        staged = spark.table(tables.stage).filter(F.col("id_ejecucion") == run_id).select(*rows.columns)
        facts = key_facts(staged)
        received = facts.rows
        if received == 0:
            record_run(audit_row(spark, run_id, start, model_version, 0, 0, "NO_DATA", C.NO_DATA_MESSAGE, mode), tables)
            return RunResult(run_id, "NO_DATA", 0, 0, C.NO_DATA_MESSAGE)
        facts.require_clean()
        published = publish(staged, tables, run_id, model_version)
        if published != received:
            raise ValueError(f"publication incomplete: received={received}, published={published}")
        record_run(audit_row(spark, run_id, start, model_version, received, published, "SUCCESS", None, mode), tables)
    except Exception as error:
        message = str(error) or type(error).__name__
        record_run(audit_row(spark, audit_id, start, model_version, received, published, "FAILED", message, mode), tables)
        if received:
            drop_partition(spark, tables.stage, "id_ejecucion", run_id)
        raise
    drop_partition(spark, tables.stage, "id_ejecucion", run_id)
    return RunResult(run_id, "SUCCESS", received, published)


def quality_report(source: DataFrame) -> DataFrame:
    """Missing values per model feature of a batch."""
    return missing_profile(scoring_frame(source))


def batch_quality(source: DataFrame) -> DataFrame:
    """Missing values per model feature and unreadable dates per date column of a batch: (clase, columna, casos)."""
    features = quality_report(source).select(F.lit("FEATURE").alias("clase"), F.col("variable").alias("columna"), F.col("valores_faltantes").alias("casos"))
    dates = unreadable_dates(source, C.SCORING_DATES)
    return features.unionByName(dates.select(F.lit("DATE").alias("clase"), "columna", F.col("fechas_ilegibles").alias("casos")))


def run_report(spark: SparkSession, tables: ScoringTables, run_id: str) -> tuple[DataFrame, DataFrame]:
    """Risk summary and audit row of a run; both reads are pruned to the run."""
    scores = spark.table(tables.scores).filter(F.col("id_ejecucion") == run_id)
    return risk_summary(scores), spark.table(tables.runs).filter(F.col("id_ejecucion") == run_id)


# --- arrival of new claims -----------------------------------------------------------------------


def next_batch(existing: DataFrame, prefix: str, size: int, family: str) -> DataFrame:
    """The first ``size`` claims by key, re-keyed by a hash and stamped, minus those already there.

    ``family`` is the common prefix of generated keys: generated claims are never sources again.
    """
    from claimlens.functions.scoring import short_hash_key

    first = existing.filter(~F.col(C.KEY).startswith(family)).orderBy(C.KEY).limit(size)
    batch = first.withColumns({C.KEY: short_hash_key(F.col(C.KEY), prefix), "fecha_ingesta": F.current_timestamp()})
    return new_rows(batch, existing, [C.KEY])

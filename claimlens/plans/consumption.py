"""Views for consumers, as persisted SQL over catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimlens import config as C
from claimlens.sources.tables import publish_view


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_consumer_view(
    spark: SparkSession, name: str, scores_table: str, model_name: str = C.DEFAULT_MODEL, contract_version: str = C.CONTRACT_VERSION
) -> DataFrame:
    """The latest score per claim under the consumer contract; same rows as ``reports.consumer_view``."""
    publish_view(
        spark,
        name,
        None,
        f"""
        WITH newest AS (
          SELECT *, row_number() OVER (
            PARTITION BY id_reclamacion
            ORDER BY fecha_scoring DESC, id_ejecucion, score_fraude DESC, version_modelo) AS puesto
          FROM {scores_table}
        )
        SELECT id_reclamacion, score_fraude, nivel_riesgo, accion_sugerida, fecha_scoring,
               {_text(model_name)} AS model_name,
               coalesce(nullif(regexp_extract(version_modelo, ':([0-9]+)$', 1), ''), version_modelo) AS model_version,
               {_text(contract_version)} AS contract_version,
               id_ejecucion AS trace_id, estado_scoring AS scoring_status, cast(NULL AS STRING) AS reason_code
        FROM newest WHERE puesto = 1
        """,
    )
    return spark.table(name)


def create_alert_view(spark: SparkSession, name: str, drift_table: str) -> DataFrame:
    """Warning and critical drift rows with evidence and action; same rows as ``drift.active_alerts``."""
    agreed = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in C.ALERT_ACTIONS.items())
    publish_view(
        spark,
        name,
        None,
        f"""
        SELECT feature_name AS alert_source, feature_type AS alert_type, drift_status AS severity,
               'PSI=' || cast(round(psi, 4) AS STRING)
                 || coalesce(', KS=' || cast(round(ks_statistic, 4) AS STRING), '') AS evidence,
               CASE feature_name {agreed} ELSE {_text(C.ALERT_ACTION_DEFAULT)} END AS recommended_action
        FROM {drift_table}
        WHERE drift_status IN ({_text(C.CRITICAL)}, {_text(C.WARNING)})
        """,
    )
    return spark.table(name)

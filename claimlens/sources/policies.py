"""Rules as data: limits, retraining rules, response fields and error codes as typed tables.

The rows are made from the limits in ``config`` and from code lists; whoever keeps a policy reads the stored table, so a
changed row changes the result. Rules are conjunctions of conditions, one row each: (rule, fact, comparison, bound).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.sources.tables import overwrite

COMPARE = {
    "=": lambda a, b: a == b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def metric_limits() -> list[tuple]:
    """(metric, layer, comparison, warning, critical) for every limit that the library checks."""
    d, g = C.DriftLimits(), C.GateLimits()
    return [
        ("psi", "DATA_DRIFT", ">=", d.psi_warning, d.psi_critical),
        ("ks", "DATA_DRIFT", ">=", None, d.ks_critical),
        ("score_psi", "PREDICTION_DRIFT", ">=", d.psi_warning, d.psi_critical),
        ("flagged_change", "PREDICTION_DRIFT", ">", C.FLAGGED_CHANGE_WARNING, C.FLAGGED_CHANGE_CRITICAL),
        ("volume_change", "OPERATIONAL", ">", C.VOLUME_CHANGE, None),
        ("area_loss", "PERFORMANCE", ">", C.AREA_LOSS_WARNING, C.AREA_LOSS_CRITICAL),
        ("roc_auc", "PERFORMANCE", "<", None, g.roc_auc),
        ("area_under_pr", "PERFORMANCE", "<", None, g.area_under_pr),
        ("top20_capture", "BUSINESS", "<", None, g.top20_capture),
    ]


# Own rules: which facts (see ``plans.monitoring.retraining_facts``) lead to which action. A rule fires if all its
# conditions hold; several may fire.
RETRAINING: dict[str, tuple[bool, list[tuple[str, str, float]]]] = {
    "RESTORE_VERSION": (False, [("score_critical", ">", 0), ("features_drifted", "=", 0)]),
    "INVESTIGATE": (False, [("features_drifted", ">", 0), ("losses_critical", "=", 0)]),
    "REVIEW_THRESHOLD": (False, [("score_critical", ">", 0), ("losses_critical", "=", 0)]),
    "RETRAIN_ON_RECENT": (True, [("features_drifted", ">", 0), ("losses_critical", ">", 0)]),
    "REBUILD_FEATURES": (True, [("features_drifted", "=", 0), ("losses_critical", ">", 0)]),
    "SEGMENT_AND_LABEL": (True, [("new_categories", ">", 0)]),
    "RECALIBRATE": (False, [("losses_warning", ">", 0), ("losses_critical", "=", 0)]),
    "KEEP": (False, [("features_drifted", "=", 0), ("score_critical", "=", 0), ("losses_critical", "=", 0), ("losses_warning", "=", 0)]),
}

# Reason codes and their status numbers.
STATUS_OF = {
    "SUCCESS": 200,
    "QUEUED_FOR_BATCH": 202,
    "INVALID_SCHEMA": 400,
    "UNAUTHENTICATED": 401,
    "FORBIDDEN": 403,
    "IDEMPOTENCY_CONFLICT": 409,
    "INVALID_VALUES": 422,
    "RATE_LIMITED": 429,
    "SCORING_ERROR": 500,
    "SERVICE_UNAVAILABLE": 503,
}


def policies() -> dict[str, tuple[str, list[tuple]]]:
    """Schema and rows of each policy table; the first column numbers the rows."""
    rules = [(rule, retrain, *condition) for rule, (retrain, conditions) in RETRAINING.items() for condition in conditions]
    fields = [(name, kind, name not in C.OPTIONAL_RESPONSE) for name, kind in C.RESPONSE_FIELDS.items()]
    # A client may try again when it was too fast or the server failed.
    errors = [(reason, status, status == 429 or status >= 500) for reason, status in STATUS_OF.items()]
    tables = {
        "monitoring_metric_policy": ("metric string, layer string, comparison string, warning double, critical double", metric_limits()),
        "retraining_decision_policy": ("rule string, retrain boolean, fact string, comparison string, bound double", rules),
        "score_interface_contract": ("field_name string, data_type string, required boolean", fields),
        "score_error_contract": ("reason_code string, http_status int, retry_allowed boolean", errors),
    }
    return {name: (f"number int, {schema}", [(i + 1, *_doubles(r)) for i, r in enumerate(rows)]) for name, (schema, rows) in tables.items()}


def _doubles(row: Iterable) -> tuple:
    """Bounds as doubles; status numbers and flags as they are."""
    *head, last = row
    return (*head, float(last)) if isinstance(last, int) and not isinstance(last, bool) else (*head, last)


def policy(spark: SparkSession, name: str) -> DataFrame:
    """A policy table in its order."""
    schema, rows = policies()[name]
    return spark.createDataFrame(rows, schema).orderBy("number")


def seed(spark: SparkSession, database: str | None = None) -> list[str]:
    """Write (overwrite) all policy tables; returns their names."""
    names = {n: f"{database}.{n}" if database else n for n in policies()}
    for short, full in names.items():
        overwrite(policy(spark, short), full)
    return list(names.values())


def read_policy(spark: SparkSession, name: str) -> DataFrame:
    """A stored policy table, ordered by its first column."""
    stored = spark.table(name)
    return stored.orderBy(stored.columns[0])


# --- rules to predicates --------------------------------------------------------------------


def predicate(conditions: list[Row]) -> Column:
    """All conditions of a rule as one column; a fact that is null fails its condition."""
    holds = [F.coalesce(COMPARE[c["comparison"]](F.col(c["fact"]), F.lit(c["bound"])), F.lit(False)) for c in conditions]
    return reduce(lambda a, b: a & b, holds)


def fired(facts: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per row of facts and rule: the facts, the rule, whether it asks for retraining, whether it fires.

    The rules are a small table; they become one projection over the facts, and no join. A comparison or a fact that is not
    known is refused.
    """
    by_rule: dict[tuple[str, bool], list[Row]] = {}
    for row in rules.collect():
        if row["comparison"] not in COMPARE or row["fact"] not in facts.columns:
            raise ValueError(f"rule {row['rule']!r}: cannot compare {row['fact']!r} by {row['comparison']!r}")
        by_rule.setdefault((row["rule"], row["retrain"]), []).append(row)
    cells = [
        F.struct(F.lit(rule).alias("rule"), F.lit(retrain).alias("retrain"), predicate(conditions).alias("fires"))
        for (rule, retrain), conditions in by_rule.items()
    ]
    return facts.select("*", F.inline(F.array(*cells)))

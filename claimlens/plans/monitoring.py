"""Monitoring flow: periods from scores and claims, drift table, alerts, retraining advice."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.functions.features import parse_dates
from claimlens.operators import drift as D
from claimlens.operators.reports import baseline_execution, execution_distribution
from claimlens.session import run_folder
from claimlens.sources.policies import fired
from claimlens.sources.tables import write_and_read


@dataclass(frozen=True)
class Monitoring:
    scores: DataFrame
    features: DataFrame
    drift: DataFrame
    alerts: DataFrame


def _store(df: DataFrame, name: str) -> DataFrame:
    return write_and_read(df, run_folder(df.sparkSession, name))


def compare_periods(scores: DataFrame, features: DataFrame, limits: C.DriftLimits = C.DriftLimits()) -> Monitoring:
    """Store both period tables (several passes follow) and compare their two periods."""
    stored_scores, stored_features = _store(scores, "period-scores"), _store(features, "period-features")
    table = D.drift_table(stored_features, stored_scores, limits=limits)
    return Monitoring(stored_scores, stored_features, table, D.active_alerts(table))


def baseline_of(scores: DataFrame) -> tuple[str, DataFrame]:
    """The execution with the most claims, and its scores."""
    row = baseline_execution(execution_distribution(scores).select("id_ejecucion", "reclamaciones")).first()
    run = row["id_ejecucion"]
    return run, scores.filter(F.col("id_ejecucion") == run).select(C.KEY, F.col("score_fraude").cast("double").alias("score_fraude"))


def stress_test(scores: DataFrame, claims: DataFrame, factor: float = 1.40, bucket=None) -> Monitoring:
    """What-if comparison: the baseline execution against a shifted copy of itself.

    Scores move up until the flagged share is ``factor`` times as large; part of the claims get
    larger reserves, late notices or another channel.
    """
    run, found = baseline_of(scores)
    baseline = _store(found, "baseline")
    shift = D.shift_for_target(baseline, factor)
    both_scores = D.period_scores(baseline, C.REFERENCE, run).unionByName(
        D.period_scores(D.shifted_scores(baseline, shift), C.CURRENT, "INCIDENTE_SIMULADO")
    )
    own_claims = D.baseline_claims(parse_dates(claims, C.SCORING_DATES), baseline)
    reference = _store(D.period_features(own_claims, C.REFERENCE), "baseline-features")
    scenario = D.cohort_scenario(reference, D.hash_bucket() if bucket is None else bucket)
    return compare_periods(both_scores, reference.unionByName(scenario))


def retraining_facts(drift: DataFrame, losses: DataFrame, categories: DataFrame) -> DataFrame:
    """What the retraining rules ask for, as one row: all inputs are small results.

    ``categories``: rows (feature_name, category, ref_n, cur_n). A category is new if only the current period has it.
    """
    is_score, status = F.col("feature_type") == "PREDICTION", F.col("drift_status")
    found = {
        "features_drifted": drift.filter(~is_score & status.isin(C.CRITICAL, C.WARNING)),
        "score_critical": drift.filter(is_score & (status == C.CRITICAL)),
        "losses_critical": losses.filter(F.col("estado") == "CRITICO"),
        "losses_warning": losses.filter(F.col("estado") == "ADVERTENCIA"),
        "new_categories": categories.filter((F.col("ref_n") == 0) & (F.col("cur_n") > 0)),
    }
    rows = reduce(DataFrame.unionByName, [rows.select(F.lit(fact).alias("fact")) for fact, rows in found.items()])
    return rows.agg(*[F.count_if(F.col("fact") == fact).alias(fact) for fact in found])


def retraining_advice(drift: DataFrame, losses: DataFrame, categories: DataFrame, rules: DataFrame) -> DataFrame:
    """Every retraining rule with the facts it looks at and whether it fires."""
    return fired(retraining_facts(drift, losses, categories), rules)


def policy_status(drift: DataFrame, limits: DataFrame) -> DataFrame:
    """The stored limits with the features that reach each of them: those of ``psi``, ``score_psi`` and ``ks``."""
    is_score = F.col("feature_type") == "PREDICTION"
    measured = drift.select(
        F.inline(
            F.array(
                F.struct(F.when(is_score, "score_psi").otherwise("psi").alias("metric"), F.col("psi").alias("value")),
                F.struct(F.lit("ks").alias("metric"), F.col("ks_statistic").alias("value")),
            )
        )
    )
    # A handful of limits and a row or two per feature.
    joined = limits.join(measured, "metric", "left")
    return joined.groupBy("number", "metric", "layer", "warning", "critical").agg(
        F.count_if(F.col("value") >= F.col("critical")).alias("criticos"),
        F.count_if((F.col("value") >= F.col("warning")) & (F.col("value") < F.col("critical"))).alias("advertencias"),
    )

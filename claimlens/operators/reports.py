"""Summaries of claims, scores, periods and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.functions.scoring import version_number
from claimlens.operators.ranking import group_quantiles, order_statistics


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("casos"))


def base_rate(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.avg(label).alias("base_rate"))


def segment_table(
    df: DataFrame,
    segments: list[str] = C.SEGMENTS,
    min_cases: int = C.SEGMENT_MIN_CASES,
    top: int = C.SEGMENT_TOP,
    label: str = "label",
    score: str = "score_fraude",
) -> DataFrame:
    """The worst ``top`` values of each segment column that exists, by rate; small groups left out.

    All segment columns share one pass: each row is repeated per column and pre-aggregated before
    the shuffle. The ranking window sees one row per segment value.
    """
    present = [s for s in segments if s in df.columns]
    cells = ", ".join(f"'{s}', cast(`{s}` as string)" for s in present)
    order = W.partitionBy("segmento").orderBy(F.desc("tasa_fraude"), F.asc_nulls_first("valor"))
    return (
        df.select(label, score, F.expr(f"stack({len(present)}, {cells}) as (segmento, valor)"))
        .groupBy("segmento", "valor")
        .agg(F.count("*").alias("casos"), F.avg(label).alias("tasa_fraude"), F.avg(score).alias("score_promedio"))
        .filter(F.col("casos") >= min_cases)
        .withColumn("puesto", F.row_number().over(order))
        .filter(F.col("puesto") <= top)
    )


def risk_summary(scores: DataFrame) -> DataFrame:
    """Cases and score range by level and action, highest mean first."""
    return (
        scores.groupBy("nivel_riesgo", "accion_sugerida")
        .agg(
            F.count("*").alias("casos"),
            F.avg("score_fraude").alias("score_promedio"),
            F.min("score_fraude").alias("score_minimo"),
            F.max("score_fraude").alias("score_maximo"),
        )
        .orderBy(F.desc("score_promedio"))
    )


def score_difference(a: DataFrame, b: DataFrame, key: str = C.KEY) -> DataFrame:
    """Claims in both sets with the absolute score difference. Columns: score, prediction."""
    left = a.select(key, F.col("score").alias("score_a"), F.col("prediction").alias("pred_a"))
    right = b.select(key, F.col("score").alias("score_b"), F.col("prediction").alias("pred_b"))
    return left.join(right, key, "inner").withColumn("diferencia", F.abs(F.col("score_a") - F.col("score_b")))


def equivalence_summary(differences: DataFrame) -> DataFrame:
    return differences.agg(
        F.count("*").alias("registros_comparados"),
        F.count_if(F.col("pred_a") != F.col("pred_b")).alias("predicciones_diferentes"),
        F.max("diferencia").alias("max_diferencia_score"),
    )


def require_equivalent(summary: DataFrame, tolerance: float = C.EQUIVALENCE_TOLERANCE) -> None:
    """Fail when nothing was compared, a prediction differs, or a score differs by more than the tolerance."""
    row = summary.first()
    if row["max_diferencia_score"] is None:
        raise ValueError("no scores were compared")
    if row["max_diferencia_score"] > tolerance or row["predicciones_diferentes"]:
        raise ValueError(f"models differ: {row.asDict()}")


def period_score_summary(scores: DataFrame) -> DataFrame:
    """Count, mean, median, 90th percentile, flagged count and percent per period.

    Both percentiles come from one sketch.
    """
    s = F.col("score_monitoreado")
    return (
        scores.groupBy("periodo")
        .agg(
            F.count("*").alias("casos"),
            F.avg(s).alias("media"),
            F.percentile_approx(s, [0.50, 0.90]).alias("p"),
            F.sum("marcado_fraude").alias("casos_marcados_fraude"),
            F.avg("marcado_fraude").alias("parte"),
        )
        .select(
            "periodo",
            "casos",
            F.round("media", 4).alias("score_promedio"),
            F.round(F.get("p", F.lit(0)), 4).alias("score_p50"),
            F.round(F.get("p", F.lit(1)), 4).alias("score_p90"),
            "casos_marcados_fraude",
            F.round(100.0 * F.col("parte"), 2).alias("porcentaje_marcado_fraude"),
        )
        .orderBy(F.desc("periodo"))
    )


def period_score_summary_exact(scores: DataFrame, periods: list[str]) -> DataFrame:
    """As ``period_score_summary`` with exact percentiles and unrounded figures.

    Each period becomes a column, so all percentiles of all periods come out of the same
    narrowing passes; no group is collected.
    """
    names = {p: f"p{i}" for i, p in enumerate(periods)}
    s = F.col("score_monitoreado")
    wide = scores.select(*[F.when(F.col("periodo") == p, s).alias(n) for p, n in names.items()])

    def rank(n: int, percent: int) -> int:
        return max(1, -(-n * percent // 100))

    found = order_statistics(wide, {n: lambda k: [rank(k, 50), rank(k, 90)] if k else [] for n in names.values()})
    rows = []
    for p, n in names.items():
        if found[n]:
            total = next(iter(found[n].values())).total
            rows.append((p, found[n][rank(total, 50)].value, found[n][rank(total, 90)].value))
    percentiles = F.broadcast(scores.sparkSession.createDataFrame(rows, "periodo string, score_p50 double, score_p90 double"))
    counts = scores.groupBy("periodo").agg(
        F.count("*").alias("casos"),
        F.avg(s).alias("score_promedio"),
        F.sum("marcado_fraude").alias("casos_marcados_fraude"),
        (100.0 * F.avg("marcado_fraude")).alias("porcentaje_marcado_fraude"),
    )
    return counts.join(percentiles, "periodo", "left")


def period_feature_summary(features: DataFrame) -> DataFrame:
    """Means of the monitored numbers and distinct categories per period.

    Sums are first taken per (period, channel, region), so the distinct counts run over a handful
    of rows instead of expanding every input row once per distinct column.
    """
    means = {
        "edad_promedio": "edad_actual_asegurado",
        "vigencia_promedio": "vigencia_poliza",
        "reserva_promedio": "reserva_inicial",
        "log_reserva_promedio": "log_reserva_inicial",
        "dias_notificacion_promedio": "dias_siniestro_a_notificacion",
    }
    groups = features.groupBy("periodo", "canal_comercial", "regional").agg(
        F.count("*").alias("n"),
        *[F.sum(c).alias(f"s_{c}") for c in means.values()],
        *[F.count(c).alias(f"n_{c}") for c in means.values()],
    )
    return groups.groupBy("periodo").agg(
        F.sum("n").alias("registros"),
        *[F.try_divide(F.sum(f"s_{c}"), F.sum(f"n_{c}")).alias(name) for name, c in means.items()],
        F.count_distinct("canal_comercial").alias("canales_distintos"),
        F.count_distinct("regional").alias("regionales_distintas"),
    )


def flagged_share(scores: DataFrame, score: str = "score_fraude", cutoff: float = C.Thresholds().high) -> DataFrame:
    s = F.col(score)
    return scores.agg(
        F.count("*").alias("registros"),
        F.avg(F.when(s >= cutoff, 100.0).otherwise(0.0)).alias("porcentaje_alto"),
    )


def execution_distribution(scores: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Score distribution per execution: claims, mean, percentiles, level shares, version, time.

    The definition is this library's own. The percentiles come from one sketch, merged before the
    shuffle, so an execution may hold any share of all rows; ``execution_percentiles`` gives exact ones.
    """
    s = F.col("score_fraude")

    def percent(level: str) -> Column:
        return F.avg(F.when(F.col("nivel_riesgo") == level, 100.0).otherwise(0.0))

    grouped = scores.groupBy("id_ejecucion").agg(
        F.max("fecha_scoring").alias("fecha_scoring"),
        F.count("*").alias("reclamaciones"),
        F.avg(s).alias("score_promedio"),
        F.percentile_approx(s, [0.50, 0.90, 0.95], accuracy).alias("p"),
        percent(C.ALTO).alias("porcentaje_alto"),
        percent(C.MEDIO).alias("porcentaje_medio"),
        percent(C.BAJO).alias("porcentaje_bajo"),
        F.max("version_modelo").alias("version_modelo"),
    )
    return grouped.select(
        "id_ejecucion",
        "fecha_scoring",
        "reclamaciones",
        "score_promedio",
        *[F.get("p", F.lit(i)).alias(f"score_p{q}") for i, q in enumerate((50, 90, 95))],
        "porcentaje_alto",
        "porcentaje_medio",
        "porcentaje_bajo",
        "version_modelo",
    )


def execution_percentiles(scores: DataFrame) -> DataFrame:
    """The percentiles of ``execution_distribution``, exact."""
    percents = (50, 90, 95)
    found = group_quantiles(scores, ["id_ejecucion"], "score_fraude", [q / 100 for q in percents])
    return found.select("id_ejecucion", *[F.get("quantiles", F.lit(i)).alias(f"score_p{q}") for i, q in enumerate(percents)])


def baseline_execution(distribution: DataFrame) -> DataFrame:
    """The execution with the most claims (smallest id on a tie)."""
    return distribution.orderBy(F.desc("reclamaciones"), "id_ejecucion").limit(1)


def execution_monitor(runs: DataFrame, slow_minutes: float = 60.0) -> DataFrame:
    """Runs with minutes, success percent and a state. The rule for the state is this library's own."""
    minutes = F.col("duracion_segundos") / 60.0
    percent = F.try_divide(100.0 * F.col("registros_exitosos"), F.col("registros_entrada"))
    state = (
        F.when(F.col("estado") == "FAILED", "CRITICO")
        .when(F.col("estado") == "NO_DATA", "SIN_DATOS")
        .when((percent < 100.0) | (minutes > slow_minutes), "ADVERTENCIA")
        .otherwise("NORMAL")
    )
    return runs.select(
        "id_ejecucion",
        "fecha_inicio",
        "fecha_fin",
        "version_modelo",
        "modo_scoring",
        "registros_entrada",
        "registros_exitosos",
        "registros_error",
        minutes.alias("duracion_minutos"),
        percent.alias("porcentaje_exito"),
        "estado",
        state.alias("estado_monitoreo"),
        "mensaje_error",
    )


# --- consumer side ---------------------------------------------------------------------


def latest_scores(scores: DataFrame) -> DataFrame:
    """The newest score of each claim (ties: smaller run id, then higher score).

    The filter on the row number lets Spark keep one row per claim and task before the shuffle,
    so a claim with very many scores does not load one task.
    """
    newest = W.partitionBy(C.KEY).orderBy(F.desc("fecha_scoring"), "id_ejecucion", F.desc("score_fraude"), "version_modelo")
    return scores.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def consumer_view(scores: DataFrame, model_name: str = C.DEFAULT_MODEL, contract_version: str = C.CONTRACT_VERSION) -> DataFrame:
    return latest_scores(scores).select(
        C.KEY,
        "score_fraude",
        "nivel_riesgo",
        "accion_sugerida",
        "fecha_scoring",
        F.lit(model_name).alias("model_name"),
        version_number(F.col("version_modelo")).alias("model_version"),
        F.lit(contract_version).alias("contract_version"),
        F.col("id_ejecucion").alias("trace_id"),
        F.col("estado_scoring").alias("scoring_status"),
        F.lit(None).cast("string").alias("reason_code"),
    )


def top_scores(view: DataFrame, n: int = 20) -> DataFrame:
    return view.orderBy(F.desc("score_fraude"), C.KEY).limit(n)


def consumer_summary(view: DataFrame) -> DataFrame:
    """Rows, distinct claims and the latest time, from one pass over per-claim counts."""
    per_claim = view.groupBy(C.KEY).agg(F.count("*").alias("n"), F.max("fecha_scoring").alias("t"))
    return per_claim.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("reclamaciones"),
        F.count(C.KEY).alias("reclamaciones_unicas"),
        F.max("t").alias("ultima_actualizacion"),
    )


# --- period comparisons -------------------------------------------------------------------


def _pair(df: DataFrame, value: Column, period: str, reference: str, current: str) -> DataFrame:
    return df.agg(
        F.max(F.when(F.col(period) == reference, value)).alias("referencia"),
        F.max(F.when(F.col(period) == current, value)).alias("actual"),
    )


def flagged_rate_change(scores: DataFrame, reference: str = C.REFERENCE, current: str = C.CURRENT) -> DataFrame:
    """Relative change of the flagged share: above 20 % a warning, above 40 % critical."""
    rates = scores.groupBy("periodo").agg((100.0 * F.avg("marcado_fraude")).alias("pct"))
    change = F.try_divide(F.col("actual") - F.col("referencia"), F.col("referencia"))
    return _pair(rates, F.col("pct"), "periodo", reference, current).select(
        "referencia",
        "actual",
        change.alias("cambio_relativo"),
        F.when(change.isNull(), "NO_EVALUABLE").when(change > C.FLAGGED_CHANGE_CRITICAL, "CRITICO").when(change > C.FLAGGED_CHANGE_WARNING, "ADVERTENCIA").otherwise("ESTABLE").alias("estado"),
    )


def volume_change(df: DataFrame, reference: str = C.REFERENCE, current: str = C.CURRENT) -> DataFrame:
    """Relative change of the row count: more than 20 % either way is a warning, no data is critical."""
    counts = df.groupBy("periodo").agg(F.count("*").alias("n"))
    change = F.try_divide(F.col("actual") - F.col("referencia"), F.col("referencia"))
    return _pair(counts, F.col("n"), "periodo", reference, current).select(
        "referencia",
        "actual",
        change.alias("cambio_relativo"),
        F.when(F.col("actual").isNull(), "CRITICO").when(F.abs(change) > C.VOLUME_CHANGE, "ADVERTENCIA").otherwise("ESTABLE").alias("estado"),
    )

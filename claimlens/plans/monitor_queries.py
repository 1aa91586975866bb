"""Registered queries on drift, scenarios, models, gates and contracts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.functions import features as FE
from claimlens.functions.scoring import score_rows
from claimlens.operators import contracts as K
from claimlens.operators import drift as D
from claimlens.operators import evaluation as EV
from claimlens.operators import governance as G
from claimlens.operators import merge as M
from claimlens.operators import model as MD
from claimlens.operators import reports as RP
from claimlens.plans import consumption as CV
from claimlens.plans import monitoring as MO
from claimlens.plans import oracles as O
from claimlens.plans import training as TR
from claimlens.plans.batch_scoring import ScoringTables, batch_quality, score_batch
from claimlens.plans.claim_queries import PERIOD_FEATURES, PERIODS, formula_period_features, formula_period_scores, labelled
from claimlens.plans.registry import query, six
from claimlens.session import run_folder
from claimlens.sources import claims as A
from claimlens.sources import policies as P
from claimlens.sources.tables import overwrite, passing_schema, scan, write_and_read

# --- SQL twins of the drift figures -----------------------------------------------------------------


def _values(rows: list[tuple]) -> str:
    def lit(v):
        if isinstance(v, bool):
            return "true" if v else "false"
        if v is None:
            return "NULL"
        return repr(v) if isinstance(v, int) else f"{v!r}::DOUBLE" if isinstance(v, float) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


_SHARES = ", ".join(f"({i}, {min(i * 0.1, 1.0)!r}e0)" for i in range(11))
_X = "(d * sqrt(CAST(n AS DOUBLE) * m / (CAST(n AS DOUBLE) + m)))"
_RIGHT = " ".join(f"{'+' if k % 2 else '-'} 2e0 * exp(-{2 * k * k}e0 * x * x)" for k in range(1, 9))
_LEFT = " + ".join(f"exp(-{(2 * k - 1) ** 2}e0 * pi() * pi() / (8e0 * x * x))" for k in range(1, 9))

# Numeric drift of the long table ``vals(name, ref, x)``, x finite and not null.
NUMERIC_SQL = f"""
sizes AS (SELECT name, sum(CASE WHEN ref THEN 1 ELSE 0 END) AS n, sum(CASE WHEN ref THEN 0 ELSE 1 END) AS m FROM vals GROUP BY name),
ordered AS (SELECT name, x, row_number() OVER (PARTITION BY name ORDER BY x) AS rn FROM vals WHERE ref),
places AS (SELECT name, i, CASE WHEN i = 10 THEN n - 1e0 ELSE q * (n - 1) END AS place FROM sizes, (VALUES {_SHARES}) AS shares(i, q)),
edges AS (
  SELECT DISTINCT p.name, CASE WHEN p.place - floor(p.place) < 5e-1 THEN a.x + (b.x - a.x) * (p.place - floor(p.place))
         ELSE b.x - (b.x - a.x) * (1e0 - (p.place - floor(p.place))) END AS e
  FROM places AS p JOIN ordered AS a ON a.name = p.name AND a.rn = floor(p.place) + 1
  JOIN ordered AS b ON b.name = p.name AND b.rn = ceil(p.place) + 1
),
inner_edges AS (SELECT name, e FROM (SELECT name, e, min(e) OVER (PARTITION BY name) AS lo, max(e) OVER (PARTITION BY name) AS hi FROM edges) AS z WHERE e > lo AND e < hi),
per_value AS (SELECT name, x, sum(CASE WHEN ref THEN 1 ELSE 0 END) AS rn, sum(CASE WHEN ref THEN 0 ELSE 1 END) AS cn FROM vals GROUP BY name, x),
binned AS (
  SELECT v.name, v.x, v.rn, v.cn, (SELECT count(*) FROM inner_edges AS e WHERE e.name = v.name AND e.e <= v.x) AS b FROM per_value AS v
),
bins AS (SELECT name, b, sum(rn) AS rn, sum(cn) AS cn FROM binned GROUP BY name, b),
shares2 AS (
  SELECT bins.name, greatest(CAST(rn AS DOUBLE) / n, 1e-6) AS r, greatest(CAST(cn AS DOUBLE) / m, 1e-6) AS c FROM bins JOIN sizes ON bins.name = sizes.name
),
psi AS (SELECT name, sum((c - r) * ln(c / r)) AS psi FROM shares2 GROUP BY name),
steps AS (
  SELECT p.name, abs(CAST(sum(rn) OVER w AS DOUBLE) / n - CAST(sum(cn) OVER w AS DOUBLE) / m) AS d
  FROM per_value AS p JOIN sizes ON p.name = sizes.name
  WINDOW w AS (PARTITION BY p.name ORDER BY x)
),
ks AS (SELECT name, max(d) AS d FROM steps GROUP BY name),
xs AS (SELECT ks.name, d, {_X} AS x FROM ks JOIN sizes ON ks.name = sizes.name),
numeric_result AS (
  SELECT xs.name AS feature_name, psi.psi AS psi, d AS ks_statistic,
         CASE WHEN x <= 0 THEN 1e0 WHEN x < 118e-2 THEN 1e0 - sqrt(2e0 * pi()) / x * ({_LEFT}) ELSE 0e0 {_RIGHT} END AS ks_pvalue
  FROM xs JOIN psi ON xs.name = psi.name
)"""

STATUS_SQL = """CASE WHEN psi IS NULL THEN 'NO_EVALUABLE' WHEN psi >= 0.25 THEN 'DRIFT_CRITICO'
 WHEN ks_statistic >= 0.10 AND ks_pvalue < 0.05 THEN 'DRIFT_CRITICO' WHEN psi >= 0.10 THEN 'ADVERTENCIA' ELSE 'ESTABLE' END"""

_NUMERIC_VALS = "\n  UNION ALL ".join(f"SELECT '{c}' AS name, periodo = 'REFERENCIA' AS ref, {c} AS x FROM pf WHERE {c} IS NOT NULL" for c in C.DRIFT_NUMERIC)
_CATEGORY_VALS = "\n  UNION ALL ".join(f"SELECT '{c}' AS name, periodo = 'REFERENCIA' AS ref, coalesce({c}, '__NULL__') AS cat FROM pf" for c in C.DRIFT_CATEGORICAL)

CATEGORY_SQL = """
cat_counts AS (SELECT name, cat, sum(CASE WHEN ref THEN 1 ELSE 0 END) AS rn, sum(CASE WHEN ref THEN 0 ELSE 1 END) AS cn FROM cats GROUP BY name, cat),
cat_shares AS (
  SELECT name, greatest(CAST(rn AS DOUBLE) / sum(rn) OVER (PARTITION BY name), 1e-6) AS r,
         greatest(CAST(cn AS DOUBLE) / sum(cn) OVER (PARTITION BY name), 1e-6) AS c FROM cat_counts
),
category_result AS (SELECT name AS feature_name, sum((c - r) * ln(c / r)) AS psi FROM cat_shares GROUP BY name)"""

DRIFT_SQL = f"""{PERIOD_FEATURES},
vals AS (
  {_NUMERIC_VALS}
  UNION ALL SELECT 'score_fraude', "FSINIESTRO" < DATE '1998-05-01', score_formula FROM claims
),
cats AS ({_CATEGORY_VALS}),
{NUMERIC_SQL.strip()},
{CATEGORY_SQL.strip()},
drift AS (
  SELECT feature_name, CASE WHEN feature_name = 'score_fraude' THEN 'PREDICTION' ELSE 'NUMERIC' END AS feature_type, psi, ks_statistic, ks_pvalue FROM numeric_result
  UNION ALL SELECT feature_name, 'CATEGORICAL', psi, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM category_result
),
drift_status AS (SELECT *, {STATUS_SQL} AS drift_status FROM drift)"""


def formula_drift(spark: SparkSession, folder: str) -> MO.Monitoring:
    return MO.compare_periods(formula_period_scores(spark, folder), formula_period_features(spark, folder))


@query(
    "drift_table",
    "J1 J2 J3 J4 J5 J6 J8 F3",
    O.with_(DRIFT_SQL) + "SELECT feature_name, feature_type, round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, drift_status FROM drift_status",
)
def drift_table(spark, folder):
    return six(formula_drift(spark, folder).drift, "psi", "ks_statistic", "ks_pvalue")


@query(
    "drift_report",
    "J8 F3",
    O.with_(DRIFT_SQL) + "SELECT feature_name, feature_type, round(psi, 4) AS psi, round(ks_statistic, 4) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, drift_status FROM drift_status",
)
def drift_report(spark, folder):
    return six(D.drift_report(formula_drift(spark, folder).drift), "ks_pvalue")


ALERTS_SQL = (
    O.with_(DRIFT_SQL)
    + f"""SELECT feature_name AS alert_source, feature_type AS alert_type, drift_status AS severity,
'PSI=' || CAST(round(psi, 4) AS VARCHAR) || CASE WHEN ks_statistic IS NOT NULL THEN ', KS=' || CAST(round(ks_statistic, 4) AS VARCHAR) ELSE '' END AS evidence,
CASE feature_name {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.ALERT_ACTIONS.items())} ELSE '{C.ALERT_ACTION_DEFAULT}' END AS recommended_action
FROM drift_status WHERE drift_status IN ('DRIFT_CRITICO', 'ADVERTENCIA')"""
)


@query("active_alerts", "J9 B23 B24 B25 F3", ALERTS_SQL)
def active_alerts(spark, folder):
    return formula_drift(spark, folder).alerts


EVENT_DRIFT_SQL = f"""
vals AS (SELECT 'value' AS name, ts < TIMESTAMP '2024-01-16' AS ref, value AS x FROM events WHERE value IS NOT NULL),
cats AS (SELECT 'event_type' AS name, ts < TIMESTAMP '2024-01-16' AS ref, coalesce(event_type, '__NULL__') AS cat FROM events),
{NUMERIC_SQL.strip()},
{CATEGORY_SQL.strip()},
drift AS (
  SELECT feature_name, 'NUMERIC' AS feature_type, psi, ks_statistic, ks_pvalue FROM numeric_result
  UNION ALL SELECT feature_name, 'CATEGORICAL', psi, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM category_result
)"""


@query(
    "event_value_drift",
    "J1 J2 J3 J4 J5",
    O.with_(EVENT_DRIFT_SQL) + f"SELECT feature_name, feature_type, round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, {STATUS_SQL} AS drift_status FROM drift",
)
def event_value_drift(spark, folder):
    """First against second half of the month of events."""
    first_half = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    events = scan(spark, "events", folder).withColumn("periodo", F.when(first_half, C.REFERENCE).otherwise(C.CURRENT))
    return six(D.drift_table(events, numeric=["value"], categorical=["event_type"]), "psi", "ks_statistic", "ks_pvalue")


# --- scenarios -----------------------------------------------------------------------------------------


SHIFT_SQL = f"""{O.ORDER_SCORES},
share AS (SELECT least(1e2, 1e2 * avg(CASE WHEN score_fraude >= {O.HIGH} THEN 1e0 ELSE 0e0 END) * 14e-1) AS goal, count(*) AS n FROM order_scores),
cut AS (
  SELECT score_fraude AS cutoff FROM (SELECT score_fraude, row_number() OVER (ORDER BY score_fraude) AS rn FROM order_scores) AS o, share
  WHERE rn = greatest(1, CAST(ceil(round((1e0 - goal / 1e2) * n, 9)) AS BIGINT))
),
shift AS (SELECT greatest(0e0, {O.HIGH} - cutoff + 1e-6) AS delta FROM cut),
moved AS (SELECT id_reclamacion, least(1e0, score_fraude + delta) AS s FROM order_scores, shift)"""


@query(
    "shifted_score_scenario",
    "J10 D17",
    O.with_(SHIFT_SQL) + f"SELECT id_reclamacion, round(s, 8) AS score_monitoreado, CASE WHEN s >= {O.HIGH} THEN 1 ELSE 0 END AS marcado_fraude, 'ACTUAL_4_MESES' AS periodo FROM moved",
)
def shifted_score_scenario(spark, folder):
    scores = A.formula_claims(spark, folder).select(C.KEY, "score_fraude")
    moved = D.shifted_scores(scores, D.shift_for_target(scores))
    rows = D.period_scores(moved, C.CURRENT, "INCIDENTE_SIMULADO").drop("source_execution_id")
    return rows.withColumn("score_monitoreado", F.round("score_monitoreado", 8))


COHORT_SQL = f"""{PERIOD_FEATURES},
bucketed AS (SELECT *, CAST('0x' || substr(sha256(id_reclamacion), 1, 8) AS BIGINT) % 100 AS b FROM pf),
cohort AS (
  SELECT id_reclamacion, edad_actual_asegurado, vigencia_poliza, CASE WHEN b < 60 THEN reserva_inicial * 18e-1 ELSE reserva_inicial END AS reserva_inicial,
         CASE WHEN b < 50 THEN dias_siniestro_a_notificacion + 10 ELSE dias_siniestro_a_notificacion END AS dias_siniestro_a_notificacion,
         CASE WHEN b < 30 THEN 'CANAL_DIGITAL_SIMULADO' ELSE canal_comercial END AS canal_comercial, regional
  FROM bucketed
)"""


@query(
    "cohort_scenario",
    "J11 B7",
    O.with_(COHORT_SQL)
    + """SELECT *, round(ln(1e0 + CASE WHEN reserva_inicial > 0 THEN reserva_inicial ELSE 0e0 END), 6) AS log_reserva_inicial, 'ACTUAL_4_MESES' AS periodo FROM cohort""",
)
def cohort_scenario(spark, folder):
    """With the bucket that other engines can compute."""
    return six(D.cohort_scenario(formula_period_features(spark, folder), D.sha_bucket()), "log_reserva_inicial")


@query("cohort_scenario_hashed", "J11")
def cohort_scenario_hashed(spark, folder):
    return D.cohort_scenario(formula_period_features(spark, folder), D.hash_bucket())


STRESS_SQL = f"""{PERIOD_FEATURES},
base AS (SELECT id_reclamacion, score_formula AS score_fraude FROM claims WHERE lote = (
  SELECT lote FROM claims WHERE lote < 2 GROUP BY lote ORDER BY count(*) DESC, lote LIMIT 1)),
share AS (SELECT least(1e2, 1e2 * avg(CASE WHEN score_fraude >= {O.HIGH} THEN 1e0 ELSE 0e0 END) * 14e-1) AS goal, count(*) AS n FROM base),
cut AS (
  SELECT score_fraude AS cutoff FROM (SELECT score_fraude, row_number() OVER (ORDER BY score_fraude) AS rn FROM base) AS o, share
  WHERE rn = greatest(1, CAST(ceil(round((1e0 - goal / 1e2) * n, 9)) AS BIGINT))
),
shift AS (SELECT greatest(0e0, {O.HIGH} - cutoff + 1e-6) AS delta FROM cut),
own AS (SELECT pf.*, CAST('0x' || substr(sha256(pf.id_reclamacion), 1, 8) AS BIGINT) % 100 AS b FROM pf JOIN base ON base.id_reclamacion = pf.id_reclamacion),
scenario AS (
  SELECT edad_actual_asegurado, vigencia_poliza, CASE WHEN b < 60 THEN reserva_inicial * 18e-1 ELSE reserva_inicial END AS reserva_inicial,
         CASE WHEN b < 50 THEN dias_siniestro_a_notificacion + 10 ELSE dias_siniestro_a_notificacion END AS dias_siniestro_a_notificacion,
         CASE WHEN b < 30 THEN 'CANAL_DIGITAL_SIMULADO' ELSE canal_comercial END AS canal_comercial, regional FROM own
),
both_periods AS (
  SELECT true AS ref, edad_actual_asegurado, vigencia_poliza, reserva_inicial, dias_siniestro_a_notificacion, canal_comercial, regional, log_reserva_inicial FROM own
  UNION ALL SELECT false, *, ln(1e0 + CASE WHEN reserva_inicial > 0 THEN reserva_inicial ELSE 0e0 END) FROM scenario
),
vals AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS name, ref, {c} AS x FROM both_periods WHERE {c} IS NOT NULL" for c in C.DRIFT_NUMERIC)}
  UNION ALL SELECT 'score_fraude', true, score_fraude FROM base
  UNION ALL SELECT 'score_fraude', false, least(1e0, score_fraude + delta) FROM base, shift
),
cats AS ({" UNION ALL ".join(f"SELECT '{c}' AS name, ref, coalesce({c}, '__NULL__') AS cat FROM both_periods" for c in C.DRIFT_CATEGORICAL)}),
{NUMERIC_SQL.strip()},
{CATEGORY_SQL.strip()},
drift AS (
  SELECT feature_name, CASE WHEN feature_name = 'score_fraude' THEN 'PREDICTION' ELSE 'NUMERIC' END AS feature_type, psi, ks_statistic, ks_pvalue FROM numeric_result
  UNION ALL SELECT feature_name, 'CATEGORICAL', psi, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM category_result
)"""


@query(
    "stress_test_drift",
    "F6 J6 J9 J10 J11",
    O.with_(STRESS_SQL) + f"SELECT feature_name, feature_type, round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, {STATUS_SQL} AS drift_status FROM drift",
)
def stress_test_drift(spark, folder):
    """The baseline execution against its shifted copy: the whole monitoring flow."""
    result = MO.stress_test(A.published_scores(spark, folder), A.scoring_input(spark, folder), bucket=D.sha_bucket())
    return six(result.drift, "psi", "ks_statistic", "ks_pvalue")


# --- models ----------------------------------------------------------------------------------------------


def training_input(spark: SparkSession, folder: str) -> DataFrame:
    return A.claims(spark, folder).drop("score_formula", "lote")


@query("model_comparison", "H1 H2 H3 H4 H5 H6 H7 H8 H9 E1")
def model_comparison(spark, folder):
    """Three classifiers on the time split; areas on the test rows."""
    return TR.train(training_input(spark, folder)).metrics


@query("trained_model_lift", "H5 H9 D8 E3 B29")
def trained_model_lift(spark, folder):
    return TR.train(training_input(spark, folder), names=["random_forest"]).lift


@query(
    "saved_model_equivalence",
    "H10 D11 B21 B31",
    "SELECT count(*) - CAST(floor(count(*) * 75e-2) AS BIGINT) AS registros_comparados, CAST(0 AS BIGINT) AS predicciones_diferentes, 0e0 AS max_diferencia_score FROM orders",
)
def saved_model_equivalence(spark, folder):
    """Fit, save, load, and compare both models on all test claims by business key."""
    tagged = TR.split_frame(training_input(spark, folder))
    rows = tagged.withColumns({f: F.col(f).cast("double") for f in C.FEATURES})
    fitted = MD.fit_all(rows.filter("tramo = 'TRAIN'"), rows.filter("tramo = 'TEST'"), names=["random_forest"])[0]
    path = run_folder(spark, "model")
    MD.save_model(fitted.model, path)
    return MD.model_equivalence(fitted.model, MD.load_model(path), rows.filter("tramo = 'TEST'"))


# A linear model with given numbers, as a saved one would give them: weight and fill value of each feature.
LINEAR = MD.LinearModel(
    tuple(C.FEATURES), tuple(((-1) ** i) * 0.01 * (i + 1) / (1000.0 if "reserva" in f else 10.0) for i, f in enumerate(C.FEATURES)), tuple(float(i) for i in range(len(C.FEATURES))), -0.25
)
# The feature table of the SQL twins holds the logarithm rounded.
_UNROUNDED = {"log_reserva_inicial": 'ln(1e0 + CASE WHEN "Sum_Valor_Reservas_Inicial" > 0 THEN "Sum_Valor_Reservas_Inicial" ELSE 0e0 END)'}
_LINEAR_SUM = " + ".join(f"({w!r}) * coalesce({_UNROUNDED.get(f, f)}, {m!r})" for f, w, m in zip(LINEAR.features, LINEAR.weights, LINEAR.fill))


@query(
    "batch_scored_by_model",
    "H4 H11 H12 B29 I3 I6 A6 C2",
    O.with_(O.FEATURES)
    + f""", scored AS (SELECT id_reclamacion, 1e0 / (1e0 + exp(-({LINEAR.intercept!r} + {_LINEAR_SUM}))) AS score_fraude FROM features)
SELECT id_reclamacion, round(score_fraude, 6) AS score_fraude, {O.level("score_fraude")} AS nivel_riesgo, 'm:1' AS version_modelo, 'SUCCESS' AS estado FROM scored""",
)
def batch_scored_by_model(spark, folder):
    """A linear model as column expression, published by the scoring flow; its run's state from the audit table."""
    tables = _tables(spark)
    source = write_and_read(A.scoring_input(spark, folder), run_folder(spark, "input"))
    score_batch(source, LINEAR, "m:1", tables, run_id="run-lineal")
    runs = spark.table(tables.runs).select("id_ejecucion", "estado")
    # One audit row per run.
    joined = spark.table(tables.scores).join(F.broadcast(runs), "id_ejecucion")
    return six(joined.select(C.KEY, "score_fraude", "nivel_riesgo", "version_modelo", "estado"), "score_fraude")


_BAD_DATE = "CAST(id_reclamacion AS BIGINT) % 89 = 0"


def _no_value(feature: str) -> str:
    """A feature is missing, also because the loss date it needs cannot be read."""
    base = f'"{feature}" IS NULL OR isnan("{feature}")'
    return f"{base} OR {_BAD_DATE}" if "siniestro" in feature else base


@query(
    "batch_quality",
    "B2 D3 B30",
    O.with_(O.FEATURES)
    + "\nUNION ALL ".join(f"SELECT 'FEATURE' AS clase, '{f}' AS columna, count(CASE WHEN {_no_value(f)} THEN 1 END) AS casos FROM features" for f in C.FEATURES)
    + "".join(f"\nUNION ALL SELECT 'DATE', '{d}', {f'count(CASE WHEN {_BAD_DATE} THEN 1 END)' if d == 'FSINIESTRO' else 'count(*) - count(*)'} FROM features" for d in C.SCORING_DATES),
)
def batch_quality_query(spark, folder):
    """A batch whose loss date came as text, here and there unreadable: what a scoring run would miss."""
    claims = A.scoring_input(spark, folder)
    bad = F.col(C.KEY).cast("long") % 89 == 0
    return batch_quality(claims.withColumn("FSINIESTRO", F.when(bad, "31/31/1999").otherwise(F.col("FSINIESTRO").cast("string"))))


@query(
    "model_risk_summary",
    "D10 B15 B16 B29 H11",
    O.with_(O.FEATURES)
    + f""", scored AS (SELECT 1e0 / (1e0 + exp(-({LINEAR.intercept!r} + {_LINEAR_SUM}))) AS s FROM features), leveled AS (SELECT s, {O.level("s")} AS nivel_riesgo FROM scored)
SELECT nivel_riesgo, {O.action("nivel_riesgo")} AS accion_sugerida, count(*) AS casos, round(avg(s), 6) AS score_promedio, round(min(s), 6) AS score_minimo, round(max(s), 6) AS score_maximo
FROM leveled GROUP BY 1""",
)
def model_risk_summary(spark, folder):
    """Claims, all features, a linear model over them, level and action, summary: the flow in one plan."""
    scored = LINEAR(FE.scoring_frame(A.scoring_input(spark, folder)))
    rows = score_rows(scored, "m:1", "run-resumen", datetime(2026, 1, 1))
    return six(RP.risk_summary(rows), "score_promedio", "score_minimo", "score_maximo")


@query(
    "refused_models",
    "I3 I5 H11",
    "SELECT 'run-orden' AS id_ejecucion, 'FAILED' AS estado, 0 AS registros_exitosos, 'features are not in the approved order' AS mensaje_error "
    "UNION ALL SELECT 'run-resto', 'FAILED', 0, 'approved features are missing: [''" + C.FEATURES[-1] + "'']'",
)
def refused_models(spark, folder):
    """A model whose inputs are in another order, and one that lacks one: both runs fail and publish nothing."""
    tables = _tables(spark)
    source = A.scoring_input(spark, folder)
    turned = MD.LinearModel(LINEAR.features[::-1], LINEAR.weights[::-1], LINEAR.fill[::-1], LINEAR.intercept)
    short = MD.LinearModel(LINEAR.features[:-1], LINEAR.weights[:-1], LINEAR.fill[:-1], LINEAR.intercept)
    for model, run_id in ((turned, "run-orden"), (short, "run-resto")):
        try:
            score_batch(source, model, "m:1", tables, run_id=run_id)
        except ValueError:
            pass  # the audit row tells
    return spark.table(tables.runs).select("id_ejecucion", "estado", F.col("registros_exitosos").cast("int").alias("registros_exitosos"), "mensaje_error")


@query(
    "feature_medians",
    "H1 D17",
    O.with_(O.FEATURES)
    + "\nUNION ALL ".join(f"SELECT '{f}' AS feature, quantile_disc({f}, 0.5) AS mediana FROM features" for f in C.FEATURES if f != "log_reserva_inicial")
    + "\nUNION ALL SELECT 'log_reserva_inicial', round(quantile_disc(log_reserva_inicial, 0.5), 6) FROM features",
)
def feature_medians(spark, folder):
    """Fill values of the imputer: exact medians of all features from the same passes."""
    stored = write_and_read(FE.scoring_frame(A.scoring_input(spark, folder)).select(*C.FEATURES), run_folder(spark, "features"))
    medians = MD.exact_medians(stored, C.FEATURES)
    return spark.createDataFrame([(f, round(m, 6)) for f, m in medians.items()], "feature string, mediana double")


AREAS = f"""{O.LABELLED},
points AS (SELECT periodo, score_fraude AS s, sum(label) AS pos, sum(1 - label) AS neg FROM
  (SELECT *, CASE WHEN "FSINIESTRO" < DATE '1998-05-01' THEN 'REFERENCIA' ELSE 'ACTUAL_4_MESES' END AS periodo FROM labelled) AS l GROUP BY 1, 2),
curve AS (
  SELECT *, sum(pos) OVER (PARTITION BY periodo ORDER BY s DESC) AS tp, sum(neg) OVER (PARTITION BY periodo ORDER BY s DESC) AS fp,
         sum(pos) OVER (PARTITION BY periodo) AS p, sum(neg) OVER (PARTITION BY periodo) AS n FROM points
),
areas AS (
  SELECT periodo, CAST(max(p) AS BIGINT) AS positivos, CAST(max(n) AS BIGINT) AS negativos,
         sum(neg * (tp - pos + pos / 2)) / (max(p) * max(n)) AS roc_auc,
         sum(pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN tp / (tp + fp) ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2) / max(p) AS area_under_pr
  FROM curve GROUP BY periodo
)"""


def period_areas(spark, folder) -> DataFrame:
    tag = F.when(F.col("FSINIESTRO") < A.PERIOD_START, C.REFERENCE).otherwise(C.CURRENT)
    rows = labelled(spark, folder).select("label", "score_fraude", tag.alias("periodo"))
    return EV.curve_areas(write_and_read(rows, run_folder(spark, "areas")), by=["periodo"])


@query(
    "exact_curve_areas",
    "H8",
    O.with_(AREAS) + "SELECT periodo, positivos, negativos, round(roc_auc, 6) AS roc_auc, round(area_under_pr, 6) AS area_under_pr FROM areas",
)
def exact_curve_areas(spark, folder):
    return six(period_areas(spark, folder), "roc_auc", "area_under_pr")


LOSS = f"""{AREAS},
long AS (SELECT 'roc_auc' AS metrica, periodo, roc_auc AS v FROM areas UNION ALL SELECT 'area_under_pr', periodo, area_under_pr FROM areas),
pair AS (SELECT metrica, max(CASE WHEN periodo = 'REFERENCIA' THEN v END) AS referencia, max(CASE WHEN periodo <> 'REFERENCIA' THEN v END) AS actual FROM long GROUP BY 1),
loss AS (SELECT *, (referencia - actual) / referencia AS perdida_relativa FROM pair),
losses AS (SELECT *, CASE WHEN perdida_relativa > 0.1 THEN 'CRITICO' WHEN perdida_relativa > 0.05 THEN 'ADVERTENCIA' ELSE 'ESTABLE' END AS estado FROM loss)"""


@query(
    "period_area_loss",
    "L4 C5",
    O.with_(LOSS) + "SELECT metrica, round(referencia, 6) AS referencia, round(actual, 6) AS actual, round(perdida_relativa, 6) AS perdida_relativa, estado FROM losses",
)
def period_area_loss(spark, folder):
    out = EV.relative_loss(period_areas(spark, folder), "periodo", C.REFERENCE, C.CURRENT)
    return six(out, "referencia", "actual", "perdida_relativa")


@query(
    "threshold_quality",
    "L5",
    O.with_(O.LABELLED)
    + f""", c AS (SELECT "REGIONAL", count(CASE WHEN label = 1 AND score_fraude >= {O.HIGH} THEN 1 END) AS vp, count(CASE WHEN label <> 1 AND score_fraude >= {O.HIGH} THEN 1 END) AS fp,
count(CASE WHEN label = 1 AND score_fraude < {O.HIGH} THEN 1 END) AS fn, count(CASE WHEN label <> 1 AND score_fraude < {O.HIGH} THEN 1 END) AS vn FROM labelled GROUP BY 1)
SELECT "REGIONAL", vp, fp, fn, vn, round(CAST(vp AS DOUBLE) / (vp + fp), 6) AS precision, round(CAST(vp AS DOUBLE) / (vp + fn), 6) AS recall, round(CAST(fp AS DOUBLE) / (fp + vn), 6) AS tasa_falsos_positivos FROM c""",
)
def threshold_quality(spark, folder):
    out = EV.threshold_metrics(labelled(spark, folder), C.Thresholds().high, by=["REGIONAL"])
    return six(out, "precision", "recall", "tasa_falsos_positivos")


@query(
    "brier_by_channel",
    "L6 L7",
    O.with_(O.LABELLED) + 'SELECT "Nombre_Canal_Comercial", count(*) AS casos, round(avg((score_fraude - label) * (score_fraude - label)), 6) AS brier FROM labelled GROUP BY 1',
)
def brier_by_channel(spark, folder):
    return six(EV.brier(labelled(spark, folder), by=["Nombre_Canal_Comercial"]), "brier")


@query(
    "calibration_bins",
    "L6",
    O.with_(O.LABELLED)
    + """SELECT CAST(least(floor(score_fraude * 10), 9) AS INTEGER) AS tramo_score, count(*) AS casos, round(avg(score_fraude), 6) AS score_promedio, round(avg(label), 6) AS tasa_observada
FROM labelled GROUP BY 1""",
)
def calibration_bins(spark, folder):
    return six(EV.calibration(labelled(spark, folder)), "score_promedio", "tasa_observada")


@query(
    "flagged_rate_change",
    "L2 D14",
    O.with_(PERIODS)
    + """, r AS (SELECT 1e2 * avg(CASE WHEN periodo = 'REFERENCIA' THEN marcado_fraude END) AS a, 1e2 * avg(CASE WHEN periodo <> 'REFERENCIA' THEN marcado_fraude END) AS b FROM periods)
SELECT round(a, 6) AS referencia, round(b, 6) AS actual, round((b - a) / a, 6) AS cambio_relativo,
CASE WHEN (b - a) / a > 0.4 THEN 'CRITICO' WHEN (b - a) / a > 0.2 THEN 'ADVERTENCIA' ELSE 'ESTABLE' END AS estado FROM r""",
)
def flagged_rate_change(spark, folder):
    return six(RP.flagged_rate_change(formula_period_scores(spark, folder)), "referencia", "actual", "cambio_relativo")


@query(
    "volume_change",
    "L3 D1",
    O.with_(PERIODS)
    + """, r AS (SELECT count(CASE WHEN periodo = 'REFERENCIA' THEN 1 END) AS a, count(CASE WHEN periodo <> 'REFERENCIA' THEN 1 END) AS b FROM periods)
SELECT a AS referencia, b AS actual, round(CAST(b - a AS DOUBLE) / a, 6) AS cambio_relativo, CASE WHEN abs(CAST(b - a AS DOUBLE) / a) > 0.2 THEN 'ADVERTENCIA' ELSE 'ESTABLE' END AS estado FROM r""",
)
def volume_change(spark, folder):
    return six(RP.volume_change(formula_period_scores(spark, folder)), "cambio_relativo")


def policy_values(name: str) -> str:
    """A policy table as a common table expression."""
    schema, rows = P.policies()[name]
    return f"{name}({', '.join(c.split()[0] for c in schema.split(', '))}) AS (VALUES {_values(rows)})"


def stored_policy(spark: SparkSession, name: str) -> DataFrame:
    """A policy table as it comes back from the catalog, written over another version of itself."""
    with passing_schema(spark) as schema:
        full = f"{schema}.{name}"
        overwrite(P.policy(spark, name).withColumn("number", F.col("number") + 100).withColumn("draft", F.lit(True)), full)
        overwrite(P.policy(spark, name), full)
        kept = P.read_policy(spark, full)
        # A few rows of rules: they outlive the table.
        return spark.createDataFrame(kept.collect(), kept.schema)


@query(
    "policy_tables",
    "A5 A8 G8",
    f"""WITH {", ".join(policy_values(n) for n in P.policies())}
SELECT 'monitoring_metric_policy' AS policy, number, metric AS name, critical AS bound FROM monitoring_metric_policy
UNION ALL SELECT 'retraining_decision_policy', number, rule, bound FROM retraining_decision_policy
UNION ALL SELECT 'score_interface_contract', number, field_name, CAST(CASE WHEN required THEN 1 ELSE 0 END AS DOUBLE) FROM score_interface_contract
UNION ALL SELECT 'score_error_contract', number, reason_code, CAST(http_status AS DOUBLE) FROM score_error_contract""",
)
def policy_tables(spark, folder):
    """All policy tables written, overwritten with another schema, and read back."""
    parts = {
        "monitoring_metric_policy": ("metric", F.col("critical")),
        "retraining_decision_policy": ("rule", F.col("bound")),
        "score_interface_contract": ("field_name", F.col("required").cast("double")),
        "score_error_contract": ("reason_code", F.col("http_status").cast("double")),
    }
    frames = [
        stored_policy(spark, table).select(F.lit(table).alias("policy"), "number", F.col(name).alias("name"), bound.alias("bound"))
        for table, (name, bound) in parts.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query(
    "retraining_advice",
    "L10 A8 G8",
    O.with_(DRIFT_SQL, "\n".join(LOSS.split(f"{O.CLAIMS},", 1)[1:]).strip())
    + f""", {policy_values("retraining_decision_policy")},
facts AS (
  SELECT (SELECT count(*) FROM drift_status WHERE feature_type <> 'PREDICTION' AND drift_status IN ('DRIFT_CRITICO', 'ADVERTENCIA')) AS features_drifted,
         (SELECT count(*) FROM drift_status WHERE feature_type = 'PREDICTION' AND drift_status = 'DRIFT_CRITICO') AS score_critical,
         (SELECT count(*) FROM losses WHERE estado = 'CRITICO') AS losses_critical, (SELECT count(*) FROM losses WHERE estado = 'ADVERTENCIA') AS losses_warning,
         (SELECT count(*) FROM cat_counts WHERE rn = 0 AND cn > 0) AS new_categories
), named AS (UNPIVOT facts ON * INTO NAME fact VALUE n)
SELECT facts.*, rule, retrain, bool_and(CASE comparison WHEN '=' THEN n = bound WHEN '>' THEN n > bound END) AS fires
FROM retraining_decision_policy JOIN named USING (fact), facts GROUP BY ALL""",
)
def retraining_advice(spark, folder):
    """Every stored rule judged by the drift, the losses and the new categories of the two periods."""
    losses = EV.relative_loss(period_areas(spark, folder), "periodo", C.REFERENCE, C.CURRENT)
    categories = D.category_counts(formula_period_features(spark, folder), C.DRIFT_CATEGORICAL, F.col("periodo") == C.REFERENCE)
    return MO.retraining_advice(formula_drift(spark, folder).drift, losses, categories, stored_policy(spark, "retraining_decision_policy"))


@query(
    "metric_policy_status",
    "A8 G8",
    O.with_(DRIFT_SQL)
    + f""", {policy_values("monitoring_metric_policy")},
measured AS (
  SELECT CASE WHEN feature_type = 'PREDICTION' THEN 'score_psi' ELSE 'psi' END AS metric, psi AS value FROM drift_status
  UNION ALL SELECT 'ks', ks_statistic FROM drift_status
)
SELECT number, p.metric, layer, warning, critical, count(CASE WHEN value >= critical THEN 1 END) AS criticos,
       count(CASE WHEN value >= warning AND value < critical THEN 1 END) AS advertencias
FROM monitoring_metric_policy AS p LEFT JOIN measured ON p.metric = measured.metric GROUP BY ALL""",
)
def metric_policy_status(spark, folder):
    """The stored limits with the features that reach them."""
    return MO.policy_status(formula_drift(spark, folder).drift, stored_policy(spark, "monitoring_metric_policy"))


# --- contracts and the scoring flow -----------------------------------------------------------------------


def _incoming(spark, folder) -> DataFrame:
    """Claims as received, with faults: lines of one order are copies of one claim, the loss date
    as text is sometimes unreadable, keys are sometimes blank, reserves sometimes negative."""
    key = F.col("l_orderkey")
    return scan(spark, "lineitem", folder).select(
        F.when(key % 97 == 0, "  ").otherwise(key.cast("string")).alias(C.KEY),
        F.when(key % 89 == 0, "31/31/1999").otherwise(F.lit("1999-12-31")).alias("FSINIESTRO"),
        (18 + key % 60).cast("int").alias("edad_ingreso_asegurado"),
        F.lit(1).alias("vigencia_poliza"),
        F.lit(1).alias("vigencia_certificado"),
        F.when(key % 83 == 0, -1.0).when(key % 5 == 0, F.col("l_linenumber").cast("double")).otherwise(100.0).alias("Sum_Valor_Reservas_Inicial"),
        F.col("l_linenumber"),
    )


_INCOMING_COLUMNS = [C.KEY, "FSINIESTRO", "edad_ingreso_asegurado", "vigencia_poliza", "vigencia_certificado", "Sum_Valor_Reservas_Inicial"]


@query(
    "quarantine_reasons",
    "L8 A8",
    f"""WITH t AS (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN '  ' ELSE CAST(l_orderkey AS VARCHAR) END AS k, l_orderkey % 89 = 0 AS bad_date,
         CAST(18 + l_orderkey % 60 AS INTEGER) AS age,
         CASE WHEN l_orderkey % 83 = 0 THEN -1e0 WHEN l_orderkey % 5 = 0 THEN CAST(l_linenumber AS DOUBLE) ELSE 1e2 END AS reserve
  FROM lineitem
), c AS (SELECT k FROM t GROUP BY k HAVING count(DISTINCT (bad_date, age, reserve)) > 1),
r AS (
  SELECT CASE WHEN trim(t.k) = '' OR bad_date THEN 'INVALID_SCHEMA' WHEN c.k IS NOT NULL THEN 'IDEMPOTENCY_CONFLICT'
              WHEN reserve < 0 THEN 'INVALID_VALUES' ELSE 'SUCCESS' END AS reason_code
  FROM t LEFT JOIN c ON t.k = c.k
), {policy_values("score_error_contract")}
SELECT r.reason_code, http_status, retry_allowed, count(*) AS casos FROM r JOIN score_error_contract AS p ON r.reason_code = p.reason_code GROUP BY 1, 2, 3""",
)
def quarantine_reasons(spark, folder):
    """Reasons counted and joined with the error contract."""
    counted = RP.count_by(K.quarantine(_incoming(spark, folder), _INCOMING_COLUMNS), "reason_code")
    errors = F.broadcast(stored_policy(spark, "score_error_contract").select("reason_code", "http_status", "retry_allowed"))
    return counted.join(errors, "reason_code").select("reason_code", "http_status", "retry_allowed", "casos")


@query(
    "interface_contract_check",
    "L9 A8",
    O.with_(O.HISTORY)
    + " UNION ALL ".join(
        f"""SELECT {i + 1} AS number, '{name}' AS field_name, '{kind}' AS agreed_type, '{kind}' AS found_type, {str(name not in C.OPTIONAL_RESPONSE).lower()} AS required,
count(CASE WHEN {name} IS NULL THEN 1 END) AS nulls, 'OK' AS contract_status FROM view"""
        for i, (name, kind) in enumerate(C.RESPONSE_FIELDS.items())
    ),
)
def interface_contract_check(spark, folder):
    contract = stored_policy(spark, "score_interface_contract").collect()
    return K.interface_check(RP.consumer_view(A.score_history(spark, folder)), contract)


def _tables(spark: SparkSession) -> ScoringTables:
    """New tables of the scoring flow, below a folder of their own."""
    location = run_folder(spark, "scoring")
    name = location.rsplit("-", 1)[-1][:12]
    return ScoringTables(f"scores_{name}", f"stage_{name}", f"runs_{name}", location)


def _flow(spark: SparkSession, folder: str) -> ScoringTables:
    """Runs of the scoring flow with the formula score: lots 0 and 1; all (only lot 2 is new); all again (nothing new);
    all with a second version; then the first run repeated, its id with another version, and lot 2 twice in one batch."""
    tables = _tables(spark)
    source = write_and_read(A.scoring_input(spark, folder), f"{tables.location}/input")

    def scorer(df: DataFrame) -> DataFrame:
        return df.withColumn("score_fraude", F.col("score_formula"))

    score_batch(source.filter("lote < 2"), scorer, "m:1", tables, run_id="run-a")
    score_batch(source, scorer, "m:1", tables, run_id="run-b")
    score_batch(source, scorer, "m:1", tables, run_id="run-c")
    score_batch(source, scorer, "m:2", tables, run_id="run-d")
    score_batch(source.filter("lote < 2"), scorer, "m:1", tables, run_id="run-a")
    twice = source.filter("lote = 2").unionByName(source.filter("lote = 2"))
    for rows, run_id in ((source, "run-a"), (twice, "run-f")):
        try:
            score_batch(rows, scorer, "m:3", tables, run_id=run_id)
        except ValueError:
            pass  # the audit row tells
    return tables


@query(
    "scoring_flow_runs",
    "A6 A7 A9 A11 C2 D16 G3 G4 I1 I2 I3 I4 I5 I6",
    """WITH n AS (SELECT count(CASE WHEN o_orderkey % 3 < 2 THEN 1 END) AS a, count(CASE WHEN o_orderkey % 3 = 2 THEN 1 END) AS b, count(*) AS d FROM orders)
SELECT 'run-a' AS id_ejecucion, 'm:1' AS version_modelo, a AS registros_entrada, a AS registros_exitosos, a - a AS registros_error, 'SUCCESS' AS estado FROM n
UNION ALL SELECT 'run-b', 'm:1', b, b, b - b, 'SUCCESS' FROM n UNION ALL SELECT 'run-c', 'm:1', a - a, a - a, a - a, 'NO_DATA' FROM n
UNION ALL SELECT 'run-d', 'm:2', d, d, d - d, 'SUCCESS' FROM n UNION ALL SELECT 'run-a@m:3', 'm:3', a - a, a - a, a - a, 'FAILED' FROM n
UNION ALL SELECT 'run-f', 'm:3', 2 * b, a - a, 2 * b, 'FAILED' FROM n""",
)
def scoring_flow_runs(spark, folder):
    tables = _flow(spark, folder)
    return spark.table(tables.runs).select("id_ejecucion", "version_modelo", "registros_entrada", "registros_exitosos", "registros_error", "estado")


@query(
    "scoring_flow_scores",
    "A6 C2 D10 G3",
    O.with_(O.ORDER_SCORES)
    + f""", published AS (
  SELECT *, 'm:1' AS version_modelo, CASE WHEN lote < 2 THEN 'run-a' ELSE 'run-b' END AS id_ejecucion FROM order_scores
  UNION ALL SELECT *, 'm:2', 'run-d' FROM order_scores)
SELECT id_reclamacion, score_fraude, {O.level("score_fraude")} AS nivel_riesgo, version_modelo, id_ejecucion FROM published""",
)
def scoring_flow_scores(spark, folder):
    tables = _flow(spark, folder)
    return spark.table(tables.scores).select(C.KEY, "score_fraude", "nivel_riesgo", "version_modelo", "id_ejecucion")


# --- governance ----------------------------------------------------------------------------------------------


@query("alias_state", "K2 K11 E4", O.with_(O.MODEL_EVENTS) + "SELECT * FROM alias_state")
def alias_state(spark, folder):
    return G.alias_state(A.model_events(spark, folder))


@query(
    "event_history",
    "K1 K12 B28",
    O.with_(O.MODEL_EVENTS) + "SELECT event_id, event_timestamp, action, previous_version, target_version, model_alias, validation_status, approved_by, reason FROM model_events",
)
def event_history(spark, folder):
    return G.event_history(A.model_events(spark, folder))


@query("event_metadata_json", "B28", O.with_(O.MODEL_EVENTS) + "SELECT event_id, metadata_json FROM model_events")
def event_metadata_json(spark, folder):
    return A.model_events(spark, folder).select("event_id", "metadata_json")


@query(
    "event_log_merged",
    "K1 G5 G6 B32",
    O.with_(O.MODEL_EVENTS)
    + """SELECT event_id, event_timestamp, CASE WHEN action = 'PROMOTE' THEN 'revisado' ELSE reason END AS reason, target_version, model_name, action, approved_by FROM model_events
UNION ALL SELECT 'evt-' || CAST(event_id AS VARCHAR), CAST(ts AS TIMESTAMP), 'nuevo: ' || event_type, CAST(NULL AS VARCHAR), 'vistas', 'VIEW', CAST(NULL AS VARCHAR) FROM events WHERE event_type = 'view'""",
)
def event_log_merged(spark, folder):
    """The log after a merge: promotions come again with a new reason and another action, which is not renewed; views come in as new events."""
    log = A.model_events(spark, folder)
    changed = log.filter("action = 'PROMOTE'").withColumns({"reason": F.lit("revisado"), "action": F.lit("OTHER")})
    given = {
        "event_id": F.concat(F.lit("evt-"), F.col("event_id").cast("string")),
        "event_timestamp": F.col("ts").cast("timestamp"),
        "model_name": F.lit("vistas"),
        "action": F.lit("VIEW"),
        "reason": F.concat(F.lit("nuevo: "), F.col("event_type")),
    }
    new = scan(spark, "events", folder).filter("event_type = 'view'").select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in log.columns])
    merged = G.record_events(log, changed.unionByName(new))
    return merged.select("event_id", "event_timestamp", "reason", "target_version", "model_name", "action", "approved_by")


@query(
    "newest_ready_version",
    "K3",
    O.with_(O.MODEL_VERSIONS) + "SELECT model_name, max(CAST(version AS INTEGER)) AS version FROM model_versions WHERE status = 'READY' GROUP BY 1",
)
def newest_ready_version(spark, folder):
    return G.newest_ready(A.model_versions(spark, folder))


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_ORDER_TEXT = ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in _ORDER_COLUMNS)


@query(
    "manifest_facts",
    "K4 B19 B28",
    f"""SELECT count(*) AS source_table_version,
CAST(CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {_ORDER_TEXT})), 1, 16) AS UBIGINT)) AS HUGEINT) % 18446744073709551616 AS VARCHAR) AS source_content_digest,
'{{"max_depth":6,"num_trees":50,"seed":42}}' AS parameters_json, 42 AS random_seed, 'PARTIAL' AS reproducibility_status FROM orders""",
)
def manifest_facts(spark, folder):
    """A manifest of the orders: its digest changes with any value, with a row lost and with a row repeated."""
    orders = scan(spark, "orders", folder).select(*_ORDER_COLUMNS)
    row = G.manifest(orders, "manifest-1", C.DEFAULT_MODEL, "1", {"max_depth": 6, "num_trees": 50, "seed": 42}, {"roc_auc": 0.78}, datetime(2026, 1, 1), "orders")
    return row.select("source_table_version", "source_content_digest", "parameters_json", "random_seed", "reproducibility_status")


@query(
    "new_candidates",
    "K5",
    O.with_(O.MODEL_VERSIONS)
    + """SELECT model_name, git_commit AS marker, version FROM model_versions AS w WHERE git_commit IS NOT NULL AND CAST(version AS INTEGER) > 6
AND NOT EXISTS (SELECT 1 FROM model_versions AS e WHERE e.model_name = w.model_name AND e.git_commit = w.git_commit AND CAST(e.version AS INTEGER) <= 9)""",
)
def new_candidates(spark, folder):
    v = A.model_versions(spark, folder).withColumnRenamed("git_commit", "marker")
    number = F.col("version").cast("int")
    wanted = v.filter(F.col("marker").isNotNull() & (number > 6)).select("model_name", "marker", "version")
    return G.new_candidates(wanted, v.filter(number <= 9))


def _gate(name: str, ok: str, observed: str, required: str, otherwise: str = "FAIL") -> str:
    return (
        f"SELECT model_name, champion_version, candidate_version, '{name}' AS gate_name, CASE WHEN {ok} THEN 'PASS' ELSE '{otherwise}' END AS gate_status, "
        f"coalesce({observed}, 'None') AS observed_value, {required} AS required_value FROM pairs"
    )


def _figure(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18, 6)) AS VARCHAR)"


_GATES = [
    _gate("MODEL_READY", "status = 'READY'", "status", "'READY'"),
    _gate("SEPARATE_FROM_CHAMPION", "candidate_version <> champion_version", "candidate_version", "'not ' || coalesce(champion_version, 'None')"),
    _gate("RUN_FINISHED", "run_status = 'FINISHED'", "run_status", "'FINISHED'"),
    _gate("MIN_ROC_AUC", "roc_auc >= 75e-2", _figure("roc_auc"), "'>= 0.75'"),
    _gate("MIN_AREA_UNDER_PR", "area_under_pr >= 55e-2", _figure("area_under_pr"), "'>= 0.55'"),
    _gate("MIN_TOP20_CAPTURE", "top20_capture >= 35e-2", _figure("top20_capture"), "'>= 0.35'"),
    _gate("MAX_ROC_DEGRADATION", "roc_auc - champion_roc_auc >= -2e-2", _figure("roc_auc - champion_roc_auc"), "'>= -0.02'"),
    _gate("RANDOM_SEED_REGISTERED", "seed IS NOT NULL", "CAST(seed AS VARCHAR)", "'required'"),
    _gate("CODE_VERSION_REGISTERED", "git_commit <> ''", "CASE WHEN git_commit <> '' THEN git_commit ELSE 'NO_REGISTRADO' END", "'required'", "WARNING"),
]
PAIRS = f"""{O.MODEL_EVENTS},
{O.MODEL_VERSIONS.strip()},
newest AS (SELECT model_name, max(CAST(version AS INTEGER)) AS v FROM model_versions GROUP BY 1),
pairs AS (
  SELECT c.model_name, s.version AS champion_version, c.version AS candidate_version, c.status, c.run_status, c.roc_auc, c.area_under_pr, c.top20_capture,
         b.roc_auc AS champion_roc_auc, b.area_under_pr AS champion_area_under_pr, b.top20_capture AS champion_top20_capture, c.seed, c.git_commit
  FROM model_versions AS c JOIN newest ON newest.model_name = c.model_name AND newest.v = CAST(c.version AS INTEGER)
  LEFT JOIN alias_state AS s ON s.model_name = c.model_name AND s.model_alias = 'Champion'
  LEFT JOIN model_versions AS b ON b.model_name = c.model_name AND b.version = s.version
),
gates AS (
  {"""
  UNION ALL """.join(_GATES)}
),
decisions AS (
  SELECT model_name, candidate_version, count(CASE WHEN gate_status = 'FAIL' THEN 1 END) AS fallos, count(CASE WHEN gate_status = 'WARNING' THEN 1 END) AS advertencias,
         CASE WHEN count(CASE WHEN gate_status = 'FAIL' THEN 1 END) > 0 THEN 'FAIL' WHEN count(CASE WHEN gate_status = 'WARNING' THEN 1 END) > 0 THEN 'PASS_WITH_EXCEPTION' ELSE 'PASS' END AS decision
  FROM gates GROUP BY 1, 2
)"""


_METRICS = ["roc_auc", "area_under_pr", "top20_capture"]


def candidate_pairs(spark, folder) -> DataFrame:
    """The newest version of each model next to its champion, or alone where the model has none."""
    versions = A.model_versions(spark, folder)
    newest = versions.groupBy("model_name").agg(F.max(G.as_int("version")).alias("v"))
    champion = G.alias_state(A.model_events(spark, folder)).filter(F.col("model_alias") == G.CHAMPION)
    champion = champion.select("model_name", F.col("version").alias("champion_version"))
    base = versions.select("model_name", F.col("version").alias("champion_version"), *[F.col(m).alias(f"champion_{m}") for m in _METRICS])
    return (
        versions.join(newest, "model_name")
        .filter(G.as_int("version") == F.col("v"))
        .drop("v")
        .withColumnRenamed("version", "candidate_version")
        .join(champion, "model_name", "left")
        .join(base, ["model_name", "champion_version"], "left")
    )


def candidate_gates(spark, folder) -> DataFrame:
    return G.gate_results(candidate_pairs(spark, folder), F.lit("2026-01-01").cast("timestamp"))


@query("validation_gates", "K6 A12", O.with_(PAIRS) + "SELECT * FROM gates")
def validation_gates(spark, folder):
    return candidate_gates(spark, folder).select(
        "model_name", "champion_version", "candidate_version", "gate_name", "gate_status", "observed_value", "required_value"
    )


@query("gate_decisions", "K7", O.with_(PAIRS) + "SELECT * FROM decisions")
def gate_decisions(spark, folder):
    return G.gate_decision(candidate_gates(spark, folder))


@query(
    "gate_results_merged",
    "K8 G6",
    O.with_(PAIRS)
    + "SELECT model_name || '-v' || candidate_version || '-' || gate_name AS validation_id, gate_name, gate_status, observed_value, required_value, 'nuevo' AS details FROM gates",
)
def gate_results_merged(spark, folder):
    """Stored results of half of the gates, all PASS, after a merge of the present results."""
    now = candidate_gates(spark, folder).withColumn("details", F.lit("nuevo"))
    stored = now.filter(F.col("validation_id").contains("-M")).withColumns(
        {"gate_status": F.lit("PASS"), "observed_value": F.lit("antes"), "details": F.lit("viejo")}
    )
    return G.record_gates(stored, now).select("validation_id", "gate_name", "gate_status", "observed_value", "required_value", "details")


@query(
    "latest_candidate_report",
    "D20 F3 K6",
    O.with_(PAIRS) + "SELECT model_name, candidate_version, gate_name, gate_status, observed_value, required_value FROM gates",
)
def latest_candidate_report(spark, folder):
    """Gate rows of all versions; those of the newest stay. Versions 9, 10 and 12 exist side by side, so a text maximum would pick the wrong one."""
    newest = candidate_pairs(spark, folder)
    champions = newest.select("model_name", "champion_version", *[f"champion_{m}" for m in _METRICS])
    everyone = A.model_versions(spark, folder).withColumnRenamed("version", "candidate_version").join(champions, "model_name")
    gates = G.gate_results(everyone, F.lit("2026-01-01").cast("timestamp"))
    return G.latest_candidate_report(gates).drop("details")


@query(
    "promotion_decisions",
    "K9",
    O.with_(PAIRS)
    + """SELECT p.model_name, p.champion_version, p.candidate_version, decision,
CASE WHEN p.champion_version = p.candidate_version THEN 'NO_CHANGE' WHEN decision = 'FAIL' THEN 'BLOCKED' ELSE 'PROMOTE' END AS resultado
FROM pairs AS p JOIN decisions AS d ON p.model_name = d.model_name AND p.candidate_version = d.candidate_version""",
)
def promotion_decisions(spark, folder):
    return decided_pairs(spark, folder)


def decided_pairs(spark, folder) -> DataFrame:
    pairs = candidate_pairs(spark, folder).select("model_name", "champion_version", "candidate_version")
    decided = G.gate_decision(candidate_gates(spark, folder)).select("model_name", "candidate_version", "decision")
    return G.promotion_decisions(pairs.join(decided, ["model_name", "candidate_version"])).select(
        "model_name", "champion_version", "candidate_version", "decision", "resultado"
    )


@query(
    "champion_metric_comparison",
    "C5",
    O.with_(PAIRS)
    + "\nUNION ALL ".join(f"SELECT model_name, '{m}' AS metric, champion_{m} AS champion_value, {m} AS candidate_value, {m} - champion_{m} AS delta FROM pairs" for m in ("roc_auc", "area_under_pr", "top20_capture")),
)
def champion_metric_comparison(spark, folder):
    """All metrics; models without a champion keep their rows."""
    pairs = candidate_pairs(spark, folder)

    def long(prefix: str) -> DataFrame:
        cells = [F.struct(F.lit(m).alias("metric"), F.col(prefix + m).alias("value")) for m in _METRICS]
        return pairs.select("model_name", F.inline(F.array(*cells)))

    return G.metric_comparison(long("champion_"), long(""))


@query(
    "alias_checks",
    "K11 K2",
    O.with_(O.MODEL_EVENTS) + "SELECT model_name, model_alias, version, 'OK' AS estado FROM alias_state WHERE model_name = (SELECT min(model_name) FROM alias_state)",
)
def alias_checks(spark, folder):
    """The aliases of one model against the targets of its latest events, found another way; a difference raises."""
    events = A.model_events(spark, folder)
    name = events.agg(F.min("model_name")).first()[0]
    own = events.filter(F.col("model_name") == name)
    latest = own.groupBy("model_alias").agg(F.max_by("target_version", F.struct("event_timestamp", "event_id")).alias("version"))
    state = G.alias_state(events)
    G.check_aliases(state, {r["model_alias"]: r["version"] for r in latest.collect()}, name)
    return state.filter(F.col("model_name") == name).select("model_name", "model_alias", "version", F.lit("OK").alias("estado"))


@query(
    "promotions_by_user",
    "B32 K9",
    O.with_(PAIRS)
    + """SELECT p.model_name, p.candidate_version AS target_version, true AS registrado_por_usuario FROM pairs AS p
JOIN decisions AS d ON p.model_name = d.model_name AND p.candidate_version = d.candidate_version WHERE p.champion_version <> p.candidate_version AND d.decision <> 'FAIL'""",
)
def promotions_by_user(spark, folder):
    """Promotions without a named approver are recorded under the session's user."""
    events = G.promotion_events(decided_pairs(spark, folder), datetime(2026, 1, 2), None, "T-1")
    own = (F.col("approved_by") == F.current_user()) & (F.length("approved_by") > 0)
    return events.filter("action = 'PROMOTE'").select("model_name", "target_version", own.alias("registrado_por_usuario"))


@query("persisted_consumer_view", "A13 E4 D15", O.with_(O.HISTORY) + "SELECT * FROM view")
def persisted_consumer_view(spark, folder):
    """The consumer view as SQL kept in the catalog over a stored score table."""
    with passing_schema(spark) as schema:
        overwrite(A.score_history(spark, folder), f"{schema}.scores")
        kept = CV.create_consumer_view(spark, f"{schema}.consumer_scores", f"{schema}.scores")
        return write_and_read(kept, run_folder(spark, "consumer-view"))


@query("persisted_alert_view", "A13 J9", ALERTS_SQL)
def persisted_alert_view(spark, folder):
    """The alert view as SQL kept in the catalog over a stored drift table."""
    with passing_schema(spark) as schema:
        overwrite(formula_drift(spark, folder).drift, f"{schema}.drift")
        kept = CV.create_alert_view(spark, f"{schema}.active_alerts", f"{schema}.drift")
        return write_and_read(kept, run_folder(spark, "alert-view"))


CYCLE = f"""{PAIRS},
promoted AS (
  SELECT p.model_name, p.champion_version, p.candidate_version FROM pairs AS p
  JOIN decisions AS d ON p.model_name = d.model_name AND p.candidate_version = d.candidate_version
  WHERE p.champion_version <> p.candidate_version AND d.decision <> 'FAIL'
)"""


@query(
    "models_after_promotion",
    "K9 K1",
    O.with_(CYCLE)
    + """SELECT a.model_name, a.model_alias, CASE WHEN a.model_alias = 'Champion' THEN coalesce(p.candidate_version, a.version) ELSE a.version END AS version
FROM alias_state AS a LEFT JOIN promoted AS p ON a.model_name = p.model_name
UNION ALL SELECT model_name, 'PreviousChampion', champion_version FROM promoted""",
)
def models_after_promotion(spark, folder):
    """Alias state of all models once every candidate that may be promoted is promoted."""
    log = A.model_events(spark, folder)
    events = G.promotion_events(decided_pairs(spark, folder), datetime(2026, 1, 2), "aprobador", "T-1")
    return G.alias_state(log.unionByName(events)).select("model_name", "model_alias", "version")


@query(
    "models_after_rollback",
    "K10 K11 K12",
    O.with_(CYCLE)
    + """SELECT a.model_name, a.model_alias, CASE WHEN a.model_alias = 'RolledBack' THEN coalesce(p.candidate_version, a.version) ELSE a.version END AS version
FROM alias_state AS a LEFT JOIN promoted AS p ON a.model_name = p.model_name
UNION ALL SELECT model_name, 'PreviousChampion', champion_version FROM promoted
UNION ALL SELECT model_name, 'RolledBack', candidate_version FROM promoted
WHERE model_name NOT IN (SELECT model_name FROM alias_state WHERE model_alias = 'RolledBack')""",
)
def models_after_rollback(spark, folder):
    """... and then rolled back: champions are as before, withdrawn versions are kept."""
    log = A.model_events(spark, folder)
    events = G.promotion_events(decided_pairs(spark, folder), datetime(2026, 1, 2), "aprobador", "T-1")
    # The log with the promotions is stored: the rollback reads it and is appended to it.
    promoted = write_and_read(log.unionByName(events), run_folder(spark, "events"))
    undone = G.rollback_events(promoted, datetime(2026, 1, 3), "aprobador", "T-2")
    return G.alias_state(promoted.unionByName(undone)).select("model_name", "model_alias", "version")

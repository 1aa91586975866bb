"""Registered queries on claims, scores and runs: sources, features, joins, aggregates, merges."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.functions import features as FE
from claimlens.functions.names import clean_headers
from claimlens.functions.scoring import flagged, risk_action, risk_level, score_rows, short_hash_key, version_number
from claimlens.operators import drift as D
from claimlens.operators import evaluation as EV
from claimlens.operators import merge as M
from claimlens.operators import profile as P
from claimlens.operators import ranking as R
from claimlens.operators import reports as RP
from claimlens.plans import oracles as O
from claimlens.plans.batch_scoring import next_batch, unscored
from claimlens.plans.registry import query, six
from claimlens.session import run_folder
from claimlens.sources import claims as A
from claimlens.sources.tables import TABLES, append, create_schema, overwrite, passing_schema, publish_view, scan, stage_run, write_and_read


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return A.claims(spark, folder).withColumns({"label": FE.label(), "score_fraude": F.col("score_formula")})


# --- sources and sinks --------------------------------------------------------------------------


@query("claim_rows", "A1", O.with_(O.CLAIMS) + "SELECT * FROM claims")
def claim_rows(spark, folder):
    return A.claims(spark, folder)


@query(
    "table_scan_counts",
    "A1 G1",
    "\nUNION ALL ".join(f"SELECT '{t}' AS tabla, count(*) AS filas FROM {t}" for t in TABLES),
)
def table_scan_counts(spark, folder):
    parts = [scan(spark, t, folder).agg(F.count("*").alias("filas")).select(F.lit(t).alias("tabla"), "filas") for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "clean_header_names",
    "A2",
    'SELECT c_custkey AS "Id_cliente", c_name AS "Nombre_Cliente", c_nationkey AS "A_o_pais", c_acctbal AS "Saldo_Sum", c_mktsegment AS "Canal_n" FROM customer',
)
def clean_header_names(spark, folder):
    raw = scan(spark, "customer", folder).toDF(" Id cliente ", "Nombre--Cliente", "A.o (pais)", "__Saldo  $Sum__", "Canal ï¿½".replace("ï¿½", "�"))
    return clean_headers(raw)


@query(
    "append_new_batch",
    "A3 B13 B19 B20 C1 F1",
    O.with_(O.ORDER_SCORES)
    + """, existing AS (
  SELECT id_reclamacion, score_fraude FROM order_scores
  UNION ALL
  SELECT 'DEMO-INC-001-' || substr(sha256(id_reclamacion), 1, 24), score_fraude FROM (
    SELECT * FROM order_scores ORDER BY id_reclamacion LIMIT 40) AS already),
batch AS (
  SELECT 'DEMO-INC-001-' || substr(sha256(id_reclamacion), 1, 24) AS id_reclamacion, score_fraude FROM (
    SELECT * FROM existing WHERE id_reclamacion NOT LIKE 'DEMO-INC-%' ORDER BY id_reclamacion LIMIT 100) AS first_rows)
SELECT id_reclamacion, score_fraude, false AS nueva, false AS sellada FROM existing
UNION ALL
SELECT id_reclamacion, score_fraude, true, true FROM batch
WHERE id_reclamacion NOT IN (SELECT id_reclamacion FROM existing)""",
)
def append_new_batch(spark, folder):
    """The stored input table after a batch of 100, of which 40 had been added before, was appended in the table's column order.

    A new row's stamp must lie within the run.
    """
    begun = datetime.now(timezone.utc)
    base = A.formula_claims(spark, folder).select(C.KEY, "score_fraude")
    before = base.orderBy(C.KEY).limit(40).withColumn(C.KEY, short_hash_key(F.col(C.KEY), "DEMO-INC-001-"))
    old = base.unionByName(before).withColumn("fecha_ingesta", F.lit(None).cast("timestamp"))
    with passing_schema(spark) as schema:
        name = f"{schema}.entrada"
        overwrite(old, name)
        new = next_batch(spark.table(name), "DEMO-INC-001-", 100, "DEMO-INC-")
        append(new.select("fecha_ingesta", "score_fraude", C.KEY), name)
        stored = write_and_read(spark.table(name), run_folder(spark, "input"))
    within = F.col("fecha_ingesta").between(F.lit(begun), F.lit(datetime.now(timezone.utc)))
    return stored.select(C.KEY, "score_fraude", F.col("fecha_ingesta").isNotNull().alias("nueva"), F.coalesce(within, F.lit(False)).alias("sellada"))


@query(
    "overwritten_scored_test",
    "A4 A5 B18",
    O.with_(O.LABELLED) + 'SELECT label, score_fraude, "Ramo_Desc", "Nombre_Canal_Comercial", "REGIONAL", "Cobertura" FROM labelled',
)
def overwritten_scored_test(spark, folder):
    """The scored-test table: those of its columns that exist, overwritten and read back."""
    rows = FE.existing(labelled(spark, folder), C.SCORED_TEST_COLUMNS)
    stored = write_and_read(rows, run_folder(spark, "scored-test"))
    return stored.select("label", "score_fraude", "Ramo_Desc", "Nombre_Canal_Comercial", "REGIONAL", "Cobertura")


@query(
    "staged_run_rows",
    "A6 B14 B17 G7",
    O.with_(O.PUBLISHED) + "SELECT * FROM published WHERE id_ejecucion = 'run-1'",
)
def staged_run_rows(spark, folder):
    """Both runs staged; run-1 staged a second time; only run-1 is read back, without doubles."""
    scores = A.published_scores(spark, folder)
    path = run_folder(spark, "stage")
    stage_run(scores, path, "run-0")
    again = scores.filter(F.col("id_ejecucion") == "run-1")
    return stage_run(again, path, "run-1")


@query(
    "consumer_view_by_name",
    "A13 D15",
    O.with_(O.HISTORY)
    + "SELECT count(*) AS reclamaciones, count(DISTINCT id_reclamacion) AS reclamaciones_unicas, max(fecha_scoring) AS ultima_actualizacion FROM view",
)
def consumer_view_by_name(spark, folder):
    """The consumer view published under a name and read through SQL."""
    publish_view(spark, "consumer_scores_batch_v1", RP.consumer_view(A.score_history(spark, folder)))
    return RP.consumer_summary(spark.table("consumer_scores_batch_v1"))


# --- projections ----------------------------------------------------------------------------------


@query("label_and_calendar", "B1 B4", O.with_(O.CLAIMS) + f"""SELECT id_reclamacion, "Fraude_S_N", {O.LABEL} AS label,
CAST(month("FSINIESTRO") AS VARCHAR) AS mes_siniestro, CAST(dayofweek("FSINIESTRO") + 1 AS VARCHAR) AS dia_semana_siniestro FROM claims""")
def label_and_calendar(spark, folder):
    return FE.training_frame(A.claims(spark, folder)).select(C.KEY, C.TARGET, "label", "mes_siniestro", "dia_semana_siniestro")


@query(
    "date_parsing",
    "B2",
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'sin fecha' WHEN o_orderkey % 50 = 1 THEN NULL
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS txt FROM orders)
SELECT o_orderkey AS id_reclamacion, TRY_CAST(txt AS DATE) AS "FSINIESTRO", txt IS NOT NULL AND TRY_CAST(txt AS DATE) IS NULL AS ilegible FROM t""",
)
def date_parsing(spark, folder):
    text = (
        F.when(F.col("o_orderkey") % 50 == 0, "sin fecha")
        .when(F.col("o_orderkey") % 50 == 1, None)
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
    )
    raw = scan(spark, "orders", folder).select(F.col("o_orderkey").alias(C.KEY), text.alias("FSINIESTRO"))
    parsed = FE.as_date(raw, "FSINIESTRO")
    return raw.select(C.KEY, parsed.alias("FSINIESTRO"), (F.col("FSINIESTRO").isNotNull() & parsed.isNull()).alias("ilegible"))


@query("model_features", "B2 B3 B5 B6 B7 B8 B9 B10", O.with_(O.FEATURES) + "SELECT * FROM features")
def model_features(spark, folder):
    frame = FE.scoring_frame(A.scoring_input(spark, folder)).select(C.KEY, *C.FEATURES)
    return six(frame, "log_reserva_inicial")


@query(
    "text_number_casts",
    "B9 B10",
    """SELECT id_reclamacion, TRY_CAST(txt AS DOUBLE) AS valor FROM (SELECT CAST(o_orderkey AS VARCHAR) AS id_reclamacion,
CASE WHEN o_orderkey % 13 = 0 THEN 'n/d' ELSE CAST(o_orderkey * 3 AS VARCHAR) END AS txt FROM orders) AS t""",
)
def text_number_casts(spark, folder):
    key = F.col("o_orderkey")
    raw = scan(spark, "orders", folder).select(
        key.cast("string").alias(C.KEY), F.when(key % 13 == 0, "n/d").otherwise((key * 3).cast("string")).alias("valor")
    )
    return raw.select(C.KEY, FE.lenient_double("valor").alias("valor"))


@query("scored_claims", "B15 B16 B17", O.with_(O.PUBLISHED) + "SELECT * FROM published")
def scored_claims(spark, folder):
    return A.published_scores(spark, folder)


@query(
    "prefix_split",
    "B13 D16",
    "SELECT CASE WHEN o_orderpriority LIKE '1-%' THEN true ELSE false END AS con_prefijo, count(*) AS casos FROM orders GROUP BY 1",
)
def prefix_split(spark, folder):
    o = scan(spark, "orders", folder)
    has = F.col("o_orderpriority").startswith("1-")
    one = o.filter(has).agg(F.lit(True).alias("con_prefijo"), F.count("*").alias("casos"))
    return one.unionByName(o.filter(~has).agg(F.lit(False).alias("con_prefijo"), F.count("*").alias("casos")))


@query(
    "version_numbers",
    "B22",
    O.with_(O.HISTORY) + "SELECT version_modelo, coalesce(nullif(regexp_extract(version_modelo, ':([0-9]+)$', 1), ''), version_modelo) AS model_version, count(*) AS casos FROM history GROUP BY 1, 2",
)
def version_numbers(spark, folder):
    h = A.score_history(spark, folder)
    return h.groupBy("version_modelo", version_number(F.col("version_modelo")).alias("model_version")).agg(F.count("*").alias("casos"))


@query(
    "flagged_claims",
    "B26 D14",
    O.with_(O.ORDER_SCORES) + f"SELECT count(*) AS registros, round(avg(CASE WHEN score_fraude >= {O.HIGH} THEN 1e2 ELSE 0e0 END), 6) AS porcentaje_alto FROM order_scores",
)
def flagged_claims(spark, folder):
    return six(RP.flagged_share(A.formula_claims(spark, folder)), "porcentaje_alto")


@query(
    "period_score_rows",
    "B26 B27 G1",
    O.with_(O.ORDER_SCORES)
    + f"""SELECT id_reclamacion, CASE WHEN loss < DATE '1998-05-01' THEN 'REFERENCIA' ELSE 'ACTUAL_4_MESES' END AS periodo,
score_fraude AS score_monitoreado, CASE WHEN score_fraude >= {O.HIGH} THEN 1 ELSE 0 END AS marcado_fraude,
CASE WHEN loss < DATE '1998-05-01' THEN 'run-0' ELSE 'run-1' END AS source_execution_id FROM order_scores""",
)
def period_score_rows(spark, folder):
    """Two periods of one score table, tagged by row, so the table is read once."""
    s = A.formula_claims(spark, folder)
    old = F.col("FSINIESTRO") < A.PERIOD_START
    rows = D.period_scores(s, F.when(old, C.REFERENCE).otherwise(C.CURRENT), F.when(old, "run-0").otherwise("run-1"))
    return rows


def formula_period_scores(spark, folder) -> DataFrame:
    s = A.formula_claims(spark, folder)
    tag = F.when(F.col("FSINIESTRO") < A.PERIOD_START, C.REFERENCE).otherwise(C.CURRENT)
    return D.period_scores(s, tag, "formula")


PERIODS = f"""{O.ORDER_SCORES},
periods AS (
  SELECT id_reclamacion, CASE WHEN loss < DATE '1998-05-01' THEN 'REFERENCIA' ELSE 'ACTUAL_4_MESES' END AS periodo,
         score_fraude AS score_monitoreado, CASE WHEN score_fraude >= {O.HIGH} THEN 1 ELSE 0 END AS marcado_fraude
  FROM order_scores
)"""


# --- joins ------------------------------------------------------------------------------------------


@query(
    "unscored_by_version",
    "C2 G2",
    O.with_(O.PUBLISHED) + "SELECT id_reclamacion FROM order_scores WHERE id_reclamacion NOT IN (SELECT id_reclamacion FROM published WHERE version_modelo = 'claims.risk_forest:2')",
)
def unscored_by_version(spark, folder):
    """Claims that version 2 has not scored: lot 2, never scored, and lot 0, scored by version 1."""
    claims = A.formula_claims(spark, folder).select(C.KEY)
    return unscored(claims, A.published_scores(spark, folder), f"{C.DEFAULT_MODEL}:2")


def two_score_sets(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Formula scores, and the same with every 17th claim changed."""
    base = A.formula_claims(spark, folder).select(C.KEY, F.col("score_fraude").alias("score"))
    other = base.withColumn("score", F.when(F.col(C.KEY).cast("long") % 17 == 0, F.col("score") * 0.5).otherwise(F.col("score")))
    predict = F.when(F.col("score") >= 0.5, 1.0).otherwise(0.0)
    return base.withColumn("prediction", predict), other.withColumn("prediction", predict)


CHANGED = f"""{O.ORDER_SCORES},
both_sets AS (
  SELECT id_reclamacion, score_fraude AS a,
         CASE WHEN CAST(id_reclamacion AS BIGINT) % 17 = 0 THEN score_fraude * 5e-1 ELSE score_fraude END AS b
  FROM order_scores
)"""


@query(
    "score_differences",
    "C3 B31",
    O.with_(CHANGED) + "SELECT id_reclamacion, a AS score_a, b AS score_b, abs(a - b) AS diferencia FROM both_sets",
)
def score_differences(spark, folder):
    diff = RP.score_difference(*two_score_sets(spark, folder))
    return diff.select(C.KEY, "score_a", "score_b", "diferencia")


@query(
    "equivalence_check",
    "D11",
    O.with_(CHANGED)
    + """SELECT count(*) AS registros_comparados, count(CASE WHEN (a >= 5e-1) <> (b >= 5e-1) THEN 1 END) AS predicciones_diferentes,
max(abs(a - b)) AS max_diferencia_score FROM both_sets""",
)
def equivalence_check(spark, folder):
    return RP.equivalence_summary(RP.score_difference(*two_score_sets(spark, folder)))


@query(
    "baseline_claim_rows",
    "C4 F6",
    O.with_(O.CLAIMS, O.HISTORY)
    + """SELECT id_reclamacion, "FSINIESTRO" FROM claims WHERE id_reclamacion IN (SELECT id_reclamacion FROM history WHERE id_ejecucion =
(SELECT id_ejecucion FROM history GROUP BY id_ejecucion ORDER BY count(*) DESC, id_ejecucion LIMIT 1))""",
)
def baseline_claim_rows(spark, folder):
    """Claims of the execution with the most scores; claims scored twice in it stay single."""
    history = A.score_history(spark, folder)
    chosen = RP.baseline_execution(RP.count_by(history, "id_ejecucion").withColumnRenamed("casos", "reclamaciones"))
    baseline = history.join(F.broadcast(chosen.select("id_ejecucion")), "id_ejecucion", "left_semi")
    return D.baseline_claims(A.scoring_input(spark, folder), baseline).select(C.KEY, "FSINIESTRO")


# --- aggregates ---------------------------------------------------------------------------------------


@query("label_counts", "D1", O.with_(O.LABELLED) + 'SELECT "Fraude_S_N", label, count(*) AS casos FROM labelled GROUP BY 1, 2')
def label_counts(spark, folder):
    return RP.count_by(labelled(spark, folder), C.TARGET, "label")


_PROFILED = [
    "id_reclamacion", "Fraude_S_N", "edad_ingreso_asegurado", "edad_actual_asegurado", "vigencia_poliza", "vigencia_certificado",
    "Sum_Valor_Reservas_Inicial", "A_o", "Fecha_Primera_Vigencia_Cert", "fecha_primera_vigencia_pol", "FEXPEDICION", "FSINIESTRO",
    "F_Notificacion", "Fecha_Apertura", "Ramo_Desc", "Nombre_Canal_Comercial", "REGIONAL", "Cobertura", "score_formula", "lote",
]  # every column of the claims


@query(
    "column_nulls",
    "D2",
    O.with_(O.CLAIMS) + "\nUNION ALL ".join(f"""SELECT '{c}' AS columna, count(CASE WHEN "{c}" IS NULL THEN 1 END) AS nulos FROM claims""" for c in _PROFILED),
)
def column_nulls(spark, folder):
    return P.null_counts(A.claims(spark, folder))


_LEFT_OUT = {*C.LEAKAGE_COLUMNS, *C.TRAINING_DATES, *C.HIGH_CARDINALITY_COLUMNS, C.KEY}


def _role(column: str) -> str:
    numeric = f"""CASE WHEN typeof(any_value("{column}")) IN ('INTEGER', 'BIGINT', 'DOUBLE') THEN 'NUMERICA' ELSE 'NO_NUMERICA' END"""
    return "'EXCLUIDA'" if column in _LEFT_OUT else numeric


@query(
    "column_roles",
    "B11 B12 D2",
    O.with_(O.CLAIMS) + "\nUNION ALL ".join(f"""SELECT '{c}' AS columna, count(CASE WHEN "{c}" IS NULL THEN 1 END) AS nulos, {_role(c)} AS uso FROM claims""" for c in _PROFILED),
)
def column_roles(spark, folder):
    """What each raw claim column is to training (a numeric feature, another feature, or left out), and its nulls."""
    claims = A.claims(spark, folder)
    chosen = FE.feature_columns(claims)
    numeric = FE.numeric_columns(claims, chosen)
    role = F.when(F.col("columna").isin(numeric), "NUMERICA").when(F.col("columna").isin(chosen), "NO_NUMERICA").otherwise("EXCLUIDA")
    return P.null_counts(claims).withColumn("uso", role)


@query("column_profile", "D2 B11 B12")
def column_profile(spark, folder):
    """Nulls and approximate cardinality, with the role of each column in training."""
    frame = FE.training_frame(A.claims(spark, folder).drop("score_formula", "lote"))
    chosen = FE.feature_columns(frame)
    numeric = FE.numeric_columns(frame, chosen)
    role = F.when(F.col("columna").isin(numeric), "NUMERICA").when(F.col("columna").isin(chosen), "NO_NUMERICA").otherwise("EXCLUIDA")
    return P.column_profile(frame).withColumn("uso", role)


@query(
    "missing_features",
    "D3 B30 F4",
    O.with_(O.FEATURES)
    + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS variable, count(CASE WHEN "{c}" IS NULL OR isnan("{c}") THEN 1 END) AS valores_faltantes,
round(avg(CASE WHEN "{c}" IS NULL OR isnan("{c}") THEN 1e0 ELSE 0e0 END), 6) AS porcentaje_faltante FROM features"""
        for c in C.FEATURES
    ),
)
def missing_features(spark, folder):
    return six(P.missing_profile(FE.scoring_frame(A.scoring_input(spark, folder))), "porcentaje_faltante")


@query("duplicate_claim_keys", "D4", "SELECT CAST(l_orderkey AS VARCHAR) AS id_reclamacion, l_linenumber, count(*) AS veces FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_claim_keys(spark, folder):
    rows = scan(spark, "lineitem", folder).select(F.col("l_orderkey").alias(C.KEY), "l_linenumber")
    return M.duplicate_keys(rows, [C.KEY, "l_linenumber"]).withColumn(C.KEY, F.col(C.KEY).cast("string"))


@query(
    "blank_claim_keys",
    "D5 F5",
    """SELECT k AS id_reclamacion, o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN NULL WHEN o_orderkey % 100 = 1 THEN '   '
ELSE CAST(o_orderkey AS VARCHAR) END AS k FROM orders) AS t WHERE k IS NULL OR trim(k) = ''""",
)
def blank_claim_keys(spark, folder):
    key = F.col("o_orderkey")
    text = F.when(key % 100 == 0, None).when(key % 100 == 1, "   ").otherwise(key.cast("string"))
    return P.blank_keys(scan(spark, "orders", folder).select(text.alias(C.KEY), "o_orderkey"))


@query("confusion_matrix", "D6", O.with_(O.LABELLED) + "SELECT label, CASE WHEN score_fraude >= 5e-1 THEN 1e0 ELSE 0e0 END AS pred_label, count(*) AS casos FROM labelled GROUP BY 1, 2")
def confusion_matrix(spark, folder):
    return EV.confusion(labelled(spark, folder))


@query("base_rate", "D7", O.with_(O.LABELLED) + "SELECT round(avg(label), 6) AS base_rate FROM labelled")
def base_rate(spark, folder):
    return six(RP.base_rate(labelled(spark, folder)), "base_rate")


LIFT = f"""{O.LABELLED},
tiles AS (SELECT *, ntile(10) OVER (ORDER BY score_fraude DESC, id_reclamacion) AS decil FROM labelled),
lift AS (
  SELECT CAST(decil AS INTEGER) AS decil, count(*) AS casos, sum(label) AS fraudes, min(score_fraude) AS score_min,
         max(score_fraude) AS score_max, avg(label) AS tasa_fraude,
         avg(label) / (SELECT avg(label) FROM labelled) AS lift
  FROM tiles GROUP BY 1
)"""


def labelled_tiles(spark, folder) -> DataFrame:
    """Labelled claims with their decile; written once, because several passes follow."""
    narrow = labelled(spark, folder).select(C.KEY, "label", "score_fraude")
    stored = write_and_read(narrow, run_folder(spark, "labelled"))
    return R.tile(stored, "score_fraude", C.KEY)


@query(
    "decile_lift",
    "D8 E3",
    O.with_(LIFT) + "SELECT decil, casos, fraudes, score_min, score_max, round(tasa_fraude, 6) AS tasa_fraude, round(lift, 6) AS lift FROM lift",
)
def decile_lift(spark, folder):
    return six(EV.lift_table(labelled_tiles(spark, folder)), "tasa_fraude", "lift")


@query(
    "lift_table_in_schema",
    "A4 A10 D8",
    O.with_(LIFT) + "SELECT decil, casos, fraudes FROM lift",
)
def lift_table_in_schema(spark, folder):
    """The lift table overwritten twice in a result schema and read back by its two-part name."""
    location = run_folder(spark, "schema")
    schema = f"resultados_{location[-8:]}"
    create_schema(spark, schema, location)
    table = f"{schema}.fraude_decile_lift"
    overwrite(EV.lift_table(labelled_tiles(spark, folder)), table)
    overwrite(scan(spark, table).select("decil", "casos", "fraudes").transform(lambda d: write_and_read(d, f"{location}/copy")), table)
    return scan(spark, table)


@query("top20_capture", "L1", O.with_(LIFT) + "SELECT round(sum(CASE WHEN decil <= 2 THEN fraudes END) / sum(fraudes), 6) AS captura_top_20 FROM lift")
def top20_capture(spark, folder):
    return six(EV.top_share(EV.lift_table(labelled_tiles(spark, folder))), "captura_top_20")


_SEGS = ["Ramo_Desc", "Nombre_Canal_Comercial", "REGIONAL", "Cobertura"]


@query(
    "segment_rates",
    "D9 L7",
    O.with_(O.LABELLED)
    + ", segments AS ("
    + " UNION ALL ".join(
        f"""SELECT '{s}' AS segmento, "{s}" AS valor, count(*) AS casos, avg(label) AS tasa_fraude, avg(score_fraude) AS score_promedio FROM labelled GROUP BY "{s}" HAVING count(*) >= 30"""
        for s in _SEGS
    )
    + """), ranked AS (SELECT *, row_number() OVER (PARTITION BY segmento ORDER BY tasa_fraude DESC, valor NULLS FIRST) AS puesto FROM segments)
SELECT segmento, valor, casos, round(tasa_fraude, 6) AS tasa_fraude, round(score_promedio, 6) AS score_promedio, CAST(puesto AS INTEGER) AS puesto
FROM ranked WHERE puesto <= 10""",
)
def segment_rates(spark, folder):
    return six(RP.segment_table(labelled(spark, folder)), "tasa_fraude", "score_promedio")


RISK_SQL = f"""SELECT nivel_riesgo, {O.action("nivel_riesgo")} AS accion_sugerida, count(*) AS casos, round(avg(score), 6) AS score_promedio,
min(score) AS score_minimo, max(score) AS score_maximo FROM leveled_claims GROUP BY 1, 2"""


@query(
    "risk_summary",
    "B15 B16 D10",
    O.with_(O.FEATURES)
    + f""", leveled_claims AS (SELECT s.score, {O.level("s.score")} AS nivel_riesgo FROM (
  SELECT score_formula AS score FROM claims) AS s)
{RISK_SQL}""",
)
def risk_summary(spark, folder):
    """Claims, a fixed-formula score, level and action, summary. No feature enters; see ``model_risk_summary``."""
    frame = FE.scoring_frame(A.scoring_input(spark, folder)).withColumn("score_fraude", F.col("score_formula"))
    level = risk_level(F.col("score_fraude"))
    scored = frame.withColumns({"nivel_riesgo": level, "accion_sugerida": risk_action(level)})
    return six(RP.risk_summary(scored), "score_promedio")


@query(
    "period_score_summary",
    "D12",
    O.with_(PERIODS)
    + """SELECT periodo, count(*) AS casos, round(avg(score_monitoreado), 6) AS score_promedio,
quantile_disc(score_monitoreado, 0.5) AS score_p50, quantile_disc(score_monitoreado, 0.9) AS score_p90,
CAST(sum(marcado_fraude) AS BIGINT) AS casos_marcados_fraude, round(1e2 * avg(marcado_fraude), 6) AS porcentaje_marcado_fraude
FROM periods GROUP BY periodo""",
)
def period_score_summary(spark, folder):
    """With exact percentiles, from the narrowing passes."""
    out = RP.period_score_summary_exact(formula_period_scores(spark, folder), [C.REFERENCE, C.CURRENT])
    return six(out, "score_promedio", "porcentaje_marcado_fraude")


@query("period_score_report", "D12")
def period_score_report(spark, folder):
    """With sketch percentiles and the rounding of the report."""
    return RP.period_score_summary(formula_period_scores(spark, folder))


def formula_period_features(spark, folder) -> DataFrame:
    claims = FE.parse_dates(A.scoring_input(spark, folder), C.SCORING_DATES)
    return D.period_features(claims, F.when(F.col("FSINIESTRO") < A.PERIOD_START, C.REFERENCE).otherwise(C.CURRENT))


PERIOD_FEATURES = f"""{O.CLAIMS},
pf AS (
  SELECT id_reclamacion, CAST(edad_actual_asegurado AS DOUBLE) AS edad_actual_asegurado, CAST(vigencia_poliza AS DOUBLE) AS vigencia_poliza,
         "Sum_Valor_Reservas_Inicial" AS reserva_inicial, CAST("F_Notificacion" - "FSINIESTRO" AS DOUBLE) AS dias_siniestro_a_notificacion,
         "Nombre_Canal_Comercial" AS canal_comercial, "REGIONAL" AS regional,
         ln(1e0 + CASE WHEN "Sum_Valor_Reservas_Inicial" > 0 THEN "Sum_Valor_Reservas_Inicial" ELSE 0e0 END) AS log_reserva_inicial,
         CASE WHEN "FSINIESTRO" < DATE '1998-05-01' THEN 'REFERENCIA' ELSE 'ACTUAL_4_MESES' END AS periodo
  FROM claims
)"""


@query("period_feature_rows", "J7", O.with_(PERIOD_FEATURES) + "SELECT * EXCLUDE (log_reserva_inicial), round(log_reserva_inicial, 6) AS log_reserva_inicial FROM pf")
def period_feature_rows(spark, folder):
    return six(formula_period_features(spark, folder), "log_reserva_inicial")


@query(
    "period_feature_summary",
    "D13",
    O.with_(PERIOD_FEATURES)
    + """SELECT periodo, count(*) AS registros, round(avg(edad_actual_asegurado), 6) AS edad_promedio, round(avg(vigencia_poliza), 6) AS vigencia_promedio,
round(avg(reserva_inicial), 4) AS reserva_promedio, round(avg(log_reserva_inicial), 6) AS log_reserva_promedio,
round(avg(dias_siniestro_a_notificacion), 6) AS dias_notificacion_promedio, count(DISTINCT canal_comercial) AS canales_distintos,
count(DISTINCT regional) AS regionales_distintas FROM pf GROUP BY periodo""",
)
def period_feature_summary(spark, folder):
    out = RP.period_feature_summary(formula_period_features(spark, folder))
    out = six(out, "edad_promedio", "vigencia_promedio", "log_reserva_promedio", "dias_notificacion_promedio")
    return out.withColumn("reserva_promedio", F.round("reserva_promedio", 4))


@query(
    "score_quantiles",
    "D17",
    O.with_(O.ORDER_SCORES)
    + "\nUNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS parte, quantile_disc(score_fraude, {p}) AS valor FROM order_scores" for p in (0.05, 0.117, 0.5, 0.9, 0.95)
    ),
)
def score_quantiles(spark, folder):
    shares = [0.05, 0.117, 0.5, 0.9, 0.95]
    values = R.sample_quantiles(A.formula_claims(spark, folder), "score_fraude", shares)
    return spark.createDataFrame(list(zip(shares, values)), "parte double, valor double")


@query(
    "execution_distribution",
    "D18",
    O.with_(O.HISTORY)
    + """SELECT id_ejecucion, max(fecha_scoring) AS fecha_scoring, count(*) AS reclamaciones, round(avg(score_fraude), 6) AS score_promedio,
round(1e2 * avg(CASE WHEN nivel_riesgo = 'ALTO' THEN 1e0 ELSE 0e0 END), 6) AS porcentaje_alto,
round(1e2 * avg(CASE WHEN nivel_riesgo = 'MEDIO' THEN 1e0 ELSE 0e0 END), 6) AS porcentaje_medio,
round(1e2 * avg(CASE WHEN nivel_riesgo = 'BAJO' THEN 1e0 ELSE 0e0 END), 6) AS porcentaje_bajo,
max(version_modelo) AS version_modelo FROM history GROUP BY id_ejecucion""",
)
def execution_distribution(spark, folder):
    """Without the sketch percentiles, which have a query of their own."""
    out = RP.execution_distribution(A.score_history(spark, folder)).drop("score_p50", "score_p90", "score_p95")
    return six(out, "score_promedio", "porcentaje_alto", "porcentaje_medio", "porcentaje_bajo")


_PERCENTILES = ", ".join(f"max(CASE WHEN r = greatest(1, ceil(round({q}e-2 * n, 9))) THEN s END) AS score_p{q}" for q in (50, 90, 95))


@query(
    "execution_percentiles",
    "D18",
    O.with_(O.HISTORY)
    + f""", ranked AS (
  SELECT id_ejecucion, score_fraude AS s, row_number() OVER (PARTITION BY id_ejecucion ORDER BY score_fraude) AS r, count(*) OVER (PARTITION BY id_ejecucion) AS n FROM history
)
SELECT id_ejecucion, {_PERCENTILES} FROM ranked GROUP BY 1""",
)
def execution_percentiles(spark, folder):
    """Exact percentiles of every execution."""
    return RP.execution_percentiles(A.score_history(spark, folder))


@query(
    "baseline_execution",
    "F6",
    O.with_(O.HISTORY) + "SELECT id_ejecucion, count(*) AS reclamaciones FROM history GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
)
def baseline_execution(spark, folder):
    counts = RP.count_by(A.score_history(spark, folder), "id_ejecucion").withColumnRenamed("casos", "reclamaciones")
    return RP.baseline_execution(counts)


@query(
    "execution_monitor",
    "D19",
    O.with_(O.RUNS)
    + """, m AS (SELECT *, duracion_segundos / 6e1 AS minutos, 1e2 * registros_exitosos / registros_entrada AS pct FROM runs)
SELECT id_ejecucion, fecha_inicio, fecha_fin, version_modelo, modo_scoring, registros_entrada, registros_exitosos, registros_error,
round(minutos, 6) AS duracion_minutos, round(pct, 6) AS porcentaje_exito, estado,
CASE WHEN estado = 'FAILED' THEN 'CRITICO' WHEN pct < 100 OR minutos > 60 THEN 'ADVERTENCIA' ELSE 'NORMAL' END AS estado_monitoreo, mensaje_error FROM m""",
)
def execution_monitor(spark, folder):
    return six(RP.execution_monitor(A.scoring_runs(spark, folder)), "duracion_minutos", "porcentaje_exito")


# --- windows, ranks ------------------------------------------------------------------------------------


@query(
    "time_split",
    "E1",
    O.with_(O.CLAIMS)
    + """, numbered AS (SELECT id_reclamacion, row_number() OVER (ORDER BY "Fecha_Apertura" ASC NULLS LAST, id_reclamacion) AS rn,
count(*) OVER () AS n FROM claims)
SELECT id_reclamacion, CASE WHEN rn <= CAST(floor(n * 75e-2) AS BIGINT) THEN 'TRAIN' ELSE 'TEST' END AS tramo FROM numbered""",
)
def time_split(spark, folder):
    dates = write_and_read(A.claims(spark, folder).select(C.KEY, "Fecha_Apertura"), run_folder(spark, "dates"))
    return R.time_split(dates, "Fecha_Apertura", C.KEY, C.TRAIN_SHARE).select(C.KEY, "tramo")


@query(
    "score_rank",
    "E2",
    O.with_(O.ORDER_SCORES) + "SELECT id_reclamacion, row_number() OVER (ORDER BY score_fraude DESC, id_reclamacion) AS rank_score FROM order_scores",
)
def score_rank(spark, folder):
    scores = A.formula_claims(spark, folder).select(C.KEY, "score_fraude")
    return R.global_rank(scores, [F.desc("score_fraude"), F.col(C.KEY)], "rank_score").select(C.KEY, "rank_score")


@query(
    "score_deciles",
    "E3",
    O.with_(O.ORDER_SCORES) + "SELECT id_reclamacion, CAST(ntile(10) OVER (ORDER BY score_fraude DESC, id_reclamacion) AS INTEGER) AS decil FROM order_scores",
)
def score_deciles(spark, folder):
    return R.tile(A.formula_claims(spark, folder), "score_fraude", C.KEY).select(C.KEY, "decil")


@query("latest_scores", "E4", O.with_(O.HISTORY) + "SELECT * FROM view")
def latest_scores(spark, folder):
    return RP.consumer_view(A.score_history(spark, folder))


@query(
    "top_scores",
    "F2",
    O.with_(O.HISTORY) + "SELECT id_reclamacion, score_fraude, nivel_riesgo FROM view ORDER BY view.score_fraude DESC, id_reclamacion LIMIT 20",
)
def top_scores(spark, folder):
    top = RP.top_scores(RP.consumer_view(A.score_history(spark, folder)))
    return top.select(C.KEY, "score_fraude", "nivel_riesgo")


# --- merges ----------------------------------------------------------------------------------------------


MERGE = f"""{O.PUBLISHED},
source_rows AS (
  SELECT id_reclamacion, score_fraude / 2 AS score_fraude, nivel_riesgo, 'run-' || CAST(lote AS VARCHAR) AS id_ejecucion
  FROM leveled WHERE lote > 0
)"""


def merge_source(spark, folder) -> DataFrame:
    """Lots 1 (already published) and 2 (new), with halved scores."""
    rows = A.formula_claims(spark, folder).filter("lote > 0").withColumn("nivel_riesgo", risk_level(F.col("score_fraude")))
    return rows.select(
        C.KEY,
        (F.col("score_fraude") / 2).alias("score_fraude"),
        "nivel_riesgo",
        F.concat(F.lit("run-"), F.col("lote").cast("string")).alias("id_ejecucion"),
    )


def merge_target(spark, folder) -> DataFrame:
    return A.published_scores(spark, folder).select(C.KEY, "score_fraude", "nivel_riesgo", "id_ejecucion")


@query(
    "merge_insert_only",
    "G3 G5",
    O.with_(MERGE)
    + """SELECT id_reclamacion, score_fraude, nivel_riesgo, id_ejecucion FROM published
UNION ALL SELECT id_reclamacion, score_fraude, nivel_riesgo, id_ejecucion FROM source_rows AS s
WHERE NOT EXISTS (SELECT 1 FROM published AS p WHERE p.id_reclamacion = s.id_reclamacion AND p.id_ejecucion = s.id_ejecucion)""",
)
def merge_insert_only(spark, folder):
    return M.merge_insert(merge_target(spark, folder), merge_source(spark, folder), [C.KEY, "id_ejecucion"])


@query(
    "merge_update_all",
    "G4",
    O.with_(MERGE)
    + """SELECT id_reclamacion, score_fraude, nivel_riesgo, id_ejecucion FROM source_rows
UNION ALL SELECT id_reclamacion, score_fraude, nivel_riesgo, id_ejecucion FROM published AS p
WHERE NOT EXISTS (SELECT 1 FROM source_rows AS s WHERE p.id_reclamacion = s.id_reclamacion AND p.id_ejecucion = s.id_ejecucion)""",
)
def merge_update_all(spark, folder):
    return M.merge_upsert(merge_target(spark, folder), merge_source(spark, folder), [C.KEY, "id_ejecucion"])


@query(
    "merge_update_columns",
    "G6",
    O.with_(MERGE)
    + """SELECT p.id_reclamacion, CASE WHEN s.id_reclamacion IS NOT NULL THEN s.score_fraude ELSE p.score_fraude END AS score_fraude, p.nivel_riesgo, p.id_ejecucion
FROM published AS p LEFT JOIN (SELECT * REPLACE ('x' AS nivel_riesgo) FROM source_rows) AS s ON p.id_reclamacion = s.id_reclamacion AND p.id_ejecucion = s.id_ejecucion
UNION ALL SELECT id_reclamacion, score_fraude, 'x', id_ejecucion FROM source_rows AS s
WHERE NOT EXISTS (SELECT 1 FROM published AS p WHERE p.id_reclamacion = s.id_reclamacion AND p.id_ejecucion = s.id_ejecucion)""",
)
def merge_update_columns(spark, folder):
    """Matched rows take the score only; the level of the source shows in new rows alone."""
    source = merge_source(spark, folder).withColumn("nivel_riesgo", F.lit("x"))
    return M.merge_update(merge_target(spark, folder), source, [C.KEY, "id_ejecucion"], ["score_fraude"])


@query(
    "run_deleted",
    "G7",
    O.with_(O.PUBLISHED) + "SELECT id_ejecucion, count(*) AS casos FROM published WHERE id_ejecucion <> 'run-0' GROUP BY 1",
)
def run_deleted(spark, folder):
    return RP.count_by(M.delete_run(A.published_scores(spark, folder), "run-0"), "id_ejecucion")

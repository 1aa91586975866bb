"""SQL building blocks for the checks: the derived tables of ``sources/claims.py`` in ANSI SQL."""

HIGH, MEDIUM = "4.296664901149328e-1", "3.8046251630548705e-1"
SCORE = "5e-1 * o_totalprice / 5e5 + 5e-1 * (o_orderkey % 1000) / 1e3"

CLAIMS = f"""
lines AS (
  SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS first_ship, CAST(max(l_shipdate) AS DATE) AS last_ship,
         count(*) AS n_lines, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned
  FROM lineitem GROUP BY l_orderkey
),
claims AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id_reclamacion,
    CASE WHEN n_lines IS NOT NULL THEN CASE WHEN 2 * n_returned > n_lines THEN ' Fraude ' ELSE 'No fraude' END END AS "Fraude_S_N",
    CAST(18 + o_custkey % 60 AS INTEGER) AS edad_ingreso_asegurado,
    CASE WHEN c_acctbal < 0 THEN -1 ELSE CAST(18 + o_custkey % 60 + o_orderkey % 10 AS INTEGER) END AS edad_actual_asegurado,
    CAST(o_orderkey % 365 AS INTEGER) AS vigencia_poliza,
    CAST(coalesce(n_lines, 0) AS INTEGER) AS vigencia_certificado,
    CASE WHEN o_orderkey % 7 = 0 THEN 0e0 WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS "Sum_Valor_Reservas_Inicial",
    CAST(year(o_orderdate) AS INTEGER) AS "A_o",
    CAST(o_orderdate AS DATE) - CAST(o_orderkey % 700 AS INTEGER) AS "Fecha_Primera_Vigencia_Cert",
    CAST(o_orderdate AS DATE) - CAST(o_custkey % 1500 AS INTEGER) AS fecha_primera_vigencia_pol,
    CAST(o_orderdate AS DATE) - CAST(o_orderkey % 90 AS INTEGER) AS "FEXPEDICION",
    CAST(o_orderdate AS DATE) AS "FSINIESTRO",
    first_ship AS "F_Notificacion",
    last_ship AS "Fecha_Apertura",
    o_orderstatus AS "Ramo_Desc",
    c_mktsegment AS "Nombre_Canal_Comercial",
    r_name AS "REGIONAL",
    o_orderpriority AS "Cobertura",
    {SCORE} AS score_formula,
    CAST(o_orderkey % 3 AS INTEGER) AS lote
  FROM orders
  LEFT JOIN lines ON o_orderkey = l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""

LABEL = """CASE WHEN lower(trim("Fraude_S_N")) = 'fraude' THEN 1e0 ELSE 0e0 END"""

# Claims with label and formula score.
LABELLED = f"""{CLAIMS},
labelled AS (SELECT *, {LABEL} AS label, score_formula AS score_fraude FROM claims)"""

FEATURES = f"""{CLAIMS},
features AS (
  SELECT id_reclamacion,
    CAST(edad_ingreso_asegurado AS DOUBLE) AS edad_ingreso_asegurado,
    CAST(edad_actual_asegurado AS DOUBLE) AS edad_actual_asegurado,
    CAST(vigencia_poliza AS DOUBLE) AS vigencia_poliza,
    CAST(vigencia_certificado AS DOUBLE) AS vigencia_certificado,
    "Sum_Valor_Reservas_Inicial",
    CAST("A_o" AS DOUBLE) AS "A_o",
    CAST("Fecha_Apertura" - "FSINIESTRO" AS DOUBLE) AS dias_siniestro_a_apertura,
    CAST("F_Notificacion" - "FSINIESTRO" AS DOUBLE) AS dias_siniestro_a_notificacion,
    CAST("Fecha_Apertura" - "F_Notificacion" AS DOUBLE) AS dias_notificacion_a_apertura,
    CAST("FSINIESTRO" - "Fecha_Primera_Vigencia_Cert" AS DOUBLE) AS dias_vigencia_cert_a_siniestro,
    CAST("FSINIESTRO" - fecha_primera_vigencia_pol AS DOUBLE) AS dias_vigencia_pol_a_siniestro,
    CAST("FSINIESTRO" - "FEXPEDICION" AS DOUBLE) AS dias_expedicion_a_siniestro,
    CAST(edad_actual_asegurado - edad_ingreso_asegurado AS DOUBLE) AS delta_edad,
    CASE WHEN edad_actual_asegurado < 0 THEN 1e0 ELSE 0e0 END AS edad_actual_invalida,
    round(ln(1e0 + CASE WHEN "Sum_Valor_Reservas_Inicial" > 0 THEN "Sum_Valor_Reservas_Inicial" ELSE 0e0 END), 6) AS log_reserva_inicial,
    CASE WHEN "Sum_Valor_Reservas_Inicial" = 0 THEN 1e0 ELSE 0e0 END AS reserva_inicial_es_cero
  FROM claims
)"""


def level(score: str) -> str:
    return f"CASE WHEN {score} >= {HIGH} THEN 'ALTO' WHEN {score} >= {MEDIUM} THEN 'MEDIO' ELSE 'BAJO' END"


def action(lev: str) -> str:
    return f"CASE {lev} WHEN 'ALTO' THEN 'REVISION_PRIORITARIA' WHEN 'MEDIO' THEN 'REVISION_SECUNDARIA' ELSE 'FLUJO_ESTANDAR' END"


ORDER_SCORES = f"""
order_scores AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id_reclamacion, {SCORE} AS score_fraude,
         CAST(o_orderdate AS DATE) AS loss, CAST(o_orderkey % 3 AS INTEGER) AS lote
  FROM orders
)"""

PUBLISHED = f"""{ORDER_SCORES},
leveled AS (SELECT *, {level("score_fraude")} AS nivel_riesgo FROM order_scores),
published AS (
  SELECT id_reclamacion, score_fraude, nivel_riesgo, {action("nivel_riesgo")} AS accion_sugerida,
         CAST(loss + 30 AS TIMESTAMP) AS fecha_scoring,
         'claims.risk_forest:' || CAST(lote + 1 AS VARCHAR) AS version_modelo,
         'run-' || CAST(lote AS VARCHAR) AS id_ejecucion, 'batch' AS modo_scoring, 'SUCCESS' AS estado_scoring
  FROM leveled WHERE lote < 2
)"""

HISTORY = f"""
line_scores AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id_reclamacion, l_extendedprice / 105000e0 AS score_fraude,
         CAST(l_shipdate AS TIMESTAMP) AS fecha_scoring,
         CASE WHEN l_suppkey % 13 = 0 THEN 'modelo sin numero'
              ELSE 'claims.risk_forest:' || CAST(l_suppkey % 12 + 1 AS VARCHAR) END AS version_modelo,
         'run-' || CAST(l_linenumber AS VARCHAR) AS id_ejecucion
  FROM lineitem
),
history AS (SELECT *, {level("score_fraude")} AS nivel_riesgo, 'SUCCESS' AS estado_scoring FROM line_scores),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY id_reclamacion
      ORDER BY fecha_scoring DESC, id_ejecucion, score_fraude DESC, version_modelo) AS n
    FROM history) AS h WHERE n = 1
),
view AS (
  SELECT id_reclamacion, score_fraude, nivel_riesgo, {action("nivel_riesgo")} AS accion_sugerida, fecha_scoring,
         'claims.risk_forest' AS model_name,
         coalesce(nullif(regexp_extract(version_modelo, ':([0-9]+)$', 1), ''), version_modelo) AS model_version,
         '1.0' AS contract_version, id_ejecucion AS trace_id, estado_scoring AS scoring_status,
         CAST(NULL AS VARCHAR) AS reason_code
  FROM latest
)"""

RUNS = """
days AS (
  SELECT CAST(o_orderdate AS DATE) AS dia, count(*) AS registros_entrada,
         count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS registros_exitosos,
         CAST(max(o_orderkey) % 7200 AS DOUBLE) AS duracion_segundos
  FROM orders GROUP BY 1
),
runs AS (
  SELECT 'run-' || CAST(dia AS VARCHAR) AS id_ejecucion, CAST(dia AS TIMESTAMP) AS fecha_inicio,
         CAST(dia AS TIMESTAMP) + to_seconds(CAST(duracion_segundos AS BIGINT)) AS fecha_fin,
         'claims.risk_forest:1' AS version_modelo, 'batch' AS modo_scoring,
         registros_entrada, registros_exitosos, registros_entrada - registros_exitosos AS registros_error,
         duracion_segundos, CASE WHEN registros_exitosos = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS estado,
         CAST(NULL AS VARCHAR) AS mensaje_error
  FROM days
)"""

MODEL_EVENTS = """
model_events AS (
  SELECT 'evt-' || CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS TIMESTAMP) AS event_timestamp,
         'modelo-' || CAST(user_id AS VARCHAR) AS model_name,
         CASE event_type WHEN 'purchase' THEN 'PROMOTE' WHEN 'error' THEN 'ROLLBACK' ELSE 'BASELINE_SNAPSHOT' END AS action,
         CAST(NULL AS VARCHAR) AS previous_version,
         CAST(event_id % 12 + 1 AS VARCHAR) AS target_version,
         CASE event_type WHEN 'error' THEN 'RolledBack' ELSE 'Champion' END AS model_alias,
         CASE event_type WHEN 'purchase' THEN 'PASS' WHEN 'error' THEN 'RESTORED' ELSE 'APPROVED' END AS validation_status,
         'aprobador' AS approved_by, 'alta de datos' AS reason,
         '{"origen":' || CAST(event_id AS VARCHAR) || ',"tipo":"' || event_type || '"}' AS metadata_json
  FROM events WHERE event_type IN ('purchase', 'error', 'signup')
),
alias_state AS (
  SELECT model_name, model_alias, target_version AS version, event_timestamp, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY model_name, model_alias ORDER BY event_timestamp DESC, event_id DESC) AS n
    FROM model_events) AS e WHERE n = 1
)"""

MODEL_VERSIONS = """
grouped AS (
  SELECT user_id, event_id % 12 + 1 AS v, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / (1e2 * count(*)) AS avg_value, count(*) AS n_events, min(event_id) AS first_event
  FROM events GROUP BY 1, 2
),
model_versions AS (
  SELECT 'modelo-' || CAST(user_id AS VARCHAR) AS model_name, CAST(v AS VARCHAR) AS version,
         CASE WHEN first_event % 9 = 0 THEN 'PENDING' ELSE 'READY' END AS status,
         CASE WHEN first_event % 8 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS run_status,
         CASE WHEN first_event % 10 <> 0 THEN 7e-1 + avg_value / 1e3 END AS roc_auc,
         CASE WHEN first_event % 11 <> 0 THEN 5e-1 + avg_value / 7e2 END AS area_under_pr,
         3e-1 + avg_value / 9e2 AS top20_capture,
         CASE WHEN n_events % 5 <> 0 THEN 42 END AS seed,
         CASE WHEN n_events % 3 <> 0 THEN 'c' || CAST(first_event AS VARCHAR) END AS git_commit
  FROM grouped
)"""


def with_(*blocks: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in blocks) + "\n"

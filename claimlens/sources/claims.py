"""Claims, scores, runs and model records derived from the order and event tables.

One claim per order. The same expressions exist in ANSI SQL in ``plans/oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.functions.scoring import score_rows
from claimlens.sources.tables import scan

PERIOD_START = "1998-05-01"


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """The raw claim table, label column included.

    Lines are pre-aggregated per order before the join, so a hot order key never meets more
    than one right-hand row. ``nation`` and ``region`` are fixed lists of 25 and 5 rows; the
    customer join is left to the optimizer, which broadcasts by measured size or splits skew.
    """
    lines = (
        scan(spark, "lineitem", folder)
        .groupBy("l_orderkey")
        .agg(
            F.min("l_shipdate").cast("date").alias("first_ship"),
            F.max("l_shipdate").cast("date").alias("last_ship"),
            F.count("*").alias("n_lines"),
            F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("n_returned"),
        )
    )
    places = (
        scan(spark, "nation", folder)
        .join(scan(spark, "region", folder), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    )
    customers = (
        scan(spark, "customer", folder)
        .select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(places, "c_nationkey", "left")
    )
    orders = scan(spark, "orders", folder).withColumn("loss", F.col("o_orderdate").cast("date"))
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    entry_age = (18 + customer % 60).cast("int")
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customers, "o_custkey", "left")
        .select(
            key.cast("string").alias(C.KEY),
            F.when(F.col("n_lines").isNotNull(), F.when(2 * F.col("n_returned") > F.col("n_lines"), " Fraude ").otherwise("No fraude")).alias(C.TARGET),
            entry_age.alias("edad_ingreso_asegurado"),
            F.when(F.col("c_acctbal") < 0, -1).otherwise((entry_age + key % 10).cast("int")).alias("edad_actual_asegurado"),
            (key % 365).cast("int").alias("vigencia_poliza"),
            F.coalesce(F.col("n_lines"), F.lit(0)).cast("int").alias("vigencia_certificado"),
            F.when(key % 7 == 0, 0.0).when(key % 11 == 0, None).otherwise(F.col("o_totalprice")).alias("Sum_Valor_Reservas_Inicial"),
            F.year("loss").alias("A_o"),
            F.date_sub("loss", (key % 700).cast("int")).alias("Fecha_Primera_Vigencia_Cert"),
            F.date_sub("loss", (customer % 1500).cast("int")).alias("fecha_primera_vigencia_pol"),
            F.date_sub("loss", (key % 90).cast("int")).alias("FEXPEDICION"),
            F.col("loss").alias("FSINIESTRO"),
            F.col("first_ship").alias("F_Notificacion"),
            F.col("last_ship").alias("Fecha_Apertura"),
            F.col("o_orderstatus").alias("Ramo_Desc"),
            F.col("c_mktsegment").alias("Nombre_Canal_Comercial"),
            F.col("r_name").alias("REGIONAL"),
            F.col("o_orderpriority").alias("Cobertura"),
            formula_score().alias("score_formula"),
            (key % 3).cast("int").alias("lote"),
        )
    )


def formula_score() -> Column:
    """A score that is plain arithmetic, so results can be checked in any SQL engine."""
    return 0.5 * F.col("o_totalprice") / 500000.0 + 0.5 * (F.col("o_orderkey") % 1000) / 1000.0


def scoring_input(spark: SparkSession, folder: str) -> DataFrame:
    """Claims as they reach scoring: without the label."""
    return claims(spark, folder).drop(C.TARGET)


def formula_claims(spark: SparkSession, folder: str) -> DataFrame:
    """The three order columns a formula score needs, straight from one scan."""
    return scan(spark, "orders", folder).select(
        F.col("o_orderkey").cast("string").alias(C.KEY),
        formula_score().alias("score_fraude"),
        F.col("o_orderdate").cast("date").alias("FSINIESTRO"),
        (F.col("o_orderkey") % 3).cast("int").alias("lote"),
    )


def published_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A score table of two runs: lots 0 and 1, one model version each. Lot 2 is unscored."""
    lot = F.col("lote")
    return score_rows(
        formula_claims(spark, folder).filter(lot < 2),
        model_version=F.concat(F.lit(f"{C.DEFAULT_MODEL}:"), (lot + 1).cast("string")),
        run_id=F.concat(F.lit("run-"), lot.cast("string")),
        scored_at=F.date_add("FSINIESTRO", 30),
    )


def score_history(spark: SparkSession, folder: str) -> DataFrame:
    """Many scores per claim: every order line counts as one scoring of its order."""
    line = scan(spark, "lineitem", folder)
    return score_rows(
        line.select(
            F.col("l_orderkey").alias(C.KEY),
            (F.col("l_extendedprice") / 105000.0).alias("score_fraude"),
            "l_shipdate",
            "l_linenumber",
            "l_suppkey",
        ),
        model_version=F.when(F.col("l_suppkey") % 13 == 0, "modelo sin numero").otherwise(
            F.concat(F.lit(f"{C.DEFAULT_MODEL}:"), (F.col("l_suppkey") % 12 + 1).cast("string"))
        ),
        run_id=F.concat(F.lit("run-"), F.col("l_linenumber").cast("string")),
        scored_at=F.col("l_shipdate"),
    )


def scoring_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One audit row per day of orders: the claims of that day as one run."""
    day = F.col("o_orderdate").cast("date")
    return (
        scan(spark, "orders", folder)
        .groupBy(day.alias("dia"))
        .agg(
            F.count("*").alias("registros_entrada"),
            F.count(F.when(F.col("o_orderstatus") != "P", 1)).alias("registros_exitosos"),
            (F.max("o_orderkey") % 7200).cast("double").alias("duracion_segundos"),
        )
        .select(
            F.concat(F.lit("run-"), F.col("dia").cast("string")).alias("id_ejecucion"),
            F.col("dia").cast("timestamp").alias("fecha_inicio"),
            F.timestamp_seconds(F.unix_timestamp(F.col("dia").cast("timestamp")) + F.col("duracion_segundos")).alias("fecha_fin"),
            F.lit(f"{C.DEFAULT_MODEL}:1").alias("version_modelo"),
            F.lit("batch").alias("modo_scoring"),
            "registros_entrada",
            "registros_exitosos",
            (F.col("registros_entrada") - F.col("registros_exitosos")).alias("registros_error"),
            "duracion_segundos",
            F.when(F.col("registros_exitosos") == 0, "FAILED").otherwise("SUCCESS").alias("estado"),
            F.lit(None).cast("string").alias("mensaje_error"),
        )
    )


def model_events(spark: SparkSession, folder: str) -> DataFrame:
    """Governance events from the event stream: a user is a model, its actions move aliases."""
    kind = F.col("event_type")
    version = (F.col("event_id") % 12 + 1).cast("string")
    return (
        scan(spark, "events", folder)
        .filter(kind.isin("purchase", "error", "signup"))
        .select(
            F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("event_id"),
            F.col("ts").cast("timestamp").alias("event_timestamp"),
            F.concat(F.lit("modelo-"), F.col("user_id").cast("string")).alias("model_name"),
            F.when(kind == "purchase", "PROMOTE").when(kind == "error", "ROLLBACK").otherwise("BASELINE_SNAPSHOT").alias("action"),
            F.lit(None).cast("string").alias("previous_version"),
            version.alias("target_version"),
            F.when(kind == "error", "RolledBack").otherwise("Champion").alias("model_alias"),
            F.when(kind == "purchase", "PASS").when(kind == "error", "RESTORED").otherwise("APPROVED").alias("validation_status"),
            F.lit("aprobador").alias("approved_by"),
            F.lit("alta de datos").alias("reason"),
            F.to_json(F.struct(F.col("event_id").alias("origen"), kind.alias("tipo"))).alias("metadata_json"),
        )
    )


def model_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Registered versions with their run facts: per user (model) and twelve versions.

    Metrics are arithmetic on the mean event value, taken over whole cents so that the order of
    summation cannot matter; some are missing on purpose.
    """
    events = scan(spark, "events", folder)
    version = F.col("event_id") % 12 + 1
    value = F.col("avg_value")
    n, first = F.col("n_events"), F.col("first_event")
    return (
        events.groupBy("user_id", version.alias("v"))
        .agg(
            (F.sum(F.round(F.col("value") * 100).cast("bigint")) / (F.lit(100.0) * F.count("*"))).alias("avg_value"),
            F.count("*").alias("n_events"),
            F.min("event_id").alias("first_event"),
        )
        .select(
            F.concat(F.lit("modelo-"), F.col("user_id").cast("string")).alias("model_name"),
            F.col("v").cast("string").alias("version"),
            F.when(first % 9 == 0, "PENDING").otherwise("READY").alias("status"),
            F.when(first % 8 == 0, "FAILED").otherwise("FINISHED").alias("run_status"),
            F.when(first % 10 != 0, 0.70 + value / 1000.0).alias("roc_auc"),
            F.when(first % 11 != 0, 0.50 + value / 700.0).alias("area_under_pr"),
            (0.30 + value / 900.0).alias("top20_capture"),
            F.when(n % 5 != 0, F.lit(42)).alias("seed"),
            F.when(n % 3 != 0, F.concat(F.lit("c"), first.cast("string"))).alias("git_commit"),
        )
    )

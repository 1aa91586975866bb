"""Schema and value contracts: what may enter scoring, and what a score row must look like."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.functions.features import as_date
from claimlens.functions.scoring import row_hash
from claimlens.session import run_folder
from claimlens.sources.tables import write_and_read


def check_input_columns(df: DataFrame, required: list[str] = C.REQUIRED_COLUMNS, forbidden: list[str] = C.FORBIDDEN_COLUMNS) -> None:
    """All required columns present, no forbidden one. Reads the schema only."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"required columns are missing: {absent}")
    leaking = [c for c in forbidden if c in df.columns]
    if leaking:
        raise ValueError(f"columns that are only known after the outcome: {leaking}")


def check_features(found: list[str], approved: list[str] = C.FEATURES) -> None:
    """The features must be exactly the approved ones, in the approved order."""
    absent = [f for f in approved if f not in found]
    if absent:
        raise ValueError(f"approved features are missing: {absent}")
    extra = [f for f in found if f not in approved]
    if extra:
        raise ValueError(f"features that were not approved: {extra}")
    if list(found) != list(approved):
        raise ValueError("features are not in the approved order")


def quarantine(df: DataFrame, columns: list[str] = C.REQUIRED_COLUMNS, key: str = C.KEY) -> DataFrame:
    """All rows with a ``reason_code``: SUCCESS, or why the row may not be scored.

    INVALID_SCHEMA: no key, or a date that cannot be read. IDEMPOTENCY_CONFLICT: the key occurs
    with different payloads. INVALID_VALUES: entry age, terms or reserve below zero, or no loss
    date. The first reason wins.

    Conflicting keys come from an aggregation that is combined map-side (smallest and largest of
    two independent 64-bit digests per key); they are never gathered as groups. They are stored
    before they are joined back, so the optimizer knows their size: few are broadcast, and the
    rows need no shuffle.
    """
    dates = [c for c in C.SCORING_DATES if c in columns and c in df.columns]
    unreadable = F.lit(False)
    for d in dates:
        unreadable = unreadable | (F.col(d).isNotNull() & as_date(df, d).isNull())
    keyless = F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")
    bad_values = F.col("FSINIESTRO").isNull()
    for c in ["edad_ingreso_asegurado", "vigencia_poliza", "vigencia_certificado", "Sum_Valor_Reservas_Inicial"]:
        bad_values = bad_values | (F.col(c).try_cast("double") < 0)
    payload = [c for c in columns if c != key]
    conflicts = (
        df.select(key, row_hash(payload).alias("_p"), row_hash(payload, "2").alias("_q"))
        .groupBy(key)
        .agg(F.min("_p").alias("_p0"), F.max("_p").alias("_p1"), F.min("_q").alias("_q0"), F.max("_q").alias("_q1"))
        .filter("_p0 <> _p1 or _q0 <> _q1")
        .select(key, F.lit(True).alias("_conflict"))
    )
    conflicts = write_and_read(conflicts, run_folder(df.sparkSession, "conflicts"))
    return (
        df.join(conflicts, key, "left")
        .withColumn(
            "reason_code",
            F.when(keyless | unreadable, "INVALID_SCHEMA")
            .when(F.col("_conflict"), "IDEMPOTENCY_CONFLICT")
            .when(F.coalesce(bad_values, F.lit(False)), "INVALID_VALUES")
            .otherwise("SUCCESS"),
        )
        .drop("_conflict")
    )


def interface_check(view: DataFrame, contract: list[Row]) -> DataFrame:
    """Each response field of the interface contract against a consumer view.

    One row per field: is it there, has it the agreed type, and how many rows break "required".
    The contract is a fixed list of fields, so it is compared with the schema on the driver; the
    null counts come from one pass.
    """
    fields = [(r["number"], r["field_name"], r["data_type"], r["required"]) for r in contract]
    types = {f.name: f.dataType.simpleString().upper() for f in view.schema.fields}
    row = view.agg(*[F.count_if(F.col(n).isNull()).alias(n) if n in types else F.lit(None).cast("long").alias(n) for _, n, _, _ in fields])
    cells = ", ".join(
        f"{o}, '{n}', '{t}', '{types.get(n, '')}', {str(bool(req)).lower()}, `{n}`" for o, n, t, req in fields
    )
    checked = row.select(
        F.expr(f"stack({len(fields)}, {cells}) as (number, field_name, agreed_type, found_type, required, nulls)")
    )
    return checked.withColumn(
        "contract_status",
        F.when(F.col("found_type") == "", "MISSING")
        .when(F.col("found_type") != F.col("agreed_type"), "WRONG_TYPE")
        .when(F.col("required") & (F.col("nulls") > 0), "NULLS")
        .otherwise("OK"),
    )

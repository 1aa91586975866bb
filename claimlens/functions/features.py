"""Label and model features as column expressions.

Null rules (kept on purpose, results depend on them): the label is 0.0 for a null or unknown
text; both flags are 0.0 for null; ``log_reserva_inicial`` of a null reserve is 0.0, because
``greatest`` skips nulls. Day differences and the age difference of a null are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens import config as C

# Feature name -> (later date, earlier date).
DAY_DIFFERENCES = {
    "dias_siniestro_a_apertura": ("Fecha_Apertura", "FSINIESTRO"),
    "dias_siniestro_a_notificacion": ("F_Notificacion", "FSINIESTRO"),
    "dias_notificacion_a_apertura": ("Fecha_Apertura", "F_Notificacion"),
    "dias_vigencia_cert_a_siniestro": ("FSINIESTRO", "Fecha_Primera_Vigencia_Cert"),
    "dias_vigencia_pol_a_siniestro": ("FSINIESTRO", "fecha_primera_vigencia_pol"),
    "dias_expedicion_a_siniestro": ("FSINIESTRO", "FEXPEDICION"),
}


def label(target: str | Column = C.TARGET) -> Column:
    text = F.col(target) if isinstance(target, str) else target
    return F.when(F.lower(F.trim(text)) == "fraude", 1.0).otherwise(0.0)


def as_date(df: DataFrame, name: str) -> Column:
    """Text is parsed leniently (unreadable -> null); dates and timestamps are cast."""
    if isinstance(df.schema[name].dataType, (T.StringType, T.VarcharType, T.CharType)):
        return F.try_to_date(F.col(name))
    return F.col(name).cast("date")


def parse_dates(df: DataFrame, names: list[str] = C.TRAINING_DATES) -> DataFrame:
    """Turn those of ``names`` that exist into dates, in one projection."""
    present = {n: as_date(df, n) for n in names if n in df.columns}
    return df.withColumns(present) if present else df


def unreadable_dates(df: DataFrame, names: list[str] = C.TRAINING_DATES) -> DataFrame:
    """Rows whose date text is present but cannot be read, counted per column in one pass."""
    present = [n for n in names if n in df.columns]
    counts = df.agg(
        *[F.count(F.when(F.col(n).isNotNull() & as_date(df, n).isNull(), 1)).alias(n) for n in present]
    )
    return counts.unpivot([], present, "columna", "fechas_ilegibles")


def log_reserve(reserve: Column) -> Column:
    return F.log1p(F.greatest(reserve.cast("double"), F.lit(0.0)))


def derived_features(columns: list[str]) -> dict[str, Column]:
    """The derived columns whose inputs are all in ``columns`` (dates already parsed)."""
    have = set(columns)
    out: dict[str, Column] = {}
    for name, (end, start) in DAY_DIFFERENCES.items():
        if {end, start} <= have:
            out[name] = F.datediff(F.col(end), F.col(start))
    if {"edad_actual_asegurado", "edad_ingreso_asegurado"} <= have:
        age = F.col("edad_actual_asegurado")
        out["delta_edad"] = age - F.col("edad_ingreso_asegurado")
        out["edad_actual_invalida"] = F.when(age < 0, 1.0).otherwise(0.0)
    if "Sum_Valor_Reservas_Inicial" in have:
        reserve = F.col("Sum_Valor_Reservas_Inicial")
        out["log_reserva_inicial"] = log_reserve(reserve)
        out["reserva_inicial_es_cero"] = F.when(reserve == 0, 1.0).otherwise(0.0)
    return out


def calendar_features(columns: list[str]) -> dict[str, Column]:
    """Month and weekday (Sunday = 1) of the loss, as text."""
    if "FSINIESTRO" not in columns:
        return {}
    return {
        "mes_siniestro": F.month("FSINIESTRO").cast("string"),
        "dia_semana_siniestro": F.dayofweek("FSINIESTRO").cast("string"),
    }


def training_frame(df: DataFrame) -> DataFrame:
    """Label, parsed dates, calendar and derived columns over the raw training table."""
    if C.TARGET not in df.columns:
        raise ValueError(f"target column {C.TARGET} is missing; found {df.columns}")
    dated = parse_dates(df, C.TRAINING_DATES)
    return dated.withColumns(
        {"label": label(), **derived_features(dated.columns), **calendar_features(dated.columns)}
    )


def lenient_double(name: str) -> Column:
    """The column as double, unreadable values -> null."""
    return F.col(name).try_cast("double")


def strict_double(names: list[str]) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def scoring_frame(df: DataFrame, features: list[str] = C.FEATURES) -> DataFrame:
    """All input columns plus the model features, each feature a double."""
    dated = parse_dates(df, C.SCORING_DATES)
    full = dated.withColumns(derived_features(dated.columns))
    absent = [f for f in features if f not in full.columns]
    if absent:
        raise ValueError(f"model features that could not be built: {absent}")
    return full.withColumns({f: lenient_double(f) for f in features})


def feature_columns(df: DataFrame, key: str | None = C.KEY) -> list[str]:
    """All columns that are no key, no leakage, no date and not of high cardinality."""
    drop = {*C.LEAKAGE_COLUMNS, *C.TRAINING_DATES, *C.HIGH_CARDINALITY_COLUMNS, key}
    return [c for c in df.columns if c not in drop]


def numeric_columns(df: DataFrame, names: list[str] | None = None) -> list[str]:
    """Those of ``names`` with a numeric type, decimals included."""
    names = df.columns if names is None else names
    return [n for n in names if isinstance(df.schema[n].dataType, T.NumericType)]


def existing(df: DataFrame, names: list[str]) -> DataFrame:
    """Keep only those of ``names`` that exist, in the order of the table."""
    wanted = set(names)
    return df.select([c for c in df.columns if c in wanted])

from datetime import date

import pytest
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.functions import features as FE
from claimlens.functions.names import clean_headers, clean_name
from claimlens.functions.scoring import flagged, missing, risk_action, risk_level, short_hash_key, version_number
from claimlens.operators import contracts as K


@pytest.mark.parametrize(
    "raw, clean",
    [("  A�o ", "Ano"), ("Fraude S/N", "Fraude_S_N"), ("__x__y__", "x_y"), ("a - b", "a_b"), ("ok_1", "ok_1"), ("A.o", "A_o")],
)
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_clean_headers_refuses_clashes(spark):
    with pytest.raises(ValueError, match="equal after cleaning"):
        clean_headers(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


def test_label_is_never_null(spark):
    df = spark.createDataFrame([(" FRAUDE ",), ("fraude",), ("No fraude",), ("",), (None,)], "Fraude_S_N string")
    assert [r[0] for r in df.select(FE.label()).collect()] == [1.0, 1.0, 0.0, 0.0, 0.0]


def test_null_rules_of_features(spark):
    row = (None, None, None, None, None, None)
    df = spark.createDataFrame(
        [row, (-1, 20, 0.0, date(2020, 1, 5), date(2020, 1, 1), date(2020, 2, 1)), (30, 20, -5.0, None, date(2020, 1, 1), None)],
        "edad_actual_asegurado int, edad_ingreso_asegurado int, Sum_Valor_Reservas_Inicial double, F_Notificacion date, FSINIESTRO date, Fecha_Apertura date",
    )
    out = df.select(*[c.alias(n) for n, c in FE.derived_features(df.columns).items()]).collect()
    assert out[0].asDict() == {
        "dias_siniestro_a_apertura": None,
        "dias_siniestro_a_notificacion": None,
        "dias_notificacion_a_apertura": None,
        "delta_edad": None,
        "edad_actual_invalida": 0.0,
        "log_reserva_inicial": 0.0,
        "reserva_inicial_es_cero": 0.0,
    }
    assert out[1].dias_siniestro_a_notificacion == 4 and out[1].dias_siniestro_a_apertura == 31 and out[1].dias_notificacion_a_apertura == 27
    assert out[1].edad_actual_invalida == 1.0 and out[1].reserva_inicial_es_cero == 1.0 and out[1].delta_edad == -21
    assert out[2].log_reserva_inicial == 0.0 and out[2].reserva_inicial_es_cero == 0.0


def test_absent_columns_give_no_feature():
    assert set(FE.derived_features(["FSINIESTRO", "edad_actual_asegurado"])) == set()
    assert FE.calendar_features(["x"]) == {}


def test_calendar_sunday_is_one(spark):
    df = spark.createDataFrame([(date(2024, 6, 2),)], "FSINIESTRO date")
    row = df.select(*[c.alias(n) for n, c in FE.calendar_features(df.columns).items()]).first()
    assert row.mes_siniestro == "6" and row.dia_semana_siniestro == "1"


def test_unreadable_dates_are_counted_not_raised(spark):
    df = spark.createDataFrame([("2020-01-31",), ("31/31/2020",), (None,)], "FSINIESTRO string")
    assert [r[0] for r in FE.parse_dates(df).collect()] == [date(2020, 1, 31), None, None]
    assert FE.unreadable_dates(df).collect()[0].asDict() == {"columna": "FSINIESTRO", "fechas_ilegibles": 1}


def test_decimals_count_as_numeric(spark):
    df = spark.createDataFrame([], "id_reclamacion string, a decimal(10,2), b int, c string, d double, AGENTE int, label double, FSINIESTRO date")
    chosen = FE.feature_columns(df)
    assert chosen == ["a", "b", "c", "d"]
    assert FE.numeric_columns(df, chosen) == ["a", "b", "d"]


def test_lenient_double(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(FE.lenient_double("v")).collect()] == [1.5, None, None]


def test_levels_on_the_thresholds(spark):
    t = C.Thresholds()
    df = spark.createDataFrame([(t.high,), (t.high - 1e-12,), (t.medium,), (t.medium - 1e-12,), (None,)], "s double")
    level = risk_level(F.col("s"))
    rows = df.select(level.alias("l"), risk_action(level).alias("a"), flagged(F.col("s")).alias("f")).collect()
    assert [r.l for r in rows] == ["ALTO", "MEDIO", "MEDIO", "BAJO", "BAJO"]
    assert [r.a for r in rows][:3] == ["REVISION_PRIORITARIA", "REVISION_SECUNDARIA", "REVISION_SECUNDARIA"]
    assert [r.f for r in rows] == [1, 0, 0, 0, 0]


def test_versions_hash_and_missing(spark):
    df = spark.createDataFrame([("m:12",), ("m",), ("a:b:7",), ("m:x",)], "v string")
    assert [r[0] for r in df.select(version_number(F.col("v"))).collect()] == ["12", "m", "7", "m:x"]
    key = df.select(short_hash_key(F.lit("1"), "P-")).first()[0]
    assert key == "P-6b86b273ff34fce19d6b804e" and len(key) == 26
    x = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    assert [r[0] for r in x.select(missing("x")).collect()] == [False, True, True]


def test_input_contract(spark):
    good = spark.createDataFrame([], ", ".join(f"{c} string" for c in C.REQUIRED_COLUMNS))
    K.check_input_columns(good)
    with pytest.raises(ValueError, match="missing"):
        K.check_input_columns(good.drop("A_o"))
    with pytest.raises(ValueError, match="after the outcome"):
        K.check_input_columns(good.withColumn("label", F.lit(1.0)))


def test_feature_contract():
    K.check_features(list(C.FEATURES))
    with pytest.raises(ValueError, match="missing"):
        K.check_features(C.FEATURES[:-1])
    with pytest.raises(ValueError, match="not approved"):
        K.check_features([*C.FEATURES, "x"])
    with pytest.raises(ValueError, match="order"):
        K.check_features(C.FEATURES[::-1])


def test_quarantine_reasons(spark):
    rows = [
        ("a", "2020-01-01", 30, 1, 1, 5.0),
        ("b", "2020-01-01", 30, 1, 1, 5.0),
        ("b", "2020-01-01", 30, 1, 1, 5.0),
        ("c", "2020-01-01", 30, 1, 1, 5.0),
        ("c", "2020-01-01", 30, 1, 1, None),
        ("d", "2020-13-01", 30, 1, 1, 5.0),
        (None, "2020-01-01", 30, 1, 1, 5.0),
        ("e", None, 30, 1, 1, 5.0),
        ("f", "2020-01-01", -1, 1, 1, 5.0),
        ("g", "2020-01-01", None, 1, 1, 5.0),
        ("g", "2020-01-01", 1, None, 1, 5.0),
    ]
    cols = ["id_reclamacion", "FSINIESTRO", "edad_ingreso_asegurado", "vigencia_poliza", "vigencia_certificado", "Sum_Valor_Reservas_Inicial"]
    df = spark.createDataFrame(rows, "id_reclamacion string, FSINIESTRO string, edad_ingreso_asegurado int, vigencia_poliza int, vigencia_certificado int, Sum_Valor_Reservas_Inicial double")
    got = sorted((r.id_reclamacion or "", r.reason_code) for r in K.quarantine(df, cols).collect())
    assert got == [
        ("", "INVALID_SCHEMA"), ("a", "SUCCESS"), ("b", "SUCCESS"), ("b", "SUCCESS"), ("c", "IDEMPOTENCY_CONFLICT"), ("c", "IDEMPOTENCY_CONFLICT"),
        ("d", "INVALID_SCHEMA"), ("e", "INVALID_VALUES"), ("f", "INVALID_VALUES"), ("g", "IDEMPOTENCY_CONFLICT"), ("g", "IDEMPOTENCY_CONFLICT"),
    ]

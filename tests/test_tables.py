from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.operators import merge as M
from claimlens.operators import profile as P
from claimlens.operators import reports as RP
from claimlens.operators.governance import content_fingerprint
from claimlens.plans.batch_scoring import next_batch
from claimlens.sources import policies, tables

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "k string, r string, v int"


def rows(df):
    return sorted(df.collect(), key=lambda r: tuple((x is not None, str(x)) for x in r))


key = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))


@FEW
@given(target=st.lists(st.tuples(key, st.just("1"), st.integers(0, 9)), max_size=8), source=st.lists(st.tuples(st.sampled_from("abcdef"), st.just("1"), st.integers(10, 19)), max_size=6))
def test_insert_merge_twice_is_once(spark, target, source):
    t, s = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    once = M.merge_insert(t, s, ["k", "r"])
    assert rows(M.merge_insert(once, s, ["k", "r"])) == rows(once)
    kept = [r for r in once.collect() if r.v < 10]
    assert sorted(map(str, kept)) == sorted(map(str, t.collect()))


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "1", 1)], SCHEMA)
    s = spark.createDataFrame([(None, "1", 2)], SCHEMA)
    assert M.merge_insert(t, s, ["k", "r"]).count() == 2
    assert M.merge_upsert(t, s, ["k", "r"]).count() == 2
    assert M.merge_update(t, s, ["k", "r"], ["v"]).count() == 2


def test_upsert_and_update(spark):
    t = spark.createDataFrame([("a", "1", 1), ("b", "1", 2)], SCHEMA)
    s = spark.createDataFrame([("b", "9", None), ("c", "9", 3)], SCHEMA)
    assert rows(M.merge_upsert(t, s, ["k"])) == rows(spark.createDataFrame([("a", "1", 1), ("b", "9", None), ("c", "9", 3)], SCHEMA))
    assert rows(M.merge_update(t, s, ["k"], ["v"])) == rows(spark.createDataFrame([("a", "1", 1), ("b", "1", None), ("c", "9", 3)], SCHEMA))
    with pytest.raises(ValueError, match="several rows"):
        M.merge_upsert(t, s.unionByName(s), ["k"])


def test_delete_run_keeps_rows_of_no_run(spark):
    t = spark.createDataFrame([("a", "1"), ("b", None), ("c", "2")], "k string, id_ejecucion string")
    assert [r.k for r in M.delete_run(t, "1").orderBy("k").collect()] == ["b", "c"]


def test_stage_replaces_own_run_only(spark, folder):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "id_ejecucion string, v int")
    path = f"{folder}/stage"
    tables.stage_run(df, path, "x")
    again = tables.stage_run(df.filter("id_ejecucion = 'x' and v = 1"), path, "x")
    assert [(r.id_ejecucion, r.v) for r in again.collect()] == [("x", 1)]
    assert spark.read.parquet(path).filter("id_ejecucion = 'y'").count() == 1


def test_append_replace_and_drop(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "r string, v int")
    tables.append(df, "t_partitioned", ["r"])
    tables.append(df.select("v", "r"), "t_partitioned")
    assert spark.table("t_partitioned").count() == 4
    tables.replace_partitions(spark.createDataFrame([("x", 9)], "r string, v int"), "t_partitioned", ["r"])
    assert sorted((r.r, r.v) for r in spark.table("t_partitioned").collect()) == [("x", 9), ("y", 2), ("y", 2)]
    tables.drop_partition(spark, "t_partitioned", "r", "y")
    assert spark.table("t_partitioned").count() == 1
    tables.drop_partition(spark, "t_partitioned", "r", "not there")


def test_overwrite_changes_the_schema(spark):
    tables.overwrite(spark.createDataFrame([(1,)], "a int"), "t_plain")
    tables.overwrite(spark.createDataFrame([("x", 2)], "b string, c int"), "t_plain")
    assert spark.table("t_plain").columns == ["b", "c"]


def test_missing_table_and_schema_and_view(spark):
    empty = tables.table_or_empty(spark, "no_such_table", spark.createDataFrame([], SCHEMA).schema)
    assert empty.count() == 0 and empty.columns == ["k", "r", "v"]
    tables.create_schema(spark, "zona")
    tables.create_schema(spark, "zona")
    tables.overwrite(spark.createDataFrame([(1,)], "a int"), "zona.t")
    tables.publish_view(spark, "zona.v", None, "SELECT a + 1 AS b FROM zona.t")
    assert tables.scan(spark, "zona.v").first().b == 2


def test_policy_tables(spark):
    tables.create_schema(spark, "politicas")
    names = policies.seed(spark, "politicas")
    policies.seed(spark, "politicas")
    assert {n.split(".")[1] for n in names} == set(policies.policies())
    for name, (_, rows) in policies.policies().items():
        stored = policies.read_policy(spark, f"politicas.{name}").collect()
        assert [r["number"] for r in stored] == list(range(1, len(rows) + 1))
        assert stored == policies.policy(spark, name).collect()


@pytest.mark.parametrize(
    "given, wanted",
    [
        ((0, 1, 0, 0, 0), {"RESTORE_VERSION", "REVIEW_THRESHOLD"}),
        ((2, 0, 0, 0, 0), {"INVESTIGATE"}),
        ((2, 1, 1, 0, 0), {"RETRAIN_ON_RECENT"}),
        ((0, 0, 2, 0, 0), {"REBUILD_FEATURES"}),
        ((0, 0, 0, 1, 3), {"RECALIBRATE", "SEGMENT_AND_LABEL"}),
        ((0, 0, 0, 0, 0), {"KEEP"}),
        ((None, 0, 0, 0, 0), set()),
    ],
)
def test_rules_fire(spark, given, wanted):
    schema = "features_drifted long, score_critical long, losses_critical long, losses_warning long, new_categories long"
    judged = policies.fired(spark.createDataFrame([given], schema), policies.policy(spark, "retraining_decision_policy")).collect()
    assert {r.rule for r in judged if r.fires} == wanted and len(judged) == len(policies.RETRAINING)
    assert all(r.retrain == policies.RETRAINING[r.rule][0] for r in judged)


def test_stored_rule_that_cannot_be_compiled(spark):
    facts = spark.createDataFrame([(1,)], "a int")
    schema = "rule string, retrain boolean, fact string, comparison string, bound double"
    for row in (("r", True, "b", ">", 0.0), ("r", True, "a", "like", 0.0)):
        with pytest.raises(ValueError, match="cannot compare"):
            policies.fired(facts, spark.createDataFrame([row], schema))


def test_profiles(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "a")], "x double, t string")
    assert {r.columna: r.nulos for r in P.null_counts(df).collect()} == {"x": 1, "t": 1}
    assert {r.columna: r.cardinalidad_aprox for r in P.column_profile(df).collect()} == {"x": 2, "t": 1}
    missing = P.missing_profile(df, ["x", "t"]).collect()
    assert [(r.variable, r.valores_faltantes) for r in missing] == [("x", 2), ("t", 1)]
    assert missing[0].porcentaje_faltante == pytest.approx(2 / 3)


def test_key_facts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("  ",), ("  ",)], "id_reclamacion string")
    assert P.key_facts(df) == P.KeyFacts(6, 3, 1)
    assert P.blank_keys(df).count() == 3
    with pytest.raises(ValueError, match="without"):
        P.key_facts(df).require_clean()
    with pytest.raises(ValueError, match="more than once"):
        P.key_facts(df.filter("id_reclamacion in ('a', 'b')")).require_clean()
    assert P.key_facts(df.limit(0)) == P.KeyFacts(0, 0, 0)
    with pytest.raises(ValueError, match="expected"):
        P.verify_batch(df.filter("id_reclamacion = 'b'"), 2)
    P.verify_batch(df.filter("id_reclamacion = 'b'"), 1)


def test_next_batch_is_made_once(spark):
    base = spark.createDataFrame([(f"c{i}", i) for i in range(10)], "id_reclamacion string, v int")
    first = next_batch(base, "DEMO-1-", 4, "DEMO-")
    assert first.count() == 4 and "fecha_ingesta" in first.columns
    after = base.unionByName(first.select(*base.columns))
    assert next_batch(after, "DEMO-1-", 4, "DEMO-").count() == 0
    assert next_batch(after, "DEMO-2-", 4, "DEMO-").count() == 4


def test_latest_score_ties(spark):
    t = datetime(2026, 1, 1)
    raw = [("a", 0.1, t, "m:9", "r2"), ("a", 0.2, t, "m:10", "r1"), ("a", 0.9, datetime(2025, 1, 1), "m:1", "r0"), ("b", 0.3, t, "m", "r1")]
    df = spark.createDataFrame(raw, "id_reclamacion string, score_fraude double, fecha_scoring timestamp, version_modelo string, id_ejecucion string")
    df = df.withColumns({"nivel_riesgo": F.lit("BAJO"), "accion_sugerida": F.lit("x"), "estado_scoring": F.lit("SUCCESS")})
    view = RP.consumer_view(df)
    assert [(r.id_reclamacion, r.score_fraude, r.model_version, r.trace_id) for r in view.orderBy("id_reclamacion").collect()] == [
        ("a", 0.2, "10", "r1"), ("b", 0.3, "m", "r1"),
    ]
    summary = RP.consumer_summary(view).first()
    assert (summary.reclamaciones, summary.reclamaciones_unicas, summary.ultima_actualizacion) == (2, 2, t)
    assert RP.consumer_summary(view.limit(0)).first().reclamaciones == 0


def test_latest_score_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(10).select(
        F.col("id").cast("string").alias("id_reclamacion"), F.rand(1).alias("score_fraude"), F.timestamp_seconds(F.col("id")).alias("fecha_scoring"),
        F.lit("m:1").alias("version_modelo"), F.lit("r").alias("id_ejecucion"),
    )
    plan = RP.latest_scores(df)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_equivalence_fails_loudly(spark):
    a = spark.createDataFrame([("x", 0.5, 1.0)], "id_reclamacion string, score double, prediction double")
    b = spark.createDataFrame([("x", 0.5 + 1e-9, 1.0)], "id_reclamacion string, score double, prediction double")
    RP.require_equivalent(RP.equivalence_summary(RP.score_difference(a, a)))
    with pytest.raises(ValueError, match="differ"):
        RP.require_equivalent(RP.equivalence_summary(RP.score_difference(a, b)))
    with pytest.raises(ValueError, match="no scores"):
        RP.require_equivalent(RP.equivalence_summary(RP.score_difference(a, b.limit(0))))


def test_segments_need_enough_cases(spark):
    data = [("A", "x", 1.0, 0.5)] * 30 + [("B", "y", 0.0, 0.1)] * 29
    df = spark.createDataFrame(data, "REGIONAL string, Otra string, label double, score_fraude double")
    out = RP.segment_table(df).collect()
    assert [(r.segmento, r.valor, r.casos, r.tasa_fraude) for r in out] == [("REGIONAL", "A", 30, 1.0)]


def test_change_rules(spark):
    def scores(ref, cur):
        data = [(C.REFERENCE, int(i < ref)) for i in range(100)] + [(C.CURRENT, int(i < cur)) for i in range(100)]
        return spark.createDataFrame(data, "periodo string, marcado_fraude int")

    assert RP.flagged_rate_change(scores(50, 60)).first().estado == "ESTABLE"
    assert RP.flagged_rate_change(scores(50, 61)).first().estado == "ADVERTENCIA"
    assert RP.flagged_rate_change(scores(50, 71)).first().estado == "CRITICO"
    assert RP.flagged_rate_change(scores(0, 71)).first().estado == "NO_EVALUABLE"
    assert RP.volume_change(scores(1, 1)).first().estado == "ESTABLE"
    assert RP.volume_change(scores(1, 1).filter(F.col("periodo") == C.REFERENCE)).first().estado == "CRITICO"


def test_monitor_states(spark):
    from claimlens.plans.batch_scoring import audit_row

    t0, t1, t2 = datetime(2026, 1, 1, 0), datetime(2026, 1, 1, 1), datetime(2026, 1, 1, 2)
    runs = audit_row(spark, "a", t0, "m", 10, 10, "SUCCESS", end=t1)
    for row in [
        audit_row(spark, "b", t0, "m", 10, 10, "SUCCESS", end=t2),
        audit_row(spark, "c", t0, "m", 10, 9, "SUCCESS", end=t1),
        audit_row(spark, "d", t0, "m", 10, 0, "FAILED", "x", end=t1),
        audit_row(spark, "e", t0, "m", 0, 0, "NO_DATA", end=t1),
    ]:
        runs = runs.unionByName(row)
    got = {r.id_ejecucion: r.estado_monitoreo for r in RP.execution_monitor(runs).collect()}
    assert got == {"a": "NORMAL", "b": "ADVERTENCIA", "c": "ADVERTENCIA", "d": "CRITICO", "e": "SIN_DATOS"}


def test_fingerprint_ignores_order_but_not_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    b = spark.createDataFrame([(2, 3), (1, None)], "a int, b int")
    c = spark.createDataFrame([(None, 1), (2, 3)], "a int, b int")
    assert content_fingerprint(a).first() == content_fingerprint(b).first()
    assert content_fingerprint(a).first().huella != content_fingerprint(c).first().huella
    assert content_fingerprint(a.limit(0)).first().filas == 0


def test_sketch_percentiles_are_within_their_error(spark):
    n = 20000
    df = spark.range(n).select(F.lit("r").alias("id_ejecucion"), (F.col("id") / n).alias("score_fraude"), F.lit("ALTO").alias("nivel_riesgo"),
                               F.current_timestamp().alias("fecha_scoring"), F.lit("m:1").alias("version_modelo"))
    row = RP.execution_distribution(df.repartition(5)).first()
    for got, want in ((row.score_p50, 0.5), (row.score_p90, 0.9), (row.score_p95, 0.95)):
        assert abs(got - want) <= 3e-4
    assert row.porcentaje_alto == 100.0 and row.reclamaciones == n

import math
import os

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.operators import drift as D

FEW = settings(max_examples=int(os.environ.get("EXAMPLES", 4)), deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
INF, NAN = float("inf"), float("nan")


def psi_by_hand(ref, cur, bins=10):
    ref, cur = (np.array([v for v in x if v is not None and math.isfinite(v)]) for x in (ref, cur))
    if len(ref) == 0 or len(cur) == 0:
        return None
    edges = np.unique(np.quantile(ref, np.linspace(0.0, 1.0, bins + 1)))
    if len(edges) < 2:
        return 0.0
    full = np.concatenate(([-np.inf], edges[1:-1], [np.inf]))
    r, c = (np.clip(np.histogram(x, full)[0] / len(x), 1e-6, None) for x in (ref, cur))
    return float(np.sum((c - r) * np.log(c / r)))


def ks_by_hand(ref, cur):
    ref, cur = (np.sort([v for v in x if v is not None and not math.isnan(v)]) for x in (ref, cur))
    both = np.concatenate([ref, cur])
    return float(np.max(np.abs(np.searchsorted(ref, both, side="right") / len(ref) - np.searchsorted(cur, both, side="right") / len(cur))))


def frame(spark, ref, cur):
    rows = [(True, v) for v in ref] + [(False, v) for v in cur]
    return spark.createDataFrame(rows, "ref boolean, x double").repartition(3)


def drift_of(spark, ref, cur):
    return D.numeric_drift(frame(spark, ref, cur), ["x"], F.col("ref")).first()


def check(spark, ref, cur):
    got = drift_of(spark, ref, cur)
    want = psi_by_hand(ref, cur)
    assert (got.psi is None) == (want is None)
    if want is not None:
        assert math.isclose(got.psi, want, rel_tol=1e-9, abs_tol=1e-9)
        assert got.psi >= 0
    if got.ks_statistic is not None:
        assert math.isclose(got.ks_statistic, ks_by_hand(ref, cur), abs_tol=1e-12)
        assert 0 <= got.ks_statistic <= 1
    return got


value = st.one_of(st.integers(-4, 4).map(float), st.just(-0.0), st.floats(-50, 50), st.none(), st.sampled_from([INF, -INF, NAN]))


@FEW
@given(ref=st.lists(value, min_size=1, max_size=60), cur=st.lists(value, min_size=1, max_size=60))
def test_psi_and_ks_by_hand(spark, ref, cur):
    check(spark, ref, cur)


def test_large_rounded_sample(spark):
    rng = np.random.default_rng(1)
    ref = [float(v) for v in np.round(rng.normal(0, 1, 3000), 2)]
    cur = [float(v) for v in np.round(rng.normal(0.3, 1.2, 2000), 2)]
    check(spark, ref, cur)


def test_ties_on_an_edge_and_hot_value(spark):
    check(spark, [1.0] * 50 + [2.0] * 30 + [3.0] * 20, [1.0] * 10 + [2.0] * 80 + [4.0] * 10)
    check(spark, list(map(float, range(11))), [0.0, 3.0, 3.0, 10.0, 11.0])


def test_same_sample_has_no_drift(spark):
    x = [float(i % 17) for i in range(100)]
    got = drift_of(spark, x, x)
    assert got.psi == 0 and got.ks_statistic == 0 and got.ks_pvalue == 1.0


def test_constant_reference(spark):
    assert check(spark, [2.0] * 9, [1.0, 2.0, 3.0]).psi == 0.0


def test_empty_sides(spark):
    for ref, cur in (([1.0], [None]), ([None, NAN], [1.0]), ([INF], [1.0])):
        got = drift_of(spark, ref, cur)
        assert got.psi is None
    empty = drift_of(spark, [None], [None])
    assert empty.psi is None and empty.ks_statistic is None and empty.ks_pvalue is None


def test_infinite_values_count_for_ks_only(spark):
    got = check(spark, [1.0, 2.0, 3.0, INF, INF], [1.0, 2.0, 3.0, -INF])
    assert math.isclose(got.psi, 0.0, abs_tol=1e-9) and got.ks_statistic > 0.2


def test_not_evaluable_row_is_kept(spark):
    df = spark.createDataFrame([(C.REFERENCE, 1.0), (C.CURRENT, None)], "periodo string, x double")
    row = D.drift_table(df, numeric=["x"], categorical=[]).first()
    assert row.drift_status == C.NOT_EVALUABLE and row.psi is None


def cat_by_hand(ref, cur):
    ref, cur = (["__NULL__" if v is None else v for v in x] for x in (ref, cur))
    out = 0.0
    for c in set(ref) | set(cur):
        r, k = max(ref.count(c) / len(ref), 1e-6), max(cur.count(c) / len(cur), 1e-6)
        out += (k - r) * math.log(k / r)
    return out


@FEW
@given(ref=st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=30), cur=st.lists(st.sampled_from(["a", "b", "d", None]), min_size=1, max_size=30))
def test_categorical_psi(spark, ref, cur):
    rows = [(True, v) for v in ref] + [(False, v) for v in cur]
    df = spark.createDataFrame(rows, "ref boolean, c string")
    got = D.categorical_drift(df, ["c"], F.col("ref")).first()
    assert math.isclose(got.psi, cat_by_hand(ref, cur), abs_tol=1e-9)


def test_categorical_with_one_empty_period(spark):
    df = spark.createDataFrame([(True, "a")], "ref boolean, c string")
    assert D.categorical_drift(df, ["c"], F.col("ref")).first().psi is None


def kolmogorov(x):
    return max(0.0, min(1.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 2000))))


@pytest.mark.parametrize("d, n, m", [(0.05, 50, 60), (0.1, 200, 300), (0.02, 5000, 5000), (0.3, 40, 40), (0.9, 1000, 1000), (0.004, 9000, 100)])
def test_ks_pvalue(spark, d, n, m):
    got = spark.range(1).select(D.ks_pvalue(F.lit(d), F.lit(n), F.lit(m))).first()[0]
    assert math.isclose(got, kolmogorov(d * math.sqrt(n * m / (n + m))), abs_tol=1e-9)


def test_status_limits(spark):
    rows = [(None, 0.9, 0.0), (0.25, None, None), (0.24, 0.10, 0.049), (0.24, 0.10, 0.05), (0.10, 0.0, 1.0), (0.0999, 0.09, 0.0), (0.0, None, None)]
    df = spark.createDataFrame(rows, "psi double, ks double, p double")
    got = [r[0] for r in df.select(D.drift_status(F.col("psi"), F.col("ks"), F.col("p"))).collect()]
    assert got == [C.NOT_EVALUABLE, C.CRITICAL, C.CRITICAL, C.WARNING, C.WARNING, C.STABLE, C.STABLE]


def test_alert_text_and_order(spark):
    rows = [
        ("zona", "CATEGORICAL", 0.12, None, None, C.WARNING),
        ("score_fraude", "PREDICTION", 1.23241, 0.30931, 0.0, C.CRITICAL),
        ("edad", "NUMERIC", 0.01, 0.01, 0.9, C.STABLE),
        ("canal_comercial", "CATEGORICAL", 3.851, None, None, C.CRITICAL),
    ]
    table = spark.createDataFrame(rows, "feature_name string, feature_type string, psi double, ks_statistic double, ks_pvalue double, drift_status string")
    alerts = D.active_alerts(table).collect()
    assert [a.alert_source for a in alerts] == ["canal_comercial", "score_fraude", "zona"]
    assert [a.evidence for a in alerts] == ["PSI=3.851", "PSI=1.2324, KS=0.3093", "PSI=0.12"]
    assert alerts[2].recommended_action == C.ALERT_ACTION_DEFAULT
    assert [r.feature_name for r in D.drift_report(table).collect()] == ["canal_comercial", "score_fraude", "zona", "edad"]


def test_shift_reaches_the_target(spark):
    scores = spark.createDataFrame([(str(i), i / 1000) for i in range(1000)], "id_reclamacion string, score_fraude double")
    cutoff = C.Thresholds().high
    before = sum(i / 1000 >= cutoff for i in range(1000))
    moved = D.shifted_scores(scores, D.shift_for_target(scores, 1.40))
    after = moved.filter(F.col("score_fraude") >= cutoff).count()
    assert abs(after - 1.4 * before) <= 2
    assert moved.agg(F.max("score_fraude")).first()[0] <= 1.0
    null = D.shifted_scores(spark.createDataFrame([("a", None)], "id_reclamacion string, score_fraude double"), 0.1)
    assert null.first().score_fraude == 1.0

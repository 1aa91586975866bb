import math
import os

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.operators import ranking as R
from claimlens.operators.evaluation import curve_areas

FEW = settings(max_examples=int(os.environ.get("EXAMPLES", 4)), deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def keyed(spark, values):
    return spark.createDataFrame([(f"{i:04d}", v) for i, v in enumerate(values)], "id string, x double").repartition(3)


SKEWED = [5.0] * 40 + [float(i % 7) for i in range(35)] + [None] * 6 + [1e9, -1e9, 0.125]


def test_order_statistics_with_a_hot_value(spark):
    df = keyed(spark, SKEWED)
    clean = sorted(v for v in SKEWED if v is not None)
    for buckets in (2, 64):
        found = R.order_statistics(df, {"x": lambda n: list(range(1, n + 1))}, buckets)["x"]
        assert [found[i].value for i in range(1, len(clean) + 1)] == clean
        assert all(f.total == len(clean) and 1 <= f.rank_in_ties <= f.ties for f in found.values())


def test_order_statistics_bounds(spark):
    with pytest.raises(ValueError, match="outside"):
        R.order_statistics(keyed(spark, [1.0]), {"x": lambda n: [2]})
    assert R.sample_quantiles(keyed(spark, [None]), "x", [0.5]) == [None]


@FEW
@given(values=st.lists(st.one_of(st.none(), st.floats(-100, 100), st.integers(-3, 3).map(float)), min_size=1, max_size=60), tiles=st.integers(1, 12))
def test_tile_is_ntile(spark, values, tiles):
    df = keyed(spark, values)
    plain = F.ntile(tiles).over(W.orderBy(F.desc_nulls_last("x"), "id"))
    out = R.tile(df, "x", "id", tiles).withColumn("plain", plain)
    assert out.filter("decil <> plain").count() == 0
    sizes = [r["count"] for r in out.groupBy("decil").count().collect()]
    assert max(sizes) - min(sizes) <= 1


@FEW
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float)), min_size=1, max_size=50))
def test_global_rank_is_row_number(spark, values):
    df = keyed(spark, values)
    ranked = R.global_rank(df, [F.desc_nulls_last("x"), F.col("id")], "r")
    plain = F.row_number().over(W.orderBy(F.desc_nulls_last("x"), "id"))
    rows = ranked.withColumn("plain", plain).collect()
    assert len(rows) == len(values) and all(r.r == r.plain for r in rows)


def test_time_split_with_hot_day_and_nulls(spark):
    days = ["2020-01-02"] * 30 + ["2020-01-01"] * 5 + ["2020-03-01"] * 3 + [None] * 10
    df = spark.createDataFrame([(f"{i:03d}", d) for i, d in enumerate(days)], "id string, d string").withColumn("d", F.to_date("d"))
    for share in (0.0, 0.1, 0.5, 0.75, 0.99, 1.0):
        out = R.time_split(df, "d", "id", share)
        number = F.row_number().over(W.orderBy(F.asc_nulls_last("d"), "id"))
        wrong = out.withColumn("n", number).filter((F.col("tramo") == "TRAIN") != (F.col("n") <= int(len(days) * share)))
        assert wrong.count() == 0


def test_time_split_of_nothing(spark):
    df = spark.createDataFrame([], "id string, d date")
    assert R.time_split(df, "d", "id").count() == 0


def test_sample_quantiles_match_spark(spark):
    df = keyed(spark, SKEWED)
    shares = [0.0, 0.1, 0.37, 0.5, 0.9, 1.0]
    assert R.sample_quantiles(df, "x", shares) == df.approxQuantile("x", shares, 0.0)


def auc_by_hand(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def pr_by_hand(labels, scores):
    total = sum(labels)
    area, recall, precision = 0.0, 0.0, None
    for cut in sorted(set(scores), reverse=True):
        chosen = [y for y, s in zip(labels, scores) if s >= cut]
        p, r = sum(chosen) / len(chosen), sum(chosen) / total
        area += (r - recall) * (p + (p if precision is None else precision)) / 2
        recall, precision = r, p
    return area


@FEW
@given(rows=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6).map(lambda v: v / 6)), min_size=1, max_size=40))
def test_curve_areas(spark, rows):
    df = spark.createDataFrame([(float(y), s) for y, s in rows], "label double, score_fraude double")
    got = curve_areas(df).first()
    labels, scores = [y for y, _ in rows], [s for _, s in rows]
    want = auc_by_hand(labels, scores)
    if want is None:
        assert got.roc_auc is None
    else:
        assert math.isclose(got.roc_auc, want, abs_tol=1e-12)
        assert math.isclose(got.area_under_pr, pr_by_hand(labels, scores), abs_tol=1e-12)


def test_curve_areas_near_the_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 800)
    s = np.round(rng.normal(y, 1.5), 2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, s)], "label double, score_fraude double")
    got = curve_areas(df).first()
    for metric, value in (("areaUnderROC", got.roc_auc), ("areaUnderPR", got.area_under_pr)):
        exact = BinaryClassificationEvaluator(rawPredictionCol="score_fraude", metricName=metric, numBins=0).evaluate(df)
        assert math.isclose(exact, value, abs_tol=1e-9)


def test_curve_areas_keep_the_null_group(spark):
    rows = [(g, float(i % 2), i / 10) for g in ("a", None) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, label double, score_fraude double")
    out = {r.g: r for r in curve_areas(df, by=["g"]).collect()}
    assert set(out) == {"a", None} and out["a"].roc_auc == out[None].roc_auc and out[None].positivos == 5


def test_tiles_of_odd_scores(spark):
    """Nulls and NaN come after everything, negative infinity included."""
    scores = [float("inf"), 3.0, 2.0, 1.0, float("-inf"), None, float("nan"), None]
    df = spark.createDataFrame([(f"k{i}", s) for i, s in enumerate(scores)], "key string, score double")
    got = {r["key"]: r["decil"] for r in R.tile(df, "score", "key", tiles=8).collect()}
    assert [got[f"k{i}"] for i in range(5)] == [1, 2, 3, 4, 5] and {got[f"k{i}"] for i in (5, 6, 7)} == {6, 7, 8}

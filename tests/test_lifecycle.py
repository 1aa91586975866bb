from datetime import datetime

import pytest

from claimlens.operators import governance as G
from claimlens.plans import lifecycle as L

GOOD = {"roc_auc": 0.80, "area_under_pr": 0.60, "top20_capture": 0.41, "seed": 42}
MODEL = "m"


def day(n):
    return datetime(2026, 1, n)


def test_life_of_a_candidate(spark, folder):
    t = L.LifecycleTables("lv", "le", "lg", "lm", folder)
    assert L.add_version(spark, t, MODEL, "first", **GOOD, git_commit="c1") == "1"
    L.point(spark, t, MODEL, G.CHAMPION, "1", "baseline-1", day(1), "yo", "BASELINE_SNAPSHOT")
    L.point(spark, t, MODEL, G.CHAMPION, "1", "baseline-1", day(9), "otra", "BASELINE_SNAPSHOT")
    assert L.events(spark, t).count() == 1
    # The candidate is made once, however often it is asked for.
    assert [L.add_version(spark, t, MODEL, "second", **GOOD) for _ in range(2)] == ["2", "2"]
    L.point(spark, t, MODEL, G.CANDIDATE, "2", "candidate-2", day(2), "yo", "REGISTER")
    with pytest.raises(ValueError, match="blocked"):
        L.promote(spark, t, MODEL, day(3), "yo", "T1")  # never validated
    assert [L.validate(spark, t, MODEL, day(3)) for _ in range(2)] == ["PASS_WITH_EXCEPTION"] * 2
    assert spark.table(t.gates).count() == 9
    with pytest.raises(ValueError, match="blocked"):
        L.promote(spark, t, MODEL, day(4), "yo", "T1")
    assert L.aliases(spark, t, MODEL) == {G.CHAMPION: "1", G.CANDIDATE: "2"}
    assert L.promote(spark, t, MODEL, day(4), "yo", "T1", allow_exception=True)
    assert L.aliases(spark, t, MODEL) == {G.CHAMPION: "2", G.CANDIDATE: "2", G.PREVIOUS: "1"}
    assert not L.promote(spark, t, MODEL, day(5), "yo", "T1", allow_exception=True)
    assert L.roll_back(spark, t, MODEL, day(6), "yo", "T2")
    assert L.aliases(spark, t, MODEL) == {G.CHAMPION: "1", G.CANDIDATE: "2", G.PREVIOUS: "1", G.ROLLED_BACK: "2"}
    assert not L.roll_back(spark, t, MODEL, day(7), "yo", "T2")
    assert L.events(spark, t).count() == 6


def test_weak_candidate_is_blocked(spark, folder):
    t = L.LifecycleTables("wv", "we", "wg", "wm", folder)
    L.add_version(spark, t, MODEL, "first", **GOOD, git_commit="c1")
    L.add_version(spark, t, MODEL, "second", **{**GOOD, "roc_auc": 0.77}, git_commit="c2")
    L.point(spark, t, MODEL, G.CHAMPION, "1", "b", day(1), "yo", "BASELINE_SNAPSHOT")
    L.point(spark, t, MODEL, G.CANDIDATE, "2", "c", day(2), "yo", "REGISTER")
    assert L.validate(spark, t, MODEL, day(3)) == "FAIL"
    with pytest.raises(ValueError, match="blocked"):
        L.promote(spark, t, MODEL, day(4), "yo", "T1", allow_exception=True)
    report = G.latest_candidate_report(spark.table(t.gates)).collect()
    assert [r.gate_name for r in report if r.gate_status == "FAIL"] == ["MAX_ROC_DEGRADATION"] and report[0].gate_status == "FAIL"


def test_table_merges(spark):
    def one(id, at, reason, target):
        row = (id, at, MODEL, "PROMOTE", "1", target, G.CHAMPION, "PASS", "yo", reason, None)
        return spark.createDataFrame([row], G.EVENT_SCHEMA)

    log = G.record_events(one("e", day(1), "old", "2"), one("e", day(2), "new", "3"))
    row = log.first()
    assert (log.count(), row.reason, row.event_timestamp, row.target_version) == (1, "new", day(2), "2")
    src = spark.range(3)
    a = G.manifest(src, "x", MODEL, "1", {"seed": 1}, {"roc_auc": 0.5}, day(1), "t")
    b = G.manifest(src, "x", MODEL, "2", {"seed": 2}, {"roc_auc": 0.6}, day(2), "t")
    assert [r.model_version for r in G.record_manifest(a, b).collect()] == ["1"]

"""Cells are divided as often as a question needs: same results with few buckets and small leaves, few values looked at."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.operators import drift as D
from claimlens.operators import narrowing as N
from claimlens.operators import ranking as R
from claimlens.operators.evaluation import curve_areas

INF = float("inf")


TINY = 5e-324


@pytest.mark.parametrize("low, high", [(0.0, 1.0), (-5.0, 3.0), (1.0, math.nextafter(1.0, 2.0)), (0.0, TINY), (-1e308, 1e308), (TINY, 3 * TINY)])
def test_parts_ascend_and_separate_the_ends(spark, low, high):
    rng = random.Random(1)
    values = sorted({low, high, *[min(high, max(low, low + (high - low) * rng.random() ** k)) for k in (1, 9, 99) for _ in range(50) if high - low < INF]})
    for by_log in (False, True):
        rows = [(v, low, high, by_log) for v in values]
        df = spark.createDataFrame(rows, "value double, low double, high double, by_log boolean")
        parts = [r[0] for r in df.select(N.part_of(F.lit(8))).collect()]
        assert parts == sorted(parts) and parts[0] == 0 and parts[-1] == 7


def test_far_value_does_not_hold_up_the_division(spark):
    """All values lie close together but one: even steps fail, steps of the logarithm do not."""
    values = [1.0 + i * 1e-12 for i in range(2000)] + [1e300]
    cells = N.Cells(made(spark, values), ["x"], buckets=4)
    cells.fine_edges("x", leaf=20)
    assert max(c.n for c in cells.cells["x"]) <= 20 and cells.passes < 20


def made(spark, values):
    return spark.createDataFrame([(f"{i:05d}", v) for i, v in enumerate(values)], "id string, x double").repartition(3)


def uneven(n, seed=1):
    rng = random.Random(seed)
    values = [rng.choice([rng.lognormvariate(0, 5), -rng.lognormvariate(0, 5), round(rng.gauss(0, 1), 1), 7.0]) for _ in range(n)]
    return values + [INF, INF, -INF, None, float("nan"), None]


def test_order_statistics_on_many_levels(spark):
    """Four buckets, leaves of three rows: several counting passes, the same values as in one list."""
    values = uneven(900)
    df = made(spark, values)
    clean = sorted(v for v in values if v is not None and not math.isnan(v))
    wanted = [1, 2, 17, 300, 450, 451, len(clean) - 1, len(clean)]
    for buckets, leaf in ((4, 9), (4, 10**6)):
        found = R.order_statistics(df, {"x": lambda n: wanted}, buckets, leaf)["x"]
        assert [found[r].value for r in wanted] == [clean[r - 1] for r in wanted]
        for r, f in found.items():
            assert f.ties == clean.count(f.value) and clean.index(f.value) + f.rank_in_ties == r


def test_levels_are_needed_and_taken(spark):
    cells = N.Cells(made(spark, [i / 7 for i in range(4000)]), ["x"], buckets=4)
    assert cells.passes == 2 and len(cells.cells["x"]) <= 6
    edges = cells.fine_edges("x", leaf=20)
    assert cells.passes >= 5 and max(c.n for c in cells.cells["x"]) <= 20
    assert cells.total("x") == 4000 and edges == sorted(set(edges))


def test_nulls_come_last_and_do_not_meet_infinity(spark):
    values = [1.0, None, INF, INF, None, float("nan"), -INF]
    df = made(spark, values)
    cuts = R.cut_points(df, F.col("x"), F.col("id"), lambda n: list(range(1, n + 1)))
    assert [cuts[r][0] for r in range(1, 8)] == [-INF, 1.0, INF, INF, None, None, None]
    for rank, cut in cuts.items():
        assert df.filter(~R.beyond_cut(N.plain_double(F.col("x")), F.col("id"), cut)).count() == rank


def areas_by_group(spark, rows, **more):
    df = spark.createDataFrame(rows, "g string, label double, score_fraude double").repartition(5)
    return {r.g: (r.positivos, r.negativos, r.roc_auc, r.area_under_pr) for r in curve_areas(df, by=["g"], **more).collect()}


def test_curve_areas_with_one_group_of_nearly_all_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [("big" if i % 100 else "small", float(rng.random() < 0.3), rng.random() ** 3) for i in range(6000)]
    wanted = areas_by_group(spark, rows)
    monkeypatch.setattr(R, "TOGETHER", 4)  # buckets, runs of buckets, and totals of runs
    found = areas_by_group(spark, rows, leaf=25)
    assert found.keys() == wanted.keys() == {"big", "small"}
    for g, numbers in wanted.items():
        assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(found[g], numbers))


def test_fine_buckets_split_a_group_into_many_windows(spark):
    df = made(spark, [i / 3 for i in range(5000)])
    edges = N.Cells(df, ["x"], buckets=4).fine_edges("x", leaf=50)
    sizes = N.with_buckets(df, {"x": edges}).groupBy("x__b").count()
    assert sizes.agg(F.max("count")).first()[0] <= 50 and sizes.count() >= 100


def halves(spark, n, seed=5):
    rng = np.random.default_rng(seed)
    columns = [rng.normal(0, 1, n), rng.lognormal(0, 2, n), rng.random(n)]
    rows = [(i % 2 == 0, *map(float, r)) for i, r in enumerate(zip(*columns))]
    return spark.createDataFrame(rows, "ref boolean, a double, b double, c double").repartition(4), columns


def test_ks_of_equal_halves_looks_at_few_values(spark):
    """Reference and current rows of one distribution: less than a tenth of each column's values is looked at."""
    df, columns = halves(spark, 20_000)
    known, looked = D.narrowed(df, ["a", "b", "c"], F.col("ref"), C.DriftLimits())
    seen = {}
    for rows in looked.kept:
        for r in rows.groupBy("name").count().collect():
            seen[r["name"]] = seen.get(r["name"], 0) + r["count"]
    for name, values in zip("abc", columns):
        ref, cur = np.sort(values[::2]), np.sort(values[1::2])
        both = np.concatenate([ref, cur])
        distance = np.abs(np.searchsorted(ref, both, "right") / len(ref) - np.searchsorted(cur, both, "right") / len(cur))
        assert math.isclose(known[name].ks, distance.max(), abs_tol=1e-12)
        assert seen.get(name, 0) < 0.1 * len(values)


def test_psi_needs_three_passes(spark):
    """Sketch, counts, one look: the bins need no pass of their own. The distance has a sharp peak."""
    rows = [(i % 2 == 0, (i * 7919 % 8009) / (8009 if i % 2 == 0 else 16018)) for i in range(8000)]
    df = spark.createDataFrame(rows, "ref boolean, x double").repartition(3)
    known, looked = D.narrowed(df, ["x"], F.col("ref"), C.DriftLimits())
    edges = D._edges(known["x"].at, known["x"].n_fin, 10)
    counted = D.bin_counts(known, looked, {"x": edges[1:-1]})
    assert looked.cells.passes <= 3 and sum(r for _, r, _ in counted) == sum(c for _, _, c in counted) == 4000


@pytest.mark.parametrize("buckets, leaf", [(4, 12), (16, 10**6)])
def test_drift_on_many_levels(spark, buckets, leaf):
    values = uneven(300, 9)
    rows = [(i % 3 > 0, v if i % 3 or v is None else v + 0.5) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "ref boolean, x double").repartition(3)
    wanted = D.numeric_drift(df, ["x"], F.col("ref")).first()
    found = D.numeric_drift(df, ["x"], F.col("ref"), buckets=buckets, leaf=leaf).first()
    assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(found[2:], wanted[2:]))


def test_edge_between_reference_values_with_current_values_between(spark):
    """An interpolated edge cuts cells that hold values of the current period only."""
    rows = [(True, float(i)) for i in range(0, 1000, 100)] * 20 + [(False, i / 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "ref boolean, x double")
    known, looked = D.narrowed(df, ["x"], F.col("ref"), C.DriftLimits())
    edges = D._edges(known["x"].at, known["x"].n_fin, 10)[1:-1]
    counted = D.bin_counts(known, looked, {"x": edges})
    bounds = [-INF, *edges, INF]
    assert [c for _, _, c in counted] == [sum(a <= i / 3 < b for i in range(3000)) for a, b in zip(bounds, bounds[1:])]

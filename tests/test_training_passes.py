"""Training reads, predicts and compares no row more often than it must."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.operators import evaluation as EV
from claimlens.operators import model as MD
from claimlens.operators import ranking as R
from claimlens.plans import monitor_queries as MQ
from claimlens.plans import training as TR
from claimlens.sources.tables import write_and_read

FOLDER = "/root/testdata/sf0.001"


def executed(df) -> str:
    """The final plan of a frame that has been run."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_areas_read_their_points_once(spark, tmp_path):
    rows = spark.range(4000).select((F.col("id") % 7 == 0).cast("double").alias("label"), (F.xxhash64("id") % 1000).alias("score"), (F.col("id") % 2).alias("model"))
    areas = EV.curve_areas(write_and_read(rows, str(tmp_path / "scores")), "score", "label", ["model"])
    assert len(areas.collect()) == 2
    assert executed(areas).count("FileScan parquet") == 1


def test_test_rows_are_predicted_once(spark, monkeypatch):
    calls = []
    transform = RandomForestClassificationModel.transform
    monkeypatch.setattr(RandomForestClassificationModel, "transform", lambda self, df, *a: calls.append(1) or transform(self, df, *a))
    result = TR.train(MQ.training_input(spark, FOLDER), names=["random_forest"])
    assert len(calls) == 1
    doubles = result.test.withColumns({f: F.col(f).cast("double") for f in C.FEATURES})
    again = MD.apply_model(result.best.model, doubles)
    own = result.scored.select(*again.columns)
    assert own.schema.simpleString() == again.schema.simpleString()
    assert own.count() == again.count() and own.exceptAll(again).isEmpty()


def test_equivalence_keeps_the_row_it_checked(spark, tmp_path):
    raw = TR.split_frame(MQ.training_input(spark, FOLDER))
    rows = raw.withColumns({f: F.col(f).cast("double") for f in C.FEATURES})
    model = MD.fit_all(rows.filter("tramo = 'TRAIN'"), rows.filter("tramo = 'TEST'"), names=["logistic_regression"])[0].model
    summary = MD.model_equivalence(model, model, rows)
    # Nothing is left to be read: the models are not applied again when the result is used.
    assert summary.inputFiles() == []
    assert summary.first().asDict() == {"registros_comparados": rows.count(), "predicciones_diferentes": 0, "max_diferencia_score": 0.0}


@pytest.mark.parametrize("nulls_last", [False, True])
def test_counted_ranks_by_brute_force(spark, nulls_last):
    nan = float("nan")
    own = [3.0, None, nan, -0.0, 0.0, 5.5, -math.inf, 3.0, 3.0, math.inf, *map(float, range(40))]
    df = spark.createDataFrame([(v, None) for v in own], "a double, b double").repartition(5)
    values = sorted(v for v in own if v is not None and v == v)
    everything = [*values, *[None] * 2] if nulls_last else values
    found = R.counted_order_statistics(df, {"a": lambda n: list(range(1, n + 1)), "b": lambda n: [n] if n else []}, nulls_last)
    for rank, value in enumerate(everything, 1):
        first = everything.index(value)
        assert found["a"][rank] == R.Found(value, rank - first, everything.count(value), len(everything))
    assert {r: f.value for r, f in found["b"].items()} == ({len(own): None} if nulls_last else {})


def test_medians_and_split_take_no_passes_of_cells(spark, monkeypatch):
    def refused(*_, **__):
        raise AssertionError("cells were counted")

    monkeypatch.setattr(R, "Cells", refused)
    tagged = TR.split_frame(MQ.training_input(spark, FOLDER))
    n = tagged.count()
    assert tagged.filter("tramo = 'TRAIN'").count() == n * 3 // 4
    medians = MD.exact_medians(tagged, ["A_o", "Sum_Valor_Reservas_Inicial"])
    for name, median in medians.items():
        values = sorted(float(r[0]) for r in tagged.select(name).filter(F.col(name).isNotNull()).collect())
        assert median == values[-(-len(values) // 2) - 1]

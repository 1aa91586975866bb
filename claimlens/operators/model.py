"""Training, comparing, saving and applying classifiers with Spark ML."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from claimlens import config as C
from claimlens.functions.scoring import probability_of_one
from claimlens.operators.evaluation import curve_areas
from claimlens.operators.ranking import counted_order_statistics
from claimlens.operators.reports import equivalence_summary, require_equivalent, score_difference
from claimlens.session import run_folder
from claimlens.sources.tables import write_and_read


# Training rows are placed in so many partitions at least, and in more where a partition would hold more rows than this.
LEAST_PLACEMENT, PLACED_ROWS = 16, 1_000_000


def placement_of(rows: int) -> int:
    """Partitions for so many training rows: a rule of the table alone, so that the trees can be grown again."""
    return max(LEAST_PLACEMENT, -(-rows // PLACED_ROWS))


def classifiers(seed: int = C.SEED) -> dict[str, object]:
    """The three competing classifiers, with their fixed settings."""
    common = {"featuresCol": "features", "labelCol": "label"}
    return {
        "logistic_regression": LogisticRegression(maxIter=30, regParam=0.10, elasticNetParam=0.0, **common),
        "random_forest": RandomForestClassifier(numTrees=50, maxDepth=6, seed=seed, **common),
        "gradient_boosting": GBTClassifier(maxIter=30, maxDepth=3, seed=seed, **common),
    }


def exact_medians(df: DataFrame, features: list[str]) -> dict[str, float]:
    """The least value of each feature that at least half of its values do not exceed; all features in the same passes."""
    found = counted_order_statistics(df, {f: lambda n: [-(-n // 2)] if n else [] for f in features})
    empty = [f for f in features if not found[f]]
    if empty:
        raise ValueError(f"features without any value have no median: {empty}")
    return {f: next(iter(found[f].values())).value for f in features}


def fill_stage(medians: dict[str, float]) -> Transformer:
    """Puts the medians in the place of nulls and NaN, as ``<feature>_imputed``; saved with the pipeline like any stage."""
    filled = ", ".join(f"coalesce(nanvl(`{f}`, CAST(NULL AS DOUBLE)), CAST('{m!r}' AS DOUBLE)) AS `{f}_imputed`" for f, m in medians.items())
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def fit_preparation(train: DataFrame, features: list[str] = C.FEATURES) -> list[Transformer]:
    """Median imputer, assembler and scaler, fitted once for all classifiers."""
    filled = [f"{f}_imputed" for f in features]
    imputer = fill_stage(exact_medians(train, features))
    assembler = VectorAssembler(inputCols=filled, outputCol="features_raw", handleInvalid="keep")
    assembled = assembler.transform(imputer.transform(train))
    scaler = StandardScaler(inputCol="features_raw", outputCol="features").fit(assembled)
    return [imputer, assembler, scaler]


@dataclass(frozen=True)
class LinearModel:
    """A logistic model as one column expression: no vectors, no model file at scoring time.

    ``features`` are its inputs in order; who publishes its scores checks them. A missing input takes its fill value.
    """

    features: tuple[str, ...]
    weights: tuple[float, ...]
    fill: tuple[float, ...]
    intercept: float

    def probability(self) -> Column:
        value = lambda f, m: F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.lit(m))
        terms = [F.lit(w) * value(f, m) for f, w, m in zip(self.features, self.weights, self.fill)]
        return 1.0 / (1.0 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.intercept))))

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumn("score_fraude", self.probability())


def linear_model(model: PipelineModel, features: list[str] = C.FEATURES) -> LinearModel:
    """The column expression of a fitted or loaded logistic regression; the scaler's divisors go into the weights."""
    fill, _, scaler, fitted = model.stages
    names = [f"{f}_imputed" for f in features]
    row = fill.transform(SparkSession.getActiveSession().createDataFrame([(None,) * len(features)], ", ".join(f"`{f}` double" for f in features)))
    medians = row.select(*names).first()
    divisors = [float(s) if scaler.getWithStd() and s else 1.0 for s in scaler.std]
    # A constant feature is scaled to zero.
    weights = [float(c) / d if s else 0.0 for c, d, s in zip(fitted.coefficients, divisors, scaler.std)]
    return LinearModel(tuple(features), tuple(weights), tuple(medians), float(fitted.intercept))


def placed_by_key(df: DataFrame, placement: int, key: str = C.KEY) -> DataFrame:
    """Rows placed and ordered by key, so that tree sampling is repeatable.

    Bagging depends on the order of rows within each partition. The number of key-hashed partitions,
    each sorted, is an argument of its own: the session's settings do not change the trees.
    """
    return df.repartition(placement, key).sortWithinPartitions(key)


@dataclass(frozen=True)
class Trained:
    name: str
    model: PipelineModel
    roc_auc: float
    area_under_pr: float
    placement: int

    def parameters(self, seed: int = C.SEED) -> dict[str, int]:
        """What a manifest must keep so that the same trees can be grown again."""
        return {"placement": self.placement, "seed": seed}


def scored_by_all(models: dict[str, Transformer], prepare: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and, per model, ``prediction_<name>`` and ``score_<name>``; the rows are prepared once for all."""
    added = prepare.transform(df)
    for name, model in models.items():
        # The next model writes columns of the same names.
        added = model.transform(added).withColumn(f"score_{name}", probability_of_one()).withColumnRenamed("prediction", f"prediction_{name}")
        added = added.drop("rawPrediction", "probability")
    return added.select(*keep, *[f"{c}_{n}" for n in models for c in ("prediction", "score")])


def areas_of(scored: DataFrame, names: list[str]) -> dict[str, Row]:
    """Exact areas of all models from the stored scores of ``scored_by_all``."""
    cells = ", ".join(f"'{n}', score_{n}" for n in names)
    long = scored.select("label", F.expr(f"stack({len(names)}, {cells}) as (model, score)"))
    return {r["model"]: r for r in curve_areas(long, "score", "label", ["model"]).collect()}


def fit_all(
    train: DataFrame, test: DataFrame, features: list[str] = C.FEATURES, names: list[str] | None = None, seed: int = C.SEED, key: str = C.KEY,
    placement: int | None = None,
) -> list[Trained]:
    """Fit every classifier on the same prepared rows and measure it on the test rows."""
    return fit_and_score(train, test, [key, "label"], features, names, seed, key, placement)[0]


def fit_and_score(
    train: DataFrame, test: DataFrame, keep: list[str], features: list[str] = C.FEATURES, names: list[str] | None = None, seed: int = C.SEED,
    key: str = C.KEY, placement: int | None = None,
) -> tuple[list[Trained], DataFrame]:
    """``fit_all``, and the test rows' columns ``keep`` (label among them) with the prediction and score of every model.

    The preparation is fitted on the rows as they lie; only the prepared vectors are shuffled, once,
    and cached (with spill) for all fits. The test rows are predicted once, by all models, and stored: areas and later
    tables read the stored scores. Features come out as doubles.
    """
    doubles = [F.col(f).cast("double").alias(f) for f in features]
    preparation = fit_preparation(train.select(*doubles), features)
    prepare = PipelineModel(preparation)

    vectors = prepare.transform(train.select(key, "label", *doubles)).select(key, "label", "features")
    # The count of a stored table is read from its footers.
    placement = placement or placement_of(train.count())
    ready = placed_by_key(vectors, placement, key).persist(StorageLevel.MEMORY_AND_DISK)
    fitted = {}
    try:
        for name, classifier in classifiers(seed).items():
            if names is None or name in names:
                fitted[name] = classifier.fit(ready)
    finally:
        ready.unpersist()
    cast = test.withColumns({f: F.col(f).cast("double") for f in features})
    scored = write_and_read(scored_by_all(fitted, prepare, cast, keep), run_folder(train.sparkSession, "scored"))
    areas = areas_of(scored, list(fitted))
    return [
        Trained(n, PipelineModel([*preparation, m]), areas[n]["roc_auc"], areas[n]["area_under_pr"], placement) for n, m in fitted.items()
    ], scored


def best_of(trained: list[Trained]) -> Trained:
    """Highest area under PR; the first one wins a tie."""
    return max(trained, key=lambda t: t.area_under_pr)


def metrics_table(spark, trained: list[Trained]) -> DataFrame:
    rows = [(t.name, t.roc_auc, t.area_under_pr) for t in trained]
    return spark.createDataFrame(rows, "model string, roc_auc double, area_under_pr double").orderBy(F.desc("area_under_pr"))


def apply_model(model: PipelineModel, df: DataFrame, out: str = "score_fraude") -> DataFrame:
    """All input columns plus the class-1 probability and the predicted class."""
    added = model.transform(df).withColumn(out, probability_of_one())
    return added.select(*df.columns, "prediction", out)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def contract_sample(df: DataFrame, features: list[str] = C.FEATURES, n: int = 10) -> DataFrame:
    """A few rows as the model's input example, every feature a double."""
    return df.select(*[F.col(f).cast("double").alias(f) for f in features]).limit(n)


def input_signature(features: list[str] = C.FEATURES) -> str:
    """The input contract of a saved model as JSON text."""
    return json.dumps({"inputs": [{"name": f, "type": "double"} for f in features], "outputs": [{"name": "prediction", "type": "double"}]})


def model_equivalence(first: PipelineModel, second: PipelineModel, df: DataFrame, key: str = C.KEY, check: bool = True) -> DataFrame:
    """Compare two models on the same claims by business key; fail above the tolerance."""

    def scores(model: PipelineModel) -> DataFrame:
        return apply_model(model, df, "score").select(key, "prediction", "score")

    summary = equivalence_summary(score_difference(scores(first), scores(second), key))
    if check:
        # The one row that was checked is the result, so that the models are applied once.
        summary = df.sparkSession.createDataFrame(summary.collect(), summary.schema)
        require_equivalent(summary)
    return summary

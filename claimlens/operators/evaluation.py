"""Exact curve areas and threshold metrics from a label and a score column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.operators.narrowing import LEAF, Cells, plain_double
from claimlens.operators.ranking import running_totals


def curve_areas(
    df: DataFrame, score: str = "score_fraude", label: str = "label", by: list[str] = [], leaf: int = LEAF
) -> DataFrame:
    """Exact area under ROC and under precision-recall, per group of ``by``.

    Rows are first counted per distinct score, so equal scores form one curve point (the rank-sum
    form with half credit for ties). Both areas use trapezoids over all points; the PR curve
    starts at recall 0 with the precision of its first point. Areas are null without both classes.
    """
    plain = plain_double(F.col(score)).alias(score)
    splits = Cells(df.select(plain), [score]).fine_edges(score, leaf)
    points = df.select(*by, label, plain).filter(F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1.0).alias("pos"), F.count_if(F.col(label) != 1.0).alias("neg")
    )
    curve = running_totals(points, score, ["pos", "neg"], splits, by)
    pos, neg, tp, fp = F.col("pos"), F.col("neg"), F.col("pos_before"), F.col("neg_before")
    precision = (tp + pos) / (tp + pos + fp + neg)
    first = (tp + fp) == 0
    before = F.when(first, precision).otherwise(F.try_divide(tp, tp + fp))
    sums = curve.groupBy(*by).agg(
        F.sum("pos").alias("positivos"),
        F.sum("neg").alias("negativos"),
        F.sum(neg * (tp + pos / 2.0)).alias("roc"),
        F.sum(pos * (precision + before) / 2.0).alias("pr"),
    )
    return sums.select(
        *by,
        "positivos",
        "negativos",
        F.try_divide("roc", F.col("positivos").cast("double") * F.col("negativos")).alias("roc_auc"),
        F.when(F.col("negativos") > 0, F.try_divide("pr", F.col("positivos"))).alias("area_under_pr"),
    )


def confusion(df: DataFrame, score: str = "score_fraude", label: str = "label", cutoff: float = 0.5) -> DataFrame:
    return (
        df.withColumn("pred_label", F.when(F.col(score) >= cutoff, 1.0).otherwise(0.0))
        .groupBy(label, "pred_label")
        .agg(F.count("*").alias("casos"))
    )


def threshold_metrics(df: DataFrame, cutoff: float, score: str = "score_fraude", label: str = "label", by: list[str] = []) -> DataFrame:
    """Precision, recall and false-positive rate at a cutoff."""
    hit, flag = F.col(label) == 1.0, F.col(score) >= cutoff
    counts = df.groupBy(*by).agg(
        F.count_if(hit & flag).alias("vp"),
        F.count_if(~hit & flag).alias("fp"),
        F.count_if(hit & ~flag).alias("fn"),
        F.count_if(~hit & ~flag).alias("vn"),
    )
    return counts.select(
        "*",
        F.try_divide("vp", F.col("vp") + F.col("fp")).alias("precision"),
        F.try_divide("vp", F.col("vp") + F.col("fn")).alias("recall"),
        F.try_divide("fp", F.col("fp") + F.col("vn")).alias("tasa_falsos_positivos"),
    )


def brier(df: DataFrame, score: str = "score_fraude", label: str = "label", by: list[str] = []) -> DataFrame:
    error = F.col(score) - F.col(label)
    return df.groupBy(*by).agg(F.count("*").alias("casos"), F.avg(error * error).alias("brier"))


def calibration(df: DataFrame, bins: int = 10, score: str = "score_fraude", label: str = "label", by: list[str] = []) -> DataFrame:
    """Mean score against observed rate in equal-width score bins 0..bins-1."""
    number = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(*by, number.alias("tramo_score")).agg(
        F.count("*").alias("casos"), F.avg(score).alias("score_promedio"), F.avg(label).alias("tasa_observada")
    )


def relative_loss(areas: DataFrame, period: str, reference: str, current: str, warning: float = 0.05, critical: float = 0.10) -> DataFrame:
    """Relative loss of each area from the reference to the current period (two rows in, two out)."""
    long = areas.unpivot([period], ["roc_auc", "area_under_pr"], "metrica", "valor")
    pair = long.groupBy("metrica").agg(
        F.max(F.when(F.col(period) == reference, F.col("valor"))).alias("referencia"),
        F.max(F.when(F.col(period) == current, F.col("valor"))).alias("actual"),
    )
    loss = F.try_divide(F.col("referencia") - F.col("actual"), F.col("referencia"))
    return pair.select(
        "*",
        loss.alias("perdida_relativa"),
        F.when(loss.isNull(), "NO_EVALUABLE").when(loss > critical, "CRITICO").when(loss > warning, "ADVERTENCIA").otherwise("ESTABLE").alias("estado"),
    )


def top_share(lift: DataFrame, upto: int = 2) -> DataFrame:
    """Share of all positives in the first ``upto`` tiles of a lift table."""
    return lift.agg(
        F.try_divide(F.sum(F.when(F.col("decil") <= upto, F.col("fraudes"))), F.sum("fraudes")).alias("captura_top_20")
    )


def lift_table(df: DataFrame, score: str = "score_fraude", label: str = "label", tile: str = "decil") -> DataFrame:
    """Cases, positives, score range, rate and lift per tile; the base rate comes from the same pass.

    The window runs over one row per tile.
    """
    per_tile = df.groupBy(tile).agg(
        F.count("*").alias("casos"),
        F.sum(label).alias("fraudes"),
        F.min(score).alias("score_min"),
        F.max(score).alias("score_max"),
        F.avg(label).alias("tasa_fraude"),
    )
    everything = W.partitionBy(F.lit(0))
    base = F.sum("fraudes").over(everything) / F.sum("casos").over(everything)
    return per_tile.withColumn("lift", F.try_divide(F.col("tasa_fraude"), base)).orderBy(tile)

"""Hypergeometric draws of sizes that the test tables don't reach."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.llm import mixing


def test_large_draws(spark):
    """A source that holds most of the draws, half of which go left: mean and variance of the law."""
    cases = [(n, n * p // 100) for n in (5_000, 10_000, 114_000, 1_000_000) for p in (50, 80, 90, 99)]
    cases += [(5_000, 5_000), (5_000, 0), (1, 1), (1, 0)]
    given = spark.createDataFrame([(n, q) for n, q in cases], "all long, quota long")
    u = (F.col("i") + 0.5) / 100
    drawn = given.select("*", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("i")).select(
        "all", "quota", mixing.hypergeometric(F.col("quota"), F.col("all"), F.floor(F.col("all") / 2), u).alias("k")
    )
    found = {}
    for r in drawn.collect():
        found.setdefault((r["all"], r["quota"]), []).append(r["k"])
    for (n, q), k in found.items():
        left, share = n // 2, q / n
        variance = left * share * (1 - share) * (n - left) / max(n - 1, 1)
        # The u are evenly spaced, so the means are nearer than those of random draws.
        assert np.mean(k) == pytest.approx(left * share, abs=0.1 * variance**0.5 + 0.01), (n, q)
        assert np.var(k) == pytest.approx(variance, rel=0.15), (n, q)

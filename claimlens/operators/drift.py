"""Distribution drift between two periods: PSI, Kolmogorov-Smirnov, status, alerts, scenarios.

The numeric part works on all columns at once with the value cells of ``narrowing``:

1. one sketch pass and one counting pass give the counts of both periods per cell. That fixes the KS distance at
   every cell's end and tells which cells hold the decile edges of the reference period;
2. KS goes on best first: a cell is open while some order of its values could reach a distance above the best one known.
   While open cells hold a good part of the rows they are counted again in smaller cells, the most promising
   first; each new end raises the best distance and closes others. Then few values are left to look at;
3. cells that hold a decile edge, and the most promising open ones, are looked at value by value, once;
4. PSI bins add up the counts of whole cells; only cells that an edge cuts need their values, and those are known by then.

Every figure is exact; rows never leave the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.functions.features import log_reserve, strict_double
from claimlens.operators.narrowing import BUCKETS, CELLS, INF, LEAF, Cell, Cells
from claimlens.operators.ranking import sample_quantiles
from claimlens.session import shared_folder

# Open cells that hold more than this share of a column's rows are divided rather than looked at; so many of the most
# promising ones are looked at first.
LOOK_SHARE, FIRST_LOOK = 0.05, 64

RESULT = "feature_name string, feature_type string, psi double, ks_statistic double, ks_pvalue double, n_ref long, n_cur long"


# --- PSI ------------------------------------------------------------------------


def psi_term(ref_n: Column, cur_n: Column, ref_total: Column, cur_total: Column, epsilon: float) -> Column:
    """``(c - r) * ln(c / r)`` of one bin, shares clipped from below."""
    r = F.greatest(ref_n / ref_total, F.lit(epsilon))
    c = F.greatest(cur_n / cur_total, F.lit(epsilon))
    return (c - r) * F.log(c / r)


def _edge_places(n: int, bins: int) -> list[float]:
    """Zero-based places of the quantiles 0, 1/bins, ..., 1 among n sorted values.

    The shares are multiples of the step ``1 / bins`` in double arithmetic, as evenly spaced
    shares usually are: for an integer place it decides on which side of its own edge a value lies.
    """
    return [min(i * (1.0 / bins), 1.0) * (n - 1) for i in range(bins)] + [float(n - 1)]


def _edge_ranks(n: int, bins: int) -> list[int]:
    places = _edge_places(n, bins)
    return sorted({math.floor(p) + 1 for p in places} | {math.ceil(p) + 1 for p in places})


def _edges(values: dict[int, float], n: int, bins: int) -> list[float]:
    """Distinct, linearly interpolated quantile edges from the values at ``_edge_ranks``."""
    out = set()
    for place in _edge_places(n, bins):
        low, high = values[math.floor(place) + 1], values[math.ceil(place) + 1]
        part = place - math.floor(place)
        # Start from the nearer neighbour, so that the result never overshoots it.
        out.add(low + (high - low) * part if part < 0.5 else high - (high - low) * (1.0 - part))
    return sorted(out)


@dataclass
class Known:
    """What is known of one column: its cells, counts before each, the best KS distance, values at ranks of the reference."""

    cells: list[Cell]
    ks: float | None = None
    at: dict[int, float] = field(default_factory=dict)
    looked: set[int] = field(default_factory=set)

    def count(self, cells: list[Cell]) -> None:
        self.cells = cells
        ends = {k: list(accumulate(c.counts[k] for c in cells)) for k in ("ref_n", "cur_n", "ref_fin", "cur_fin")}
        self.n, self.m, self.n_fin, self.m_fin = (e[-1] if e else 0 for e in ends.values())
        self.ends = list(zip(*ends.values()))
        if self.n and self.m:
            edges = max(abs(a / self.n - b / self.m) for a, b, _, _ in self.ends)
            self.ks = max(self.ks or 0.0, edges)

    def before(self, i: int) -> tuple[int, int, int, int]:
        return self.ends[i - 1] if i else (0, 0, 0, 0)

    def reach(self, i: int) -> float:
        """The largest distance that any order of this cell's values could give."""
        (ref_0, cur_0, *_), (ref_1, cur_1, *_) = self.before(i), self.ends[i]
        return max(ref_1 / self.n - cur_0 / self.m, cur_1 / self.m - ref_0 / self.n)

    def promising(self) -> list[tuple[float, Cell]]:
        """Cells not looked at in which the distance may still grow, the largest reach first."""
        if not (self.n and self.m):
            return []
        found = [(self.reach(i), c) for i, c in enumerate(self.cells) if c.low < c.high and c.id not in self.looked]
        return sorted((f for f in found if f[0] > self.ks), key=lambda f: -f[0])

    def holding(self, ranks: list[int]) -> dict[int, list[int]]:
        """Indices of the cells that hold these ranks of the reference's finite values."""
        out: dict[int, list[int]] = {}
        i = 0
        for rank in ranks:
            while self.ends[i][2] < rank:
                i += 1
            out.setdefault(i, []).append(rank)
        return out


def numeric_drift(
    df: DataFrame,
    names: list[str],
    is_reference: Column,
    kinds: dict[str, str] = {},
    limits: C.DriftLimits = C.DriftLimits(),
    buckets: int = BUCKETS,
    leaf: int = LEAF,
) -> DataFrame:
    """PSI and KS of each numeric column between the reference rows and the other rows.

    Nulls and NaN do not count. Infinite values count for KS only. PSI is null when a period has
    no finite value, and 0 for a constant reference. KS and its p-value are null when a period has
    no value at all.
    """
    known, cells = narrowed(df, names, is_reference, limits, buckets, leaf)
    rows, bins = [], []
    for name, k in known.items():
        rows.append((name, kinds.get(name, "NUMERIC"), k.ks, k.n, k.m, k.n_fin, k.m_fin))
        if k.n_fin and k.m_fin:
            edges = _edges(k.at, k.n_fin, limits.bins)
            bins.append((name, edges[1:-1] if len(edges) > 2 else []))
    spark = df.sparkSession
    totals = spark.createDataFrame(
        rows, "name string, feature_type string, ks double, n_ref long, n_cur long, ref_total long, cur_total long"
    )
    counted = spark.createDataFrame(bin_counts(known, cells, dict(bins)), "name string, ref_fin long, cur_fin long")
    term = psi_term(F.col("ref_fin"), F.col("cur_fin"), F.col("ref_total"), F.col("cur_total"), limits.epsilon)
    psi = counted.join(F.broadcast(totals), "name").groupBy("name").agg(F.sum(term).alias("psi"))
    return totals.join(psi, "name", "left").select(
        F.col("name").alias("feature_name"),
        "feature_type",
        "psi",
        F.col("ks").alias("ks_statistic"),
        ks_pvalue(F.col("ks"), F.col("n_ref"), F.col("n_cur")).alias("ks_pvalue"),
        "n_ref",
        "n_cur",
    )


def narrowed(
    df: DataFrame, names: list[str], is_reference: Column, limits: C.DriftLimits, buckets: int = BUCKETS, leaf: int = LEAF
) -> tuple[dict[str, Known], Looked]:
    """KS distance and the values at the wanted ranks of every column, and the values looked at on the way."""
    finite = F.abs("value") < INF
    conditions = {"ref_n": F.col("ref"), "cur_n": ~F.col("ref"), "ref_fin": F.col("ref") & finite, "cur_fin": ~F.col("ref") & finite}
    cells = Cells(df, names, conditions, [is_reference.alias("ref")], buckets)
    known = {n: Known([]) for n in names}
    ranks: dict[str, list[int]] = {}

    def count() -> None:
        for name, k in known.items():
            k.count(cells.cells[name])
            ranks[name] = _edge_ranks(k.n_fin, limits.bins) if k.n_fin and k.m_fin else []

    def ranked(k: Known, name: str) -> list[Cell]:
        return [k.cells[i] for i in k.holding(ranks[name]) if k.cells[i].low < k.cells[i].high]

    count()
    while True:
        divide: dict[str, list[Cell]] = {}
        for name, k in known.items():
            open_cells = [c for _, c in k.promising()]
            # Many open cells are proof enough that the distance is tiny: then looking is no more work than counting.
            many = sum(c.n for c in open_cells) > LOOK_SHARE * cells.total(name) and len(open_cells) < CELLS // 8
            chosen = [c for c in open_cells if c.n > (1 if many else leaf)] + [c for c in ranked(k, name) if c.n > leaf]
            divide[name] = [c for c in {c.id: c for c in chosen}.values() if c.divisible]
        if not any(divide.values()):
            break
        cells.divide(divide)
        count()

    looked = Looked(cells)
    first = {n: ranked(k, n) + [c for _, c in k.promising()[:FIRST_LOOK]] for n, k in known.items()}
    looked.at(known, {n: list({c.id: c for c in cs}.values()) for n, cs in first.items()}, ranks)
    # What the first look leaves open, if anything.
    looked.at(known, {n: [c for _, c in k.promising()] for n, k in known.items()}, ranks)
    for name, k in known.items():
        for i, own in k.holding(ranks[name]).items():
            if k.cells[i].low == k.cells[i].high:
                k.at.update({rank: k.cells[i].low for rank in own})
    return known, looked


class Looked:
    """Values of open cells with both periods' counts, kept in the shared folder so that they are read once from the source."""

    def __init__(self, cells: Cells):
        self.cells, self.kept = cells, []

    def at(self, known: dict[str, Known], chosen: dict[str, list[Cell]], ranks: dict[str, list[int]]) -> None:
        """Look at these cells: the distances inside them, and the values at the ranks they hold."""
        if not any(chosen.values()):
            return
        spark = self.cells.wide.sparkSession
        shared_folder(spark)
        starts = []
        for name, cells in chosen.items():
            k, wanted = known[name], {c.id for c in cells}
            holding = k.holding(ranks[name])
            for i, cell in enumerate(k.cells):
                if cell.id in wanted:
                    starts.append((name, cell.id, *k.before(i)[:3], k.n, k.m, holding.get(i, [])))
            k.looked |= wanted
        order = W.partitionBy("name", "id").orderBy("value")
        sums = [F.sum(c).over(order).alias(f"{c}_upto") for c in ("ref_n", "cur_n", "ref_fin")]
        kept = self.cells.values(chosen).select("name", "id", "value", "ref_fin", "cur_fin", *sums).checkpoint()
        self.kept.append(kept)
        # One row per cell looked at.
        schema = "name string, id long, ref_0 long, cur_0 long, fin_0 long, n long, m long, ranks array<long>"
        upto = kept.join(F.broadcast(spark.createDataFrame(starts, schema)), ["name", "id"])
        distance = F.when(
            (F.col("n") > 0) & (F.col("m") > 0),
            F.abs((F.col("ref_0") + F.col("ref_n_upto")) / F.col("n") - (F.col("cur_0") + F.col("cur_n_upto")) / F.col("m")),
        )
        reached = [
            F.min(F.when(F.col("fin_0") + F.col("ref_fin_upto") >= F.get("ranks", F.lit(i)), F.col("value"))).alias(f"v{i}")
            for i in range(max(len(s[-1]) for s in starts))
        ]
        ranks_of = {(s[0], s[1]): s[-1] for s in starts}
        for r in upto.groupBy("name", "id").agg(F.max(distance).alias("ks"), *reached).collect():
            k = known[r["name"]]
            if r["ks"] is not None:
                k.ks = max(k.ks, r["ks"])
            for i, rank in enumerate(ranks_of[r["name"], r["id"]]):
                k.at[rank] = r[f"v{i}"]

    def below(self, known: dict[str, Known], cuts: list[tuple[str, Cell, float]]) -> dict[tuple[str, float], tuple[int, int]]:
        """Finite values of both periods below an edge, in the cell that it cuts."""
        rest = {n: list({c.id: c for m, c, _ in cuts if m == n and c.id not in known[n].looked}.values()) for n in known}
        tables = list(self.kept)
        if any(rest.values()):  # cells without reference values between the two values from which an edge is interpolated
            tables.append(self.cells.values(rest))
        rows = [(name, cell.id, edge) for name, cell, edge in cuts]
        # One row per inner edge of a column.
        edges = F.broadcast(self.cells.wide.sparkSession.createDataFrame(rows, "name string, id long, edge double"))
        columns = ["name", "id", "value", "ref_fin", "cur_fin"]
        values = reduce(DataFrame.unionByName, [t.select(*columns) for t in tables])
        lower = values.join(edges, ["name", "id"]).filter("value < edge").groupBy("name", "edge")
        found = lower.agg(F.sum("ref_fin").alias("ref"), F.sum("cur_fin").alias("cur")).collect()
        return {(r["name"], r["edge"]): (r["ref"], r["cur"]) for r in found}


def bin_counts(known: dict[str, Known], looked: Looked, bins: dict[str, list[float]]) -> list[tuple[str, int, int]]:
    """Finite values per PSI bin and period; bins are ``[a, b)`` between the inner edges, open at both far ends."""
    cuts = [
        (name, cell, edge) for name, edges in bins.items() for edge in edges for cell in known[name].cells if cell.low < edge <= cell.high
    ]
    partial = looked.below(known, cuts) if cuts else {}
    out = []
    for name, edges in bins.items():
        k = known[name]
        below = [(0, 0)]
        for edge in edges:
            whole = [c.counts for c in k.cells if c.high < edge]
            ref, cur = partial.get((name, edge), (0, 0))
            below.append((ref + sum(c["ref_fin"] for c in whole), cur + sum(c["cur_fin"] for c in whole)))
        below.append((k.n_fin, k.m_fin))
        out += [(name, b[0] - a[0], b[1] - a[1]) for a, b in zip(below, below[1:])]
    return out


def category_counts(df: DataFrame, names: list[str], is_reference: Column) -> DataFrame:
    """(name, category, ref_n, cur_n); null is a category of its own.

    All columns go through one map-side combined count, so a category that holds most rows is a
    single row per task when it is shuffled.
    """
    cells = ", ".join(f"'{n}', cast(`{n}` as string)" for n in names)
    return (
        df.select(is_reference.alias("ref"), F.expr(f"stack({len(names)}, {cells}) as (name, category)"))
        .withColumn("category", F.coalesce("category", F.lit("__NULL__")))
        .groupBy("name", "category")
        .agg(F.count_if("ref").alias("ref_n"), F.count_if(~F.col("ref")).alias("cur_n"))
    )


def categorical_drift(df: DataFrame, names: list[str], is_reference: Column, limits: C.DriftLimits = C.DriftLimits()) -> DataFrame:
    """PSI over the union of categories of both periods."""
    counts = category_counts(df, names, is_reference)
    # One row per column: safe to broadcast.
    totals = F.broadcast(counts.groupBy("name").agg(F.sum("ref_n").alias("n_ref"), F.sum("cur_n").alias("n_cur")))
    term = psi_term(F.col("ref_n"), F.col("cur_n"), F.col("n_ref"), F.col("n_cur"), limits.epsilon)
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    return (
        counts.join(totals, "name")
        .groupBy("name", "n_ref", "n_cur")
        .agg(F.sum(F.when(both, term)).alias("psi"))
        .select(
            F.col("name").alias("feature_name"),
            F.lit("CATEGORICAL").alias("feature_type"),
            "psi",
            F.lit(None).cast("double").alias("ks_statistic"),
            F.lit(None).cast("double").alias("ks_pvalue"),
            "n_ref",
            "n_cur",
        )
    )


# --- KS p-value -------------------------------------------------------------------


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 8) -> Column:
    """Two-sided asymptotic p-value of the two-sample KS distance.

    Kolmogorov's limit law at ``x = d * sqrt(e)``, ``e = n * m / (n + m)``. Of its two series the
    one that converges at once is used, left or right of 1.18.
    """
    e = (n.cast("double") * m) / (n.cast("double") + m)
    x = d * F.sqrt(e)
    right = F.lit(0.0)
    for k in range(1, terms + 1):
        right = right + (2.0 if k % 2 else -2.0) * F.exp(-2.0 * k * k * x * x)
    left = F.lit(0.0)
    for k in range(1, terms + 1):
        left = left + F.exp(-((2 * k - 1) ** 2) * math.pi**2 / (F.lit(8.0) * x * x))
    left = 1.0 - math.sqrt(2.0 * math.pi) / x * left
    return F.when(x <= 0, F.lit(1.0)).when(x < 1.18, left).otherwise(right)


# --- status, table, alerts ----------------------------------------------------------


def drift_status(psi: Column, ks: Column, p: Column, limits: C.DriftLimits = C.DriftLimits()) -> Column:
    return (
        F.when(psi.isNull(), C.NOT_EVALUABLE)
        .when(psi >= limits.psi_critical, C.CRITICAL)
        .when((ks >= limits.ks_critical) & (p < limits.p_value), C.CRITICAL)
        .when(psi >= limits.psi_warning, C.WARNING)
        .otherwise(C.STABLE)
    )


def drift_table(
    features: DataFrame,
    scores: DataFrame | None = None,
    numeric: list[str] = C.DRIFT_NUMERIC,
    categorical: list[str] = C.DRIFT_CATEGORICAL,
    period: str = "periodo",
    reference: str = C.REFERENCE,
    limits: C.DriftLimits = C.DriftLimits(),
) -> DataFrame:
    """One row per feature (and one for the score): psi, ks, p-value, status.

    Scores may be other rows than the features; they join the numeric passes as one more column.
    """
    is_ref = F.col(period) == reference
    parts = []
    numbers = features.select(period, *numeric) if numeric else None
    names = list(numeric)
    if scores is not None:
        score = scores.select(period, F.col("score_monitoreado").alias("score_fraude"))
        numbers = score if numbers is None else numbers.unionByName(score, allowMissingColumns=True)
        names.append("score_fraude")
    if names:
        parts.append(numeric_drift(numbers, names, is_ref, {"score_fraude": "PREDICTION"}, limits))
    if categorical:
        parts.append(categorical_drift(features, categorical, is_ref, limits))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    status = drift_status(F.col("psi"), F.col("ks_statistic"), F.col("ks_pvalue"), limits)
    return table.select("feature_name", "feature_type", "psi", "ks_statistic", "ks_pvalue", status.alias("drift_status"))


def severity_rank(status: Column) -> Column:
    return F.when(status == C.CRITICAL, 1).when(status == C.WARNING, 2).when(status == C.STABLE, 3).otherwise(4)


def drift_report(table: DataFrame) -> DataFrame:
    return table.select(
        "feature_name",
        "feature_type",
        F.round("psi", 4).alias("psi"),
        F.round("ks_statistic", 4).alias("ks_statistic"),
        "ks_pvalue",
        "drift_status",
    ).orderBy(severity_rank(F.col("drift_status")), F.desc("psi"), "feature_name")


def alert_evidence(psi: Column, ks: Column) -> Column:
    """``PSI=...`` and, if there is a KS value, ``, KS=...``, both to four places."""
    return F.concat(
        F.lit("PSI="),
        F.round(psi, 4).cast("string"),
        F.when(ks.isNotNull(), F.concat(F.lit(", KS="), F.round(ks, 4).cast("string"))).otherwise(""),
    )


def alert_action(feature: Column) -> Column:
    """The action agreed for a feature, else the default one."""
    agreed = F.create_map(*[F.lit(x) for pair in C.ALERT_ACTIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(agreed, feature), F.lit(C.ALERT_ACTION_DEFAULT))


def active_alerts(table: DataFrame) -> DataFrame:
    """Warning and critical rows with evidence and action, worst first."""
    status = F.col("drift_status")
    return (
        table.filter(status.isin(C.CRITICAL, C.WARNING))
        .select(
            F.col("feature_name").alias("alert_source"),
            F.col("feature_type").alias("alert_type"),
            status.alias("severity"),
            alert_evidence(F.col("psi"), F.col("ks_statistic")).alias("evidence"),
            alert_action(F.col("feature_name")).alias("recommended_action"),
        )
        .orderBy(severity_rank(F.col("severity")), "alert_source")
    )


# --- periods and scenarios ------------------------------------------------------------


def period_scores(scores: DataFrame, period: str | Column, source: str | Column, cutoff: float = C.Thresholds().high) -> DataFrame:
    """Score rows tagged with a period and the execution they come from."""
    tag = period if isinstance(period, Column) else F.lit(period)
    origin = source if isinstance(source, Column) else F.lit(source)
    score = F.col("score_fraude")
    return scores.select(
        C.KEY,
        tag.alias("periodo"),
        score.alias("score_monitoreado"),
        F.when(score >= cutoff, 1).otherwise(0).alias("marcado_fraude"),
        origin.alias("source_execution_id"),
    )


def period_features(claims: DataFrame, period: str | Column) -> DataFrame:
    """The monitored features of each claim (dates already parsed), tagged with a period."""
    tag = period if isinstance(period, Column) else F.lit(period)
    reserve = F.col("Sum_Valor_Reservas_Inicial").cast("double")
    return claims.select(
        C.KEY,
        *strict_double(["edad_actual_asegurado", "vigencia_poliza"]),
        reserve.alias("reserva_inicial"),
        F.datediff("F_Notificacion", "FSINIESTRO").cast("double").alias("dias_siniestro_a_notificacion"),
        F.col("Nombre_Canal_Comercial").alias("canal_comercial"),
        F.col("REGIONAL").alias("regional"),
        log_reserve(reserve).alias("log_reserva_inicial"),
        tag.alias("periodo"),
    )


def baseline_claims(claims: DataFrame, baseline_scores: DataFrame) -> DataFrame:
    """Claims of a baseline execution. A semi join: a claim scored twice is still one row."""
    return claims.join(baseline_scores.select(C.KEY), C.KEY, "left_semi")


def shift_for_target(scores: DataFrame, factor: float = 1.40, cutoff: float = C.Thresholds().high) -> float:
    """The score shift that raises the flagged share to ``factor`` times itself (at most all)."""
    score = F.col("score_fraude").cast("double")
    share = scores.agg(F.avg(F.when(score >= cutoff, 1.0).otherwise(0.0))).first()[0]
    if share is None:
        return 0.0
    goal = min(100.0, 100.0 * share * factor)
    (at,) = sample_quantiles(scores, "score_fraude", [1.0 - goal / 100.0])
    return max(0.0, cutoff - at + 1e-6)


def shifted_scores(scores: DataFrame, shift: float) -> DataFrame:
    """Scores moved up and capped at 1 (a null score becomes 1, as ``least`` skips nulls)."""
    return scores.withColumn("score_fraude", F.least(F.lit(1.0), F.col("score_fraude") + F.lit(shift)))


def hash_bucket(key: str = C.KEY) -> Column:
    """A stable bucket 0..99 of a key."""
    return F.pmod(F.xxhash64(key), F.lit(100))


def sha_bucket(key: str = C.KEY) -> Column:
    """A stable bucket 0..99 that other SQL engines can compute as well."""
    return F.conv(F.substring(F.sha2(F.col(key), 256), 1, 8), 16, 10).cast("long") % 100


def cohort_scenario(
    features: DataFrame,
    bucket: Column,
    reserve_share: int = 60,
    reserve_factor: float = 1.80,
    delay_share: int = 50,
    delay_days: float = 10.0,
    channel_share: int = 30,
    channel: str = "CANAL_DIGITAL_SIMULADO",
    period: str = C.CURRENT,
) -> DataFrame:
    """A what-if copy of period features: part of the claims get larger reserves, late notices,
    or another channel. The logarithm follows the changed reserve."""
    changed = (
        features.withColumn("_bucket", bucket)
        .withColumns(
            {
                "reserva_inicial": F.when(F.col("_bucket") < reserve_share, F.col("reserva_inicial") * reserve_factor).otherwise(
                    F.col("reserva_inicial")
                ),
                "dias_siniestro_a_notificacion": F.when(
                    F.col("_bucket") < delay_share, F.col("dias_siniestro_a_notificacion") + delay_days
                ).otherwise(F.col("dias_siniestro_a_notificacion")),
                "canal_comercial": F.when(F.col("_bucket") < channel_share, channel).otherwise(F.col("canal_comercial")),
                "periodo": F.lit(period),
            }
        )
        .withColumn("log_reserva_inicial", log_reserve(F.col("reserva_inicial")))
    )
    return changed.drop("_bucket")

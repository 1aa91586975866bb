"""Order statistics, ranks, tiles and running totals over a whole table.

A window without a partition key would send every row through one task. Instead:

* an order statistic is found by narrowing (see ``narrowing``): the cell that holds a wanted rank is divided, counting pass by
  counting pass, until it is small, and then looked at value by value. Ties are single rows there, so a value shared by
  a third of all rows costs nothing;
* tiles and the time split only need a few cut points, after which each row is placed by a
  literal comparison, without any shuffle of the table;
* a full rank is one distributed sort plus one small offset per sorted partition.

All results are exact. What reaches the driver is bounded by the cells of a pass, partitions,
or the number of wanted ranks, never by rows.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.operators.narrowing import BUCKETS, LEAF, Cell, Cells, plain_double, with_buckets
from claimlens.session import run_folder, shared_folder
from claimlens.sources.tables import write_and_read

# Neighbouring buckets whose totals are summed in one window.
TOGETHER = 256


# --- order statistics --------------------------------------------------------


@dataclass(frozen=True)
class Found:
    """The value at a rank (None: a null), and where the rank lies within the run of equal values."""

    value: float | None
    rank_in_ties: int
    ties: int
    total: int


# Which ranks to look up, given the number of values.
RankRule = Callable[[int], list[int]]


def order_statistics(
    df: DataFrame, ranks: dict[str, RankRule], buckets: int = BUCKETS, leaf: int = LEAF, nulls_last: bool = False
) -> dict[str, dict[int, Found]]:
    """Exact values at the wanted ranks (1 = smallest) of each column.

    Nulls and NaN do not count, or come last. The cell of a rank is divided until it holds at most ``leaf`` rows; then its
    values are looked at.
    """
    cells = Cells(df, list(ranks), buckets=buckets)
    totals = {n: cells.total(n) + (cells.nulls[n] if nulls_last else 0) for n in ranks}
    wanted = {n: sorted(set(rule(totals[n]))) for n, rule in ranks.items()}
    for name, own in wanted.items():
        if own and not 1 <= own[0] <= own[-1] <= totals[name]:
            raise ValueError(f"ranks {own} of {name} are outside 1..{totals[name]}")
    while True:
        out: dict[str, dict[int, Found]] = {n: {} for n in ranks}
        open_ranks: list[tuple[str, Cell, int, int]] = []
        for name, own in wanted.items():
            ends = list(accumulate(c.n for c in cells.cells[name]))
            for rank in own:
                if rank > (values := ends[-1] if ends else 0):
                    out[name][rank] = Found(None, rank - values, cells.nulls[name], totals[name])
                    continue
                at = bisect_left(ends, rank)
                cell = cells.cells[name][at]
                local = rank - (ends[at] - cell.n)
                if cell.low == cell.high:
                    out[name][rank] = Found(cell.low, local, cell.n, totals[name])
                else:
                    open_ranks.append((name, cell, local, rank))
        chosen = {n: list({c.id: c for m, c, _, _ in open_ranks if m == n}.values()) for n in ranks}
        big = {n: [c for c in cs if c.n > leaf and c.divisible] for n, cs in chosen.items()}
        if not any(big.values()):
            break
        cells.divide(big)
    if open_ranks:
        rows = [(n, c.id, local, rank) for n, c, local, rank in open_ranks]
        order = W.partitionBy("name", "id").orderBy("value")
        steps = cells.values(chosen).withColumn("upto", F.sum("n").over(order))
        # One row per wanted rank: safe to broadcast.
        targets = F.broadcast(df.sparkSession.createDataFrame(rows, "name string, id long, local long, rank long"))
        hits = (
            steps.join(targets, ["name", "id"])
            .filter((F.col("local") <= F.col("upto")) & (F.col("local") > F.col("upto") - F.col("n")))
            .select("name", "rank", "value", (F.col("local") - F.col("upto") + F.col("n")).alias("inside"), "n")
        )
        for r in hits.collect():
            out[r["name"]][r["rank"]] = Found(r["value"], r["inside"], r["n"], totals[r["name"]])
    return out


def counted_order_statistics(df: DataFrame, ranks: dict[str, RankRule], nulls_last: bool = False) -> dict[str, dict[int, Found]]:
    """``order_statistics`` in one pass over the table, for columns whose values repeat or that are a few of many.

    Equal values become one row with a count before the shuffle. These rows are sorted and stored; the totals of the sorted partitions
    say which partition holds a rank, and only those partitions are looked at, each by a window of its own.
    """
    cells = ", ".join(f"'{n}', `{n}`" for n in ranks)
    plain = df.select(*[plain_double(F.col(n)).alias(n) for n in ranks])
    long = plain.select(F.expr(f"stack({len(ranks)}, {cells}) as (name, value)"))
    if not nulls_last:
        long = long.filter("value IS NOT NULL")
    order = F.asc_nulls_last("value")
    counted = long.groupBy("name", "value").agg(F.count("*").alias("n")).orderBy("name", order)
    spark = df.sparkSession
    stored = write_and_read(counted.withColumn("part", F.spark_partition_id()), run_folder(spark, "values"))
    # One row per column and sorted partition.
    sizes: dict[str, list[tuple[int, int]]] = {n: [] for n in ranks}
    for r in stored.groupBy("name", "part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        sizes[r["name"]].append((r["part"], r["n"]))
    rows, totals = [], {}
    for name, own in sizes.items():
        ends = list(accumulate(n for _, n in own))
        totals[name] = ends[-1] if ends else 0
        for rank in sorted(set(ranks[name](totals[name]))):
            if not 1 <= rank <= totals[name]:
                raise ValueError(f"rank {rank} of {name} is outside 1..{totals[name]}")
            at = bisect_left(ends, rank)
            rows.append((name, own[at][0], rank - ends[at] + own[at][1], rank))
    out: dict[str, dict[int, Found]] = {n: {} for n in ranks}
    # One row per wanted rank: safe to broadcast.
    targets = F.broadcast(spark.createDataFrame(rows, "name string, part int, local long, rank long"))
    inside = stored.join(F.broadcast(targets.select("name", "part").distinct()), ["name", "part"], "left_semi")
    steps = inside.withColumn("upto", F.sum("n").over(W.partitionBy("name", "part").orderBy(order)))
    hits = steps.join(targets, ["name", "part"]).filter((F.col("local") <= F.col("upto")) & (F.col("local") > F.col("upto") - F.col("n")))
    for r in hits.select("name", "rank", "value", (F.col("local") - F.col("upto") + F.col("n")).alias("inside"), "n").collect():
        out[r["name"]][r["rank"]] = Found(r["value"], r["inside"], r["n"], totals[r["name"]])
    return out


def sample_quantiles(df: DataFrame, name: str, shares: list[float], buckets: int = BUCKETS) -> list[float | None]:
    """Exact sample quantiles: the smallest value whose share of rows is at least the given one."""

    def rank(n: int, share: float) -> int:
        return min(n, max(1, math.ceil(round(share * n, 9))))

    found = order_statistics(df, {name: lambda n: [rank(n, s) for s in shares] if n else []}, buckets)[name]
    if not found:
        return [None for _ in shares]
    n = next(iter(found.values())).total
    return [found[rank(n, s)].value for s in shares]


def group_quantiles(df: DataFrame, by: list[str], value: str, shares: list[float], leaf: int = LEAF) -> DataFrame:
    """Exact sample quantiles of every group: ``by`` and an array of values in the order of ``shares``; null without values.

    The column's cells are the same for all groups. Counts per (group, cell) say in which cell a group's rank lies; only rows of those
    cells are counted by value. Nothing is collected per group, and a group of all rows is as many tasks as there are cells.
    """
    narrow = df.select(*by, plain_double(F.col(value)).alias("_v"))
    splits = Cells(narrow, ["_v"]).fine_edges("_v", leaf)
    rows = with_buckets(narrow, {"_v": splits}).withColumn("_b", F.col("_v__b").cast("int")).drop("_v__b")
    # A null value has a bucket of its own behind the others; its group is kept.
    counts = rows.groupBy(*by, "_b").agg(F.count("_v").alias("_n"))
    over = W.partitionBy(*by)
    upto = F.sum("_n").over(over.orderBy("_b"))
    placed = counts.select("*", upto.alias("_upto"), F.sum("_n").over(over).alias("_total"))
    wanted = F.posexplode(F.array(*[F.lit(s) for s in shares])).alias("_i", "_share")
    rank = F.least(F.col("_total"), F.greatest(F.lit(1), F.ceil(F.round(F.col("_share") * F.col("_total"), 9))))
    targets = (
        placed.select("*", wanted)
        .withColumn("_rank", rank)
        .filter((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_n")))
        .select(*[F.col(c).alias(f"_t{i}") for i, c in enumerate(by)], F.col("_b").alias("_tb"), "_i", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_local"))
    )

    def same(own: str, other: str) -> Column:
        pairs = [F.col(c).eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(by)]
        return reduce(lambda a, b: a & b, pairs, F.col(own) == F.col(other))

    inside = rows.join(targets.drop("_i", "_local").distinct(), same("_b", "_tb"), "left_semi").groupBy(*by, "_b", "_v").agg(F.count("*").alias("_n"))
    steps = inside.withColumn("_upto", F.sum("_n").over(W.partitionBy(*by, "_b").orderBy("_v")))
    hits = steps.join(targets, same("_b", "_tb")).filter((F.col("_local") <= F.col("_upto")) & (F.col("_local") > F.col("_upto") - F.col("_n")))
    found = hits.select(*by, "_i", "_v").unionByName(counts.select(*by, F.lit(-1).alias("_i"), F.lit(None).cast("double").alias("_v")))
    values = [F.max(F.when(F.col("_i") == i, F.col("_v"))) for i in range(len(shares))]
    return found.groupBy(*by).agg(F.array(*values).alias("quantiles"))


# --- cut points, time split, tiles ---------------------------------------------

Cut = tuple["float | None", "str | None"]


def cut_points(df: DataFrame, order: Column, tie: Column, ranks: RankRule, counted: bool = False) -> dict[int, Cut]:
    """The (order value, tie value) pair at each wanted rank, order ascending with nulls and NaN last; ``counted``: order values are few.

    ``tie`` must be unique within equal order values. It is looked at only for rows that share
    the order value of a cut; a cut at the end of a run of equal values needs none.
    """
    keyed = df.select(plain_double(order).alias("v"), tie.cast("string").alias("t"))
    statistics = counted_order_statistics if counted else order_statistics
    found = statistics(keyed, {"v": ranks}, nulls_last=True)["v"]
    inner = {rank: f for rank, f in found.items() if f.rank_in_ties < f.ties}
    tie_values: dict[int, str] = {}
    if inner:
        runs = {f.value: f.ties for f in inner.values()}
        ordered = sorted(runs, key=lambda v: (v is None, v))
        start = dict(zip(ordered, accumulate([0, *[runs[v] for v in ordered]])))
        place = {start[f.value] + f.rank_in_ties: rank for rank, f in inner.items()}
        tied = F.col("v").isin([v for v in ordered if v is not None])
        tied = keyed.filter(tied | F.col("v").isNull() if None in runs else tied)
        ranked = global_rank(tied, [F.asc_nulls_last("v"), F.col("t")], "r").filter(F.col("r").isin(sorted(place)))
        tie_values = {place[r["r"]]: r["t"] for r in ranked.collect()}
    return {rank: (f.value, tie_values.get(rank)) for rank, f in found.items()}


def beyond_cut(order: Column, tie: Column, cut: Cut) -> Column:
    """Whether a row comes after the cut; ``order`` must be a ``plain_double``."""
    value, last = cut
    later = tie.cast("string") > F.lit(last) if last is not None else F.lit(False)
    if value is None:
        return order.isNull() & later
    return order.isNull() | (order > F.lit(value)) | ((order == F.lit(value)) & later)


def time_split(df: DataFrame, date: str, key: str, share: float = 0.75, out: str = "tramo") -> DataFrame:
    """Tag the first ``int(share * n)`` rows by date (nulls last, key breaks ties) TRAIN, the rest TEST.

    Only the rows of each day are counted, and the keys of one day looked at; the table itself is neither sorted nor shuffled.
    """
    day = F.unix_date(F.col(date).cast("date"))
    cuts = cut_points(df, day, F.col(key), lambda n: [int(n * share)] if int(n * share) else [], counted=True)
    if not cuts:
        return df.withColumn(out, F.lit("TEST"))
    (cut,) = cuts.values()
    return df.withColumn(out, F.when(beyond_cut(plain_double(day), F.col(key), cut), "TEST").otherwise("TRAIN"))


def tile_ends(n: int, tiles: int) -> list[int]:
    """Last rank of each tile but the last; the first ``n % tiles`` tiles get one row more."""
    size, extra = divmod(n, tiles)
    return list(accumulate(size + (1 if t < extra else 0) for t in range(tiles)))[:-1]


def tile(df: DataFrame, score: str, key: str, tiles: int = 10, out: str = "decil") -> DataFrame:
    """``ntile`` by descending score (nulls last, key breaks ties), placed by literal comparisons."""
    down = -F.col(score).cast("double")
    # With fewer rows than tiles several ends coincide; each rank then opens its own tile.
    cuts = cut_points(df, down, F.col(key), lambda n: [e for e in tile_ends(n, tiles) if 0 < e < n])
    number = F.lit(1)
    for cut in cuts.values():
        number = number + beyond_cut(plain_double(down), F.col(key), cut).cast("int")
    return df.withColumn(out, number)


# --- full rank -------------------------------------------------------------------


def global_rank(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Number all rows from 1 in the given total order, without a single-task window.

    The distributed sort splits hot order values too, as long as the last sort column is unique.
    Row numbers inside each sorted partition come from ``monotonically_increasing_id`` (partition
    number in the upper bits, position in the lower 33), so no window and no second shuffle are
    needed. The numbered rows go to the checkpoint folder, because range limits are sampled and
    both uses must see the same ones; the offsets are one row per partition.
    """
    shared_folder(df.sparkSession)
    position = F.monotonically_increasing_id()
    numbered = df.orderBy(*order).withColumn("_pos", position).checkpoint()
    part, inside = F.shiftright("_pos", 33), F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part")) - F.col("_n")
    offsets = F.broadcast(sizes.select("_part", before.alias("_before")))
    return (
        numbered.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(out, F.col("_before") + inside + 1)
        .drop("_part", "_pos", "_before")
    )


# --- running totals ---------------------------------------------------------------


def running_totals(
    points: DataFrame, value: str, sums: list[str], splits: list[float], by: list[str] = [], descending: bool = True
) -> DataFrame:
    """Add ``<sum>_before``: the total of each sum over all rows of the group that come before this value.

    ``points`` has one row per (``by``, ``value``); ``splits`` are as fine as ``Cells.fine_edges`` makes them. Totals
    run on three levels: values inside a bucket, buckets inside a run of ``TOGETHER`` buckets, and those runs. So a group that
    holds all rows is as many tasks as there are buckets, and no window grows with the table but the last, by a
    row for each ``TOGETHER`` buckets.
    """
    # Never null, so that no null filter is pushed into one branch only: both then share one shuffle.
    number = F.coalesce(F.col(value + "__b").cast("int"), F.lit(-1))
    bucketed = with_buckets(points, {value: splits}).withColumn("_b", number).drop(value + "__b")
    direction = F.desc if descending else F.asc

    def before(column: Column, by_columns: list[str], order: str) -> Column:
        window = W.partitionBy(*by_columns).orderBy(direction(order)).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    totals = bucketed.groupBy(*by, "_b").agg(*[F.sum(s).alias(s) for s in sums])
    totals = totals.withColumn("_run", F.coalesce(F.floor(F.col("_b") / TOGETHER), F.lit(-1)))
    inside = totals.select("*", *[before(F.col(s), [*by, "_run"], "_b").alias(f"_{s}_run") for s in sums])
    runs = totals.groupBy(*by, "_run").agg(*[F.sum(s).alias(s) for s in sums])
    first = runs.select(
        *[F.col(c).alias(f"_r{i}") for i, c in enumerate(by)],
        F.col("_run").alias("_rr"),
        *[before(F.col(s), by, "_run").alias(f"_{s}_first") for s in sums],
    )

    def same(prefix: str, own: str, other: str) -> Column:
        """A null group is a group like any other."""
        pairs = [F.col(c).eqNullSafe(F.col(f"{prefix}{i}")) for i, c in enumerate(by)]
        return reduce(lambda a, b: a & b, pairs, F.col(own) == F.col(other))

    offsets = inside.join(first, same("_r", "_run", "_rr")).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)],
        F.col("_b").alias("_kb"),
        *[(F.col(f"_{s}_run") + F.col(f"_{s}_first")).alias(f"_{s}_off") for s in sums],
    )
    local = bucketed.select("*", *[before(F.col(s), [*by, "_b"], value).alias(f"_{s}_in") for s in sums])
    joined = local.join(offsets, same("_k", "_b", "_kb"))
    return joined.select(*points.columns, *[(F.col(f"_{s}_off") + F.col(f"_{s}_in")).alias(f"{s}_before") for s in sums])

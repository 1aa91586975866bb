"""Value cells: where the values of a column lie, known as finely as a question needs.

A cell is a run of neighbouring values with its least and greatest value and its counts. One sketch pass gives the first cells of all
columns, one pass counts them. Whoever asks for a rank, a distance or a bin then names the cells that leave the answer open: they
are counted again in smaller cells, pass by pass, or looked at value by value once they are small. A value that many rows share
soon has a cell of its own, which nothing has to open.

How finely is not limited: only what one pass may count is (``CELLS``, which bounds what reaches the driver at once), and a
cell of more than ``LEAF`` rows is never looked at as long as it can be divided. A row finds its cell by its bucket among the first edges and then by
one small broadcast table for each later pass, in which its place follows from its cell's ends by arithmetic: even steps, or even steps of the
logarithm of the distance from the least value where even steps have just failed to divide the cell.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INF = float("inf")

# First cells of a column; cells that one pass counts, all columns together; rows of a cell that one task sorts with ease.
BUCKETS, CELLS, LEAF = 256, 1 << 14, 1 << 20


MOST = sys.float_info.max


@dataclass(frozen=True)
class Cell:
    id: int
    low: float
    high: float
    n: int
    counts: dict[str, int] = field(default_factory=dict)
    by_log: bool = False  # even steps have just left most rows of a cell in this one

    @property
    def divisible(self) -> bool:
        return self.low < self.high < INF


def plain_double(value: Column) -> Column:
    """A double without NaN (-> null) and without negative zero, which a search among edges would tell apart from zero."""
    return F.nanvl(value.cast("double"), F.lit(None)) + F.lit(0.0)


def with_buckets(df: DataFrame, splits: dict[str, list[float]], suffix: str = "__b") -> DataFrame:
    """Add the bucket number of each column by binary search, on the JVM side; null goes to a bucket behind the last."""
    names = list(splits)
    stage = Bucketizer(
        splitsArray=[splits[n] for n in names],
        inputCols=names,
        outputCols=[n + suffix for n in names],
        handleInvalid="keep",
    )
    return stage.transform(df)


def part_of(parts: Column) -> Column:
    """Which part of its cell a value lies in; the least value is in the first, the greatest in the last part."""
    value, low, high = F.col("value") / 2, F.col("low") / 2, F.col("high") / 2
    even = F.floor(F.try_divide(value - low, high - low) * parts)
    least = math.log2(sys.float_info.min) - 60  # below the logarithm of any distance
    by_log = F.floor(F.try_divide(F.log2(value - low) - least, F.log2(high - low) - least) * parts)
    inner = F.when(F.col("by_log"), by_log).otherwise(even)
    # Distances too small to be halved have no logarithm or quotient.
    return F.when(F.col("value") <= F.col("low"), 0).when(F.col("value") >= F.col("high"), parts - 1).otherwise(F.greatest(F.lit(1), F.least(F.coalesce(inner, F.lit(1)), parts - 2)))


class Cells:
    """The cells of some columns of a table; ``counts`` are further conditions counted per cell, over the columns ``keep``."""

    def __init__(
        self, df: DataFrame, names: list[str], counts: dict[str, Column] = {}, keep: list[Column] = [], buckets: int = BUCKETS
    ):
        self.names, self.conditions, self.buckets = names, counts, buckets
        self.wide = df.select(*keep, *[plain_double(F.col(n)).alias(n) for n in names])
        self.keep = [c for c in self.wide.columns if c not in names]
        self.passes = 0
        self.splits = self.first_splits()
        self.tables: list[DataFrame] = []
        self.next_id = max(map(len, self.splits.values()))
        self.nulls: dict[str, int] = {n: 0 for n in names}
        self.cells: dict[str, list[Cell]] = {n: [] for n in names}
        self.count(self.rows(), {})

    def first_splits(self) -> dict[str, list[float]]:
        """Edges by one sketch of all columns. A value found twice is a hot one and gets an edge on either side."""
        shares = [i / self.buckets for i in range(1, self.buckets)]
        found = self.wide.approxQuantile(self.names, shares, 1.0 / (8 * self.buckets))
        self.passes += 1
        splits = {}
        for name, values in zip(self.names, found):
            times = Counter(v + 0.0 for v in values if math.isfinite(v))
            after = {math.nextafter(v, INF) for v, n in times.items() if n > 1}
            # Infinite values get buckets of their own, but for what equals the greatest double.
            splits[name] = [-INF, *sorted(({*times, *after} - {INF}) | {-MOST, MOST}), INF]
        return splits

    def rows(self, of: list[str] | None = None) -> DataFrame:
        """One row (name, value, id of its cell, *keep) per cell of the table; a null value has no cell but a row."""
        splits = {n: self.splits[n] for n in of or self.names}
        stacked = ", ".join(f"'{n}', `{n}`, cast(`{n}__b` as long)" for n in splits)
        rows = with_buckets(self.wide, splits).select(*self.keep, F.expr(f"stack({len(splits)}, {stacked}) as (name, value, id)"))
        for table in self.tables:
            rows = self.moved(rows, table, "left")
        return rows

    def moved(self, rows: DataFrame, table: DataFrame, how: str) -> DataFrame:
        """Rows with the ids of their parts, where their cell has been divided. The table holds ``CELLS // 4`` rows at most."""
        inside = rows.join(F.broadcast(table), ["name", "id"], how)
        id = F.when(F.col("first").isNotNull(), F.col("first") + part_of(F.col("parts"))).otherwise(F.col("id"))
        return inside.select(*self.keep, "name", "value", id.alias("id"))

    def aggregates(self) -> list[Column]:
        return [F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in self.conditions.items()]]

    def count(self, rows: DataFrame, whole: dict[int, Cell]) -> None:
        """Count the cells of these rows; ``whole``: the cell that a cell is cut from."""
        ends = F.min("value").alias("low"), F.max("value").alias("high")
        self.passes += 1
        for r in rows.groupBy("name", "id").agg(*self.aggregates(), *ends).collect():
            if r["low"] is None:
                self.nulls[r["name"]] = r["n"]
            else:
                parent = whole.get(r["id"])
                by_log = parent is not None and not parent.by_log and 2 * r["n"] > parent.n
                self.cells[r["name"]].append(Cell(r["id"], r["low"], r["high"], r["n"], {k: r[k] for k in self.conditions}, by_log))
        for own in self.cells.values():
            own.sort(key=lambda c: c.low)

    def divide(self, chosen: dict[str, list[Cell]]) -> None:
        """Put smaller cells in the place of these, by one pass; the ``CELLS // 4`` given first at most, the others stay."""
        taken = [(n, c) for n, cells in chosen.items() for c in cells if c.divisible][: CELLS // 4]
        if not taken:
            return
        parts = max(4, min(self.buckets, CELLS // len(taken)))
        rows, whole = [], {}
        for name, cell in taken:
            rows.append((name, cell.id, self.next_id, parts, cell.low, cell.high, cell.by_log))
            whole.update({self.next_id + i: cell for i in range(parts)})
            self.next_id += parts
        schema = "name string, id long, first long, parts int, low double, high double, by_log boolean"
        table = self.wide.sparkSession.createDataFrame(rows, schema)
        gone = {(n, c.id) for n, c in taken}
        inside = self.moved(self.rows(sorted({n for n, _ in taken})), table, "inner")
        self.cells = {n: [c for c in own if (n, c.id) not in gone] for n, own in self.cells.items()}
        self.tables.append(table)
        self.count(inside, whole)

    def values(self, chosen: dict[str, list[Cell]]) -> DataFrame:
        """(name, id, value, counts): a row per distinct value of these cells."""
        self.passes += 1
        wanted = [(n, c.id) for n, cells in chosen.items() for c in cells]
        # One row per cell that is looked at.
        table = F.broadcast(self.wide.sparkSession.createDataFrame(wanted, "name string, id long"))
        inside = self.rows(sorted({n for n, _ in wanted})).join(table, ["name", "id"], "left_semi")
        return inside.groupBy("name", "id", "value").agg(*self.aggregates())

    def total(self, name: str) -> int:
        """Rows with a value."""
        return sum(c.n for c in self.cells[name])

    def fine_edges(self, name: str, leaf: int = LEAF) -> list[float]:
        """Edges between which no cell has more than ``leaf`` rows, unless a single value does; the ends are infinite."""
        while big := [c for c in self.cells[name] if c.n > leaf and c.divisible]:
            self.divide({name: big})
        lows = sorted({c.low for c in self.cells[name] if math.isfinite(c.low)})[1:]
        return [-INF, *(lows or [0.0]), INF]

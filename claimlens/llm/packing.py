"""Documents packed whole into as few sequences of fixed capacity as best-fit packing can.

Documents longer than the capacity are cut into full pieces and a rest. What has to be packed is then a histogram: as many pieces of
each length, at most ``capacity`` lengths, however large the corpus. The packing is made on that histogram and
says of runs of equal pieces which sequences they fill; each piece finds its place from its length and its number among the pieces of
that length:

* large pieces, above a third of the capacity: no three fit together. From the longest down, each is matched with the longest
  one that still fits beside it. As every shorter piece has at least the choice of a longer one, no other matching has more pairs;
* small pieces, from the longest down: each goes where the least room is left that still takes it. A run of equal pieces goes to a run
  of sequences with equal room at once; only if no room is left are new sequences begun.

A run ends with its pieces or with its sequences. Room at least halves whenever a run of sequences is used up, so the number of runs is
bounded by the capacity, not by the corpus.

The text is read once: pieces and their ids are written packed, with a number among the pieces of their length in their task.
Totals of (task, length) make those numbers global. No length, however frequent, meets in one task.

Defined results: a null or empty text is a document of the end id alone. Repeated rows and rows without id are documents of their own. Only
the id and the text are read, so other columns may have any name. An empty table makes no sequences.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.llm.base import pieces, stored, text_of, texts_of
from claimlens.llm.pretokens import word_encoder

PIECES = "part int, number long, doc_id long, piece int, start long, length long, ids_crc32 long, rank long, ids binary"


class Run(NamedTuple):
    """Equal pieces, numbers ``rank`` and on: ``each`` of them to every sequence from ``sequence`` on, the first at ``offset``."""

    length: int
    rank: int
    count: int
    sequence: int
    each: int
    offset: int


class Room:
    """Runs of sequences by the room that is left in them."""

    def __init__(self) -> None:
        self.runs: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, number)
        self.sizes: list[int] = []

    def add(self, room: int, sequence: int, number: int) -> None:
        if room and number:
            if room not in self.runs:
                bisect.insort(self.sizes, room)
            self.runs.setdefault(room, []).append((sequence, number))

    def take(self, length: int) -> tuple[int, int, int] | None:
        """The least room that holds the length, and a run of sequences with it."""
        at = bisect.bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return None
        room = self.sizes[at]
        sequence, number = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room], self.sizes[at]
        return room, sequence, number


def plan(counts: dict[int, int], capacity: int) -> list[Run]:
    """How to pack so many pieces of each length."""
    runs: list[Run] = []
    used: Counter[int] = Counter()
    room, sequences = Room(), 0

    def put(length: int, count: int, sequence: int, each: int, offset: int) -> None:
        runs.append(Run(length, used[length], count, sequence, each, offset))
        used[length] += count

    large = sorted(x for x, n in counts.items() if n and 3 * x > capacity)
    left = {x: counts[x] for x in large}
    while large:
        longest = large[-1]
        if not left[longest]:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - longest) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        partner = large[at] if at >= 0 else None
        if partner is None:
            number = left[longest]
        elif partner == longest:
            number = left[longest] // 2
        else:
            number = min(left[longest], left[partner])
        if not number:  # a single one is left of a length that pairs with itself: the next shorter one, or alone
            partner = large[at - 1] if at > 0 else None
            while partner is not None and not left[partner]:
                large.remove(partner)
                at -= 1
                partner = large[at - 1] if at > 0 else None
            number = 1
        put(longest, number, sequences, 1, 0)
        left[longest] -= number
        if partner is not None:
            put(partner, number, sequences, 1, longest)
            left[partner] -= number
        room.add(capacity - longest - (partner or 0), sequences, number)
        sequences += number

    for length in sorted((x for x, n in counts.items() if n and 3 * x <= capacity), reverse=True):
        todo = counts[length]
        while todo:
            found = room.take(length)
            if found is None:
                found = capacity, sequences, -(-todo // (capacity // length))
                sequences += found[2]
            size, first, number = found
            each, offset = size // length, capacity - size
            full = min(number, todo // each)
            if full:
                put(length, full * each, first, each, offset)
                room.add(size - each * length, first, full)
                todo -= full * each
            rest = min(todo, each) if full < number else 0
            if rest:
                put(length, rest, first + full, each, offset)
                room.add(size - rest * length, first + full, 1)
                todo -= rest
            room.add(size, first + full + (rest > 0), number - full - (rest > 0))
    return runs


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer: a bound from lengths and from what can lie beside long pieces, for every threshold up to half."""
    lengths = np.array(sorted(counts), np.int64)
    numbers = np.array([counts[x] for x in sorted(counts)], np.int64)
    total = lambda chosen: int((lengths * numbers)[chosen].sum())
    best = -(-total(lengths > 0) // capacity)
    for k in [0, *lengths[2 * lengths <= capacity].tolist()]:
        alone, half = lengths > capacity - k, (2 * lengths > capacity) & (lengths <= capacity - k)
        between = (lengths >= k) & (2 * lengths <= capacity)
        free = int(numbers[half].sum()) * capacity - total(half)
        best = max(best, int(numbers[alone | half].sum()) + max(0, -(-(total(between) - free) // capacity)))
    return best


def pieces_of(
    df: DataFrame, tokenizer: str, end_id: int, capacity: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every document's ids and the end id, cut at the capacity; ``rank`` counts the pieces of a length in a task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, end, ranks, number = word_encoder(tokenizer), np.array([end_id], np.uint32), Counter(), 0
        names = [f.split()[0] for f in PIECES.split(", ")]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
        for batch in pieces(batches):
            rows = []
            for part, doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))):
                ids = np.concatenate([e.encode(value), end]).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    data = own.tobytes()
                    rows.append((part, number, doc, piece, start, len(own), zlib.crc32(data), ranks[len(own)], data))
                    ranks[len(own)] += 1
                    number += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    rows = df.select(F.spark_partition_id().alias("part"), F.col(id).cast("long").alias("id"), text_of(text).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def counts_of(held: DataFrame) -> dict[int, int]:
    """Pieces of each length: at most ``capacity`` rows reach the driver."""
    return {r["length"]: r["count"] for r in held.groupBy("length").count().collect()}


def place(held: DataFrame, capacity: int) -> DataFrame:
    """Stored pieces without their ids, with the sequence that takes each and its offset there."""
    runs = sorted(plan(counts_of(held), capacity))
    firsts = np.array([[r.length, r.rank] for r in runs], np.int64).reshape(-1, 2)
    rest = np.array([[r.rank, r.sequence, r.each, r.offset] for r in runs], np.int64).reshape(-1, 4)
    # Bounded by the capacity, see above.
    shared = held.sparkSession.sparkContext.broadcast((firsts, rest))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, rest = shared.value
        starts = np.searchsorted(firsts[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            at = np.empty(len(rank), np.int64)
            for x in np.unique(length):
                own, low, high = length == x, starts[x], starts[x + 1]
                at[own] = low + np.searchsorted(firsts[low:high, 1], rank[own], "right") - 1
            first, sequence, each, offset = rest[at].T
            nth = rank - first
            found = pa.array(sequence + nth // each), pa.array(offset + nth % each * length)
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, "sequence_id", "offset"])

    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = held.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = totals.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = held.drop("ids").join(before, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema.fields)
    return numbered.mapInArrow(find, f"{schema}, sequence_id long, offset long")


def sequences(held: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: ids (little-endian 32-bit), and doc_id, piece, start and offset of what lies in them, in order."""
    whole = placed.select("part", "number", "sequence_id", "offset").join(held.select("part", "number", "doc_id", "piece", "start", "ids"), ["part", "number"])
    # A sequence holds ``capacity`` ids at most.
    rows = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "ids")))
    packed = whole.groupBy("sequence_id").agg(rows.alias("rows"))
    joined = F.unhex(F.array_join(F.transform("rows", lambda r: F.hex(r["ids"])), "")).alias("ids")
    spans = F.transform("rows", lambda r: F.struct(r["doc_id"], r["piece"], r["start"], r["offset"])).alias("spans")
    return packed.select("sequence_id", joined, spans)


def pack(df: DataFrame, tokenizer: str, end_id: int, capacity: int, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(stored pieces with their ids, their places)."""
    held = stored(pieces_of(df, tokenizer, end_id, capacity, id, text), "pieces")
    return held, place(held, capacity)

"""SimHash near-dedup with pivot distance tables.

Each text gets a 64-bit fingerprint from its word shingles. Only distinct fingerprints are compared, in buckets:
the 64 bits are cut into ``max_bits + agree`` pieces, so two fingerprints that differ in ``max_bits`` bits at most
agree on ``agree`` of the pieces, and every choice of so many pieces is a bucket key (fifteen keys for four bits and
two pieces). In a bucket the distances of all members to ``PIVOTS`` reference fingerprints are looked up in a table made
beforehand; two members whose distances to some reference differ by more than ``max_bits`` cannot be
close (triangle inequality) and are discarded; the others are verified by their own distance. A bucket gives a spanning
forest of its links, never all its pairs. Buckets above ``BUCKET`` members are cut into blocks, and every pair
of blocks is compared in a task of its own, so no task holds more than two blocks. Links are exact: none is lost,
none is added. ``dedup`` can ask for more: with ``also_bits`` a link must be confirmed by a second fingerprint,
made of the same shingles with other hashes, so that a wider ``max_bits`` doesn't link unlike texts by chance.

Defined results: texts are lower-cased A-Z only. A text with fewer words than a shingle has one shingle, the
whole sequence; a text without words (or null) has fingerprint zero, linked like any other. A bit is 1 if
more than half of the shingle hashes have it. ``component_id`` is the smallest non-null id that can
be reached, null if there is none. Repeated rows are linked like other equal texts. Of each component
``dedup`` keeps the row with the smallest id (null last; of rows with equal id, one). An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from claimlens.llm.base import WORD, pieces, stored, texts_of
from claimlens.llm.components import components

SEED = 42
SHINGLE, MAX_BITS, AGREE = 4, 4, 2
PIVOTS = 16
BUCKET = 4096
# Groups up to this size are compared by shifted arrays, all groups of a batch at once.
SMALL = 16

# Reference fingerprints, by rule.
REFERENCES = np.array([xxhash.xxh64_intdigest(f"pivot {i}", SEED) for i in range(PIVOTS)], np.uint64)

# Words of a text hashed at a time: bounds what a very long text takes.
WORDS = 20_000

find_words = re.compile(WORD.encode()).finditer


# --- fingerprints -----------------------------------------------------------------


def shingle_hashes(text: str, width: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles, some thousand at a time."""
    hash_of = xxhash.xxh64_intdigest
    found = find_words(text.encode("utf-8", "replace").lower())  # bytes.lower() changes A-Z only
    words: list[bytes] = []
    while more := [m.group() for m in islice(found, WORDS)]:
        words = words[len(words) - width + 1 :] + more if words else more
        joined = b" ".join(words)
        ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
        if len(words) < width:
            yield np.array([hash_of(joined, SEED)], "<u8")
        else:
            starts = [0, *[e + 1 for e in ends[:-width]]]
            yield np.array([hash_of(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])], "<u8")


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(texts: list[str], width: int, second: bool = False) -> list[np.ndarray]:
    """Signed 64-bit fingerprints of each text: one array, or two."""
    out = [np.zeros(len(texts), np.uint64) for _ in range(1 + second)]
    for i, text in enumerate(texts):
        n, counts = 0, np.zeros((len(out), 64), np.int64)
        for hashes in shingle_hashes(text, width):
            n += len(hashes)
            for count in counts:
                count += bit_counts(hashes)
                hashes = (hashes ^ hashes >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
                hashes ^= hashes >> np.uint64(29)
        for found, count in zip(out, counts):
            found[i] = np.packbits(count * 2 > n, bitorder="little").view("<u8")[0]
    return [x.view(np.int64) for x in out]


def with_fingerprint(df: DataFrame, text: str, width: int, *out: str) -> DataFrame:
    """All columns of ``df`` and the fingerprint, or two."""
    at = df.columns.index(text)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = fingerprints([str(t) for t in texts_of(batch.column(at))], width, len(out) > 1)
            made = [pa.array(x, pa.int64()) for x in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *out])

    return df.mapInArrow(marked, StructType([*df.schema.fields, *[StructField(c, LongType()) for c in out]]))


# --- buckets ----------------------------------------------------------------------


def bit_pieces(n: int) -> list[int]:
    """Masks of ``n`` pieces of near-equal width."""
    limits = [round(64 * i / n) for i in range(n + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(limits, limits[1:])]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bucketed(distinct: DataFrame, masks: list[int]) -> DataFrame:
    """(keys, fp, and second if given): each fingerprint once for each choice of pieces.

    Dealt out first, by number, so that no task multiplies and counts a large part of them.
    """
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.explode(F.array(*[F.lit(i) for i in range(len(masks))])).alias("keys")
    return distinct.repartition(tasks, "fp").select(number, *distinct.columns)


def masked(masks: list[int]) -> Column:
    """The bits of the fingerprint that make its bucket."""
    return F.col("fp").bitwiseAND(F.element_at(F.array(*[F.lit(m) for m in masks]), F.col("keys") + 1))


def in_blocks(buckets: DataFrame, masks: list[int], largest: int, weight: str | None = None) -> DataFrame:
    """Rows by bucket and pair of blocks: (keys, masked, first, last, fp, ...). Small buckets are one block.

    A block has about ``largest`` rows at most, or so much of ``weight`` if that is given.
    """
    prints = buckets.columns[1:]
    total = F.count("*") if weight is None else F.sum(weight)
    sizes = buckets.groupBy("keys", masked(masks).alias("masked")).agg(total.alias("n"))
    # Few or none; written, so that their size is known before the join.
    large = stored(sizes.where(F.col("n") > largest), "large-buckets")
    large = large.select(F.col("keys").alias("large_keys"), F.col("masked").alias("large_masked"), "n")
    own_bucket = (F.col("keys") == F.col("large_keys")) & (masked(masks) == F.col("large_masked"))
    sized = buckets.join(large, own_bucket, "left").select("keys", *prints, "n")
    sized = sized.withColumn("blocks", F.coalesce(F.ceil(F.col("n") / F.lit(largest)), F.lit(1)))
    own = F.pmod(F.xxhash64(*prints), F.col("blocks"))  # equal fingerprints are dealt out too
    partners = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.struct(F.least(own, other).alias("first"), F.greatest(own, other).alias("last")),
    )
    paired = sized.select("keys", *prints, F.explode(partners).alias("pair"))
    rows = paired.repartition("keys", masked(masks), "pair").select(
        "keys", masked(masks).alias("masked"), "pair.first", "pair.last", *prints
    )
    return rows.sortWithinPartitions("keys", "masked", "first", "last")


def distances(fps: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps ^ others)


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Distance of each fingerprint to each reference."""
    return distances(fps[:, None], REFERENCES[None, :]).astype(np.int8)


class Close:
    """Which fingerprints of some rows are close: in the first and, if there is one, in the second."""

    def __init__(self, fps: np.ndarray, max_bits: int, second: np.ndarray | None = None, also_bits: int = 64):
        self.fps, self.max_bits, self.second, self.also_bits = fps, max_bits, second, also_bits
        self.table = pivot_table(fps)

    def among(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the close ones among the pairs (a, b) of rows: pivots first, then their own distance."""
        kept = np.flatnonzero((np.abs(self.table[a] - self.table[b]) <= self.max_bits).all(axis=1))
        kept = kept[distances(self.fps[a[kept]], self.fps[b[kept]]) <= self.max_bits]
        if self.second is not None:
            kept = kept[distances(self.second[a[kept]], self.second[b[kept]]) <= self.also_bits]
        return kept


def small_links(rows: Close, group: np.ndarray) -> list[np.ndarray]:
    """Links within small groups: row i against rows i + 1, i + 2, ... while they are of its group."""
    fps, found = rows.fps, []
    for step in range(1, SMALL):
        a = np.flatnonzero(group[:-step] == group[step:]) if step < len(fps) else np.empty(0, np.int64)
        if not len(a):
            break
        a = a[rows.among(a, a + step)]
        found.append(np.stack([fps[a], fps[a + step]], axis=1))
    return found


def large_links(rows: Close) -> list[np.ndarray]:
    """A spanning forest of the links of one group: from each member reached, the close ones not yet reached."""
    fps, found = rows.fps, []
    left = np.arange(len(fps))
    while len(left):
        waiting, left = [int(left[0])], left[1:]
        while waiting and len(left):
            at = waiting.pop()
            kept = rows.among(np.full(len(left), at), left)
            reached = left[kept]
            found.append(np.stack([np.full(len(reached), fps[at]), fps[reached]], axis=1))
            waiting += reached.tolist()
            left = np.delete(left, kept)
    return found


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows of blocks (see ``in_blocks``) in tables that cut no group."""
    carried: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if carried is None else pa.concat_tables([carried, rows])
        # The last group may go on in the next batch.
        end, last = len(rows), [rows.column(c)[len(rows) - 1] for c in range(4)] if len(rows) else None
        if last is None:
            continue
        same = np.ones(end, bool)
        for c in range(4):
            same &= rows.column(c).to_numpy() == last[c].as_py()
        first = end - int(same.sum())
        if first:
            yield rows.slice(0, first)
        carried = rows.slice(first).combine_chunks()
    if carried is not None:
        yield carried


def group_numbers(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's group, and the groups' sizes."""
    change = np.zeros(len(rows), bool)
    for column in (rows.column(c).to_numpy() for c in range(4)):
        change[1:] |= column[1:] != column[:-1]
    group = np.cumsum(change)
    return group, np.bincount(group)


def links(
    distinct: DataFrame, max_bits: int, agree: int = AGREE, largest: int = BUCKET, also_bits: int = 64
) -> DataFrame:
    """(a, b): links between the fingerprints ``fp``, enough to connect all that are close.

    If ``distinct`` has a column ``second``, a link needs that one within ``also_bits`` too. This is checked before the
    spanning forest is chosen: a forest of unconfirmed links may leave out the confirmed ones.
    """

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            fps = rows.column(4).to_numpy().view(np.uint64)
            second = rows.column(5).to_numpy().view(np.uint64) if rows.num_columns > 5 else None

            def at(places: np.ndarray | slice) -> Close:
                return Close(fps[places], max_bits, None if second is None else second[places], also_bits)

            group, sizes = group_numbers(rows)
            few = (sizes[group] > 1) & (sizes[group] <= SMALL)
            found = small_links(at(few), group[few]) if few.any() else []
            starts = np.cumsum(sizes) - sizes
            for g in np.flatnonzero(sizes > SMALL).tolist():
                found += large_links(at(slice(starts[g], starts[g] + sizes[g])))
            pairs = np.concatenate(found) if found else np.empty((0, 2), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, i].view(np.int64)) for i in (0, 1)], ["a", "b"])

    masks = [signed(sum(chosen)) for chosen in combinations(bit_pieces(max_bits + agree), agree)]
    return in_blocks(bucketed(distinct, masks), masks, largest).mapInArrow(linked, "a long, b long").distinct()


def component_ids(
    marked: DataFrame,
    id: str,
    fp: str,
    max_bits: int = MAX_BITS,
    agree: int = AGREE,
    second: str | None = None,
    also_bits: int = 64,
    largest: int = BUCKET,
) -> DataFrame:
    """One row per distinct fingerprint: fp, root (of its component), component_id."""
    other = F.lit(0).cast("long") if second is None else F.col(second)
    distinct = marked.groupBy(F.col(fp).alias("fp")).agg(F.min(id).alias("least"), F.min(other).alias("second"))
    distinct = stored(distinct, "fingerprints")
    prints = ["fp"] if second is None else ["fp", "second"]
    found = links(distinct.select(*prints), max_bits, agree, largest, also_bits)
    roots = components(found).withColumnRenamed("node", "fp")
    joined = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.select("fp", "root").join(ids, "root").select("fp", "root", "component_id")


def decide(
    df: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row: id, fingerprint (16 hex digits), component_id."""
    narrow = df.select(F.col(id), F.col(text).cast("string").alias("__sim_text"))
    marked = stored(with_fingerprint(narrow, "__sim_text", width, "__sim_fp").drop("__sim_text"), "marked")
    found = component_ids(marked, id, "__sim_fp", max_bits)
    return marked.join(found, F.col("__sim_fp") == F.col("fp")).select(
        F.col(id), F.lower(F.lpad(F.hex("__sim_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def dedup(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    max_bits: int = MAX_BITS,
    agree: int = AGREE,
    also_bits: int | None = None,
) -> DataFrame:
    """One row of each component, with the columns of ``df``."""
    columns = ["__sim_fp"] if also_bits is None else ["__sim_fp", "__sim_second"]
    given, shown = df, text
    if df.schema[text].dataType != StringType():
        given, shown = df.withColumn("__sim_text", F.col(text).cast("string")), "__sim_text"
    marked = stored(with_fingerprint(given, shown, width, *columns).drop("__sim_text"), "marked")
    more = {} if also_bits is None else {"second": columns[1], "also_bits": also_bits}
    found = component_ids(marked.select(id, *columns), id, columns[0], max_bits, agree, **more)
    found = found.select(F.col("fp").alias("__sim_fp"), F.col("root").alias("__sim_root"))
    first = W.partitionBy("__sim_root").orderBy(F.col(id).asc_nulls_last())
    ranked = marked.join(found, "__sim_fp").withColumn("__sim_rank", F.row_number().over(first))
    return ranked.where(F.col("__sim_rank") == 1).select(*df.columns)

"""Near dedup by the share of distinct shingles, with SimHash fingerprints and pivots as the search.

Two texts are near copies if they share ``share`` of all their distinct word shingles or more. A text's distinct shingle
hashes give ``PRINTS`` independent 64-bit fingerprints, each cut into ``BANDS`` pieces; every piece is a bucket
key, and the buckets of all fingerprints are united. In a bucket pairs are discarded by
their numbers of shingles (an exact bound), by pivots, by their own distance and by that of the next fingerprint. What is left
is only a candidate: the shingles themselves are compared before anything is linked, so no link is false.

The search goes in two rounds, the first over few fingerprints. In the second the pairs of one component are
no longer looked at, so a large group of near copies never gives all its pairs. Groups of up to
``simhash.SMALL`` members propose all pairs; larger ones a minimum spanning forest by distance. Where a pair of a forest proves
false and its ends stay apart, links behind it may be missing. In such buckets members that still have a candidate of another
root get their shingles, all these candidates are compared in the bucket's own task, and only a forest of true links leaves it: rows
stay in proportion to the members, however many pairs are false. So components are those of all candidates.

Defined results: shingles are those of ``simhash``; texts without words are copies of each other. Of each component the row
with the smallest id is kept (null last; of rows with equal id, one).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from claimlens.llm import simhash
from claimlens.llm.base import pieces, stored, texts_of
from claimlens.llm.components import components

WIDTH, SHARE = 5, 0.8
# Fingerprints, and bucket keys of each. Texts that share 0.8 of their shingles differ in 15 % of the bits: they meet in
# a given bucket with a chance of 0.072, in one of 64 with 0.99.
PRINTS, BANDS = 16, 4
# Most bits that two texts of a bucket differ in, and in the next fingerprint: three standard deviations above 0.8.
MAX_BITS, ALSO_BITS = 15, 19
# For the rounding of share times a number.
SLACK = 1e-6
# Fingerprints of the first round.
FIRST = 2
# Shingles of a block where a bucket's sets are compared in its task: a task holds two blocks.
SHINGLES = 1 << 21
MIXERS = np.array([xxhash.xxh64_intdigest(f"print {i}", simhash.SEED) for i in range(PRINTS)], np.uint64)
NODE, SIZE, MARKS, ROW, TEXT = "__near_node", "__near_size", "__near_prints", "__near_row", "__near_text"


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    found = list(simhash.shingle_hashes(text, width))
    return np.unique(np.concatenate(found)) if found else np.empty(0, "<u8")


def prints(hashes: np.ndarray) -> np.ndarray:
    """All fingerprints of a set of shingles."""
    counts = np.zeros(64 * PRINTS, np.int64)
    for i in range(0, len(hashes), 255):  # a byte holds so many
        mixed = hashes[i : i + 255, None] ^ MIXERS
        mixed = (mixed ^ mixed >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        counts += np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")


def with_prints(df: DataFrame, text: str, width: int) -> DataFrame:
    """All columns and the digest of the shingle set, its size and its fingerprints."""
    at = df.columns.index(text)
    fields = [StructField(NODE, LongType()), StructField(SIZE, IntegerType()), StructField(MARKS, ArrayType(LongType()))]

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            nodes, sizes, marks = [], [], [np.empty(0, np.int64)]
            for t in texts_of(batch.column(at)):
                hashes = shingle_set(t, width)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), simhash.SEED))
                sizes.append(len(hashes))
                marks.append(prints(hashes))
            offsets = pa.array(np.arange(len(nodes) + 1) * PRINTS, pa.int32())
            made = [
                pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array(sizes, pa.int32()),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(marks))),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *[f.name for f in fields]])

    return df.mapInArrow(marked, StructType([*df.schema.fields, *fields]))


class Near(simhash.Close):
    """Which rows may be near copies: their numbers of shingles first, then as in simhash."""

    def __init__(self, rows: list[np.ndarray], share: float):
        fps, second, self.nodes, self.sizes, self.roots = rows
        super().__init__(fps.view(np.uint64), MAX_BITS, second.view(np.uint64), ALSO_BITS)
        self.share = share

    def among(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = self.sizes[a], self.sizes[b]
        kept = np.flatnonzero((self.roots[a] != self.roots[b]) & (np.minimum(x, y) >= self.share * np.maximum(x, y) - SLACK))
        return kept[super().among(a[kept], b[kept])]

    def bits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        first = simhash.distances(self.fps[a], self.fps[b]).astype(np.int64)
        return first + simhash.distances(self.second[a], self.second[b])


def all_pairs(rows: Near, group: np.ndarray) -> Iterator[np.ndarray]:
    """Candidates within small groups: row i against rows i + 1, i + 2, ... while they are of its group."""
    for step in range(1, simhash.SMALL):
        a = np.flatnonzero(group[:-step] == group[step:]) if step < len(group) else np.empty(0, np.int64)
        if not len(a):
            break
        a = a[rows.among(a, a + step)]
        yield np.stack([rows.nodes[a], rows.nodes[a + step]], axis=1)


def spanning_pairs(rows: Near) -> np.ndarray:
    """A minimum spanning forest of one group's candidates by distance; rows of one root count as joined."""
    n, far = len(rows.nodes), 1 << 20
    best, source, left = np.full(n, far), np.zeros(n, np.int64), np.ones(n, bool)
    found, at = [], 0
    while True:
        left[at] = False
        others = np.flatnonzero(left)
        if not len(others):
            break
        here = np.full(len(others), at)
        best[others[rows.roots[others] == rows.roots[at]]] = -1
        kept = rows.among(here, others)
        reached, bits = others[kept], rows.bits(here[kept], others[kept])
        nearer = bits < best[reached]
        best[reached[nearer]], source[reached[nearer]] = bits[nearer], at
        at = int(others[np.argmin(best[others])])
        if 0 <= best[at] < far:
            found.append((source[at], at))
    return rows.nodes[np.array(found, np.int64).reshape(-1, 2)]


def with_partner(rows: Near) -> np.ndarray:
    """Which rows of one group have a candidate of another root."""
    found = np.zeros(len(rows.nodes), bool)
    for at in range(len(found) - 1):
        others = np.arange(at + 1, len(found))
        kept = others[rows.among(np.full(len(others), at), others)]
        found[kept] = True
        found[at] |= len(kept) > 0
    return found


def true_links(rows: Near, sets: list[np.ndarray]) -> np.ndarray:
    """A spanning forest of one group's links: candidates whose sets share enough; rows of one root count as joined."""
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    sizes, found = rows.sizes.astype(np.int64), []
    starts, present = np.cumsum(sizes) - sizes, np.zeros(len(numbers), bool)
    for at in range(len(sizes) - 1):
        others = np.arange(at + 1, len(sizes))
        kept = others[rows.among(np.full(len(others), at), others)]
        if not len(kept):
            continue
        own, lengths = numbers[starts[at] : starts[at] + sizes[at]], sizes[kept]
        ahead = np.cumsum(lengths) - lengths
        places = np.repeat(starts[kept] - ahead, lengths) + np.arange(lengths.sum())
        present[own] = True
        both = np.add.reduceat(present[numbers[places]], ahead, dtype=np.int64)
        present[own] = False
        for b in kept[both >= rows.share * (sizes[at] + lengths - both) - SLACK].tolist():
            if rows.roots[b] != rows.roots[at]:
                found.append((at, b))
                rows.roots[rows.roots == rows.roots[b]] = rows.roots[at]
    return rows.nodes[np.array(found, np.int64).reshape(-1, 2)]


def bucket_rows(nodes: DataFrame, first: int, last: int) -> tuple[DataFrame, list[int]]:
    """Each node once for each bucket key of the fingerprints first..last-1, and the keys' masks."""
    masks = [simhash.signed(m) for _ in range(first, last) for m in simhash.bit_pieces(BANDS)]
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.explode(F.array(*[F.lit(i) for i in range(len(masks))])).alias("keys")
    place = (F.lit(first) + F.floor(F.col("keys") / BANDS)).cast("int")
    buckets = (
        nodes.where(F.col(SIZE) > 0)
        .repartition(tasks, NODE)
        .select(number, NODE, "root", SIZE, MARKS)
        .select(
            "keys",
            F.element_at(MARKS, place + 1).alias("fp"),
            F.element_at(MARKS, (place + 1) % PRINTS + 1).alias("second"),
            NODE,
            SIZE,
            "root",
        )
    )
    return buckets, masks


def candidates(nodes: DataFrame, first: int, last: int, share: float, largest: int) -> DataFrame:
    """(a, b, bucket, masked): pairs of nodes of different roots to be verified, by the fingerprints first..last-1.

    ``nodes``: node, root, size, prints. Pairs of large groups name their bucket, others have -1.
    """
    buckets, masks = bucket_rows(nodes, first, last)

    def batch_of(pairs: np.ndarray, bucket: int = -1, masked: int = 0) -> pa.RecordBatch:
        ends, n = np.sort(pairs, axis=1), len(pairs)
        columns = [pa.array(ends[:, 0]), pa.array(ends[:, 1]), pa.array(np.full(n, bucket, np.int32)), pa.array(np.full(n, masked))]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "bucket", "masked"])

    def proposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in simhash.whole_groups(batches):
            columns = [rows.column(c).to_numpy() for c in range(4, 9)]
            group, sizes = simhash.group_numbers(rows)
            few = np.flatnonzero((sizes[group] > 1) & (sizes[group] <= simhash.SMALL))
            if len(few):
                found = all_pairs(Near([c[few] for c in columns], share), group[few])
                yield batch_of(np.concatenate([np.empty((0, 2), np.int64), *found]))
            keys, values = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            starts = np.cumsum(sizes) - sizes
            for g in np.flatnonzero(sizes > simhash.SMALL).tolist():
                own = Near([c[starts[g] : starts[g] + sizes[g]] for c in columns], share)
                yield batch_of(spanning_pairs(own), first * BANDS + int(keys[starts[g]]), int(values[starts[g]]))

    made = simhash.in_blocks(buckets, masks, largest).mapInArrow(proposed, "a long, b long, bucket int, masked long")
    return made.distinct()


def links_of_buckets(
    nodes: DataFrame, opened: DataFrame, distinct: DataFrame, marked: DataFrame, text: str, width: int, share: float, largest: int
) -> DataFrame:
    """(a, b): links that join what the candidates of the buckets ``opened`` (bucket, masked) join, compared where the buckets are."""
    buckets, masks = bucket_rows(nodes, 0, PRINTS)
    open_buckets = opened.select(F.col("bucket").alias("open_keys"), F.col("masked").alias("open_masked"))
    buckets = buckets.join(open_buckets, (F.col("keys") == F.col("open_keys")) & (simhash.masked(masks) == F.col("open_masked")), "left_semi")
    names = buckets.columns

    def groups(rows: pa.Table) -> Iterator[tuple[slice, Near]]:
        columns = [rows.column(c).to_numpy() for c in range(4, 9)]
        sizes = simhash.group_numbers(rows)[1]
        starts = np.cumsum(sizes) - sizes
        for g in np.flatnonzero(sizes > 1).tolist():
            own = slice(starts[g], starts[g] + sizes[g])
            yield own, Near([c[own].copy() for c in columns], share)

    def partnered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in simhash.whole_groups(batches):
            wanted = np.zeros(len(rows), bool)
            for own, near in groups(rows):
                wanted[own] = with_partner(near)
            yield from rows.filter(pa.array(wanted)).select(names).to_batches()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in simhash.whole_groups(batches):
            hashes = rows.column(9)
            for own, near in groups(rows):
                sets = [np.frombuffer(x.as_buffer(), "<u8") for x in hashes.slice(own.start, own.stop - own.start)]
                ends = np.sort(true_links(near, sets), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    blocks = simhash.in_blocks(buckets, masks, largest)
    # A row of a bucket of several blocks may be found by several of them.
    rows = stored(blocks.mapInArrow(partnered, buckets.schema).distinct(), "near-partnered")
    sets = shingle_sets(rows.select(NODE).distinct(), distinct, marked, text, width)
    with_sets = rows.join(sets.select(F.col("node").alias(NODE), "hashes"), NODE).select(*names, "hashes")
    blocks = simhash.in_blocks(with_sets, masks, SHINGLES, SIZE)
    return blocks.mapInArrow(linked, "a long, b long").distinct()


def shingle_sets(wanted: DataFrame, distinct: DataFrame, marked: DataFrame, text: str, width: int) -> DataFrame:
    """(node, hashes) of the wanted nodes."""
    chosen = distinct.select(NODE, ROW).join(wanted, NODE).select(ROW, NODE)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = [shingle_set(t, width).tobytes() for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "hashes"])

    # One row of each node is hashed again: only nodes with a candidate need their sets.
    sets = marked.select(ROW, F.col(text).alias(TEXT)).join(chosen, ROW).select(NODE, TEXT)
    return stored(sets.mapInArrow(hashed, "node long, hashes binary"), "near-sets")


def verified(pairs: DataFrame, distinct: DataFrame, marked: DataFrame, text: str, width: int, share: float) -> DataFrame:
    """The pairs and whether their shingle sets share enough: (a, b, near)."""
    ends = pairs.select(F.col("a").alias(NODE)).unionByName(pairs.select(F.col("b").alias(NODE))).distinct()
    sets = shingle_sets(ends, distinct, marked, text, width)

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("hashes").alias(f"{name}_hashes"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both >= share * (len(x) + len(y) - both) - SLACK)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.bool_())], ["a", "b", "near"])

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_hashes", "b_hashes")
    return joined.mapInArrow(compared, "a long, b long, near boolean")


def left_out(forests: DataFrame, judged: DataFrame, nodes: DataFrame) -> DataFrame:
    """(bucket, masked): buckets with a false pair in their forest whose ends have different roots."""
    false = judged.where(~F.col("near")).select("a", "b")
    apart = forests.where(F.col("bucket") >= 0).join(false, ["a", "b"])
    for end in ("a", "b"):
        apart = apart.join(nodes.select(F.col(NODE).alias(end), F.col("root").alias(f"{end}_root")), end)
    return apart.where(F.col("a_root") != F.col("b_root")).select("bucket", "masked").distinct()


def near_roots(
    distinct: DataFrame, marked: DataFrame, text: str, width: int, share: float, largest: int = simhash.BUCKET
) -> DataFrame:
    """(node, root) of every node that is linked to another."""
    nodes, judged, roots = distinct.withColumn("root", F.col(NODE)), None, None

    def judge(proposed: DataFrame) -> None:
        nonlocal nodes, judged, roots
        pairs = proposed.select("a", "b").distinct()
        if judged is not None:
            pairs = pairs.join(judged.select("a", "b"), ["a", "b"], "left_anti")
        new = stored(verified(stored(pairs, "near-pairs"), distinct, marked, text, width, share), "near-judged")
        judged = new if judged is None else judged.unionByName(new)
        roots = components(judged.where("near").select("a", "b"))
        found = roots.select(F.col("node").alias(NODE), "root")
        nodes = distinct.join(found, NODE, "left").withColumn("root", F.coalesce("root", NODE))

    forests = []
    for first, last in ((0, FIRST), (FIRST, PRINTS)):
        forests.append(stored(candidates(nodes, first, last, share, largest), "near-proposed"))
        judge(forests[-1])
    opened = stored(left_out(forests[0].unionByName(forests[1]), judged, nodes), "near-open")
    if not opened.isEmpty():
        more = links_of_buckets(nodes, opened, distinct, marked, text, width, share, largest)
        roots = components(judged.where("near").select("a", "b").unionByName(stored(more, "near-links")))
    return roots


def dedup(
    df: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, share: float = SHARE
) -> DataFrame:
    """One row of each component of near copies, with the columns of ``df``."""
    given, shown = df, text
    if df.schema[text].dataType != StringType():
        given, shown = df.withColumn(TEXT, F.col(text).cast("string")), TEXT
    numbered = with_prints(given, shown, width).withColumn(ROW, F.monotonically_increasing_id())
    marked = stored(numbered, "near-marked")
    distinct = marked.groupBy(NODE).agg(F.min(ROW).alias(ROW), F.first(SIZE).alias(SIZE), F.first(MARKS).alias(MARKS))
    distinct = stored(distinct, "near-nodes")
    roots = near_roots(distinct, marked, shown, width, share).select(F.col("node").alias(NODE), "root")
    rows = marked.select(F.col(id).alias("__near_id"), NODE, ROW).join(roots, NODE, "left")
    order: Column = F.struct(F.col("__near_id").isNull(), F.col("__near_id"), F.col(ROW).alias("row"))
    kept = rows.groupBy(F.coalesce("root", NODE).alias("root")).agg(F.min(order)["row"].alias(ROW))
    return marked.join(kept.select(ROW), ROW, "left_semi").select(*df.columns)

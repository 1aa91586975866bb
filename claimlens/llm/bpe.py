"""BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash over the bytes cuts each text into chunks whose limits depend on nearby content only, so a passage
that several documents share falls into the same chunks in all of them. A first pass finds the chunks that
different texts share, and the texts that ``REPEATS`` rows or more hold, which count as one shared chunk. A text without any is encoded as it
is read. In the others a shared chunk is only named; the first place in a task encodes it, one of these copies is kept, and its ids are
joined to all its places. The rest of the text is encoded in runs where it is cut. Then the joints are repaired: next to a
cut, the text between two safe points is encoded anew, and the ids that it replaces must agree with an encoding of the same
stretch on each side. If they don't, or if there is no safe point, the stretch grows, in the end to the whole
text. Only ids and the text at the joints are written or travel; no text does.

A safe point is a space or line feed between two letters. The pattern that cuts a text into pre-tokens
always ends one there and depends on nothing further to the left, and special tokens hold no such place; so the
encodings before and after it are independent, and the repaired ids are exactly those of the whole text.

Shared digests are known on the map side through a bit map of fixed size (``MAP_BITS``). A wrong hit only sends a
chunk through the join that need not have gone; there are no wrong misses.

Defined results: a null text is empty and has no ids. Texts that the fast encoder does not take (see ``tokenizer``) are encoded
whole by the library. All other columns, nulls and repeated rows are carried along; helper columns have names of their own
(``__bpe_*``). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

from claimlens.llm.base import pieces, stored, texts_of
from claimlens.llm.tokenizer import Encoder, encoder

KEY, PARTS, NEW, IDS, TEXT, DECODED = "__bpe_key", "__bpe_parts", "__bpe_new", "__bpe_ids", "__bpe_text", "__bpe_decoded"

PIECE = StructType().add("head", StringType()).add("middle", BinaryType()).add("tail", StringType())
PART_LIST = ArrayType(StructType().add("digest", BinaryType()).add("piece", PIECE))

# Chunks: a cut where the hash of the last WINDOW bytes has CUT_BITS zeros, at least SHORTEST bytes after the last.
WINDOW, CUT_BITS, SHORTEST = 32, 10, 256
# From so many rows on a repeated text is encoded once and joined: for fewer the join moves more than it saves.
REPEATS = 8
# 8 MB, whatever the size of the corpus.
MAP_BITS = 26

# A value of 64 bits for each byte, by rule.
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) for b in range(256)], np.uint64)
FACTOR = 0x9E3779B97F4A7C15

# Chunks that a task remembers to have encoded: 100 MB. One that it has forgotten is encoded again.
REMEMBERED = 1_000_000

SAFE = regex.compile(r"(?<=\p{L})[ \n](?=\p{L})")


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of UTF-8 bytes end; never inside a character."""
    n = len(data)
    if n < 2 * SHORTEST:
        return [n] if n else []
    codes = np.frombuffer(data, np.uint8)
    rolled, size = GEAR[codes], 1
    while size < WINDOW:  # doubling: the hash of 2k bytes from two hashes of k
        longer = rolled.copy()
        longer[size:] += rolled[:-size] * np.uint64(pow(FACTOR, size, 1 << 64))
        rolled, size = longer, 2 * size
    cut = (rolled >> np.uint64(40)) & np.uint64((1 << CUT_BITS) - 1) == 0
    cut[1:] &= (codes[1:] & 0xC0) != 0x80
    ends, last = [], 0
    for at in np.flatnonzero(cut).tolist():
        if at - last >= SHORTEST and n - at >= SHORTEST:
            ends.append(at)
            last = at
    return [*ends, n]


def chunks(data: bytes) -> list[tuple[bytes, bytes]]:
    """(digest, bytes) of each chunk."""
    ends = chunk_ends(data)
    cut = [data[a:b] for a, b in zip([0, *ends], ends)]
    return [(xxhash.xxh3_128_digest(c), c) for c in cut]


def slots(digests: list[bytes]) -> np.ndarray:
    """Place of each digest in the bit map."""
    return np.frombuffer(b"".join(d[:8] for d in digests), "<u8") & np.uint64((1 << MAP_BITS) - 1)


def shared_map(df: DataFrame, text: str, tokenizer: str) -> np.ndarray:
    """The bit map of the digests of repeated texts and of chunks that occur in different texts, as bytes."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer)
        for batch in pieces(batches):
            found, owners = [], []
            for t in texts_of(batch.column(0)):
                data = t.encode()
                if len(data) < SHORTEST or not e.settled(t):
                    continue
                # A whole text counts its rows (no owner), a chunk the texts that hold it.
                whole = xxhash.xxh3_128_digest(data)
                own = {d for d, _ in chunks(data)} - {whole}
                found += [whole, *own]
                owners += [None, *[xxhash.xxh3_64_intdigest(data) >> 1] * len(own)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(owners, pa.int64())], ["digest", "owner"])

    shared = (
        df.select(F.col(text).cast("string"))
        .mapInArrow(digests, "digest binary, owner long")
        .groupBy("digest")
        .agg(F.min("owner").alias("least"), F.max("owner").alias("most"), F.count_if(F.col("owner").isNull()).alias("rows"))
        .where((F.col("least") < F.col("most")) | (F.col("rows") >= REPEATS))
    )

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = slots(batch.column(0).to_pylist()) if batch.num_rows else np.empty(0, np.uint64)
            words = pa.array((at >> np.uint64(6)).astype(np.int64))
            bits = pa.array((np.uint64(1) << (at & np.uint64(63))).astype(np.int64))
            yield pa.RecordBatch.from_arrays([words, bits], ["word", "bits"])

    marked = shared.select("digest").mapInArrow(places, "word long, bits long").groupBy("word")
    words = np.zeros(1 << (MAP_BITS - 6), np.int64)
    # At most 2 ** (MAP_BITS - 6) rows of two numbers.
    for batch in marked.agg(F.bit_or("bits").alias("bits")).toArrow().to_batches():
        words[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return words.view(np.uint8)


class Sharing:
    """Which chunks of a text may be shared, by the broadcast map."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def flags(self, cut: list[tuple[bytes, bytes]]) -> list[bool]:
        if not cut:
            return []
        at = slots([d for d, _ in cut])
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0).tolist()


    def cut(self, e: Encoder, text: str) -> list[tuple[bytes | None, str]]:
        """The text in parts: (digest, chunk) if shared, (None, run) else; nothing if no part is shared."""
        data = text.encode()
        if len(data) < SHORTEST or not e.settled(text):
            return []
        whole = xxhash.xxh3_128_digest(data)
        if self.flags([(whole, data)])[0]:
            return [(whole, text)]
        cut = chunks(data)
        parts: list[tuple[bytes | None, bytes]] = []
        for (digest, chunk), flag in zip(cut, self.flags(cut)):
            if flag:
                parts.append((digest, chunk))
            elif parts and parts[-1][0] is None:
                parts[-1] = None, parts[-1][1] + chunk
            else:
                parts.append((None, chunk))
        return [(d, c.decode()) for d, c in parts] if any(d for d, _ in parts) else []


# --- joints -----------------------------------------------------------------------


def piece(e: Encoder, text: str, ids: np.ndarray) -> dict:
    """A part made ready for joining: the text before its first safe point, the ids between, the text after its last.

    The ids next to both points must agree with an encoding of the stretch beyond; if they don't, a point
    further inside is taken, and where none is left the part stays text.
    """
    for first in SAFE.finditer(text):
        head = e.encode(text[: first.start()])
        if np.array_equal(ids[: len(head)], head):
            break
    else:
        return {"head": text, "middle": None, "tail": None}
    high = len(text)
    while (last := last_safe(text, first.start(), high)) > first.start():
        tail = e.encode(text[last:])
        if np.array_equal(ids[len(ids) - len(tail) :], tail):
            break
        high = last + 1  # the letter after the next point must still be seen
    else:
        tail = ids[len(head) :]
    return {"head": text[: first.start()], "middle": packed(ids[len(head) : len(ids) - len(tail)]), "tail": text[last:]}


def last_safe(text: str, low: int, high: int) -> int:
    """The last safe point below ``high``, looked for from the right in growing stretches; ``low`` is one."""
    width = 64
    while (start := max(low, high - width)) > low:
        found = [m.start() for m in SAFE.finditer(text, start, high)]
        if found:
            return found[-1]
        width *= 4
    return max((m.start() for m in SAFE.finditer(text, low, high)), default=low)


def stitch(e: Encoder, parts: list[dict]) -> np.ndarray:
    """Ids of the joined parts, exactly as if encoded whole: each joint is encoded anew between two safe points."""
    done, joint = [], ""
    for part in parts:
        joint += part["head"]
        if part["middle"] is not None:
            done += [e.encode(joint), unpacked(part["middle"])]
            joint = part["tail"]
    return np.concatenate([*done, e.encode(joint)])


def packed(ids: np.ndarray) -> bytes:
    """Two bytes an id where they suffice, else four; the first byte says which."""
    small = not len(ids) or int(ids.max()) < 1 << 16
    return (b"2" + ids.astype("<u2").tobytes()) if small else (b"4" + ids.astype("<u4").tobytes())


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u" + chr(data[0]), offset=1).astype("<u4")


# --- the operator -----------------------------------------------------------------


def encode(
    df: DataFrame,
    tokenizer: str,
    text: str = "text",
    ids: str = "ids",
    keep_text: bool = True,
    decoded: str | None = None,
) -> DataFrame:
    """All columns of ``df`` (``text`` only if ``keep_text``) and ``ids``: little-endian unsigned 32-bit integers.

    With ``decoded`` a column of that name holds what ``decode`` makes of the ids, in the same pass over them: a task
    then needs one Python worker instead of two.
    """
    spark = df.sparkSession
    bits = spark.sparkContext.broadcast(shared_map(df, text, tokenizer))
    kept = df.columns if keep_text else [c for c in df.columns if c != text]
    given = df.select(*kept, F.col(text).cast("string").alias(TEXT))
    fields = df.select(*kept).schema.fields

    def finished(e: Encoder, batch: pa.RecordBatch, made: list[bytes | None]) -> pa.RecordBatch:
        columns, names = [*batch.columns[: len(kept)], pa.array(made, pa.binary())], [*kept, IDS]
        if decoded is not None:
            columns.append(pa.array([None if x is None else e.decode(np.frombuffer(x, "<u4")) for x in made], pa.string()))
            names.append(DECODED)
        return pa.RecordBatch.from_arrays(columns, names)

    def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, sharing = encoder(tokenizer), Sharing(bits.value)
        for batch in pieces(batches):
            made = []
            for value in texts_of(batch.column(len(kept))):
                made.append(None if sharing.cut(e, value) else e.encode(value).astype("<u4").tobytes())
            full = finished(e, batch, made)
            yield full.filter(full.column(len(kept)).is_valid())

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Key, parts (own runs encoded, shared chunks by digest) and the chunks that this task meets for the first time."""
        e, sharing, seen = encoder(tokenizer), Sharing(bits.value), set()
        types = [to_arrow_schema(with_parts).field(n).type for n in (PARTS, NEW)]
        for batch in pieces(batches):
            keys, lists, news = [], [], []
            for value in texts_of(batch.column(len(kept))):
                parts, new = [], []
                for digest, part in sharing.cut(e, value):
                    made = piece(e, part, e.encode(part)) if digest is None or digest not in seen else None
                    parts.append({"digest": digest, "piece": made if digest is None else None})
                    if digest is not None and made is not None:
                        new.append({"digest": digest, "piece": made})
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(digest)
                keys.append(xxhash.xxh3_128_digest(value.encode()) if parts else None)
                lists.append(parts or None)
                news.append(new or None)
            key = pa.array(keys, pa.binary())
            added = [key, pa.array(lists, types[0]), pa.array(news, types[1])]
            full = pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *added], [*kept, KEY, PARTS, NEW])
            yield full.filter(key.is_valid())

    def stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer)
        for batch in pieces(batches):
            made = []
            for parts, found in zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()):
                chunk = {f["digest"]: f["piece"] for f in found}
                made.append(stitch(e, [p["piece"] or chunk[p["digest"]] for p in parts]).astype("<u4").tobytes())
            yield finished(e, batch, made)

    with_ids = StructType([*fields]).add(IDS, BinaryType())
    if decoded is not None:
        with_ids = with_ids.add(DECODED, StringType())
    with_parts = StructType([*fields]).add(KEY, BinaryType()).add(PARTS, PART_LIST).add(NEW, PART_LIST)
    ready = given.mapInArrow(direct, with_ids)
    rest = stored(given.mapInArrow(shared, with_parts), "shared-texts")
    # One copy of each chunk; its ids go to all texts that name it, a text once however often it occurs.
    once = rest.select(F.explode(NEW).alias("c")).select("c.*").dropDuplicates(["digest"])
    named = rest.select(KEY, F.explode(F.filter(F.transform(PARTS, lambda p: p["digest"]), lambda d: d.isNotNull())).alias("digest")).distinct()
    found = named.join(once, "digest").groupBy(KEY).agg(F.collect_list(F.struct("digest", "piece")).alias(NEW))
    # Stored, so that both sides of the join are plain shuffles and a text with very many copies can be split.
    found = stored(found, "text-chunks")
    joined = rest.drop(NEW).join(found, KEY).select(*kept, PARTS, NEW)
    out = ready.unionByName(joined.mapInArrow(stitched, with_ids)).withColumnRenamed(IDS, ids)
    return out if decoded is None else out.withColumnRenamed(DECODED, decoded)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``df`` and the decoded text of ``ids`` (null ids: an empty text)."""
    at = df.columns.index(ids)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer)
        for batch in pieces(batches):
            made = [e.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*batch.schema.names, text])

    return df.mapInArrow(texts, StructType([*df.schema.fields]).add(text, "string"))

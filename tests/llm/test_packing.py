"""Packing: plans against their definition, the bound, and all packings of small cases; the query against the library."""

import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimlens.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def sequences_of(runs):
    found = defaultdict(list)
    for r in runs:
        for i in range(r.count):
            found[r.sequence + i // r.each].append((r.offset + i % r.each * r.length, r.length))
    return found


def check_plan(counts, capacity):
    """Every piece is placed once, ranks are gapless, sequences are filled from 0 without gap. Returns their number."""
    runs, ranks = packing.plan(counts, capacity), Counter()
    for r in sorted(runs):
        assert r.rank == ranks[r.length]
        ranks[r.length] += r.count
    assert ranks == Counter({k: v for k, v in counts.items() if v})
    found = sequences_of(runs)
    for spans in found.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity and sum(3 * x > capacity for _, x in spans) <= 2
    assert sorted(found) == list(range(len(found)))
    return len(found)


@lru_cache(maxsize=None)
def fewest(lengths, room, capacity):
    """Fewest sequences, by trying every place for each piece, longest first."""
    if not lengths:
        return len(room)
    x, rest = lengths[0], lengths[1:]
    best = fewest(rest, tuple(sorted((*room, capacity - x))), capacity)
    for i, r in enumerate(room):
        if r >= x and (i == 0 or room[i - 1] != r):
            best = min(best, fewest(rest, tuple(sorted((*room[:i], *room[i + 1 :], r - x))), capacity))
    return best


def test_plans_near_the_fewest():
    rng = random.Random(2)
    wanted = made = 0
    for _ in range(150):
        capacity = rng.choice([6, 10, 30])
        counts = Counter(rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9)))
        n = check_plan(counts, capacity)
        best = fewest(tuple(sorted(counts.elements(), reverse=True)), (), capacity)
        assert packing.least_sequences(counts, capacity) <= best <= n <= best + 1
        wanted, made = wanted + best, made + n
    assert made <= 1.02 * wanted


def test_matching_has_most_pairs():
    """Only large pieces: as many pairs as any matching has."""
    rng = random.Random(4)
    for _ in range(150):
        capacity = rng.choice([12, 30, 100])
        low = capacity // 3 + 1
        counts = Counter(rng.randrange(low, capacity + 1) for _ in range(rng.randrange(1, 9)))
        assert check_plan(counts, capacity) == fewest(tuple(sorted(counts.elements(), reverse=True)), (), capacity)


@pytest.mark.parametrize("capacity", [1, 2, 7, 4096])
def test_plans(capacity):
    rng = random.Random(capacity)
    for n in (0, 1, 2, 50, 2000):
        check_plan(Counter(min(capacity, 1 + int(rng.lognormvariate(5, 1.5))) for _ in range(n)), capacity)
    check_plan({capacity: 5}, capacity)
    check_plan({1: 5000}, capacity)


def test_plan_of_a_large_corpus_is_bounded():
    rng = random.Random(8)
    counts = {x: rng.randrange(1, 10**10) for x in range(1, 4097)}
    runs = packing.plan(counts, 4096)
    used = max(r.sequence + -(-r.count // r.each) for r in runs)
    assert len(runs) < 20_000 and used <= 1.005 * packing.least_sequences(counts, 4096)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_pieces_and_sequences(spark, docs, odd_rows, library):
    rows = odd_rows + [(100 + i, "same length here", "h") for i in range(60)]
    held, placed = packing.pack(docs(rows).repartition(4), PATH, end_id=1, capacity=64)
    found = placed.collect()
    wanted = Counter()
    for i, text, _ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 64)):
            own = ids[start : start + 64]
            wanted[i, piece, start, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == wanted
    spans = defaultdict(list)
    for r in found:
        spans[r.sequence_id].append((r.offset, r.length))
    for own in spans.values():
        ends = np.cumsum([x for _, x in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 64
    counts = Counter(r.length for r in found)
    assert len(spans) <= packing.least_sequences(counts, 64) + 1
    whole = {r.sequence_id: r for r in packing.sequences(held, placed).collect()}
    assert whole.keys() == spans.keys()
    for r in found:
        data = whole[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r.length)]
        assert zlib.crc32(data) == r.ids_crc32
        assert (r.doc_id, r.piece, r.start, r.offset) in [tuple(s) for s in whole[r.sequence_id].spans]


def test_empty_and_clashing(spark):
    names = "doc_id long, text string, length long, rank long, part int, before long"
    _, placed = packing.pack(spark.createDataFrame([], names), PATH, end_id=1, capacity=8)
    assert placed.collect() == []
    rows = [(None, None, 1, 1, 1, 1)] * 20 + [(7, "one two", 1, 1, 1, 1)]
    _, placed = packing.pack(spark.createDataFrame(rows, names), PATH, end_id=1, capacity=8)
    assert placed.count() == 21 and placed.agg(F.countDistinct("sequence_id")).first()[0] == 3


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    found = queries.op11_best_fit_packing(spark, folder).collect()
    wanted = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            wanted.add((r.doc_id, piece, start, len(ids[start : start + 4096]), zlib.crc32(ids[start : start + 4096].tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == wanted and len(found) == len(wanted)
    assert len({r.sequence_id for r in found}) <= packing.least_sequences(Counter(r.length for r in found), 4096) + 1

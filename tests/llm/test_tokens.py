"""Encoding, decoding, counts and files against the tokenizers library, text by text."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from claimlens.llm import bpe, queries, simple8b, token_counts, token_files
from claimlens.llm.tokenizer import Encoder
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
library = Tokenizer.from_file(PATH)


def ids_of(text):
    return library.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.fixture(scope="module")
def corpus(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_encoder_agrees_with_the_library(odd_rows):
    e = Encoder(PATH)
    assert e.fast is not None
    r = random.Random(5)
    alphabet = "abzéЖԧ 019'.,!\n\t\r\x0b\x0c\x1c\x85\xa0—’€sdtm"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(3000)]
    texts += ["".join(map(chr, range(1, 0x528)))] + [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1" for c in range(1, 0x528)]
    texts += [f"a{chr(c)}b {chr(c)}c" for c in [*range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC, 0x2122]]
    for text in texts + [t or "" for _, t, _ in odd_rows]:
        assert e.encode(text).tolist() == ids_of(text), text[:80]
        assert e.decode(e.encode(text)) == library.decode(ids_of(text), skip_special_tokens=False)


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_files_go_to_the_library(name):
    e = Encoder(public_tokenizers.path(name))
    assert e.fast is None
    assert e.encode("Some words").tolist() == e.library.encode("Some words", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60_000) | st.integers(0, 1), max_size=300))
@settings(max_examples=200, deadline=None)
def test_simple8b_round_trip(values):
    given = np.array(values, np.uint64)
    words = simple8b.encode(given)
    assert simple8b.decode(words, len(values)).tolist() == values
    assert len(words) <= 2 * len(values)


def test_simple8b_packs():
    assert len(simple8b.encode(np.ones(600, np.uint64))) == 10
    assert len(simple8b.encode(np.full(600, 1023, np.uint64))) == 100


@given(st.lists(st.sampled_from(["a b", " the", "\n", "'s", "don't stop", "<|endof", "text|>", "  ", "1.5", "é è"]), min_size=2, max_size=40), st.data())
@settings(max_examples=200, deadline=None)
def test_stitch_is_exact(words, data):
    text = "".join(words)
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(text) - 1)), max_size=5)))
    parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
    parts = [p for p in parts if p] or [text]
    e = bpe.encoder(PATH)
    assert bpe.stitch(e, [bpe.piece(e, p, e.encode(p)) for p in parts]).tolist() == ids_of(text)


def test_chunks_depend_on_content():
    passage = "".join(random.Random(1).choices("abcdefgh ", k=20_000)).encode()
    alone = {d for d, _ in bpe.chunks(passage)}
    moved = {d for d, _ in bpe.chunks(b"Something else in front of it. " * 40 + passage)}
    assert len(alone & moved) > 0.7 * len(alone)
    for text in ("", "é" * 3000, "a" * 5000):
        assert b"".join(c for _, c in bpe.chunks(text.encode())).decode() == text
        assert all(c.decode() for _, c in bpe.chunks(text.encode()))


@pytest.mark.parametrize("one_pass", [False, True])
def test_encode_and_decode_keep_rows(spark, docs, odd_rows, one_pass):
    given = docs(odd_rows).withColumnRenamed("lang", "ids_of_other")
    made = bpe.encode(given, PATH, decoded="decoded") if one_pass else bpe.decode(bpe.encode(given, PATH), PATH)
    assert made.columns == [*given.columns, "ids", "decoded"]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", bytes(r.ids), r.decoded) for r in made.collect())
    want = sorted(
        (i is None, i or 0, t or "", packed(ids_of(t)), library.decode(ids_of(t), skip_special_tokens=False))
        for i, t, _ in odd_rows
    )
    assert got == want


def test_shared_passages_are_joined(spark, docs, odd_rows):
    """The passage of documents 7, 8 and 9 is found by its chunks and encoded once."""
    seen = bpe.Sharing(bpe.shared_map(docs(odd_rows), "text", PATH))
    texts = {i: t or "" for i, t, _ in odd_rows}
    assert sum(seen.flags(bpe.chunks(texts[8].encode()))) >= 2
    assert not any(seen.flags(bpe.chunks(("Only here: " + "qwertz uiop " * 300).encode())))


def test_texts_of_many_rows_are_encoded_once(spark, docs):
    """A text of nine rows goes through the join as one chunk, one of two rows is encoded where it stands."""
    often, seldom = "Often there, it's said. " * 40, "Seldom there, we don't know. " * 40
    rows = [(i, often, "a") for i in range(9)] + [(10, seldom, "a"), (11, seldom, "b"), (12, None, "b"), (13, often[:300], "b")]
    seen = bpe.Sharing(bpe.shared_map(docs(rows), "text", PATH))
    e = bpe.encoder(PATH)
    assert [d is not None for d, _ in seen.cut(e, often)] == [True] and seen.cut(e, seldom) == []
    made = bpe.encode(docs(rows).repartition(4), PATH, decoded="decoded").collect()
    assert len(made) == len(rows)
    for r in made:
        assert bytes(r.ids) == packed(ids_of(r.text)) and r.decoded == (r.text or "")


def test_empty_tables(spark, docs, folder):
    none = docs([])
    assert bpe.decode(bpe.encode(none, PATH), PATH).collect() == []
    assert token_counts.count_tokens(none, PATH).collect() == []
    token_files.write_tokens(none, f"{folder}/t", PATH, 2)
    assert token_files.read_tokens(spark, f"{folder}/t").collect() == []


def test_op1(spark, corpus):
    got = sorted(map(tuple, queries.op1_bpe_chunk_reuse(spark, FOLDER).collect()))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(ids_of(t)), sha(packed(ids_of(t))), sha(library.decode(ids_of(t), skip_special_tokens=False).encode())) for i, t in corpus]
    assert got == sorted(want)


def test_op5(spark, corpus):
    start, want = 0, []
    for i, t in sorted(corpus):
        ids = [*ids_of(t), 2]
        want.append((i, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    assert sorted(map(tuple, queries.op5_token_files(spark, FOLDER).collect())) == want


def test_token_files_of_odd_rows(spark, docs, odd_rows, folder, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 500)
    token_files.write_tokens(docs(odd_rows), f"{folder}/t", PATH, 2)
    rows = sorted(token_files.read_tokens(spark, f"{folder}/t").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _, _ in odd_rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    assert sorted(bytes(r.ids) for r in rows) == sorted(packed([*ids_of(t), 2]) for _, t, _ in odd_rows)


def test_op6(spark, corpus):
    got = sorted(map(tuple, queries.op6_token_counts(spark, FOLDER).collect()))
    assert got == sorted((i, len((t or "").encode()), len(ids_of(t)), len(ids_of(t)) > 512) for i, t in corpus)


def test_counts_of_odd_rows(spark, docs, odd_rows, monkeypatch):
    key = lambda r: (r[0] is None, r)
    want = sorted(((i, len((t or "").encode()), len(ids_of(t))) for i, t, _ in odd_rows), key=lambda r: (r[0] is None, str(r)))
    for most in (0, 3, 1 << 16):  # whatever the table holds
        monkeypatch.setattr(token_counts.frequent_pretokens, "__defaults__", ("text", most))
        got = sorted(map(tuple, token_counts.count_tokens(docs(odd_rows), PATH).collect()), key=lambda r: (r[0] is None, str(r)))
        assert got == want


def test_frequent_pretokens_are_bounded_and_right(spark, corpus, docs):
    given = docs([(i, t, None) for i, t in corpus])
    found = token_counts.frequent_pretokens(given, PATH, most=50)
    assert len(found) == 50 and " the" in found
    assert all(n == len(ids_of(k)) for k, n in found.items())

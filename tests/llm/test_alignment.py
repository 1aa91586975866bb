"""Token alignment against a brute-force version that goes through the bytes of each text."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimlens.llm import alignment, pretokens

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text, libraries):
    """(id, bytes) of both sides by the libraries alone; empty where one does not give the text back."""
    first, second = libraries
    chars = {c: b for b, c in enumerate_bytes()}
    a = [(i, bytes(chars[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    spaced = (" " + text).encode()
    if not text or any(b"".join(x for _, x in side) != spaced for side in (a, b)):
        return [], []
    return a, b


def enumerate_bytes():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 600))
    return [(b, chr(b) if b in plain else chr(next(rest))) for b in range(256)]


def brute(texts, libraries):
    rows, held, links_of = [], Counter(), []
    for text in texts:
        a, b = tokens(text or "", libraries)
        spans = []
        for side in (a, b):
            at, cut = 0, []
            for i, data in side:
                cut.append((i, at, at + len(data)))
                at += len(data)
            spans.append(cut)
        links = [(x, y) for x, s, e in spans[0] for y, u, v in spans[1] if s < v and u < e]
        both = sorted({e for _, _, e in spans[0]} & {v for _, _, v in spans[1]})
        groups, low = [], 0
        for high in both:
            groups.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < high) for side in spans))
            low = high
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        rows.append([len(a), len(b), len(groups), len(links), digest])
        links_of.append(links)
        held.update(set(links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [
        (*r[:4], sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), r[4])
        for r, links in zip(rows, links_of)
    ]


def texts_of(odd_rows):
    words = ["it's", "Ärger", "naïve", "12.5", "don't", "tokenizers", "  ", "\n", "漢字", "<|endoftext|>", "</s>", "x" * 30, "a▁b"]
    made = [" ".join(words[(i * k) % len(words)] for i in range(1, 30)) for k in range(1, 12)]
    return [t if t is None else t[:3000] for _, t, _ in odd_rows] + made + made[:3] + [" ", "  a ", "﻿x", "a\x00b", "▁"]


@pytest.mark.parametrize("frequent", [0, 40, 1 << 18])
def test_alignment(spark, libraries, odd_rows, frequent):
    texts = texts_of(odd_rows)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    held = alignment.stored(alignment.aligned(df, A, B), "aligned")
    found = {r.doc_id: r for r in alignment.with_pair_counts(held, frequent).collect()}
    assert len(found) == len(texts)
    for i, expected in enumerate(brute(texts, libraries)):
        assert (*(found[i][c] for c in NUMBERS), found[i].groups_sha256) == expected, texts[i]


def test_empty_clashing_and_null(spark):
    names = "row long, doc_id long, pair long, text string, n long"
    assert alignment.decide(spark.createDataFrame([], names), A, B).collect() == []
    df = spark.createDataFrame([(1, None, 2, "hello", 3), (1, None, 2, None, 3)], names)
    found = sorted(alignment.decide(df, A, B).collect(), key=lambda r: r.n_a)
    assert [tuple(r[c] for c in NUMBERS) for r in found][0] == (0, 0, 0, 0, 0, 0) and found[0].groups_sha256 == ""
    assert found[1].doc_id is None and found[1].n_a > 0


def test_hot_pairs_are_in_the_table(spark):
    """A third of all texts are one text: its pairs come back by the broadcast table, not by the join."""
    rows = [(i, "the same words again" if i % 3 == 0 else f"other {i} words") for i in range(3000)]
    held = alignment.stored(alignment.aligned(spark.createDataFrame(rows, "doc_id long, text string"), A, B), "aligned")
    counts = alignment.pair_counts(held)
    least = alignment.least_frequent(counts, 50)
    assert 0 < counts.where(F.col("n") >= least).count() <= 50
    assert counts.where(F.col("n") < least).agg(F.max("n")).first()[0] < 1000


def test_long_texts_are_cut_exactly(odd_rows, monkeypatch):
    whole = [t for _, t, _ in odd_rows if t] + ["  a   b", "a  ", "é " * 50, " \n b"]
    piece, word = pretokens.piece_encoder(B), pretokens.word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    expected = [piece.model.encode(t) for t in whole]
    words = [word.library.encode(t, add_special_tokens=False).ids for t in whole]
    for chunk in (7, 1000):
        monkeypatch.setattr(pretokens, "CHUNK", chunk)
        assert [piece.encode(t).tolist() for t in whole] == expected
        assert [word.encode(t).tolist() for t in whole] == words

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """A table of documents from (doc_id, text, source) rows."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, rare characters, control strings."""
    long = " ".join(f"word{i % 977} it's {i}" for i in range(40_000))
    shared = " ".join(f"Shared passage {i} says {i * i % 7919} times that it's here." for i in range(250))
    return [
        (1, None, None),
        (2, "", "a"),
        (None, "text without an id", "a"),
        (3, "text without an id", "b"),
        (4, "text without an id", "b"),
        (4, "text without an id", "b"),
        (5, long, "b"),
        (6, long + " end", "é"),
        (7, shared, "𐀀"),
        (8, "Before it. " * 50 + shared + " After it, don't stop <|endoftext|> here." * 30, "b"),
        (9, "Other words go first, " * 61 + shared, "b"),
        (10, "   \n\n \t  ", "b"),
        (11, "漢字と仮名" * 400, "b"),
        (12, "x" * 5000 + " " * 5000 + "y" * 5000, "b"),
        (13, "<|im_end|> </s>[INST] ok [/INST] <\\|x|>", "b"),
        (14, "one two three", "b"),
        (15, "One TWO three", "b"),
        (16, "É été 12.5 naïve ǅ ͸ \U0001f600 \x1c\x85\xa0end", "b"),
    ]

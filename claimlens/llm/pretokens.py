"""Encoders for a lower-case word tokenizer and for a sentencepiece model; ids are those of their libraries.

``WordEncoder``: BPE whose last character of a word carries an end mark, as a tokenizers file. With the mark written as a
character of its own, which merges first, the vocabulary is a table of ranks, from which tiktoken encodes a good deal faster.
Texts for which the two are not known to agree go to the tokenizers library as a whole.

``PieceEncoder``: the model's own encoder. Where none of its pieces holds a space after another character, no merge crosses the
start of a run of spaces: very long texts are cut there, so that the memory of one call is bounded.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import regex
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from claimlens.llm.tokenizer import LONG_SPACE, UNSETTLED, byte_of_char

# Characters encoded in one call.
CHUNK = 1_000_000

# Fixed value: the words of the lower-case word tokenizer. Only characters of settled classes reach it.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\x09-\x0D\x20\x85\xA0\p{L}\p{N}]+")

# The same for texts of ASCII characters in lower case.
ASCII_WORDS = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^a-z0-9\x09-\x0D\x20]+")

# Lower case depends on the place (sigma) or changes the number of characters (dotted I); the mark itself.
LEFT_TO_LIBRARY = re.compile("[Σİ\x80]|<\\|")
END, MARK = "</w>", "\x80"


def chunks(text: str) -> Iterator[str]:
    """The text in parts of some ``CHUNK`` characters, each cut before a space that follows another character."""
    start = 0
    while len(text) - start > CHUNK:
        cut = start + CHUNK
        while (cut := text.find(" ", cut)) > 0 and text[cut - 1] == " ":
            cut += 1
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def marked_ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes, the end mark as a character, to id + 1; the mark itself ranks first. None for other kinds of file."""
    model = spec["model"]
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    normalizers = (spec.get("normalizer") or {}).get("normalizers", [])
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    made = [vocab["".join(p).replace(END, "", 1) if p[0].endswith(END) else "".join(p)] for p in merges]
    known = (
        model.get("type") == "BPE"
        and model.get("end_of_word_suffix") == END
        and not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges"))
        and not model.get("continuing_subword_prefix")
        and [n["type"] for n in normalizers] == ["NFC", "Replace", "Lowercase"]
        and [s["type"] for s in splits] == ["Split", "ByteLevel"]
        and splits[0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
        and splits[0]["behavior"] == "Removed"
        and splits[0]["invert"]
        and made == sorted(set(made))
        and len(vocab) == len(made) + 512
        and min(made) == 512
    )
    if not known:
        return None
    chars, mark = byte_of_char(), MARK.encode()
    bytes_of = lambda t: bytes(chars[c] for c in t)
    ranks = {bytes_of(t[: -len(END)]) + mark if t.endswith(END) else bytes_of(t): i + 1 for t, i in vocab.items()}
    return {mark: 0, **ranks}


class WordEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            ranks = marked_ranks(json.load(file))
        self.path, self.fast = path, None
        if ranks is not None:
            self.fast = tiktoken.Encoding("words", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self) -> Tokenizer:
        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    def settled(self, text: str) -> bool:
        """Whether the fast way is known to agree with the library."""
        if self.fast is None or LEFT_TO_LIBRARY.search(text):
            return False
        return text.isascii() or not UNSETTLED.search(text) and unicodedata.is_normalized("NFC", text)

    def encode(self, text: str) -> np.ndarray:
        if not self.settled(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        found = [self.marked(c) for c in chunks(text)]
        return found[0] if len(found) == 1 else np.concatenate(found)

    def marked(self, text: str) -> np.ndarray:
        words = (ASCII_WORDS if text.isascii() else WORDS).findall(text.lower())
        words.append("")
        return np.array(self.fast.encode_ordinary(MARK.join(words)), np.uint32) - np.uint32(1)


class PieceEncoder:
    """``encode`` gives the model's ids; ``bytes_of`` the bytes of each id, a space for the word mark."""

    SPACE = "▁"

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(self.SPACE, " ").encode()
            for i, p in enumerate(names)
        ]
        inside = any(self.SPACE in p.lstrip(self.SPACE) for p in names)
        own_space = self.model.encode("a a") == 2 * self.model.encode("a")
        self.divisible = own_space and not inside

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= CHUNK or not self.divisible or self.SPACE in text:
            return np.array(self.model.encode(text, num_threads=1), np.uint32)
        first, *rest = chunks(text)
        # The model puts a space before what it is given: the one at which the text was cut. Of a space alone it makes nothing.
        runs = [self.model.encode(first, num_threads=1)]
        for part in rest:
            runs.append(self.model.encode(part[1:], num_threads=1) or [self.model.piece_to_id(self.SPACE)])
        return np.concatenate([np.array(r, np.uint32) for r in runs])


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One per Python worker and file."""
    return WordEncoder(path)


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)

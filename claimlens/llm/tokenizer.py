"""Byte-level BPE as the tokenizers library does it, from the library's own file.

Where a file is plain byte-level BPE (ids in merge order, no normalizer, special tokens matched as they stand), its
vocabulary is the same thing as a table of ranks, and ordinary texts are encoded by tiktoken from
that table, about five times as fast. Whatever could differ between the two libraries goes to the
tokenizers library itself: texts with characters outside a range whose Unicode classes are long settled, very
long runs of white space, and files of any other kind.
"""

from __future__ import annotations

import json
import re
from functools import cached_property, lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Fixed value: how byte-level BPE cuts a text before merging.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Characters outside this range may have other letter, number or space classes in another Unicode version.
UNSETTLED = re.compile("[^\\x00-ԧ‐-‧‰-⁞€™]")
LONG_SPACE = re.compile(r"\s{2000}")


@lru_cache(maxsize=1)
def byte_of_char() -> dict[str, int]:
    """The printable stand-ins for bytes: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def rank_table(spec: dict) -> dict[bytes, int] | None:
    """Token bytes to id, if the file is byte-level BPE whose ids follow its merges; else None."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    ordinary = (
        model.get("type") == "BPE"
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges"))
        and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
        and spec.get("normalizer") is None
        and spec.get("post_processor") is None
        and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not ordinary:
        return None
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab["".join(p)] for p in pairs]
    if made != sorted(set(made)) or len(vocab) != len(made) + 256:
        return None
    chars = byte_of_char()
    return {bytes(chars[c] for c in token): i for token, i in vocab.items() if token}


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path = path
        self.special = [t["content"] for t in spec["added_tokens"]]
        ranks = rank_table(spec)
        self.fast = self.bytes_of = None
        if ranks is not None:
            added = {t["content"]: t["id"] for t in spec["added_tokens"]}
            self.fast = tiktoken.Encoding("file", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens=added)
            self.bytes_of = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in added.items()}

    @cached_property
    def library(self) -> Tokenizer:
        """Loaded by the first text that needs it: it takes 30 MB of each worker."""
        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    @cached_property
    def plain_library(self) -> Tokenizer:
        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        library.encode_special_tokens = True
        return library

    def settled(self, text: str) -> bool:
        """Whether the fast way is known to agree with the library."""
        if self.fast is None or not text.isascii() and UNSETTLED.search(text):
            return False
        return len(text) < 2000 or LONG_SPACE.search(text) is None

    def encode(self, text: str) -> np.ndarray:
        if self.settled(text):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode_plain(self, text: str) -> np.ndarray:
        """As ``encode``, but the strings of special tokens in a text are ordinary text."""
        if self.settled(text):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.plain_library.encode(text, add_special_tokens=False).ids, np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        if self.bytes_of is None:
            return self.library.decode(ids.tolist(), skip_special_tokens=False)
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker and file."""
    return Encoder(path)

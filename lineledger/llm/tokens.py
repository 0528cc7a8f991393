"""Token ids of a byte-level BPE tokenizer file."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Fixed value: how byte-level BPE files of this kind split texts before merging.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = 0x0250  # below this code point both libraries have the same letters, digits and blanks


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in such files: itself if it prints, else the next sign from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Byte strings by rank, where ids are ranks and nothing but byte-level merging happens; else None."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and spec.get("normalizer") is None and before.get("type") == "ByteLevel"
    if not plain or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    signs, special = _byte_signs(), {t["content"] for t in spec.get("added_tokens", [])}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if any(vocab.get(t) != 256 + i for i, t in enumerate(merged)) or len(vocab) != 256 + len(merged):
        return None
    return {bytes(signs[c] for c in t): i for t, i in vocab.items()}


class Encoder:
    """Ids as the tokenizers library gives them without special tokens of its own.

    Texts of common letters go through a faster library with the same merges, which gives the same ids; texts with
    other signs or with the file's special strings go through the tokenizers library itself.
    """

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        self.exact = Tokenizer.from_str(spec)
        self.special = [t["content"] for t in parsed.get("added_tokens", [])]
        ranks = _ranks(parsed)
        self.fast = ranks and tiktoken.Encoding("file", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        common = self.fast and (text.isascii() or ord(max(text)) < _PLAIN)
        if common and not any(s in text for s in self.special):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(spec)

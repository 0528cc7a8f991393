"""Byte-level BPE by dynamic programming over prefixes, and back to text.

Merging gives every prefix of a word one last token, whatever follows it. A suffix automaton of the vocabulary tells
which tokens a prefix ends with; of these the last one is the one that merging would leave beside the last token of what
precedes it. So one pass stores a token per prefix, and the way back from the whole word gives its ids.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate, islice, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lineledger.llm.shared import map_batches

# Fixed value: how byte-level BPE files of this kind split texts into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NEVER = 2**62  # the rank of a merge that does not come
_REMEMBERED_WORDS = 300_000  # a worker keeps the ids of so many words
_REMEMBERED_LENGTH = 48  # of so many characters at most
_REMEMBERED_PAIRS = 500_000
_TOGETHER_LENGTH = 1000  # longer words are worked out one by one
_WORDS_AT_ONCE = 100_000
_CELLS_AT_ONCE = 2_000_000  # bytes of words that are worked out together


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in such files: itself if it prints, else the next sign from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class SuffixAutomaton:
    """All substrings of some byte strings; a state stands for strings that occur with the same continuations.

    The longest string of a state has its ``length``; its ``link`` is the state of the longest suffix of these strings
    that is not in the state itself. A string that was added is the longest one of its state.
    """

    def __init__(self) -> None:
        self.steps: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]

    def _state(self, length: int, link: int, steps: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.steps.append(steps)
        return len(self.length) - 1

    def _split(self, state: int, sign: int, target: int) -> int:
        """A state of its own for the strings of ``target`` that are no longer than one sign more than ``state``'s."""
        shorter = self._state(self.length[state] + 1, self.link[target], dict(self.steps[target]))
        self.link[target] = shorter
        while state >= 0 and self.steps[state].get(sign) == target:
            self.steps[state][sign] = shorter
            state = self.link[state]
        return shorter

    def _reached(self, state: int, sign: int) -> int:
        target = self.steps[state][sign]
        return target if self.length[target] == self.length[state] + 1 else self._split(state, sign, target)

    def add(self, string: bytes) -> int:
        """Adds a string with all its substrings; returns its state."""
        state = 0
        for sign in string:
            if sign in self.steps[state]:
                state = self._reached(state, sign)
                continue
            new, above = self._state(self.length[state] + 1, 0, {}), state
            while above >= 0 and sign not in self.steps[above]:
                self.steps[above][sign] = new
                above = self.link[above]
            if above >= 0:
                self.link[new] = self._reached(above, sign)
            state = new
        return state


@dataclass(frozen=True)
class Merges:
    """Which tokens a merge makes, in the order of merges, and which token leaves which pair alone."""

    pairs: dict[tuple[int, int], int]  # rank of the merge of two tokens
    rank: dict[int, int]  # of the merge that makes a token; -1 for single bytes
    left: dict[int, int]
    right: dict[int, int]

    def apart(self, a: int, b: int, before: int = _NEVER) -> bool:
        """Whether the texts of ``a`` and ``b`` side by side become these two tokens, up to merge ``before``.

        Runs the merges backwards: the token made last is taken apart, and what then lies at the border must not
        have been merged before. Of equal merges the leftmost comes first, so that the right one is taken apart first.
        """
        pairs, rank = self.pairs, self.rank
        while True:
            if pairs.get((a, b), _NEVER) < before:
                return False
            if rank[a] > rank[b]:
                before, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                before, b = rank[b] + 1, self.left[b]
            else:
                return True


def merges_of(vocab: dict[str, int], merged: list[tuple[str, str]]) -> Merges:
    """Tokens that merging can make; a vocabulary entry that it can't is not among ``rank``."""
    signs = byte_signs()
    if any(s not in vocab for s in signs):
        raise ValueError("byte-level merging needs a token for every byte")
    pairs = {(vocab[a], vocab[b]): i for i, (a, b) in reversed(list(enumerate(merged)))}
    made = Merges(pairs, {vocab[s]: -1 for s in signs}, {}, {})
    for i, (a, b) in enumerate(merged):
        left, right, token = vocab[a], vocab[b], vocab[a + b]
        if pairs[left, right] == i and token not in made.rank and left in made.rank and right in made.rank:
            if made.apart(left, right, i):
                made.rank[token], made.left[token], made.right[token] = i, left, right
    if any(made.rank.get(part, -1) >= i for pair, i in pairs.items() for part in pair):
        raise ValueError("a merge comes before the merges that make its parts")
    return made


def _sorted(entries: Iterable[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    keys, values = (np.array(side, np.int64) for side in zip(*entries)) if (entries := list(entries)) else ([], [])
    order = np.argsort(keys)
    return np.asarray(keys, np.int64)[order], np.asarray(values, np.int64)[order]


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted key among sorted ones, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass(frozen=True, eq=False)
class Tables:
    """A tokenizer file as the tables that encoding and decoding need; their size is the vocabulary's."""

    spec: str = field(repr=False)
    merges: Merges = field(repr=False)
    text: list[bytes | None]  # of each id
    special: dict[str, int]
    steps: tuple[np.ndarray, np.ndarray]  # state * 256 + byte, sorted, and the state it leads to
    length: np.ndarray
    link: np.ndarray
    longest: np.ndarray  # of each state: the longest token that its longest string ends with
    shorter: np.ndarray  # of each token: the longest other token that it ends with

    @property
    def digest(self) -> str:
        return hashlib.sha256(self.spec.encode()).hexdigest()

    def __hash__(self) -> int:
        return hash(self.digest)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Tables) and self.digest == other.digest


def tables(spec: str) -> Tables:
    """Reads the content of a tokenizer file of plain byte-level BPE; any other kind of file is refused."""
    parsed = json.loads(spec)
    model, before, decoder = parsed["model"], parsed.get("pre_tokenizer") or {}, parsed.get("decoder") or {}
    plain = model.get("type") == "BPE" and parsed.get("normalizer") is None
    plain &= before.get("type") == decoder.get("type") == "ByteLevel"
    plain &= not before.get("add_prefix_space") and before.get("use_regex", True)
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    plain &= not any(model.get(k) for k in odd)
    added = parsed.get("added_tokens", [])
    plain &= not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if not plain:
        raise ValueError("not a file of plain byte-level BPE")
    signs = byte_signs()
    merged = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    vocab = model["vocab"]
    special = {t["content"]: vocab.get(t["content"], t["id"]) for t in added}
    made = merges_of(vocab, merged)

    text: list[bytes | None] = [None] * (max([*vocab.values(), *special.values()]) + 1)
    for token, i in (vocab | special).items():
        known = all(s in signs for s in token)
        text[i] = bytes(signs[s] for s in token) if known else token.encode()
    automaton, at = SuffixAutomaton(), {}
    for token in sorted(made.rank):
        at[automaton.add(text[token])] = token
    states = len(automaton.length)
    by_length = sorted(range(1, states), key=automaton.length.__getitem__)
    longest, shorter = np.full(states, -1, np.int32), np.full(len(text), -1, np.int32)
    for state in by_length:
        rest = int(longest[automaton.link[state]])
        longest[state] = at.get(state, rest)
        if state in at:
            shorter[at[state]] = rest
    steps = _sorted((state << 8 | sign, to) for state in range(states) for sign, to in automaton.steps[state].items())
    return Tables(
        spec, made, text, special, steps, np.array(automaton.length, np.int32), np.array(automaton.link, np.int32), longest, shorter
    )


class _Kinds(dict):
    """A usual sign of the same kind for each code point: letter, digit, blank or other, as the library sees it."""

    def __init__(self, spec: str):
        super().__init__({c: chr(c) for c in [9, 10, 13, *range(0x20, 0x7F)]})
        self.split = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str

    def __missing__(self, code: int) -> str:
        kinds = {"a": "a", "1": "1", "!": "!"}  # one piece with a sign of the same kind, two with any other
        sign = next((k for k in kinds if len(self.split(k + chr(code))) == 1), "\t")
        self[code] = sign
        return sign


class _Pairs:
    """:meth:`Merges.apart` for many pairs at once, with a table of recent answers."""

    SLOTS, MIX = 2**20, 0x1E3779B97F4A7C15  # any odd number that spreads pairs over the slots

    def __init__(self, merges: Merges, ids: int):
        self.ids = ids
        self.keys, self.merged = _sorted((a * ids + b, rank) for (a, b), rank in merges.pairs.items())
        self.rank, self.left, self.right = (np.full(ids, -1) for _ in range(3))
        for into, values in ((self.rank, merges.rank), (self.left, merges.left), (self.right, merges.right)):
            into[list(values)] = list(values.values())
        self.answers = np.full(self.SLOTS, -1)  # a pair and, in the last bit, its answer

    def _work_out(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        good, before, open_ = np.ones(len(a), bool), np.full(len(a), _NEVER), np.arange(len(a))
        a, b = a.copy(), b.copy()
        while len(open_):
            x, y = a[open_], b[open_]
            at, merged = _found(self.keys, x * self.ids + y)
            joined = merged & (self.merged[at] < before[open_])
            good[open_[joined]] = False
            rx, ry = self.rank[x], self.rank[y]
            left, right = ~joined & (rx > ry), ~joined & (rx <= ry) & (ry >= 0)
            before[open_[left]], a[open_[left]] = rx[left], self.right[x[left]]
            before[open_[right]], b[open_[right]] = ry[right] + 1, self.left[y[right]]
            open_ = open_[left | right]
        return good

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.ids + b
        slot = key * self.MIX >> 40 & self.SLOTS - 1
        kept = self.answers[slot]
        good, new = kept & 1 == 1, np.flatnonzero(kept >> 1 != key)
        if len(new):
            good[new] = self._work_out(a[new], b[new])
            self.answers[slot[new]] = key[new] << 1 | good[new]
        return good


class Encoder(dict):
    """Ids by word, as bytes of 32-bit numbers. Memory is bounded: so many words are remembered, and no long ones.

    Words that are not known yet are worked out together, position by position; very long words one by one.
    """

    def __init__(self, tables: Tables):
        super().__init__()
        self.tables = tables
        self.sizes = np.array([len(t or b"") for t in tables.text])
        self.pairs = _Pairs(tables.merges, len(tables.text))
        self.kinds = _Kinds(tables.spec)
        self.words = regex.compile(WORDS)
        self.usual = regex.compile(r"[\t\n\r\x20-\x7E]*").fullmatch
        longest_first = sorted(tables.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.single: dict | None = None  # what a long word needs, if there is one

    def __missing__(self, word: str) -> bytes:
        return np.array(self.ids(word.encode()), np.int32).tobytes()

    def last_tokens(self, word: bytes) -> array:
        """The last token of each prefix of a single word, from one byte on."""
        t = self.tables
        if self.single is None:
            steps = dict(zip(*(side.tolist() for side in t.steps)))
            self.single = {"steps": steps, "known": {}, "sizes": self.sizes.tolist()}
        steps, known, sizes, shorter = self.single["steps"], self.single["known"], self.single["sizes"], t.shorter
        length, link, longest = t.length, t.link, t.longest
        last = array("i", bytes(4 * len(word)))
        state = matched = 0  # the longest end of the prefix that the automaton knows
        for at, sign in enumerate(word):
            key = state << 8 | sign
            while key not in steps:
                state = int(link[state])
                matched = length[state]
                key = state << 8 | sign
            state, matched = steps[key], matched + 1
            token = int(longest[state if matched == length[state] else link[state]])
            while (start := at - sizes[token]) >= 0:
                pair = last[start], token
                if pair not in known:
                    if len(known) >= _REMEMBERED_PAIRS:
                        known.clear()
                    known[pair] = t.merges.apart(*pair)
                if known[pair]:
                    break
                token = int(shorter[token])
            last[at] = token
        return last

    def ids(self, word: bytes) -> list[int]:
        last, at, out = self.last_tokens(word), len(word), []
        while at:
            out.append(last[at - 1])
            at -= self.single["sizes"][out[-1]]
        out.reverse()
        return out

    def learn(self, words: list[str]) -> None:
        """Works out many words together: one step of the automaton, and one token each, per position."""
        coded = sorted(((w.encode(), w) for w in words), key=lambda pair: -len(pair[0]))
        while coded:
            count = max(1, _CELLS_AT_ONCE // max(1, len(coded[0][0])))
            self._learn(coded[:count])
            coded = coded[count:]

    def _learn(self, coded: list[tuple[bytes, str]]) -> None:
        t, sizes = self.tables, np.array([len(b) for b, _ in coded])
        grid = np.zeros((sizes[0], len(coded)), np.int64)  # the longest word comes first
        columns = np.repeat(np.arange(len(coded)), sizes)
        grid[np.arange(len(columns)) - np.repeat(np.cumsum(sizes) - sizes, sizes), columns] = np.frombuffer(
            b"".join(b for b, _ in coded), np.uint8
        )
        last = np.zeros(grid.shape, np.int32)
        state, matched = np.zeros(len(coded), np.int64), np.zeros(len(coded), np.int64)
        for at in range(len(grid)):
            here = int(np.searchsorted(-sizes, -at))  # words that reach beyond this position
            state, matched, sign = state[:here], matched[:here], grid[at, :here]
            step, known = _found(t.steps[0], state << 8 | sign)
            lost = np.flatnonzero(~known)
            while len(lost):
                state[lost] = t.link[state[lost]]
                matched[lost] = t.length[state[lost]]
                step[lost], known = _found(t.steps[0], state[lost] << 8 | sign[lost])
                lost = lost[~known]
            state, matched = t.steps[1][step], matched + 1
            token = t.longest[np.where(matched == t.length[state], state, t.link[state])]
            open_ = np.flatnonzero(at >= self.sizes[token])
            while len(open_):
                start = at - self.sizes[token[open_]]
                fits = self.pairs.apart(last[start, open_].astype(np.int64), token[open_].astype(np.int64))
                open_ = open_[~fits]
                token[open_] = t.shorter[token[open_]]
                open_ = open_[at >= self.sizes[token[open_]]]
            last[at, :here] = token
        found, at, rows = [], sizes.copy(), np.arange(len(coded))
        while len(rows):
            token = last[at[rows] - 1, rows]
            found.append((rows, token))
            at[rows] -= self.sizes[token]
            rows = rows[at[rows] > 0]
        rows, tokens = (np.concatenate(side)[::-1] for side in zip(*found))
        order = np.argsort(rows, kind="stable")
        ids, ends = tokens[order].tobytes(), 4 * np.cumsum(np.bincount(rows, minlength=len(coded)))
        begin = 0
        for (_, word), end in zip(coded, ends.tolist()):
            self[word] = ids[begin:end]
            begin = end

    def _split(self, text: str) -> Iterator[list[str]]:
        """The words of a text without special strings, in lists of a bounded length."""
        usual = self.usual(text)
        shown = text if usual else text.translate(self.kinds)
        if len(text) <= _WORDS_AT_ONCE:
            words = self.words.findall(shown)
        else:
            words = (found.group() for found in self.words.finditer(shown))
        at = 0
        for part in iter(lambda words=iter(words): list(islice(words, _WORDS_AT_ONCE)), []):
            if not usual:
                ends = list(accumulate(map(len, part), initial=at))
                part, at = [text[i:j] for i, j in pairwise(ends)], ends[-1]
            yield part

    def _parts(self, text: str) -> Iterator[list[str] | bytes]:
        """Lists of words, and the ids of special strings between them."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            yield from self._split(text[at : found.start()])
            yield np.array([self.tables.special[found.group()]], np.int32).tobytes()
            at = found.end()
        yield from self._split(text[at:] if at else text)

    def __call__(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text; the file's special strings in it are their own tokens."""
        out: list[list[bytes]] = []
        waiting: list[tuple[list[bytes], list[str] | bytes]] = []
        size = 0
        for text in texts:
            out.append([])
            for part in self._parts(text):
                waiting.append((out[-1], part))
                size += len(part)
                if size >= _WORDS_AT_ONCE:
                    self._write(waiting)
                    waiting, size = [], 0
        self._write(waiting)
        return [np.frombuffer(b"".join(ids), np.int32) for ids in out]

    def _write(self, waiting: list[tuple[list[bytes], list[str] | bytes]]) -> None:
        words = {w for _, part in waiting if isinstance(part, list) for w in part if len(w) <= _TOGETHER_LENGTH}
        if len(self) + len(words) > _REMEMBERED_WORDS:
            self.clear()
        new = [w for w in words if w not in self]
        self.learn(new)
        for ids, part in waiting:
            ids.append(part if isinstance(part, bytes) else b"".join(map(self.__getitem__, part)))
        for word in new:
            if len(word) > _REMEMBERED_LENGTH:
                del self[word]


@lru_cache(maxsize=2)
def encoder(tables: Tables) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(tables)


def id_lists(values: Sequence[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)])
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def _carried(df: DataFrame, carried: tuple[Column, ...], **columns: Column) -> tuple[DataFrame, str]:
    rows = df.select(F.struct(*carried).alias("__row"), *(c.alias(name) for name, c in columns.items()))
    return rows, rows.schema["__row"].dataType.simpleString()


def encode(docs: DataFrame, tables: Tables, *carried: Column, text_col: str = "text") -> DataFrame:
    """``carried`` columns of each row with the ``ids`` of its whole text; null and empty texts have none.

    The ids are those of the tokenizers library without special tokens of its own. The tables are broadcast, their
    size is the vocabulary's; each task encodes its own rows and nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    rows, fields = _carried(docs, carried, __text=F.col(text_col).cast("string"))

    def batch(row, texts) -> Iterator[dict]:
        own = encoder(shared.value)
        yield {"__row": row, "ids": id_lists(own(t.as_py() or "" for t in texts))}

    found = map_batches(rows, {"__row": fields, "__text": "string"}, batch, f"__row {fields}, ids array<int>")
    return found.select("__row.*", "ids")


def decode(encoded: DataFrame, tables: Tables, *carried: Column, ids_col: str = "ids") -> DataFrame:
    """``carried`` columns of each row with the ``decoded`` text of its ids.

    Bytes that are no UTF-8 become U+FFFD. Null lists give empty texts; null ids and ids of no token give nothing.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(tables.text)
    rows, fields = _carried(encoded, carried, __ids=F.col(ids_col).cast("array<int>"))

    def batch(row, lists) -> Iterator[dict]:
        own = shared.value
        known = {i: t for i, t in enumerate(own) if t is not None} if None in own else None
        out = []
        for ids in lists:
            flat = ids.values
            flat = [] if flat is None else flat.drop_null().to_numpy()
            if known is None and (not len(flat) or 0 <= flat.min() <= flat.max() < len(own)):
                parts = map(own.__getitem__, flat.tolist() if len(flat) else [])
            else:
                parts = (own[i] or b"" for i in flat.tolist() if 0 <= i < len(own))
            out.append(b"".join(parts).decode("utf-8", "replace"))
        yield {"__row": row, "decoded": out}

    found = map_batches(rows, {"__row": fields, "__ids": "array<int>"}, batch, f"__row {fields}, decoded string")
    return found.select("__row.*", "decoded")

"""Token counts of a unigram tokenizer without its tokens: Viterbi that carries a score and a count."""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineledger.llm.shared import map_batches

SPACE = "▁"  # stands for a space in the vocabulary and begins every word
UNKNOWN_PENALTY = 10.0  # fixed value: how far an unknown character scores below the worst piece
_REMEMBERED = 500_000  # words whose counts a worker keeps
_LONGEST_REMEMBERED = 64  # code points; longer words are worked out each time


class Counter(dict):
    """Counts by word, without the mark that begins it; a word that is not known yet is worked out.

    Ties are resolved as the tokenizers library does for a unigram model: a position is reached from the earliest
    start among equal scores, an unknown character counts last, and neighbouring unknown characters are one token
    or, with byte pieces, one token per byte.
    """

    def __init__(self, vocabulary: tuple[tuple[str, float], ...], byte_fallback: bool):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.ring = max((len(p) for p, _ in vocabulary), default=1) + 1
        pieces = {p for p, _ in vocabulary}
        self.bytes = byte_fallback
        if byte_fallback and not all(f"<0x{b:02X}>" in pieces for b in range(256)):
            raise ValueError("byte fallback needs a piece for every byte")

    def __missing__(self, word: str) -> int:
        n = self.count(SPACE + word)
        if len(word) <= _LONGEST_REMEMBERED:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = n
        return n

    def count(self, word: str) -> int:
        """Pieces on the best path through ``word``; memory depends on the longest piece, not on the word."""
        ring = self.ring
        best, pieces, unknown = [0.0] * ring, [0] * ring, [False] * ring
        matches = self.automaton.iter(word)
        end, found = next(matches, (-1, None))
        for at, sign in enumerate(word):
            score, start, single = None, 0, False
            while end == at:  # the longest match comes first
                length, own = found
                reached = best[(at + 1 - length) % ring] + own
                if score is None or reached > score:
                    score, start = reached, at + 1 - length
                single |= length == 1
                end, found = next(matches, (-1, None))
            here, before = (at + 1) % ring, at % ring
            if not single and (score is None or best[before] + self.unknown > score):
                best[here], unknown[here] = best[before] + self.unknown, True
                if self.bytes:
                    pieces[here] = pieces[before] + len(sign.encode("utf-8", "surrogatepass"))
                else:
                    pieces[here] = pieces[before] + (not unknown[before])
            else:
                from_ = start % ring
                best[here], unknown[here], pieces[here] = score, False, pieces[from_] + 1
        return pieces[len(word) % ring]

    def of_text(self, text: str | None) -> int:
        """Tokens of a text; every space begins a word, and so does the text itself."""
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        words = text.split(" ")
        return sum(map(self.__getitem__, words[1:] if text[0] == " " else words))


@lru_cache(maxsize=2)
def counter(vocabulary: tuple[tuple[str, float], ...], byte_fallback: bool) -> Counter:
    """One counter per worker and vocabulary."""
    return Counter(vocabulary, byte_fallback)


def piece_vocabulary(file: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def count_tokens(
    docs: DataFrame, vocabulary: list[tuple[str, float]], *carried: Column, byte_fallback: bool = True, text_col: str = "text"
) -> DataFrame:
    """``carried`` columns of each row with ``n_tokens`` of its whole text; null and empty texts have none.

    The vocabulary, whose size is the tokenizer's and not the data's, is broadcast; each task counts its own rows
    and nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast((tuple(vocabulary), byte_fallback))
    rows = docs.select(F.col(text_col).cast("string").alias("__text"), F.struct(*carried).alias("__row"))
    fields = rows.schema["__row"].dataType.simpleString()

    def batch(texts, row):
        own = counter(*shared.value)
        yield {"__row": row, "n_tokens": np.fromiter((own.of_text(t.as_py()) for t in texts), np.int64, len(texts))}

    kinds = {"__text": "string", "__row": fields}
    return map_batches(rows, kinds, batch, f"__row {fields}, n_tokens bigint").select("__row.*", "n_tokens")

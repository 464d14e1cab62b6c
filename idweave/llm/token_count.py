"""Token counts under a unigram vocabulary, without making the tokens.

Method: count-only Viterbi. An Aho-Corasick automaton lists the vocabulary pieces that end at each
character; dynamic programming carries the best score and the number of pieces of the best path.
Ties go as in the public unigram tokenizers: a path replaces another only if it is strictly better, and
starts are tried from left to right, so of equal paths the one with the longer last piece stays. A
character without a piece of its own may also be taken as unknown, at the lowest score less 10; it
counts as its UTF-8 bytes with byte fallback, otherwise a run of unknown characters counts once.

Texts are cut where no piece can reach across (before a blank's mark, at line ends), so that the
count of a unit is found once and kept in a bounded memory of each worker. The cut changes no path.

Null and empty texts have 0 tokens and score 0. Rows are independent: repeated rows give repeated
results, an empty table an empty one, further columns stay as they are. Very long texts are counted whole, unit by unit.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Units whose counts a worker keeps; beyond it the memory starts anew.
MEMORY = 1 << 20
#: A vocabulary travels with the function, so its size is checked.
MAX_PIECES = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that may match text, with scores. ``prefix``: a blank is put before each text."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool = False
    prefix: bool = True

    def __post_init__(self) -> None:
        if not 0 < len(self.pieces) <= MAX_PIECES:
            raise ValueError(f"a vocabulary has 1 to {MAX_PIECES} pieces")


def load_vocabulary(path: str, as_unigram: bool = False) -> Vocabulary:
    """Reads a SentencePiece model (its normal and user-defined pieces with their scores) or a
    tokenizers JSON file with a unigram model.

    A model of another kind is refused. With ``as_unigram`` the pieces and scores of a SentencePiece model of another kind
    make a unigram vocabulary (the scores of a BPE model are its merge ranks): the counts are then those of that vocabulary, and
    not those of the model's own way of splitting."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model.get("type") != "Unigram":
            raise ValueError("not a unigram model")
        pieces = [(p, float(s)) for i, (p, s) in enumerate(model["vocab"]) if i != model.get("unk_id")]
        return Vocabulary(tuple(pieces), bool(model.get("byte_fallback")))
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.trainer_spec
    if spec.model_type != sentencepiece_model_pb2.TrainerSpec.UNIGRAM and not as_unigram:
        raise ValueError("not a unigram model")
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    pieces = [(p.piece, float(p.score)) for p in model.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
    return Vocabulary(tuple(pieces), spec.byte_fallback, model.normalizer_spec.add_dummy_prefix)


class Counter:
    """Counts pieces of texts; made once for each worker and vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.unknown = min(s for _, s in vocabulary.pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        # A piece may hold marks only in front, and no line end, for the cuts to be exact.
        self.by_word = not any(MARK in p.lstrip(MARK) for p, _ in vocabulary.pieces)
        self.by_line = self.by_word and vocabulary.byte_fallback and not any("\n" in p for p, _ in vocabulary.pieces)
        self.memory: dict[str, tuple[int, float]] = {}

    def viterbi(self, unit: str) -> tuple[int, float]:
        """Number of pieces and score of the best path."""
        n, unknown, fallback = len(unit), self.unknown, self.vocabulary.byte_fallback
        best, count, lone = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0

        def close(end: int, top: float | None, start: int, single: bool) -> None:
            if not single:
                score = best[end - 1] + unknown
                if top is None or score > top:
                    more = len(unit[end - 1].encode("utf-8", "surrogatepass")) if fallback else 1 - lone[end - 1]
                    best[end], count[end], lone[end] = score, count[end - 1] + more, True
                    return
            best[end], count[end] = top, count[start] + 1

        top, start, single = None, 0, False
        for at, (length, score) in self.automaton.iter(unit):
            end = at + 1
            while done + 1 < end:
                done += 1
                close(done, top, start, single)
                top, start, single = None, 0, False
            begin = end - length
            score += best[begin]
            if top is None or score > top or (score == top and begin < start):
                top, start = score, begin
            single = single or length == 1
        while done < n:
            done += 1
            close(done, top, start, single)
            top, start, single = None, 0, False
        return count[n], best[n]

    def units(self, text: str) -> Iterator[str]:
        head = MARK if self.vocabulary.prefix else ""
        if not self.by_word:
            yield head + text.replace(" ", MARK)
            return
        lines = text.split("\n") if self.by_line else [text]
        for i, line in enumerate(lines):
            line = (head if i == 0 else "\n") + line.replace(" ", MARK)
            words = line.split(MARK)
            if words[0]:
                yield words[0]
            marks = 0
            for word in words[1:]:
                marks += 1
                if word:
                    yield MARK * marks + word
                    marks = 0
            if marks:
                yield MARK * marks

    def __call__(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        memory, tokens, total = self.memory, 0, 0.0
        for unit in self.units(text):
            found = memory.get(unit)
            if found is None:
                found = self.viterbi(unit)
                if len(unit) <= 64:
                    if len(memory) >= MEMORY:
                        memory.clear()
                    memory[unit] = found
            tokens += found[0]
            total += found[1]
        return tokens, total


_COUNTERS: dict[Vocabulary, Counter] = {}


def counter(vocabulary: Vocabulary) -> Counter:
    if vocabulary not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[vocabulary] = Counter(vocabulary)
    return _COUNTERS[vocabulary]


def token_counts(text: Column, vocabulary: Vocabulary) -> Column:
    """A struct of ``n_tokens`` and ``score`` for each text."""

    @F.pandas_udf("n_tokens long, score double")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = counter(vocabulary)
        for part in texts:
            yield pd.DataFrame([of(t) for t in part], columns=["n_tokens", "score"])

    return count(text)


def with_token_counts(df: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "token_count") -> DataFrame:
    """Adds the struct column ``out``."""
    return df.withColumn(out, token_counts(F.col(text), vocabulary))

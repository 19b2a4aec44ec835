"""Token counts: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; the
dynamic programme carries only the best score and its number of pieces.  Tie rules are the
unigram tokenizer's: at each end, candidates count from the earliest start on, and only a
strictly better score replaces; a character that is no piece itself may be unknown, at the
lowest score less 10, and is then counted by its bytes (byte fallback).

No unigram model is among the public files, so the vocabulary and its scores are those of
the piece model that is; its scores are whole numbers, hence sums are exact, and the best
path of a text is made of the best paths between places that no piece spans.  Texts are cut
there (before each word mark, and around characters that no piece holds), and each distinct
stretch is worked out once per worker process (until its bounded cache is full).  Matches are
taken as the automaton finds them and states kept for the longest piece's length, so a
stretch without a cut, however long, takes no memory beside its characters.

White space is marked as the tokenizer's metaspace does: every space becomes a word mark and a text
that doesn't begin with one gets one.  Null and empty texts have no tokens.
"""

from __future__ import annotations

import functools
import re
from pathlib import Path

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from carepulse.llm import common as C

MARK, UNKNOWN_PENALTY = "▁", 10.0
#: Distinct stretches kept per worker process; the memory bound of the cache, not of the result.
CACHE = 400_000


def read_pieces(path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a model file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()))


class Counter:
    """Counts the pieces of texts under one vocabulary."""

    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        self.auto = ahocorasick.Automaton()
        for piece, score in pieces:
            self.auto.add_word(piece, (len(piece), float(score)))
        self.auto.make_automaton()
        self.states = 1 + max(len(piece) for piece, _ in pieces)
        if any(score != int(score) for _, score in pieces):
            raise ValueError("scores must be whole numbers for sums to be exact")
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.known = {c for piece, _ in pieces for c in piece}
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        # pieces of marks only may span marks; with any other mark inside, cuts before marks would be wrong
        if any(MARK in piece.lstrip(MARK) for piece, _ in pieces):
            raise ValueError("a piece has a word mark after another character")
        self.cache: dict[str, int] = {}
        inside = "".join(map(re.escape, sorted(self.known - {MARK})))
        # marks and what follows them; a stretch without a mark; a character that no piece holds
        self.stretch = re.compile(f"{MARK}+[{inside}]*|[{inside}]+|.", re.S)

    def viterbi(self, s: str) -> int:
        """Pieces of the best path over ``s``."""
        n, size = len(s), min(self.states, len(s) + 1)
        # the states before the last ``size`` places, by place modulo ``size``: no piece begins before them
        score, count = [0.0] * size, [0] * size
        matches = self.auto.iter(s)
        at, piece = next(matches, (n, None))
        for end in range(n):
            best, many, here = None, 0, []
            while at == end:
                here.append(piece)
                at, piece = next(matches, (n, None))
            if len(here) > 1:
                here.sort(reverse=True)
            for length, worth in here:
                start = (end + 1 - length) % size
                if best is None or worth + score[start] > best:
                    best, many = worth + score[start], count[start] + 1
            if s[end] not in self.single and (best is None or self.unknown + score[end % size] > best):
                best, many = self.unknown + score[end % size], count[end % size] + len(s[end].encode("utf-8", "surrogatepass"))
            score[(end + 1) % size], count[(end + 1) % size] = best, many
        return count[n % size]

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        if text[0] != MARK:
            text = MARK + text
        cache, total = self.cache, 0
        for found in self.stretch.finditer(text):
            s = found[0]
            n = cache.get(s)
            if n is None:
                if len(cache) >= CACHE:
                    cache.clear()
                n = self.viterbi(s)
                if len(s) <= 64:
                    cache[s] = n
            total += n
        return total


@functools.lru_cache(maxsize=1)
def counter_of(pieces: tuple[tuple[str, float], ...]) -> Counter:
    """One counter, with its cache, serves all tasks of a worker process."""
    return Counter(pieces)


def token_counts(docs: DataFrame, model_path: str, carry: list[str] | None = None) -> DataFrame:
    """Every document with ``n_tokens`` under the vocabulary of ``model_path``; no shuffle."""
    if Path(model_path).stat().st_size > 64 << 20:
        raise ValueError("vocabulary file over 64 MB")
    sent = docs.sparkSession.sparkContext.broadcast(read_pieces(model_path))

    def work():
        counter = counter_of(sent.value)

        def f(texts):
            some = texts.to_pylist()
            return [pa.array([len(t) for t in some], pa.int64()), pa.array([counter(t) for t in some], pa.int64())]
        return f

    return C.map_texts(docs, "n_chars long, n_tokens long", work, ["doc_id"] if carry is None else carry)

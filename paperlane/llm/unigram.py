"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton lists every piece of the vocabulary that ends at each character; dynamic
programming carries the best score up to there and the number of its pieces. The rules are those of
the unigram tokenizers: the higher sum of scores wins; of equal sums the one whose last piece is
longer; a character that is no piece of its own may stand as unknown, at ten below the lowest score,
after all pieces, and counts as its UTF-8 bytes if the vocabulary has byte pieces, else a run of
unknown characters counts as one.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence

import ahocorasick
from pyspark.sql import DataFrame

from paperlane.llm.tasks import map_texts

SPACE = "▁"
UNKNOWN_BELOW = 10.0
REMEMBERED, LONGEST_REMEMBERED = 400_000, 64
NEVER = float("-inf")


class UnigramCounter:
    """Best score and number of tokens of texts."""

    def __init__(self, pieces: dict[str, float], byte_pieces: bool):
        self.byte_pieces = byte_pieces
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values()) - UNKNOWN_BELOW
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        # no piece crosses from a letter to a space sign: words can be counted on their own
        crossing = re.compile(f"[^{SPACE}]{SPACE}")
        self.parts = None if any(map(crossing.search, pieces)) else re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.place: dict[str, int] = {}
        self.scores: list[float] = []
        self.counts: list[int] = []

    def forget(self) -> None:
        """Free the memory of what was learned about words."""
        self.place, self.scores, self.counts = {}, [], []

    def best(self, text: str) -> tuple[float, int]:
        """Best score and its number of tokens."""
        n = len(text)
        score, count = [NEVER] * (n + 1), [0] * (n + 1)
        score[0] = 0.0
        if self.single.issuperset(text):
            # at each end the longest piece comes first
            for end, (length, value) in self.automaton.iter(text):
                value += score[end + 1 - length]
                if value > score[end + 1]:
                    score[end + 1] = value
                    count[end + 1] = count[end + 1 - length] + 1
            return score[n], count[n]

        unknown_last = [False] * (n + 1)

        def stand_alone(end: int) -> None:
            """The character before ``end`` as an unknown one."""
            sign = text[end - 1]
            value = score[end - 1] + self.unknown
            if sign not in self.single and value > score[end]:
                fused = unknown_last[end - 1] and not self.byte_pieces
                more = len(sign.encode("utf-8", "surrogatepass")) if self.byte_pieces else int(not fused)
                score[end], count[end], unknown_last[end] = value, count[end - 1] + more, True

        done = 0
        for end, (length, value) in self.automaton.iter(text):
            # pieces come by their ends: earlier ends are settled now
            while done < end:
                done += 1
                stand_alone(done)
            value += score[end + 1 - length]
            if value > score[end + 1]:
                score[end + 1], count[end + 1] = value, count[end + 1 - length] + 1
        while done < n:
            done += 1
            stand_alone(done)
        return score[n], count[n]

    def __call__(self, text: str) -> tuple[float, int]:
        """Best score and number of tokens of a whole text, spaces shown as a sign that also leads."""
        shown = text.replace(" ", SPACE)
        if not shown:
            return 0.0, 0
        if shown[0] != SPACE:
            shown = SPACE + shown
        if self.parts is None:
            return self.best(shown)
        words = self.parts.findall(shown)
        new = set(words).difference(self.place)
        if len(self.place) + len(new) > REMEMBERED:
            self.place.clear()
            self.scores.clear()
            self.counts.clear()
            new = set(words)
        for word in new:
            value, n = self.best(word)
            self.place[word] = len(self.scores)
            self.scores.append(value)
            self.counts.append(n)
        total_score = total = 0
        for i in map(self.place.__getitem__, words):
            total_score += self.scores[i]
            total += self.counts[i]
        # a very long word is not worth its memory
        for word in [w for w in new if len(w) > LONGEST_REMEMBERED]:
            del self.place[word]
        return float(total_score), total


def read_pieces(path: str) -> tuple[dict[str, float], bool]:
    """Pieces and scores of a sentencepiece file, and whether it has byte pieces.

    Control, unknown and byte pieces match no text and are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return {model.id_to_piece(i): model.get_score(i) for i in plain}, any(map(model.is_byte, ids))


def counter_of(path: str) -> UnigramCounter:
    """The counter of a file, kept as long as the Python worker lives, without the words it knows."""
    kept = sys.__dict__.setdefault("_paperlane_counters", {})
    if path not in kept:
        kept[path] = UnigramCounter(*read_pieces(path))
    return kept[path]


def token_counts(
    df: DataFrame, text: str, vocabulary: str, count: str = "n_tokens", score: str = "best_score",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the number of tokens and the best score of each whole text.

    A missing or empty text has none and scores 0. Columns of the same names are replaced; rows are
    handled one by one, so repeated rows stay. ``vocabulary`` is a path that exists on every executor.
    """

    def start():
        counter = counter_of(vocabulary)
        return lambda texts: list(zip(*((n, x) for x, n in map(counter, texts)), strict=True))

    return map_texts(df, text, {count: "bigint", score: "double"}, start, keep, lambda: counter_of(vocabulary).forget())

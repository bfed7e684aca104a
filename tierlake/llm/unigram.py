"""A unigram vocabulary with exact scores, and its Viterbi segmentation.

Pieces come from a public vocabulary file whose order is known: rank r scores
``-round(32 ln(r + 2))``. Whole numbers make every sum exact, so that a segmentation, ties included,
does not depend on where a text is cut. Rules are those of the public unigram encoder: a character
without a piece of its own costs ten more than the worst piece and is spelled in byte pieces; of
equally good ways to reach a position, the one whose last piece starts first is taken.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import ahocorasick

SPACE = "▁"
UNKNOWN_PENALTY = 10
NEVER = -(1 << 60)
#: Public vocabulary file; any path that the driver can read.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def rank_score(rank: int) -> int:
    return -round(32 * math.log(rank + 2))


@dataclass
class Vocabulary:
    pieces: dict[str, tuple[int, int]]  # piece -> (id, score)
    byte_ids: list[int]
    spelled: list[bytes]  # id -> what it stands for

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown = min((s for _, s in self.pieces.values()), default=0) - UNKNOWN_PENALTY
        self.singles = frozenset(p for p in self.pieces if len(p) == 1)
        self.cuts_at_space = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.cuts_at_line = self.cuts_at_space and not any("\n" in p for p in self.pieces if len(p) > 1)
        inner = SPACE + "\n" if self.cuts_at_line else SPACE
        extra = "|\n" if self.cuts_at_line else ""
        self.units = re.compile(f"{SPACE}*[^{inner}]+|{SPACE}+{extra}") if self.cuts_at_space else re.compile("(?s).+")

    def is_cut(self, text: str, at: int) -> bool:
        """Whether no piece can cross this position."""
        if not self.cuts_at_space or not 0 < at < len(text):
            return False
        if self.cuts_at_line and "\n" in (text[at], text[at - 1]):
            return True
        return text[at] == SPACE and text[at - 1] != SPACE


def load(path: str = VOCABULARY) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    byte_ids, spelled, normal = [0] * 256, [b""] * size, []
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            spelled[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            normal.append((-model.get_score(i), i, piece))
            spelled[i] = piece.replace(SPACE, " ").encode()
    pieces = {piece: (i, rank_score(rank)) for rank, (_, i, piece) in enumerate(sorted(normal))}
    return Vocabulary(pieces, byte_ids, spelled)


def normalised(text: str) -> str:
    """Spaces become the space sign, and a text starts with one; nothing else changes."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def forward(vocabulary: Vocabulary, text: str, entry: list[int], length: int) -> tuple[list[int], list[int]]:
    """Best scores and last starts for every position reached by pieces that start before ``length``.

    ``entry[s]`` is the score of arriving at position s from before the text; its start is -1.
    """
    longest, get, unknown = vocabulary.longest, vocabulary.pieces.get, vocabulary.unknown
    total = len(text)
    best = [NEVER] * (total + 1)
    start = [-2] * (total + 1)
    for s, value in enumerate(entry[: total + 1]):
        if value > NEVER:
            best[s], start[s] = value, -1
    for i in range(length):
        here = best[i]
        if here == NEVER:
            continue
        for j in range(i + 1, min(i + longest, total) + 1):
            found = get(text[i:j])
            if found is not None:
                score = here + found[1]
                if score > best[j]:
                    best[j], start[j] = score, i
        if text[i] not in vocabulary.pieces and here + unknown > best[i + 1]:
            best[i + 1], start[i + 1] = here + unknown, i
    return best, start


def piece_ids(vocabulary: Vocabulary, piece: str) -> list[int]:
    found = vocabulary.pieces.get(piece)
    if found is not None:
        return [found[0]]
    return [vocabulary.byte_ids[b] for b in piece.encode("utf-8", "replace")]


def backtrace(vocabulary: Vocabulary, text: str, start: list[int], at: int) -> tuple[list[int], int]:
    """Ids of the pieces from the entry to ``at``, and the position at which they begin."""
    pieces = []
    while start[at] >= 0:
        pieces.append(text[start[at] : at])
        at = start[at]
    return [i for piece in reversed(pieces) for i in piece_ids(vocabulary, piece)], at


def automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    """Finds every piece in a text; a match tells the piece's length, score and id."""
    found = ahocorasick.Automaton()
    for piece, (number, score) in vocabulary.pieces.items():
        found.add_word(piece, (len(piece), score, number))
    found.make_automaton()
    return found


def segment(vocabulary: Vocabulary, matcher: ahocorasick.Automaton, unit: str) -> tuple[list[int], int]:
    """Ids and score of the best segmentation. Matches come by end, longest (earliest start) first."""
    if not vocabulary.singles.issuperset(unit):
        return _segment_spelled(vocabulary, matcher, unit)
    # Every character is a piece, so every position is reached by a match.
    at = len(unit)
    best, last = [0] + [NEVER] * at, [(0, 0, 0)] * (at + 1)
    for end, piece in matcher.iter(unit):
        end += 1
        total = best[end - piece[0]] + piece[1]
        if total > best[end]:
            best[end], last[end] = total, piece
    ids: list[int] = []
    while at:
        length, _, number = last[at]
        ids.append(number)
        at -= length
    ids.reverse()
    return ids, best[-1]


def _segment_spelled(vocabulary: Vocabulary, matcher: ahocorasick.Automaton, unit: str) -> tuple[list[int], int]:
    """As above, for units with characters that may have to be spelled in byte pieces."""
    best, last = [0], []
    unknown = vocabulary.unknown
    matches = iter(matcher.iter(unit))
    end, found = next(matches, (-1, None))
    for at in range(len(unit)):
        score, piece, own = NEVER, (1, -1), False
        while end == at:
            length, worth, number = found
            total = best[at + 1 - length] + worth
            if total > score:
                score, piece = total, (length, number)
            own |= length == 1
            end, found = next(matches, (-1, None))
        if not own and best[at] + unknown > score:
            score, piece = best[at] + unknown, (1, -1)
        best.append(score)
        last.append(piece)
    ids: list[int] = []
    at = len(unit)
    while at > 0:
        length, number = last[at - 1]
        if number >= 0:
            ids.append(number)
        else:
            ids.extend(vocabulary.byte_ids[b] for b in reversed(unit[at - 1].encode("utf-8", "replace")))
        at -= length
    ids.reverse()
    return ids, best[-1]


class Remembered(dict):
    """Results per unit, made when first met. Two generations of ``most`` units are kept, so that
    units in use stay and memory is bounded; units longer than ``longest`` are not kept."""

    def __init__(self, make, most: int = 60_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest
        self.older: dict = {}

    def __missing__(self, unit: str):
        value = self.older.pop(unit, None)
        if value is None:
            value = self.make(unit)
        if len(unit) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[unit] = value
        return value

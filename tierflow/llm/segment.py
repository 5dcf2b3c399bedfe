"""Pre-tokenization of many texts at once, as arrays of code points.

The two vocabularies cut text with the same kind of pattern: contractions,
runs of letters, numbers, or other signs, and white space. Which code point is
which is asked from the tokenizer's own pre-tokenizer, once a code point.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tierflow.llm.common import distinct_spans

LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
_APOSTROPHE = ord("'")
# The contractions both patterns name.
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


class Classes:
    """Code point classes, filled as code points come up; ``pieces`` counts a string's pieces."""

    def __init__(self, pieces: Callable[[str], int], single_numbers: bool):
        self._pieces, self._single = pieces, single_numbers
        self._table = np.zeros(0x110000, np.uint8)

    def _ask(self, c: str) -> int:
        if self._pieces(f"a{c}a") == 1:
            return LETTER
        if self._pieces(f"!{c}!") == 1:
            return OTHER
        if self._single:  # white space is dropped, a number stands alone
            return NUMBER if self._pieces(f"a{c}a") == 3 else SPACE
        return NUMBER if self._pieces(f"1{c}1") == 1 else SPACE

    def of(self, points: np.ndarray) -> np.ndarray:
        found = self._table[points]
        if len(found) and not found.min():
            for p in np.unique(points[found == 0]).tolist():
                # a lone surrogate cannot be asked for; the libraries never see one
                self._table[p] = OTHER if 0xD800 <= p < 0xE000 else self._ask(chr(p))
            found = self._table[points]
        return found


def code_points(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts as one string, its code points and the offsets of the texts."""
    joined = "".join(texts)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return joined, np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def cut(points: np.ndarray, offsets: np.ndarray, classes: Classes, keep_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces.

    With ``keep_space`` a space goes with the run after it and other white
    space makes pieces (all but the last of a run, then the last); without, it
    is dropped and every number is a piece.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes.of(points)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    run = edge[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    if keep_space:
        after_space = np.zeros(n, bool)
        after_space[1:] = (points[:-1] == 32) & ~edge[1:n]
        last = np.zeros(n, bool)  # the last of a white space run that something follows
        last[:-1] = (kind[:-1] == SPACE) & run[1:] & ~edge[1:n]
        start &= ~(after_space & (kind != SPACE))
        start |= last
    else:
        after_space = np.zeros(n, bool)
        start |= kind == NUMBER
    at = np.flatnonzero((points == _APOSTROPHE) & run & ~after_space)
    if len(at):
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        same = np.concatenate([edge[1:], np.ones(3, bool)])  # same[i]: nothing of the text follows i
        for letters in _CONTRACTIONS:
            hit = at[~same[at]]
            for i, c in enumerate(letters):
                hit = hit[(padded[hit + 1 + i] == ord(c)) & ~same[hit + i]]
            start[hit + 1] = False
            nxt = hit + 1 + len(letters)
            inside = nxt[nxt < n]
            inside = inside[(kind[inside] == LETTER) & ~edge[inside]]
            start[inside] = True
    begins = np.flatnonzero(start)
    ends = np.append(begins[1:], n)
    if not keep_space:
        word = kind[begins] != SPACE
        begins, ends = begins[word], ends[word]
    return begins, ends


class Pieces:
    """The pieces of some texts and which of them are equal."""

    def __init__(self, texts: list[str], classes: Classes, keep_space: bool):
        self.joined, points, offsets = code_points(texts)
        self.start, self.end = cut(points, offsets, classes, keep_space)
        #: number of pieces before each text
        self.first = np.searchsorted(self.start, offsets)
        # as narrow as the code points allow: more of them are compared at once
        top = points.max(initial=0)
        narrow = points.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)
        self._example, self.which = distinct_spans(narrow, self.start, self.end)

    def __len__(self) -> int:
        """How many distinct pieces there are."""
        return len(self._example)

    def distinct(self) -> list[str]:
        """The distinct pieces; ``which`` has each piece's place among them."""
        text = self.joined
        return [text[a:b] for a, b in zip(self.start[self._example].tolist(), self.end[self._example].tolist(), strict=True)]

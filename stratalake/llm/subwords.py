"""Hashed words and character n-grams of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Code points scanned at once; longer texts are scanned in several parts.
PART_CHARS = 1 << 18
BLANKS = " \t\n\v\f\r"
MIX = np.uint64(0x9E3779B97F4A7C15)


def parts(texts: list[str], size: int = PART_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Lists of (index of text, part of it) of at most ``size`` code points. A text that long at most is whole
    in one list. A longer one begins a list and is parted at blanks, or after ``size`` code points of one word;
    only its last part shares a list with later texts."""
    held, filled = [], 0
    for index, text in enumerate(texts):
        if held and filled + len(text) > size:
            yield held
            held, filled = [], 0
        at = 0
        while at < len(text):
            end = min(len(text), at + size)
            if end < len(text):
                blank = max(text.rfind(mark, at, end) for mark in BLANKS)
                if blank > at:
                    end = blank
            held.append((index, text[at:end]))
            filled += end - at
            at = end
            if at < len(text):
                yield held
                held, filled = [], 0
    if held:
        yield held


class Scan:
    """Words of the parts: ``doc`` (index of the text; ``first`` is that of the first part), hashes ``words``, ``lengths``; and of each
    n-gram size the hashes with the word they belong to. Blanks at a word's ends count as one
    boundary character, and an n-gram never crosses a blank."""

    def __init__(self, held: list[tuple[int, str]], sizes: tuple[int, ...]):
        text = " " + " ".join(part for _, part in held) + " "
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
        codes[blank] = 0
        first = ~blank
        first[1:] &= blank[:-1]
        self.first = held[0][0]
        starts = np.flatnonzero(first)
        of_char = np.cumsum(first) - 1
        ends = np.cumsum([len(part) + 1 for _, part in held])
        self.doc = np.array([index for index, _ in held])[np.searchsorted(ends, starts - 1, side="right")] if len(starts) else np.zeros(0, int)
        inside = np.flatnonzero(~blank)
        place = inside - starts[of_char[inside]] if len(starts) else inside
        self.lengths = np.bincount(of_char[inside], minlength=len(starts)) if len(starts) else np.zeros(0, int)
        power = np.cumprod(np.full(max(1, int(self.lengths.max(initial=1))), MIX | np.uint64(1)))
        self.words = self.mixed(np.add.reduceat((codes[inside] + np.uint64(1)) * power[place], np.cumsum(self.lengths) - self.lengths)) if len(starts) else np.zeros(0, np.uint64)
        self.grams = []
        rolled, valid = codes, ~blank
        whole = ~blank
        for size in range(2, max(sizes, default=1) + 1):
            rolled = rolled[:-1] * MIX + codes[size - 1 :]
            if size >= 3:
                # characters 1 .. size - 2 of the n-gram lie in a word
                valid = whole[1 : len(rolled) + 1] if size == 3 else valid[: len(rolled)] & whole[size - 2 : size - 2 + len(rolled)]
                if size in sizes:
                    at = np.flatnonzero(valid)
                    self.grams.append((self.mixed(rolled[at] + np.uint64(size)), of_char[at + 1]))

    @staticmethod
    def mixed(hashes: np.ndarray) -> np.ndarray:
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return hashes ^ (hashes >> np.uint64(32))

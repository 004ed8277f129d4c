"""Statistics of whole texts, shared by the quality classifier and the quality rules."""

from __future__ import annotations

import re
from string import ascii_uppercase

import numpy as np

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_chars", "n_lines", "n_distinct", "n_upper", "n_exclaim", "n_digits", "n_stops"]
#: n_distinct adds up the different words of blocks of so many words: over a whole text their share falls with length.
BLOCK = 256
SYMBOLS = b"#*$%&|<>"
#: UTF-8 of the capitals À-Ö and Ø-Þ.
ACCENTED = re.compile(rb"\xc3[\x80-\x96\x98-\x9e]")


def repeat_words(found: list[bytes], width: int = 8) -> int:
    """Words that lie in windows of ``width`` words (a power of two) found twice or more, the first one included.

    Windows are named exactly: a window of 2k words is the pair of the names of its halves.
    """
    if len(found) <= width:
        return 0
    known: dict[bytes, int] = {}
    names = np.array([known.setdefault(w, len(known)) for w in found], np.int64)
    if len(known) == len(found):
        return 0
    step = 1
    while step < width:
        pairs = names[:-step] * (int(names.max()) + 1) + names[step:]
        distinct, names = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        step *= 2
    again = np.flatnonzero(np.bincount(names)[names] > 1)
    marks = np.zeros(len(found) + 1, np.int64)
    np.add.at(marks, again, 1)
    np.add.at(marks, again + width, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def dup_lines(text: str) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier line)."""
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    return len(lines), len(lines) - len(set(lines))


def count(raw: bytes, some: bytes) -> int:
    """How many bytes of a text are among ``some`` ASCII characters."""
    return len(raw) - len(raw.translate(None, some))


def statistics(text: str | None) -> list[int]:
    """The values of BASE and MORE for a text; null counts as empty."""
    text = text or ""
    raw = text.encode()
    found = raw.split()
    lines, dups = dup_lines(text)
    return [
        len(found),
        len(text) - len(raw) + sum(map(len, found)),
        count(raw, SYMBOLS),
        dups,
        repeat_words(found),
        len(text),
        lines,
        sum(len(set(found[at : at + BLOCK])) for at in range(0, len(found), BLOCK)),
        count(raw, ascii_uppercase.encode()) + (0 if raw.isascii() else len(ACCENTED.findall(raw))),
        raw.count(b"!"),
        count(raw, b"0123456789"),
        count(raw, b".?"),
    ]


#: Ratios that hardly depend on a text's length.
RATIOS = ["symbols_per_word", "chars_per_word", "dup_line_share", "repeat_word_share", "distinct_share", "upper_share", "exclaims_per_word", "digits_per_char", "words_per_line", "words_per_stop"]


def ratios(s: np.ndarray) -> np.ndarray:
    """RATIOS of rows of statistics, in the same order."""
    n, c, sym, dup, rep, chars, lines, distinct, upper, exclaim, digits, stops = s.T.astype(float)
    w, one = np.maximum(n, 1), np.maximum(chars, 1)
    return np.stack([sym / w, c / w, dup / np.maximum(lines, 1), rep / w, distinct / w, upper / one, exclaim / w, digits / one, n / np.maximum(lines, 1), n / np.maximum(stops, 1)], 1)

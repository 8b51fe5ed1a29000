"""Hashes of the words of a text and of runs of words."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np

_SPAN = 1 << 16
_SLICE = 1 << 18
_BLANK = re.compile("[ \n]")
_MULTIPLIER = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(_SPAN)], np.uint64)
#: Scripts written without blanks between words: their characters are words.
_UNSPACED = (
    (0x0E00, 0x0EFF),  # Thai, Lao
    (0x1000, 0x109F),  # Myanmar
    (0x1780, 0x17FF),  # Khmer
    (0x1950, 0x19DF),  # Tai Le, New Tai Lue
    (0x1A20, 0x1AAF),  # Tai Tham
    (0x1B00, 0x1B7F),  # Balinese
    (0x3005, 0x3007),  # marks of ideographs
    (0x3021, 0x3029),
    (0x3031, 0x31BF),  # kana, Bopomofo (and Hangul jamo, see below)
    (0x31F0, 0x31FF),
    (0x3400, 0x4DBF),  # ideographs
    (0x4E00, 0x9FFF),
    (0xA000, 0xA48F),  # Yi
    (0xA980, 0xA9FF),  # Javanese, Myanmar
    (0xAA60, 0xAA7F),
    (0xF900, 0xFAFF),  # ideographs
    (0xFF66, 0xFF9F),  # kana of half width
    (0x16FE0, 0x18DFF),  # Tangut, Khitan
    (0x1AFF0, 0x1B2FF),  # kana, Nushu
    (0x20000, 0x323AF),  # ideographs
)
_HANGUL = range(0x3130, 0x3190)
_LAST = 0x323B0
_LETTER, _SINGLE, _MARK, _VISIBLE = 1, 2, 3, 4


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _kinds() -> np.ndarray:
    """What each code point is; those from `_LAST` on count as signs."""
    kinds = np.zeros(_LAST + 1, np.uint8)
    for code in range(_LAST):
        major = unicodedata.category(chr(code))[0]
        if major == "M":
            kinds[code] = _MARK
        elif major in "LN" or code == 95:
            kinds[code] = _LETTER
        elif code > 32 and not chr(code).isspace():
            kinds[code] = _VISIBLE
    for first, last in _UNSPACED:
        own = kinds[first : last + 1]
        own[own == _LETTER] = _SINGLE
    own = kinds[_HANGUL.start : _HANGUL.stop]
    own[own == _SINGLE] = _LETTER
    kinds[_LAST] = _VISIBLE
    return kinds


def word_hashes(text: str) -> np.ndarray:
    """One unsigned 64-bit hash per word of the lower-cased text, in order.

    Words are runs of Unicode letters, numbers, underscores and the marks on them;
    in scripts written without blanks each letter with its marks is a word. A text
    without any is taken as runs of visible characters. An empty or blank text has
    no words. A long text is worked through in slices that end at a blank, so that
    memory does not follow its length.
    """
    found = [_hashes(part, True) for part in _slices(text)]
    if not sum(map(len, found)):
        found = [_hashes(part, False) for part in _slices(text)]
    return found[0] if len(found) == 1 else np.concatenate(found)


def _slices(text: str) -> Iterator[str]:
    """The text in parts of about `_SLICE` characters, each from a blank on; a longer run without one is not cut."""
    start = 0
    while len(text) - start > _SLICE:
        blank = _BLANK.search(text, start + _SLICE)
        if blank is None:
            break
        yield text[start : blank.start()]
        start = blank.start()
    yield text[start:]


def _hashes(text: str, words: bool) -> np.ndarray:
    """Hashes of the words of a text, or of its runs of visible characters."""
    text = text.lower()
    plain = text.isascii()
    data = np.frombuffer(text.encode("ascii") if plain else text.encode("utf-32-le", "replace"), np.uint8 if plain else "<u4")
    kinds = _kinds()[data if plain else np.minimum(data, _LAST)]
    inside = (kinds > 0) & (kinds < _VISIBLE) if words else kinds > 0
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64)
    starts = np.diff(at, prepend=-2) > 1
    if not plain:
        own = kinds[at]
        single = own == _SINGLE
        if single.any():
            # The letter that each mark stands on; a letter after a single one starts a word as well.
            base = np.maximum.accumulate(np.where(own != _MARK, np.arange(len(at)), 0))
            starts |= single
            starts[1:] |= (own[1:] == _LETTER) & single[base[:-1]]
    first = np.flatnonzero(starts)  # of each word, in `at`
    lengths = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    weighted = (data[at].astype(np.uint64) + np.uint64(1)) * _POWERS[place & (_SPAN - 1)]
    return mix(np.add.reduceat(weighted, first) + lengths.astype(np.uint64) * np.uint64(_MULTIPLIER))


def shingle_hashes(text: str, words: int = 5) -> np.ndarray:
    """One hash per run of `words` words; a shorter text is one run of all it has."""
    found = word_hashes(text)
    n = min(words, len(found))
    out = np.full(max(1, len(found) - words + 1), n, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(_MULTIPLIER) + found[i : i + len(out)])
    return out


def weighted_shingles(text: str, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The different runs of a text, ascending, and how often each occurs."""
    return np.unique(shingle_hashes(text, words), return_counts=True)

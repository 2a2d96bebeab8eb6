"""Trigrams of many texts as numbers, by numpy inside a task.

Texts are in lower case. As in ``functions.text.letter_text``, what is not a letter
becomes one space between letters, and a space is put around each text. Which code
points are letters is given by ``letters``, a flag for each.
A trigram is one whole number made of its three code points. Texts of few different
characters, which is most, are counted and looked up by smaller numbers in arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from corpusprep.operators.points import CODE_POINTS

# Characters whose trigrams are held at once.
CHARACTERS = 1_000_000

_BITS = 21
# Trigrams of different characters that an array has places for.
PLACES = 4_000_000


def pack(gram: str) -> int:
    """The number of a trigram."""
    first, second, third = map(ord, gram)
    return first << 2 * _BITS | second << _BITS | third


def unpack(code: int) -> str:
    mask = (1 << _BITS) - 1
    return chr(code >> 2 * _BITS) + chr(code >> _BITS & mask) + chr(code & mask)


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHARACTERS`` characters together."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 2
        if size >= CHARACTERS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _padded(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single spaces of all texts, a space before and behind the letters of each, and the place behind each text."""
    chars = np.frombuffer("".join([f" {t} " for t in texts]).encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(t) + 2 for t in texts])
    letter = letters[chars]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[ends[:-1]] = kept[0] = True
    return np.where(letter, chars, 32)[kept].astype(np.int64), np.cumsum(kept)[ends - 1]


def _coded(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """The number at each character, whether a trigram of its text begins there, the place behind each text, the alphabet.

    With an alphabet numbers are made of places in it, otherwise of code points.
    """
    chars, ends = _padded(texts, letters)
    own = np.ones(len(chars), bool)
    own[ends - 1] = own[np.maximum(ends - 2, 0)] = False
    seen = np.zeros(CODE_POINTS, bool)
    seen[chars] = True
    alphabet = np.flatnonzero(seen)
    if len(alphabet) ** 3 > PLACES:
        return chars[:-2] << 2 * _BITS | chars[1:-1] << _BITS | chars[2:], own[:-2], ends, None
    places = np.zeros(CODE_POINTS, np.int64)
    places[alphabet] = np.arange(len(alphabet))
    chars = places[chars]
    return (chars[:-2] * len(alphabet) + chars[1:-1]) * len(alphabet) + chars[2:], own[:-2], ends, alphabet


def _unplaced(codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Numbers made of code points, in the same order, from numbers made of places."""
    n = len(alphabet)
    return alphabet[codes // (n * n)] << 2 * _BITS | alphabet[codes // n % n] << _BITS | alphabet[codes % n]


def _distinct(codes: np.ndarray, alphabet: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if alphabet is None:
        return np.unique(codes, return_counts=True)
    n = np.bincount(codes)
    found = np.flatnonzero(n)
    return found, n[found]


def counted(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of all texts and how often each occurs."""
    found = []
    for begin, end in slices(texts):
        codes, own, _, alphabet = _coded(texts[begin:end], letters)
        codes, n = _distinct(codes[own], alphabet)
        found.append((codes if alphabet is None else _unplaced(codes, alphabet), n))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, places = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
    totals = np.zeros(len(codes), np.int64)
    np.add.at(totals, places, np.concatenate([n for _, n in found]))
    return codes, totals


def summed(texts: list[str], known: np.ndarray, weights: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """For each text the number of its trigrams, and the sum of each row of ``weights`` over those that are ``known``.

    ``known`` is sorted; ``weights`` has a column for each of it, and one of zeros behind them.
    """
    rows = np.zeros((len(texts), 1 + len(weights)), np.int64)
    for begin, end in slices(texts):
        codes, own, ends, alphabet = _coded(texts[begin:end], letters)
        starts = np.concatenate([[0], ends[:-1]])
        # Characters where no trigram begins weigh nothing.
        places = np.full(ends[-1], len(known))
        if alphabet is None:
            places[:-2][own] = _places(codes[own], known)
        else:
            distinct, _ = _distinct(codes[own], alphabet)
            place = np.empty(len(alphabet) ** 3, np.int64)
            place[distinct] = _places(_unplaced(distinct, alphabet), known)
            places[:-2][own] = place[codes[own]]
        rows[begin:end, 0] = np.maximum(ends - starts - 2, 0)
        for i, weight in enumerate(weights):
            rows[begin:end, 1 + i] = np.add.reduceat(weight[places], starts)
    return rows


def _places(codes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of each number in ``known``, the one behind all if it is not there."""
    places = np.searchsorted(known, codes)
    found = known[np.minimum(places, len(known) - 1)] == codes if len(known) else np.zeros(len(codes), bool)
    return np.where(found, places, len(known))

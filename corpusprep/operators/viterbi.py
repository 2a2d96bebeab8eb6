"""Best paths through the readings of many texts at once, by numpy inside a task.

Runs of ambiguous tokens take their steps together: the first tokens of all runs,
then the second ones, and so on. What is kept of a step is one number for each
reading, which says where its best path comes from.
"""

from __future__ import annotations

import numpy as np

# Scores of a reading that a token does not have, and of a missing score, which is below every other and equal to itself.
_ABSENT, _MISSING = -(2**62), -(2**60)


def best_path(
    starts: np.ndarray, counts: np.ndarray, tags: np.ndarray, scores: np.ndarray, missing: np.ndarray, sizes: np.ndarray, follows: np.ndarray, block: int
) -> np.ndarray:
    """The tag of each token, -1 for tokens without a reading.

    A token has ``counts`` readings from ``starts`` on in ``tags`` and ``scores``; ``missing`` marks scores that are null.
    ``sizes`` are the tokens of each text. ``follows`` has a last row and column for the edge.
    """
    edge = len(follows) - 1
    found = np.full(len(counts), -1, np.int64)
    found[counts == 1] = tags[starts[counts == 1]]
    ambiguous = counts > 1
    if not ambiguous.any():
        return found
    opens = np.zeros(len(counts) + 1, bool)
    opens[np.cumsum(sizes)] = opens[0] = True
    follows_run = np.append(False, ambiguous)[:-1] & ~opens[:-1]
    precedes_run = np.append(ambiguous, False)[1:] & ~opens[1:]
    first, last = np.flatnonzero(ambiguous & ~follows_run), np.flatnonzero(ambiguous & ~precedes_run)
    beside = np.append(np.where(found < 0, edge, found), edge)
    left, right = np.where(opens[first], edge, beside[first - 1]), np.where(opens[last + 1], edge, beside[last + 1])
    length, widest = last - first + 1, np.maximum.reduceat(counts, first)
    nulls = missing.any()
    scores = np.where(missing, _MISSING, scores)
    for width in np.unique(widest):
        runs = np.flatnonzero(widest == width)
        runs = runs[np.argsort(-length[runs], kind="stable")]
        many = max(1, block // int(width * width))
        for begin in range(0, len(runs), many):
            own = runs[begin : begin + many]
            _decode(found, first[own], length[own], left[own], right[own], width, counts, starts, tags, scores, nulls, follows)
    return found


def _decode(found, first, length, left, right, width, counts, starts, tags, scores, nulls, follows) -> None:
    """Set the tags of runs that are sorted by length, the longest first."""
    places = np.arange(width)

    def readings(tokens):
        has = places < counts[tokens][:, None]
        at = np.where(has, starts[tokens][:, None] + places, 0)
        return tags[at], np.where(has, scores[at], _ABSENT), has

    def settled(options):
        return np.where((options < _MISSING // 2) & (options > _ABSENT // 2), _MISSING, options) if nulls else options

    active = [int(np.searchsorted(-length, -k)) for k in range(int(length[0]))]
    tag, score, has = readings(first)
    state = np.where(has, settled(score + follows[left[:, None], tag]), _ABSENT)
    came = []
    for k in range(1, len(active)):
        n = active[k]
        new, score, has = readings(first[:n] + k)
        options = settled(state[:n, :, None] + follows[tag[:n, :, None], new[:, None, :]])
        # Of equal scores the first, which is that of the tag that sorts first.
        best = options.argmax(1)
        came.append(best.astype(np.int8))
        value = np.take_along_axis(options, best[:, None, :], 1)[:, 0]
        value = np.maximum(value + score, _MISSING) if nulls else value + score
        state[:n], tag[:n] = np.where(has, settled(value), _ABSENT), new
    chosen = settled(state + follows[tag, right[:, None]]).argmax(1)
    for k in range(len(active) - 1, -1, -1):
        n = active[k]
        tokens = first[:n] + k
        found[tokens] = tags[starts[tokens] + chosen[:n]]
        if k:
            chosen[:n] = came[k - 1][np.arange(n), chosen[:n]]

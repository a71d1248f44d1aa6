"""Simple-8b: runs of small numbers in 64-bit words, for many blocks at once.

The top four bits of a word are its selector; it says how many numbers of how many bits fill the
other sixty.  A word takes as many of the next numbers as some selector allows.  That choice
depends on where the word before ended, so the blocks of a batch walk along together, one word of
each block a step; which selector fits at every place is found for all places beforehand.

Numbers of more than sixty bits keep their low sixty in place; the others are escapes, stored
behind the words of the block as (place in the block << 4 | top four bits).  Blocks decode alone.
"""

from __future__ import annotations

import numpy as np

# The selectors of the published code, (numbers, bits of each).
SELECTORS = [
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]

U64 = np.uint64
PAYLOAD = 60
_COUNTS = np.array([c for c, _ in SELECTORS], np.int64)
_POWERS = np.array([1 << b for b in range(64)], U64)


def _widths(values: np.ndarray) -> np.ndarray:
    """How many bits each number has."""
    if not len(values) or values.max() < 1 << 53:
        return np.frexp(values.astype(np.float64))[1]
    return np.searchsorted(_POWERS, values, "right")


def encode(values: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, words per block, escapes, escapes per block) of numbers in blocks of one size.

    The last block may be shorter; the last word of a block is filled with zeros.
    """
    values = values.astype(U64, copy=False)
    n_blocks = -(-len(values) // block)
    grid = np.zeros((n_blocks, block + SELECTORS[0][0]), U64)
    whole = len(values) // block
    grid[:whole, :block] = values[: whole * block].reshape(whole, block)
    grid[whole:, : len(values) - whole * block] = values[whole * block :]
    sizes = np.full(n_blocks, block, np.int64)
    if n_blocks:
        sizes[-1] = len(values) - (n_blocks - 1) * block

    at = np.flatnonzero(values >> U64(PAYLOAD))
    escapes = (at % block).astype(U64) << U64(4) | values[at] >> U64(PAYLOAD)
    per_block = np.bincount(at // block, minlength=n_blocks)
    grid &= U64((1 << PAYLOAD) - 1)

    # The best selector at every place: the one with most numbers that all fit.  The widest of c
    # numbers is the wider of two overlapping windows that are known already.
    width = grid.shape[1]
    widest = {1: _widths(grid.reshape(-1)).astype(np.int8).reshape(n_blocks, width)}
    best = np.full((n_blocks, width), len(SELECTORS) - 1, np.int8)
    for s in range(len(SELECTORS) - 2, -1, -1):
        count, bits = SELECTORS[s]
        half = min(c for c in widest if 2 * c >= count)
        wide = np.full((n_blocks, width), PAYLOAD, np.int8)
        shift = count - half
        np.maximum(widest[half][:, : width - shift], widest[half][:, shift:], out=wide[:, : width - shift])
        widest[count] = wide
        best = np.where(wide <= bits, np.int8(s), best)

    rows, starts, taken = [], [], []
    row, place = np.arange(n_blocks), np.zeros(n_blocks, np.int64)
    while len(row):
        chosen = best[row, place]
        rows.append(row)
        starts.append(place)
        taken.append(chosen)
        place = place + _COUNTS[chosen]
        more = place < sizes[row]
        row, place = row[more], place[more]
    if not rows:
        return np.zeros(0, U64), np.zeros(0, np.int64), escapes, per_block
    row, place, chosen = (np.concatenate(x) for x in (rows, starts, taken))
    order = np.argsort(row, kind="stable")
    row, place, chosen = row[order], place[order], chosen[order]
    words = chosen.astype(U64) << U64(PAYLOAD)
    for s in np.unique(chosen):
        count, bits = SELECTORS[s]
        own = np.flatnonzero(chosen == s)
        for j in range(count if bits else 0):
            words[own] |= grid[row[own], place[own] + j] << U64(j * bits)
    return words, np.bincount(row, minlength=n_blocks), escapes, per_block


def decode(
    words: np.ndarray, n_words: np.ndarray, escapes: np.ndarray, n_escapes: np.ndarray, sizes: np.ndarray
) -> np.ndarray:
    """The numbers of consecutive blocks; sizes: how many each block has."""
    chosen = (words >> U64(PAYLOAD)).astype(np.int64)
    counts = _COUNTS[chosen]
    begins = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(int(begins[-1]), U64)
    for s in np.unique(chosen):
        count, bits = SELECTORS[s]
        if not bits:
            continue
        own = np.flatnonzero(chosen == s)
        shifts = (np.arange(count) * bits).astype(U64)
        found = (words[own, None] >> shifts) & U64((1 << bits) - 1)
        out[begins[own, None] + np.arange(count)] = found
    # Blocks end inside their last word.
    edges = begins[np.concatenate([[0], np.cumsum(n_words)])]
    block = np.repeat(np.arange(len(sizes)), np.diff(edges))
    out = out[np.arange(len(out)) - edges[block] < sizes[block]]
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    at = np.repeat(first, n_escapes) + (escapes >> U64(4)).astype(np.int64)
    out[at] |= (escapes & U64(15)) << U64(PAYLOAD)
    return out

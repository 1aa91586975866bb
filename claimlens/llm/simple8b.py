"""Simple-8b: several small integers in a 64-bit word.

The upper four bits of a word say how its other 60 are divided. Selector 0 is the escape: the next word
is one value of more than 60 bits as it stands. The last word may have room for more values than there
are; the reader knows their number.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the format: values per word and bits per value, by selector from 1 on.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 0

COUNT_OF = np.array([1, *COUNTS], np.int64)


SMALL = np.array([max(1, v.bit_length()) for v in range(1 << 16)], np.uint8)


def bit_widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value, 1 at least."""
    top = int(values.max(initial=0))
    if top < len(SMALL):
        return SMALL[values]
    widths = SMALL[values & np.uint64(0xFFFF)]
    for shift in range(16, top.bit_length(), 16):
        part = values >> np.uint64(shift)
        widths = np.where(part > 0, SMALL[part & np.uint64(0xFFFF)] + np.uint8(shift), widths)
    return widths


def encode(values: np.ndarray) -> np.ndarray:
    """Words of the values (unsigned 64-bit): each word takes as many of the next values as fit."""
    values = values.astype(np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64)
    room = COUNTS[0]
    widths = np.concatenate([bit_widths(values), np.ones(room, np.uint8)])
    padded = np.concatenate([values, np.zeros(room, np.uint64)])
    # The largest width among the next k values, for each k that a word may hold. A count is at most
    # twice the one before it, so two overlapping runs of that one cover it.
    largest = {1: widths}
    for before, count in zip(COUNTS[:0:-1], COUNTS[-2::-1]):
        run, step = largest[before], count - before
        largest[count] = np.maximum(run, np.concatenate([run[step:], np.ones(step, np.uint8)]))
    selectors = np.full(n, len(COUNTS), np.uint8)
    for s in range(len(COUNTS), 0, -1):
        selectors[largest[COUNTS[s - 1]][:n] <= WIDTHS[s - 1]] = s
    selectors[widths[:n] > 60] = ESCAPE
    steps = COUNT_OF[selectors].astype(np.uint8).tobytes()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += steps[i]
    starts = np.array(starts, np.int64)
    chosen = selectors[starts]
    words = np.zeros(len(starts), np.uint64)
    for s in np.unique(chosen).tolist():
        here = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            continue
        count, width = COUNTS[s - 1], WIDTHS[s - 1]
        word = np.full(len(here), s << 60, np.uint64)
        for k in range(count):
            word |= padded[starts[here] + k] << np.uint64(k * width)
        words[here] = word
    escapes = np.flatnonzero(chosen == ESCAPE)
    return np.insert(words, escapes + 1, values[starts[escapes]]) if len(escapes) else words


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values of the words."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    raw = np.empty(0, np.int64)
    if (selectors == ESCAPE).any():
        marks, i = [], -1
        for z in np.flatnonzero(selectors == ESCAPE).tolist():
            if z > i:  # else it is the value of the escape before it
                marks.append(z)
                i = z + 1
        marks = np.array(marks, np.int64)
        raw = words[marks + 1]
        keep = np.ones(len(words), bool)
        keep[marks + 1] = False
        words, selectors = words[keep], selectors[keep]
    counts = COUNT_OF[selectors]
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint64)
    for s in np.unique(selectors).tolist():
        here = np.flatnonzero(selectors == s)
        if s == ESCAPE:
            out[starts[here]] = raw
            continue
        count, width = COUNTS[s - 1], WIDTHS[s - 1]
        mask = np.uint64((1 << width) - 1)
        for k in range(count):
            out[starts[here] + k] = (words[here] >> np.uint64(k * width)) & mask
    return out[:n]

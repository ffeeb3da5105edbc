"""Simple-8b: 64-bit words that hold as many integers as fit, in numpy.

The high four bits of a word name its layout, the low sixty hold the values, the first of them
lowest. Values are coded in blocks that start at a word, so that blocks are decoded apart.
Values of over sixty bits are escaped: their word holds a place in a table beside the words.
"""

from __future__ import annotations

import numpy as np

#: Values a block; a multiple of no layout, as blocks end early.
BLOCK = 240
# How many values a word holds, and of how many bits, by selector from 1.
COUNTS = (120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 0

_COUNT_OF = np.array([1, *COUNTS], dtype=np.int64)
#: By how many values a word is to hold: the widest class of which it holds as many.
_TIGHTEST = [max(k for k, held in enumerate(COUNTS) if held >= max(1, n)) for n in range(121)]
_SELECTOR_OF = {count: selector for selector, count in enumerate(COUNTS, 1)}
#: Class k holds values below 2 ** WIDTHS[k]; the class behind the last is escaped.
_LIMITS = np.array([1 << width for width in WIDTHS], dtype=np.uint64)
_ENDED, _ESCAPED = 255, len(WIDTHS)


def _classes(values: np.ndarray) -> np.ndarray:
    if values.size and values.max() < len(_SMALL):
        return _SMALL[values]
    return np.searchsorted(_LIMITS, values, side="right").astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words, the number of words of each block, and the table of escaped values."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    blocks = -(-len(values) // BLOCK)
    classes = np.full(blocks * BLOCK, _ENDED, dtype=np.uint8)
    classes[: len(values)] = _classes(values)
    classes = np.ascontiguousarray(classes.reshape(blocks, BLOCK).T)
    # The most values that a word from each place can hold; it never crosses the block's end.
    best = np.ones((BLOCK, blocks), dtype=np.uint8)
    largest = classes.copy()
    for count in range(2, COUNTS[0] + 1):
        largest = np.maximum(largest[:-1], classes[count - 1 :])
        if count in _SELECTOR_OF:
            fits = largest <= _SELECTOR_OF[count] - 1
            best[: len(fits)][fits] = count
        if not largest.size or largest.min() > _TIGHTEST[count]:
            break
    # All blocks take a step at a time along their words.
    lengths = np.full(blocks, BLOCK, dtype=np.int64)
    if blocks:
        lengths[-1] = len(values) - BLOCK * (blocks - 1)
    at, lanes = np.zeros(blocks, dtype=np.int64), np.arange(blocks)
    steps = []
    while lanes.size:
        taken = best[at[lanes], lanes]
        steps.append((lanes * BLOCK + at[lanes], taken))
        at[lanes] += taken
        lanes = lanes[at[lanes] < lengths[lanes]]
    if not steps:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.uint64)
    starts = np.concatenate([start for start, _ in steps])
    order = np.argsort(starts, kind="stable")
    starts, counts = starts[order], np.concatenate([count for _, count in steps])[order]
    words = np.zeros(len(starts), dtype=np.uint64)
    for selector, (count, width) in enumerate(zip(COUNTS, WIDTHS), 1):
        chosen = np.flatnonzero(counts == count)
        word = np.full(len(chosen), selector << 60, dtype=np.uint64)
        for place in range(count if width else 0):
            word |= values[starts[chosen] + place] << np.uint64(place * width)
        words[chosen] = word
    escaped = np.flatnonzero((counts == 1) & (values[starts] >= _LIMITS[-1]))
    table = values[starts[escaped]]
    words[escaped] = np.arange(len(escaped), dtype=np.uint64)
    sizes = np.bincount(starts // BLOCK, minlength=blocks).astype(np.uint8)
    return words, sizes, table


def decode(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The values of any run of whole blocks."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNT_OF[selectors]
    starts = np.cumsum(counts) - counts
    values = np.zeros(int(counts.sum()), dtype=np.uint64)
    for selector, (count, width) in enumerate(zip(COUNTS, WIDTHS), 1):
        chosen = np.flatnonzero(selectors == selector)
        mask = np.uint64((1 << width) - 1)
        for place in range(count if width and len(chosen) else 0):
            values[starts[chosen] + place] = words[chosen] >> np.uint64(place * width) & mask
    escaped = np.flatnonzero(selectors == ESCAPE)
    values[starts[escaped]] = table[words[escaped].astype(np.int64)]
    return values


_FEW = np.arange(1 << 17, dtype=np.uint64)
_SMALL = np.searchsorted(_LIMITS, _FEW, side="right").astype(np.uint8)

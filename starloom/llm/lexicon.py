"""A lexicon as a minimal acyclic transducer: words in, sequences of ids out.

States that accept the same rests with the same outputs are one state, so suffixes are shared
as prefixes are. Outputs stand as far towards the start as words agree on them. The compiled
lexicon is a few flat arrays in one file, which workers map into memory and walk for all words
of a batch at once.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

#: Longer words are not taken in.
WORD_BYTES = 48
#: Words that are walked at once.
WALKED = 1 << 16

# Fixed values of the file format: five counts, then the closing magic number.
_FOOTER = struct.Struct("<5Q")
MAGIC = b"\xffLEX"

Ids = tuple[int, ...]


def _shared(one: Ids, other: Ids) -> int:
    size = 0
    for a, b in zip(one, other):
        if a != b:
            break
        size += 1
    return size


class _State:
    __slots__ = ("arcs", "final")

    def __init__(self) -> None:
        #: By label: target and output.
        self.arcs: dict[int, tuple[int, Ids]] = {}
        #: What is put out if a word ends here; None if none does.
        self.final: Ids | None = None

    def prepend(self, ids: Ids) -> None:
        self.arcs = {label: (target, ids + out) for label, (target, out) in self.arcs.items()}
        if self.final is not None:
            self.final = ids + self.final


def compile_lexicon(entries: Iterable[tuple[bytes, Ids]]) -> bytes:
    """The file of a lexicon, without its magic number; words come sorted and once each."""
    register: dict[tuple, int] = {}
    frozen: list[_State] = []

    def freeze(state: _State) -> int:
        known = (state.final, tuple(state.arcs.items()))
        number = register.get(known)
        if number is None:
            number = register[known] = len(frozen)
            frozen.append(state)
        return number

    open_states, before = [_State()], b""
    for word, ids in entries:
        if not before < word or len(word) > WORD_BYTES:
            raise ValueError("words come sorted, once each, and not too long")
        same = 0
        while same < len(before) and before[same] == word[same]:
            same += 1
        _close(open_states, before, same, freeze)
        for place in range(same):
            state, label = open_states[place], word[place]
            _, out = state.arcs[label]
            agreed = _shared(out, ids)
            if agreed < len(out):
                open_states[place + 1].prepend(out[agreed:])
                state.arcs[label] = (-1, out[:agreed])
            ids = ids[agreed:]
        for place in range(same, len(word)):
            open_states[place].arcs[word[place]] = (-1, ids)
            open_states.append(_State())
            ids = ()
        open_states[-1].final = ids
        before = word
    _close(open_states, before, 0, freeze)
    return _flat(frozen, freeze(open_states[0]))


def _close(states: list[_State], word: bytes, keep: int, freeze) -> None:
    """Freeze what lies behind the first ``keep`` letters of the word before."""
    for place in range(len(word), keep, -1):
        label = word[place - 1]
        _, out = states[place - 1].arcs[label]
        states[place - 1].arcs[label] = (freeze(states.pop()), out)


def _flat(states: list[_State], root: int) -> bytes:
    outputs: dict[Ids, int] = {(): 0}
    keys, targets, emitted = [], [], []
    finals = np.full(len(states), -1, dtype="<i4")
    for number, state in enumerate(states):
        for label in sorted(state.arcs):
            target, out = state.arcs[label]
            keys.append(number << 8 | label)
            targets.append(target)
            emitted.append(outputs.setdefault(out, len(outputs)))
        if state.final is not None:
            finals[number] = outputs.setdefault(state.final, len(outputs))
    sizes = np.array([len(out) for out in outputs], dtype="<i4")
    ids = np.array([number for out in outputs for number in out], dtype="<u4")
    arrays = [
        np.array(keys, dtype="<i8"),
        np.array(targets, dtype="<i4"),
        np.array(emitted, dtype="<i4"),
        finals,
        sizes,
        ids,
    ]
    footer = _FOOTER.pack(len(keys), len(states), len(sizes), len(ids), root)
    return b"".join([*(array.tobytes() for array in arrays), footer])


def ragged(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices of ``pool`` behind each other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class Lexicon:
    """A compiled lexicon over a buffer, such as a file in memory."""

    def __init__(self, content) -> None:
        data = np.frombuffer(content, dtype=np.uint8)
        end = len(data) - len(MAGIC)
        if data[end:].tobytes() != MAGIC:
            raise ValueError("not a lexicon")
        footer = end - _FOOTER.size
        arcs, states, outputs, ids, self._root = _FOOTER.unpack(data[footer:end].tobytes())
        at = 0

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            start, at = at, at + count * np.dtype(kind).itemsize
            return data[start:at].view(kind)

        self._keys, self._targets = take("<i8", arcs), take("<i4", arcs)
        self._emitted, self._finals = take("<i4", arcs), take("<i4", states)
        self._sizes, self._ids = take("<i4", outputs), take("<u4", ids)
        if at != footer:
            raise ValueError("broken lexicon")
        self._starts = np.cumsum(self._sizes, dtype=np.int64) - self._sizes
        self.states = states

    def look_up(
        self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words (slices of bytes) are known, how many ids each has, and all their ids."""
        parts = [
            self._walk(data, starts[i : i + WALKED], sizes[i : i + WALKED])
            for i in range(0, len(starts), WALKED)
        ]
        if not parts:
            nothing = np.zeros(0, dtype=np.int64)
            return nothing.astype(bool), nothing, nothing.astype("<u4")
        return tuple(np.concatenate(column) for column in zip(*parts))

    def _walk(self, data, starts, sizes):
        words = len(starts)
        state = np.where(sizes <= WORD_BYTES, self._root, -1).astype(np.int64)
        longest = int(sizes[state >= 0].max(initial=0))
        emitted = np.zeros((words, longest + 1), dtype=np.int32)
        alive = np.flatnonzero(state >= 0)
        for place in range(longest if len(self._keys) else 0):
            alive = alive[sizes[alive] > place]
            key = state[alive] << 8 | data[starts[alive] + place]
            arc = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            known = self._keys[arc] == key
            state[alive[~known]] = -1
            alive, arc = alive[known], arc[known]
            state[alive] = self._targets[arc]
            emitted[alive, place] = self._emitted[arc]
        if not len(self._keys):
            state[sizes > 0] = -1
        found = state >= 0
        found[found] = self._finals[state[found]] >= 0
        emitted[~found] = 0
        emitted[found, sizes[found]] = self._finals[state[found]]
        row, place = np.nonzero(emitted)
        outputs = emitted[row, place]
        made = self._sizes[outputs]
        counts = np.bincount(row, weights=made, minlength=words).astype(np.int64)
        return found, counts, ragged(self._ids, self._starts[outputs], made)

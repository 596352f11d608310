"""Texts laid end to end as bytes, so that their words are found, lower-cased and told apart all at once.

Python's cost is per object. Over the bytes of many texts numpy's is per byte, and
a word needs an object of its own only where a caller asks for it.
"""

from __future__ import annotations

import numpy as np
import xxhash

LONGEST = 64  # bytes of a word that `hashes` takes
_PAD = b"\n" * (LONGEST + 8)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = [c.encode() for c in map(chr, range(0x80, 0x3001)) if c.isspace()]
_SPACE_HEADS = np.isin(np.arange(256), [s[0] for s in _SPACES])


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts with line ends before, between and after them, and where each text ends."""
    coded = [t.encode() for t in texts]
    ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + 1)
    return np.frombuffer(bytearray(b"\n" + b"\n".join(coded) + _PAD), np.uint8), ends


def blank_spaces(raw: np.ndarray) -> None:
    """Write ASCII spaces over the other spaces that ``str.split`` knows."""
    heads = np.flatnonzero(_SPACE_HEADS[raw])
    for space in _SPACES if len(heads) else ():
        at = heads[np.logical_and.reduce([raw[heads + i] == b for i, b in enumerate(space)])]
        for i in range(len(space)):
            raw[at + i] = 32


def lowered(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with A-Z and the capitals of U+00C0 to U+00DE lower-cased, and where the letters of U+00C0 to U+00FF begin."""
    low = _LOWER[raw]
    at = np.flatnonzero(raw == 0xC3)
    second = raw[at + 1]
    letter = (second != 0x97) & (second != 0xB7)  # the signs of multiplication and division
    at, second = at[letter], second[letter]
    low[at + 1] = second + np.uint8(32) * (second <= 0x9E)
    return low, at


def words(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs without gap begin and end; the first and the last byte are gaps."""
    turns = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    return turns[::2], turns[1::2]


def eight(raw: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes from ``at`` on as one number each, 8 or as many as ``sizes`` says."""
    aligned = raw[:len(raw) // 8 * 8].view("<u8")
    slot, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
    found = (aligned[slot] >> shift) | ((aligned[slot + 1] << np.uint64(1)) << (np.uint64(63) - shift))
    return found & _MASKS[np.clip(sizes, 0, 8)]


def _mixed(found: np.ndarray, more: np.ndarray) -> np.ndarray:
    found = (found ^ more) * _FACTOR
    return found ^ (found >> np.uint64(32))


def hashes(raw: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes; the runs have ``LONGEST`` bytes at most."""
    out = _mixed(sizes.astype(np.uint64) * _FACTOR, eight(raw, at, sizes))
    done, rest = 8, np.flatnonzero(sizes > 8)
    while len(rest):
        out[rest] = _mixed(out[rest], eight(raw, at[rest] + done, sizes[rest] - done))
        done += 8
        rest = rest[sizes[rest] > done]
    return out


def places(first: np.ndarray, second: np.ndarray, count: int) -> np.ndarray:
    """A place below ``count``, a power of two, for each pair of numbers."""
    return (_mixed(_mixed(first, second), first) & np.uint64(count - 1)).astype(np.int64)


def hashes_of(runs: list[bytes]) -> np.ndarray:
    """The same hashes of separate runs, also of longer ones."""
    sizes = np.fromiter(map(len, runs), np.int64, len(runs))
    out = hashes(np.frombuffer(b"".join(runs) + _PAD, np.uint8), np.cumsum(sizes) - sizes, np.minimum(sizes, LONGEST))
    for i in np.flatnonzero(sizes > LONGEST).tolist():
        out[i] = xxhash.xxh64_intdigest(runs[i], 7)
    return out

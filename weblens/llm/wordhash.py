"""64-bit hashes of the words of a batch of texts, in NumPy passes over its bytes.

Words are runs of bytes other than space and the controls 9 to 13. A word is mixed into its hash eight bytes at a
time, all words at once; no word becomes a Python object.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

U64 = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_SEEDS = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)  # masks of the first k bytes
LONG = 256  # longer spans are hashed one by one


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every byte on as one value, zeros behind the end."""
    n = len(data)
    padded = np.zeros(n + 16, dtype=np.uint8)
    padded[:n] = data
    out = np.empty(n + 8, dtype=np.uint64)
    for k in range(8):
        out[k::8] = padded[k:k + (len(out[k::8]) * 8)].view("<u8")
    return out[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, two: bool = False) -> list[np.ndarray]:
    """64-bit hashes of data[start:end], and with ``two`` others of their own seed, so that both make 128 bits.

    Every eight bytes are mixed into the state, one round for all spans that still have some; spans of more than
    LONG bytes go through BLAKE2.
    """
    lengths = ends - starts
    found = [mix(lengths.astype(np.uint64) * seed + seed) for seed in _SEEDS[:1 + two]]
    eights = _eights(data)
    active = np.flatnonzero((lengths > 0) & (lengths <= LONG))
    done = 0
    while len(active):
        left = lengths[active] - done
        block = eights[starts[active] + done] & _KEEP[np.minimum(left, 8)]
        for h, seed in zip(found, _SEEDS):
            h[active] = mix((h[active] ^ block) + seed)
        done += 8
        active = active[left > 8]
    for k in np.flatnonzero(lengths > LONG).tolist():
        whole = np.frombuffer(hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=16).digest(), dtype=np.uint64)
        for h, value in zip(found, whole):
            h[k] = value
    return found


def text_slices(column: pa.Array, most: int = 1 << 20):
    """(first row, bytes, offsets) of runs of rows of a string column with about ``most`` bytes each;
    NULL is empty."""
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False,
                letters: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the range of its words (texts + 1 offsets).

    With ``letters`` words are runs of ASCII letters and bytes of other characters."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = _LETTERS[data] if letters else ~_SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < n]
    start[firsts] = inside[firsts]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    end[lasts] = inside[lasts]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    hashes, = span_hashes(_LOWER[data] if lower else data, starts, ends)
    return hashes, np.searchsorted(starts, offsets)


def set_digest(hashes: np.ndarray) -> bytes:
    """A 128-bit digest of a sorted set of hashes."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int, lower: bool = False) -> list[np.ndarray]:
    """For each text its distinct ``size``-word shingles as sorted hashes; a text with fewer words has one
    shingle of all of them, a text without words none."""
    hashes, at = word_hashes(data, offsets, lower)
    rolled = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for k in range(size):
        rolled = mix(rolled + hashes[k:k + len(rolled)])
    sets = []
    for i, j in zip(at[:-1], at[1:]):
        if j - i >= size:
            sets.append(np.unique(rolled[i:j - size + 1]))
        elif j > i:
            whole = np.array([j - i], dtype=np.uint64)
            for h in hashes[i:j]:
                whole = mix(whole + h)
            sets.append(mix(whole ^ U64(0x5851F42D4C957F2D)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets

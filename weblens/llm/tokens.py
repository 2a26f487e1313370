"""Token ids of whole texts inside a task, through a vocabulary file of the ``tokenizers`` library.

Texts are cut where neither of the supported pre-tokenizers (byte-level BPE, and BPE with word ends) joins the
two sides, whatever stands around: before a space, newline or punctuation mark. Pieces are told apart by
128-bit hashes, and each new one is encoded by the library once; a worker remembers a bounded number.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from weblens.llm.wordhash import mix, span_hashes, text_slices

_ASCII = np.arange(256) < 128
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
_LETTER = _ASCII & np.isin(np.arange(256) | 32, np.arange(97, 123)) & (np.arange(256) >= 65)
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_MARK = _ASCII & ~_WHITE & ~_LETTER & ~_DIGIT & (np.arange(256) > 32) & (np.arange(256) < 127)
_PLAIN = _ASCII & ~_WHITE
_TWO_BYTE = np.isin(np.arange(256), np.arange(0xC3, 0xE0))  # leads of two-byte characters, none of them white


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start, the start of every text that has bytes included."""
    n = len(data)
    start = np.zeros(n, dtype=bool)
    if n == 0:
        return np.flatnonzero(start)
    # filled[i]: the character that ends at byte i is known not to be white space.
    filled = _PLAIN[data]
    filled[1:] |= (data[1:] >= 0x80) & _TWO_BYTE[data[:-1]]
    breaks = (data == 32) | (data == 10)
    start[1:] = filled[:-1] & breaks[1:] | _LETTER[data[:-1]] & _MARK[data[1:]]
    # A single newline, and what is known not to be white after it.
    start[2:] |= filled[:-2] & (data[1:-1] == 10) & _PLAIN[data[2:]]
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(start)


class _Table:
    """Sorted hashes of pieces, and where their ids are."""

    def __init__(self):
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places, -1 where there is none."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.places[at], -1)

    def add(self, hashes: np.ndarray, places: np.ndarray) -> None:
        hashes, places = np.concatenate([self.hashes, hashes]), np.concatenate([self.places, places])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.places = hashes[order], places[order]


class Encoder:
    def __init__(self, path: str, most_pieces: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.most = most_pieces
        self._forget()

    def _forget(self) -> None:
        self.known, self.recent = _Table(), _Table()
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.seconds = np.zeros(1 << 16, np.uint64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.pieces = self.used = 0

    def _learn(self, hashes: np.ndarray, seconds: np.ndarray, pieces: list[str]) -> np.ndarray:
        if self.pieces + len(pieces) > self.most:
            self._forget()
        lengths, flat = [], []
        for k in range(0, len(pieces), 4096):
            for e in self.tokenizer.encode_batch_fast(pieces[k:k + 4096], add_special_tokens=False):
                ids = e.ids
                lengths.append(len(ids))
                flat += ids
        n, size = self.pieces + len(pieces), self.used + len(flat)
        while len(self.starts) < n:
            self.starts, self.lengths, self.seconds = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths, self.seconds))
        while len(self.ids) < size:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        places = np.arange(self.pieces, n)
        self.lengths[places], self.seconds[places] = lengths, seconds
        self.starts[places] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used:size] = flat
        self.pieces, self.used = n, size
        self.recent.add(hashes, places)
        if 4 * len(self.recent.hashes) > len(self.known.hashes):
            self.known.add(self.recent.hashes, self.recent.places)
            self.recent = _Table()
        return places

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """The ids of each text with ``end_id`` appended, in order; NULL is empty."""
        for _, data, offsets in text_slices(texts):
            yield from self._encode(data, offsets, end_id)

    def _encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> Iterator[np.ndarray]:
        starts = piece_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes, seconds = span_hashes(data, starts, ends, two=True)
        while True:
            distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            places = self.known.find(distinct)
            unknown = places < 0
            places[unknown] = self.recent.find(distinct[unknown])
            # Another piece with the same first hash, here or among those known, is told by the second one and goes on
            # under another first hash.
            other = seconds != seconds[first][which]
            other |= ((places >= 0) & (self.seconds[places] != seconds[first]))[which]
            if not other.any():
                break
            hashes[other] = mix(hashes[other] ^ seconds[other])
        missing = np.flatnonzero(places < 0)
        if len(missing):
            if self.pieces + len(missing) > self.most:  # the pieces of this batch are learnt anew, too
                self._forget()
                missing = np.arange(len(distinct))
            raw = data.tobytes()
            places[missing] = self._learn(distinct[missing], seconds[first[missing]], [
                raw[i:j].decode() for i, j in zip(starts[first[missing]].tolist(), ends[first[missing]].tolist())])
        at = places[which]
        lengths = self.lengths[at].astype(np.int64)
        done = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.arange(done[-1]) + np.repeat(self.starts[at] - done[:-1], lengths)]
        bounds = done[np.searchsorted(starts, offsets)]
        end = np.array([end_id], np.uint32)
        for i, j in zip(bounds[:-1], bounds[1:]):
            yield np.concatenate([ids[i:j], end])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker; it outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]

"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Helpers for code that runs inside Arrow map functions. Separators are ASCII, so
they are found byte by byte without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SPACE = b"\t\n\x0b\x0c\r "
SLICE_BYTES = 2 << 20
_LONG = 64
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], dtype=np.uint64)


def word_bytes(separators: bytes) -> np.ndarray:
    """True for every byte value that belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


SPACED = word_bytes(SPACE)
#: Words of ASCII letters and digits and of everything beyond ASCII.
ALPHANUMERIC = word_bytes(bytes(b for b in range(128) if not chr(b).isalnum() or chr(b).isupper()))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """``start``/``end``: byte offsets of each word; ``first``: index of each
    text's first word, with the total at the end; ``text``: each word's text."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)

    @property
    def position(self) -> np.ndarray:
        """Number of each word in its own text."""
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], self.count)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other and where each begins; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def scan(texts: pa.Array, belongs: np.ndarray = SPACED, lower: bool = False) -> Words:
    """The words of ``texts``: the longest runs of bytes in ``belongs``."""
    data, offsets = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = belongs[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    before[edges] = False
    after[edges - 1] = False
    if len(inside):
        after[-1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * _M1
    value = (value ^ (value >> np.uint64(29))) * _M2
    return value ^ (value >> np.uint64(32))


def hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    length = words.end - words.start
    out = mix(length.astype(np.uint64) + np.uint64((seed * 0x632BE59BD9B4E019 + 0x2545F491) % 2**64))
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    eights = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    todo = np.arange(len(length))
    for at in range(0, _LONG, 8):
        todo = todo[length[todo] > at] if at else todo
        if not len(todo):
            break
        piece = eights[words.start[todo] + at] & _MASKS[np.minimum(length[todo] - at, 8)]
        out[todo] = mix(out[todo] * _M2 ^ piece)
    for i in np.flatnonzero(length > _LONG):
        rest = words.data[words.start[i] : words.end[i]].tobytes()
        out[i] = out[i] ^ np.uint64(xxhash.xxh64_intdigest(rest, seed))
    return out


def join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring runs from the hashes of each."""
    return mix(left * _M1 + (right ^ (right >> np.uint64(31))) * _M2 + np.uint64(0x1B873593))


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` values, at its first; built by doubling."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    n = len(values) - size + 1
    power, covered, parts, done = values, 1, None, 0
    while True:
        if size & covered:
            piece = power[done : done + n]
            parts = piece if parts is None else join(parts, piece)
            done += covered
        if done == size:
            return parts
        power = join(power[:-covered], power[covered:])
        covered *= 2


def inside_one_text(words: Words, size: int) -> np.ndarray:
    """True where a window of ``size`` words starts and ends in the same text."""
    n = max(0, len(words.start) - size + 1)
    ends = np.repeat(words.first[1:], words.count)[:n]
    return np.arange(n) + size <= ends


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of text, a single longer text alone."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def fixed_binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()

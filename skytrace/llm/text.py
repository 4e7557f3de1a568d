"""Helpers that run inside tasks: Arrow text columns in bounded blocks, words and word hashes.

Words are maximal runs of anything but the six ASCII white space characters, after A-Z have been
lower-cased. All functions work on UTF-8 bytes, so no text is decoded. A null text is an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20
CHUNK_BYTES = 1 << 20

#: Byte table that lower-cases A-Z and leaves every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LOWER = np.frombuffer(LOWER, np.uint8)
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

#: An odd multiplier has an inverse modulo 2**64, so a word's hash follows from two running sums.
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def blocks(batches: Iterable[pa.RecordBatch], text: str | int = "text",
           size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have at most ``size`` bytes, or one row.

    ``text`` is a column's name, or its place (from the end if negative).
    """
    for batch in batches:
        place = (batch.schema.get_field_index(text) if isinstance(text, str)
                 else text % batch.num_columns)
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(place)), 0), np.int64)
        ends = np.cumsum(lengths)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, made longer until no other column has it."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name += "_"
    return name


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in one array, and where each text begins (one offset more)."""
    filled = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[
        filled.offset:filled.offset + len(filled) + 1]
    if not len(filled):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = filled.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and each text's first word (one offset more)."""
    inside = ~_SPACES[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    values = values.astype(np.uint64)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    return values ^ (values >> np.uint64(33))


class Powers:
    """Powers of the multiplier and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            size = max(n + 1, CHUNK_BYTES + 4096)
            self.up, self.down = (
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, x, np.uint64))),
                           dtype=np.uint64) for x in (_MULTIPLIER, _INVERSE))
        return self.up, self.down


_POWERS = Powers()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and do not overlap.

    Equal bytes have equal hashes everywhere. Works in chunks of about a megabyte.
    """
    out = np.empty(len(starts), np.uint64)
    span = 0
    while span < len(starts):
        base = starts[span]
        last = max(span + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
        stop = ends[last - 1]
        up, down = _POWERS.upto(int(stop - base))
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum((data[base:stop].astype(np.uint64) + np.uint64(1)) * up[:stop - base],
                  out=sums[1:])
        begin = starts[span:last] - base
        out[span:last] = mixed((sums[ends[span:last] - base] - sums[begin]) * down[begin]
                               + (ends[span:last] - starts[span:last]).astype(np.uint64))
        span = last
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every lower-cased word, and each text's first word (one offset more)."""
    starts, ends, firsts = spans(data, offsets)
    return span_hashes(_LOWER[data], starts, ends), firsts


def word_chunks(text: bytes, size: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The lower-cased words of a text in lists, cut at white space about every ``size`` bytes."""
    begin = 0
    while begin < len(text):
        end = begin + size
        if end < len(text):
            found = _SPACE.search(text, end)
            end = found.start() if found else len(text)
        yield text[begin:end].translate(LOWER).split()
        begin = end


def per_text(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of the values of each text; zero for a text without any."""
    sums = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return sums[firsts[1:]] - sums[firsts[:-1]]


def lists(values: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column as arrays, without a Python object for each number."""
    out = []
    for chunk in values.chunks:
        flat, ends = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        out += [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    return out

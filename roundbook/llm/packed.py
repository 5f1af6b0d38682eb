"""Words of UTF-8 texts packed into unsigned 64-bit numbers, sorted by radix and run-counted.

Short words (up to 16 bytes) become one or two 64-bit numbers, most significant
byte first and padded with zero bytes, so the packing is exact and keeps byte
order. Length buckets bound the sorting: a word of two bytes needs one pass of
16 bits, one of 16 bytes eight. Longer words, and those that hold a zero byte,
are sorted as bytes in buckets of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that a task works on at a time; a longer text is a block of its own.
BLOCK_BYTES = 3_000_000
#: Lengths in bytes up to which words share a bucket of 64-bit numbers.
PACKED = (2, 4, 8, 16)


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: (first row, end row, their bytes, their offsets in these bytes).

    Null texts have no bytes. Arrow's own buffers are read, nothing is decoded.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words_in(low: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and text number of every maximal run of ``inside``
    bytes; a run ends with its text."""
    before = np.zeros(len(low) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(low) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def radix_order(keys: list[np.ndarray], bits: list[int] | None = None) -> np.ndarray:
    """Stable order by ``keys`` (most significant first), least significant 16 bits first.

    A pass over digits that are all alike is left out. ``bits`` gives the used
    low bits of each key (default 64).
    """
    order = None
    for key, used in zip(keys[::-1], (bits or [64] * len(keys))[::-1]):
        for shift in range(0, used, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit == digit[0]).all():
                continue
            order = np.argsort(digit, kind="stable") if order is None else order[np.argsort(digit[order], kind="stable")]
    return np.arange(len(keys[0])) if order is None else order


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted arrays."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


_MASK = np.array([(0xFFFFFFFFFFFFFFFF << (8 * (8 - n))) & 0xFFFFFFFFFFFFFFFF if n else 0 for n in range(9)], np.uint64)


def pack(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers for words of at most 16 bytes (the second is 0 up to 8)."""
    padded = np.append(low, np.zeros(16, np.uint8))
    every = np.ndarray((len(low) + 9,), dtype=">u8", buffer=padded, strides=(1,))
    first = every[starts].astype(np.uint64) & _MASK[np.minimum(lengths, 8)]
    second = np.zeros(len(starts), np.uint64)
    far = np.flatnonzero(lengths > 8)
    second[far] = every[starts[far] + 8].astype(np.uint64) & _MASK[lengths[far] - 8]
    return first, second


def unpack(first: np.ndarray, second: np.ndarray) -> list[bytes]:
    """The words that :func:`pack` packed."""
    return np.frombuffer(np.stack([first, second], axis=1).astype(">u8").tobytes(), "S16").tolist()


@dataclass
class Bucket:
    """Words of one length bucket: where they stand in the block, and their packing
    (``first``, ``second``) or, for long ones, their bytes in ``long``."""

    at: np.ndarray
    bits: list[int]
    first: np.ndarray
    second: np.ndarray
    long: np.ndarray | None = None

    def order(self, *before: np.ndarray) -> np.ndarray:
        """Stable order by ``before`` (16-bit keys, most significant first), then by word."""
        if self.long is None:
            keys = [*before, self.first >> np.uint64(64 - self.bits[0]), self.second]
            return radix_order(keys[: len(before) + len(self.bits)], [16] * len(before) + self.bits)
        order = np.argsort(self.long, kind="stable")
        return order[radix_order([k[order] for k in before], [16] * len(before))] if before else order

    def keys(self, order: np.ndarray) -> list[np.ndarray]:
        return [self.first[order], self.second[order]] if self.long is None else [self.long[order]]


def buckets(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray, zero_bytes: bool = False) -> Iterator[Bucket]:
    """The words of a block by length. ``zero_bytes``: words may hold zero bytes,
    which the padding could not be told from; those words count as long ones."""
    packed = lengths <= PACKED[-1]
    if zero_bytes:
        zeros = np.concatenate([[0], np.cumsum(low == 0)])
        packed &= zeros[starts + lengths] == zeros[starts]
    least = 0
    for most in PACKED:
        at = np.flatnonzero(packed & (lengths > least) & (lengths <= most))
        least = most
        if len(at):
            first, second = pack(low, starts[at], lengths[at])
            yield Bucket(at, [64, 64] if most > 8 else [8 * most], first, second)
    for at in _by_width(np.flatnonzero(~packed), lengths):
        none = np.zeros(len(at), np.uint64)
        yield Bucket(at, [], none, none, _as_bytes(low, starts[at], lengths[at]))


def _by_width(at: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Long words in buckets of doubling width, so padding at most doubles them."""
    width = np.ceil(np.log2(np.maximum(lengths[at], 2))).astype(np.int64)
    for w in np.unique(width):
        yield at[width == w]


def _as_bytes(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Python bytes objects: compared whole, zero bytes included."""
    out = np.empty(len(starts), object)
    for k, (s, n) in enumerate(zip(starts.tolist(), lengths.tolist())):
        out[k] = low[s : s + n].tobytes()
    return out

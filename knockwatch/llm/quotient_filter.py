"""Counting quotient filters over packed n-grams of word ids, as sorted numpy arrays.

An n-gram of word ids is packed into ``2 * width`` bits and sent through an invertible
permutation of those bits. The permuted value is split into a quotient (its leading bits)
and the full remainder, so nothing is lost: filters count exactly, and every key can be
read back. A filter keeps its remainders in order of the permuted values; two bit vectors
say which quotients occur and where the run of each one ends; counters take a byte each,
larger ones an entry in a list of their own. Filters that are sorted the same way merge by
one ordered pass, so the filters of all shards of a table add up to the filter of the table.

A key is held as two halves of ``width`` bits (at most 63), so that 126 bits can be packed.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

#: Odd multipliers of the permutation's rounds; any odd numbers would do.
ROUNDS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
MOST_WIDTH = 63


def half_width(longest: int, id_bits: int) -> int:
    """Bits of each half of a key that packs ``longest`` ids of ``id_bits`` bits."""
    width = -(-longest * id_bits // 2)
    if width > MOST_WIDTH:
        raise ValueError(f"{longest} ids of {id_bits} bits do not fit into {2 * MOST_WIDTH} bits")
    return max(1, width)


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def _mixed(half: np.ndarray, odd: int, width: int) -> np.ndarray:
    product = half * np.uint64(odd)
    return ((product ^ (product >> np.uint64(32))) * np.uint64(ROUNDS[0])) >> np.uint64(64 - width)


def permute(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A Feistel network on the two halves: a bijection, whatever the round function."""
    for odd in ROUNDS:
        left, right = right, left ^ _mixed(right, odd, width)
    return left, right


def restore(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``permute``."""
    for odd in reversed(ROUNDS):
        left, right = right ^ _mixed(left, odd, width), left
    return left, right


def pack(columns: list[np.ndarray], id_bits: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (below ``2 ** id_bits``), the first leading, as the two halves of one key each."""
    left = np.zeros(len(columns[0]), dtype=np.uint64)
    right = np.zeros(len(columns[0]), dtype=np.uint64)
    for ids in columns:
        left = ((left << np.uint64(id_bits)) | (right >> np.uint64(width - id_bits))) & _mask(width)
        right = ((right << np.uint64(id_bits)) | ids.astype(np.uint64)) & _mask(width)
    return left, right


def unpack(left: np.ndarray, right: np.ndarray, longest: int, id_bits: int, width: int) -> list[np.ndarray]:
    """The inverse of ``pack``."""
    columns = []
    for _ in range(longest):
        columns.append((right & _mask(id_bits)).astype(np.int64))
        right = ((right >> np.uint64(id_bits)) | (left << np.uint64(width - id_bits))) & _mask(width)
        left = left >> np.uint64(id_bits)
    return columns[::-1]


@dataclass
class Entries:
    """Distinct permuted keys in ascending order, with their counts."""

    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.left)

    def part(self, low: int, high: int) -> Entries:
        return Entries(self.left[low:high], self.right[low:high], self.counts[low:high])


def nothing() -> Entries:
    none = np.zeros(0, dtype=np.uint64)
    return Entries(none, none, np.zeros(0, dtype=np.int64))


def counted(left: np.ndarray, right: np.ndarray, width: int, counts: np.ndarray | None = None) -> Entries:
    """Entries of permuted keys in any order, repeats included; ``counts`` are 1 each by default."""
    if not len(left):
        return nothing()
    if 2 * width <= 64 and counts is None:
        keys = np.sort((left << np.uint64(width)) | right)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        keys = keys[first]
        sums = np.diff(np.append(first, len(left)))
        return Entries(keys >> np.uint64(width), keys & _mask(width), sums)
    order = np.argsort((left << np.uint64(width)) | right, kind="stable") if 2 * width <= 64 else np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))))
    each = np.ones(len(left), dtype=np.int64) if counts is None else counts[order]
    return Entries(left[first], right[first], np.add.reduceat(each, first))


def merged(filters: list[Entries], width: int) -> Entries:
    """The sum of several filters; the stable sort finds their ordered runs and merges those."""
    some = [f for f in filters if len(f)]
    if len(some) < 2:
        return some[0] if some else nothing()
    return counted(
        np.concatenate([f.left for f in some]),
        np.concatenate([f.right for f in some]),
        width,
        np.concatenate([f.counts for f in some]),
    )


def ranges(entries: Entries, bits: int, width: int) -> np.ndarray:
    """Where each of the ``2 ** bits`` ranges of the leading bits starts, and the end of the last."""
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(width - bits)
    return np.append(np.searchsorted(entries.left, starts), len(entries))


_HEAD = struct.Struct("<QBBBBQ")


def _bytes_of(values: np.ndarray, size: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _values_of(data: memoryview, count: int, size: int) -> np.ndarray:
    wide = np.zeros((count, 8), dtype=np.uint8)
    wide[:, :size] = np.frombuffer(data[: count * size], dtype=np.uint8).reshape(count, size)
    return wide.reshape(-1).view("<u8").astype(np.uint64)


def encode(entries: Entries, width: int, prefix_bits: int = 0) -> bytes:
    """A filter as bytes. ``prefix_bits`` leading bits are the same in all keys and kept once."""
    n = len(entries)
    prefix = int(entries.left[0] >> np.uint64(width - prefix_bits)) if n else 0
    inner = entries.left & _mask(width - prefix_bits)
    quotient_bits = min(max(0, n.bit_length() - 1), width - prefix_bits)
    rest = width - prefix_bits - quotient_bits
    quotient = (inner >> np.uint64(rest)).astype(np.int64)
    occupied = np.zeros(1 << quotient_bits, dtype=bool)
    occupied[quotient] = True
    run_end = np.concatenate((quotient[1:] != quotient[:-1], [True])) if n else np.zeros(0, dtype=bool)
    rest_bytes, right_bytes = -(-rest // 8), -(-width // 8)
    small = np.minimum(entries.counts, 255).astype(np.uint8)
    large = entries.counts[entries.counts >= 255].astype("<i8")
    return b"".join(
        [
            _HEAD.pack(n, prefix_bits, quotient_bits, rest_bytes, right_bytes, prefix),
            np.packbits(occupied).tobytes(),
            np.packbits(run_end).tobytes(),
            _bytes_of(inner & _mask(rest), rest_bytes),
            _bytes_of(entries.right, right_bytes),
            small.tobytes(),
            large.tobytes(),
        ]
    )


def decode(data: bytes, width: int) -> Entries:
    """The inverse of ``encode``."""
    n, prefix_bits, quotient_bits, rest_bytes, right_bytes, prefix = _HEAD.unpack_from(data)
    view = memoryview(data)[_HEAD.size :]

    def take(size: int) -> memoryview:
        nonlocal view
        part, view = view[:size], view[size:]
        return part

    quotients = 1 << quotient_bits
    occupied = np.unpackbits(np.frombuffer(take(-(-quotients // 8)), dtype=np.uint8), count=quotients)
    run_end = np.unpackbits(np.frombuffer(take(-(-n // 8)), dtype=np.uint8), count=n)
    # the runs stand in the order of their quotients: a slot's run is the number of ends before it
    run = np.cumsum(run_end, dtype=np.int64) - run_end
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    rest = width - prefix_bits - quotient_bits
    left = (np.uint64(prefix) << np.uint64(width - prefix_bits)) | (quotient << np.uint64(rest))
    left = left | _values_of(take(n * rest_bytes), n, rest_bytes)
    right = _values_of(take(n * right_bytes), n, right_bytes)
    counts = np.frombuffer(take(n), dtype=np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(view, dtype="<i8")
    return Entries(left, right, counts)

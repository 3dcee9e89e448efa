"""Words of a text as 64-bit hashes, a whole text at a time in numpy."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
_ODD_1, _ODD_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

_CODES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
SPACE = (_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13))
DIGIT = (_CODES >= 48) & (_CODES <= 57)
UPPER = (_CODES >= 65) & (_CODES <= 90)
LETTER = UPPER | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)


def mix(hashes: np.ndarray) -> np.ndarray:
    """Spread the entropy of a hash over its high bits."""
    hashes = hashes * _ODD_1
    return (hashes ^ (hashes >> np.uint64(29))) * _ODD_2


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of True, and the True positions."""
    at = np.flatnonzero(inside)
    if not len(at):
        return at, at
    first = np.concatenate(([True], at[1:] != at[:-1] + 1))
    return np.flatnonzero(first), at


def hash_runs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each run of ``values`` (bytes), a run reaching to the next start."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = np.diff(np.append(starts, len(values)))
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    return np.add.reduceat(mix(_BYTE[values] * _PLACE[place & 4095]), starts)


def words(data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Hashes of the words (runs of bytes for which the table ``inside`` holds), A-Z lower-cased."""
    starts, at = runs(inside[data])
    return hash_runs(LOWER[data[at]], starts)

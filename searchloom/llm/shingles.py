"""Word shingles and universal hash minima of many texts at once, in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
PIECE = 1 << 20
SLICE = 1 << 15


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(n: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random odd multipliers, the same in every process."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Multipliers:
    """Multipliers by place in a word, as many as the longest word needs."""

    def __init__(self):
        self._values = drawn(64, 1)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self._values):
            self._values = drawn(2 * n, 1)
        return self._values


_PLACES = Multipliers()


def _pieces(content: bytes) -> Iterator[bytes]:
    """The content in pieces of about PIECE bytes, cut at white space, so that arrays over bytes stay small."""
    at = 0
    while len(content) - at > PIECE:
        cut = at + PIECE
        while cut < len(content) and not _SPACE[content[cut]]:
            cut += 1
        yield content[at:cut]
        at = cut
    yield content[at:]


def word_hashes(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(place of each word's first byte, 64-bit hash of each word) after lower-casing A-Z; words are cut at ASCII white space."""
    places, hashes, offset = [], [], 0
    for piece in _pieces(content):
        data = np.frombuffer(piece.translate(_LOWER), np.uint8)
        space = _SPACE[data]
        first = ~space
        first[1:] &= space[:-1]
        starts = np.flatnonzero(first)
        if len(starts):
            at = np.arange(len(data))
            at[starts[0] :] -= np.repeat(starts, np.diff(starts, append=len(data)))
            at[space] = 0
            values = (data.astype(np.uint64) + np.uint64(1)) * _PLACES.upto(int(at.max()) + 1)[at]
            values[space] = 0
            places.append(starts + offset)
            hashes.append(mixed(np.add.reduceat(values, starts)))
        offset += len(piece)
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


def _sets_of(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct hashes of the k-word shingles, sorted; of fewer words the one of all of them."""
    if not len(words):
        return words
    factors = drawn(k + 1, 2)
    n = min(k, len(words))
    total = np.full(len(words) - n + 1, factors[k] * np.uint64(n), np.uint64)
    for j in range(n):
        total += words[j : len(words) - n + 1 + j] * factors[j]
    return np.unique(mixed(total))


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """For each text the sorted array of its distinct shingle hashes; empty without words."""
    with np.errstate(over="ignore"):
        contents = [(t or "").encode() for t in texts]
        bounds = np.cumsum([0] + [len(c) + 1 for c in contents])
        places, hashes = word_hashes(b" ".join(contents))
        cuts = np.searchsorted(places, bounds)
        return [_sets_of(hashes[a:b], k) for a, b in zip(cuts[:-1], cuts[1:])]


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: sums of its members and of their second hashes."""
    with np.errstate(over="ignore"):
        second = mixed(values ^ np.uint64(0xD6E8FEB86659FD93))
        return int(values.sum(dtype=np.uint64).astype(np.int64)), int(second.sum(dtype=np.uint64).astype(np.int64))


def _minima_of(part: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    starts = np.cumsum([0] + [len(x) for x in part[:-1]])
    x = np.concatenate(part)
    found = np.empty((len(part), len(a)), np.uint32)
    for j in range(len(a)):
        found[:, j] = np.minimum.reduceat((x * a[j] + b[j]) >> np.uint64(32), starts)
    return found


def minima(sets: list[np.ndarray], count: int) -> np.ndarray:
    """One row of ``count`` universal hash minima (32 bits) for each set; sets must not be empty."""
    out = np.empty((len(sets), count), np.uint32)
    a, b = drawn(count, 3), drawn(count, 4)
    with np.errstate(over="ignore"):
        at = 0
        while at < len(sets):
            end, size = at + 1, len(sets[at])
            while end < len(sets) and size + len(sets[end]) <= SLICE:
                size += len(sets[end])
                end += 1
            if size <= SLICE:
                out[at:end] = _minima_of(sets[at:end], a, b)
            else:  # one large set, slice by slice
                out[at] = np.min([_minima_of([sets[at][i : i + SLICE]], a, b)[0] for i in range(0, size, SLICE)], axis=0)
            at = end
    return out


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """64-bit keys of the bands of each signature, different from band to band."""
    rows = signatures.shape[1] // bands
    with np.errstate(over="ignore"):
        parts = signatures[:, : rows * bands].reshape(-1, bands, rows).astype(np.uint64) * drawn(rows, 5)
        return mixed(mixed(parts).sum(axis=2, dtype=np.uint64) + drawn(bands, 6)).astype(np.int64)

"""Word and shingle hashes of a batch of texts, vectorised with numpy.

A word is a run of bytes other than ASCII white space, with A-Z lower-cased.
Its 64-bit hash comes from differences of the prefix sums of a polynomial
with random byte values, so a batch costs a few passes over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
for _c in range(0x41, 0x5B):  # A-Z hash as a-z
    _BYTE[_c] = _BYTE[_c + 32]
_STEP = np.random.default_rng(7).integers(1, 1 << 63, 16, dtype=np.uint64) | U(1)

KEPT_POWERS = 1 << 22
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n-1 and their inverses modulo 2**64 (those of a
    usual chunk are kept, longer texts' are made for the occasion)."""
    held = _powers if n <= KEPT_POWERS else [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    if len(held[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            a = np.full(1 << (n - 1).bit_length() if n <= KEPT_POWERS else n, base, np.uint64)
            a[0] = 1
            held[k] = np.multiply.accumulate(a)
    return held[0][:n], held[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def column_chunks(column: pa.Array, size: int) -> Iterator[pa.Array]:
    """A text column in parts of about ``size`` bytes together (a longer text alone)."""
    held = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)) if len(column) else []
    at = 0
    while at < len(column):
        before = held[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(held, before + size, "right")))
        yield column.slice(at, end - at)
        at = end


def text_chunks(column: pa.Array, size: int = 150_000) -> Iterator[list[bytes]]:
    """A text column's UTF-8 bytes (null as empty) in lists of about ``size``
    bytes together (a longer text alone), taken from the batch one by one."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for part in column_chunks(column, size):
        yield [t or b"" for t in part.cast(kind).to_pylist()]


def word_table(texts: list[bytes], strip: np.ndarray | None = None, prefixes: tuple[int, ...] = ()) -> tuple:
    """All words of the texts in order: the joined bytes, where words start
    and end in them, their hashes, and each text's first word (one entry more
    than texts); then the hashes of their first bytes, per length in
    ``prefixes``. ``strip`` marks bytes that separate words as white space does."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = (_SPACE if strip is None else _SPACE | strip)[joined]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    first, end = edge[::2], edge[1::2]
    power, inverse = powers(len(joined))
    total = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_BYTE[joined] * power, out=total[1:])
    hashes = mix((total[end] - total[first]) * inverse[first])
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    heads = [mix((total[np.minimum(first + n, end)] - total[first]) * inverse[first] + U(n)) for n in prefixes]
    return joined, first, end, hashes, np.searchsorted(first, begins), *heads


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin."""
    return word_table(texts)[3:5]


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``width``-word shingles; of
    fewer words the whole sequence is one shingle, of none the set is empty."""
    hashes, begins = word_hashes(texts)
    n = len(hashes) - width + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        rolled += hashes[k:k + n] * _STEP[k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(begins[:-1], begins[1:]):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            whole = (hashes[a:b] * _STEP[:b - a]).sum(dtype=np.uint64) + U(b - a)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out

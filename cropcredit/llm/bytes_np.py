"""Vectorised views of Arrow string columns: word bounds and 64-bit word hashes.

A word is a maximal run of ASCII letters, ASCII digits and non-ASCII characters, lower-cased.
The same rule in a regular expression over lower-cased text:
``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in blocks of about so many bytes (a longer text is a block of its own).
BLOCK_BYTES = 1 << 20

#: Runs up to this size are hashed eight bytes at a time, side by side; longer ones by BLAKE2b.
LONG_RUN = 1024
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the low k bytes

WORD = np.zeros(256, bool)
WORD[128:] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    WORD[_a:_b] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def as_strings(col) -> pa.LargeStringArray:
    """One array of 64-bit offset strings, nulls as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    return col.fill_null("") if col.null_count else col


def buffers(arr: pa.LargeStringArray):
    """(bytes, offsets) of an array of strings."""
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset: arr.offset + len(arr) + 1]
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[offs[0]: offs[-1]], offs - offs[0]


def blocks(arr: pa.LargeStringArray, block_bytes: int = BLOCK_BYTES):
    """Cut an array into runs of rows of about ``block_bytes`` bytes: yields (lo, hi)."""
    n = len(arr)
    if not n:
        return
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset: arr.offset + n + 1]
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + block_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte run [start, end): each eight bytes are mixed into the state by a finaliser that is no
    linear function of them, so regular texts don't collide as they do under polynomial hashes."""
    size = ends - starts
    out = mix(size.astype(np.uint64) + np.uint64(seed) + np.uint64(0x9E3779B97F4A7C15))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    on, k = np.flatnonzero((size > 0) & (size <= LONG_RUN)), 0
    while len(on):
        left = size[on] - k
        out[on] = mix(out[on] ^ (eight[starts[on] + k] & _LOW[np.minimum(left, 8)]))
        on, k = on[left > 8], k + 8
    for r in np.flatnonzero(size > LONG_RUN).tolist():
        h = hashlib.blake2b(data[starts[r]: ends[r]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little"))
        out[r] = np.uint64(int.from_bytes(h.digest(), "little"))
    return out


def runs(mask: np.ndarray, offs: np.ndarray):
    """Maximal runs of True that do not cross the text bounds ``offs``: (starts, ends, text)."""
    n = len(mask)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    inner = offs[(offs > 0) & (offs < n)]
    first[inner] = mask[inner]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    last[inner - 1] = mask[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offs, starts, "right") - 1


def words(arr: pa.LargeStringArray):
    """Words of a block of texts: (hash of each word, index of its text, bytes, starts, ends)."""
    data, offs = buffers(pc.utf8_lower(arr))
    starts, ends, text = runs(WORD[data], offs)
    return run_hashes(data, starts, ends), text, data, starts, ends


def first_of(text: np.ndarray, n: int) -> np.ndarray:
    """Offsets (n + 1) of each text's items in a list sorted by text."""
    return np.searchsorted(text, np.arange(n + 1), "left")


def word_digests(n_texts: int, text: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """128 bits of SHA-256 over each text's words, each followed by a blank (what ``words`` gives)."""
    size = ends - starts
    kept = data[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    joined = np.insert(kept, np.cumsum(size), 32)
    upto = np.concatenate([[0], np.cumsum(size + 1)])[first_of(text, n_texts)]
    raw = joined.tobytes()
    return [hashlib.sha256(raw[a:b]).digest()[:16] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]

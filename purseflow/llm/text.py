"""Words of many documents at once, as numpy arrays over the bytes of an Arrow batch.

No Python code runs per word: a block of whole documents is one byte array, words are
runs in it, and a word's 64-bit hash comes from a prefix sum of a polynomial modulo 2^64.
Such sums coincide for some long patterned words whatever the base is, so words above 63
bytes get xxhash instead. A document is never cut; a block is one long document if need be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 1 << 19

LONG_SPAN = 63
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SPACES = bytes([0x20, *range(0x09, 0x0E)])
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2^64
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lower(byte: int) -> int:
    return byte + 32 if 0x41 <= byte <= 0x5A else byte


IS_WORD = np.array([b not in _SPACES for b in range(256)])
IS_ALNUM = np.array(
    [0x30 <= _lower(b) <= 0x39 or 0x61 <= _lower(b) <= 0x7A or b >= 0x80 for b in range(256)]
)
BYTE_VALUE = mix((np.array([_lower(b) for b in range(256)], np.uint64) + np.uint64(1)) * _STEP)
# every byte has its own value: no two are equal to a tokenizer or a byte-wise comparison
EXACT_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(257)) * _STEP)
PLACE = mix((np.arange(1, 65, dtype=np.uint64)) * _STEP) | np.uint64(1)


def blocks(
    batch: pa.RecordBatch, column: str = "text", max_bytes: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) of runs of whole documents; null is empty."""
    texts = pc.fill_null(batch.column(column), "")
    wide = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    all_bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + max_bytes, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        here = offsets[row : end + 1]
        yield row, end, all_bytes[here[0] : here[-1]], here - here[0]
        row = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, start and end byte of every word; a document's end ends a word."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[:-1] = is_word[data]
    before = np.zeros(len(data) + 1, np.int8)
    before[1:] = inside[:-1]
    # a word at the end of one document must not run into the next one
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    starts_at = (inside == 1) & (before == 0)
    ends_at = (inside == 0) & (before == 1)
    starts_at[cuts] = inside[cuts] == 1
    ends_at[cuts] = before[cuts] == 1
    start, end = np.flatnonzero(starts_at), np.flatnonzero(ends_at)
    return np.searchsorted(offsets, start, side="right") - 1, start, end


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def prefix_sums(data: np.ndarray, values: np.ndarray | None = BYTE_VALUE) -> np.ndarray:
    """Sums for ``span_hashes``; without ``values`` the data are 64-bit values themselves."""
    up, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data if values is None else values[data]) * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans from prefix sums; equal bytes give equal hashes at any place."""
    _, down = _power_tables(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def span_sums(sums: np.ndarray, size: int) -> np.ndarray:
    """What ``span_hashes`` mixes, for the spans of ``size`` entries at every place."""
    n = len(sums) - size
    return (sums[size:] - sums[:n]) * _power_tables(len(sums))[1][:n]


def hash_long(
    hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False
) -> np.ndarray:
    """Replace, in place, the hashes of spans above 63 entries by those of another kind."""
    for i in np.flatnonzero(end - start > LONG_SPAN).tolist():
        raw = data[start[i] : end[i]].tobytes()
        hashes[i] = xxhash.xxh3_64_intdigest(raw.translate(_LOWER) if lower else raw)
    return hashes


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD
) -> tuple[np.ndarray, np.ndarray]:
    """Document number and hash (A-Z lower-cased) of every word, in order."""
    doc, start, end = word_spans(data, offsets, is_word)
    return doc, hash_long(span_hashes(prefix_sums(data), start, end), data, start, end, lower=True)


def shingles(words: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words and the place of their first word, within documents."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += words[j : j + n] * PLACE[j]
    place = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mix(total[place]), place


def whole_hash(words: np.ndarray) -> int:
    """Hash of a short word sequence that depends on its length as well."""
    parts = np.append(words * PLACE[: len(words)], PLACE[-1:] * np.uint64(len(words)))
    return int(mix(parts.sum(dtype=np.uint64, keepdims=True))[0])


def runs(doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Where each document's entries begin in an array ordered by document (n_docs + 1)."""
    return np.searchsorted(doc, np.arange(n_docs + 1))

"""Token ids of many documents with the ``tokenizers`` library, each distinct piece encoded once.

The pre-tokenizer of a byte-level BPE file never joins what stands on both sides of

* a non-space character followed by an ASCII space or line end, or
* an ASCII letter followed by one of ``, . ; : ! ?``,

so texts are cut there and the library encodes the pieces. A worker keeps the ids of the
pieces it has seen in a hash table of bounded size, whose only effect is on speed.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .piece_table import KEPT_PIECES, PieceTable
from .text import EXACT_VALUE, blocks, hash_long, prefix_sums, span_hashes

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[0x09, 0x0A, 0x0D, 0x20]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b",.;:!?")] = True
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
# first bytes of characters that may be spaces, and control characters some call spaces
_DOUBTFUL = np.zeros(256, bool)
_DOUBTFUL[[0xC2, 0xE1, 0xE2, 0xE3, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_ODD = _SPACE | _DOUBTFUL | (np.arange(256) < 0x20)


class Encoder(PieceTable):
    """Encodes whole texts; ``path`` names a tokenizer file of the ``tokenizers`` library."""

    def __init__(self, path: str, kept: int = KEPT_PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.line_end = self._direct(["\n"])[0]
        super().__init__(kept)

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _encode_lines(self, raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number of pieces without inner spaces, which the library gets as lines of one text."""
        flats, lengths = [], []
        for k in range(0, len(start), 20_000):
            pieces = [raw[s:e] for s, e in zip(start[k : k + 20_000].tolist(), end[k : k + 20_000].tolist())]
            ids = self._direct([b"\n".join(pieces).decode("utf-8", "replace")])[0]
            is_end = ids == self.line_end if len(self.line_end) == 1 else np.zeros(len(ids), bool)
            cuts = np.flatnonzero(is_end)
            if len(cuts) == len(pieces) - 1:
                flats.append(ids[~is_end])
                lengths.append(np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1)
            else:
                each = self._direct([p.decode("utf-8", "replace") for p in pieces])
                flats += each
                lengths.append(np.array([len(x) for x in each]))
        return np.concatenate([np.zeros(0, np.uint32), *flats]), np.concatenate([np.zeros(0, np.int64), *lengths])

    def _learn(self, data: np.ndarray, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        odd = np.concatenate([[0], np.cumsum(_ODD[data])])
        body = start + (data[start] == 0x20)
        plain = (odd[end] == odd[body]) & (end > body)
        raw = data.tobytes()
        self._add(keys[plain], *self._encode_lines(raw, start[plain], end[plain]))
        rest = [raw[s:e].decode("utf-8", "replace") for s, e in zip(start[~plain].tolist(), end[~plain].tolist())]
        ids = self._direct(rest)
        flat = np.concatenate([np.zeros(0, np.uint32), *ids])
        self._add(keys[~plain], flat, np.array([len(x) for x in ids], np.int64))

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of documents and where each document's ids begin (n + 1)."""
        n_docs = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n_docs + 1, np.int64)
        doubt = np.concatenate([[0], np.cumsum(_DOUBTFUL[data])])
        doubtful = np.repeat(doubt[offsets[1:]] > doubt[offsets[:-1]], np.diff(offsets))
        solid = np.where(doubtful, _SOLID[data], ~_SPACE[data] & (data >= 0x20))
        begins = np.zeros(len(data), bool)
        begins[1:] = (solid[:-1] & _BREAK[data[1:]]) | (_LETTER[data[:-1]] & _STOP[data[1:]])
        filled = offsets[:-1][np.diff(offsets) > 0]
        begins[filled] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(data))
        keys = hash_long(span_hashes(prefix_sums(data, EXACT_VALUE), start, end), data, start, end)
        keys[keys == 0] = 1
        ids, upto = self.look_up(keys, lambda new, at: self._learn(data, new, start[at], end[at]))
        return ids, upto[np.searchsorted(start, offsets)]

    def documents(self, batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of every row of the batch; a null text has none."""
        for first, end, data, offsets in blocks(batch, column):
            ids, bounds = self.encode_block(data, offsets)
            for i in range(end - first):
                yield first + i, ids[bounds[i] : bounds[i + 1]]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, loaded once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]

"""Token ids of merge-type (BPE) sentencepiece vocabularies, by an agenda of symbol pairs.

A text is normalised (a space in front, spaces as U+2581) and starts as single characters.
Neighbours whose joined string is a piece of the vocabulary stand in an agenda ordered by
the piece's score, then from left to right. The best pair is merged, its new neighbours
enter the agenda, and pairs that lost a part meanwhile are passed over. What ends as no
piece becomes its UTF-8 bytes. A long segment has a heap for its agenda; short ones are merged
many at a time, with a row of a matrix each.

No merge ever crosses a place whose two characters stand side by side in no piece (between
words, for one), so a text is cut there, and each distinct segment goes through the agenda
once per worker (``PieceTable``). Segments are found and looked up in numpy; a text is
never cut anywhere else, and a segment of any length is merged as a whole.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa

from .piece_table import KEPT_PIECES, PieceTable
from .text import blocks, hash_long, mix, prefix_sums, span_hashes

SPACE = "▁"  # how a vocabulary writes a space
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # kinds of pieces in a model file
MERGE_MODEL = 2
_LAST = 0x110000
_SHORT = 24  # characters of a segment up to which many are merged at once
_NEVER = np.int64(1) << 60


def _one_mark_per_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("purseflow.mark_bytes", _one_mark_per_byte)


class PieceCodec(PieceTable):
    """Encodes and decodes whole texts with the model file ``path``.

    Refused are models of another type, without byte pieces, with user-defined or unused
    pieces, or with a normalisation other than a space in front.
    """

    def __init__(self, path: str, kept: int = KEPT_PIECES) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if (
            model.trainer_spec.model_type != MERGE_MODEL
            or not model.trainer_spec.byte_fallback
            or model.trainer_spec.treat_whitespace_as_suffix
            or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not (norm.add_dummy_prefix and norm.escape_whitespaces)
        ):
            raise ValueError(f"{path}: only plain merge-type models with byte pieces and a space in front")
        normal = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type == NORMAL]
        self.ids_of = {piece: i for i, piece, _ in normal}
        # equal scores share a place in the order, so that the left one goes first
        levels = {s: n for n, s in enumerate(sorted({s for _, _, s in normal}, reverse=True))}
        self.order = {piece: levels[score] for _, piece, score in normal}
        self.byte_ids = [0] * 256
        surface = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:-1], 16)] = i
                surface.append(bytes([int(p.piece[3:-1], 16)]))
            elif p.type == CONTROL:
                surface.append(b"")
            elif p.type == UNKNOWN:
                surface.append(model.trainer_spec.unk_surface.encode())
            else:
                surface.append(p.piece.replace(SPACE, " ").encode())
        self.surface = pa.array(surface, pa.large_binary())
        self.silent = np.array([p.type == CONTROL for p in model.pieces])
        self.widths = np.array([len(s) for s in surface], np.int64)
        self.spaced = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in model.pieces])
        letters = sorted({c for _, piece, _ in normal for c in piece})
        self.letter = np.zeros(_LAST, np.int16 if len(letters) < 1 << 15 else np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        self._name_pairs(letters)
        pairs = np.array([(ord(a), ord(b)) for _, piece, _ in normal for a, b in zip(piece, piece[1:])])
        self.joined[self.letter[pairs[:, 0]], self.letter[pairs[:, 1]]] = True
        super().__init__(kept)

    def _name_pairs(self, letters: list[str]) -> None:
        """Numbers for all symbols, and for each pair that is a piece its place in the order and its symbol."""
        names = [*self.ids_of, *[c for c in letters if c not in self.ids_of]]
        number = {name: n for n, name in enumerate(names)}
        self.symbol_of_letter = np.array([-1, *[number[c] for c in letters]], np.int64)
        self.id_of_symbol = np.array([self.ids_of.get(name, -1) for name in names], np.int64)
        known = [
            (left * len(names) + right, self.order[piece], number[piece])
            for piece in self.ids_of
            for k in range(1, len(piece))
            if (left := number.get(piece[:k])) is not None and (right := number.get(piece[k:])) is not None
        ]
        table = np.array(sorted(known), np.int64).reshape(-1, 3)
        self.n_symbols, self.pair, self.pair_place, self.pair_symbol = len(names), *np.ascontiguousarray(table.T)

    def _places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair stands in the order; ``_NEVER`` if it is no piece."""
        keys = left * self.n_symbols + right
        at = np.minimum(np.searchsorted(self.pair, keys), len(self.pair) - 1)
        return np.where((self.pair[at] == keys) & (left >= 0) & (right >= 0), self.pair_place[at], _NEVER)

    def merge_rows(self, symbols: np.ndarray) -> np.ndarray:
        """``merge`` for many short segments at once: a row of symbols each, filled up with -1.

        A row of places is the agenda of a segment; every round takes the best pair of each row.
        """
        done = np.full_like(symbols, -1)
        row = np.arange(len(symbols))
        places = self._places(symbols[:, :-1], symbols[:, 1:])
        columns = np.arange(symbols.shape[1])
        while len(row):
            best = places.argmin(axis=1)  # the first of equal ones is the leftmost
            each = np.arange(len(row))
            over = places[each, best] == _NEVER
            done[row[over]] = symbols[over]
            go_on = ~over
            row, symbols, places, best = row[go_on], symbols[go_on], places[go_on], best[go_on]
            each = np.arange(len(row))
            keys = symbols[each, best] * self.n_symbols + symbols[each, best + 1]
            merged = self.pair_symbol[np.searchsorted(self.pair, keys)]
            # everything behind the pair moves up by one
            moved = columns + (columns > best[:, None])
            moved[:, -1] = np.minimum(moved[:, -1], symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, moved, 1)
            symbols[:, -1] = -1
            symbols[each, best] = merged
            places = np.take_along_axis(places, np.minimum(moved[:, :-1], places.shape[1] - 1), 1)
            places[:, -1] = _NEVER
            after = np.minimum(best, places.shape[1] - 1)
            places[each, after] = self._places(symbols[each, after], symbols[each, after + 1])
            inner = np.flatnonzero(best > 0)
            before = best[inner] - 1
            places[inner, before] = self._places(symbols[inner, before], symbols[inner, before + 1])
        return done

    def merge(self, segment: str) -> list[int]:
        """Ids of a normalised piece of text, all merges done in the agenda's order."""
        order, n = self.order, len(segment)
        symbol: list[str] = list(segment)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            place = order.get(segment[i : i + 2])
            if place is not None:
                agenda.append((place, i, i + 1, 2))
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            if not symbol[left] or not symbol[right] or len(symbol[left]) + len(symbol[right]) != size:
                continue  # a part was merged away meanwhile
            symbol[left] += symbol[right]
            symbol[right] = ""
            follower = after[left] = after[right]
            if follower < n:
                before[follower] = left
                pair = symbol[left] + symbol[follower]
                if (place := order.get(pair)) is not None:
                    heappush(agenda, (place, left, follower, len(pair)))
            if (leader := before[left]) >= 0:
                pair = symbol[leader] + symbol[left]
                if (place := order.get(pair)) is not None:
                    heappush(agenda, (place, leader, left, len(pair)))
        out: list[int] = []
        for s in symbol:
            if s:
                found = self.ids_of.get(s)
                out += [self.byte_ids[b] for b in s.encode()] if found is None else [found]
        return out

    def _learn(self, codes: np.ndarray, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        size = end - start
        short = (size > 1) & (size <= _SHORT)
        for at in np.array_split(np.flatnonzero(short), 1 + np.count_nonzero(short) // 20_000):
            if len(at):
                place = start[at][:, None] + np.arange(size[at].max())
                inside = place < end[at][:, None]
                symbols = np.where(inside, self.symbol_of_letter[self.letter[codes[np.where(inside, place, 0)]]], -1)
                merged = self.merge_rows(symbols)
                known = merged >= 0
                ids = np.where(known, self.id_of_symbol[merged], -1)
                whole = ~(known & (ids < 0)).any(axis=1)  # letters that are no piece become bytes
                short[at[~whole]] = False
                self._add(keys[at[whole]], ids[whole][known[whole]].astype(np.uint32), known[whole].sum(axis=1))
        at = np.flatnonzero(~short)
        found = [
            self.merge(codes[s:e].tobytes().decode("utf-32-le")) for s, e in zip(start[at].tolist(), end[at].tolist())
        ]
        lengths = np.array([len(x) for x in found], np.int64)
        self._add(keys[at], np.fromiter((i for x in found for i in x), np.uint32, int(lengths.sum())), lengths)

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of documents (UTF-8) and where each document's ids begin (n + 1)."""
        n_docs = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n_docs + 1, np.int64)
        characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        plain = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        filled = np.diff(characters) > 0
        codes = np.insert(plain, characters[:-1][filled], ord(SPACE))  # the space in front
        codes[codes == 0x20] = ord(SPACE)
        bounds = characters + np.concatenate([[0], np.cumsum(filled)])
        letter = self.letter[codes]
        begins = np.ones(len(codes), bool)
        begins[1:] = ~self.joined[letter[:-1], letter[1:]]
        begins[bounds[:-1][filled]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(codes))
        values = mix((codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        keys = hash_long(span_hashes(prefix_sums(values, None), start, end), codes, start, end)
        keys[keys == 0] = 1
        ids, upto = self.look_up(keys, lambda new, at: self._learn(codes, new, start[at], end[at]))
        return ids, upto[np.searchsorted(start, bounds)]

    def decode_block(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all documents and where each one's begin (n + 1).

        A first piece that begins with a space loses it, as the space in front isn't part
        of the text. Pieces that stand for nothing (begin, end) don't count as the first one.
        """
        flat = self.surface.take(pa.array(ids, pa.int32()))
        data = np.frombuffer(flat.buffers()[2], np.uint8) if len(ids) else np.zeros(0, np.uint8)
        upto = np.concatenate([[0], np.cumsum(self.widths[ids])])
        real = np.flatnonzero(self.widths[ids] > 0)
        first = np.searchsorted(real, bounds[:-1])
        some = first < len(real)
        opening = real[first[some]]
        opening = opening[opening < bounds[1:][some]]
        drop = upto[opening[self.spaced[ids[opening]]]]
        starts = upto[bounds]
        return np.delete(data[: upto[-1]], drop), starts - np.searchsorted(drop, starts)

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The decoded documents; a piece that stands for nothing parts the bytes around it."""
        data, starts = self.decode_block(ids, bounds)
        out = []
        for i in range(len(bounds) - 1):
            mine = ids[bounds[i] : bounds[i + 1]]
            if not self.silent[mine].any():
                out.append(as_text(data[starts[i] : starts[i + 1]].tobytes()))
                continue
            cuts = np.concatenate([[0], np.flatnonzero(self.silent[mine]), [len(mine)]])
            ends = np.concatenate([[0], np.cumsum(self.widths[mine])])[cuts]
            ends = np.maximum(starts[i + 1] - (ends[-1] - ends), starts[i])  # the space in front may be gone
            out.append("".join(as_text(data[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])))
        return out

    def documents(self, batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, bounds) of runs of whole documents; a null text has no ids."""
        for first, end, data, offsets in blocks(batch, column):
            yield first, end, *self.encode_block(data, offsets)


def as_text(raw: bytes) -> str:
    """Bytes of decoded pieces as text; each byte that isn't UTF-8 becomes one U+FFFD."""
    return raw.decode("utf-8", "purseflow.mark_bytes")


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The worker's codec of a model file, loaded once."""
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]

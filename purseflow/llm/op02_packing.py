"""Packing token sequences: best fit, then a local search that empties underfull bins.

Pieces are dealt into blocks of bounded size by hash. In a block they are packed best fit
decreasing; then documents are moved or exchanged (one for one, two for one) between
underfull bins as long as that raises the sum of squared fills, so the fuller bins fill up
and the emptier ones empty out. Bins that end up full are done. The pieces of the other
bins of all blocks are dealt anew into fewer blocks, until one block holds them, so blocks
cost no more than a few bins altogether.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table
from .tables import Workspace
from .tokens import encoder

CAPACITY = 2048
BLOCK_PIECES = 20_000
END_ID = 0

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit(lengths: Sequence[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that still has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            which = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, which = capacity, len(bins)
            bins.append([])
        bins[which].append(i)
        by_room[room - n].append(which)
        rooms |= 1 << (room - n)
    return bins


def improve(bins: list[list[int]], lengths: Sequence[int], capacity: int) -> list[list[int]]:
    """Local search over the underfull bins; full bins stay as they are.

    A step takes the fullest underfull bin and brings in, from an emptier bin, what fills it
    best: a document that fits (move), a longer document for one of its own (one for one), or
    two documents for one of its own (two for one). The squared fill grows with every step, so the
    search ends: when a sweep over all bins moves nothing, or when no smaller number of bins could
    hold the pieces. Every emptier bin is looked at: the sums of two of its lengths are the bits of one number.
    """
    size = [sum(lengths[i] for i in b) for b in bins]
    done = [b for b, s in zip(bins, size) if s == capacity]
    rest = {k: list(b) for k, (b, s) in enumerate(zip(bins, size)) if s < capacity}
    fill = {k: size[k] for k in rest}
    total = sum(fill.values())
    order = sorted((fill[k], k) for k in rest)  # emptiest first
    single: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]  # length -> (fill, item, bin), sorted
    have = 0
    sums: dict[int, int] = {}  # bin -> bit s: two of its items have s in all; made when needed

    def add(k: int) -> None:
        nonlocal have
        for i in rest[k]:
            insort(single[lengths[i]], (fill[k], i, k))
            have |= 1 << lengths[i]

    def drop(k: int) -> None:
        nonlocal have
        sums.pop(k, None)
        for i in rest[k]:
            entries = single[lengths[i]]
            del entries[bisect_left(entries, (fill[k], i, k))]
            if not entries:
                have &= ~(1 << lengths[i])

    def donor(length: int, target: int) -> tuple[int, int] | None:
        """An item of this length in a bin that is not fuller than the target."""
        for f, i, k in single[length]:  # emptiest bins first
            if f > fill[target]:
                return None
            if (f, k) < (fill[target], target):
                return i, k
        return None

    def longest(upto: int, above: int, target: int) -> tuple[int, int] | None:
        """The longest available item with above < length <= upto."""
        mask = have & ((1 << (upto + 1)) - 1) if upto >= 0 else 0
        while mask.bit_length() - 1 > above:
            n = mask.bit_length() - 1
            found = donor(n, target)
            if found:
                return found
            mask ^= 1 << n
        return None

    for k in rest:
        add(k)

    def two_sums(k: int) -> int:
        if k not in sums:
            found = seen = 0
            for i in rest[k]:
                found |= seen << lengths[i]
                seen |= 1 << lengths[i]
            sums[k] = found
        return sums[k]

    # two documents of one emptier bin against one of the target's; of equal gains the emptiest bin's
    def pair(room: int, own: list[int], target: int) -> tuple[int, list[int], int, int] | None:
        def wanted(above: int) -> int:
            """Bit s: s exceeds an own length by more than ``above`` and at most by ``room``."""
            span = ((1 << (room - above)) - 1) << (above + 1)
            out = 0
            for i in own:
                out |= span << lengths[i]
            return out

        best, gain, want = None, 0, wanted(0)
        for f, k in order:
            if (f, k) >= (fill[target], target):
                break
            if not two_sums(k) & want:
                continue
            within = ((1 << room) - 1) << 1
            gain, item = max((((sums[k] >> lengths[i]) & within).bit_length() - 1, i) for i in own)
            best = k, item
            if gain == room:
                break
            want = wanted(gain)
        if best is None:
            return None
        k, item = best
        both, at = lengths[item] + gain, {}
        for i in rest[k]:
            if both - lengths[i] in at:
                return gain, [i, at[both - lengths[i]]], item, k
            at[lengths[i]] = i
        raise AssertionError("the sum of two lengths has no such pair")

    def change(k: int, out: list[int], come: list[int]) -> None:
        nonlocal total
        del order[bisect_left(order, (fill[k], k))]
        total -= fill[k]
        drop(k)
        for i in out:
            rest[k].remove(i)
        rest[k] += come
        fill[k] = sum(lengths[i] for i in rest[k])
        if not rest[k]:
            del rest[k], fill[k]
        elif fill[k] == capacity:
            done.append(rest.pop(k))
            del fill[k]
        else:
            add(k)
            insort(order, (fill[k], k))
            total += fill[k]

    def step(k: int) -> bool:
        """Bring into bin ``k`` what fills it best; whether anything did."""
        room, own = capacity - fill[k], list({lengths[i]: i for i in rest[k]}.values())
        options: list[tuple[int, list[int], list[int], int]] = []
        moved = longest(room, 0, k)
        if moved:
            options.append((lengths[moved[0]], [moved[0]], [], moved[1]))
        if not moved or lengths[moved[0]] < room:
            for i in own:
                found = longest(lengths[i] + room, lengths[i], k)
                if found:
                    options.append((lengths[found[0]] - lengths[i], [found[0]], [i], found[1]))
            if not options or max(options)[0] < room:
                two = pair(room, own, k)
                if two:
                    options.append((two[0], two[1], [two[2]], two[3]))
        if not options:
            return False
        _, come, out, source = max(options, key=lambda o: (o[0], -len(o[1]) - len(o[2])))
        change(source, come, out)
        change(k, out, come)
        return True

    moved_any = True
    while moved_any and len(rest) > -(-total // capacity):
        moved_any = False
        for _, k in sorted(order, reverse=True):  # fullest first
            while k in rest and step(k):
                moved_any = True
            if len(rest) <= -(-total // capacity):
                break
    return done + list(rest.values())


def cut_documents(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every whole text's ids (and ``end_id``): full ones, after a shorter first one."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for row, ids in encoder(path).documents(batch):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                cut = len(ids) % capacity or capacity
                bounds = [0, *range(cut, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    rows.append((keys[row], k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, _PIECE)


def pack_block(block: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Number and offset in its bin of every piece of one block, and the bin's fill."""
    block = block.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
    lengths = block["length"].tolist()
    number, offset, filled = [0] * len(lengths), [0] * len(lengths), [0] * len(lengths)
    for k, items in enumerate(improve(best_fit(lengths, capacity), lengths, capacity)):
        at = 0
        for i in items:
            number[i], offset[i] = k, at
            at += lengths[i]
        for i in items:
            filled[i] = at
    return block.assign(bin=number, offset=offset, filled=filled)


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of at most ``capacity``.

    Pieces of the full length are sequences of their own. A task never holds more than about
    ``block_pieces`` pieces. Rows may repeat; other columns pass through.
    """
    work = Workspace(pieces, "packing")
    named = work.put(pieces.withColumn("uid", F.monotonically_increasing_id()))
    whole = named.where(F.col("length") >= capacity).select(
        "*", (F.col("uid") * 256).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    columns = named.columns
    result, rest = whole, named.where(F.col("length") < capacity)
    left, step = rest.count(), 0
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema)
    while left:
        step += 1
        blocks = -(-left // block_pieces)
        packed = work.put(
            rest.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(step)), F.lit(blocks)).cast("int"))
            .groupBy("block")
            .applyInPandas(
                lambda block: pack_block(block, capacity),
                f"{schema}, block int, bin long, offset long, filled long",
            )
        )
        full = F.col("filled") == capacity
        open_pieces = packed.where(~full).count()
        last = blocks == 1 or open_pieces > 0.9 * left or step == 200
        # 256 * block-wise number + round: no two rounds share a sequence
        mine = packed if last else packed.where(full)
        result = result.unionByName(
            mine.select(
                *columns,
                ((F.col("bin") * blocks + F.col("block")) * 256 + step).cast("long").alias("sequence_id"),
                "offset",
            )
        )
        if last:
            break
        rest, left = packed.where(~full).select(*columns), open_pieces
    return result.drop("uid")


def pack_documents(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All documents as pieces in sequences of at most ``capacity`` ids.

    Null and empty texts are a piece of the end id alone; rows may repeat or lack a doc_id,
    each is packed; an empty table gives no rows; other columns are ignored.
    """
    return pack(cut_documents(documents, path, capacity, end_id), capacity)


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))

"""Alignment of two tokenizers' tokens over the same bytes, and how often ids are linked.

A text with a space in front is encoded by a byte-level BPE file (A) and by a sentencepiece
model (B). Each side becomes an array of byte offsets where its tokens end. ``align_ends``
walks both arrays by diagonal run skipping: at the current shift between the two indices,
exponential probing compares ever longer stretches of the arrays, so a run of one-to-one
tokens is jumped in a logarithmic number of comparisons. Where the arrays differ, the group
up to the next common end is resolved token by token, which updates the shift.

``align`` returns the groups of every document. ``link_statistics`` counts over the whole
corpus how often each (A id, B id) is linked and folds these counts back into documents:

* Workers write chunks (some MB of whole documents) with the chunk's distinct pairs and, per
  document, places in that list of pairs; a common pair is one row per chunk, not per link.
* Spark sums the pairs. The highest count per B id has at most as many rows as the model
  has pieces, so it is broadcast.
* The sums go back to the chunks, one list per chunk, which a worker folds into documents.

Texts that are null or empty, or whose tokens don't give back the bytes (a text with U+2581
in it), have no tokens: zeros, empty arrays and an empty string instead of a digest. Rows
that repeat a doc_id or have none count like others. Other columns of the documents are
left out; an empty table gives an empty one. Texts are never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pieces import codec
from .registry import query, table
from .tables import Workspace
from .text import blocks, runs
from .tokens import encoder

CHUNK_LINKS = 1 << 20  # a chunk ends after so many links or documents; a document is never parted
CHUNK_DOCUMENTS = 4096
FIRST_PROBE = 2
_PAIR_SHIFT = 32


def align_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[int], list[int], list[int], list[int]]:
    """Walk two increasing arrays of token ends whose last entries are equal.

    Returns the A and B tokens inside irregular groups that end no group, and the links of
    the irregular groups as A and B tokens. All other tokens are linked one to one, in order.
    """
    raw_a, raw_b = ends_a.astype("<u4").tobytes(), ends_b.astype("<u4").tobytes()
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    inner_a: list[int] = []
    inner_b: list[int] = []
    linked_a: list[int] = []
    linked_b: list[int] = []
    i = j = 0
    n, m = len(list_a), len(list_b)
    while i < n and j < m:
        if list_a[i] == list_b[j]:
            # jump a run at this shift: probes double while equal, then halve to its end
            probe = FIRST_PROBE
            i, j = i + 1, j + 1
            while i + probe <= n and raw_a[4 * i : 4 * (i + probe)] == raw_b[4 * j : 4 * (j + probe)]:
                i, j, probe = i + probe, j + probe, 2 * probe
            while probe > 1:
                probe >>= 1
                if i + probe <= n and raw_a[4 * i : 4 * (i + probe)] == raw_b[4 * j : 4 * (j + probe)]:
                    i, j = i + probe, j + probe
            continue
        while True:
            linked_a.append(i)
            linked_b.append(j)
            here, there = list_a[i], list_b[j]
            if here < there:
                inner_a.append(i)
                i += 1
            elif there < here:
                inner_b.append(j)
                j += 1
            else:
                i, j = i + 1, j + 1
                break
    return inner_a, inner_b, linked_a, linked_b


def _byte_of_letter() -> dict[str, int]:
    """Byte-level files write each byte as a letter: visible ones as themselves, others from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Aligner:
    """Tokens, groups and links of blocks of whole documents, for one pair of vocabulary files."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = encoder(path_a), codec(path_b)
        letters = _byte_of_letter()
        vocabulary = self.a.tokenizer.get_vocab()
        surface = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            plain = all(c in letters for c in token)
            surface[i] = bytes(letters[c] for c in token) if plain else token.encode()
        self.surface_a = pa.array(surface, pa.large_binary())
        self.widths_a = np.array([len(s) for s in surface], np.int64)
        n = max(len(surface), len(self.b.widths))
        self.decimals = pa.array([f"{i}{sign}" for i in range(n) for sign in ",|;"], pa.large_string())
        self.decimal_widths = np.array([len(str(i)) + 1 for i in range(n)], np.int64)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> Block:
        sizes = np.diff(offsets)
        filled = sizes > 0
        spaced = np.insert(data, offsets[:-1][filled], 0x20)
        bounds = offsets + np.concatenate([[0], np.cumsum(filled)])
        ids_a, at_a = self.a.encode_block(spaced, bounds)
        ids_b, at_b = self.b.encode_block(data, offsets)
        whole = filled.copy()
        for ids, at, surface, widths in (
            (ids_a, at_a, self.surface_a, self.widths_a),
            (ids_b, at_b, self.b.surface, self.b.widths),
        ):
            ends = np.concatenate([[0], np.cumsum(widths[ids])])[at]
            if np.array_equal(ends, bounds) and np.array_equal(joined(surface, ids), spaced):
                continue
            bytes_here = joined(surface, ids)
            for d in np.flatnonzero(whole).tolist():
                whole[d] = np.array_equal(bytes_here[ends[d] : ends[d + 1]], spaced[bounds[d] : bounds[d + 1]])
        ids_a, at_a = _only(ids_a, at_a, whole)
        ids_b, at_b = _only(ids_b, at_b, whole)
        return Block(self, ids_a, at_a, ids_b, at_b)


def joined(surface: pa.Array, ids: np.ndarray) -> np.ndarray:
    """The bytes of all entries, one after the other."""
    if not len(ids):
        return np.zeros(0, np.uint8)
    found = surface.take(pa.array(ids, pa.int32()))
    ends = np.frombuffer(found.buffers()[1], np.int64)
    return np.frombuffer(found.buffers()[2], np.uint8)[: ends[len(ids)]]


def _only(ids: np.ndarray, at: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids without those of documents that are not whole."""
    if whole.all():
        return ids, at
    n = np.where(whole, np.diff(at), 0)
    return ids[np.repeat(whole, np.diff(at))], np.concatenate([[0], np.cumsum(n)])


class Block:
    """The aligned tokens of some documents; ``at_a`` and ``at_b`` say where a document's begin."""

    def __init__(self, aligner: Aligner, ids_a: np.ndarray, at_a: np.ndarray, ids_b: np.ndarray, at_b: np.ndarray) -> None:
        self.aligner, self.ids_a, self.at_a, self.ids_b, self.at_b = aligner, ids_a, at_a, ids_b, at_b
        ends_a, ends_b = np.cumsum(aligner.widths_a[ids_a]), np.cumsum(aligner.b.widths[ids_b])
        # documents end where both sides end, so one walk aligns all of them
        inner_a, inner_b, self.linked_a, self.linked_b = align_ends(ends_a, ends_b)
        self.last_a, self.last_b = np.ones(len(ids_a), bool), np.ones(len(ids_b), bool)
        self.last_a[inner_a] = False
        self.last_b[inner_b] = False
        self.groups_at = np.concatenate([[0], np.cumsum(self.last_a)])[at_a]

    def group_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """For every group, the A and the B tokens before its end, counted within its document."""
        doc = np.repeat(np.arange(len(self.at_a) - 1), np.diff(self.groups_at))
        return np.flatnonzero(self.last_a) + 1 - self.at_a[doc], np.flatnonzero(self.last_b) + 1 - self.at_b[doc]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Document and (A id, B id) of every link; the order within a document is free."""
        single_a, single_b = np.ones(len(self.ids_a), bool), np.ones(len(self.ids_b), bool)
        single_a[self.linked_a] = False
        single_b[self.linked_b] = False
        a = np.concatenate([np.flatnonzero(single_a), np.array(self.linked_a, np.int64)])
        b = np.concatenate([np.flatnonzero(single_b), np.array(self.linked_b, np.int64)])
        pair = (self.ids_a[a].astype(np.int64) << _PAIR_SHIFT) | self.ids_b[b].astype(np.int64)
        return np.searchsorted(self.at_a, a, side="right") - 1, pair

    def digests(self) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per document; the empty string without tokens."""
        ends_a, ends_b = np.flatnonzero(self.last_a) + 1, np.flatnonzero(self.last_b) + 1
        group_a, group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        code = np.zeros(len(self.ids_a) + len(self.ids_b), np.int64)
        # a token stands behind all of its own side and those of the other side in earlier groups (B: also its own group)
        code[np.arange(len(self.ids_a)) + np.concatenate([[0], ends_b])[group_a]] = 3 * self.ids_a.astype(np.int64) + self.last_a
        code[np.arange(len(self.ids_b)) + ends_a[group_b]] = 3 * self.ids_b.astype(np.int64) + 2 * self.last_b
        text = joined(self.aligner.decimals, code).tobytes()
        at = np.concatenate([[0], np.cumsum(self.aligner.decimal_widths[code // 3])])[self.at_a + self.at_b].tolist()
        return [hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(at[:-1], at[1:])]


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligned_blocks(batch: pa.RecordBatch, path_a: str, path_b: str) -> Iterator[tuple[int, int, Block]]:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    for first, end, data, offsets in blocks(batch):
        yield first, end, _aligners[path_a, path_b].block(data, offsets)


def _plain(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def align(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_ends, b_ends``: the tokens, and where each group ends among them."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, block in _aligned_blocks(batch, path_a, path_b):
                ends_a, ends_b = block.group_ends()
                lists = {
                    "a_ids": (block.at_a, block.ids_a), "b_ids": (block.at_b, block.ids_b),
                    "a_ends": (block.groups_at, ends_a), "b_ends": (block.groups_at, ends_b),
                }
                columns = {"doc_id": batch.column("doc_id").slice(first, end - first)}
                for name, (at, values) in lists.items():
                    columns[name] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"
    return _plain(documents).mapInArrow(aligned, schema)


_CHUNK = (
    "chunk long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "sha array<string>, at array<long>, places binary, pairs array<long>, counts array<long>"
)


def _chunk(number: int, parts: list[tuple[pa.Array, Block]]) -> pa.RecordBatch:
    """One row: documents, the distinct pairs (most frequent first), and each link's place among them."""
    found = [block.links() for _, block in parts]
    pairs, which, counts = np.unique(np.concatenate([p for _, p in found]), return_inverse=True, return_counts=True)
    by_count = np.argsort(-counts, kind="stable")
    place = np.empty(len(pairs), np.uint32)
    place[by_count] = np.arange(len(pairs), dtype=np.uint32)
    base = np.cumsum([0] + [len(ids) for ids, _ in parts])
    doc = np.concatenate([d + k for (d, _), k in zip(found, base)])
    order = np.lexsort((place[which], doc))
    # the bytes of all places side by side, low ones first, compress well
    planes = np.ascontiguousarray(place[which][order].view(np.uint8).reshape(-1, 4).T)
    row = {
        "chunk": number,
        "doc_ids": [i for ids, _ in parts for i in ids.to_pylist()],
        "n_a": np.concatenate([np.diff(b.at_a) for _, b in parts]),
        "n_b": np.concatenate([np.diff(b.at_b) for _, b in parts]),
        "n_groups": np.concatenate([np.diff(b.groups_at) for _, b in parts]),
        "sha": [s for _, b in parts for s in b.digests()],
        "at": runs(doc[order], int(base[-1])),
        "places": zstandard.ZstdCompressor(level=1).compress(planes.tobytes()),
        "pairs": pairs[by_count],
        "counts": counts[by_count],
    }
    kinds = {"doc_ids": pa.int64(), "sha": pa.string(), **dict.fromkeys(["n_a", "n_b", "n_groups", "at", "pairs", "counts"], pa.int64())}
    arrays = [
        pa.array([v], pa.int64() if k == "chunk" else pa.binary() if k == "places" else pa.list_(kinds[k]))
        for k, v in row.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(row))


def link_statistics(documents: DataFrame, path_a: str, path_b: str, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """Per document the numbers of tokens, groups and links, the digest of its groups, and over its links:

    ``n_best``, those whose pair is linked as often as any pair of its B id in the corpus, and
    ``count_sum``, the sum of the pairs' numbers of links.
    """
    work = Workspace(documents, "alignment")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[pa.Array, Block]] = []
        number, links, docs = 0, 0, 0
        for batch in batches:
            if batch.num_rows and not parts and not number:
                number = batch.column("part")[0].as_py() << 32
            for first, end, block in _aligned_blocks(batch, path_a, path_b):
                parts.append((batch.column("doc_id").slice(first, end - first), block))
                links += len(block.ids_a) + len(block.ids_b) - int(block.groups_at[-1])
                docs += end - first
                if links >= chunk_links or docs >= CHUNK_DOCUMENTS:
                    yield _chunk(number, parts)
                    parts, number, links, docs = [], number + 1, 0, 0
        if parts:
            yield _chunk(number, parts)

    known = work.put(_plain(documents).withColumn("part", F.spark_partition_id()).mapInArrow(chunks, _CHUNK))
    rows = known.select(
        "chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "pair")
    ).select("chunk", "place", "pair.pairs", "pair.counts").withColumnsRenamed({"pairs": "pair", "counts": "n"})
    totals = work.put(rows.groupBy("pair").agg(F.sum("n").alias("total")))
    piece = F.col("pair").bitwiseAND((1 << _PAIR_SHIFT) - 1)
    # at most one row per piece of the model
    top = totals.groupBy(piece.alias("piece")).agg(F.max("total").alias("top"))
    rated = totals.join(F.broadcast(top), piece == F.col("piece")).select(
        F.col("pair").alias("rated"), "total", (F.col("total") == F.col("top")).alias("best")
    )
    given = (
        rows.select("chunk", "place", "pair")
        .join(rated, F.col("pair") == F.col("rated"))
        .groupBy("chunk")  # a chunk has no more pairs than links, and these are bounded
        .agg(F.sort_array(F.collect_list(F.struct("place", "total", "best"))).alias("given"))
        .select("chunk", F.col("given.total").alias("totals"), F.col("given.best").alias("best"))
    )

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                planes = np.frombuffer(zstandard.decompress(row["places"].as_buffer()), np.uint8)
                places = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()
                at = row["at"].values.to_numpy()
                sums = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
                if len(places):
                    totals = row["totals"].values.to_numpy()
                    best = row["best"].values.to_numpy(zero_copy_only=False).astype(np.int64)
                    sums = [np.concatenate([[0], np.cumsum(v[places])]) for v in (best, totals)]
                n_a, n_b, n_groups = (row[c].values.to_numpy() for c in ("n_a", "n_b", "n_groups"))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": row["doc_ids"].values, "n_a": n_a, "n_b": n_b, "n_groups": n_groups,
                        "n_links": n_a + n_b - n_groups,
                        "n_best": np.diff(sums[0][at]), "count_sum": np.diff(sums[1][at]),
                        "groups_sha256": row["sha"].values,
                    }
                )

    # Spark bounds the bytes of a batch, so a worker holds a few chunks at a time
    return known.drop("pairs", "counts").join(given, "chunk", "left").mapInArrow(
        folded,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )


@query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of all documents between byte_bpe_50k.json and piece_bpe_32k.model."""
    path = public_tokenizers.path
    return link_statistics(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))

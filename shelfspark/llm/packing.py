"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Documents are tokenised where they are read and cut into pieces of at most ``capacity`` tokens.  A full piece is a sequence
by itself and is not moved.  The others are dealt at random to groups of about ``group_pieces`` pieces, and each group is
packed by best-fit decreasing: pieces by falling length, each into the open sequence whose remaining room is the least that
suffices, found in logarithmic time with a segment tree over the remaining capacities.  A group of many pieces is a fair
sample of all lengths and ends with at most one sequence that is half empty or more (otherwise its last piece would have
gone into another), so cutting N pieces into groups costs at most N / group_pieces sequences, whatever N is."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import text_rows
from shelfspark.llm.tokens import encoder
from shelfspark.session import cut_lineage

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


class CapacityTree:
    """Open bins by remaining capacity 1..``top``, as a segment tree of occupied capacities."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.used = bytearray(2 * self.leaves)
        self.bins: list[list] = [[] for _ in range(top + 1)]

    def put(self, room: int, bin_: tuple) -> None:
        self.bins[room].append(bin_)
        node = self.leaves + room
        while node and not self.used[node]:
            self.used[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, tuple] | None:
        """Removes and returns (room, bin) with the smallest room of at least ``least``."""
        node = self.leaves + least
        while not self.used[node]:
            while node & 1:  # right children have nothing to their right below this ancestor
                node >>= 1
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.used[2 * node] else 2 * node + 1
        room = node - self.leaves
        bin_ = self.bins[room].pop()
        if not self.bins[room]:
            while node and not (node < self.leaves and (self.used[2 * node] or self.used[2 * node + 1])):
                self.used[node] = 0
                node >>= 1
        return room, bin_


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset in the bin of each length (0 < length <= capacity)."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, opened = CapacityTree(capacity), 0
    for at in np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist():
        length = lengths[at]
        found = tree.take(length)
        if found is None:
            room, bin_ = capacity, opened
            opened += 1
        else:
            room, bin_ = found
        bins[at], offsets[at] = bin_, capacity - room
        if room > length:
            tree.put(room - length, bin_)
    return bins, offsets


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each piece of each document: ``doc_id``, ``piece`` (from 0), ``start`` (the document's ids before it),
    ``length``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers), and these ``ids`` (binary) on demand.
    A document's ids are the tokenizer's and ``end_id``; a NULL or empty text has ``end_id`` alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4")
        for batch in batches:
            cells: dict[str, list] = {c: [] for c in names}
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                ids = np.concatenate([ids, end])
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    for c, v in zip(names, (doc_id, k, at, len(part), zlib.crc32(part), part.tobytes() if with_ids else None)):
                        cells[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cells[c], t) for c, t in names.items()], list(names))

    names = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()} | ({"ids": pa.binary()} if with_ids else {})
    return text_rows(docs, id_col, text_col).mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def pack(pieces: DataFrame, capacity: int = 2048, group_pieces: int = 32768) -> DataFrame:
    """``pieces`` (any columns, among them ``length`` of 1..capacity) with ``sequence_id`` and ``offset`` added.  It must be
    a written table: rows are dealt out by their place in it.  The pieces of a sequence are gapless from 0."""
    row = F.monotonically_increasing_id()
    whole = pieces.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - row).withColumn("offset", F.lit(0).cast("long"))
    part = pieces.where(F.col("length") < capacity)
    groups, names = max(1, -(-part.count() // group_pieces)), whole.columns

    def run(table: pa.Table) -> pa.Table:
        bins, offsets = best_fit_decreasing(table.column("length").to_pylist(), capacity)
        table = table.append_column("sequence_id", pa.array((table.column("group")[0].as_py() << 32) + bins))
        return table.append_column("offset", pa.array(offsets)).select(names)

    dealt = part.withColumn("group", F.pmod(F.xxhash64(row), F.lit(groups)))
    return whole.unionAll(dealt.groupBy("group").applyInArrow(run, whole.schema))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, group_pieces: int = 32768) -> DataFrame:
    """The pieces of all documents (see :func:`token_pieces`) with ``sequence_id`` and ``offset``.

    Repeated rows are packed as often as they come, NULL ids like any other; equal lengths go in table order; an empty
    table gives an empty result; extra columns take no part."""
    pieces = cut_lineage(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids), "pieces")
    return pack(pieces, capacity, group_pieces)

"""Removal of byte strings of at least ``length`` bytes that start anywhere else too, by sorting suffixes.

A suffix array of the whole corpus would write each byte's suffix; only suffixes that can have a partner are sorted here.

1. *Anchors.*  Of the K-byte strings inside a window of ``length`` bytes, the one with the least hash (leftmost of equals) is
   the window's anchor.  It depends on the window's bytes alone, so equal windows have equal anchors at equal offsets.
   Neighbouring windows share an anchor and make a *context*: all windows of one place with that anchor.
2. *Partners.*  Anchors are counted by hash (map-side combined).  A context whose anchor occurs nowhere else has no repeated
   window.  Where all contexts of an anchor are equal, every window is repeated.  The rest goes on.
3. *Deep-shallow sort.*  The distinct contexts of an anchor meet in one task.  Their windows are sorted as suffixes: multikey
   quicksort (three-way partition by eight bytes a step) to the shallow depth; suffixes that are still equal are ordered by a
   blind trie, which compares each with one leaf and branches where they part, and whose in-order walk gives the ranks.  Two
   neighbours that do not part within ``length`` bytes are a repeat.  A context that occurs twice as a whole (equal anchor and
   equal digest of 128 bits) is repeated in all its windows.
4. An anchor with more than ``anchor_contexts`` distinct contexts (a line that a third of all documents hold, each time in
   other surroundings) is not sorted in one task: its windows are counted by two hashes, map-side combined, without limit.

Documents are keyed by their content: copies are worked on once, and their contexts count as often as they occur."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import text_rows
from shelfspark.session import cut_lineage

#: Bytes of an anchor; bytes handled at a time; depth at which tries take over.
ANCHOR, BLOCK, SHALLOW = 32, 1 << 20, 32
#: Documents' keys up to this number are broadcast to leave the others out of a shuffle of texts (16 bytes each).
BROADCAST_KEYS = 1_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * ODD
    return h ^ (h >> np.uint64(29))


def _string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of each string of ``length`` bytes, from hashes of strings of 1, 2, 4.. bytes."""
    h, k = _mix(data.astype(np.uint64) + np.uint64(1)), 1
    while 2 * k <= length:
        h, k = _mix(h[:-k] * np.uint64(0xD6E8FEB86659FD93) + h[k:]), 2 * k
    n = len(data) - length + 1
    return h if k == length else _mix(h[:n] * np.uint64(0xA0761D6478BD642F) + h[length - k : length - k + n])


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    m, k = v, 1
    while 2 * k <= width:
        m, k = np.minimum(m[:-k], m[k:]), 2 * k
    n = len(v) - width + 1
    return np.minimum(m[:n], m[width - k : width - k + n])


def contexts_of(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, context digest (128 bits), first window and number of windows of each context of a document."""
    out = [(np.zeros(0, np.uint64), np.zeros(0, object), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    place = np.uint64(BLOCK * 2 - 1)
    for base in range(0, len(data) - length + 1, BLOCK):
        part = data[base : base + BLOCK + length - 1]
        h = _string_hashes(np.frombuffer(part, np.uint8), ANCHOR)
        least = _sliding_min((h & ~place) | np.arange(len(h), dtype=np.uint64), length - ANCHOR + 1)
        at = (least & place).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        count = np.diff(np.append(first, len(at)))
        anchor = at[first]
        own = [xxhash.xxh128_digest(part[s : s + n + length - 1], a - s) for s, n, a in zip(first.tolist(), count.tolist(), anchor.tolist())]
        out.append((h[anchor], np.array(own, object), first + base, count))
    return tuple(np.concatenate(c) for c in zip(*out))


class BlindTrie:
    """Orders strings by their first ``depth`` bytes; an inner node knows where its strings part, not what they share."""

    def __init__(self, data: bytes, depth: int):
        self.data, self.depth, self.root = data, depth, None

    def _common(self, p: int, q: int) -> int:
        a, b = self.data[p : p + self.depth], self.data[q : q + self.depth]
        if a == b:
            return self.depth
        return (8 * self.depth - (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length()) // 8

    def insert(self, p: int) -> None:
        """Adds the string at ``p``: one leaf is found by the parting bytes alone and compared, then the new branch goes where
        the two part.  Equal strings share a leaf."""
        data, node = self.data, self.root
        if node is None:
            self.root = [p]
            return
        while type(node) is tuple:
            found = node[1].get(data[p + node[0]])
            node = found if found is not None else next(iter(node[1].values()))
        leaf, common = node, self._common(p, node[0])
        if common == self.depth:
            leaf.append(p)
            return
        above, node = None, self.root
        while type(node) is tuple and node[0] < common:
            above, node = node, node[1][data[p + node[0]]]
        if type(node) is tuple and node[0] == common:
            node[1][data[p + common]] = [p]
            return
        new = (common, {data[leaf[0] + common]: node, data[p + common]: [p]})
        if above is None:
            self.root = new
        else:
            above[1][data[p + above[0]]] = new

    def leaves(self) -> Iterator[list[int]]:
        """The strings' places in order, equal strings together: an in-order walk."""
        stack = [] if self.root is None else [self.root]
        while stack:
            node = stack.pop()
            if type(node) is tuple:
                stack += [node[1][byte] for byte in sorted(node[1], reverse=True)]
            else:
                yield node


def _multikey_quicksort(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts``, within each run of ``sizes``, by their first ``depth`` bytes (a multiple of 8), and
    (first, end) of the groups in it that are still equal.  All groups are partitioned side by side: below, equal to and above the eight bytes of a pivot at the
    group's depth; the equal part goes eight bytes deeper."""
    order = np.arange(len(starts))
    first, size = (np.cumsum(sizes) - sizes)[sizes > 1], sizes[sizes > 1]
    level = np.zeros(len(size), np.int64)
    deep_first, deep_size = [], []
    while len(first):
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        own, begin = order[at], np.cumsum(size) - size
        key = words[starts[own] + np.repeat(level, size)]
        a, b, c = key[begin], key[begin + size // 2], key[begin + size - 1]
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), size)
        parts, place = [key < pivot, key == pivot, key > pivot], np.repeat(first, size)
        counts = [np.add.reduceat(p, begin, dtype=np.int64) for p in parts]
        for part, count in zip(parts, counts):
            rank = np.cumsum(part) - 1
            before = rank[begin] - part[begin] + 1  # of the part in the groups before
            order[(place + rank - np.repeat(before, size))[part]] = own[part]
            place = place + np.repeat(count, size)
        starts_of = [first, first + counts[0], first + counts[0] + counts[1]]
        first, level_, size = np.concatenate(starts_of), np.concatenate([level, level + 8, level]), np.concatenate(counts)
        ended = (size > 1) & (level_ >= depth)
        deep_first.append(first[ended])
        deep_size.append(size[ended])
        go = (size > 1) & ~ended
        first, size, level = first[go], size[go], level_[go]
    begin, size = np.concatenate([np.zeros(0, np.int64), *deep_first]), np.concatenate([np.zeros(0, np.int64), *deep_size])
    return order, begin, begin + size


def sorted_suffixes(data: bytes, starts: np.ndarray, length: int, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, equal): the suffixes at ``starts`` by their first ``length`` bytes (within runs of ``sizes``, if given), and
    whether each is equal in them to the one before it in that order.  Multikey quicksort to the shallow depth; a blind trie orders each group left."""
    equal = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return np.arange(len(starts)), equal
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    words = np.zeros(len(raw) - 7, np.uint64)
    for k in range(8):
        words |= raw[k : k + len(words)] << np.uint64(56 - 8 * k)
    order, begin, end = _multikey_quicksort(words, starts, np.array([len(starts)]) if sizes is None else sizes, min(SHALLOW, length // 8 * 8))
    for a, b in zip(begin.tolist(), end.tolist()):
        members, trie = order[a:b], BlindTrie(data, length)
        number = dict(zip(starts[members].tolist(), members.tolist()))
        for p in number:
            trie.insert(p)
        for leaf in trie.leaves():
            order[a : a + len(leaf)] = [number[p] for p in leaf]
            equal[a + 1 : a + len(leaf)] = True
            a += len(leaf)
    return order, equal


def repeated_suffixes(data: bytes, starts: np.ndarray, length: int, sizes: np.ndarray | None = None) -> np.ndarray:
    """Which of the suffixes at the (distinct) ``starts`` share their first ``length`` bytes with another of them (of their run),
    that is, with a neighbour in their order."""
    order, equal = sorted_suffixes(data, starts, length, sizes)
    repeated = np.zeros(len(starts), bool)
    repeated[order] = equal | np.append(equal[1:], False)[: len(equal)]
    return repeated


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce("text", F.lit(b""))
    rows = text_rows(docs, id_col, text_col, binary=True).withColumn("text", text)
    return rows.select("doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "text")


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    """One row for each context of each document of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            parts, sizes = [], []
            for text in batch.column("text"):
                parts.append(contexts_of(text.as_py(), length))
                sizes.append(len(parts[-1][0]))
            anchor, context, first, count = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, object), *[np.zeros(0, np.int64)] * 2)
            of = np.repeat(np.arange(batch.num_rows), sizes)
            cells = [batch.column(k).take(pa.array(of)) for k in ("k1", "k2")] + [pa.array(anchor.view(np.int64)), pa.array(context, pa.binary()), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cells, ["k1", "k2", "anchor", "context", "first", "count"])

    return rows.where(F.length("text") >= length).select("k1", "k2", "text").mapInArrow(run, "k1 long, k2 long, anchor long, context binary, first int, count int")


def _chosen(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose ``keys`` are in ``wanted``; with few keys the others do not enter the join that follows."""
    ids = cut_lineage(wanted.select(*keys).distinct(), "wanted-documents")
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_KEYS else ids, keys, "left_semi")


def _sorted_contexts(length: int, at_once: int = 1 << 20):
    """Anchors' contexts (sorted by anchor) to the repeated windows of the contexts that occur once."""

    def flush(rows: list) -> pa.RecordBatch:
        out, lengths = [], np.array([len(r[-1]) for r in rows], np.int64)
        base = np.cumsum(lengths) - lengths
        counts = lengths - length + 1
        starts = np.repeat(base - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        anchor = np.array([r[4] for r in rows], np.int64)  # equal windows have equal anchors
        sizes = np.add.reduceat(counts, np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])))
        flags = repeated_suffixes(b"".join(r[-1] for r in rows), starts, length, sizes)
        begin = 0
        for (k1, k2, first, times, _, _), n in zip(rows, counts.tolist()):
            if times == 1:
                out += [(k1, k2, first + a, first + b) for a, b in _runs(flags[begin : begin + n])]
            begin += n
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], ["k1", "k2", "first", "last"])

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "first", "times", "anchor", "bytes"))):
                if held >= at_once and row[4] != last:  # all contexts of an anchor stay together
                    yield flush(rows)
                    rows, held = [], 0
                rows.append(row)
                held, last = held + len(row[-1]), row[4]
        if rows:
            yield flush(rows)

    return run


def _window_hashes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, first, times, data in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "first", "times", "bytes"))):
                raw = np.frombuffer(data, np.uint8)
                h, other = _string_hashes(raw, length).view(np.int64), _string_hashes(~raw, length).view(np.int64)
                n = len(h)
                yield pa.RecordBatch.from_arrays([pa.array([k1] * n, pa.int64()), pa.array([k2] * n, pa.int64()), pa.array(np.arange(first, first + n, dtype=np.int32)), pa.array([times] * n, pa.int64()), pa.array(h), pa.array(other)], ["k1", "k2", "first", "times", "hash", "other"])

    return run


def repeated_windows(rows: DataFrame, length: int = 200, anchor_contexts: int = 4096) -> DataFrame:
    """``k1``, ``k2``, ``first``, ``last``: in the document with that key, every window that starts at first..last-1 also starts
    elsewhere.  ``rows``: see :func:`_documents`."""
    anchors = cut_lineage(_anchors(rows, length), "anchors")
    sides = [F.xxhash64("context"), F.xxhash64(F.lit(1), "context")]  # longs, for a hash aggregate
    several = (F.min(sides[0]) != F.max(sides[0])) | (F.min(sides[1]) != F.max(sides[1]))
    shared = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), several.alias("several")).where("n > 1").select("anchor", "several")
    shared = cut_lineage(shared, "anchors-counted")  # written, so that the join's large partitions can be split
    met = cut_lineage(anchors.join(shared, "anchor"), "shared-anchors")
    span = ["k1", "k2", "first", (F.col("first") + F.col("count")).cast("int").alias("last")]
    copies = met.where("not several").select(*span)

    # of anchors with several contexts: each context once, with the number of its places and one of them
    place = F.struct("k1", "k2", "first", "count")
    distinct = met.where("several").groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("at"))
    width = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"))
    open_ = cut_lineage(distinct.join(width, "anchor").select("anchor", "context", "times", "contexts", "at.k1", "at.k2", "at.first", "at.count"), "contexts")
    again = met.where("several").join(open_.where("times > 1").select("anchor", "context"), ["anchor", "context"], "left_semi").select(*span)

    # their bytes, from one document of each content
    lowest = rows.groupBy("k1", "k2").agg(F.min(F.coalesce("doc_id", F.lit(0))).alias("low"))
    sources = lowest.join(open_.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    one = _chosen(rows.withColumn("low", F.coalesce("doc_id", F.lit(0))), sources, ["k1", "k2", "low"])
    text = one.select("k1", "k2", "text")
    sliced = open_.join(text, ["k1", "k2"]).select("anchor", "context", "times", "contexts", "k1", "k2", "first", F.substring("text", F.col("first") + 1, F.col("count") + (length - 1)).alias("bytes"))
    sliced = cut_lineage(sliced, "context-bytes")
    near = sliced.where(F.col("contexts") <= anchor_contexts).dropDuplicates(["anchor", "context"])
    near = near.repartition("anchor").sortWithinPartitions("anchor", "context")
    sorted_ = near.mapInArrow(_sorted_contexts(length), "k1 long, k2 long, first int, last int")
    hashed = sliced.where(F.col("contexts") > anchor_contexts).dropDuplicates(["anchor", "context"]).mapInArrow(_window_hashes(length), "k1 long, k2 long, first int, times long, hash long, other long")
    common = hashed.groupBy("hash", "other").agg(F.sum("times").alias("n")).where("n > 1").select("hash", "other")
    counted = hashed.where("times = 1").join(common, ["hash", "other"], "left_semi").select("k1", "k2", "first", (F.col("first") + 1).cast("int").alias("last"))
    return copies.unionAll(again).unionAll(sorted_).unionAll(counted)


def kept_bytes(data: bytes, windows: list[tuple[int, int]], length: int) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a document, and the maximal removed runs."""
    runs: list[list[int]] = []
    for first, last in sorted(windows):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last - 1 + length)
        else:
            runs.append([first, last - 1 + length])
    kept, at = [], 0
    for a, b in runs:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]]), [tuple(r) for r in runs]


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", anchor_contexts: int = 4096) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``spans`` (first, last byte + 1),
    ``kept`` (the remaining bytes; NULL where nothing is removed), ``kept_sha256``: one row for each row of ``docs``.

    Each byte covered by a string of ``length`` bytes that starts anywhere else too, in the same document or another, is
    removed, every copy alike; strings are judged on the input.  NULL is an empty text.  Repeated rows are copies of one
    another; documents shorter than ``length`` stay whole; an empty table gives an empty result."""
    if length < ANCHOR + 8:
        raise ValueError(f"length must be {ANCHOR + 8} or more")
    rows = _documents(docs, id_col, text_col)
    windows = repeated_windows(rows, length, anchor_contexts)
    per_doc = cut_lineage(windows.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("windows")), "repeated-windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k1, k2, data, own in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text", "windows"))):
                kept, runs = kept_bytes(data, [(w["first"], w["last"]) for w in own], length)
                out.append((k1, k2, len(data) - len(kept), [{"first": a, "last": b} for a, b in runs], kept, hashlib.sha256(kept).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], ["k1", "k2", "n_removed", "spans", "kept", "kept_sha256"])

    lowest = rows.groupBy("k1", "k2").agg(F.min(F.coalesce("doc_id", F.lit(0))).alias("low"))
    wanted = lowest.join(per_doc.select("k1", "k2"), ["k1", "k2"], "left_semi")
    one = _chosen(rows.withColumn("low", F.coalesce("doc_id", F.lit(0))), wanted, ["k1", "k2", "low"])
    cut = one.join(per_doc, ["k1", "k2"]).select("k1", "k2", "text", "windows").mapInArrow(run, "k1 long, k2 long, n_removed long, spans array<struct<first:int,last:int>>, kept binary, kept_sha256 string")
    cut = cut_lineage(cut, "cut-documents").dropDuplicates(["k1", "k2"])
    every = rows.select("doc_id", "k1", "k2", F.length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own"))
    return every.join(cut, ["k1", "k2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "spans", "kept", F.coalesce("kept_sha256", "own").alias("kept_sha256")
    )

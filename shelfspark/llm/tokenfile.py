"""Token files: one array of ids, document boundaries and document ids as Elias-Fano sequences.

File layout (little-endian)::

    magic "EFTOK001" | ids, 2 or 4 bytes each | boundaries | doc ids | trailer

*Boundaries* are the n + 1 rising offsets of the documents in the array; *doc ids* are the n rising ids less the first.
Both are stored as Elias-Fano sequences: of each value the ``low_bits`` low bits are packed side by side, the rest is a bit
vector in which the i-th one stands at (value >> low_bits) + i, 2 + log2(range / n) bits a value in all.  Every 256th one's
place is kept as an unsigned 32-bit number, so that ``select`` scans a few dozen bytes; there is no table of 64-bit offsets.

Files are written by range of document id: names sort as the ids do, a file's first offset is the sum of the files before it.
A task writes under a name of its own attempt and renames it when complete, so a repeated attempt leaves no half file.  The
folder must be one that driver and executors share; any scheme that ``pyarrow.fs`` opens will do."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import text_rows
from shelfspark.llm.tokens import encoder
from shelfspark.session import cut_lineage

MAGIC = b"EFTOK001"
SAMPLE = 256
#: Documents read back at a time.
READ_DOCS = 1024
#: Text that a file is made of.
FILE_BYTES = 512 << 20
#: bytes an id, documents, documents without id, first document id, then (place, count, low bits, low bytes, high bytes) twice
TRAILER = struct.Struct("<BQQq" + "QQBQQ" * 2)


def elias_fano(values: np.ndarray) -> tuple[tuple[int, int, int, int], bytes]:
    """(count, low bits, low bytes, high bytes) and the bytes of rising unsigned ``values``."""
    n, top = len(values), int(values[-1]) if len(values) else 0
    low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
    high = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    if n and int(high[-1]) >> 32:
        raise ValueError("too many documents for one file")
    vector = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
    vector[high] = 1
    low = bytearray()
    for start in range(0, n, 65536):  # a multiple of 8 values fills whole bytes
        bits = (values[start : start + 65536, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low += np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    parts = [bytes(low), np.packbits(vector, bitorder="little").tobytes(), high[::SAMPLE].astype("<u4").tobytes()]
    return (n, low_bits, len(parts[0]), len(parts[1])), b"".join(parts)


class EliasFano:
    """Random access to a stored sequence."""

    def __init__(self, raw: bytes, n: int, low_bits: int, low_bytes: int, high_bytes: int):
        raw = np.frombuffer(raw, np.uint8)
        self.n, self.low_bits = n, low_bits
        self.low, self.high = raw[:low_bytes], raw[low_bytes : low_bytes + high_bytes]
        self.samples = raw[low_bytes + high_bytes :].view("<u4")

    def select(self, first: int, last: int) -> np.ndarray:
        """Places of the ones number first..last-1 in the bit vector."""
        block, end = first // SAMPLE, -(-last // SAMPLE)
        start = int(self.samples[block]) // 8
        stop = int(self.samples[end]) // 8 + 1 if end < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[start:stop], bitorder="little")) + 8 * start
        ones = ones[ones >= self.samples[block]]
        return ones[first - block * SAMPLE : last - block * SAMPLE]

    def values(self, first: int, last: int) -> np.ndarray:
        """The values number first..last-1."""
        if first >= last:
            return np.zeros(0, np.uint64)
        high = (self.select(first, last) - np.arange(first, last)).astype(np.uint64)
        if not self.low_bits:
            return high
        from_bit, to_bit = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[from_bit // 8 : -(-to_bit // 8)], bitorder="little")[from_bit % 8 :][: to_bit - from_bit]
        low = bits.reshape(-1, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)
        return high << np.uint64(self.low_bits) | low.sum(axis=1, dtype=np.uint64)


class TokenFileWriter:
    """Appends documents in rising order of id (None first); memory holds one number for each document."""

    def __init__(self, out, id_bytes: int):
        self.out, self.id_bytes = out, id_bytes
        self.out.write(MAGIC)
        self.ends, self.doc_ids, self.without_id = [0], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> (8 * self.id_bytes):
            raise ValueError(f"id {int(ids.max())} does not fit {self.id_bytes} bytes")
        self.out.write(ids.astype(f"<u{self.id_bytes}").tobytes())
        self.ends.append(self.ends[-1] + len(ids))
        if doc_id is None:
            self.without_id += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> None:
        first = self.doc_ids[0] if self.doc_ids else 0
        place, spans = len(MAGIC) + self.ends[-1] * self.id_bytes, []
        for values in (np.asarray(self.ends, np.uint64), np.asarray(self.doc_ids, np.int64).view(np.uint64) - np.int64(first).view(np.uint64)):
            head, raw = elias_fano(values)
            self.out.write(raw)
            spans += [place, *head]
            place += len(raw)
        self.out.write(TRAILER.pack(self.id_bytes, len(self.ends) - 1, self.without_id, first, *spans))
        self.out.close()


class TokenFileReader:
    """Random access to one file; holds the compressed boundaries, reads ids on demand."""

    def __init__(self, source):
        self.source, size = source, source.size()
        if source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file")
        head = TRAILER.unpack(source.read_at(TRAILER.size, size - TRAILER.size))
        self.id_bytes, self.n_docs, self.without_id, self.first_id = head[:4]
        (at, *ends), (ids_at, *ids) = head[4:9], head[9:14]
        self.ends = EliasFano(source.read_at(ids_at - at, at), *ends)
        self.doc_ids = EliasFano(source.read_at(size - TRAILER.size - ids_at, ids_at), *ids)

    def documents(self, first: int, last: int) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc id, start, ids as little-endian unsigned 32-bit numbers) of documents number first..last-1."""
        ends = self.ends.values(first, last + 1).astype(np.int64)
        raw = self.source.read_at(int(ends[-1] - ends[0]) * self.id_bytes, len(MAGIC) + int(ends[0]) * self.id_bytes)
        ids = np.frombuffer(raw, f"<u{self.id_bytes}").astype("<u4").tobytes()
        known = self.doc_ids.values(max(first - self.without_id, 0), max(last - self.without_id, 0))
        names = [None] * (last - first - len(known)) + (known + np.int64(self.first_id).view(np.uint64)).view(np.int64).tolist()
        for doc_id, a, b in zip(names, ends[:-1].tolist(), ends[1:].tolist()):
            yield doc_id, a, ids[4 * (a - int(ends[0])) : 4 * (b - int(ends[0]))]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, files: int | None = None, id_bytes: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes all documents in rising order of id (NULL first, equal ids by the text's first 64 characters, then a hash of it)
    and returns the list of files: ``file`` (long, in order), ``path``, ``n_docs``, ``n_tokens``.  ``id_bytes``: 2 suffices for
    vocabularies up to 65,536 ids; a larger id is an error.  ``files``: how many ranges (default: the session's shuffle
    partitions, or more, so that a file is made of about ``FILE_BYTES`` of text).  No documents: no files."""
    spark, rows = docs.sparkSession, text_rows(docs, id_col, text_col)
    if files is None:
        total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // FILE_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        number, writer, encode = TaskContext.get().partitionId(), None, encoder(tokenizer).encode
        final, end = f"{base}/tokens-{number:06d}-{uuid.uuid4().hex}", np.array([end_id], "<u4")
        for batch in batches:
            if batch.num_rows and writer is None:
                fs.create_dir(base)
                writer = TokenFileWriter(fs.open_output_stream(f"{final}.part"), id_bytes)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                writer.add(doc_id, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            fs.move(f"{final}.part", final)
            yield pa.RecordBatch.from_pydict({"file": [number], "path": [final], "n_docs": [len(writer.ends) - 1], "n_tokens": [writer.ends[-1]]})

    keys = {"head": F.substring("text", 1, 64), "hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()}  # rows of one id can be split
    ordered = rows.withColumns(keys).repartitionByRange(files, "doc_id", *keys).sortWithinPartitions("doc_id", *keys).select("doc_id", "text")
    return cut_lineage(ordered.mapInArrow(run, "file long, path string, n_docs long, n_tokens long"), "token-files")


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` of every document in ``files``
    (from :func:`write_token_files`), read from the files through their select structures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                with fs.open_input_file(path) as source:
                    reader = TokenFileReader(source)
                    for first in range(0, reader.n_docs, READ_DOCS):
                        rows = [(d, before + a, len(ids) // 4, zlib.crc32(ids)) for d, a, ids in reader.documents(first, min(first + READ_DOCS, reader.n_docs))]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = files.select("path", before.cast("long").alias("before"))  # one row for each file
    return listed.repartition(max(1, files.count())).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")

"""Token counts of whole texts under a byte-level BPE file, by rank-synchronous merging of arrays.

A text is cut where the vocabulary's own rules always cut: before a space that a visible character follows.  The distinct
chunks of a batch are cut further into pre-tokens by the file's pattern, and the distinct pre-tokens are held as one ragged
array of symbols (ids of single bytes, one sequence behind the other).  In every round each sequence finds the pair of lowest
rank among its neighbours, and all its occurrences are merged at once, in all sequences together; only pairs at the merged
places are looked up again.  Sequences without a pair that the vocabulary merges leave the array, and the symbols that are
left are their tokens.  A merge makes a symbol whose own merges all have higher ranks, so this is the order in which the
vocabulary merges; :class:`MergeTable` refuses a file for which that does not hold.

Nothing is shuffled, and nothing is kept between batches: a task holds the symbols of ``tokens.BATCH_BYTES`` of text (a longer text
without a single place to cut is a batch of its own)."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import tokens
from shelfspark.llm.common import text_rows
from shelfspark.llm.tokens import chunk_codes, in_parts

#: The pattern of byte-level files with ``use_regex`` (fixed by that format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: No merge: above every rank.
NONE = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the files: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(shifted)) for b in range(256)]


class MergeTable:
    """Ranks and results of pairs of ids, and ids of single bytes, of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, special = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        plain = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}
        odd = [k for k, v in plain.items() if (model.get(k) or None) != (v or None)]
        odd += [k for k, v in {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}.items() if pre.get(k) != v]
        odd += [t["content"] for t in special if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if odd or spec.get("normalizer") or spec.get("truncation") or spec.get("padding"):
            raise ValueError(f"not a plain byte-level BPE file: {odd}")
        vocab = model["vocab"]
        self.special = sorted((t["content"] for t in special), key=len, reverse=True)
        self.bytes = np.array([vocab[c] for c in byte_symbols()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array([vocab[s] for s in side], np.int64) for side in (*zip(*pairs), [a + b for a, b in pairs])) if pairs else (np.zeros(0, np.int64),) * 3
        rank_of = {int(m): r for r, m in reversed(list(enumerate(made)))}
        if any(max(rank_of.get(int(a), -1), rank_of.get(int(b), -1)) >= r for r, (a, b) in enumerate(zip(left, right))) or len(rank_of) != len(made):
            raise ValueError("a merge comes before the merges of its parts, or makes a symbol that another makes")
        self.width, self.made = max(vocab.values()) + 1, np.append(made, -1)
        # open addressing by a multiplicative hash; a slot holds the first key that came to it, the others go a level on
        self.levels, keys, ranks, bits = [], left * self.width + right, np.arange(len(left)), 19
        while len(keys):
            slot = self._slot(keys, bits)
            table, rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE)
            first = np.unique(slot, return_index=True)[1]
            table[slot[first]], rank[slot[first]] = keys[first], ranks[first]
            self.levels.append((bits, table, rank))
            rest = np.setdiff1d(np.arange(len(keys)), first)
            keys, ranks, bits = keys[rest], ranks[rest], max(4, int(len(rest)).bit_length() + 4) + (len(self.levels) % 3)

    @staticmethod
    def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return (((keys + bits).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``NONE`` where there is no merge."""
        keys, out = left * self.width + right, np.full(len(left), NONE)
        for bits, table, rank in self.levels:
            slot = self._slot(keys, bits)
            found = table[slot] == keys
            out[found] = rank[slot[found]]
        return out


def surviving_symbols(symbols: np.ndarray, lengths: np.ndarray, table: MergeTable) -> np.ndarray:
    """Number of symbols left of each sequence; ``symbols`` are the ids of all sequences in a row, ``lengths`` their sizes."""
    left = np.asarray(lengths, np.int64).copy()
    own = np.flatnonzero(left > 1)  # numbers of the sequences in the array
    size = left[own]
    sym = symbols[np.repeat(left > 1, left)]
    rank = table.ranks(sym, np.append(sym[1:], 0))
    while len(own):
        end = np.cumsum(size)
        rank[end - 1] = NONE
        best = np.minimum.reduceat(rank, end - size)
        live = best < NONE
        if not live.all():
            left[own[~live]] = size[~live]
            keep = np.repeat(live, size)
            sym, rank, own, size, best = sym[keep], rank[keep], own[live], size[live], best[live]
            if not len(own):
                break
            end = np.cumsum(size)
        hit = rank == np.repeat(best, size)
        follows = hit[1:] & hit[:-1]
        if follows.any():  # x x x: of a run of overlapping occurrences, the first, third.. are merged
            at = np.arange(len(hit))
            start = np.maximum.accumulate(np.where(hit & ~np.append(False, follows), at, -1))
            hit &= (at - start) % 2 == 0
        at = np.flatnonzero(hit)
        sym[at] = table.made[rank[at]]
        gone = np.zeros(len(sym), bool)
        gone[at + 1] = True
        size = size - np.add.reduceat(hit, end - size, dtype=np.int64)
        at -= np.arange(len(at))  # one symbol is gone for each merge before
        sym, rank = sym[~gone], rank[~gone]
        touched = np.zeros(len(sym), bool)
        touched[at] = touched[at[at > 0] - 1] = True
        again = np.flatnonzero(touched)
        rank[again] = table.ranks(sym[again], np.append(sym, 0)[again + 1])
    return left


class TokenCounter:
    """Counts tokens of texts with the merges of one file."""

    def __init__(self, path: str):
        self.path, self.table, self.find, self.library = path, MergeTable(path), regex.compile(PATTERN).findall, None
        self.marks = re.compile("|".join(map(re.escape, self.table.special))) if self.table.special else None

    def _pre_tokens(self, chunks: list[str]) -> list[list[str]]:
        """Pre-tokens of each chunk.  Characters that Unicode 15.1 leaves undefined are classed by the file's library."""
        out = [self.find(c) for c in chunks]
        odd = [c for c in set("".join(chunks)) if c > "˿" and unicodedata.category(c) == "Cn"]
        if odd:
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path).pre_tokenizer
            back = {c: chr(b) for b, c in enumerate(byte_symbols())}
            for n, c in enumerate(chunks):
                if any(x in c for x in odd):
                    out[n] = ["".join(map(back.__getitem__, t)).encode("latin-1").decode("utf-8", "surrogatepass") for t, _ in self.library.pre_tokenize_str(c)]
        return out

    def _chunk_counts(self, chunks: list[str]) -> np.ndarray:
        found = self._pre_tokens(chunks)
        coded = pa.array(chain.from_iterable(found), pa.large_string()).dictionary_encode()
        words, code = coded.dictionary.cast(pa.large_binary()), coded.indices.to_numpy()
        raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: int(pc.sum(pc.binary_length(words)).as_py() or 0)]
        counts = surviving_symbols(self.table.bytes[raw], pc.binary_length(words).to_numpy(), self.table)
        running = np.append(0, np.cumsum(counts[code]))
        end = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        return running[end] - running[np.append(0, end[:-1])] if len(end) else end

    def _counts(self, texts: pa.Array) -> np.ndarray:
        """Counts of texts without special tokens."""
        if not len(texts):
            return np.zeros(0, np.int64)
        codes, begin, chunks = chunk_codes(texts)
        return np.add.reduceat(self._chunk_counts(chunks)[codes], begin)

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text (NULL: none).  Special tokens' strings are one token each, as is the library's default."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size, total = pc.binary_length(texts).to_numpy(), np.zeros(len(texts), np.int64)
        apart = size > tokens.BATCH_BYTES
        if self.marks:
            apart = apart | pc.match_substring_regex(texts, "|".join(re.escape(s) for s in self.table.special)).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~apart)
        group = np.cumsum(size[plain]) // tokens.BATCH_BYTES
        for rows in np.split(plain, np.flatnonzero(np.diff(group)) + 1):
            total[rows] = self._counts(texts.take(pa.array(rows)))
        for row in np.flatnonzero(apart).tolist():
            text = texts[row].as_py()
            for n, part in enumerate(self.marks.split(text) if self.marks else [text]):
                total[row] += (n > 0) + sum(int(self._counts(pa.array([p], pa.large_string()))[0]) for p in in_parts(part) if p)
        return total


_OPEN: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """The worker's counter of this file."""
    if path not in _OPEN:
        _OPEN.clear()
        _OPEN[path] = TokenCounter(path)
    return _OPEN[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens) of every row's whole text.

    A NULL or empty text has no bytes and no tokens; repeated rows and NULL ids come out as often as they come in; extra
    columns take no part; an empty table gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer).count
        for batch in batches:
            texts = batch.column("text")
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n_bytes, pa.array(count(texts))], ["doc_id", "n_bytes", "n_tokens"])

    counted = text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

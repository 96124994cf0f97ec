"""Exact token ids of whole texts with a file of the ``tokenizers`` library, as the library gives them by default: strings of
special tokens inside a text are special tokens."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

#: Text handled at a time.
BATCH_BYTES = 6 << 20
#: A piece that is empty or begins with white space (or a control) does not end the run of white space before it.
JOINED = r"^$|^[\x00-\x20\x7f-\xa0\x{180e}\x{200b}\p{Z}]"
CUT = re.compile(r" (?=[^\s\x00-\x20\x7f-\xa0᠎​])")
#: The same beyond the first byte: white space and controls of two and three bytes, as numbers.
WIDE_SPACE = np.array([0xC280 + k for k in range(33)] + [int.from_bytes(chr(c).encode()) for c in (0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)])
#: Marks beside which words are cut; an apostrophe may belong to a word.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: What a byte of text is.
BEGINS, ENDS, MARK, SEEN = 1, 2, 4, 8  # a letter begins, a letter ends, a mark, a visible character ends
KIND = np.zeros(256, np.uint8)
KIND[0x21:0x7F] = SEEN
KIND[[*range(65, 91), *range(97, 123)]] |= BEGINS | ENDS
KIND[list(MARKS.encode())] |= MARK
#: Chunks that are one pre-token of byte-level files.
SINGLE = re.compile(f" ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[{re.escape(MARKS)}]+)")
#: The character by which byte-level files write each byte.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_CHARS = "".join(chr(b if b in _SHOWN else 256 + sum(c not in _SHOWN for c in range(b))) for b in range(256))
#: How a file shows that it lowers letters and merges runs of letters and of marks without the space before them.
LOWERED_WORDS = r'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\s+"), content=" "), Lowercase()])'
SPLIT_WORDS = (
    r"""Sequence(pretokenizers=[Split(pattern=Regex("'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), behavior=Removed, invert=True), """
    "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])"
)
#: Tried in turn as a mark between chunks that are encoded together: it must come out as one id of its own.
SEPARATORS = ("\n", " ~ ", " | ", " ^ ")
#: Chunks encoded together.
TOGETHER = 1000
#: Words on which a file shows that its merges may be asked for directly.
WORD_PROBES = ("a", " a", "the", " the", " Hello", "tokenisers", " antidisestablishmentarianism", " qzxjv", " Été", "ßÿÀ", ",", " (", "!?.", " ###~")
#: Strings on which a file shows that it never joins a visible character and the space behind it.
PROBES = ("a b", "it's, isn't it ? 12 34", "x  y", "e\n f", "Ünï  漢字 ok", "the end . The end", "a  \n\t b c", "!! !! ~ ~")
#: The same for letters and the marks beside them, and for single line ends.
FINE_PROBES = ("end.\nNext one", "a,b (c) \"d\" e! ", "été!x É,ß ÿ.", "##\nno***on\n12\n'a'\n漢", ".\n\nA\n B", "\nfoo\n", "x.'s x!'s x's.", "a-b_c/d <e>f|g", "$1.50, no.1 (2)")


def _begin_with_space(pieces: pa.Array) -> np.ndarray:
    """Where ``JOINED`` holds; its pattern is only tried where the first byte leaves it open."""
    offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    raw = np.append(np.frombuffer(pieces.buffers()[2] or b"", np.uint8), np.uint8(0))
    byte = raw[np.minimum(offsets[:-1], len(raw) - 1)]
    joined = (offsets[1:] == offsets[:-1]) | (byte <= 0x20) | (byte == 0x7F)
    wide = np.flatnonzero(~joined & (byte >= 0xC2) & (byte <= 0xE3))
    joined[wide] = pc.match_substring_regex(pieces.take(pa.array(wide)), JOINED).to_numpy(zero_copy_only=False)
    return joined


def chunk_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Texts cut before each space that a visible character follows: (number of the distinct chunk at each place, first
    place of each text, distinct chunks).  Only an empty text has the empty chunk."""
    lists = pc.split_pattern(texts, " ")
    pieces, begin = lists.flatten(), lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
    first = np.zeros(len(pieces), bool)
    first[begin] = True
    joined = _begin_with_space(pieces) & ~first
    if joined.any():  # runs of white space stay with the piece before them
        start = np.flatnonzero(~joined)
        stop = np.append(start[1:], len(pieces))
        several = stop - start > 1
        whole = pa.array([" ".join(pieces.slice(a, b - a).to_pylist()) for a, b in zip(start[several].tolist(), stop[several].tolist())], pieces.type)
        place = np.where(several, len(pieces) + np.cumsum(several) - 1, start)
        pieces, first = pa.concat_arrays([pieces, whole]).take(pa.array(place)), first[start]
        begin = np.searchsorted(start, begin)
    coded = pieces.dictionary_encode()
    key = coded.indices.to_numpy().astype(np.int64) * 2 + first
    used = np.zeros(2 * len(coded.dictionary), bool)
    used[key] = True
    names = coded.dictionary.to_pylist()
    chunks = [names[k >> 1] if k & 1 else " " + names[k >> 1] for k in np.flatnonzero(used).tolist()]
    return (np.cumsum(used) - 1)[key], begin, chunks


def in_parts(text: str) -> Iterator[str]:
    """A long text in parts of about ``BATCH_BYTES`` characters, cut where :func:`chunk_codes` cuts."""
    at = 0
    while len(text) - at > BATCH_BYTES and (found := CUT.search(text, at + BATCH_BYTES)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def text_pieces(texts: pa.Array, fine: bool) -> tuple[pa.Array, np.ndarray]:
    """Texts (large strings without NULL) cut before each space that a visible character follows; with ``fine`` also around marks
    beside letters (ASCII and Latin-1; no apostrophes) and around single line ends: (pieces, first piece of each text)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets, n = offsets - offsets[0], len(raw)
    raw = np.append(raw, np.zeros(3, np.uint8))
    starts = np.zeros(n + 1, bool)
    starts[offsets] = True
    cut = starts.copy()

    def before_visible(at: np.ndarray) -> np.ndarray:
        """Those of the places behind which a visible character of the same text stands."""
        byte = raw[at + 1]
        seen = (byte > 0x20) & (byte != 0x7F) & ~starts[at + 1]
        wide = np.flatnonzero(seen & (byte >= 0xC2) & (byte <= 0xE3))
        first, second, third = (raw[at[wide] + k].astype(np.int64) for k in (1, 2, 3))
        seen[wide] = ~np.isin(np.where(first < 0xE0, first << 8 | second, first << 16 | second << 8 | third), WIDE_SPACE)
        return at[seen]

    cut[before_visible(np.flatnonzero(raw[:n] == 0x20))] = True
    if fine:
        kind = KIND[raw]
        lead = np.flatnonzero(raw[:n] == 0xC3)
        lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]  # the signs of multiplication and division
        kind[lead] |= BEGINS
        kind[lead + 1] |= ENDS | SEEN
        left, right = kind[: max(n - 1, 0)], kind[1 : max(n, 1)]
        cut[1:n] |= ((left & ENDS) > 0) & ((right & MARK) > 0) | ((left & MARK) > 0) & ((right & BEGINS) > 0)
        line = np.flatnonzero(raw[1:n] == 0x0A) + 1
        line = line[(kind[line - 1] & SEEN) > 0]
        cut[line] = True
        cut[before_visible(line) + 1] = True
    place = np.flatnonzero(cut[:n])
    edges = pa.py_buffer(np.append(place, n))
    return pa.LargeStringArray.from_buffers(len(place), edges, pa.py_buffer(raw)), np.searchsorted(place, offsets[:-1])


def _gathered(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size`` ids from each ``start`` on, one behind another."""
    end = np.cumsum(size)
    return pool[np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)]


class ChunkEncoder:
    """Encodes texts; remembers the ids of pieces of text, so that a word goes through the vocabulary's merges once.  The memory is
    one column of strings and one of ids; beyond four times ``memo_chunks`` pieces it is cut to the half that came last.

    Pieces are right for tokenizers that split at white space before merging, as byte-level and end-of-word BPE do; a file
    that does not (see ``PROBES``) has whole texts encoded, as have texts with strings of special tokens."""

    def __init__(self, path: str, memo_chunks: int = 120_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo_chunks = memo_chunks
        self.names, self.pool = pa.array([], pa.large_string()), np.zeros(0, np.uint32)
        self.start, self.size, self.used, self.turn = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), 0
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "|".join(map(re.escape, special))
        self.separator, self.mark = next(((s, ids[0]) for s in SEPARATORS if len(ids := self._separator_ids(s)) == 1), ("", -1))
        self.in_chunks, self.fine = self._splits(PROBES, False), self._splits(PROBES + FINE_PROBES, True)

        split, normal = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        self.direct = normal is None and type(split).__name__ == "ByteLevel" and not split.add_prefix_space and split.use_regex
        self.direct = self.direct and self._asked_rightly(False)
        self.lowered = (repr(normal), repr(split)) == (LOWERED_WORDS, SPLIT_WORDS) and self._asked_rightly(True)

    def _splits(self, probes: tuple[str, ...], fine: bool) -> bool:
        return all(self._ids(p) == list(chain.from_iterable(map(self._ids, text_pieces(pa.array([p], pa.large_string()), fine)[0].to_pylist()))) for p in probes)

    def _asked_rightly(self, lowered: bool) -> bool:
        ids, size = self._merged(list(WORD_PROBES), lowered)
        return [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [self._ids(w) for w in WORD_PROBES]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _separator_ids(self, separator: str) -> list[int]:
        a, b, both = self._ids("so"), self._ids("it"), self._ids(f"so{separator}it")
        return both[len(a) : len(both) - len(b)] if both[: len(a)] == a and both[len(both) - len(b) :] == b else []

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, words: list[str], lowered: bool) -> tuple[np.ndarray, list[int]]:
        """Ids, one behind another, and their number for each word.  ``words`` are matched by ``SINGLE``: one pre-token each, so the
        library's model alone is asked.  ``lowered``: by a file that takes lower case and leaves spaces out."""
        joined = "\n".join([w.removeprefix(" ") for w in words]).lower() if lowered else "\n".join(words)
        ids, size, model = array("I"), [], self.tokenizer.model.tokenize
        for line in joined.encode().split(b"\n") if words else ():
            found = [t.id for t in model(line.decode("latin-1").translate(BYTE_CHARS))]
            ids.extend(found)
            size.append(len(found))
        return np.asarray(ids, np.uint32), size

    def _together(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of each chunk, from one text that has the separator between them."""
        out = []
        for start in range(0, len(chunks), TOGETHER):
            group = chunks[start : start + TOGETHER]
            ids = np.asarray(self.tokenizer.encode_batch_fast([self.separator.join(group)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            if len(ends) != len(group):
                out += self._whole(group)
                continue
            out += [ids[a:b] for a, b in zip([0, *(ends[:-1] + 1).tolist()], ends.tolist())]
        return out

    def _learn(self, words: list[str]) -> None:
        """Adds the ids of ``words`` to the memory, in this order."""
        sign, kinds = self.separator.strip() or self.separator, ([], [], [])
        asked = SINGLE.fullmatch if self.direct or self.lowered else lambda word: None
        for n, word in enumerate(words):
            plain = sign and sign not in word and word.split() == [word.removeprefix(" ")]
            kinds[0 if asked(word) else 1 if plain else 2].append(n)
        ids, size = self._merged([words[n] for n in kinds[0]], self.lowered)
        found = self._together([words[n] for n in kinds[1]]) + self._whole([words[n] for n in kinds[2]])
        at = np.array([*kinds[0], *kinds[1], *kinds[2]], np.int64)
        sizes = np.array([*size, *map(len, found)], np.int64)
        start, own = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        start[at], own[at] = len(self.pool) + np.cumsum(sizes) - sizes, sizes
        self.pool = np.concatenate([self.pool, ids, *found])
        self.start, self.size = np.append(self.start, start), np.append(self.size, own)

    def _forget(self) -> None:
        kept = np.argsort(-self.used, kind="stable")[: 2 * self.memo_chunks]
        kept.sort()
        self.names, self.used, size = self.names.take(pa.array(kept)), self.used[kept], self.size[kept]
        self.pool, self.start, self.size = _gathered(self.pool, self.start[kept], size), np.cumsum(size) - size, size

    def _batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        known, self.turn = len(self.names), self.turn + 1
        pieces, begin = text_pieces(texts, self.fine)
        coded = pa.concat_arrays([self.names, pieces]).dictionary_encode()  # what is known keeps its number
        codes, self.names = coded.indices.to_numpy()[known:], coded.dictionary
        if len(self.names) > known:
            self._learn(self.names.slice(known).to_pylist())
            self.used = np.append(self.used, np.zeros(len(self.names) - known, np.int32))
        self.used[codes] = self.turn
        size = self.size[codes]
        ids, end = _gathered(self.pool, self.start[codes], size).astype("<u4", copy=False), np.cumsum(size)
        if len(self.names) > 4 * self.memo_chunks:
            self._forget()
        edge = np.append(0, end)[np.append(begin, len(codes))]
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            yield ids[a:b]

    def _apart(self, text: str) -> np.ndarray:
        if not self.in_chunks or (self.special and re.search(self.special, text)):
            return np.asarray(self._ids(text), "<u4")
        return np.concatenate([next(self._batch(pa.array([p], pa.large_string()))) for p in in_parts(text)])

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text as little-endian unsigned 32-bit numbers (NULL: no ids)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size = pc.binary_length(texts).to_numpy()
        apart = size > BATCH_BYTES if self.in_chunks else np.ones(len(texts), bool)
        if self.special and self.in_chunks:
            apart = apart | pc.match_substring_regex(texts, self.special).to_numpy(zero_copy_only=False)
        group = np.where(apart, 0, size).cumsum() // BATCH_BYTES
        for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(group)) + 1):
            if len(rows):
                plain = self._batch(texts.take(pa.array(rows[~apart[rows]]))) if not apart[rows].all() else iter(())
                for row in rows.tolist():
                    yield self._apart(texts[row].as_py()) if apart[row] else next(plain)


_OPEN: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder of this file; a worker that serves several tasks keeps what it has learnt."""
    if path not in _OPEN:
        _OPEN.clear()
        _OPEN[path] = ChunkEncoder(path)
    return _OPEN[path]

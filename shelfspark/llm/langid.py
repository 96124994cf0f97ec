"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text recognises all its substrings.  A document is parsed greedily into the
longest phrases that the automaton recognises; a text in the language needs few long phrases, another needs many short ones.
The normalised number of phrases, ``phrases * log2(training symbols) / symbols``, estimates the bits a symbol costs when
each phrase is replaced by a pointer into the training text; the language with the least wins.

Symbols are lower-cased letters and one space for each run of anything else.  Texts are cut into blocks of ``BLOCK`` symbols,
and blocks of many documents step through the automata together.  Where a block's phrases begin depends on the block before
it, so each block starts from a guess (the state after the last ``WARM`` symbols in front of it) and is walked again from the
state that the block before it really ended in, until none has to be: the parse is that of the unbroken text.  Parses from
different states soon meet, as a phrase of some twenty symbols occurs once in the training text.

Transitions of the ``DENSE`` commonest symbols are a table; those of rarer ones are sorted keys, so memory grows with the
training text and not with the alphabet."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import text_rows

BLOCK = 128
#: Symbols in front of a block that its first guess is made from.
WARM = 32
#: Walks of all stale blocks before only the first stale one of each text is walked.
GUESSES = 3
#: Symbols with a column of their own in the table.
DENSE = 96
#: Symbol codes that every model has.
PAD, SPACE, UNKNOWN = 0, 1, 2
#: In a table entry, the phrases that the step closes stand above the state.
STATE_BITS = 28


@dataclass
class LanguageModel:
    languages: list[str]
    alphabet: str  # letters with codes from 3, the commonest first
    width: int  # codes below have a column
    table: np.ndarray  # next state and closed phrases by state * width + symbol
    rare_keys: np.ndarray  # state * size + symbol of the other transitions, ascending
    rare_next: np.ndarray
    roots: np.ndarray
    log_sizes: np.ndarray

    @property
    def size(self) -> int:
        return len(self.alphabet) + 3


_FOLD: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """For each code point: its lower-cased letter's code point, or 0 if it is no letter."""
    if not _FOLD:
        fold = np.zeros(0x110000, np.uint32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                fold[cp] = ord(low) if len(low) == 1 else cp
        _FOLD.append(fold)
    return _FOLD[0]


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, 0 for each run of anything else."""
    points = _folded()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    return points[(points != 0) | np.append(True, points[:-1] != 0)] if len(points) else points


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the states of the suffix automaton; state 0 is the root."""
    step, link, length, last = [{}], [-1], [0], 0
    for s in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and s not in step[at]:
            step[at][s] = new
            at = link[at]
        if at >= 0:
            to = step[at][s]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                twin = len(step)
                step.append(dict(step[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = link[new] = twin
                while at >= 0 and step[at].get(s) == to:
                    step[at][s] = twin
                    at = link[at]
        last = new
    return step


def build_model(texts: dict[str, str], dense: int = DENSE) -> LanguageModel:
    """A model from the training text of each language."""
    codes = {name: letters(text) for name, text in sorted(texts.items())}
    found, counts = np.unique(np.concatenate([*codes.values(), np.zeros(0, np.uint32)]), return_counts=True)
    alphabet = "".join(chr(c) for _, c in sorted(zip((-counts).tolist(), found.tolist())) if c)
    size = len(alphabet) + 3
    width, tables, roots, keys, targets, base = min(size, dense + 3), [], [], [], [], 0
    lookup = {ord(c): k for k, c in enumerate(alphabet, 3)} | {0: SPACE}
    for points in codes.values():
        step = suffix_automaton([lookup[p] for p in points.tolist()])
        nxt = np.full((len(step), width), -1, np.int64)
        for state, out in enumerate(step):
            for s, to in out.items():
                if s < width:
                    nxt[state, s] = to
                else:
                    keys.append((state + base) * size + s)
                    targets.append(to + base)
        first = np.broadcast_to(nxt[0], nxt.shape)
        open_phrase = (np.arange(len(step)) > 0).astype(np.int64)[:, None]  # at the root no phrase is open
        # a miss closes the open phrase and starts one with the symbol; a symbol that never occurs is a phrase by itself
        state = np.where(nxt >= 0, nxt, np.where(first >= 0, first, 0))
        closed = np.where(nxt >= 0, 0, open_phrase + (first < 0))
        state[:, PAD], closed[:, PAD] = np.arange(len(step)), 0
        tables.append(((state + base) | closed << STATE_BITS).astype(np.uint32))
        roots.append(base)
        base += len(step)
    if base >> STATE_BITS:
        raise ValueError("training text too long")
    sizes = np.array([max(len(p), 2) for p in codes.values()], float)
    order = np.argsort(np.array(keys, np.int64))
    return LanguageModel(
        list(codes), alphabet, width, np.concatenate(tables).ravel() if tables else np.zeros(0, np.uint32), np.array(keys, np.int64)[order], np.array(targets, np.int64)[order], np.array(roots, np.int64), np.log2(sizes)
    )


def _rare_step(model: LanguageModel, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Next states over symbols without a column; -1 where there is none."""
    if not len(model.rare_keys):
        return np.full(len(state), -1, np.int64)
    key = state * model.size + symbol
    at = np.minimum(np.searchsorted(model.rare_keys, key), len(model.rare_keys) - 1)
    return np.where(model.rare_keys[at] == key, model.rare_next[at], -1)


def _walk(model: LanguageModel, columns: np.ndarray, rare: np.ndarray, block: np.ndarray, language: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Walks each ``block`` in its ``language`` from ``state``: phrases closed on the way and last states.  ``columns`` holds a
    row for each place of a block, ``rare`` says at which places some block has a symbol without a column."""
    state, total = state.copy(), np.zeros(len(state), np.int64)
    for place, column in enumerate(columns):
        symbol = column.take(block).astype(np.int64)
        if not rare[place]:
            entry = model.table.take(state * model.width + symbol)
            total += entry >> STATE_BITS
            state = (entry & ((1 << STATE_BITS) - 1)).astype(np.int64)
            continue
        entry = model.table.take(state * model.width + np.where(symbol < model.width, symbol, UNKNOWN))
        after, closed = (entry & ((1 << STATE_BITS) - 1)).astype(np.int64), (entry >> STATE_BITS).astype(np.int64)
        odd = np.flatnonzero(symbol >= model.width)
        root = model.roots[language[odd]]
        going, fresh = _rare_step(model, state[odd], symbol[odd]), _rare_step(model, root, symbol[odd])
        after[odd] = np.where(going >= 0, going, np.where(fresh >= 0, fresh, root))
        closed[odd] = np.where(going >= 0, 0, (state[odd] != root).astype(np.int64) + (fresh < 0))
        state, total = after, total + closed
    return total, state


def phrases(model: LanguageModel, blocks: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Phrases of each text in each language.  Rows of ``blocks`` (``BLOCK`` codes each) follow each other; ``text``, ascending,
    says whose they are."""
    many, spoken = len(blocks), len(model.languages)
    columns = np.ascontiguousarray(blocks.T)
    rare = (columns >= model.width).any(axis=1)
    heads = np.append(True, text[1:] != text[:-1])[:many]
    begin = np.repeat(model.roots[None, :], many, axis=0)
    b, l = np.nonzero(np.broadcast_to(~heads[:, None], begin.shape))
    begin[b, l] = _walk(model, columns[-WARM:], rare[-WARM:], b - 1, l, begin[b, l])[1]
    closed, end = np.zeros((many, spoken), np.int64), np.zeros((many, spoken), np.int64)
    b, l = np.nonzero(np.ones((many, spoken), bool))
    walks = 0
    while len(b):
        closed[b, l], end[b, l] = _walk(model, columns, rare, b, l, begin[b, l])
        walks += 1
        truly = np.where(heads[:, None], model.roots, np.roll(end, 1, axis=0))
        b, l = np.nonzero(truly != begin)
        if walks >= GUESSES:  # one after the other, so that no walk is in vain
            leading = np.unique(text[b] * spoken + l, return_index=True)[1]
            b, l = b[leading], l[leading]
        begin[b, l] = truly[b, l]
    total = np.zeros((n_texts, spoken), np.int64)
    np.add.at(total, text, closed)
    tails = np.append(text[1:] != text[:-1], True)[:many]
    total[text[tails]] += end[tails] != model.roots
    return total


def entropies(model: LanguageModel, texts: list[str | None], at_once: int = 1 << 22) -> Iterator[np.ndarray | None]:
    """For each text the normalised phrases in each language; None for a text without a letter.  About ``at_once`` symbols
    times languages are walked together."""
    codes = np.full(0x110000, UNKNOWN, np.min_scalar_type(model.size))
    codes[0] = SPACE
    codes[[ord(c) for c in model.alphabet]] = np.arange(3, model.size)

    def flush() -> Iterator[np.ndarray | None]:
        lengths = np.array([len(r) // BLOCK for r in rows])
        counts = phrases(model, np.concatenate(rows).reshape(-1, BLOCK), np.repeat(np.arange(len(rows)), lengths), len(rows))
        for count, n in zip(counts, sizes):
            yield count * model.log_sizes / n if n else None

    rows, sizes, held = [], [], 0
    for text in texts:
        points = letters(text or "")
        n = len(points) if points.any() else 0
        row = np.full(-(-n // BLOCK) * BLOCK, PAD, codes.dtype)
        row[:n] = codes[points[:n]]
        rows.append(row)
        sizes.append(n)
        held += len(row) * len(model.languages)
        if held >= at_once:
            yield from flush()
            rows, sizes, held = [], [], 0
    if rows:
        yield from flush()


def sample_texts(rows: DataFrame, docs_per_language: int, language_symbols: int, passage: int = 1500) -> dict[str, str]:
    """Training text of each language in ``rows`` (doc_id, text, lang): up to ``docs_per_language`` documents, one for each
    hash bucket of ids, a passage from a hashed place of each, joined up to ``language_symbols`` characters.  A passage has
    ``passage`` characters, more where a language has few documents.  This bound on what is fitted is the only one; it doesn't
    touch what is predicted."""
    usable = rows.where("lang is not null and text is not null and doc_id is not null")
    hashed = usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    picked = hashed.groupBy("lang", F.pmod("h", F.lit(docs_per_language)).alias("bucket")).agg(F.min(F.struct("h", "doc_id")).alias("pick"))
    wanted = F.greatest(F.lit(passage), F.ceil(F.lit(language_symbols) / F.count(F.lit(1)).over(Window.partitionBy("lang"))))
    ids = picked.select("lang", "pick.doc_id", "pick.h", wanted.cast("int").alias("want"))  # at most docs_per_language rows a language
    start = 1 + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - F.col("want") + 1, F.lit(1)))
    passages = usable.join(F.broadcast(ids), ["doc_id", "lang"]).select("lang", "h", "doc_id", F.substring("text", start.cast("int"), F.col("want")).alias("text"))
    found: dict[str, list] = {}
    for r in passages.groupBy("lang", "h", "doc_id").agg(F.min("text").alias("text")).collect():  # one row an id, repeated or not
        found.setdefault(r.lang, []).append((r.h, r.text))
    return {lang: "\n".join(t for _, t in sorted(rows))[:language_symbols] for lang, rows in found.items()}


def identify(docs: DataFrame, train: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", docs_per_language: int = 64, language_symbols: int = 24_000) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``bits``: one row for each row of ``docs``.

    ``train`` says which rows may be learned from (a NULL counts as no).  ``lang_pred`` is a learned language, or ``und``
    (score 0) for a NULL text, one without a letter, or when there is nothing to learn from; equal entropies go to the
    language that sorts first.  ``score`` is the runner-up's share of the two least entropies, 0.5 (a tie) to 1 (no other
    language).  ``bits``: the winner's normalised phrases.  Repeated rows each have a row."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"), train.alias("train"))
    model = build_model(sample_texts(rows.where("train"), docs_per_language, language_symbols))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x language_symbols bound its size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            lang, score, bits = [], [], []
            for h in entropies(own, batch.column("text").to_pylist()) if own.languages else [None] * batch.num_rows:
                best, second = np.partition(np.append(h, np.inf), 1)[:2] if h is not None else (np.nan, np.nan)
                lang.append("und" if h is None else own.languages[int(np.argmin(h))])
                score.append(0.0 if h is None else 1.0 if second == np.inf else float(second / (best + second)) if second else 0.5)
                bits.append(None if h is None else float(best))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())], ["doc_id", "lang_pred", "score", "bits"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, bits double")

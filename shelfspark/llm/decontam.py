"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of canonical words: a number (digits or a number word) is ``<num>``, a unit after a number is
``<unit>``, a capitalised word is ``<name>`` (a common word only inside a sentence), any other word is itself in lower case.  Windows of
``window`` canonical words are hashed; those of the benchmark are hash-joined with those of all documents, so an item is
found again after its numbers, names and units have been replaced.

The hits of a document and an item are then judged together, in the task that has the document: they are put into chains that
rise in both (one document place for each item place, shifts near each other), and each chain is carried on word by word
through what an edit has destroyed.  *Coverage* is the share of the item's words that a chain aligns with an equal word or a
slot of the same kind.  Numbers and units are free at each place; a name of the item must stand for one name.  Windows with
fewer than ``literals`` words of their own say too little and are not used to find hits.  One changed word can leave no window
of an item with fewer than two windows' words; those of more than a window are also looked for by windows of half their words
(three at least), and then may miss one word.

An item that no such window is usable of (a few words, or dense in numbers and names) is looked up by the hash of its whole
sequence: of its words as they stand, and of its canonical words if ``literals`` of them are its own.  Characters of scripts
without spaces are words.

A window that many items share (a common prompt) gives a document hits with each of them.  Before any is judged, one vectorised
step counts the item's words that stand alike at the shifts of its hits; what is covered stands so, hence an item with too few
is out, and only the others cost a search for chains.

Only the benchmark is broadcast, in blocks of about ``block_windows`` windows; a larger benchmark takes several passes over the
documents.  Document windows meet it in a hash lookup without a shuffle."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.session import cut_lineage

#: Letters of scripts that write no spaces (Thai to Burmese, Khmer, Japanese kana, Han) are words of their own.
SPACELESS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
TOKEN = re.compile(rf"[.!?\n。！？]|\d+(?:[.,]\d+)*|[{SPACELESS}]|[^\W\d_{SPACELESS}]+")
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split())
UNIT_WORDS = frozenset("mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams pound pounds lb oz ton tons ml l liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years percent dollar dollars euro euros cent cents degree degrees kb mb gb tb hz khz mhz ghz w kw v".split())
#: Words that begin sentences without being names, in the languages that the corpus has.
COMMON_WORDS = frozenset("a about after all also although an and another any are as at because before both but by can could did do does during each every explain find first for from give given had has have he her here his how however i if in is it its last let list many more most my name next no not now of on one only or other our over read see she should since so some such suppose than that the their then there these they this those through to under until use was we were what when where whether which while who whose why will with would write you your"
    " al algunos antes así aunque como con cuando cuál cuáles cuánto cuántos cada de del desde después donde dónde durante el ella ellos en entre es esta este esto estos hay la las lo los más mi muy ni no nos nuestro o otra otro para pero por porque pues que quién qué se según si sin sobre su sus también todo todos tras un una unos y ya"
    " alors après au aussi aux avant avec ce ces cette chaque combien comme comment dans des donc du elle elles est et il ils je le les leur leurs mais ne nous on ou où par pendant plus pour pourquoi puis quand que quel quelle quels qui quoi sa sans ses si son sont sur tous tout un une vous"
    " aber alle als am an auch auf aus bei bis das dass dem den denn der des die dies diese dieser ein eine einem einen einer er es für hat hier ich ihr im in ist jede jeder man mit nach nicht noch nun nur ob oder ohne seit sie sind so über um und unter vom von vor wann war warum was welche welcher wenn wer werden wie wieviele wir wird wo zu zum zur zwischen".split())
#: The low three bits of a token's hash say what it is; a ``START`` is a capitalised common word, a name only inside a sentence.
PLAIN, TITLE, NUMBER, UNIT, MARK, START = range(6)
KIND = np.uint64(7)
PLACEHOLDERS = {kind: np.uint64(xxhash.xxh64_intdigest(name) & ~7) for kind, name in ((NUMBER, "<num>"), (UNIT, "<unit>"), (TITLE, "<name>"))}
MIX = np.uint64(0x9E3779B97F4A7C15)
NAMES = ["id", "item_id", "coverage", "first_word", "last_word", "n_slots", "reparameterised"]
KINDS = [pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]


def _token(token: str) -> int:
    low = token.lower()
    if token in ".!?\n。！？":
        kind = MARK
    elif token[0].isdigit() or low in NUMBER_WORDS:
        kind = NUMBER
    elif low in UNIT_WORDS:
        kind = UNIT
    else:
        kind = PLAIN if len(token) == 1 or not token[0].isupper() or not token[1:].islower() else START if low in COMMON_WORDS else TITLE
    return xxhash.xxh64_intdigest(low) & ~7 | kind


class Words(NamedTuple):
    """Of each word of a text: the hash of its canonical word, of the word as it stands, what slot it is (or ``PLAIN``), and
    whether it begins a sentence."""

    canonical: np.ndarray
    raw: np.ndarray
    kinds: np.ndarray
    opens: np.ndarray


class Canonical:
    """Canonical words of texts; remembers up to ``most`` tokens."""

    def __init__(self, most: int = 400_000):
        self.most, self.memo = most, {}

    def __call__(self, text: str | None) -> Words:
        tokens, memo = TOKEN.findall(text or ""), self.memo
        try:
            codes = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
        except KeyError:
            if len(memo) > self.most:
                memo.clear()
            memo.update((t, _token(t)) for t in set(tokens).difference(memo))
            codes = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
        kind = codes & KIND
        before = np.concatenate([[np.uint64(MARK)], kind[:-1]]) if len(kind) else kind
        word, raw = kind != MARK, codes & ~KIND
        number, unit, name = kind == NUMBER, (kind == UNIT) & (before == NUMBER), (kind == TITLE) | ((kind == START) & (before != MARK))
        out, slots = raw.copy(), np.zeros(len(raw), np.uint8)
        for at, kind_of in ((number, NUMBER), (unit, UNIT), (name, TITLE)):
            out[at], slots[at] = PLACEHOLDERS[kind_of], kind_of
        return Words(out[word], raw[word], slots[word], (before == MARK)[word])


def window_hashes(canonical: np.ndarray, window: int) -> np.ndarray:
    n = len(canonical) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h = (h ^ (canonical[k : k + n] * MIX)) * MIX
        h ^= h >> np.uint64(29)
    return h


def _windows_sum(flags: np.ndarray, window: int) -> np.ndarray:
    total = np.append(0, np.cumsum(flags))
    return total[window:] - total[: len(total) - window] if len(flags) >= window else np.zeros(0, np.int64)


class Table:
    """Sorted hashes with the item and the place that each comes from."""

    def __init__(self, rows: list[tuple[np.ndarray, int, np.ndarray]]):
        hashes = np.concatenate([h for h, _, _ in rows])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.concatenate([np.full(len(h), i) for h, i, _ in rows])[order]
        self.place = np.concatenate([p for _, _, p in rows])[order]
        self.mask = np.uint64((1 << max(16, 4 + len(hashes).bit_length())) - 1)
        self.sieve = np.zeros(int(self.mask) + 1, bool)
        self.sieve[self.hashes & self.mask] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place in the item, place among ``hashes``) of every equal hash."""
        at = np.flatnonzero(self.sieve[hashes & self.mask])
        low, high = (np.searchsorted(self.hashes, hashes[at], side) for side in ("left", "right"))
        n = high - low
        which = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        return self.item[which], self.place[which], np.repeat(at, n)


class Sums:
    """Hashes of all runs of any length in a sequence of words, from its running sums."""

    FACTOR = 0x9E3779B97F4A7C15
    powers = np.ones((2, 1), np.uint64)

    def __init__(self, hashes: np.ndarray):
        if Sums.powers.shape[1] < len(hashes):
            factors = (self.FACTOR, pow(self.FACTOR, -1, 1 << 64))
            Sums.powers = np.array([np.cumprod(np.append(np.uint64(1), np.full(2 * len(hashes), f, np.uint64))) for f in factors])
        self.sums = np.append(np.uint64(0), np.cumsum((hashes ^ hashes >> np.uint64(29)) * Sums.powers[0, : len(hashes)]))

    def runs(self, length: int) -> np.ndarray:
        n = max(0, len(self.sums) - length)
        h = (self.sums[length:] - self.sums[:n]) * Sums.powers[1, :n] if n else np.zeros(0, np.uint64)
        return h ^ h >> np.uint64(29)


class Items:
    """The words of a block of benchmark items with their usable windows; items without one as whole sequences, by length."""

    def __init__(self, rows: list[tuple[int, str]], window: int, literals: int):
        canonical = Canonical()
        self.items, seeds, whole = [], {}, {}
        for item_id, text in rows:
            words, found = canonical(text), False
            n = len(words.raw)
            for width in {window, max(3, n // 2)} if window < n < 2 * window else {window}:
                usable = np.flatnonzero(_windows_sum(words.kinds == PLAIN, width) >= literals)
                if len(usable):
                    seeds.setdefault(width, []).append((window_hashes(words.canonical, width)[usable], len(self.items), usable))
                    found = True
            if not found and n:
                plain = int((words.kinds == PLAIN).sum())
                for hashes, is_raw in ((words.raw, True), (words.canonical, False)) if plain >= literals else ((words.raw, True),):
                    whole.setdefault((n, is_raw), []).append((Sums(hashes).runs(n), len(self.items), np.zeros(1, np.int64)))
            self.items.append((item_id, words))
        self.whole = {of: Table(own) for of, own in whole.items()}
        self.window, self.seeds = window, {width: Table(own) for width, own in seeds.items()}
        self.sizes = np.array([len(words.raw) for _, words in self.items], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.raw, self.kinds = (np.concatenate([np.zeros(0, t), *(words[f] for _, words in self.items)]) for f, t in ((1, np.uint64), (2, np.uint8)))

    def worthwhile(self, doc: Words, item: np.ndarray, place: np.ndarray, at: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(item, places, places in the document) of the hits that may lie on a chain with the share ``least`` of the item's words.

        Hits of an item are split where their shifts are further apart than a chain may jump.  A chain aligns words at shifts of
        its hits only, so a split's words that are alike at any of its shifts are at least those that a chain covers."""
        shift = at - place
        order = np.lexsort((shift, item))
        item, place, at, shift = item[order], place[order], at[order], shift[order]
        other = np.append(True, item[1:] != item[:-1])
        split = np.cumsum(other | np.append(True, shift[1:] - shift[:-1] > self.sizes[item[1:]])) - 1
        pairs = np.flatnonzero(other | np.append(True, shift[1:] != shift[:-1]))
        sizes = self.sizes[item[pairs]]
        row = np.repeat(np.arange(len(pairs)), sizes)
        word = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        there = word + shift[pairs][row]
        inside = np.flatnonzero((there >= 0) & (there < len(doc.raw)))
        row, word, there = row[inside], word[inside], there[inside]
        flat = self.starts[item[pairs]][row] + word
        alike = (self.raw[flat] == doc.raw[there]) | ((self.kinds[flat] != PLAIN) & (self.kinds[flat] == doc.kinds[there]))
        heads = np.flatnonzero(np.append(True, split[1:] != split[:-1]))
        n = self.sizes[item[heads]]
        seen = np.zeros(n.sum(), bool)
        seen[(np.cumsum(n) - n)[split[pairs]][row[alike]] + word[alike]] = True
        enough = np.add.reduceat(seen, np.cumsum(n) - n, dtype=np.int64) / n >= least[item[heads]]
        ends = np.append(heads[1:], len(item))
        for k in np.flatnonzero(enough).tolist():
            own = slice(heads[k], ends[k])
            yield int(item[heads[k]]), place[own], at[own]

    def found(self, doc: Words, coverage: float) -> Iterator[tuple]:
        """(item id, coverage, first word, last word, slots, reparameterised) of the items that the document holds."""
        best = {}
        for width, table in self.seeds.items():
            item, place, at = table.hits(window_hashes(doc.canonical, width))
            if not len(item):
                continue
            least = np.full(len(self.items), coverage) if width == self.window else np.maximum(coverage, (self.sizes - 1) / np.maximum(self.sizes, 1))
            for i, places, found_at in self.worthwhile(doc, item, place, at, least):
                words = self.items[i][1]
                for chain in chains(places, found_at, width, len(words.raw)):
                    judged = judge(words, doc, aligned(words, doc, chain))
                    if judged and judged[0] >= least[i] and (i not in best or (judged[0], -judged[1]) > (best[i][0], -best[i][1])):
                        best[i] = judged
        sums = {is_raw: Sums(doc.raw if is_raw else doc.canonical) for is_raw in {is_raw for _, is_raw in self.whole}}
        for (n, is_raw), table in self.whole.items():
            for i, _, at in zip(*(a.tolist() for a in table.hits(sums[is_raw].runs(n)))):
                judged = judge(self.items[i][1], doc, np.arange(at, at + n))
                if judged and judged[0] == 1 and (i not in best or (1, -judged[1]) > (best[i][0], -best[i][1])):
                    best[i] = judged
        for i, judged in best.items():
            yield self.items[i][0], *judged


def chains(place: np.ndarray, at: np.ndarray, window: int, n_words: int) -> Iterator[list[tuple[int, int, int]]]:
    """The hits of an item in a document as chains, most words first: runs (first place, place after the last, shift) that
    rise in the item and in the document.  A place of either is in one run of a chain at most, a run in one chain at most."""
    shift = at - place
    order = np.lexsort((place, shift))
    place, shift = place[order], shift[order]
    new = np.append(True, (shift[1:] != shift[:-1]) | (place[1:] > place[:-1] + window))
    first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(place)) - 1
    runs = sorted(zip(place[first].tolist(), (place[last] + window).tolist(), shift[first].tolist()), key=lambda r: (r[0] + r[2], r[0]))
    score, before, oldest = [], [], 0
    for k, (begin, end, d) in enumerate(runs):
        best, of = float(end - begin), -1
        while runs[oldest][0] + runs[oldest][2] < begin + d - 2 * n_words:
            oldest += 1
        for r in range(oldest, k):
            r_begin, r_end, r_d = runs[r]
            if r_begin < begin and abs(d - r_d) <= n_words:
                more = end - max(begin, r_end, r_end + r_d - d)
                if more > 0 and score[r] + more - abs(d - r_d) / (2 * n_words) > best:
                    best, of = score[r] + more - abs(d - r_d) / (2 * n_words), r
        score.append(best)
        before.append(of)
    used = [False] * len(runs)
    for k in sorted(range(len(runs)), key=lambda k: -score[k]):
        chain = []
        while k >= 0 and not used[k]:
            used[k] = True
            chain.append(runs[k])
            k = before[k]
        if chain:
            yield chain[::-1]


def _alike(item: Words, doc: Words, places: np.ndarray, shift: int) -> np.ndarray:
    """Whether the words at ``places`` of the item and ``shift`` further in the document are equal or slots of one kind."""
    at = places + shift
    return (item.raw[places] == doc.raw[at]) | ((item.kinds[places] != PLAIN) & (item.kinds[places] == doc.kinds[at]))


def _reach(alike: np.ndarray) -> int:
    """How far a run goes on over ``alike`` words: to where most more are alike than not."""
    total = np.cumsum(np.where(alike, 1, -1))
    best = len(total) - 1 - int(np.argmax(total[::-1])) if len(total) else -1
    return best + 1 if best >= 0 and total[best] >= 0 else 0


def aligned(item: Words, doc: Words, chain: list[tuple[int, int, int]]) -> np.ndarray:
    """For each place of the item the place in the document that the chain gives it, or -1; runs are carried on to both sides."""
    out = np.full(len(item.raw), -1)
    done, d = 0, None  # the item's places before ``done`` are settled
    for begin, end, shift in chain:
        if d is None:
            lead = np.arange(begin - 1, max(0, -shift) - 1, -1)
            begin -= _reach(_alike(item, doc, lead, shift))
        elif shift == d:
            begin = done
        else:
            begin = max(begin, done, done + d - shift)
            gap = np.arange(done, min(begin, begin + shift - d))
            n = int(np.argmin(np.append(_alike(item, doc, gap, d), False)))
            out[done : done + n] = gap[:n] + d
            done += n
            gap = np.arange(begin - 1, max(done, done + d - shift) - 1, -1)
            begin -= int(np.argmin(np.append(_alike(item, doc, gap, shift), False)))
        out[begin:end] = np.arange(begin, end) + shift
        done, d = end, shift
    rest = np.arange(done, max(done, min(len(out), len(doc.raw) - d)))
    n = _reach(_alike(item, doc, rest, d))
    out[done : done + n] = rest[:n] + d
    return out


def judge(item: Words, doc: Words, at: np.ndarray) -> tuple[float, int, int, int, bool] | None:
    """(coverage, first word, last word, slots, reparameterised), or None if a name stands for several others.

    Numbers and units are judged place by place.  A name of the item has one name in the document; where it stays itself
    elsewhere, or only begins sentences and so may be no name, the others are changed words, which are not covered."""
    places = np.flatnonzero(at >= 0)
    raw, own, kinds = item.raw[places], doc.raw[at[places]], item.kinds[places]
    same = raw == own
    slot = (kinds != PLAIN) & (kinds == doc.kinds[at[places]])
    covered = same | slot
    for name in np.unique(raw[(kinds == TITLE) & slot & ~same]):
        here = (raw == name) & (kinds == TITLE) & slot
        values, n = np.unique(own[here], return_counts=True)
        if len(values[values != name]) > 1 and not item.opens[(item.raw == name) & (item.kinds == TITLE)].all():
            return None
        covered &= ~here | (own == (name if name in values else values[np.argmax(n)]))
    found = places[covered]
    if not len(found):
        return None
    changed = covered & ~same
    return len(found) / len(at), int(at[found[0]]), int(at[found[-1]]), len(np.unique(raw[covered & slot])), bool(changed.any())


def _judged(docs: DataFrame, benchmark: DataFrame, window: int = 5, coverage: float = 0.6, literals: int = 3, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", block_windows: int = 100_000) -> DataFrame:
    """``id`` (``doc_id``, ``key``: hash of the text) and what :meth:`Items.found` gives, for each row of ``docs``."""
    items = benchmark.select(F.col(f"`{item_id_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    items = cut_lineage(items, "benchmark")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // (4 * block_windows)))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    rows = texts.select(F.struct("doc_id", F.xxhash64("text").alias("key")).alias("id"), "text")

    def judged(block: int) -> DataFrame:
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        shared = docs.sparkSession.sparkContext.broadcast(Items([(r.item_id, r.text) for r in own], window, literals))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            canonical, held = Canonical(), shared.value
            for whole in batches:
                for start in range(0, whole.num_rows, 256):
                    batch = whole.slice(start, 256)
                    found = [(k, *f) for k, t in enumerate(batch.column("text").to_pylist()) for f in held.found(canonical(t), coverage)]
                    if found:
                        at, *cells = zip(*found)
                        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), *(pa.array(c, t) for c, t in zip(cells, KINDS))], NAMES)

        return rows.mapInArrow(run, "id struct<doc_id:long,key:long>, item_id long, coverage double, first_word int, last_word int, n_slots int, reparameterised boolean")

    return reduce(DataFrame.unionAll, [judged(b) for b in range(blocks)])


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``item_id``, ``coverage``, ``first_word``, ``last_word`` (places of the passage in the document, from 0),
    ``n_slots`` (distinct slot values), ``reparameterised``: one row for each document and item where at least ``coverage``
    of the item's words stand in one chain with consistent slots.  For an item the best place is reported.

    NULL ids of documents are kept, NULL texts and items without a word match nothing, an item without a usable window only
    whole (one of a single word is found wherever the word is); an item id with several texts
    is matched by each, the best is reported; repeated rows count once; empty tables give an empty result.  ``options``:
    ``window``, ``coverage``, ``literals``, ``block_windows`` and the columns' names, see :func:`_judged`."""
    best = F.struct("coverage", (-F.col("first_word")).alias("place"), (-F.col("last_word")).alias("end"), "n_slots", "reparameterised")
    out = _judged(docs, benchmark, **options).groupBy("id.doc_id", "item_id").agg(F.max(best).alias("b"))
    return out.select("doc_id", "item_id", "b.coverage", (-F.col("b.place")).alias("first_word"), (-F.col("b.end")).alias("last_word"), "b.n_slots", "b.reparameterised")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, told by id (NULL too) and text."""
    bad = _judged(docs, benchmark, **options).select(F.col("id.doc_id").alias("bad_id"), F.col("id.key").alias("bad_key")).distinct()
    names = [f"c{k}" for k in range(len(docs.columns))]  # columns of docs may have any names
    own = docs.toDF(*names)
    doc_id, text = (own[names[docs.columns.index(options.get(*c))]] for c in (("id_col", "doc_id"), ("text_col", "text")))
    same = doc_id.cast("long").eqNullSafe(bad["bad_id"]) & (F.xxhash64(text.cast("string")) == bad["bad_key"])
    return own.join(bad, same, "left_anti").toDF(*docs.columns)

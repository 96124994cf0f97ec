"""Repair of the structure of conversations by cheapest edits, ranked by prefix doubling.

A conversation's rows pass a machine of four states (nothing yet, after ``s``, after ``u``, after ``a``), whose accepted role
initials are ``(s?(ua)+)?``.  A row is kept, given another role or deleted, and rows may be inserted before it or at the end;
a node is a place between rows with a state, an arc an edit.

1. *Order.*  Rows are dealt out by range of (conversation, turn, ..) and numbered; a long conversation lies in many partitions.
   ``SEGMENT`` numbers make a segment.  A row is a duplicate if it isn't the first of its role and text (an aggregate).
2. *Cost.*  Every row is a 4 x 4 matrix of least costs; products of 1, 2, 4.. rows (least sum) give the cost to the end of the
   segment's part of a conversation.  Conversations that touch a segment's edge are put together from the matrices of
   their parts, one matrix for up to ``SEGMENT`` rows.
3. *Rank.*  Arcs that keep the least cost are optimal.  Nodes are ranked by the first 1, 2, 4.. letters of their audits: the rank
   of 2n letters is that of the pair (own rank, rank of the node n letters on), and the pointer n letters on is doubled with
   it.  Ranks select among a node's optimal arcs, and the doubled pointers lay out the least path of all conversations
   side by side.

No conversation is held as a whole: what a task holds is a segment's codes, one byte a row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.session import cut_lineage

#: Rows of a segment, as bits.
SEGMENT = 16
SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, BROKEN = 2, 5, 1, 5
LETTERS = np.frombuffer(b"DIKR", np.uint8)
FAR = np.int64(1) << 40
#: State after a row of the role that is next: user, or assistant after a user.
NEXT = np.array([2, 2, 3, 2])
#: State after keeping a row of role class 0 other, 1 s, 2 u, 3 a (-1: not allowed).
KEPT = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])
#: Cost of ending in a state.
ENDS = np.array([0, FAR, FAR, 0])
#: Bits of a row's code above its role class.
FORCED, TRUNCATED = 4, 8
PIECE = "conv_id long, first_at long, codes binary, initials binary, open boolean, blank long, duplicate long, truncated long, illegal long, matrix array<long>"


def _least_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(axis=2), FAR)


def _insertions() -> np.ndarray:
    c = np.full((4, 4), FAR)
    np.fill_diagonal(c, 0)
    c[np.arange(4), NEXT] = INSERT
    return _least_sum(c[None], c[None])[0]


def _row_matrices() -> np.ndarray:
    """Least cost from state to state over a row of each code, insertions before it included."""
    edits = np.full((16, 4, 4), FAR)
    for code in range(16):
        for q in range(4):
            edits[code, q, q] = DELETE
            if not code & FORCED:
                broken = BROKEN if code & TRUNCATED else 0
                edits[code, q, NEXT[q]] = min(edits[code, q, NEXT[q]], REROLE + broken)
                if KEPT[q, code & 3] >= 0:
                    edits[code, q, KEPT[q, code & 3]] = broken
    return _least_sum(np.broadcast_to(_insertions(), edits.shape), edits)


INSERTIONS, ROWS = _insertions(), _row_matrices()


def matrices(codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each row, the product of the matrices from it to the end of its piece (``size``: rows of each piece, none empty)."""
    out, end, at, span = ROWS[codes], np.repeat(np.cumsum(size), size), np.arange(len(codes)), 1
    while span < size.max(initial=0):
        more = at[at + span < end]
        out[more] = _least_sum(out[more], out[more + span])
        span *= 2
    return out


def least_audits(codes: np.ndarray, size: np.ndarray, ends: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The least of the cheapest audits of each piece that is entered in state ``entry``, ``ends`` being the cost after its
    last row by state: (letters of all pieces in a row, row or insertion's row of each letter, state before each letter,
    number of letters of each piece, states in which the pieces end when entered in any of the four states)."""
    pieces, n = len(size), len(codes)
    full = (INSERTIONS[None] + ends[:, None, :]).min(axis=2)
    first = np.cumsum(size) - size
    piece = np.repeat(np.arange(pieces), size)
    row, stop = np.arange(n) + piece, np.cumsum(size) + np.arange(pieces)  # places: the rows and one end for each piece
    cost = np.empty((n + pieces, 4), np.int64)
    cost[row] = (matrices(codes, size) + full[piece][:, None, :]).min(axis=2)
    cost[stop] = full
    # optimal arcs of each node, in order of their letters
    to, optimal = np.zeros((n + pieces, 4, 4), np.int64), np.zeros((n + pieces, 4, 4), bool)
    free, broken = codes & FORCED == 0, np.where(codes & TRUNCATED, BROKEN, 0)
    for q in range(4):
        kept = KEPT[q, codes & 3]
        for letter, state, price, allowed in ((0, q, DELETE, True), (2, kept, broken, free & (kept >= 0)), (3, NEXT[q], REROLE + broken, free)):
            to[row, q, letter] = (row + 1) * 4 + state
            optimal[row, q, letter] = allowed & (price + cost[row + 1, state] == cost[row, q])
        to[:, q, 1] = np.arange(n + pieces) * 4 + NEXT[q]
        optimal[row, q, 1] = INSERT + cost[row, NEXT[q]] == cost[row, q]
        optimal[stop, q, 1] = ends[:, q] != cost[stop, q]
    to, optimal = to.reshape(-1, 4), optimal.reshape(-1, 4)
    ended, nodes = ~optimal.any(axis=1), np.arange(4 * (n + pieces))
    # ranks by 1, 2, 4.. letters with pointers as far; no letter ranks lowest
    rank = np.where(ended, 0, optimal.argmax(axis=1) + 1)
    jumps, steps = [np.where(ended, nodes, to[nodes, rank - 1])], [(~ended).astype(np.int64)]
    while not ended[jumps[-1]].all():
        rank = np.unique(rank * (len(nodes) + 1) + rank[jumps[-1]], return_inverse=True)[1]
        steps.append(steps[-1] + steps[-1][jumps[-1]])
        jumps.append(jumps[-1][jumps[-1]])
    audit = np.where(optimal, np.arange(4) * (len(nodes) + 1) + rank[to], 4 * (len(nodes) + 1) + 1)
    chosen = audit.argmin(axis=1)
    start = (first + np.arange(pieces)) * 4
    length = steps[-1][start + entry]
    place = np.repeat(start + entry, length)
    step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    for k, jump in enumerate(jumps):
        ahead = (step >> k) & 1 == 1
        place[ahead] = jump[place[ahead]]
    return LETTERS[chosen[place]], place // 4 - np.repeat(np.arange(pieces), length), place % 4, length, jumps[-1][start[:, None] + np.arange(4)] % 4


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults: crc32 of ``conv_id:turn`` modulo 20 is 0: dropped, 1: text emptied, 2: text without
    ``.!?``, 3: there twice, 4: role user.  A NULL is one space in that key, and a NULL role or text becomes one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = conversations.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("again", F.explode(F.sequence(F.lit(1), "times"))).select("conv_id", "turn", "role", "text")


def ordered(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A written table of the rows with ``at``, a number that rises by 1 within a partition, in order of conversation and turn
    (NULL first); rows of one turn by role, first 64 characters of the text, and a hash of it."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    own = rows.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    own = own.withColumns({"head": F.substring("text", 1, 64), "hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    by = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "head", "hash", "row")]  # equal rows can be split too
    dealt = own.repartitionByRange(*by).sortWithinPartitions(*by).select("conv_id", "turn", "role", "text")
    return cut_lineage(dealt.withColumn("at", F.monotonically_increasing_id()), "conversations")


def _illegal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return ~(((before == 1) | (before == 3)) & (after == 2) | (before == 2) & (after == 3))


def pieces_of(table: DataFrame) -> DataFrame:
    """One row for each conversation in each segment of the ordered ``table``: codes, counts of faults, and, if it touches
    the segment's edge, the matrix of its costs."""
    bare = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    lean = table.select(
        F.shiftright("at", SEGMENT).alias("segment"), "at", "conv_id", kind.alias("kind"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    first = table.where(bare != "").groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("at").alias("at"))
    first = first.select(F.shiftright("at", SEGMENT).alias("own_segment"), "at")

    def run(rows: pa.Table, originals: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        at, kind = rows.column("at").to_numpy(), rows.column("kind").to_numpy().astype(np.int64)
        blank, cut = (rows.column(c).to_numpy().astype(bool) for c in ("blank", "cut"))
        again = ~blank & ~np.isin(at, originals.column("at").to_numpy())
        cut = cut & ~blank & ~again
        codes = (kind + FORCED * (blank | again) + TRUNCATED * cut).astype(np.uint8)
        conv = rows.column("conv_id")
        value, none = conv.fill_null(0).to_numpy(), conv.is_null().to_numpy()
        begin = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (none[1:] != none[:-1])))
        size = np.diff(np.append(begin, len(at)))
        bad = np.append(_illegal(kind[:-1], kind[1:]), False)
        bad[begin[1:] - 1] = False
        open_ = np.zeros(len(begin), bool)
        open_[[0, -1]] = True
        product = [None] * len(begin)
        for p in np.unique([0, len(begin) - 1]).tolist():
            own = slice(begin[p], begin[p] + size[p])
            product[p] = matrices(codes[own], size[p : p + 1])[0].ravel().tolist()
        cells = {
            "conv_id": conv.take(pa.array(begin)).combine_chunks(), "first_at": at[begin], "codes": [codes[b : b + s].tobytes() for b, s in zip(begin.tolist(), size.tolist())],
            "initials": [bytes([kind[b], kind[b + s - 1]]) for b, s in zip(begin.tolist(), size.tolist())], "open": open_, "matrix": product,
        } | {n: np.add.reduceat(v.astype(np.int64), begin) for n, v in (("blank", blank), ("duplicate", again), ("truncated", cut), ("illegal", bad))}
        return pa.Table.from_arrays([v if isinstance(v := cells[n], pa.Array) else pa.array(v, t) for n, t in PIECE_TYPES.items()], list(PIECE_TYPES))

    found = lean.groupBy("segment").cogroup(first.groupBy("own_segment")).applyInArrow(run, PIECE)
    return cut_lineage(found, "conversation-pieces")


PIECE_TYPES = dict(zip((c.split()[0] for c in PIECE.split(", ")), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_(), *[pa.int64()] * 4, pa.list_(pa.int64()))))


def _batches(frame: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` on batches of pieces with up to ``2 ** SEGMENT`` rows together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([len(c) for c in batch.column("codes").to_pylist()], np.int64)
            group = np.cumsum(rows) >> SEGMENT
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(group)) + 1):
                if len(part):
                    own = batch.slice(int(part[0]), len(part))
                    codes = own.column("codes").to_pylist()
                    yield fn(own, np.frombuffer(b"".join(codes), np.uint8).astype(np.int64), rows[part])

    return frame.mapInArrow(run, schema)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(batch.num_rows, -1)


def _joined_ends(pieces: DataFrame) -> DataFrame:
    """``first_at``, ``ends``, ``entry``, ``between`` of the pieces that touch a segment's edge: the cost after each piece by
    state (less the least of them), the state in which it is entered, whether its first row doesn't go with the row before."""
    open_ = pieces.where("open")

    def backward(table: pa.Table) -> pa.Table:
        table = table.sort_by("first_at")
        product, ends, after = np.array(table.column("matrix").to_pylist(), np.int64).reshape(-1, 4, 4), [], ENDS
        for m in product[::-1]:
            ends.append((after - after.min()).tolist())
            if len(ends) == 1:
                after = (INSERTIONS + after).min(axis=1)
            after = (m + after).min(axis=1)
        kinds = [(i[0], i[1]) for i in table.column("initials").to_pylist()]
        between = [False] + [bool(_illegal(np.array(a[1]), np.array(b[0]))) for a, b in zip(kinds, kinds[1:])]
        final = [False] * (len(ends) - 1) + [True]
        return pa.Table.from_arrays([table.column("first_at").combine_chunks(), pa.array(ends[::-1], pa.list_(pa.int64())), pa.array(between), pa.array(final)], ["first_at", "ends", "between", "final"])

    ends = open_.groupBy("conv_id").applyInArrow(backward, "first_at long, ends array<long>, between boolean, final boolean")

    def leave(batch: pa.RecordBatch, codes: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        *_, exits = least_audits(codes, size, _column(batch, "ends"), np.zeros(len(size), np.int64))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "first_at", "ends", "between")), pa.array(exits.tolist(), pa.list_(pa.int64()))], ["conv_id", "first_at", "ends", "between", "exits"])

    left = _batches(open_.select("conv_id", "first_at", "codes").join(ends, "first_at"), leave, "conv_id long, first_at long, ends array<long>, between boolean, exits array<long>")

    def forward(table: pa.Table) -> pa.Table:
        table, entry, state = table.sort_by("first_at"), [], 0
        for exits in table.column("exits").to_pylist():
            entry.append(state)
            state = exits[state]
        return table.select(["first_at", "ends", "between"]).append_column("entry", pa.array(entry, pa.int64()))

    return cut_lineage(left.groupBy("conv_id").applyInArrow(forward, "first_at long, ends array<long>, between boolean, entry long"), "conversation-ends")


class Repair:
    """The cheapest repair of each conversation; of equally cheap ones that whose audit is least in ASCII.

    Rows go by turn (NULL first), rows of one turn by role and text (first 64 characters, then a hash).  Role initials must
    come out as ``(s?(ua)+)?``.  Keep costs 0, a new role (user or assistant) 1, Delete 2, Insert (user or assistant, without
    text) 5; blank rows and repeats of an earlier role and text have to be deleted, and a row that doesn't end in ``.!?`` adds
    5 unless it is deleted.  NULL roles and texts count as one space, rows with a NULL conversation as one conversation; an
    empty table gives empty results; extra columns take no part."""

    def __init__(self, conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"):
        self.table = ordered(conversations, conv_col, turn_col, role_col, text_col)
        pieces = pieces_of(self.table)
        closed = pieces.where("not open").select(*PIECE_TYPES, F.lit(ENDS.tolist()).cast("array<long>").alias("ends"), F.lit(False).alias("between"), F.lit(0).cast("long").alias("entry"))
        edges = pieces.where("open").join(_joined_ends(pieces), "first_at").select(closed.columns)

        def audit(batch: pa.RecordBatch, codes: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
            letters, row, state, length, _ = least_audits(codes, size, _column(batch, "ends"), batch.column("entry").to_numpy())
            end = np.cumsum(length)
            raw, states = letters.tobytes(), state.astype(np.uint8).tobytes()
            price = np.where(letters == ord("D"), DELETE, np.where(letters == ord("I"), INSERT, np.where(letters == ord("R"), REROLE, 0)))
            kept = (letters == ord("K")) | (letters == ord("R"))
            price[kept] += np.where(codes[row[kept]] & TRUNCATED, BROKEN, 0)
            running = np.append(0, np.cumsum(price))
            spans = list(zip((end - length).tolist(), end.tolist()))
            cells = [*(batch.column(c) for c in names[:6]), batch.column("between"), pa.array(running[end] - running[end - length]), pa.array([raw[a:b].decode() for a, b in spans], pa.string()), pa.array([states[a:b] for a, b in spans], pa.binary())]
            return pa.RecordBatch.from_arrays(cells, names)

        names = ["conv_id", "first_at", "blank", "duplicate", "truncated", "illegal", "between", "cost", "audit", "states"]
        schema = "conv_id long, first_at long, blank long, duplicate long, truncated long, illegal long, between boolean, cost long, audit string, states binary"
        self.parts = cut_lineage(_batches(closed.unionByName(edges), audit, schema), "conversation-audits")

    def edits(self) -> DataFrame:
        """``conv_id``, ``at``, ``step``, ``edit``, ``role`` (initial of a new role): one row for each edit, in order of (``at``,
        ``step``); an insertion has the ``at`` of the row that it comes before, or one more than the last."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for conv, first, audit, states in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "first_at", "audit", "states"))):
                    letters, state = np.frombuffer(audit.encode(), np.uint8), np.frombuffer(states, np.uint8)
                    consumed = letters != ord("I")
                    at = first + np.cumsum(consumed) - consumed
                    role = np.where((letters == ord("R")) | ~consumed, np.where(state == 2, "a", "u"), "")
                    yield pa.RecordBatch.from_arrays([pa.array([conv] * len(at), pa.int64()), pa.array(at), pa.array(np.arange(len(at))), pa.array(list(audit), pa.string()), pa.array(role.tolist(), pa.string())], ["conv_id", "at", "step", "edit", "role"])

        return self.parts.select("conv_id", "first_at", "audit", "states").mapInArrow(run, "conv_id long, at long, step long, edit string, role string")

    def rows(self) -> DataFrame:
        """The repaired rows, in order of (``at``, ``step``) within ``conv_id``: ``turn`` (NULL if inserted), ``role``, ``text``, ``edit``."""
        own = self.table.select("at", "turn", F.col("role").alias("own"), "text")
        edits = self.edits().where("edit <> 'D'")
        new = F.when(F.col("role") == "a", "assistant").when(F.col("role") == "u", "user")
        kept = edits.where("edit <> 'I'").join(own, "at").select("conv_id", "at", "step", "turn", F.coalesce(new, "own").alias("role"), "text", "edit")
        added = edits.where("edit = 'I'").select("conv_id", "at", "step", F.lit(None).cast("long").alias("turn"), new.alias("role"), F.lit("").alias("text"), "edit")
        return kept.unionByName(added)

    def summary(self) -> DataFrame:
        """Of each conversation with rows: ``gaps`` in its turns, counts of rows by first fault, ``illegal`` neighbours, ``cost``, ``audit``."""
        turns = self.table.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
        sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")]
        audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_at", "audit"))), lambda x: x["audit"]), "")  # one row for 65,536 rows or less
        found = self.parts.groupBy("conv_id").agg(*sums, F.sum(F.col("illegal") + F.col("between").cast("long")).alias("illegal"), audit.alias("audit"))
        return found.join(turns, found["conv_id"].eqNullSafe(turns["conv_id"])).select(found["conv_id"], "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def digests(self) -> DataFrame:
        """``conv_id``, ``repaired_sha256`` of the repaired lines ``role:text``, newline-joined, of conversations that keep any.  A
        conversation's lines are streamed through one hash in order, a batch at a time."""
        lines = self.rows().select("conv_id", "at", "step", F.concat_ws(":", "role", "text").alias("line"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, digest, done = None, None, []
            for batch in batches:
                for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                    if digest is None or conv != current:
                        if digest is not None:
                            done.append((current, digest.hexdigest()))
                        current, digest = conv, hashlib.sha256(line.encode())
                    else:
                        digest.update(b"\n" + line.encode())
                if len(done) > 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.string()))], ["conv_id", "repaired_sha256"])
                    done = []
            if digest is not None:
                done.append((current, digest.hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.string()))], ["conv_id", "repaired_sha256"])

        dealt = lines.repartition("conv_id").sortWithinPartitions("conv_id", "at", "step")
        return dealt.mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Summary and digest of the repair of ``rows`` for every ``conv_id`` of ``conversations``; one without rows has zeros, an
    empty audit and the digest of nothing."""
    repair = Repair(rows)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256(b"").hexdigest()
    kinds = {"conv_id": "long", **dict.fromkeys(numbers, "long"), "audit": "string", "repaired_sha256": "string"}
    parts = [conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), repair.summary(), repair.digests()]
    every = [p.select(*[(F.col(c) if c in p.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]) for p in parts]
    out = every[0].unionAll(every[1]).unionAll(every[2]).groupBy("conv_id").agg(*[F.max(c).alias(c) for c in [*numbers, "audit", "repaired_sha256"]])
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))

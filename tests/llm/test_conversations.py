import hashlib
import random
import re
import sys
import zlib
from functools import cache
from itertools import product

import numpy as np
import pytest

from shelfspark.llm import conversations
from shelfspark.llm.conversations import ENDS, Repair, damage, least_audits, repair_report

SCHEMA = "conv_id long, turn long, role string, text string, at long, codes string, audit string, cost string, open string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", "a", "c", "o") for r in rows], SCHEMA)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(rows):
    """blank, duplicate, truncated or none for each (role, text)."""
    out = []
    for n, (role, text) in enumerate(rows):
        seen = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("blank" if not seen else "duplicate" if (role, text) in rows[:n] else "truncated" if seen[-1] not in ".!?" else "")
    return out


def cheapest(rows, fault):
    """(cost, audit) by recursion over all edits; insertions never help more than three in a row."""

    @cache
    def best(at, out, inserted):
        found = [(0, "")] if at == len(rows) and LEGAL.match(out) else []

        def add(cost, letter, *node):
            rest = best(*node)
            if rest:
                found.append((cost + rest[0], letter + rest[1]))

        def short(o):  # what decides what may follow
            return o if o in ("", "s") else "ua" if o.endswith("a") else "u"

        if inserted < 3:
            for role in "ua":
                if LEGAL.match(out + role) or LEGAL.match(out + role + "a"):
                    add(5, "I", at, short(out + role), inserted + 1)
        if at < len(rows):
            add(2, "D", at + 1, out, 0)
            if fault[at] not in ("blank", "duplicate"):
                more = 5 if fault[at] == "truncated" else 0
                for role, letter, cost in [(rows[at][0][:1], "K", 0), ("u", "R", 1), ("a", "R", 1)]:
                    if role in ("s", "u", "a") and (LEGAL.match(out + role) or LEGAL.match(out + role + "a") or (out + role == "s")):
                        add(cost + more, letter, at + 1, short(out + role), 0)
        return min(found) if found else None

    sys.setrecursionlimit(20_000)
    return best(0, "", 0)


def repaired(rows, audit):
    out, at = [], 0
    initials = ""
    for letter in audit:
        nxt = "assistant" if initials.endswith("u") else "user"
        if letter == "I":
            out.append((nxt, ""))
        else:
            if letter != "D":
                out.append((nxt if letter == "R" else rows[at][0], rows[at][1]))
            at += 1
        initials = "".join(r[:1] for r, _ in out)
    assert at == len(rows) and LEGAL.match(initials)
    return out


def expected(original, rows):
    found = []
    for conv in {r[0] for r in original}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        pairs = [(r[2], r[3]) for r in own]
        fault = faults(pairs)
        turns = [r[1] for r in own if r[1] is not None]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit = cheapest(pairs, tuple(fault))
        text = "\n".join(f"{r}:{t}" for r, t in repaired(pairs, audit))
        found.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(fault.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=lambda r: (r[0] is None, r[0] or 0))


def collected(frame):
    assert frame.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, frame.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def random_rows(seed, convs=40):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "It ends", "", " \t\n", "so. \x0b", "Ünï 漢。", "a.b", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "u", "Assistant", None]
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randint(1, 9)):
            for _ in range(rng.choice([1, 1, 1, 2])):
                rows.append((conv, rng.choice([turn, turn, turn * 3 - 2, None]), rng.choice(roles), rng.choice(texts)))
    return rows + rng.choices(rows, k=5)


@pytest.mark.parametrize("seed", range(3))
def test_report_against_recursion(spark, seed, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT", (16, 1, 2)[seed])  # conversations over many segments
    rows = random_rows(seed)
    if seed == 1:
        rows += [(900, n % 40, ("user", "assistant", "system")[n % 7 % 3], f"line {n % 60}" + ".?!,"[n % 4]) for n in range(150)]
    if seed == 2:
        rows += [(901, 4, "user", "the same.")] * 60
    out = collected(repair_report(table(spark, rows), damage(table(spark, rows))))
    assert out == expected(rows, damaged(rows))


def test_all_audits_of_short_conversations():
    """Every string of edits is tried."""
    rng = random.Random(9)
    for _ in range(150):
        codes = [rng.choice([0, 1, 2, 3, 5, 6, 9, 10, 11, 8]) for _ in range(rng.randint(1, 3))]
        best = None
        for length in range(len(codes) + 4):
            for audit in product("DIKR", repeat=length):
                if sum(x != "I" for x in audit) != len(codes):
                    continue
                cost, out, at, fine = 0, "", 0, True
                for x in audit:
                    nxt = "a" if out.endswith("u") else "u"
                    if x == "I":
                        cost, out = cost + 5, out + nxt
                        continue
                    code, at = codes[at], at + 1
                    cost += {"D": 2, "K": 0, "R": 1}[x]
                    if x != "D":
                        fine &= not code & 4 and (x == "R" or code & 3 > 0)
                        cost, out = cost + (5 if code & 8 else 0), out + (nxt if x == "R" else "?sua"[code & 3])
                if fine and LEGAL.match(out) and (best is None or (cost, "".join(audit)) < best):
                    best = cost, "".join(audit)
        letters, *_ = least_audits(np.array(codes), np.array([len(codes)]), ENDS[None], np.zeros(1, np.int64))
        assert letters.tobytes().decode() == best[1]


def test_rows_and_edges(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (1, 2, "user", "U."), (2, 0, "user", ""), (3, 5, "user", "Hi.")]
    repair = Repair(table(spark, rows))
    got = [(r.conv_id, r.turn, r.role, r.text, r.edit) for r in sorted(repair.rows().collect(), key=lambda r: (r.conv_id, r.at, r.step))]
    assert got == [(1, 0, "system", "S.", "K"), (1, 1, "user", "A.", "R"), (1, 2, "assistant", "U.", "R")]
    empty = table(spark, rows).where("conv_id < 0")
    assert repair_report(empty, empty).count() == 0
    zeros = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert collected(repair_report(table(spark, rows), empty)) == [(n, *zeros) for n in (1, 2, 3)]


def test_query_on_whole_table(spark):
    from shelfspark.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op12_conversation_repair"](spark, "/root/testdata/sf0.001")) == expected(rows, damaged(rows))

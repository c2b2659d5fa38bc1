"""Repair of conversations against an exhaustive search and a plain search that carries whole audits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from daybook.llm import conversations as conv
from daybook.llm.common import table
from daybook.llm.queries import CORPUS_QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")
NAMES = {"u": "user", "a": "assistant"}
SMALL = "/root/testdata/sf0.01"


def brute_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv_id, turn, "user" if kind == 4 else role, text)
        out += [] if kind == 0 else [row] * (2 if kind == 3 else 1)
    return out


def brute_faults(rows):
    seen, faults = set(), []
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "sound")
        seen.add((role, text))
    return faults


def outcome(rows, faults, way):
    """Cost and repaired rows of one audit given as the letters before and at each row, or None when it is not legal."""
    said, cost, at = [], 0, 0
    for letter in way:
        if letter == "I":
            state = "".join(r[:1] for r, _ in said)
            said.append((NAMES["a" if state.endswith("u") else "u"], ""))
            cost += 2
            continue
        _, _, role, text = rows[at]
        if letter == "D":
            cost += 3
        else:
            if faults[at] in ("blank", "duplicate"):
                return None
            state = "".join(r[:1] for r, _ in said)
            said.append((role if letter == "K" else NAMES["a" if state.endswith("u") else "u"], text))
            cost += (2 if letter == "R" else 0) + (faults[at] == "truncated")
        at += 1
    initials = "".join(r[:1] or "?" for r, _ in said)
    return (cost, "".join(way), said) if LEGAL.match(initials) else None


def exhaustive(rows, faults):
    gaps = ["", "I", "II"]
    ways = itertools.product(*[[g + e for g in gaps for e in "DKR"] for _ in rows], gaps)
    return min(filter(None, (outcome(rows, faults, "".join(w)) for w in ways)), key=lambda o: o[:2])


def searched(rows, faults):
    """All four states with whole audits, row by row."""
    best = {"": (0, "", [])}

    def closed(states):
        for _ in range(3):
            for state, (cost, audit, said) in list(states.items()):
                new = "u" if state in ("", "s", "a") else "a"
                here = (cost + 2, audit + "I", said + [(NAMES[new], "")])
                states[new] = min(states.get(new, here), here)
        return states

    for (_, _, role, text), fault in zip(rows, faults):
        found = {}
        for state, (cost, audit, said) in closed(best).items():
            new = "a" if state == "u" else "u"
            more = fault == "truncated"
            ways = [(state, (cost + 3, audit + "D", said))]
            if fault not in ("blank", "duplicate"):
                ways.append((new, (cost + 2 + more, audit + "R", said + [(NAMES[new], text)])))
                if role[:1] == new or role[:1] == "s" and state == "":
                    ways.append((role[:1], (cost + more, audit + "K", said + [(role, text)])))
            for to, way in ways:
                found[to] = min(found.get(to, way), way)
        best = found
    ends = closed(best)
    return min((ends[s] for s in ("", "a") if s in ends), key=lambda o: o[:2])


def expected(rows, damage=True, solve=searched):
    out = {}
    for conv_id in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == conv_id]
        mine = sorted(brute_damage(mine) if damage else [(c, t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in mine],
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = brute_faults(mine)
        cost, audit, said = solve(mine, faults) if mine else (0, "", [])
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        text = "\n".join(f"{r}:{t}" for r, t in said)
        out[conv_id] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def told(df):
    return {r.conv_id: tuple(r)[1:] for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def drawn(draw, conversations, most, first=0):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No", "Why?", "", " \t", None, "Go on!", "x. \n", "tail "]
    rows = []
    for conv_id in range(first, first + conversations):
        for turn in range(draw.randint(1, most)):
            rows.append((conv_id, draw.choice([turn, turn, turn, turn + 3, None]), draw.choice(roles), f"{draw.choice(texts) or ''}" if draw.random() < 0.9 else None))
    return rows


def test_divide_and_conquer_finds_the_least_of_the_cheapest_audits():
    draw = random.Random(4)
    for _ in range(150):
        rows = [r for r in brute_damage(drawn(draw, 1, 4))][:4]
        faults = brute_faults(rows)
        codes = "".join(conv.row_code(r[2][:1], f) for r, f in zip(rows, faults))
        best = exhaustive(rows, faults)
        assert "".join(conv.audit_of(codes + "$")) == best[1] == searched(rows, faults)[1]
        assert searched(rows, faults)[0] == best[0]


def test_long_conversations_and_their_pieces_agree_with_a_plain_search():
    draw = random.Random(5)
    for size in (1, 2, 63, 64, 65, 500):
        rows = [(1, t, draw.choice(["user", "assistant", "system", "x"]), draw.choice(["A.", "b", "", f"{t}."])) for t in range(size)]
        faults = brute_faults(rows)
        codes = "".join(conv.row_code(r[2][:1], f) for r, f in zip(rows, faults))
        whole = searched(rows, faults)[1]
        assert "".join(conv.audit_of(codes + "$")) == whole
        cuts = sorted({0, size, *(draw.randrange(size) for _ in range(6))})
        parts = [codes[a:b] for a, b in itertools.pairwise(cuts)] + ["$"]
        edges = conv.edge_states([conv.piece_table(p) for p in parts])
        assert "".join("".join(conv.audit_of(p, *e)) for p, e in zip(parts, edges)) == whole


@pytest.mark.parametrize("range_rows", [1 << 17, 7])
def test_repair_agrees_with_brute_force(spark, monkeypatch, range_rows):
    monkeypatch.setattr(conv, "RANGE_ROWS", range_rows)
    draw = random.Random(6)
    rows = drawn(draw, 60, 9)
    rows += [(None, 1, "user", "No id."), (None, None, None, None), (None, 2, "assistant", "Fine")]
    rows += [(99, t, "user" if t % 2 else "assistant", f"word {t}.") for t in range(80)]
    rows += [(100, 5, "user", "Same.")] * 30 + [(101, None, "assistant", "x" * 200_000)]
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS copies", "'p' AS piece", "'r' AS role_before", "0 AS block")
    got = told(conv.repair_digests(turns, conv.repair_conversations(conv.damaged(turns.repartition(5)), "copies")))
    assert got == expected(rows)


def test_rows_without_damage_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(conv, "BATCH_ROWS", 4)
    monkeypatch.setattr(conv, "RANGE_ROWS", 5)
    rows = [(1, 0, "system", "S."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (2, 0, "user", "Again!")] + [(2, 0, "user", "Again!")] * 21
    turns = spark.createDataFrame(rows, SCHEMA)
    edits = conv.repair_conversations(turns)
    assert told(conv.repair_digests(turns, edits)) == expected(rows, damage=False)
    kept = edits.where("conv_id = 1").orderBy("piece", "place").collect()
    assert [(r.edit, r.role, r.text) for r in kept] == [("K", "system", "S."), ("K", "user", "Hi."), ("K", "assistant", "Yes.")]


def test_no_rows(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert conv.repair_digests(turns, conv.repair_conversations(turns)).count() == 0


def test_query_agrees_with_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert told(CORPUS_QUERIES["op11_conversation_repair"](spark, SMALL)) == expected(rows)

"""Repair of damaged conversations by the cheapest edits, found by divide and conquer.

A repaired conversation has roles with the initials ``(s?(ua)+)?``. What has been said so far is one of four states, so
a run of rows is a 4 x 4 table: for each state before it and each after it, the least cost and the rank of its audit
among the least-cost audits that start in the same state. Two audits of the same rows never are prefixes of each other,
so ranks compose as costs do: the state in the middle decides before anything after it. A forward and a backward vector
of four states meet in the middle of a run, the optimal crossing with the least audit is taken, and both halves recurse.
Only the four-state vectors and the audit are kept.

Conversations are cut by ranges of (conversation, turn, role, text). One that lies within a range is solved there; the
others give one table of costs per range, from which the states at the edges follow, and their pieces are solved apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import BLANK, stored, table
from daybook.llm.registry import query

KEEP_COST, INSERT_COST, REROLE_COST, DELETE_COST, TRUNCATED_COST = 0, 2, 2, 3, 1
DAMAGES = 20
RANGE_ROWS, RANGE_BYTES = 1 << 17, 32 << 20
SOUND, EMPTY, REPEATED, CUT = "sound", "blank", "duplicate", "truncated"

# States of a conversation: nothing said, system last, user last, assistant last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)  # the only state that an inserted or a reroled row can lead to
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_END = "$"

Move = tuple[int, str]  # cost and letters of the cheapest, least way from one state to another


# ---- one row


def row_code(initial: str, fault: str) -> str:
    """The symbol of a row: x must go, else its role initial, in upper case when truncated, ``-`` for any other role."""
    if fault in (EMPTY, REPEATED):
        return "x"
    known = initial if initial in ("s", "u", "a") else "-"
    return (known.upper() if known != "-" else "+") if fault == CUT else known


@lru_cache(maxsize=None)
def moves(code: str) -> tuple[tuple[int, int, int, str], ...]:
    """``(state before, state after, cost, letters)`` of a row, insertions before it included, the best of each pair."""
    best: dict[tuple[int, int], Move] = {}
    for before in STATES:
        state, letters, cost = before, "", 0
        for _ in range(3):  # more than two insertions in a row lead back to where they began
            for after, more, letter in _choices(code, state):
                found = (cost + more, letters + letter)
                best[before, after] = min(best.get((before, after), found), found)
            state, letters, cost = _NEXT[state], letters + "I", cost + INSERT_COST
    return tuple((x, y, *move) for (x, y), move in sorted(best.items()))


def _choices(code: str, state: int) -> Iterator[tuple[int, int, str]]:
    if code == _END:  # not a row: what may stand at the end
        if state in (START, ASSISTANT):
            yield state, 0, ""
        return
    yield state, DELETE_COST, "D"
    if code != "x":
        more = TRUNCATED_COST if code.isupper() or code == "+" else 0
        if (code.lower(), state) in _KEPT:
            yield _KEPT[code.lower(), state], KEEP_COST + more, "K"
        yield _NEXT[state], REROLE_COST + more, "R"


# ---- runs of rows


class Reach(NamedTuple):
    """How a state is reached: least cost, and the rank of the least audit among the states reached from one start."""

    cost: int
    rank: int


Vector = dict[int, Reach]


def forward(codes: str, vector: Vector) -> Vector:
    """Costs and ranks of the states after ``codes``."""
    for code in codes:
        found: dict[int, tuple[int, int, str]] = {}
        for before, after, cost, letters in moves(code):
            if before in vector:
                reach = (vector[before].cost + cost, vector[before].rank, letters)
                if after not in found or reach < found[after]:
                    found[after] = reach
        vector = _ranked(found)
    return vector


def _ranked(found: dict[int, tuple]) -> Vector:
    """Ranks of states whose audits are ordered by what follows the cost."""
    order = sorted(found, key=lambda s: found[s][1:])
    return {state: Reach(found[state][0], rank) for rank, state in enumerate(order)}


def backward(codes: str, costs: dict[int, int]) -> dict[int, int]:
    """Least costs from the states before ``codes`` to its end."""
    for code in reversed(codes):
        found: dict[int, int] = {}
        for before, after, cost, _ in moves(code):
            if after in costs:
                found[before] = min(found.get(before, cost + costs[after]), cost + costs[after])
        costs = found
    return costs


def crossing(codes: str, middle: int, start: int, end: int | None) -> int:
    """The state at ``middle`` of the least audit among the cheapest ones; ``end`` is None where the conversation ends."""
    there = forward(codes[:middle], {start: Reach(0, 0)})
    back = backward(codes[middle:], {end: 0} if end is not None else {START: 0, ASSISTANT: 0})
    return min((there[s].cost + back[s], there[s].rank, s) for s in there if s in back)[2]


def audit(codes: str, start: int, end: int) -> list[str]:
    """Letters of each row (insertions before it included), from one state to another."""
    if len(codes) == 1:
        return [letters for before, after, _, letters in moves(codes) if (before, after) == (start, end)]
    middle = len(codes) // 2
    state = crossing(codes, middle, start, end)
    return audit(codes[:middle], start, state) + audit(codes[middle:], state, end)


@lru_cache(maxsize=1 << 14)
def _short_audit(codes: str, start: int, end: int | None) -> tuple[str, ...]:
    if not codes:
        return ()
    if end is None:
        end = crossing(codes, len(codes), start, None)
    return tuple(audit(codes, start, end))


def audit_of(codes: str, start: int = START, end: int | None = None) -> tuple[str, ...] | list[str]:
    """Letters of each row of a piece, by way of a cache when it is short; ``end`` None: the rest may be added there.

    A whole conversation carries the end mark as its last symbol.
    """
    if len(codes) <= 64:
        return _short_audit(codes, start, end)
    return audit(codes, start, crossing(codes, len(codes), start, None) if end is None else end)


def piece_table(codes: str) -> list[list[int]]:
    """``[before, after, cost, rank]`` of a piece of a conversation."""
    return [[s, t, *reach] for s in STATES for t, reach in forward(codes, {s: Reach(0, 0)}).items()]


def edge_states(tables: list[list[list[int]]]) -> list[tuple[int, int]]:
    """The states before and after each piece of one conversation, in order, of the least of the cheapest audits."""
    by_piece = [{(s, t): Reach(c, r) for s, t, c, r in piece} for piece in tables]
    vectors: list[Vector] = [{START: Reach(0, 0)}]
    came: list[dict[int, int]] = []
    for piece in by_piece:
        found: dict[int, tuple[int, int, int, int]] = {}
        for (s, t), reach in piece.items():
            if s in vectors[-1]:
                here = (vectors[-1][s].cost + reach.cost, vectors[-1][s].rank, reach.rank, s)
                found[t] = min(found.get(t, here), here)
        vectors.append(_ranked(found))
        came.append({t: here[3] for t, here in found.items()})
    state = min(vectors[-1], key=lambda s: vectors[-1][s])
    edges = []
    for step in reversed(came):
        edges.append((step[state], state))
        state = step[state]
    return edges[::-1]


# ---- rows of a table


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows after damage, each as often as it stands there.

    The damage is chosen by ``crc32("conv_id:turn") % 20``. A NULL role or text is one space, and so is a NULL id or
    turn in that string.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(DAMAGES))
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    kept = turns.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text")).where("kind <> 0")
    broken = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return kept.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        broken.alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _fault(text: Column, first: Column) -> Column:
    solid = F.regexp_extract(text, rf"([^{BLANK}])[{BLANK}]*\z", 1)
    return F.when(solid == "", EMPTY).when(~first, REPEATED).when(~solid.isin(".", "!", "?"), CUT).otherwise(SOUND)


_EDIT_TYPE = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("piece", pa.int64()),
        ("place", pa.int64()),
        ("edit", pa.string()),
        ("fault", pa.string()),
        ("turn", pa.int64()),
        ("role_before", pa.string()),
        ("role", pa.string()),
        ("text", pa.string()),
    ]
)
EDIT_SCHEMA = (
    "conv_id long, piece long, place long, edit string, fault string, turn long, role_before string, role string, text string"
)
_PIECE_TYPE = pa.schema([*_EDIT_TYPE, ("kind", pa.string()), ("copies", pa.int64()), ("reached", pa.list_(pa.list_(pa.int32())))])
PIECE_SCHEMA = f"{EDIT_SCHEMA}, kind string, copies long, reached array<array<int>>"
BATCH_ROWS = 4096


def _expanded(rows: list[dict]) -> tuple[list[dict], str]:
    """One row for each copy; copies after the first are repeats, unless they are blank anyway."""
    out = []
    for row in rows:
        out.append(row)
        fault = EMPTY if row["fault"] == EMPTY else REPEATED
        out.extend([row | {"fault": fault}] * (row["copies"] - 1))
    return out, "".join(row_code(r["role"][:1], r["fault"]) for r in out)


def _edits(rows: list[dict], letters: list[str] | tuple[str, ...], state: int, place: int = 0) -> Iterator[dict]:
    """The edits of expanded rows, which lead on from ``state``; further letters are insertions at the end."""
    for number, way in enumerate(letters):
        row = rows[number] if number < len(rows) else {}
        base = {"conv_id": rows[0]["conv_id"] if rows else None, "piece": rows[0]["piece"] if rows else None}
        for edit in way:
            role = row.get("role")
            if edit == "I":
                state = _NEXT[state]
                yield base | {"place": place, "edit": edit, "role": _NAMES[state], "text": ""}
            else:
                after = _NEXT[state] if edit == "R" else _KEPT[role[0], state] if edit == "K" else state
                yield base | {
                    **{"place": place, "edit": edit, "fault": row["fault"], "turn": row["turn"], "role_before": role},
                    **{"role": _NAMES[after] if edit == "R" else role, "text": row["text"]},
                }
                state = after
            place += 1


def _packed(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _range_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of the conversations that a range surely has whole; the first and the last come out as they are."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            for chunk in range(0, batch.num_rows, BATCH_ROWS):
                yield from batch.slice(chunk, BATCH_ROWS).to_pylist()

    def told() -> Iterator[dict]:
        waiting: list[dict] | None = None
        first = True
        for _, group in groupby(rows(), key=lambda r: r["conv_id"]):
            if waiting is not None:
                yield from _open(waiting) if first else _closed(waiting)
                first = False
            waiting = list(group)
        if waiting is not None:
            yield from _open(waiting)

    yield from _packed(told(), _PIECE_TYPE)


def _open(rows: list[dict]) -> Iterator[dict]:
    _, codes = _expanded(rows)
    head = {"conv_id": rows[0]["conv_id"], "piece": rows[0]["piece"], "kind": "piece", "reached": piece_table(codes)}
    yield head
    for place, row in enumerate(rows):
        yield {**row, "kind": "open", "place": place}


def _closed(rows: list[dict]) -> Iterator[dict]:
    full, codes = _expanded(rows)
    for edit in _edits(full, audit_of(codes + _END), START):
        yield edit | {"kind": "edit"}


def _edges(pieces: pa.Table) -> pa.Table:
    """States at the edges of the pieces of one conversation; a range gives two pieces at most, so they are few."""
    rows = sorted(pieces.to_pylist(), key=lambda r: r["piece"])
    # what may be added at the end belongs to the last piece; it has one way from each state
    ending = [[s, t, cost, 0] for s, t, cost, _ in moves(_END)]
    edges = edge_states([*[r["reached"] for r in rows], ending])[:-1]
    return pa.table(
        {
            "edge_conv": pa.array([r["conv_id"] for r in rows], pa.int64()),
            "edge_piece": pa.array([r["piece"] for r in rows], pa.int64()),
            "before": pa.array([e[0] for e in edges], pa.int32()),
            "after": pa.array([e[1] for e in edges], pa.int32()),
            "is_last": pa.array([i == len(rows) - 1 for i in range(len(rows))], pa.bool_()),
        }
    )


def _piece_edits(piece: pa.Table) -> pa.Table:
    """Edits of one piece between the states at its edges; a piece is no larger than a range."""
    rows = sorted(piece.to_pylist(), key=lambda r: r["place"])
    before, after, is_last = rows[0]["before"], rows[0]["after"], rows[0]["is_last"]
    full, codes = _expanded(rows)
    letters = list(audit_of(codes, before, after))
    if is_last:
        letters += [next(way for s, _, _, way in moves(_END) if s == after)]
    edits = [{name: e.get(name) for name in _EDIT_TYPE.names} for e in _edits(full, letters, before)]
    return pa.Table.from_pylist(edits, schema=_EDIT_TYPE)


def repair_conversations(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """The edits that repair each conversation: ``conv_id, piece, place, edit, fault, turn, role_before, role, text``.

    ``turns`` needs ``conv_id, turn, role, text``; ``copies`` names a column that tells how often a row stands there.
    Further columns don't matter. ``piece`` and ``place`` order the edits of a conversation. ``edit`` is K, R, D or I; an insertion has
    neither fault, turn nor ``role_before``. What is left after the edits are the rows that are not D.

    Rows are taken by turn, without a turn first, equal turns by role and text. Equal rows of one turn follow each
    other. Rows without ``conv_id`` are a conversation, too. A NULL role or text is one space. A role is judged by its
    first character; roles that begin with none of s, u, a can only be changed or deleted. Without rows there are no
    edits.

    Repeated rows are counted before anything is ranged, and the first of equal texts is found by an aggregate, not by
    a window, so no conversation or text has to fit a task: ranges hold about 131,072 rows or 32 MB, and a conversation
    that spans several is solved in pieces. Copies of one row are ranged in blocks of 4,096.
    """
    spark, space = turns.sparkSession, F.lit(" ")
    number = F.lit(1).cast("long") if copies is None else F.col(copies)
    plain = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), number.alias("copies"))
    said = F.unhex(F.sha2(F.concat(F.col("role"), F.lit("\0"), F.col("text")).cast("binary"), 256))
    keys = ["conv_id", "turn", "said"]
    counted = plain.withColumn("said", said).groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("role", "text")], F.sum("copies").alias("copies"))
    rows = stored(counted, "turns")

    order = F.struct(F.col("turn").isNotNull().alias("has_turn"), "turn")
    firsts = rows.groupBy("conv_id", "said").agg(F.min(order).alias("order"))
    firsts = firsts.select(F.col("conv_id").alias("first_conv"), F.col("order.turn").alias("first_turn"), F.col("said").alias("first_said"), F.lit(True).alias("is_first"))
    same = F.col("conv_id").eqNullSafe(F.col("first_conv")) & F.col("turn").eqNullSafe(F.col("first_turn")) & (F.col("said") == F.col("first_said"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / BATCH_ROWS))).alias("block")
    blocks = rows.join(firsts, same, "left").select(*rows.columns, "is_first", block)
    marked = blocks.select(
        *["conv_id", "turn", "role", "text", "block"],
        F.least(F.lit(BATCH_ROWS), F.col("copies") - F.col("block") * BATCH_ROWS).cast("long").alias("copies"),
        _fault(F.col("text"), F.coalesce(F.col("is_first") & (F.col("block") == 0), F.lit(False))).alias("fault"),
    )

    payload = F.sum((F.octet_length("text") + F.lit(32)) * F.col("copies"))
    size = rows.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"), F.coalesce(payload, F.lit(0)).alias("bytes")).first()
    cores = spark.sparkContext.defaultParallelism
    ranges = max(size["n"] // RANGE_ROWS, size["bytes"] // RANGE_BYTES, min(cores, size["n"] // BATCH_ROWS)) + 1
    place = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "block"]
    ranged = marked.repartitionByRange(int(ranges), *place).sortWithinPartitions(*place)
    numbered = ranged.withColumn("piece", F.spark_partition_id().cast("long"))
    pieces = stored(numbered.mapInArrow(_range_pieces, PIECE_SCHEMA), "pieces")

    columns = _EDIT_TYPE.names
    edges = pieces.where("kind = 'piece'").select("conv_id", "piece", "reached").groupBy("conv_id")
    states = edges.applyInArrow(_edges, "edge_conv long, edge_piece long, before int, after int, is_last boolean")
    # two rows a range at most: a table that grows with the number of tasks
    here = F.col("conv_id").eqNullSafe(F.col("edge_conv")) & (F.col("piece") == F.col("edge_piece"))
    opened = pieces.where("kind = 'open'").join(F.broadcast(states), here)
    solved = opened.select("conv_id", "piece", "place", "fault", "turn", "role", "text", "copies", "before", "after", "is_last")
    return pieces.where("kind = 'edit'").select(*columns).unionByName(
        solved.groupBy("conv_id", "piece").applyInArrow(_piece_edits, EDIT_SCHEMA)
    )


# ---- digests


class _Digest:
    """What the query tells of one conversation, kept up as its edits pass."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.faults = dict.fromkeys((EMPTY, REPEATED, CUT), 0)
        self.first = self.last = self.turn = None
        self.turns = self.illegal = self.cost = 0
        self.before: str | None = None
        self.audit: list[str] = []
        self.hash, self.started = hashlib.sha256(), False

    def add(self, edit: dict) -> None:
        letter, fault = edit["edit"], edit["fault"]
        self.audit.append(letter)
        self.cost += {"K": KEEP_COST, "R": REROLE_COST, "D": DELETE_COST, "I": INSERT_COST}[letter]
        self.cost += TRUNCATED_COST * (fault == CUT and letter != "D")
        if letter != "I":
            if fault in self.faults:
                self.faults[fault] += 1
            initial = edit["role_before"][:1]
            self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
            self.before = initial
            turn = edit["turn"]
            if turn is not None:
                self.turns += self.turn is None or turn != self.turn
                self.first, self.last, self.turn = turn if self.first is None else self.first, turn, turn
        if letter != "D":
            self.hash.update(f"{chr(10) * self.started}{edit['role']}:{edit['text']}".encode())
            self.started = True

    def row(self) -> dict:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {
            **{"conv_id": self.conv_id, "gaps": gaps, **self.faults, "illegal": self.illegal, "cost": self.cost},
            **{"audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()},
        }


DIGEST_SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_DIGEST_TYPE = pa.schema(
    [
        *[(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        *[(n, pa.string()) for n in ("audit", "repaired_sha256")],
    ]
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def told() -> Iterator[dict]:
        now: _Digest | None = None
        for batch in batches:
            for chunk in range(0, batch.num_rows, BATCH_ROWS):
                for edit in batch.slice(chunk, BATCH_ROWS).to_pylist():
                    if now is None or now.conv_id != edit["conv_id"]:
                        if now is not None:
                            yield now.row()
                        now = _Digest(edit["conv_id"])
                    if edit["edit"] is not None:
                        now.add(edit)
        if now is not None:
            yield now.row()

    yield from _packed(told(), _DIGEST_TYPE)


def repair_digests(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """One row per conversation of ``turns``: counts of faults, cost, audit and a hash of what the repair leaves.

    A hash of a whole conversation is sequential by its definition. The rows of a conversation pass through one task
    in order; it holds one batch and one letter per edit.
    """
    heads = turns.select("conv_id").distinct()
    # a conversation without a row left has its head alone, which sorts first
    both = edits.unionByName(heads, allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("piece"), "place")
    return ordered.mapInArrow(_digests, DIGEST_SCHEMA)


@query()
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair_digests(turns, repair_conversations(damaged(turns), "copies"))

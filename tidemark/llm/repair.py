"""Repair of conversation structure by cheapest edits (iterative-deepening A*).

A sound conversation is empty or has pairs of user and assistant turns, after a
system turn if it likes; blank, repeated and cut-off turns are faults. For each
conversation the cheapest sequence of edits is searched that makes it sound:
Keep (free), Rerole to user or assistant, Delete, which blank and repeated turns
need, Insert of an empty user or assistant turn; a cut-off turn that is not
deleted costs extra. Of equally cheap ones the first in ASCII order of the
edits' initials counts.

The search goes depth-first through the edits in ASCII order, under a bound on
the cost that grows until a path is accepted; the first one is the answer. What
a state (turns done, last role) still costs at least is bounded from below by a
pattern table, the exact costs after two of the four role states are taken for
one, and by a transposition table: a state that failed with some budget left
costs more than that.

Long conversations: turns are range-partitioned in their order, and a run of more
than ``BLOCK`` turns or ``BLOCK_CHARS`` characters is searched in blocks, as is
what lies at a partition's ends: for each role state before and after a block
the search gives the cost and the edits, a small table for each block chains them
to the cheapest whole, and each block then takes its edits. A turn's edits are
inserts and one last edit of another kind, so no block's edits are the beginning of
others, and the order of whole sequences is that of the blocks one by one.

Memory: a task holds one block of a conversation; chaining holds 32 numbers for
each block of one conversation.

Defined cases: a null role or text is one space. Turns are in order of the turn
number, nulls first, ties by role, then text; equal rows are duplicates but for
the first. Null ids are one conversation. ``copies`` (optional) says how often a
row stands there; a conversation whose rows all have 0 is one without turns:
zeros, no edits. A role counts by its first character; an empty role fits
nowhere. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Edit costs; a turn that is cut off and not deleted costs CUT_OFF more.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
BLOCK, BLOCK_CHARS = 4096, 4 << 20
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
LEGAL = {"su", "ua", "au"}

#: Role states: nothing yet, after a system turn, after a user turn, after an assistant turn.
NONE, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state after an inserted or reroled turn, and that turn's role.
FORCED = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Goal of a search that may end the conversation, with the inserts that still need.
END = 4
INF = math.inf
#: Abstract states: two role states as one, by the goal (they are kept apart where they decide).
MERGED = {USER: (0, 1, 2, 1), ASSISTANT: (0, 1, 2, 1), END: (0, 1, 2, 1), NONE: (0, 1, 2, 2), SYSTEM: (0, 1, 2, 2)}

#: A turn as the search sees it: initial of the role, must be deleted, cut off.
Turn = tuple[str, bool, bool]


def pattern(turns: list[Turn], goal: int) -> list[list[float]]:
    """At least so much does it cost to get from (turn, abstract state) to the goal."""
    of = MERGED[goal]
    inserts = {(of[q], of[FORCED[q]]) for q in range(4)}
    keeps: dict[str, set] = {}
    for (q, c), to in KEEP.items():
        keeps.setdefault(c, set()).add((of[q], of[to]))
    last = [INF] * 3
    if goal == END:
        last = [0, 0, INSERT]
    else:
        last[of[goal]] = 0
    out = [last]
    for initial, gone, cut in reversed(turns):
        after, here = out[-1], [DELETE + x for x in out[-1]]
        if not gone:
            more = CUT_OFF if cut else 0
            for a, b in keeps.get(initial, ()):
                here[a] = min(here[a], more + after[b])
            for a, b in inserts:
                here[a] = min(here[a], REROLE + more + after[b])
        for _ in range(2):
            for a, b in inserts:
                here[a] = min(here[a], INSERT + here[b])
        out.append(here)
    out.reverse()
    return out


def search(turns: list[Turn], start: int, goal: int, table: list[list[float]], failed: dict) -> tuple[int, str] | None:
    """Cost and edits of the first of the cheapest ways from a role state to the goal.
    ``failed``: (turn, state) -> least cost from there, as failures have shown."""
    n, of = len(turns), MERGED[goal]
    bound = table[0][of[start]]
    while bound < INF:
        beyond, path = INF, []
        stack = [(0, start, 0, iter(_moves(turns, 0, start, n, goal)))]
        while stack:
            i, q, g, moves = stack[-1]
            if i == n and (q == goal or goal == END and q in (NONE, ASSISTANT)):
                return g, "".join(path)
            for edit, j, to, cost in moves:
                least = g + cost + max(table[j][of[to]], failed.get((j, to), 0))
                if least > bound:
                    beyond = min(beyond, least)
                    continue
                path.append(edit)
                stack.append((j, to, g + cost, iter(_moves(turns, j, to, n, goal))))
                break
            else:
                failed[i, q] = max(failed.get((i, q), 0), bound - g + 1)
                stack.pop()
                if path:
                    path.pop()
        bound = beyond
    return None


def _moves(turns: list[Turn], i: int, q: int, n: int, goal: int) -> list[tuple[str, int, int, int]]:
    """(edit, next turn, next state, cost) in ASCII order of the edits."""
    if i == n:
        return [("I", i, FORCED[q], INSERT)] if goal == END else []
    initial, gone, cut = turns[i]
    out = [("D", i + 1, q, DELETE), ("I", i, FORCED[q], INSERT)]
    if not gone:
        more = CUT_OFF if cut else 0
        if (to := KEEP.get((q, initial))) is not None:
            out.append(("K", i + 1, to, more))
        out.append(("R", i + 1, FORCED[q], REROLE + more))
    return out


def repair_one(turns: list[Turn]) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    return search(turns, NONE, END, pattern(turns, END), {})


def repair_block(turns: list[Turn]) -> tuple[list, list, list]:
    """For each role state before a block (rows of 4) and after it: cost (None: no way),
    the edits, and their place among the four in ASCII order."""
    costs, edits = [None] * 16, [""] * 16
    for goal in range(4):
        table, failed = pattern(turns, goal), {}
        for q in range(4):
            if (got := search(turns, q, goal, table, failed)) is not None:
                costs[4 * q + goal], edits[4 * q + goal] = got
    places = [sorted(edits[i // 4 * 4:i // 4 * 4 + 4]).index(e) for i, e in enumerate(edits)]
    return costs, edits, places


#: Cost and edits that end a conversation in each role state.
LAST = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))


def chain(blocks: list[tuple[list, list]]) -> tuple[int, list[tuple[int, int]]]:
    """The cost of a conversation of blocks (costs, places) and each block's role states."""
    ahead = [[c for c, _ in LAST]]
    for costs, _ in reversed(blocks):
        ahead.append([min((costs[4 * q + to] + ahead[-1][to] for to in range(4) if costs[4 * q + to] is not None), default=INF) for q in range(4)])
    ahead.reverse()
    q, out = NONE, []
    for (costs, places), here, then in zip(blocks, ahead, ahead[1:]):
        ways = [to for to in range(4) if costs[4 * q + to] is not None and costs[4 * q + to] + then[to] == here[q]]
        to = min(ways, key=lambda t: places[4 * q + t])
        out.append((q, to))
        q = to
    return ahead[0][NONE], out


def edited(rows: list[tuple[str, str]], edits: str, q: int = NONE) -> list[tuple[str, str]]:
    """The (role, text) turns that edits leave of these, from a role state on."""
    out, i = [], 0
    for e in edits:
        if e == "I":
            q = FORCED[q]
            out.append((ROLE[q], ""))
            continue
        if e == "K":
            out.append(rows[i])
            q = KEEP[q, rows[i][0][:1]]
        elif e == "R":
            q = FORCED[q]
            out.append((ROLE[q], rows[i][1]))
        i += 1
    return out


class _Piece:
    """A run of a conversation's turns in order, with its counts."""

    def __init__(self, one: pa.Array):
        self.one = one  # the conversation's id
        self.rows: list[tuple[str, str]] = []
        self.turns: list[Turn] = []
        self.chars = self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = self.low = None

    def add(self, turn, role: str, text: str, seen: bool) -> None:
        body, initial = text.rstrip(BLANKS), role[:1]
        gone, cut = False, False
        if not body:
            self.blank, gone = self.blank + 1, True
        elif seen:
            self.duplicate, gone = self.duplicate + 1, True
        elif body[-1] not in ENDS:
            self.truncated, cut = self.truncated + 1, True
        if self.turns and self.turns[-1][0] + initial not in LEGAL:
            self.illegal += 1
        if turn is not None and (not self.turns or turn != self.last):
            self.distinct += 1
            self.low = turn if self.low is None else self.low
        if not self.turns:
            self.first = turn
        self.last = turn
        self.turns.append((initial, gone, cut))
        self.rows.append((role, text))
        self.chars += len(role) + len(text)


_COUNTS = ("n", "distinct", "low", "first", "last", "blank", "duplicate", "truncated", "illegal")
_TURNS = "array<struct<role:string,text:string>>"
_PIECES = ("part int, seq int, whole boolean, " + ", ".join(f"{c} long" for c in _COUNTS) + ", head string, tail string, cost long, audit string, "
           f"turns {_TURNS}, costs array<long>, places array<int>, ways array<string>")


def _record(p: _Piece, part: int, seq: int, whole: bool) -> dict:
    out = {c: getattr(p, c) for c in _COUNTS[1:]} | {"n": len(p.turns), "part": part, "seq": seq, "whole": whole, "head": None, "tail": None}
    if p.turns:
        out |= {"head": p.turns[0][0], "tail": p.turns[-1][0]}
    if whole:
        out["cost"], out["audit"] = repair_one(p.turns)
        rows = edited(p.rows, out["audit"])
    else:
        out["costs"], out["ways"], out["places"] = repair_block(p.turns)
        rows = p.rows
    return out | {"turns": [{"role": r, "text": t} for r, t in rows]}


def _batch(ids: list[pa.Array], records: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    rest = [pa.array([r.get(f.name) for r in records], f.type) for f in list(schema)[1:]]
    return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *rest], names=schema.names)


def pieces(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           copies_col: str | None = None) -> DataFrame:
    """Conversations in pieces, searched: (id, part, seq, counts, cost, audit, turns). A
    whole conversation has its edits and repaired turns; a part of one (``whole`` is
    false) its own turns and what each way through it costs."""
    copies = F.col(copies_col).cast("long") if copies_col else F.lit(1).cast("long")
    space = F.lit(" ")
    d = rows.select(F.col(id_col).alias("id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(role_col, space).alias("role"),
                    F.coalesce(text_col, space).alias("text"), copies.alias("copies"))
    d = d.withColumn("sha", F.sha2("text", 256))
    # where each text of a role stands first; such a mark meets its row in the grouping below, without a join
    first = d.where("copies > 0").groupBy("id", "role", "sha").agg(F.min(F.struct("turn"))["turn"].alias("turn")) \
        .select("id", "turn", "role", "sha", F.lit(0).cast("long").alias("copies"), F.lit(None).cast("string").alias("text"), F.lit(True).alias("first"))
    # equal rows as one with a count, so that a row that stands there very often is one row from here on
    known = d.withColumn("first", F.lit(False)).unionByName(first).groupBy("id", "turn", "role", "sha") \
        .agg(F.sum("copies").alias("copies"), F.max("text").alias("text"), (~F.bool_or("first")).alias("seen"))
    # long texts stay out of the sample that decides the ranges
    inner = known.select("id", "turn", "role", "text", "copies", "seen").repartitionByRange("id", "turn", "role", F.substr("text", F.lit(1), F.lit(200))).sortWithinPartitions("id", "turn", "role", "text")
    schema = d.sparkSession.createDataFrame([], f"{_PIECES}").schema
    full = type(schema)([d.schema["id"], *schema.fields])
    arrow = _arrow(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, piece, opened, ids, out, chars = TaskContext.get().partitionId(), 0, object(), None, True, [], [], 0

        def close(whole: bool) -> None:
            nonlocal seq, chars
            ids.append(piece.one)
            out.append(_record(piece, part, seq, whole))
            chars += piece.chars + 200
            seq += 1

        # opened: the piece may go on from before (another partition, or a full block)
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("id", "turn", "role", "text", "copies", "seen")]
            for r, (i, turn, role, text, copies, seen) in enumerate(zip(*cols)):
                if piece is None or i != held:
                    if piece is not None:
                        close(not opened)
                        opened = False
                    piece, held = _Piece(b.column("id").slice(r, 1)), i
                for k in range(copies):
                    if len(piece.turns) >= BLOCK or piece.turns and piece.chars + len(text) > BLOCK_CHARS:
                        close(False)
                        piece, opened = _Piece(piece.one), True
                    piece.add(turn, role, text, seen or k > 0)
                if chars > BLOCK_CHARS:
                    yield _batch(ids, out, arrow)
                    ids, out, chars = [], [], 0
        if piece is not None:
            close(False)
        if out:
            yield _batch(ids, out, arrow)

    return inner.mapInArrow(run, full)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _ways(parts: DataFrame) -> DataFrame:
    """(part, seq, q, to, end, cost): the role states of each piece in the cheapest whole;
    ``end`` marks a conversation's last piece, whose ``cost`` is that of the whole."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("part", "ascending"), ("seq", "ascending")])
        cost, states = chain(list(zip(t.column("costs").to_pylist(), t.column("places").to_pylist())))
        n = len(states)
        return pa.table({"part": t.column("part"), "seq": t.column("seq"), "q": pa.array([q for q, _ in states], pa.int32()),
                         "to": pa.array([x for _, x in states], pa.int32()), "end": pa.array([k == n - 1 for k in range(n)]),
                         "total": pa.array([int(cost) if k == n - 1 else 0 for k in range(n)], pa.int64())})

    return parts.select("id", "part", "seq", "costs", "places").groupBy("id").applyInArrow(run, "part int, seq int, q int, to int, end boolean, total long")


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           copies_col: str | None = None) -> DataFrame:
    """Pieces of repaired conversations in order of (id, part, seq): ``turns`` (role and
    text), ``audit`` (the edits' initials), ``cost`` (of the whole conversation, at its
    last piece) and the counts of faults."""
    found = staged(pieces(rows, id_col, turn_col, role_col, text_col, copies_col), "repair_pieces")
    kept = ["id", "part", "seq", "whole", *_COUNTS, "head", "tail"]
    parts = found.where("not whole")
    schema = found.select(*kept, "cost", "audit", "turns").schema
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cost, audit, turns = [], [], []
            for t, ways, q, to, end, total in zip(*(b.column(c).to_pylist() for c in ("turns", "ways", "q", "to", "end", "total"))):
                edits = ways[4 * q + to] + (LAST[to][1] if end else "")
                cost.append(total)
                audit.append(edits)
                turns.append([{"role": r, "text": x} for r, x in edited([(x["role"], x["text"]) for x in t], edits, q)])
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(c, arrow.field(f).type) for c, f in
                                             ((cost, "cost"), (audit, "audit"), (turns, "turns"))], names=arrow.names)

    chosen = parts.join(_ways(parts), ["part", "seq"]).select(*kept, "turns", "ways", "q", "to", "end", "total").mapInArrow(run, schema)
    return found.where("whole").select(*schema.names).unionByName(chosen).withColumnRenamed("id", id_col)


def repaired_turns(found: DataFrame) -> DataFrame:
    """The repaired conversations as rows: (id, part, seq, place, role, text), in that order."""
    return found.select(found.columns[0], "part", "seq", F.posexplode("turns").alias("place", "__t")) \
        .select(found.columns[0], "part", "seq", "place", "__t.role", "__t.text")


def report(found: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit
    and the SHA-256 of its repaired turns (``role:text``, parted by newlines). Pieces of a
    long one stream through the task that writes its row."""
    id_col = found.columns[0]
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    gaps = F.when(F.col("distinct") > 0, F.col("last") - F.col("low") + 1 - F.col("distinct")).otherwise(F.lit(0).cast("long"))
    counts = ("blank", "duplicate", "truncated", "illegal")
    whole = found.where("whole").select(id_col, gaps.alias("gaps"), *counts, "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    parts = found.where("not whole").withColumn("body", F.when(F.size("turns") > 0, lines)).drop("turns").withColumnRenamed(id_col, "id")
    schema = whole.withColumnRenamed(id_col, "id").schema
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = object(), None

        def done() -> pa.RecordBatch:
            row = {c: now[c] for c in (*counts, "cost")}
            row["gaps"] = now["last"] - now["low"] + 1 - now["distinct"] if now["distinct"] else 0
            return _batch([now["one"]], [row | {"audit": "".join(now["audits"]), "repaired_sha256": now["sha"].hexdigest()}], arrow)

        for b in batches:
            ids = b.column("id")
            for r, p in enumerate(b.to_pylist()):
                if now is None or p["id"] != held:
                    if now is not None:
                        yield done()
                    held = p["id"]
                    now = {c: 0 for c in (*counts, "cost", "distinct")} | {"one": ids.slice(r, 1), "low": None, "last": None, "tail": None,
                                                                           "any": False, "audits": [], "sha": hashlib.sha256()}
                for c in (*counts, "cost", "distinct"):
                    now[c] += p[c]
                if p["n"]:
                    now["illegal"] += now["tail"] is not None and now["tail"] + p["head"] not in LEGAL
                    now["distinct"] -= now["last"] is not None and now["last"] == p["first"]
                    now["low"] = p["low"] if now["low"] is None else now["low"]
                    now["tail"], now["last"] = p["tail"], p["last"]
                now["audits"].append(p["audit"])
                if p["body"] is not None:
                    now["sha"].update((("\n" if now["any"] else "") + p["body"]).encode())
                    now["any"] = True
        if now is not None:
            yield done()

    streamed = parts.repartition("id").sortWithinPartitions("id", "part", "seq").mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return whole.unionByName(streamed)


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations with faults that the id and turn decide, for trying the repair:
    (id, turn, role, text, copies); a dropped row has 0 copies, a repeated one 2."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    k, text = F.crc32(key) % 20, F.coalesce(text_col, space)
    return rows.select(
        id_col, turn_col, F.when(k == 4, F.lit("user")).otherwise(F.coalesce(role_col, space)).alias(role_col),
        F.when(k == 1, F.lit("")).when(k == 2, F.translate(text, ENDS, "")).otherwise(text).alias(text_col),
        F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("copies"))

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import repair as R
from tidemark.llm.queries import QUERIES

from .conftest import with_clash

SOUND = re.compile("(s?(ua)+)?")
TURN = st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.booleans(), st.booleans()).map(lambda t: (t[0], t[1], t[2] and not t[1]))


def plain(turns):
    """All edits of a row with up to two inserts before it and at the end, by brute force."""
    best = None
    options = []
    for initial, gone, cut in turns:
        more = 5 if cut else 0
        one = [("D", 2, "")]
        if not gone:
            one += [("K", more, initial or "?"), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
        options.append([("I" * len(ins) + e, 5 * len(ins) + c, ins + x) for ins in ("", "u", "a", "ua", "au") for e, c, x in one])
    options.append([("I" * len(ins), 5 * len(ins), ins) for ins in ("", "u", "a", "ua", "au")])
    for way in itertools.product(*options):
        if SOUND.fullmatch("".join(w[2] for w in way)):
            best = min(best or (10 ** 9, ""), (sum(w[1] for w in way), "".join(w[0] for w in way)))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(TURN, max_size=3))
def test_cheapest_edits_by_brute_force(turns):
    assert R.repair_one(turns) == plain(turns)


def dynamic(turns):
    """Cheapest (cost, edits) by dynamic programming over role states, for longer ones."""
    at = {R.NONE: (0, "")}
    def better(to, q, c, e):
        to[q] = min(to.get(q, (10 ** 9, "")), (c, e))
    def inserts(at):
        out = dict(at)
        for q, (c, e) in at.items():
            for k in (1, 2):
                q, c, e = R.FORCED[q], c + 5, e + "I"
                better(out, q, c, e)
        return out
    for initial, gone, cut in turns:
        after = {}
        for q, (c, e) in inserts(at).items():
            better(after, q, c + 2, e + "D")
            if not gone:
                if (q, initial) in R.KEEP:
                    better(after, R.KEEP[q, initial], c + 5 * cut, e + "K")
                better(after, R.FORCED[q], c + 1 + 5 * cut, e + "R")
        at = after
    ends = inserts(at)
    return min(ends[q] for q in (R.NONE, R.ASSISTANT) if q in ends)


@settings(max_examples=500, deadline=None)
@given(st.lists(TURN, max_size=40))
def test_cheapest_edits_of_long_ones(turns):
    assert R.repair_one(turns) == dynamic(turns)


@settings(max_examples=300, deadline=None)
@given(st.lists(TURN, max_size=30), st.integers(1, 7))
def test_blocks_chain_to_the_whole(turns, size):
    blocks = [R.repair_block(turns[i:i + size]) for i in range(0, len(turns), size)]
    cost, states = R.chain([(c, p) for c, _, p in blocks])
    edits = "".join(e[4 * q + to] for (_, e, _), (q, to) in zip(blocks, states)) + R.LAST[states[-1][1] if states else R.NONE][1]
    assert (cost, edits) == dynamic(turns)


@pytest.mark.parametrize("one", [("s", False, False), ("u", False, True), ("a", True, False), ("", False, False), ("u", False, False)])
def test_many_turns_of_one_kind(one):
    assert R.repair_one([one] * 3000) == dynamic([one] * 3000)


def plain_report(rows):
    """rows: (id, turn, role, text) as they stand. One conversation at a time, everything by hand."""
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, t, role if role is not None else " ", text if text is not None else " ")
                      for i, t, role, text in rows if i == conv and role != "gone"), key=lambda r: (r[0], r[1], r[3], r[4]))
        seen, turns, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for *_, role, text in own:
            solid = re.findall("[^\x20\x09-\x0d]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            if fault:
                counts[fault] += 1
            seen.add((role, text))
            turns.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        ts = {r[2] for r in own if r[2] is not None}
        cost, audit = dynamic(turns)
        fixed = "\n".join(f"{r}:{t}" for r, t in R.edited([(r[3], r[4]) for r in own], audit))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out.append((conv, max(ts) - min(ts) + 1 - len(ts) if ts else 0, *counts.values(), illegal, cost, audit, hashlib.sha256(fixed.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def rows_of(n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "no", "", " \n", "Why?", None, "x! ", "é中."]
    return [((k * 7919) % 13 if k % 3 else 5, None if k % 11 == 0 else (k * 31) % 200 - 20, roles[k * k % 8], texts[(k * 5 + k // 8) % 8] if k % 4 else f"t{k}.")
            for k in range(n)]


@pytest.mark.parametrize("block", [5, 4096])
def test_whole_report(spark, monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK", block)
    rows = rows_of(400) + [(None, 1, "user", "Hi."), (None, None, "assistant", "a."), (77, None, None, None), (78, 3, "user", "ok. " * 5000)]
    rows += rows[:40]
    df = with_clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(7)
    found = R.repair(df)
    got = R.report(found)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == plain_report(rows)
    turns = {}
    for r in sorted(R.repaired_turns(found).collect(), key=lambda r: (r.part, r.seq, r.place)):
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in got.collect():
        assert hashlib.sha256("\n".join(turns.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256


def test_empty_table_and_dropped_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, copies int"
    assert R.report(R.repair(spark.createDataFrame([], schema))).collect() == []
    df = spark.createDataFrame([(1, 1, "user", "a.", 0), (2, 5, "user", "a.", 3), (2, 9, "assistant", "b.", 0)], schema)
    got = sorted(map(tuple, R.report(R.repair(df, copies_col="copies")).collect()))
    empty = hashlib.sha256(b"").hexdigest()
    assert got == [(1, 0, 0, 0, 0, 0, 0, "", empty), (2, 0, 0, 2, 0, 2, 6, "DDD", empty)]


def test_query_against_plain_code(spark, sf):
    rows = []
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        role, text = r.role if r.role is not None else " ", r.text if r.text is not None else " "
        k = zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        rows += [(r.conv_id, r.turn, "gone" if k == 0 else role, text)] * (2 if k == 3 else 1)
    got = QUERIES["op11_conversation_repair"](spark, sf)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == plain_report(rows)

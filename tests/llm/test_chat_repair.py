"""Conversation repair against trying all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat_repair
from tidemark.llm.queries import QUERIES, damaged

SF = "/root/testdata/sf0.01"
WELL_FORMED = re.compile(r"(s?(ua)+)?\Z")
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """rows: (initial, must_go, truncated). (cost, audit, initials after) over all edit sequences, by depth-first search."""

    def fits(word):
        """Whether the initials can still grow into a well-formed sequence."""
        return any(WELL_FORMED.match(word + tail) for tail in ("", "a", "ua"))

    @lru_cache(None)
    def best(i, word, inserts):
        ways = []
        if i == len(rows) and WELL_FORMED.match(word):
            ways.append((0, "", word))
        if inserts < 2:
            for x in "ua":
                if fits(word + x):
                    c, e, w = best(i, word + x, inserts + 1)
                    ways.append((c + 2, "I" + e, w))
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            c, e, w = best(i + 1, word, 0)
            ways.append((c + 3, "D" + e, w))
            if not must_go:
                for x, cost, edit in ((initial, 0, "K"), ("u", 2, "R"), ("a", 2, "R")):
                    if fits(word + x):
                        c, e, w = best(i + 1, word + x, 0)
                        ways.append((c + cost + truncated, edit + e, w))
        return min(ways, default=(10**9, "", ""))

    return best(0, "", 0)


def initial_of(role):
    return role[:1] or "-"


def brute(turns):
    """turns: (turn, role, text) of one conversation. The report's columns behind conv_id."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    count, rows, seen = Counter(), [], set()
    for _, role, text in turns:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None
        seen.add((role, text))
        count[fault] += 1
        rows.append((initial_of(role), fault in ("blank", "duplicate"), int(fault == "truncated")))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, edits, initials = cheapest(tuple(rows))
    left, at, after = iter(initials), 0, []
    for e in edits:
        if e != "D":
            x = next(left)
            after.append((turns[at][1] if e == "K" else NAMES[x], "" if e == "I" else turns[at][2]))
        at += e != "I"
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in after).encode()).hexdigest()
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, edits, digest), after


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        text, role = " " if text is None else text, " " if role is None else role
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv]
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=7))
def test_audit_is_the_least_cheapest(rows):
    kinds = "".join("D" if d else (k if k in "sua" else "o").upper() if t else k if k in "sua" else "o" for k, d, t in rows)
    steps = chat_repair.Steps()
    edits, state = chat_repair.audit(kinds, chat_repair.TERMINAL, 0, True, steps)
    cost, edits_wanted, _ = cheapest(tuple((k, d, int(t and not d)) for k, d, t in rows))
    assert edits == edits_wanted and state in (0, 3)
    assert cost == chat_repair.costs_before(kinds, chat_repair.TERMINAL, steps)[0]
    # cut anywhere, the blocks' matrices and walks give the same
    for cut in range(1, len(kinds)):
        behind = chat_repair.costs_before(kinds[cut:], chat_repair.TERMINAL, steps)
        m = chat_repair.matrix(kinds[:cut], steps)
        assert min(m[p] + behind[p] for p in range(4)) == cost
        a, q = chat_repair.audit(kinds[:cut], tuple(behind), 0, False, steps)
        b, _ = chat_repair.audit(kinds[cut:], chat_repair.TERMINAL, q, True, steps)
        assert a + b == edits


def test_long_walk_keeps_few_vectors():
    r = random.Random(3)
    kinds = "".join(r.choice("suaoSUAOD") for _ in range(20_000))
    steps = chat_repair.Steps()
    edits, _ = chat_repair.audit(kinds, chat_repair.TERMINAL, 0, True, steps)
    cost, roles, _ = chat_repair.apply_edits(edits, 0, kinds, list(kinds.lower()), list(kinds))
    assert WELL_FORMED.match("".join(x[0] for x in roles)) and cost == chat_repair.costs_before(kinds, chat_repair.TERMINAL, steps)[0]
    assert len(steps.seen_back) < 1000


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_chat_repair"][0](spark, SF).collect()}
    assert got == {c: brute(t)[0] for c, t in brute_damage(rows).items()}
    assert sum(1 for v in got.values() if v[5]) > 10


@pytest.mark.parametrize("block_turns,block_chars", [(4096, 10**6), (3, 10**6), (4096, 20)])
def test_odd_conversations(spark, block_turns, block_chars):
    r = random.Random(block_turns + block_chars)
    rows = []
    for conv in [*range(12), None]:
        for _ in range(r.choice([1, 2, 3, 6, 9])):
            turn = r.choice([None, *range(5)])
            rows.append((conv, turn, r.choice(["system", "user", "assistant", "tool", "", None]), r.choice([None, "", " \n", "Yes.", "No", "Why?", "Ünd 中.", "a" * 30])))
    rows += [(50, i, "user" if i % 2 else "assistant", f"t {i % 40}.") for i in range(60)]  # one long conversation
    rows += [(51, 1, "user", "same.")] * 25  # repeated rows
    rows += [(52, -(2**63), "user", "a."), (52, 2**63 - 1, "assistant", "b.")]
    df = spark.createDataFrame([(*x, "clash", 7) for x in rows], "conv_id bigint, turn bigint, role string, text string, part string, rid int")
    blocks = chat_repair.repair_blocks(df, block_turns=block_turns, block_chars=block_chars)
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, role or "", text or ""))
    got = {x.conv_id: tuple(x[c] for c in COLUMNS) for x in chat_repair.conversation_reports(blocks).collect()}
    want = {c: brute(t) for c, t in by.items()}
    assert got == {c: (min(w[0], 2**63 - 1), *w[1:]) for c, (w, _) in want.items()}
    turns = defaultdict(list)
    for x in sorted(chat_repair.repaired_turns(blocks).collect(), key=lambda x: (x.part, x.no, x.place)):
        turns[x.conv_id].append((x.role, x.text))
    assert {c: turns[c] for c in by} == {c: after for c, (_, after) in want.items()}


def test_empty_and_all_dropped(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat_repair.conversation_reports(chat_repair.repair_blocks(none)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert damaged(spark.createDataFrame([(gone, 0, "user", "x")], none.schema)).count() == 0


def test_query_keeps_conversations_without_turns(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "x"), (None, None, None, None), (7, 0, "user", "Hi."), (7, 1, "assistant", "Yes.")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_chat_repair"][0](spark, str(tmp_path)).collect()}
    assert got == {c: brute(t)[0] for c, t in brute_damage(rows).items()}
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())

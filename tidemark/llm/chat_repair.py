"""Conversation repair: the cheapest edits that give a conversation well-formed turns.

Role initials must read ``(s?(ua)+)?``. Keeping a turn costs 0, giving it the role user or assistant 2, deleting
it 3, inserting an empty turn 2; a truncated turn that stays adds 1; blank and duplicate turns must go.
Among the cheapest edit sequences the one whose initials (D, I, K, R) are ASCII-least is taken.

Four states (nothing yet, after s, after u, after a) make the backward pass a step from one vector of four costs to
the one before. Vectors are kept at every ~sqrt(n)-th turn only; the forward walk computes each block's vectors again from
the checkpoint behind it and takes the least tight edit. In every state one role of u and a fits, so the initials decide all.

On a cluster the turns are range-partitioned in order and cut into blocks, so a conversation may span many tasks.
One that lies within a task and a block is repaired there. For the others each block becomes a 4 x 4 matrix of
least costs; chained backwards the matrices give the vector behind every block, its checkpoint. Then each block is walked from
all four states at once, and a chain forwards tells which of them holds.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, ship, shuffle_partitions, store_at
from tidemark.session import materialize, scratch_path

ship(__name__)

SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
# Turns and characters after which a block ends, whatever the conversation's length.
BLOCK_TURNS = 4096
BLOCK_CHARS = 4_000_000

NEXT = (2, 2, 3, 2)  # the state behind the one role of user and assistant that fits
ROLES = {2: "user", 3: "assistant"}
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}  # by initial: state before to state behind
TERMINAL = (0, 4, 2, 0)
FAR = 1 << 50

# -- one conversation ----------------------------------------------------------


class Steps:
    """Backward and forward steps over turn kinds, each computed once per distinct case.

    A kind is the initial of the turn's role (s, u, a, or o for any other), as a capital if the turn is truncated, or D if it must go.
    """

    def __init__(self):
        self.seen_back: dict[tuple, tuple[int, tuple]] = {}
        self.seen_walk: dict[tuple, tuple[str, int]] = {}

    @staticmethod
    def options(kind: str, state: int):
        """(initial, cost, state behind) of the edits that use up the turn, in ASCII order."""
        yield "D", 3, state
        if kind != "D":
            late = int(kind.isupper())
            behind = KEPT.get(kind.lower(), {}).get(state)
            if behind is not None:
                yield "K", late, behind
            yield "R", 2 + late, NEXT[state]

    def back(self, kind: str, rel: tuple) -> tuple[int, tuple]:
        """The vector before a turn from the one behind it, both less their least entry; and by how much that grew."""
        got = self.seen_back.get((kind, rel))
        if got is None:
            own = [min(c + rel[p] for _, c, p in self.options(kind, q)) for q in range(4)]
            with_inserts = [min(own[q], 2 + own[NEXT[q]], 4 + own[NEXT[NEXT[q]]]) for q in range(4)]
            least = min(with_inserts)
            got = self.seen_back[kind, rel] = least, tuple(min(x - least, FAR) for x in with_inserts)
        return got

    def walk(self, kind: str, rel: tuple, state: int) -> tuple[str, int]:
        """Tight edits from ``state`` up to the turn's own, ASCII-least, and the state behind; ``rel`` is the vector behind the turn."""
        got = self.seen_walk.get((kind, rel, state))
        if got is None:
            grown, before = self.back(kind, rel)
            edits, q = "", state
            while True:
                left = grown + before[q]
                tight = [(e, p) for e, c, p in self.options(kind, q) if c + rel[p] == left]
                if 2 + grown + before[NEXT[q]] == left and not (tight and tight[0][0] == "D"):
                    edits, q = edits + "I", NEXT[q]
                else:
                    break
            got = self.seen_walk[kind, rel, state] = edits + tight[0][0], tight[0][1]
        return got


def _less_least(vector) -> tuple[int, tuple]:
    least = min(vector)
    return least, tuple(min(x - least, FAR) for x in vector)


def costs_before(kinds: str, behind: tuple, steps: Steps) -> list[int]:
    """The vector before the first turn from the one behind the last."""
    base, rel = _less_least(behind)
    for kind in reversed(kinds):
        grown, rel = steps.back(kind, rel)
        base += grown
    return [min(base + x, FAR) for x in rel]


def matrix(kinds: str, steps: Steps) -> list[int]:
    """Least cost from each state before the block to each behind it, row by row."""
    columns = [costs_before(kinds, tuple(0 if p == q else FAR for q in range(4)), steps) for p in range(4)]
    return [columns[p][q] for q in range(4) for p in range(4)]


def audit(kinds: str, behind: tuple, state: int, last: bool, steps: Steps) -> tuple[str, int]:
    """Initials of the ASCII-least cheapest edits from ``state``, and the state behind the block."""
    n = len(kinds)
    step = isqrt(max(n - 1, 0)) + 1
    _, rel = _less_least(behind)
    kept = {n: rel}
    for i in range(n - 1, -1, -1):
        rel = steps.back(kinds[i], rel)[1]
        if i % step == 0:
            kept[i] = rel
    out = []
    for lo in range(0, n, step):
        hi = min(lo + step, n)
        block = [kept.pop(hi)]
        for i in range(hi - 1, lo, -1):
            block.append(steps.back(kinds[i], block[-1])[1])
        for i in range(lo, hi):
            edits, state = steps.walk(kinds[i], block.pop(), state)
            out.append(edits)
    while last and TERMINAL[state]:
        out.append("I")
        state = NEXT[state]
    return "".join(out), state


def apply_edits(edits: str, state: int, kinds: str, roles: list[str], texts: list[str]) -> tuple[int, list[str], list[str]]:
    """Cost, roles and texts of the block's turns after its edits."""
    cost, at, out_roles, out_texts = 0, 0, [], []
    for e in edits:
        if e == "D":
            cost, at = cost + 3, at + 1
            continue
        if e == "K":
            state = KEPT[kinds[at].lower()][state]
            out_roles.append(roles[at])
        else:
            cost, state = cost + 2, NEXT[state]
            out_roles.append(ROLES[state])
        if e == "I":
            out_texts.append("")
        else:
            cost += kinds[at].isupper()
            out_texts.append(texts[at])
            at += 1
    return cost, out_roles, out_texts


# -- blocks --------------------------------------------------------------------

STATS = (
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_role string, last_role string, "
    "first_turn bigint, last_turn bigint, min_turn bigint, max_turn bigint, distinct_turns bigint, cost bigint"
)
BLOCK = f"conv_id bigint, part int, no bigint, whole boolean, kinds string, roles array<string>, texts array<string>, matrix array<bigint>, audit string, {STATS}"
PARTS = ("su", "ua", "au")


class Block:
    """Consecutive turns of one conversation, as a task reads them."""

    def __init__(self, conv_id, part: int, no: int):
        self.conv_id, self.part, self.no = conv_id, part, no
        self.kinds, self.roles, self.texts, self.turns, self.chars = [], [], [], [], 0
        self.faults = [0, 0, 0]

    def add(self, turn, role: str, text: str, fault: int, duplicate: bool) -> None:
        fault = 1 if fault == 1 else 2 if duplicate else fault
        first = role[:1]
        kind = first if first in ("s", "u", "a") else "o"
        if fault:
            self.faults[fault - 1] += 1
        self.kinds.append("D" if fault in (1, 2) else kind.upper() if fault else kind)
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.chars += len(text)

    def row(self, whole: bool, steps: Steps) -> tuple:
        kinds = "".join(self.kinds)
        firsts = [r[:1] for r in self.roles]
        turns = [t for t in self.turns if t is not None]
        roles, texts, edits, cost, own = self.roles, self.texts, None, None, None
        if whole:
            edits, _ = audit(kinds, TERMINAL, 0, True, steps)
            cost, roles, texts = apply_edits(edits, 0, kinds, roles, texts)
        else:
            own = matrix(kinds, steps)
        return (
            self.conv_id, self.part, self.no, whole, kinds, roles, texts, own, edits, *self.faults,
            sum(a + b not in PARTS for a, b in zip(firsts, firsts[1:])), firsts[0], firsts[-1],
            self.turns[0], self.turns[-1], min(turns, default=None), max(turns, default=None), len(set(turns)), cost,
        )


def _blocks(ordered: DataFrame, schema: pa.Schema, block_turns: int, block_chars: int) -> DataFrame:
    """Blocks of turns that come sorted, each duplicate's mark right before it."""

    def run(batches):
        part, steps = TaskContext.get().partitionId(), Steps()
        no, block, marked = 0, None, False
        first_conv, closed = True, False  # closed: an earlier block of the same conversation was emitted
        rows, size = [], 0

        def emit(whole):
            nonlocal no, size
            rows.append(block.row(whole, steps))
            no += 1
            size += block.chars + 200

        for b in batches:
            columns = (b.column(c) for c in ("conv_id", "turn", "role", "text", "fault", "mark"))
            for conv, turn, role, text, fault, mark in zip(*(c.to_pylist() for c in columns)):
                if mark == 0:
                    marked = True
                    continue
                if block is not None and block.conv_id != conv:
                    emit(not first_conv and not closed)
                    first_conv, closed, block = False, False, None
                elif block is not None and (len(block.turns) >= block_turns or block.chars >= block_chars):
                    emit(False)
                    closed, block = True, None
                if block is None:
                    block = Block(conv, part, no)
                block.add(turn, role, text, fault, marked)
                marked = False
            if size > block_chars:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, size = [], 0
        if block is not None:
            emit(False)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return ordered.mapInArrow(run, BLOCK)


def _in_order(df: DataFrame, backwards: bool = False) -> DataFrame:
    """A conversation's blocks in one task, in order; one row per block, read as a stream."""
    n = shuffle_partitions(df.sparkSession)
    keys = [F.col(c).desc() if backwards else F.col(c) for c in ("part", "no")]
    return df.repartition(n, "conv_id").sortWithinPartitions("conv_id", *keys)


def _checkpoints(parts: DataFrame) -> DataFrame:
    """(part, no, behind, last): the vector of costs behind every block, by a chain of matrices from the end."""

    def run(batches):
        conv, vector = object(), None
        for b in batches:
            ids, nos, behind, last = b.column("part"), b.column("no"), [], []
            for c, m in zip(b.column("conv_id").to_pylist(), b.column("matrix").to_pylist()):
                new = c != conv
                if new:
                    conv, vector = c, list(TERMINAL)
                behind.append(vector)
                last.append(new)
                vector = [min(min(m[4 * q + p] + vector[p] for p in range(4)), FAR) for q in range(4)]
            yield pa.RecordBatch.from_arrays([ids, nos, pa.array(behind, pa.list_(pa.int64())), pa.array(last, pa.bool_())], names=["part", "no", "behind", "last"])

    return _in_order(parts.select("conv_id", "part", "no", "matrix"), backwards=True).mapInArrow(run, "part int, no bigint, behind array<bigint>, last boolean")


def _walks(parts: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """(conv_id, part, no, audits, exits): every block walked from each of the four states."""

    def run(batches):
        steps = Steps()
        for b in batches:
            audits, exits = [], []
            for kinds, behind, last in zip(*(b.column(c).to_pylist() for c in ("kinds", "behind", "last"))):
                got = [audit(kinds, tuple(behind), q, last, steps) for q in range(4)]
                audits.append([a for a, _ in got])
                exits.append([q for _, q in got])
            columns = [b.column("conv_id"), b.column("part"), b.column("no"), pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "no", "audits", "exits"])

    joined = parts.select("conv_id", "part", "no", "kinds").join(checkpoints, ["part", "no"]).select("conv_id", "part", "no", "kinds", "behind", "last")
    return joined.mapInArrow(run, "conv_id bigint, part int, no bigint, audits array<string>, exits array<int>")


def _entries(walks: DataFrame) -> DataFrame:
    """(part, no, state): the state in which each block is entered."""

    def run(batches):
        conv, state = object(), 0
        for b in batches:
            states = []
            for c, exits in zip(b.column("conv_id").to_pylist(), b.column("exits").to_pylist()):
                if c != conv:
                    conv, state = c, 0
                states.append(state)
                state = exits[state]
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("no"), pa.array(states, pa.int32())], names=["part", "no", "state"])

    return _in_order(walks.select("conv_id", "part", "no", "exits")).mapInArrow(run, "part int, no bigint, state int")


def _edited(parts: DataFrame, walks: DataFrame, entries: DataFrame, schema: pa.Schema) -> DataFrame:
    """The blocks of conversations that span several, with their edits made."""

    def run(batches):
        for b in batches:
            cost, roles, texts = [], [], []
            for row in zip(*(b.column(c).to_pylist() for c in ("audit", "state", "kinds", "roles", "texts"))):
                c, r, t = apply_edits(*row)
                cost.append(c)
                roles.append(r)
                texts.append(t)
            made = {"cost": pa.array(cost, pa.int64()), "roles": pa.array(roles, pa.list_(pa.string())), "texts": pa.array(texts, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made else b.column(f.name) for f in schema], schema=schema)

    chosen = walks.join(entries, ["part", "no"]).select("part", "no", "state", F.col("audits")[F.col("state")].alias("audit"))
    joined = parts.drop("audit").join(chosen, ["part", "no"])
    return joined.select(*(f.name for f in schema), "state").mapInArrow(run, BLOCK)


def repair_blocks(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    block_turns: int = BLOCK_TURNS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Repaired conversations in blocks of turns, in the order of (part, no) within a conversation.

    A row holds the block's edits (``audit``), the roles and texts of its turns after them, and figures of the turns before: faults,
    illegal neighbours, turn numbers, cost. ``whole`` blocks hold their conversation alone. Turns are taken by number, null numbers first,
    equal numbers by role, then by their text's SHA-256. Null roles and texts are empty. A null id is a conversation like any other; repeated rows
    are duplicates; other columns, whatever their names, are not read; an empty table gives no blocks.
    """
    spark = turns.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    path = scratch_path(spark, "repair-turns")
    rows = store_at(
        turns.select(
            F.col(f"`{id_col}`").cast("bigint").alias("conv_id"),
            F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
            F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
            text.alias("text"),
            F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("sha"),
            fault_of(text).alias("fault"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        path,
    )
    # The first turn of each role and text is the one that stays; all others are marked. Only digests are shuffled for it.
    firsts = rows.groupBy("conv_id", "role", "sha").agg(F.min(F.struct(F.col("turn").isNotNull().alias("a"), "turn", "rid")).alias("f"))
    keys = ["conv_id", "turn", "role", "sha", "rid"]
    again = rows.select(*keys).join(firsts.select(F.col("f.rid").alias("rid")), "rid", "left_anti")
    marks = again.select(*keys, F.lit(None).cast("string").alias("text"), F.lit(0).alias("fault"), F.lit(0).alias("mark"))
    both = marks.unionByName(rows.select(*keys, "text", "fault", F.lit(1).alias("mark")))
    ordered = both.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys, "mark")
    schema = _arrow_schema()
    made = _blocks(ordered.select("conv_id", "turn", "role", "text", "fault", "mark"), schema, block_turns, block_chars)
    blocks = store_at(made, scratch_path(spark, "repair-blocks"))
    discard(spark, path)
    parts = blocks.filter("not whole")
    walks = materialize(_walks(parts, _checkpoints(parts)), "repair-walks")
    return blocks.filter("whole").unionByName(_edited(parts, walks, _entries(walks), schema))


def _arrow_schema() -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(BLOCK))


def fault_of(text: Column) -> Column:
    """1: blank, 3: truncated (its last character beside white space is no . ! ?), else 0; 2, duplicate, is not the text's own."""
    end = F.rtrim(text, F.lit(SPACES))
    return F.when(end == "", 1).when(~F.substring(end, -1, 1).isin(*ENDS), 3).otherwise(0)


# -- results -------------------------------------------------------------------


def repaired_turns(blocks: DataFrame) -> DataFrame:
    """(conv_id, part, no, place, role, text): the turns after repair, in the order of (part, no, place)."""
    return blocks.select(
        "conv_id", "part", "no", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "t")
    ).select("conv_id", "part", "no", "place", F.col("t.roles").alias("role"), F.col("t.texts").alias("text"))


def conversation_reports(blocks: DataFrame) -> DataFrame:
    """One row per conversation: gaps, the faults' counts, illegal, cost, audit, repaired_sha256.

    ``gaps`` counts the numbers missing between the least and greatest turn; ``repaired_sha256`` is that of role:text of the repaired turns,
    joined by newlines. Conversations that span several blocks are put together in a stream of blocks, as one digest is one chain.
    """
    piece = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    figures = [c.split()[0] for c in STATS.split(", ")]
    whole = blocks.filter("whole").select("conv_id", "audit", F.sha2(F.encode(piece, "UTF-8"), 256).alias("repaired_sha256"), *figures)
    parts = blocks.filter("not whole").select("conv_id", "part", "no", "audit", piece.alias("piece"), F.size("roles").alias("n"), *figures)
    schema = ["conv_id", "audit", "repaired_sha256", *figures]

    def run(batches):
        conv, have, out = None, None, []

        def done():
            out.append({**have, "conv_id": conv, "audit": "".join(have["audit"]), "repaired_sha256": have["sha"].hexdigest()})

        def flush():
            columns = [pa.array([r[c] for r in out], pa.string() if c in ("audit", "repaired_sha256", "first_role", "last_role") else pa.int64()) for c in schema]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema)

        for b in batches:
            for r in b.to_pylist():
                if have is None or r["conv_id"] != conv:
                    if have is not None:
                        done()
                    conv, have = r["conv_id"], {**r, "audit": [], "sha": hashlib.sha256(), "n": 0}
                else:
                    for c in ("blank", "duplicate", "truncated", "illegal", "distinct_turns", "cost"):
                        have[c] += r[c]
                    have["illegal"] += have["last_role"] + r["first_role"] not in PARTS
                    have["distinct_turns"] -= r["first_turn"] is not None and have["last_turn"] == r["first_turn"]
                    for c, least in (("min_turn", min), ("max_turn", max)):
                        have[c] = least((x for x in (have[c], r[c]) if x is not None), default=None)
                    have["last_role"], have["last_turn"] = r["last_role"], r["last_turn"]
                have["audit"].append(r["audit"])
                if r["n"]:
                    have["sha"].update((("\n" if have["n"] else "") + r["piece"]).encode("utf-8"))
                    have["n"] += r["n"]
            yield flush()
        if have is not None:
            done()
        yield flush()

    merged = _in_order(parts).mapInArrow(run, f"conv_id bigint, audit string, repaired_sha256 string, {STATS}")
    # as decimals: two turn numbers may lie further apart than a long holds
    turn = lambda c: F.col(c).cast("decimal(20,0)")
    gaps = F.coalesce(turn("max_turn") - turn("min_turn") + 1 - turn("distinct_turns"), F.lit(0))
    gaps = F.least(gaps, F.lit((1 << 63) - 1).cast("decimal(20,0)")).cast("bigint")
    return whole.unionByName(merged).select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )

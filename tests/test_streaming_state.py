"""State carried between micro-batches: bounded reads, crashes, dead letters."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from test_streaming import WIRE, eid, rec

from tidemark.functions import codec
from tidemark.operators import ledger as L
from tidemark.operators import state as S
from tidemark.operators.offsets import partition_ends
from tidemark.session import scratch_scope
from tidemark.streaming import consumer as C


def records(spark, rows):
    return codec.encode(spark.createDataFrame(rows, WIRE)).select("topic", "partition", "offset", "key", "value")


def day(k):
    return (dt.date(2024, 1, 1) + dt.timedelta(days=k)).isoformat()


def run(spark, root, batch, rows):
    with scratch_scope(spark):
        C.process_batch(spark, records(spark, rows), batch, root, "g")


def dispositions(spark, root):
    return {r.offset: r.disposition for r in L.read_ledger(spark, root).collect()}


def test_a_batch_reads_its_months_only_and_folders_stay_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "FANOUT", 2)
    root, asked, sizes = f"{tmp_path}/ledger", [], []
    real = S.read_segments
    monkeypatch.setattr(S, "read_segments", lambda sp, paths: (asked.append(list(paths)), real(sp, paths))[1])
    months = [3, 3, 40, 70, 3]
    offset = 0
    for batch, k in enumerate(months):
        asked.clear()
        rows = [rec(offset + i, day(k + batch * 2 + i)) for i in range(2)]
        if batch:
            rows.append(rec(offset + 2, day(months[batch - 1] + (batch - 1) * 2)))  # seen in the batch before
        run(spark, root, batch, rows)
        offset += len(rows)
        sizes.append(max((len(a) for a in asked), default=0))
        assert all(p.split("month=")[1] in {day(k + batch * 2)[:7], day(k + batch * 2 + 1)[:7], day(months[batch - 1] + (batch - 1) * 2)[:7]} for a in asked for p in a)
    state = S.load(spark, root, below=100)
    assert state.version == len(months) - 1 and sum(n for *_, n, _ in state.segments) == 10
    assert S.read_segments(spark, [s[0] for s in state.segments]).select("event_id").distinct().count() == 10
    assert max(sizes) <= 2 * S.FANOUT
    # two versions, their segments, two held folders
    assert len([n for n in os.listdir(f"{root}/_state") if n.startswith("version=")]) == 2
    assert sorted(os.listdir(f"{root}/_held")) == [f"batch_id={b}" for b in (3, 4)]
    got = dispositions(spark, root)
    assert [got[o] for o in (4, 7, 10)] == ["duplicate"] * 3 and len(got) == offset
    checkpoints = {(r.topic, r.partition): r.next_offset for r in state.checkpoints.collect()}
    assert checkpoints == {("prices", 0): offset}


STEPS = [(1, "write_batch", L), (1, "_write_segments", S)]


@pytest.mark.parametrize("batch,step,module", STEPS)
def test_crash_between_any_two_steps_changes_nothing(spark, tmp_path, monkeypatch, batch, step, module):
    root = f"{tmp_path}/ledger"
    work = [
        [rec(0, day(0)), rec(1, day(1), valid=False), rec(3, day(3))],  # a hole at 2
        [rec(2, day(0), close="101.00"), rec(4, day(3))],
    ]

    class Killed(BaseException):
        pass

    def killed(*_a, **_k):
        raise Killed

    for b, rows in enumerate(work):
        if b == batch:
            with monkeypatch.context() as m:
                m.setattr(module, step, killed)
                with pytest.raises(Killed):
                    run(spark, root, b, rows)
        run(spark, root, b, rows)
    assert dispositions(spark, root) == {0: "inserted", 1: "invalid", 2: "conflict", 3: "inserted", 4: "duplicate"}
    dead = C.read_dead_letters(spark, root)
    assert {(r.topic, r.partition, r.offset, bytes(r.key).decode()) for r in dead.collect()} == {
        ("g.dead-letters", 0, 0, "prices:0:1"), ("g.dead-letters", 0, 1, "prices:0:2"),
    }
    state = S.load(spark, root, below=9)
    assert sum(s[2] for s in state.segments) == 2
    ends = {(r.topic, r.partition): r.end_offset for r in state.dead_ends.collect()}
    assert ends == {(r.topic, r.partition): r.end_offset for r in partition_ends(dead).collect()} == {("g.dead-letters", 0): 2}
    payload = json.loads(bytes(next(r.value for r in dead.collect() if r.offset == 1)).decode())
    assert payload["error_type"] == "ConflictingEventError" and payload["source"]["offset"] == 2


def test_a_ledger_without_state_is_read_once(spark, tmp_path):
    root = f"{tmp_path}/ledger"
    run(spark, root, 0, [rec(0, day(0)), rec(1, day(1))])
    S.remove(spark, f"{root}/_state")
    run(spark, root, 1, [rec(2, day(1)), rec(3, day(2))])
    assert dispositions(spark, root) == {0: "inserted", 1: "inserted", 2: "duplicate", 3: "inserted"}
    assert eid(day(2)) in {r.event_id for r in L.prices_view(L.read_ledger(spark, root)).collect()}


def test_scratch_tables_of_a_scope_are_removed(spark, tmp_path):
    from tidemark.session import materialize

    with scratch_scope(spark):
        path = materialize(spark.range(3), "gone").inputFiles()[0]
        kept = materialize(spark.range(3), "inner")
        assert kept.agg(F.sum("id")).first()[0] == 3 and os.path.exists(path.removeprefix("file:").replace("//", "/"))
    assert not os.path.exists(path.removeprefix("file:").replace("//", "/"))

"""Streams over several batches: the same result in whatever order files come, bounded state, late rows."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.streaming import keyed, streams

START = datetime(2024, 1, 1)


def files(spark, path, parts, schema):
    """Each part a file, in this order, a batch each."""
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
    return streams.stream_table(spark, str(path), 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def run(spark, stream, path, mode="append"):
    """(rows, progress of each batch)."""
    seen = []
    with keyed.started_in(spark):
        q = stream.writeStream.outputMode(mode).option("checkpointLocation", str(path)).trigger(availableNow=True).foreachBatch(lambda d, i: seen.extend(d.collect())).start()
    q.awaitTermination()
    return seen, q.recentProgress


BLOCK = "chain_id long, number long, hash string, parent_hash string, time timestamp"


def forked_chain(rng, n=300):
    """Blocks of a chain with forks: now and then it goes back some blocks and on under other hashes."""
    out, tip, hashes, made = [], 0, {0: "g"}, 0
    while made < n:
        if tip > 3 and rng.random() < 0.05:
            tip -= rng.randint(1, 4) if rng.random() < 0.9 else min(tip, 20)
        tip += 1
        parent = hashes.get(tip - 1, "g") if rng.random() < 0.97 else "unknown"
        hashes[tip] = f"{tip}-{made}"
        made += 1
        out.append((tip, hashes[tip], parent, at(12 * made)))
    return out


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_reorgs_do_not_depend_on_the_order_of_files(spark, tmp_path, order):
    rng = random.Random(7)
    chains = {c: forked_chain(rng) for c in (1, 2)}
    rows = [(c, *b) for c, blocks in chains.items() for b in blocks]
    rng.shuffle(rows)
    parts = [rows[i::4] for i in order] + [[(None, None, None, None, at(10_000_000))]]
    seen, _ = run(spark, keyed.reorgs(files(spark, tmp_path / "b", parts, BLOCK), late="10 days"), tmp_path / "c")
    want = [(c, *r) for c, blocks in chains.items() for r in keyed.walk({}, [b[:3] for b in blocks])]
    assert Counter(tuple(r) for r in seen) == Counter(want) and len(want) > 20


def test_reorgs_come_out_as_the_watermark_moves(spark, tmp_path):
    parts = [[(1, n, f"h{n}", f"h{n - 1}", at(12 * n)) for n in range(lo, lo + 100)] for lo in (0, 100, 200)]
    parts.append([(1, 250, "x", "h249", at(12 * 299 + 1)), (1, 295, "x", "h294", at(12 * 299 + 2)), (1, 400, "z", "y", at(12 * 400))])
    seen, progress = run(spark, keyed.reorgs(files(spark, tmp_path / "b", parts, BLOCK), depth=16, late="0 seconds"), tmp_path / "c")
    assert [(r["number"], r["kind"], r["ancestor"]) for r in seen] == [(295, "replaced", 294)]  # 250 is deeper than what is tracked
    assert progress[-1].stateOperators[0].numRowsTotal <= 16 + 2 + 2  # tracked blocks, what waits, timers


def test_walk_keeps_no_more_than_its_depth():
    tracked = {}
    keyed.walk(tracked, [(n, f"h{n}", f"h{n - 1}") for n in range(5000)], depth=128)
    assert sorted(tracked) == list(range(4872, 5000))
    assert keyed.walk(tracked, [(4900, "x", "h4899")], depth=128) == [(4900, "replaced", 4899)] and max(tracked) == 4900
    assert keyed.walk(tracked, [(4890, "y", "old")], depth=128) == [(4890, "replaced", None)]


def taken(times, seconds):
    out, last = [], 0
    for t in sorted(times):
        if t >= last + seconds:
            out.append(t)
            last = t
    return out


def test_throttled_calls_do_not_depend_on_the_order_of_files(spark, tmp_path):
    rng = random.Random(3)
    times = rng.sample(range(1, 1_000_000), 20_000)
    rows = [(7, i, t, at(t)) for i, t in enumerate(times)] + [(8, 1, 50, at(50)), (8, 2, 50, at(50))]
    parts = [rows[i::3] for i in (1, 2, 0)] + [[(None, None, None, at(10_000_000))]]
    seen, _ = run(spark, keyed.throttled(files(spark, tmp_path / "t", parts, "key long, number long, ts long, time timestamp"), 40, late="20 days"), tmp_path / "c")
    assert sorted(r["ts"] for r in seen if r["key"] == 7) == taken(times, 40)
    assert [r["number"] for r in seen if r["key"] == 8] == [1]


EVENT = "block_number long, log_index long, needs array<string>, time timestamp"
CALL = "block_number long, log_index long, name string, result long, time timestamp"


def test_events_await_several_calls(spark, tmp_path):
    """Ready at once when the last call comes, in any order; backlog with what is missing after the wait; calls without event go."""
    far = at(100_000)
    events = [[(1, 0, ["a", "b"], at(0)), (2, 0, ["a"], at(10)), (3, 0, [], at(10)), (4, 0, ["a", "b"], at(20))], [(5, 0, ["a"], at(400))], [(None, None, None, far)]]
    calls = [[(1, 0, "a", 10, at(5)), (9, 9, "a", 1, at(5)), (5, 0, "a", 50, at(390))], [(1, 0, "b", 11, at(250)), (2, 0, "a", 12, at(400)), (4, 0, "b", 13, at(30)), (4, 0, "other", 0, at(30))], [(None, None, None, None, far)]]
    e, c = files(spark, tmp_path / "e", events, EVENT), files(spark, tmp_path / "c", calls, CALL)
    seen, progress = run(spark, keyed.awaited(e, c, late="10 minutes"), tmp_path / "s")
    got = {r["block_number"]: (r["state"], r["missing"], r["calls"], r["results"]) for r in seen}
    assert got == {
        1: ("ready", [], ["a", "b"], ["10", "11"]), 2: ("backlog", ["a"], [], []), 3: ("ready", [], [], []),
        4: ("backlog", ["a"], ["b"], ["13"]), 5: ("ready", [], ["a"], ["50"]),
    }
    assert len(seen) == 5 and progress[-1].stateOperators[0].numRowsTotal == 0


SWAP = "pool long, time timestamp, order long, price double, volume long"


def test_candles_close_and_leave_the_state(spark, tmp_path):
    hours = [[(p, at(3600 * h + 60 * m), 100 * h + m, float(h + m), 1) for p in range(20) for m in range(5)] for h in range(6)]
    late = [(0, at(3600 + 1), 0, 99.0, 7)]
    parts = [hours[0] + hours[1], hours[2] + hours[3], late + hours[4], hours[5] + [(0, at(86_400), 9999, 1.0, 1)]]
    source = lambda: streams.stream_table(spark, str(tmp_path / "s"), 1)
    files(spark, tmp_path / "s", parts, SWAP)
    seen, progress = run(spark, streams.candles(source(), late="30 minutes"), tmp_path / "c")
    got = Counter((r["pool"], r["start"], r["open"], r["close"], r["volume"]) for r in seen)
    assert got == Counter((p, at(3600 * h), float(h), float(h + 4), 5) for p in range(20) for h in range(6))
    rows = [p.stateOperators[0].numRowsTotal for p in progress]
    assert max(rows) <= 80 and rows[-1] == 1 and sum(p.stateOperators[0].numRowsDroppedByWatermark for p in progress) == 1
    side, _ = run(spark, keyed.late_rows(source(), "30 minutes"), tmp_path / "l")
    assert [tuple(r) for r in side] == late
    updates, _ = run(spark, streams.candles(source(), late="30 minutes"), tmp_path / "u", "update")
    assert len(updates) > len(seen)


def test_sessions_keep_their_settings(spark):
    before = {k: spark.conf.get(k, None) for k in keyed.NEEDED}
    with keyed.started_in(spark):
        assert spark.conf.get(list(keyed.NEEDED)[1]) == "false"
    assert {k: spark.conf.get(k, None) for k in keyed.NEEDED} == before

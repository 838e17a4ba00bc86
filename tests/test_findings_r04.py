"""What the fourth round of review found: events that await several calls, many at a time."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import live
from ledgerloom.streaming import keyed
from test_findings_r03 import same_as_sql, write
from test_streams import CALL, EVENT, at, files, run


def test_events_of_a_group_wait_as_one_row_of_state(spark, tmp_path):
    """Once a row each, which cost several calls of the state store an event."""
    events = [[(n, 0, ["a"], at(n)) for n in range(2000)], [(None, None, None, at(10_000_000))]]
    calls = [[(n, 0, "a", n, at(n + 1)) for n in range(3000, 3500)], [(n, 0, "a", n, at(n + 1)) for n in range(0, 2000, 2)]]
    e, c = files(spark, tmp_path / "e", events, EVENT), files(spark, tmp_path / "c", calls, CALL)
    seen, progress = run(spark, keyed.awaited(e, c, late="1 day"), tmp_path / "s")
    assert Counter((r["block_number"], r["state"], *r["results"]) for r in seen) == Counter([(n, "ready", str(n)) if n % 2 == 0 else (n, "backlog") for n in range(2000)])
    assert progress[0].stateOperators[0].numRowsTotal <= 4 and progress[-1].stateOperators[0].numRowsTotal == 0


def test_events_that_outlast_others_of_their_group_are_woken_too(spark, tmp_path):
    """The timer that was expiring was taken for one to come, so none was left for the later ones."""
    events = [[(1, 0, ["a"], at(0)), (2, 0, ["a"], at(1000))], [(None, None, None, at(900))], [(None, None, None, at(90_000))]]
    e, c = files(spark, tmp_path / "e", events, EVENT), files(spark, tmp_path / "c", [[(None, None, None, None, at(0))]] * 3, CALL)
    seen, progress = run(spark, keyed.awaited(e, c), tmp_path / "s")
    assert sorted((r["block_number"], r["state"]) for r in seen) == [(1, "backlog"), (2, "backlog")]
    assert progress[-1].stateOperators[0].numRowsTotal == 0


def test_packed_rows_are_late_each_by_its_own_time(spark, tmp_path):
    """A late row does not come in with one of its group that is on time; of several calls of a name the earliest counts, then the least result."""
    events = [[(1, 0, ["b", "a", "a"], at(5000)), (2, 40, ["a"], at(5000)), (20_000, 0, [], at(5000))], [(3, 0, ["a"], at(10)), (4, 0, ["a"], at(5000))], [(None, None, None, at(90_000))]]
    calls = [[(1, 0, "a", 7, at(5001))], [(1, 0, "a", 9, at(4999)), (1, 0, "a", 8, at(4999)), (1, 0, "b", 5, at(5300)), (2, 40, "a", 1, at(5301)), (3, 0, "a", 1, at(10)), (4, 0, "a", 6, at(5000))], [(None, None, None, None, at(90_000))]]
    e, c = files(spark, tmp_path / "e", events, EVENT), files(spark, tmp_path / "c", calls, CALL)
    seen, _ = run(spark, keyed.awaited(e, c, late="10 minutes"), tmp_path / "s")
    got = sorted((r["block_number"], r["log_index"], r["state"], *r["missing"], *r["calls"], *r["results"]) for r in seen)
    assert got == [(1, 0, "ready", "a", "b", "8", "5"), (2, 40, "backlog", "a"), (4, 0, "ready", "a", "6"), (20_000, 0, "ready")]


@pytest.mark.parametrize("quarters", [(200, 3, 0, 200), (1, 0, 0, 400)])
def test_a_part_of_several_files_is_one_batch(spark, quarters):
    """Also where a part has fewer rows than files, or none."""
    ids = [(1000 * q + i,) for q, n in enumerate(quarters) for i in range(n)]
    rows = spark.createDataFrame([*ids, (3999,)], "event_id long").withColumn("time", F.timestamp_seconds("event_id"))
    seen = []
    stream = live._arriving(spark, rows, (2, 0, 3, 1), 10)
    q = stream.writeStream.trigger(availableNow=True).foreachBatch(lambda d, i: seen.append(sorted({r[0] // 1000 if r[0] is not None else None for r in d.select("event_id").collect()}))).start()
    q.awaitTermination()
    assert seen == [[q] if quarters[q] or q == 3 else [] for q in (2, 0, 3, 1)] + [[None]]


def test_several_calls_where_parts_are_several_uneven_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "FILE_ROWS", 20)
    write(tmp_path, events="""SELECT (i * i // 40)::BIGINT AS event_id, TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * (i * 37 % 900) AS ts, 1::BIGINT AS user_id, 'view' AS event_type, 1.0 AS value
FROM range(40, 1400) t(i) UNION ALL SELECT 90000, TIMESTAMP '2024-05-01', 1, 'view', 1.0""")
    same_as_sql(spark, tmp_path, "l09_several_calls")

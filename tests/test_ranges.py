"""Range files, recomputed ranges and running sums by buckets."""

import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window, functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual

from ledgerloom.operators import entities, merge, reorg, running, tvl
from ledgerloom.sources import range_files, scan


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("files"))
    rows = [(b, b * 10 + i, f"s{i % 2}", f"e{i % 3}") for b in range(100) for i in range(6)]
    df = spark.createDataFrame(rows, "block_number long, id long, source_name string, event_name string")
    written = range_files.write_range_files(df.repartition(7), path, 10)
    range_files.register(spark)
    return path, rows, written


def planned(path, *filters):
    """Files of the partitions that a scan with these filters has."""
    reader = range_files.RangeReader(path, range_files.BlockRanges({"path": path}).schema())
    left = list(reader.pushFilters(list(filters)))
    return {(p.source, p.event, p.start, p.end) for p in reader.partitions() if p.path}, left


def test_range_files_hold_their_ranges(events):
    path, rows, written = events
    assert {os.path.relpath(f, path) for f in written} == {f"s{s}/e{e}/{a}-{a + 9}.parquet" for s in (0, 1) for e in range(3) for a in range(0, 100, 10)}
    assert not [f for _, _, names in os.walk(path) for f in names if not f.endswith((".parquet", ".crc"))]


@pytest.mark.parametrize(("lo", "hi"), [(0, 100), (15, 42), (20, 30), (29, 30), (30, 30), (99, 200), (100, 200)])
def test_only_overlapping_files_are_opened(spark, events, lo, hi):
    path, rows, _ = events
    files, left = planned(path, GreaterThanOrEqual(("block_number",), lo), LessThan(("block_number",), hi), EqualTo(("source_name",), "s1"))
    assert files == {("s1", f"e{e}", a, a + 9) for e in range(3) for a in range(0, 100, 10) if a + 9 >= lo and a < hi}
    assert len(left) == 2
    df = spark.read.format("block_ranges").load(path).filter((F.col("block_number") >= lo) & (F.col("block_number") < hi) & (F.col("source_name") == "s1"))
    assert Counter(tuple(r) for r in df.select("block_number", "id", "source_name", "event_name").collect()) == Counter(r for r in rows if lo <= r[0] < hi and r[2] == "s1")
    assert lo == hi or df.rdd.getNumPartitions() == max(1, len(files))  # of an empty range Spark plans no scan


def test_filters_of_all_kinds_choose_files(events):
    path, _, _ = events
    assert {f[2] for f in planned(path, EqualTo(("block_number",), 35))[0]} == {30}
    assert {f[2] for f in planned(path, GreaterThan(("block_number",), 89))[0]} == {90}
    assert {f[2] for f in planned(path, LessThanOrEqual(("block_number",), 10))[0]} == {0, 10}
    assert {f[1] for f in planned(path, In(("event_name",), ("e0", "e2", "x")), In(("event_name",), ("e2", "e1")))[0]} == {"e2"}
    assert planned(path, EqualTo(("event_name",), "none"))[0] == set()
    assert len(planned(path, EqualTo(("id",), 3))[1]) == 1


def test_columns_that_later_files_lack_are_null(spark, events, tmp_path):
    df = spark.createDataFrame([(5, 1, "s", "e")], "block_number long, a long, source_name string, event_name string")
    range_files.write_range_files(df, str(tmp_path), 10)
    range_files.write_range_files(df.selectExpr("block_number + 10 as block_number", "a * 2 as b", "source_name", "event_name"), str(tmp_path), 10)
    got = spark.read.format("block_ranges").schema("block_number long, a long, b long, event_name string").load(str(tmp_path)).orderBy("block_number").collect()
    assert [tuple(r) for r in got] == [(5, 1, None, "e"), (15, None, 2, "e")]
    with pytest.raises(Exception, match="no range files"):
        spark.read.format("block_ranges").load(str(tmp_path / "none")).count()


def contents(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("reach", [0, 3])
def test_a_reorganisation_rewrites_its_ranges_only(spark, tmp_path, reach):
    """The table equals a rebuild, with derived rows that look `reach` blocks back, and files of other ranges stay."""
    path, rng = str(tmp_path), random.Random(1)
    table = lambda rows: spark.createDataFrame(rows, "block_number long, v long")
    old = [(b, rng.randint(0, 99)) for b in range(200) for _ in range(3) if b % 7]

    def derive(rows):
        near = rows.alias("a").join(rows.groupBy("block_number").agg(F.sum("v").alias("v")).alias("b"), F.expr(f"b.block_number between a.block_number - {reach} and a.block_number"))
        return near.groupBy("a.block_number").agg(F.sum("b.v").alias("total"))

    scan.write_ranges(derive(table(old)), path, 10, "overwrite")
    before = contents(path)
    gone = {57, 58, 141, *range(170, 180)}
    new = [r for r in old if r[0] not in gone] + [(57, 1000), (58, 2000)]
    done = reorg.recompute(spark, path, table(new), spark.createDataFrame([(b,) for b in gone], "number long"), derive, size=10, behind=reach)
    got, want = spark.read.parquet(path).select("block_number", "total"), derive(table(new))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.select("block_number", "total").collect()))
    assert set(done) == ({5, 14, 17} if not reach else {5, 6, 14, 17, 18})
    changed = {f for f, at in before.items() if contents(path).get(f) != at}
    assert {int(f.split("=")[1].split("/")[0]) for f in changed} == set(done)
    assert not os.path.exists(os.path.join(path, "block_bucket=17"))
    assert reorg.recompute(spark, path, table(new), spark.createDataFrame([], "number long"), derive, size=10) == []


@pytest.mark.parametrize("bucket", [1, 7, 1000])
def test_running_sums_equal_one_window(spark, bucket):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 1, 1, 2]), rng.randint(-50, 150), i, rng.choice([None, rng.randint(-9, 9)])) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, at long, i long, v long")
    direct = F.coalesce(F.sum("v").over(Window.partitionBy("k").orderBy("at", "i").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    want = Counter(map(tuple, df.withColumn("total", direct).collect()))
    assert Counter(map(tuple, running.running_sums(df, ["k"], "at", {"total": F.col("v")}, bucket, ("i",)).collect())) == want
    once = df.filter("k is not null").select("k", "at").distinct()
    after = once.withColumn("n", F.lead("at").over(Window.partitionBy("k").orderBy("at")))
    assert Counter(map(tuple, running.next_values(once, ["k"], "at", "n", bucket).collect())) == Counter(map(tuple, after.collect()))


def test_one_busy_key_is_ordered_in_buckets(spark):
    """Ten times the rows of one key are ten times the window groups, not one longer group."""
    for n in (1000, 10_000):
        df = spark.range(n).selectExpr("1L as pool", "-60 as tick_lower", "60 as tick_upper", "id as block", "1L as liquidity_delta")
        got = tvl.validity(df, bucket=100)
        assert got.filter("liquidity = from_block + 1 and (to_block = from_block + 1 or to_block is null)").count() == n
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        orders = [line for line in plan.splitlines() if "Window [" in line]
        assert orders and all("_part" in line for line in orders)


def test_holders_come_and_go(spark):
    rng, moves, balance, want = random.Random(5), [], defaultdict(int), {}
    for block in range(300):
        for _ in range(3):
            t, a, b, v = rng.randint(0, 1), rng.randint(0, 9), rng.randint(0, 9), rng.randint(0, 5)
            moves.append((t, block, a, b, v))
            balance[t, a] -= v
            balance[t, b] += v
        for t in (0, 1):
            want[t, block] = sum(v > 0 for (k, _), v in balance.items() if k == t)
    df = spark.createDataFrame(moves, "token long, block long, from_address long, to_address long, value long")
    got = {(r["token"], r["block"]): r["holder_count"] for r in entities.holder_counts(df, "block", 16).collect()}
    assert got == {k: n for k, n in want.items() if want.get((k[0], k[1] - 1), 0) != n}


def test_watermarks_and_missing_ranges_by_buckets(spark):
    done = spark.createDataFrame([("a", n) for n in range(50) if n not in (33, 40)] + [("b", 5), ("b", 5), ("b", 7)], "handler string, range_index long")
    for bucket in (1, 10, 1000):
        assert {r["handler"]: r["complete_to"] for r in merge.completion_watermark(done, bucket=bucket).collect()} == {"a": 32, "b": 5}
    missing = merge.missing_ranges(done, 0, 49, 1)
    assert Counter(r["handler"] for r in missing.collect()) == {"a": 2, "b": 48}

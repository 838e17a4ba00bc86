"""Derivations over batches and streams, and the path cache as pools change."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import pricing
from ledgerloom.streaming import derive

SWAPS = "pool long, block long, price double"


def counted():
    """Swaps per pool and parity of the block: a fact per block, and a total that reads it."""
    facts = derive.Derivation(
        "facts", ("swaps",), {"counts": derive.Output(("pool", "block"), "block", "first", "block")},
        lambda t: {"counts": t["swaps"].groupBy("pool", "block").agg(F.count(F.lit(1)).alias("n"))},
    )
    totals = derive.Derivation(
        "totals", ("counts", "names"), {"totals": derive.Output(("name",), "upto", "newest"), "seen": derive.Output(("pool",), "pool", "all")},
        lambda t: {
            "totals": t["counts"].join(t["names"], "pool").groupBy("name").agg(F.sum("n").alias("n"), F.max("block").alias("upto")),
            "seen": t["counts"].select("pool"),
        },
        version=2,
    )
    return [totals, facts]


def test_two_derivations_run_alike_over_batches_and_tables(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randint(0, 3), b, float(b)) for b in range(60) for _ in range(2)]
    names = spark.createDataFrame([(p, f"n{p % 2}") for p in range(4)], "pool long, name string")
    whole = derive.run(counted(), {"swaps": spark.createDataFrame(rows, SWAPS), "names": names})
    write = derive.sink(counted(), str(tmp_path), lambda b: {"swaps": b, "names": names})
    for i in range(3):
        write(spark.createDataFrame(rows[i * 40 : i * 40 + 40], SWAPS), i)
    write(spark.createDataFrame(rows[80:], SWAPS), 2)  # the last batch again
    totals, facts = counted()
    for d, name in ((facts, "counts"), (totals, "totals"), (totals, "seen")):
        assert Counter(map(tuple, derive.read(spark, str(tmp_path), d, name).collect())) == Counter(map(tuple, whole[name].collect()))
    assert sorted(map(tuple, derive.progress(spark, str(tmp_path), totals).collect())) == [("totals_v2", 0, 19), ("totals_v2", 20, 39), ("totals_v2", 40, 59)]
    gone = spark.createDataFrame([(b,) for b in range(50, 60)], "number long")
    left = derive.read(spark, str(tmp_path), facts, "counts", gone)
    assert {r["block"] for r in left.collect()} == set(range(50))


def test_policies_pick_a_row_whatever_the_batches(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (1, 3, "c"), (1, 9, "d"), (2, None, "e")], "k long, at long, v string")
    pick = lambda policy: {r["k"]: r["v"] for r in derive.resolve(rows, derive.Output(("k",), "at", policy)).collect()}
    assert pick("first") == {1: "b", 2: "e"} and pick("newest") == {1: "d", 2: "e"}


def test_wrong_declarations_are_told():
    one = derive.Derivation("a", ("x",), {"y": derive.Output(("k",), "k")}, lambda t: {})
    with pytest.raises(ValueError, match="made by"):
        derive.ordered([one, derive.Derivation("b", (), {"y": derive.Output(("k",), "k")}, lambda t: {})])
    with pytest.raises(Exception, match="cycle"):
        derive.ordered([one, derive.Derivation("c", ("y",), {"x": derive.Output(("k",), "k")}, lambda t: {})])
    with pytest.raises(ValueError, match="lacks"):
        derive.run([one], {})
    with pytest.raises(ValueError, match="makes"):
        derive.run([one], {"x": None})
    with pytest.raises(ValueError, match="policy"):
        derive.Output(("k",), "k", "last")


@pytest.mark.parametrize("seed", [1, 2])
def test_path_cache_equals_paths_from_scratch(spark, monkeypatch, seed):
    """After random changes of the pools, with only touched targets solved again; tokens without a path are kept as such."""
    rng = random.Random(seed)
    edges = {(a, b): rng.randint(1, 50) for a in range(40) for b in range(a + 1, min(40, a + 4)) if rng.random() < 0.4}
    frame = lambda e: spark.createDataFrame([(a, b, a * 100 + b, w) for (a, b), w in e.items()], "a long, b long, pool long, weight long")
    anchors, tokens = spark.createDataFrame([(0,)], "token long"), spark.range(1, 45).withColumnRenamed("id", "token")
    show = lambda df: Counter((r["target"], r["anchor"], r["bottleneck"], r["hops"], tuple(r["path"] or ())) for r in df.collect())
    cache = spark.createDataFrame([], "target long, anchor long, bottleneck long, hops int, path array<bigint>, resolved_block long")
    cache = pricing.update_paths(cache, frame(edges), frame(edges), tokens, anchors, 100)
    solved = []
    best = pricing.best_paths
    monkeypatch.setattr(pricing, "best_paths", lambda e, t, *a: solved.append(t.count()) or best(e, t, *a))
    old, new = edges, dict(edges)
    for k in rng.sample(sorted(new), 2):
        new.pop(k)
    new[rng.choice(sorted(new))] += 100
    new[2, 30] = 7
    cache = pricing.update_paths(cache, frame(old), frame(new), tokens, anchors, 200)
    scratch = best(frame(new), tokens, anchors)
    missing = tokens.join(scratch.select(F.col("target").alias("token")), "token", "left_anti")
    want = show(scratch) + Counter((r["token"], None, None, None, ()) for r in missing.collect())
    assert show(cache) == want and solved[0] < 44
    again = pricing.update_paths(cache, frame(new), frame(new), tokens.filter("token < 40"), anchors, 300)
    assert solved[1] == 0 and again.count() == 39  # nothing changed, and tokens that are no targets went
    assert pricing.update_paths(again, frame(new), frame(new), tokens, anchors, 400_000).filter("resolved_block = 400000").count() == 44

"""The pipeline's stages against brute force on the smallest tables, and on odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerloom.llm import decontam, quality, simhash
from ledgerloom.llm.common import cut, table


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = cut(P.good_quality(spark, docs, sf))
    model = quality.fit_quality(docs, table(spark, sf, "labels"))
    ids = sorted(texts)
    want = {i for i, s in zip(ids, quality.score(model, [texts[i] for i in ids])) if s >= 0.7}
    assert {r["doc_id"] for r in good.collect()} == want
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    assert all(i in want for i, q in labels.items() if q)

    clean = cut(P.without_boilerplate(spark, good, sf))
    assert clean.count() == good.count() and clean.columns == list(P.COLUMNS)

    kept = cut(P.without_near_copies(spark, clean, sf))
    before = {r["doc_id"]: shingles(r["text"]) for r in clean.collect()}
    left = {r["doc_id"] for r in kept.collect()}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i in before:  # whatever went has a close copy, and exact copies all went
        near = [j for j in before if j != i and like(before[i], before[j]) >= 0.6]
        assert i in left or near
        assert i not in left or not [j for j in near if j in left and j < i and like(before[i], before[j]) > 0.95]

    safe = cut(P.without_benchmark(spark, kept, sf))
    items = [decontam.words_of(r["text"]) for r in table(spark, sf, "benchmark").collect()]
    held = {r["doc_id"] for r in kept.collect() if any(f" {' '.join(w)} " in f" {' '.join(decontam.words_of(r['text']))} " for w in items)}
    gone = left - {r["doc_id"] for r in safe.collect()}
    assert held and held <= gone and len(gone) <= len(held) + 2

    out = P.mixed(spark, safe, sf)
    total = sum(len(r["text"].split()) for r in safe.collect())
    assert abs(out.agg(F.sum("mix_tokens")).first()[0] - total) < 0.2 * total


def test_run_is_the_stages(spark, sf):
    docs = table(spark, sf, "documents")
    for _, stage in P.STAGES:
        docs = cut(stage(spark, docs, sf))
    a = sorted((r["doc_id"], r["mix_epoch"]) for r in docs.collect())
    assert a == sorted((r["doc_id"], r["mix_epoch"]) for r in P.run(spark, sf).collect())
    assert [n for n, _ in P.STAGES][2] == "SimHash near-dedup" and len(P.STAGES) == 5 and P.ORACLE_SQL is None


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "plain words here to read.", None, "s", 3), (3, "x " * 50_000, "en", "s", 1)]])
def test_odd_input(spark, sf, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit(1)).withColumn("_host", F.lit("z"))
    for name, stage in P.STAGES:
        docs = cut(stage(spark, docs, sf))
        assert docs.columns[:5] == list(P.COLUMNS), name
    if rows:
        assert 2 in {r["doc_id"] for r in docs.collect()}


def test_near_copies_are_those_of_the_exact_similarity(spark):
    rng = np.random.default_rng(4)
    texts, family = [], []
    for f in range(120):  # families of three to six, edited so that similarities lie around 0.8
        base = rng.integers(0, 30_000, 300)
        for k in range(3 + f % 4):
            version = base.copy()
            at = rng.choice(300, int(rng.integers(0, 9)) if k else 0, replace=False)
            version[at] = rng.integers(0, 30_000, len(at))
            texts.append(" ".join(f"w{x}" for x in version))
            family.append(f)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates_similar(rows).collect()}
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    likeness = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(texts)) for j in range(i) if family[i] == family[j]}
    for (i, j), s in likeness.items():
        if s >= 0.8:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    assert all(find(i) == find(got[i]) for i in got), "documents that are no near copies were linked"
    edge = [p for p, s in likeness.items() if 0.8 <= s < 0.85]
    assert len(edge) > 100 and len([1 for i, j in edge if got[i] == got[j]]) >= 0.9 * len(edge)
    assert len({find(i) for i in got}) > 150  # families fall apart where they should


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_decisions_fall_on_rows_not_on_ids(spark, sf, monkeypatch, few):
    """By a join of rows and keys, and by sending the keys to the rows."""
    monkeypatch.setattr(P, "BROADCAST_IDS", few)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = [" ".join(f"w{k}x{i}" for i in range(100)) for k in range(4)]
    rows = [(None, long[0], "en", "s", 1), (None, long[0], "en", "t", 1), (5, long[1], "en", "s", 1), (5, long[2], "en", "s", 1), (6, long[3], "en", "s", 1), (6, long[3], "en", "s", 1), (None, long[3], "en", "s", 1)]
    kept = P.without_near_copies(spark, spark.createDataFrame(rows, schema), sf).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(0, long[0]), (5, long[1]), (5, long[2]), (6, long[3])])
    item = table(spark, sf, "benchmark").orderBy("item_id").first()["text"]
    rows = [(None, item, "en", "s", 1), (None, long[0], "en", "s", 1), (5, item, "en", "s", 1), (5, long[1], "en", "s", 1)]
    safe = P.without_benchmark(spark, spark.createDataFrame(rows, schema), sf).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in safe) == sorted([(0, long[0]), (5, long[1])])


def _families(rng, sizes, length=200, edits=12):
    texts = []
    for size in sizes:
        base = rng.integers(0, 30_000, length)
        for k in range(size):
            version = base.copy()
            at = rng.choice(length, int(rng.integers(0, edits)) if k else 0, replace=False)
            version[at] = rng.integers(0, 30_000, len(at))
            texts.append(" ".join(f"w{x}" for x in version))
    return texts


def test_hot_buckets_and_large_families_lose_no_link(spark, monkeypatch):
    """All texts' exact components, with hot buckets, blocks of a few texts, and texts that are found by a join."""
    rng = np.random.default_rng(9)
    texts = _families(rng, [60, 25, 8, *[1] * 20])
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates_similar(rows).collect()}
    for name, value in (("HOT", 6), ("TOGETHER", 7), ("BROADCAST_IDS", 0)):
        monkeypatch.setattr(simhash, name, value)
    forced = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates_similar(rows).collect()}
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    want = {i: find(i) for i in range(len(texts))}
    assert forced == want and plain == want and 3 < len(set(want.values())) < len(texts) - 20

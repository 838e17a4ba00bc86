"""Each operator on small inputs: brute force, edge cases, nulls, repeats, empty tables, clashing columns."""

import math
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import common, components, decontam, language, line_dedup, mixing, pii, quality, registry, simhash, topk, toxicity, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, 0) for i, t in enumerate(texts)], DOCS)


EDGE = [None, "", "   ", "a", "same line\nother", "same line\nother", "é" * 50, "word " * 30_000]


def clashing(df):
    internal = "_host _bad _kept _hsrc _hbad _h _htokens _before _sum _full _rest _source _place src tokens digest plan key h held other page raw node level host path"
    for c in ("score", "fp", "u", "v", "bucket", "n", "line", "block", "rank", "component_id", "held_out", "label", "mix_epoch", "_source_x", "a.b", *internal.split()):
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.mark.parametrize("form", ["edge", "empty"])
def test_edge_cases(spark, form):
    d = clashing(docs(spark, EDGE if form == "edge" else []))
    n = 0 if form == "empty" else len(EDGE)
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(n)], "doc_id long, quality int, toxic int")
    assert simhash.near_duplicates(d).count() == n
    assert simhash.near_duplicates_similar(d, tables=8).count() == n
    assert quality.score_quality(d, quality.fit_quality(d, labels)).filter("score between 0 and 1").count() == n
    assert toxicity.score_toxicity(d, toxicity.fit_toxicity(d, labels)).filter("score between 0 and 1").count() == n
    assert language.identify(d, language.fit_language(d)).filter("score between 0 and 1").count() == n
    assert pii.replace_entities(d, secret="s").count() == n
    cleaned = line_dedup.dedup_lines(d)
    assert cleaned.count() == n and cleaned.columns == [*d.columns, "lines_total", "lines_dropped"]
    urls = clashing(d.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://x.org/"), F.coalesce("text", F.lit(""))).alias("url"), F.col("text").alias("html")))
    marks = url_filter.label_pages(urls, d, labels.select("doc_id", (F.col("quality") == 0).alias("bad")))
    assert url_filter.filter_urls(urls, marks).count() == n
    vectors = clashing(d.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0), F.col("doc_id").cast("float")).alias("embedding")))
    assert topk.top_k(vectors, F.lit(True)).count() == (5 * n)
    assert decontam.find_leaks(d, spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")).count() == 0
    mixed = mixing.mix_sources(d)
    assert mixed.count() == (5 if n else 0)  # the texts with tokens, once each: one source
    assert mixed.columns.count("mix_epoch") == 1 and set(d.columns) < set(mixed.columns)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_equals_brute_force(spark, sf):
    rows = registry.op6_simhash(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{fps[i]:016x}", find(i)) for i in ids}
    assert len({find(i) for i in ids}) < len(ids)


def test_links_of_close_fingerprints_are_not_lost(spark):
    rng = np.random.default_rng(0)
    base = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    fps = set(base)
    for x in base:
        for _ in range(12):
            y = x
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    fps = sorted(x - (1 << 64) if x >= 1 << 63 else x for x in fps)
    links = simhash.link_fingerprints(spark.createDataFrame([(x,) for x in fps], "fp long"))
    root = {r["u"]: r["root"] for r in components.components(links).collect()}
    parent = {x: x for x in fps}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {x: root.get(x, x) for x in fps} == {x: find(x) for x in fps}


def test_similar_documents_meet(spark):
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(5000)])
    base = rng.choice(words, 300)
    near, far = base.copy(), base.copy()
    near[[20, 150]] = "changed"  # 10 of 296 shingles
    far[::4] = "other"
    out = simhash.near_duplicates_similar(docs(spark, [" ".join(x) for x in (base, near, far, base)])).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {0: 0, 1: 0, 2: 2, 3: 0}


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501), (501, 502), (7, 7)], "u long, v long")
    got = {r["u"]: r["root"] for r in components.components(e).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {501: 500, 502: 500}


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    vec = rng.normal(size=(300, 8)).round(1).astype("float32")
    rows = [(i, v.tolist()) for i, v in enumerate(vec)] + [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 8), (None, [1.0] * 8), (7, vec[7].tolist())]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False))).collect()
    q = np.floor(256 * vec.astype(float)).astype(int)
    want = []
    for i in range(0, 300, 50):
        order = sorted((j for j in range(300) if j != i), key=lambda j: (-(q[i] @ q[j]), j))[:5]
        want += [(i, r + 1, j, int(q[i] @ q[j])) for r, j in enumerate(order)]
    assert sorted(map(tuple, got)) == want
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_top_k_of_large_components_and_of_one_region(spark):
    rng = np.random.default_rng(7)
    vec = np.concatenate([rng.normal(size=(150, 6)) * 1e6, np.tile(rng.normal(size=(1, 6)) * 1e6, (50, 1)), rng.normal(size=(50, 6)) * 1e10])
    q = [[int(np.floor(256 * c)) for c in v] for v in vec]
    got = topk.top_k(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vec)], "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    clip = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    want = []
    for i in range(0, 250, 50):
        order = sorted((-clip(sum(a * b for a, b in zip(q[i], q[j]))), j) for j in range(250) if j != i)[:5]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(order)]
    assert sorted(map(tuple, got)) == want


def test_top_k_skips_regions_without_loss(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 40)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(12, 8)) * 20
    vec = (centre[rng.integers(0, 12, 900)] + rng.normal(size=(900, 8))).round(2)
    got = topk.top_k(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vec)], "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0).collect()
    q = np.floor(256 * vec).astype(np.int64)
    want = []
    for i in range(0, 900, 10):
        s = q @ q[i]
        order = sorted((j for j in range(900) if j != i), key=lambda j: (-s[j], j))[:5]
        want += [(i, r + 1, j, int(s[j])) for r, j in enumerate(order)]
    assert sorted(map(tuple, got)) == want


def test_top_k_block_stops_early_without_loss():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 16)) * 100 + rng.normal(size=(5, 16))[rng.integers(0, 5, 2000)] * 400
    x = np.floor(x)
    piv = topk.choose_pivots(x, 16)
    d = np.linalg.norm(x[:, None] - piv[None], axis=2)
    ids = np.arange(2000)
    got = topk.search_block(ids[:20], x[:20], d[:20], ids, x, d, 5)
    for i in range(20):
        s = x @ x[i]
        best = sorted((j for j in ids if j != i), key=lambda j: (-s[j], j))[:5]
        assert sorted(g[1] for g in got if g[0] == i) == sorted(best)


def edit(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return min(row)


def test_decontamination_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    vocab = np.array(["the", "of", "and", *[f"w{i}" for i in range(60)]])
    items = [(i, list(rng.choice(vocab, n))) for i, n in enumerate((8, 15, 15, 22, 40, 3))]
    texts = []
    for trial in range(80):
        words = list(rng.choice(vocab, rng.integers(5, 120)))
        if trial % 2:
            item = list(items[trial % len(items)][1])
            for _ in range(rng.integers(0, max(1, len(item) // 4) + 1)):
                p = rng.integers(0, len(item))
                kind = rng.integers(0, 3)
                item[p : p + 1] = [] if kind == 0 else ["new"] if kind == 1 else [item[p], "new"]
            at = rng.integers(0, len(words))
            words[at:at] = item
        texts.append(words)
    got = decontam.find_leaks(docs(spark, [" ".join(t) for t in texts]), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in got.collect()}
    want = {(d, i): e for d, t in enumerate(texts) for i, w in items if (e := edit(w, t)) <= int(0.2 * len(w))}
    assert set(got) <= set(want)
    assert len(set(want) - set(got)) <= 0.02 * len(want) + 1
    assert all(got[k] == want[k] for k in got)
    exact = {k for k, e in want.items() if e == 0}
    assert exact and exact <= set(got)


def test_decontamination_finds_planted_passages(spark, sf):
    d = {r["doc_id"]: decontam.words_of(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r["item_id"]: decontam.words_of(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    held = {(i, k) for i, t in d.items() for k, w in items.items() if f" {' '.join(w)} " in f" {' '.join(t)} "}
    assert held and held <= {(r["doc_id"], r["item_id"]) for r in registry.op10_decontam(spark, sf).collect()}


def _accuracy(rows, truth):
    held = [(r, truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r, _ in held)
    return held


def test_classifiers_hold_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = _accuracy(registry.op5_quality(spark, sf).collect(), labels)
    assert np.mean([r["predicted"] == t["quality"] for r, t in held]) > 0.97
    held = _accuracy(registry.op3_toxicity(spark, sf).collect(), labels)
    assert np.mean([r["predicted"] == t["toxic"] for r, t in held]) > 0.93
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = _accuracy(registry.op7_language(spark, sf).collect(), langs)
    assert np.mean([r["lang_pred"] == t for r, t in held]) > 0.97


def test_language_without_letters(spark):
    d = spark.createDataFrame([(1, "le chat est la " * 20, "fr"), (2, "the cat is on it " * 20, "en"), (3, "123 !!", "en"), (4, None, None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(d, language.fit_language(d)).collect()}
    assert got[3] == got[4] == "und" and got[1] != "und"


def test_toxic_grammar():
    g = toxicity.Grammar({"vequ-": 3.0})
    plain, aimed = g.document("A vequma here.")[0], g.document("You are a vequma here.")[0]
    assert aimed > plain > 0
    assert g.document("He said you are a vequma.")[0] < aimed
    assert g.document("You are not a vequma.")[0] < aimed
    assert g.document("All is well. Not a thing said.")[0] == 0


def test_isolated_words_do_not_score():
    g = toxicity.Grammar({"vequ-": 3.0})
    for text in ("vequma", "Vequma!", "I kill time here.", "quite vequma\nyou", "kill"):
        assert g.document(text)[:3] == (0.0, 0.0, 0), text
    assert g.document("I will kill you.")[0] > 0 and g.document("The vequma left.")[0] > 0 and g.document("vequma vequmo")[0] > 0
    assert g.document("A vequma you are not.")[0] < g.document("A vequma you are.")[0]
    assert g.document("I will kill the time.")[0] == 0  # a threat needs a person


def test_composed_grammar_equals_its_patterns():
    """All clauses of up to five classes: the machine against the patterns searched for word by word."""
    from itertools import product

    words = {toxicity.OTHER: "xx", toxicity.INSULT: "vequma", toxicity.THREAT: "kill", toxicity.PERSON: "you", toxicity.REFERENCE: "the", toxicity.NEGATION: "not", toxicity.REPORT: "said"}
    g = toxicity.Grammar({"vequma": 2.0})

    def direct(clause):
        total = 0.0
        for i, kind in enumerate(clause):
            factors = {toxicity.INSULT: toxicity.INSULTED, toxicity.THREAT: toxicity.THREATENED}.get(kind)
            if factors is None:
                continue
            found = [factors[c][abs(i - j) > toxicity.NEAR] for j, c in enumerate(clause) if j != i and c in factors]
            f = max(found, default=0.0)
            if any(c == toxicity.NEGATION and abs(i - j) <= toxicity.NEGATION_REACH for j, c in enumerate(clause)):
                f *= toxicity.NEGATED
            if any(c == toxicity.REPORT and (j < i or j - i <= toxicity.REPORT_BEFORE) for j, c in enumerate(clause)):
                f *= toxicity.REPORTED
            total += f * (2.0 if kind == toxicity.INSULT else 3.0)
        return total

    rng = np.random.default_rng(3)
    clauses = [c for n in range(1, 6) for c in product(toxicity.ALPHABET, repeat=n)] + [tuple(rng.integers(0, 7, n)) for n in range(6, 40) for _ in range(40)]
    for clause in clauses:
        assert g.clause([words[c] for c in clause]) == pytest.approx(direct(clause)), clause


def test_toxicity_query_equals_row_by_row(spark, sf):
    d, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] for r in d.collect()}
    model = toxicity.fit(sorted((texts[i], y) for i, y in toxic.items() if i in texts and zlib.crc32(str(i).encode()) % 4 != 2))
    g = toxicity.Grammar(model["lexicon"])
    for r in registry.op3_toxicity(spark, sf).collect():
        want = 1 / (1 + np.exp(-(toxicity._inputs([g.document(texts[r["doc_id"]])]) @ model["curve"])[0]))
        assert r["score"] == pytest.approx(want) and r["predicted"] == (want >= 0.3)


def test_samples_keep_their_bounds(spark, monkeypatch):
    from ledgerloom.llm import common

    d = docs(spark, [f"text {i}" for i in range(30)])
    labels = spark.range(30).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    assert len(common.labelled_sample(d.unionByName(d).unionByName(d), labels, "toxic", 2)) == 2
    assert 0 < len(common.labelled_sample(d, labels, "toxic", 20, max_bytes=50)) <= 8


def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    s, t = rng.normal(size=(1, 4, 2)), rng.normal(size=(2, 2))
    p, pair = quality.marginals(s, t, np.array([4]))
    paths = np.array(np.meshgrid(*[[0, 1]] * 4)).reshape(4, -1).T
    w = np.exp([s[0, range(4), y].sum() + sum(t[a, b] for a, b in zip(y, y[1:])) for y in paths])
    w /= w.sum()
    assert np.allclose(p[0, :, 1], [(w * paths[:, i]).sum() for i in range(4)])
    assert np.allclose(pair[0, 1], sum(w[k] * sum((a, b) == (0, 1) for a, b in zip(y, y[1:])) for k, y in enumerate(paths)))


def test_surrogates(spark):
    text = "Mail anna.b@mail.example.com or +1 (017) 555-7713 from 10.20.30.40; card 4539578763621486, token = \"abc123def456\". Frau Meier and Frau Meier."
    d = docs(spark, [text, "clean text 12", text.replace("anna", "berta"), None])
    rows = {r["doc_id"]: r for r in pii.replace_entities(d, secret="s").collect()}
    out = rows[0]["text"]
    for secret in ("anna.b", "555-7713", "10.20.30.40", "4539578763621486", "abc123def456", "Meier"):
        assert secret not in out
    assert rows[0]["entities"] == 7 and rows[1]["text"] == "clean text 12" and rows[3]["text"] is None
    name = re.findall(r"Frau (\w+)", out)
    assert name[0] == name[1] and name[0][0].isupper()
    card = re.search(r"card (\d{16})", out).group(1)
    assert pii.luhn_digit(card[:-1]) == card[-1]
    a, b = (re.search(r"Mail (\S+)", rows[i]["text"]).group(1) for i in (0, 2))
    assert a != b and re.fullmatch(r"[a-z]{4}\.[a-z]@[a-z]{4}\.[a-z]{7}\.com", a)
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", out)


def test_surrogates_are_one_to_one():
    key = b"k"
    for kind, values in (("ip", [f"10.0.{i // 256}.{i % 256}" for i in range(3000)]), ("secret", [f"{i:06x}" for i in range(3000)]), ("card", [f"{i:016d}" for i in range(3000)])):
        assert len({pii.surrogate(kind, v, key) for v in values}) == len(values)


def test_surrogates_of_one_entity_agree(spark):
    texts = ["+1 (017) 555-7713 and +10175557713, Anna.B@Mail.example.com", "anna.b@mail.EXAMPLE.com or +1 017 555 7713", "Mr Smith, Dr Smith, MR X", "Frau Anna SMITH and Prof Anna Smith; PASSWORD: abcdef1", "4111 1111 1111 1111 or 4111111111111111; order 4111111111111112"]
    rows = [r["text"] for r in sorted(pii.replace_entities(docs(spark, texts), secret="s").collect(), key=lambda r: r["doc_id"])]
    digits = {re.sub(r"\D", "", m) for t in rows[:2] for m in re.findall(r"\+[\d ()-]+\d", t)}
    assert len(digits) == 1 and "5557713" not in digits.pop()
    mails = [m for t in rows[:2] for m in re.findall(r"\S+@\S+\.com", t)]
    assert mails[0].lower() == mails[1].lower() and mails[0][0].isupper() and "anna" not in mails[0].lower()
    names = re.findall(r"(?:Mr|Dr) (\w+)", rows[2]) + [m.title() for m in re.findall(r"\w+ (\w+)(?: and|;)", rows[3])]
    assert len(set(names)) == 1 and names[0] != "Smith" and "SMITH".isupper() and re.search(r"Anna|abcdef1", rows[3]) is None
    assert {n.lower() for n in re.findall(r"(?:Frau|Prof) (\w+)", rows[3])} <= set(pii.GIVEN[1])
    cards = re.findall(r"\d[\d ]{14,}\d", rows[4])
    assert cards[0].replace(" ", "") == cards[1] != "4111111111111111" and cards[2] == "4111111111111112"


def test_full_classes_of_names_stay_distinct(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [a.upper() + b for a in letters for b in letters]
    d = docs(spark, [f"Dr {n} came." for n in names])
    out = [re.search(r"Dr (\w+) came", r["text"]).group(1) for r in pii.replace_entities(d, secret="s").collect()]
    assert len(set(out)) == len(names) and not set(out) & set(names)


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_redrawn_surrogates_by_join_and_by_broadcast(spark, limit):
    """Both plans of the join that brings redrawn entities to their texts, and of the boilerplate lines to their pages."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        vowels = "aeiou"
        names = [a.upper() + b for a in vowels for b in vowels]
        got = sorted(r["text"] for r in pii.replace_entities(docs(spark, [f"Dr {n} came." for n in names]), secret="s").collect())
        cleaned = sorted(r["text"] for r in line_dedup.dedup_lines(docs(spark, [f"header\nown {i}" for i in range(30)]), ratio=0.5).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert len({re.search(r"Dr (\w+)", t).group(1) for t in got} | set(names)) == 50
    assert cleaned == sorted(f"own {i}" for i in range(30))


def test_line_dedup(spark):
    d = docs(spark, [f"header\nown {i}\n\nfooter {i % 3}" for i in range(30)] + ["header\nown 0\n\nfooter 0"] * 20)
    got = line_dedup.dedup_lines(d, ratio=0.5, min_pages=5).collect()
    assert all("header" not in r["text"] and "footer" in r["text"] and r["lines_dropped"] == 1 for r in got)


def test_mixing_meets_its_budgets(spark):
    rows = [(i, "t " * (1 + i % 5), None, "big" if i < 600 else f"s{i % 3}" if i < 690 else None, 0) for i in range(700)]
    d = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_sources(d, max_repeats=3.0).groupBy("source").agg(F.sum("mix_tokens").alias("t"), F.max("mix_epoch").alias("e")).collect()
    assert len(got) == 5 and max(r["e"] for r in got) <= 3
    total = sum(1 + i % 5 for i in range(700))
    assert abs(sum(r["t"] for r in got) - total) < 25
    p = np.array([r["t"] for r in got]) / total
    assert -(p * np.log(p)).sum() <= 0.96 * np.log(5) + 0.02


def test_mixing_of_null_and_repeated_keys(spark):
    rows = [(None, f"t u {i % 7}", "en", "s", 0) for i in range(400)] + [(5, "a b c", "en", "s", 0)] * 400 + [(5, "a b c", "en", "t", 1)] * 10
    d = spark.createDataFrame(rows, DOCS)
    total = 3 * len(rows)
    for budget in (1, 100, 1201, total + 700):
        got = mixing.mix_sources(d, budget_tokens=budget).groupBy("source").agg(F.sum("mix_tokens").alias("t"), F.count("*").alias("n")).collect()
        assert sum(r["t"] for r in got) in range(budget - 2, budget + 7), budget
    again = mixing.mix_sources(d, budget_tokens=1201)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, mixing.mix_sources(d, budget_tokens=1201).collect()), key=str)


def test_url_rules(spark):
    urls = [None, "nothing", "http://A.Example.COM/en/1?x", "https://www.example.com/en/2", "http://x.net/es/1#t", "http://x.net/de/1", "http://com?q", "http://notexample.com/en/3"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(5, True), (None, True)], "page_id long, bad boolean")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, labels).collect()}
    assert got[0] == ("", "", None, got[0][3]) and got[1][:3] == ("", "", None)
    assert got[2] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[3] == ("www.example.com", "/en/2", "www.example.com/en/", "allow")
    assert got[4] == ("x.net", "/es/1", "net/es/", "block")
    assert got[6][:3] == ("com", "", None)
    assert got[7] == ("notexample.com", "/en/3", "com/", "allow")


def test_url_templates_reject_bad_branches(spark):
    pages = [(i, f"http://h.org/{'shop' if i % 2 else 'news'}/{i}.html") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2 == 1) for i in range(0, 400, 3)], "page_id long, bad boolean")
    got = url_filter.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), labels).collect()
    assert all(r["verdict"] == ("block" if r["page_id"] % 2 else "allow") for r in got)
    assert {r["template"] for r in got} == {"/shop/*.html", "/news/*.html"}


def test_url_sections_of_wide_hosts_and_deep_paths_are_told_apart(spark):
    name = lambda k: "section" + chr(97 + k // 26) + chr(97 + k % 26)
    wide = [(i, f"http://h.org/{name(i % 60)}/{i}.html", i % 60 == 7) for i in range(1800)]  # each section under 2%
    deep = [(i, f"http://d.org/a/b/c/d/{'shop' if i % 2 else 'news'}/{i}.html", i % 2 == 1) for i in range(2000, 2200)]
    pages = spark.createDataFrame(wide + deep, "page_id long, url string, bad boolean")
    got = url_filter.filter_urls(pages, pages.select("page_id", "bad").filter("page_id % 7 < 4")).collect()
    bad = {i for i, _, b in wide + deep if b}
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == bad


def brute_templates(counts, min_children=20, min_share=0.02, z=1.96, strength=4.0, threshold=0.5):
    """{(host, raw): (n, good, bad)} -> {(host, raw): (template, rejected)}, level by level over dictionaries."""
    node = dict.fromkeys(counts, "")
    for depth in range(1, 1 + max((len(raw) for _, raw in counts), default=0)):
        groups = {}
        for (host, raw), c in counts.items():
            level = raw[depth - 1] if len(raw) >= depth else None
            child = groups.setdefault((host, node[host, raw]), {}).setdefault(level, [0, 0, 0])
            child[:] = [a + b for a, b in zip(child, c)]
        step = {}
        for parent, children in groups.items():
            n, good, bad = (sum(c[i] for c in children.values()) for i in range(3))
            width = sum(level is not None for level in children)
            for level, (cn, cg, cb) in children.items():
                mine, rest = cg + cb, good + bad - cg - cb
                rate = (bad + 0.5) / (good + bad + 1)
                gap = cb / max(mine, 1) - (bad - cb) / max(rest, 1)
                alike = width > 1 and (mine == 0 or rest == 0 or abs(gap) < z * (rate * (1 - rate) * (1 / max(mine, 1) + 1 / max(rest, 1))) ** 0.5)
                rare = width > min_children and cn < min_share * n and mine < url_filter.FEW_LABELS
                step[parent, level] = "" if level is None else "/*" if alike or rare else f"/{level}"
        node = {(h, raw): at + step[(h, at), raw[depth - 1] if len(raw) >= depth else None] for (h, raw), at in node.items()}
    good, bad = (sum(c[i] for c in counts.values()) for i in (1, 2))
    prior, leaves = (bad + 1) / (good + bad + 2), {}
    for (host, raw), (_, g, b) in counts.items():
        leaf = leaves.setdefault((host, node[host, raw]), [0, 0])
        leaf[0] += g
        leaf[1] += b
    rejected = {k: (b + strength * prior) / (g + b + strength) > threshold for k, (g, b) in leaves.items()}
    return {k: (t, rejected[k[0], t]) for k, t in node.items()}


def test_url_tree_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(3000):
        host = ["a.org", "b.org", "c.org"][min(2, int(rng.integers(0, 6)) // 2)]
        depth = int(rng.integers(0, 8))
        segments = [str(rng.choice(["news", "shop", "blog", "faq", "p7", f"s{chr(97 + int(rng.integers(0, 26)))}{chr(97 + int(rng.integers(0, 3)))}"])) for _ in range(depth)]
        bad = bool(rng.random() < (0.9 if "shop" in segments[:3] else 0.1)) if rng.random() < 0.6 else None
        rows.append((i, f"http://{host}" + "".join("/" + s for s in segments), bad))
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    got = {r["page_id"]: (r["template"], r["verdict"]) for r in url_filter.filter_urls(pages, pages.select("page_id", "bad").filter("bad is not null")).collect()}
    raws = {r["page_id"]: tuple(r["raw"]) for r in pages.select("page_id", url_filter.raw_template(url_filter.host_and_path(F.col("url"))[1]).alias("raw")).collect()}
    counts = {}
    for i, url, bad in rows:
        c = counts.setdefault((url.split("/")[2], raws[i]), [0, 0, 0])
        c[:] = [c[0] + 1, c[1] + (bad is False), c[2] + (bad is True)]
    want = brute_templates(counts)
    for i, url, _ in rows:
        template, rejected = want[url.split("/")[2], raws[i]]
        assert got[i] == (template, "block" if rejected else "allow"), url
    assert {v for _, v in got.values()} == {"block", "allow"}


def test_url_chains_and_traps_take_few_rounds(spark, monkeypatch):
    """500 shared levels and three pages; a trap with a page on each of 300 levels; both as brute force has them, in a few rounds."""
    deep = "/".join(f"f{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(500))
    urls = [f"http://x.org/{deep}", f"http://x.org/{deep}/a", f"http://x.org/{deep}/b"]
    urls += ["http://trap.org/" + "/".join(["calendar"] + ["next"] * i) for i in range(300)] + ["http://trap.org/calendar/next/next/other/end"]
    urls += ["http://short.org", "http://short.org/", "http://short.org//x", "http://short.org/a/", "http://short.org/a"]
    rows = [(i, u, [None, True, False][i % 3]) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    rounds, step = [], url_filter._step
    monkeypatch.setattr(url_filter, "_step", lambda *a: rounds.append(1) or step(*a))
    begin = time.time()
    got = {r["page_id"]: r["template"] for r in url_filter.filter_urls(pages, pages.select("page_id", "bad").filter("bad is not null")).collect()}
    assert time.time() - begin < 60 and len(rounds) <= 4
    raws = {r["page_id"]: (r["h"], tuple(r["raw"])) for r in pages.select("page_id", url_filter.host_and_path(F.col("url"))[0].alias("h"), url_filter.raw_template(url_filter.host_and_path(F.col("url"))[1]).alias("raw")).collect()}
    counts = {}
    for i, _, bad in rows:
        c = counts.setdefault(raws[i], [0, 0, 0])
        c[:] = [c[0] + 1, c[1] + (bad is False), c[2] + (bad is True)]
    want = brute_templates(counts)
    assert got == {i: want[raws[i]][0] for i in got}


def test_pages_get_the_labels_of_their_text(spark):
    d = docs(spark, ["bad line one\nbad line  two\nshared", "good line\nshared\nother & more", None, "unlabelled line"])
    marks = spark.createDataFrame([(0, True), (1, False), (2, True), (7, True)], "doc_id long, bad boolean")
    html = [
        "<html><head><title>good line</title></head><body><p>bad <b>line</b> one</p><div>bad line two</div></body></html>",
        "<p>good line<br>other &amp; more<p>shared", "<p>unlabelled line</p><p>shared</p>", None, "<script>bad line one</script><p>nothing known</p>",
    ]
    pages = spark.createDataFrame([(i, h) for i, h in enumerate(html)] + [(None, html[0])], "page_id long, html string")
    assert {r["page_id"]: r["bad"] for r in url_filter.label_pages(pages, d, marks).collect()} == {0: True, 1: False}


def _all_texts(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_quality_query_equals_enumerated_paths(spark, sf):
    """Scores of short documents from all labellings of their lines."""
    from itertools import product

    texts = _all_texts(spark, sf)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    model = quality.train(sorted((texts[i], y) for i, y in labels.items() if i in texts and zlib.crc32(str(i).encode()) % 4 != 2))
    got, seen = {r["doc_id"]: r for r in registry.op5_quality(spark, sf).collect()}, 0
    assert set(got) == set(texts)
    for i, text in texts.items():
        x, size = quality.line_features(text)
        if len(x) > 8:
            continue
        s = quality.with_neighbours(x) @ model["w"]
        paths = list(product((0, 1), repeat=len(x)))
        w = np.exp([sum(s[k, y] for k, y in enumerate(p)) + sum(model["trans"][a, b] for a, b in zip(p, p[1:])) for p in paths])
        good = [sum(v for v, p in zip(w, paths) if p[k]) / w.sum() for k in range(len(x))]
        q = sum(g * (n + 1) for g, n in zip(good, size)) / sum(n + 1 for n in size)
        want = 1 / (1 + np.exp(-(model["a"] * q + model["b"])))
        assert got[i]["score"] == pytest.approx(want, abs=1e-4) and got[i]["predicted"] == (got[i]["score"] >= 0.7)
        seen += 1
    assert seen > 20


def test_language_network_equals_direct_convolution():
    rng = np.random.default_rng(12)
    net = language.train(rng.integers(0, 256, (16, language.WINDOW)).astype(np.uint8), rng.integers(0, 3, 16), 3, epochs=1)
    x = rng.integers(0, 256, (3, language.WINDOW)).astype(np.uint8)
    got = language.window_scores(net, x)
    for row, scores in zip(x, got):
        e, pooled = net["embed"][row], []
        for k, width in zip(net["conv"], language.WIDTHS):
            # every filter is laid on at the same places: where the widest one fits
            places = [e[at : at + width] for at in range(language.WINDOW - max(language.WIDTHS) + 1)]
            pooled += [max((p * k[:, :, f]).sum() for p in places) for f in range(language.FILTERS)]
        z = np.maximum(np.array(pooled) + net["bias"], 0) @ net["out"] + net["out_bias"]
        assert np.allclose(scores, z - np.log(np.exp(z - z.max()).sum()) - z.max(), atol=1e-4)


def test_language_query_equals_row_by_row(spark, sf):
    texts = _all_texts(spark, sf)
    model = language.fit_language(spark.read.parquet(f"{sf}/documents.parquet"))
    for r in registry.op7_language(spark, sf).collect():
        (lang,), (score,) = language.predict(model, [texts[r["doc_id"]]])
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-4)


def test_every_language_is_learned_and_numerals_are_no_letters(spark):
    rows = [(i, f"{chr(0x4E00 + i)}{chr(0x4E01 + i)} " * 60, f"l{i:03}") for i in range(250)] + [(1000, "½ ² 12 Ⅷ", "l000")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    windows = language.sampled_windows(d, "doc_id", 100, 2).collect()
    held = {f"l{i:03}" for i in range(250) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {r["lang"] for r in windows} == {f"l{i:03}" for i in range(250)} - held
    assert language.predict({"langs": ["x"], "net": None}, ["½ ² 12 Ⅷ", None])[0] == ["und", "und"]


def test_surrogate_query_equals_row_by_row(spark, sf):
    texts = _all_texts(spark, sf)
    found = {(k, v) for t in texts.values() for _, _, k, v in pii.entities(t)}
    key, attempt = b"demonstration", dict.fromkeys(found, 0)
    while True:
        drawn = {e: (e[0], pii.surrogate(*e, key, n)) for e, n in attempt.items()}
        first = {}
        for e in sorted(drawn, key=lambda e: e[1]):
            first.setdefault(drawn[e], e)
        lost = [e for e, s in drawn.items() if s in found or first[s] != e]
        if not lost:
            break
        for e in lost:
            attempt[e] += 1
    assert found and len(set(drawn.values())) == len(found)
    for r in registry.op8_pii(spark, sf).collect():
        text, out, at = texts[r["doc_id"]], "", 0
        mentions = pii.entities(text)
        for start, end, kind, value in mentions:
            out += text[at:start] + pii.rendered(kind, drawn[kind, value][1], text[start:end])
            at = end
        assert r["text"] == (out + text[at:] if mentions else text) and r["entities"] == len(mentions)


def test_binomial_tails_are_whole():
    exact = lambda k, n, p: math.log(sum(Fraction(math.comb(n, i)) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k, n + 1)))
    for n, p in ((8, 0.5), (60, 0.25), (300, 0.5)):
        for k in range(n + 1):
            assert toxicity._tail(k, n, p) == pytest.approx(exact(k, n, p), rel=1e-6, abs=1e-12)
    assert toxicity._tail(3500, 8000, 0.5) > -1e-9 and toxicity._tail(4500, 8000, 0.5) == pytest.approx(-65.4, abs=1)


def test_everyday_words_of_clean_texts_are_no_insults():
    sample = [(f"w{i} common", 1) for i in range(3500)] + [(f"v{i}", 1) for i in range(500)] + [(f"u{i} common", 0) for i in range(4000)]
    assert "common" not in toxicity.learn(sample)


def test_clauses_are_read_whole():
    """A target far from its insult, and a clause of very many words."""
    g = toxicity.Grammar({})
    assert g.document("idiot " + "word " * 60 + "you")[2] == 1
    assert g.document("word " * 200_000 + "idiot")[2] == 0 and g.document("you " + "word " * 200_000 + "idiot")[2] == 1


def test_a_text_beyond_the_bytes_is_passed_over(spark):
    """Whatever comes first in hash order, the texts that fit are taken."""
    for big in range(6):
        d = docs(spark, ["x" * 5000 if i == big else f"text {i}" for i in range(6)])
        labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(6)], "doc_id long, quality int, toxic int")
        sample = common.labelled_sample(d, labels, "quality", 100, max_bytes=1000)
        known = [i for i in range(6) if zlib.crc32(str(i).encode()) % 4 != 2 and i != big]
        assert sample == sorted((f"text {i}", i % 2) for i in known)


def test_hot_buckets_are_held_together_without_comparison(monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 20)
    monkeypatch.setattr(simhash, "forest", None)
    n, tables = 50, simhash.Tables(2, 18, 0.8)
    pairs = simhash.bucket_links(tables, np.zeros(n, np.int64), np.arange(n)[::-1].copy(), np.random.default_rng(0).integers(0, 1 << 62, (n, 4)).astype(np.uint64), np.zeros(n, np.uint16))
    assert sorted(map(tuple, pairs.tolist())) == [(0, i) for i in range(1, n)]


def found_in(text):
    return [(text[a:b], kind) for a, b, kind, _ in pii.entities(text)]


def test_persons_are_known_throughout_their_text():
    text = "Mr John Smith called. Smith said John Smith is fine; johnson and smith are not. DR. HOUSE met Ms. O'Brien and Frau Müller-Lüdenscheidt. O'Brien left, House stayed, Müller-Lüdenscheidt too."
    assert found_in(text) == [
        ("John", "given"), ("Smith", "surname"), ("Smith", "surname"), ("John", "given"), ("Smith", "surname"), ("HOUSE", "surname"), ("O'Brien", "surname"),
        ("Müller-Lüdenscheidt", "surname"), ("O'Brien", "surname"), ("House", "surname"), ("Müller-Lüdenscheidt", "surname"),
    ]
    assert found_in("Smith and John went out.") == []


def test_numbers_in_their_local_forms():
    for mention, kind in {
        "555-123-4567": "phone", "(212) 555-0199": "phone", "0049 30 123456": "phone", "+49 30 123456": "phone", "3782 822463 10005": "card", "4111 1111 1111 1111": "card",
        "2001:db8::1": "ip6", "fe80:0:0:0:1:2:3:4": "ip6", "::1": "ip6", "DE89 3704 0044 0532 0130 00": "iban", "GB82WEST12345698765432": "iban",
    }.items():
        assert found_in(f"It is {mention}, they say.") == [(mention, kind)]
    for clean in ("at 10:20:30", "std::vector", "DE00 3704 0044 0532 0130 00", "3782 822463 10006", "1-2-3", "2024-01-02 10:11", "a::b", "abc::def", "pages 100-200", "key::value"):
        assert found_in(f"It is {clean}, they say.") == []


def brute_persons(text):
    """Titles and names by splitting words, with no pattern of the operator."""
    words, titles = text.replace(".", " ").replace(",", " ").replace("\n", " ").split(" "), set(pii.TITLES) | {t.upper() for t in pii.TITLES}
    words = [w for w in words if w]
    names = set()
    for i, w in enumerate(words):
        if w in titles:
            run = [x for x in words[i + 1 : i + 3]]
            if run and run[0][:1].isupper() and len(run[0]) > 1:
                names.add(run[0])
                if len(run) > 1 and run[1][:1].isupper() and len(run[1]) > 1:
                    names.add(run[1])
    return names


def test_surrogates_leave_no_named_person(spark):
    """The same person everywhere, in the case of each mention, and the class of each kind of number."""
    pick = np.random.default_rng(4)
    people = [("Mr", "John", "Smith"), ("Frau", "Anna", "Müller-Lüdenscheidt"), ("Ms", "Mary", "O'Brien"), ("DR", "GREGORY", "HOUSE")]
    texts = []
    for _ in range(40):
        title, given, last = people[int(pick.integers(0, 4))]
        texts.append(f"{title} {given} {last} wrote. {last} and {given} left, said {given} {last}, in the street.")
    texts += ["call 0049 30 123456 or +49 30 123456", "DE89 3704 0044 0532 0130 00 and DE89370400440532013000", "2001:db8::1 2001:0db8::0001"]
    got = [r["text"] for r in pii.replace_entities(docs(spark, texts), secret="s").orderBy("doc_id").collect()]
    for before, after in zip(texts[:40], got):
        names = brute_persons(before)
        assert names and not names & set(after.replace(",", " ").replace(".", " ").split(" "))
        title, given, last = after.split(" ")[:3]
        assert after == f"{title} {given} {last} wrote. {last} and {given} left, said {given} {last}, in the street."
    a, b = got[40].split(" or ")
    assert a.removeprefix("call 00") == b.removeprefix("+") and a[:7] == "call 00" and texts[40] != got[40]
    a, b = got[41].split(" and ")
    assert a.replace(" ", "") == b and pii.iban_check(b) == 1 and b[:2] == "DE" and b != "DE89370400440532013000"
    a, b = got[42].split(" ")
    assert a == b != "2001:db8::1" and a.count(":") == 3


def test_number_surrogates_are_one_to_one():
    key = b"k"
    for kind, values in {"ip6": [f"2001:db8::{i:x}" for i in range(1, 200)], "iban": [f"DE{98 - pii.iban_check(f'DE00{i:018d}'):02d}{i:018d}" for i in range(300)]}.items():
        made = {pii.surrogate(kind, v, key) for v in values}
        assert len(made) == len(values) and not made & set(values)
        assert all(pii._holds(kind, m) for m in made if any(c.isdigit() for c in m))

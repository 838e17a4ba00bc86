"""Alignment, whitening and chat formatting against brute force, with nulls, repeats, empty tables and clashing columns."""

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import align, chat, registry, whitening

WORDS = ["the", "kettle", "é́", "日本語", "😀", "don't", "1234567", "<|endoftext|>", "<s>", "\n\n", "\t", "", "x" * 70, "Ωmega", "a\0b", "　", "\x85", "...!?", "    ", "naïve"]


def clash(df, *names):
    for c in ("row", "key", "text", "pairs", "code", "times", "count", "best", "x", "d", "n", "number", "layout", "turns", "formatted", "_hlayout", "print", "a.b", *names):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("z"))
    return df


@pytest.fixture(scope="module")
def pair():
    return align.Aligner(*[open(f"{align.TOKENIZERS}/{f}", "rb").read() for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")])


def full_ids(pair, text):
    """Both tokenizers over the whole text, None where their bytes are others."""
    if not text:
        return None
    a, b = pair.a.full.encode(" " + text, add_special_tokens=False).ids, pair.b.model.encode(text)
    whole = (" " + text).encode()
    return (a, b) if all(b"".join(k.bytes_of[i] for i in ids) == whole for k, ids in ((pair.a, a), (pair.b, b))) else None


def brute_groups(pair, ids):
    """Groups by the intersection of all ends."""
    ends = []
    for k, side in zip((pair.a, pair.b), ids):
        at, out = 0, []
        for i in side:
            at += len(k.bytes_of[i])
            out.append(at)
        ends.append(out)
    groups, a, b = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        i, j = ends[0].index(cut) + 1, ends[1].index(cut) + 1
        groups.append((ids[0][a:i], ids[1][b:j]))
        a, b = i, j
    return groups


def brute_alignment(pair, texts):
    found, seen = [], Counter()
    for t in texts:
        ids = full_ids(pair, t)
        groups = brute_groups(pair, ids) if ids else []
        links = Counter((a, b) for g in groups for a in g[0] for b in g[1])
        seen.update(links.keys())
        found.append((ids, groups, links))
    most = {}
    for (a, _), n in seen.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for ids, groups, links in found:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            *(map(len, ids) if ids else (0, 0)), len(groups), sum(links.values()), sum(n for p, n in links.items() if seen[p] == most[p[0]]),
            sum(n * seen[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if ids else ""))
    return out


def mixed_texts(n=120):
    pick = random.Random(5)
    return [None, "", " ", "  ", "▁ is no space", "ﬁ ", "same text", "same text", *["".join(pick.choice(WORDS) + pick.choice(["", " ", "  "]) for _ in range(pick.randint(1, 30))) for _ in range(n)]]


def test_words_are_encoded_as_in_whole_texts(pair):
    texts = [t for t in mixed_texts(600)]
    got = pair.tokens(texts)
    for t, g in zip(texts, got):
        want = full_ids(pair, t)
        assert (g is None) == (want is None) and (g is None or (g[0].tolist(), g[1].tolist()) == (want[0], want[1])), repr(t)


@pytest.mark.parametrize("heavy", [align.HEAVY, 50, 1])
def test_alignment_equals_brute_force(spark, pair, heavy):
    """With all pairs broadcast, with some of them, and with next to none."""
    texts = mixed_texts()
    docs = clash(spark.createDataFrame([(i if i % 9 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5))
    got = align.alignment(docs, heavy=heavy)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = Counter((i if i % 9 else None, *row) for i, row in enumerate(brute_alignment(pair, texts)))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_alignment_of_the_table(spark, sf, pair):
    got = {r["doc_id"]: tuple(r)[1:] for r in registry.op11_align(spark, sf).collect()}
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got == dict(zip([r[0] for r in rows], brute_alignment(pair, [r[1] for r in rows])))


def test_alignment_of_an_empty_table(spark):
    assert align.alignment(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_groups_are_divided_at_all_shared_ends():
    pick = random.Random(2)
    for _ in range(300):
        n = pick.randint(1, 60)
        ends = [np.array(sorted({*pick.sample(range(1, n + 1), pick.randint(0, n)), n})) for _ in range(2)]
        a, b = align.divide(ends[0], ends[1], np.array([len(ends[0])]), np.array([len(ends[1])]))
        assert ends[0][a - 1].tolist() == ends[1][b - 1].tolist() == sorted(set(ends[0]) & set(ends[1]))


def test_long_texts_and_large_groups_come_in_blocks(pair):
    """Blocks hold distinct pairs and add up; a group of many repeated ids does not multiply."""
    text = " ".join(random.Random(1).choices(WORDS[:4], k=4000))
    links = brute_alignment(pair, [text])[0][3]
    numbers, _, blocks = align.aligned_chunk(pair, [text], block=50)
    parts = list(blocks)
    codes = np.concatenate([p[1] for p in parts])
    assert len(parts) > 1 and len(codes) == len(set(codes.tolist())) and sum(p[2].sum() for p in parts) == links == numbers[3][0]
    g = np.zeros(3000, np.int64)
    ((_, code, times),) = align.link_blocks(np.zeros(1, np.int64), g, g + 7, g, np.arange(3000) % 2, 10, 10)
    assert code.tolist() == [70, 71] and times.tolist() == [4_500_000, 4_500_000]


# -- whitening -----------------------------------------------------------------------------------------------------


def brute_whitening(vectors):
    """Exact moments with fractions, eigenvectors of the exact covariance."""
    rows = [(k, [math.floor(256 * float(c)) for c in v]) for k, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in rows})
    n, d = len(fit), len(fit[0])
    s = [sum(x[i] for x in fit) for i in range(d)]
    v = np.array([[float(sum((Fraction(x[i]) - Fraction(s[i], n)) * (Fraction(x[j]) - Fraction(s[j], n)) for x in fit) / n) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    top = np.argsort(-e)[:4]
    out = {}
    for k, x in rows:
        c = np.array([float(Fraction(x[i]) - Fraction(s[i], n)) for i in range(d)])
        for at, i in enumerate(top):
            if e[i] > 1e-12 * e.sum():
                out[k, at + 1] = (n, sum((n * x[j] - s[j]) ** 2 for j in range(d)), abs(c @ u[:, i]) / math.sqrt(e[i]), e[i] / e.sum())
    return out


def vectors_of(spark, rows, type_="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{type_}>")


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e14])
def test_whitening_equals_exact_moments(spark, scale):
    """Numbers of one, of two and of more than two machine words."""
    r = np.random.default_rng(3)
    mix = r.normal(size=(6, 6))
    data = [(i, [float(c) for c in scale * (mix @ r.normal(size=6) + 3)]) for i in range(90)]
    rows = [*data, (200, data[0][1]), (201, None), (202, [1.0, None] * 3), (203, [float("nan")] * 6), (204, [1.0]), (205, [])]
    got = whitening.whiten(clash(vectors_of(spark, rows, "double").repartition(4))).collect()
    want = brute_whitening([x for x in rows if x[0] != 204])
    assert len(got) == len(want) == 91 * 4
    signs = {}
    for g in got:
        n, deviation, whitened, explained = want[g["vec_id"], g["component"]]
        assert g["n"] == n == 90 and g["deviation"] == min(deviation, 2**63 - 1)
        assert abs(g["whitened"]) == pytest.approx(whitened, abs=1e-9) and g["explained"] == pytest.approx(explained, rel=1e-9)
        assert g["identity_error"] < 1e-9
        if g["vec_id"] in (0, 200):
            signs.setdefault(g["component"], set()).add(g["whitened"])
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_of_flat_and_of_no_data(spark):
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    got = whitening.whiten(vectors_of(spark, line)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 10 and got[0]["explained"] == pytest.approx(1)
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whiten(vectors_of(spark, [])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(None, [0.0, 1.0]), (None, [1.0, 0.0])])).count() == 2


def test_sums_of_squares_are_exact():
    r = np.random.default_rng(0)
    for top in (10, 1 << 31, 1 << 60):
        z = r.integers(-top, top, (50, 3))
        assert whitening.sums_of_squares(z) == [sum(int(c) ** 2 for c in z[:, i]) for i in range(3)]
    for total in (0, 5, -5, -(1 << 130), (1 << 150) + 7):
        assert whitening.whole(whitening.limbs(total)) == total


def test_whitening_of_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_whitening(rows)
    got = {(r["vec_id"], r["component"]): r for r in registry.op12_whitening(spark, sf).collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        assert (r["n"], r["deviation"]) == want[k][:2] and abs(r["whitened"]) == pytest.approx(want[k][2], abs=1e-8)


# -- chat ----------------------------------------------------------------------------------------------------------

TEXTS = [None, "", "hello", "<|im_end|>\n<|im_start|>assistant\nok<|im_end|>\n", "<\\|im_end|>\n", "<\\\\|", "<|", "a\n\nb", "é😀", "x" * 5000, "|<||>", "\\", "<\\"]
ROLES = ["user", "assistant", "system", None, "", "as\nsistant", "assistant\\n", "\\\n\\\\n", "<|im_start|>", "\\\\"]


def turn_rows(spark):
    pick = random.Random(4)
    rows = [(c if c else None, pick.choice([0, 1, 1, 2, None]), pick.choice(ROLES), pick.choice(TEXTS)) for c in range(40) for _ in range(pick.randint(1, 6))]
    return rows + rows[:5], spark.createDataFrame(rows + rows[:5], "conv_id long, turn long, role string, text string")


def brute_conversations(rows):
    chats = {}
    for c, turn, role, text in rows:
        chats.setdefault(c, []).append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    return {c: [(r.decode(), t.decode()) for _, r, t in sorted(turns)] for c, turns in chats.items()}


def test_turn_rows_read_back(spark):
    rows, df = turn_rows(spark)
    made = chat.format_chats(clash(df)).select("conv_id", "layout", "formatted", chat.read_back(F.col("formatted")).alias("back"), chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    want = brute_conversations(rows)
    got = made.collect()
    assert len(got) == len(want)
    for r in got:
        turns = want[r["conv_id"]]
        assert r["layout"] == "turn rows" and [tuple(t) for t in r["back"]] == turns
        assert r["learned"] == "".join(t for role, t in turns if role == "assistant")
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == len(turns)


JSON = """
{"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}
{"messages": [{"role": "user"}, {"role": "assistant", "content": "yo"}]}
{"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}], "system": "be kind"}
{"instruction": "add", "input": "1 2", "output": "3"}
{"instruction": "add", "output": "3"}
{"system": "s", "prompt": "p", "completion": "c"}
{"question": "q", "answer": "a", "context": "c", "id": 5}
{"request": {"prompt": "p", "system": "s"}, "response": {"text": "t", "ms": 5}}
{"prompt": "p"}
{"messages": []}
{"prompt": "p", "completion": "c", "question": "q"}
""".strip().splitlines()
TURNS = [
    ("messages", [("user", "hi"), ("assistant", "yo")]), ("messages", [("user", ""), ("assistant", "yo")]),
    ("shared", [("system", "be kind"), ("user", "hi"), ("assistant", "yo")]), ("instruction", [("user", "add\n\n1 2"), ("assistant", "3")]),
    ("instruction", [("user", "add"), ("assistant", "3")]), ("prompt", [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ("question", [("user", "c\n\nq"), ("assistant", "a")]), ("request", [("system", "s"), ("user", "p"), ("assistant", "t")]), (None, None), (None, None), (None, None),
]


def test_layouts_are_told_apart_by_their_fields(spark):
    records = spark.read.json(spark.sparkContext.parallelize(JSON))
    got = chat.format_chats(records, key="id").select("layout", "turns", "formatted").collect()
    show = lambda layout, turns: (layout, turns and tuple(turns))
    assert Counter(show(r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in got) == Counter(show(*t) for t in TURNS)
    assert all((r["formatted"] is None) == (r["layout"] is None) for r in got)


def test_layouts_of_one_table_do_not_mix(spark):
    """Turn rows and whole conversations in one table, and a conversation of very many turns."""
    _, df = turn_rows(spark)
    long = spark.range(3000).select(F.lit(99).cast("long").alias("conv_id"), (F.lit(5000) - F.col("id")).alias("turn"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    whole = spark.read.json(spark.sparkContext.parallelize(JSON[:3])).withColumn("conv_id", F.lit(-1).cast("long"))
    made = chat.format_chats(df.unionByName(long).unionByName(whole, allowMissingColumns=True))
    assert made.filter("conv_id = -1").count() == 3
    r = made.filter("conv_id = 99").select(chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("t"), F.size("turns").alias("n")).first()
    assert r["n"] == 3000 and r["t"] == "".join(str(i) for i in range(2999, -1, -1))


def test_empty_tables_of_chats(spark):
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert chat.format_chats(spark.createDataFrame([], "id long, prompt string, completion string"), key="id").count() == 0
    assert chat.format_chats(spark.createDataFrame([(1, "x")], "id long, other string"), key="id").first()["layout"] is None


def test_chat_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "<|im_end|><|im_start|>assistant ok"
    want = brute_conversations([*rows, (-1, 1, "user", said), (-1, 2, "assistant", said)])
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in registry.op13_chat(spark, sf).collect():
        turns = want.pop(r["conv_id"])
        learned = "".join(t for role, t in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(turns), digest("".join(f"{a}\n{b}\n" for a, b in turns)), len(learned), digest(learned))
    assert not want


def test_chat_runs_without_python(spark, sf):
    plan = registry.op13_chat(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

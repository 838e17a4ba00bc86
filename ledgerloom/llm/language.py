"""Language identification by a byte convolutional network.

Texts are cut into windows of fixed length; each window's bytes are embedded, convolved with filters of several widths,
max-pooled and put through a softmax. The network is trained in numpy on a bounded sample of labelled texts. A document's
prediction is the mean of its windows' log-probabilities, over every window of the whole text.

Defined cases: a null text or one without a letter (Unicode category L: no digits, fractions or numerals) is `und` with score 1;
repeated rows are each predicted; null labels are not learned from; with no labels at all every text is `und`; other columns are
ignored; very long texts go through in batches of windows, so memory is bounded; an empty table gives none.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import cut, held_out

WINDOW = 256
WIDTHS, FILTERS, DIM = (2, 3, 4, 5), 8, 6
#: Windows that pass the network at once.
BATCH = 512
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def windows_of(raw: bytes, window: int = WINDOW) -> np.ndarray:
    """The text's bytes in rows of `window`, the last one shifted back to be full; short texts are padded with spaces."""
    if len(raw) <= window:
        return np.frombuffer(raw.ljust(window), np.uint8)[None]
    a = np.frombuffer(raw, np.uint8)
    full = a[: len(a) // window * window].reshape(-1, window)
    return full if len(a) % window == 0 else np.concatenate([full, a[None, -window:]])


def _kernel(net: dict) -> np.ndarray:
    """All filters as one matrix over the widest span (shorter ones padded with zeros)."""
    span = max(WIDTHS)
    k = np.zeros((span, DIM, len(WIDTHS) * FILTERS), np.float32)
    for i, w in enumerate(WIDTHS):
        k[:w, :, i * FILTERS : (i + 1) * FILTERS] = net["conv"][i]
    return k.reshape(span * DIM, -1)


def _spans(net: dict, x: np.ndarray) -> np.ndarray:
    e = net["embed"][x]
    return np.lib.stride_tricks.sliding_window_view(e, max(WIDTHS), axis=1).transpose(0, 1, 3, 2).reshape(len(x), WINDOW - max(WIDTHS) + 1, -1)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def window_scores(net: dict, x: np.ndarray) -> np.ndarray:
    out = []
    for at in range(0, len(x), BATCH):
        s = _spans(net, x[at : at + BATCH])
        h = (s.reshape(-1, s.shape[2]) @ _kernel(net)).reshape(s.shape[0], s.shape[1], -1).max(axis=1)
        out.append(log_softmax(np.maximum(h + net["bias"], 0) @ net["out"] + net["out_bias"]))
    return np.concatenate(out)


def train(x: np.ndarray, y: np.ndarray, classes: int, *, epochs: int = 10, rate: float = 0.01, seed: int = 3) -> dict:
    """Adam on the cross entropy of single windows; the gradient of the max pooling goes to the span that won."""
    rng = np.random.default_rng(seed)
    f = len(WIDTHS) * FILTERS
    net = {
        "embed": rng.normal(0, 0.5, (256, DIM)).astype(np.float32),
        "conv": [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        "bias": np.zeros(f, np.float32),
        "out": rng.normal(0, 0.2, (f, classes)).astype(np.float32),
        "out_bias": np.zeros(classes, np.float32),
    }
    names = ["embed", "bias", "out", "out_bias"]
    params = [net[n] for n in names] + net["conv"]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step, span = 0, max(WIDTHS)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            xb, yb = x[part], y[part]
            s = _spans(net, xb)
            k = _kernel(net)
            h = (s.reshape(-1, s.shape[2]) @ k).reshape(len(xb), s.shape[1], f)
            won = h.argmax(axis=1)
            pooled = np.take_along_axis(h, won[:, None, :], 1)[:, 0] + net["bias"]
            act = np.maximum(pooled, 0)
            p = np.exp(log_softmax(act @ net["out"] + net["out_bias"]))
            p[np.arange(len(yb)), yb] -= 1
            p /= len(yb)
            g_act = (p @ net["out"].T) * (pooled > 0)
            spans = s[np.arange(len(xb))[:, None], won]  # batch, filter, span * dim
            g_k = np.einsum("bf,bfk->kf", g_act, spans).reshape(span, DIM, f)
            g_s = (g_act[:, :, None] * k.T[None]).reshape(len(xb), f, span, DIM)
            g_embed = np.zeros_like(net["embed"])
            for j in range(span):
                np.add.at(g_embed, xb[np.arange(len(xb))[:, None], won + j], g_s[:, :, j])
            grads = [g_embed, g_act.sum(axis=0), act.T @ p, p.sum(axis=0)]
            grads += [g_k[:w, :, i * FILTERS : (i + 1) * FILTERS] for i, w in enumerate(WIDTHS)]
            step += 1
            for a, g, (m, v) in zip(params, grads, state):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def sampled_windows(docs: DataFrame, key: str, bound: int, per_text: int) -> DataFrame:
    """(lang, turn, windows): up to `per_text` windows of each text of a sample, about bound / languages texts (one at least) of each
    language, by a hash of the key. A language none of whose sampled texts has a letter is left out."""
    marked = docs.select(F.col(key).alias("id"), "lang").filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    marked = marked.withColumn("turn", F.xxhash64("id"))
    sizes = cut(marked.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    share = max(1, bound // max(1, sizes.count()))
    # the least hashes of each language: most rows are left out by their hash alone before the rest is ranked
    few = F.col("turn") < F.lit(-(2.0**63)) + F.lit(2.0**64 * (4 * share + 100)) / F.col("n")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("turn", "id"))
    chosen = marked.join(sizes, "lang").filter(few).select("id", "lang", "turn").distinct().withColumn("rank", rank).filter(F.col("rank") <= share)
    texts = docs.select(F.col(key).alias("id"), "lang", "text").filter(F.col("text").isNotNull())
    texts = texts.join(F.broadcast(cut(chosen.select("id", "lang", "turn"))), ["id", "lang"]).select("lang", "turn", "text")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            made = []
            for lang, turn, text in zip(p["lang"], p["turn"], p["text"]):
                if has_letter(text):
                    raw = text.encode("utf-8", "replace")
                    w = windows_of(raw)
                    picked = np.random.default_rng(zlib.crc32(raw)).permutation(len(w))[:per_text]
                    made.append((lang, turn, w[np.sort(picked)].tobytes()))
            yield pd.DataFrame(made, columns=["lang", "turn", "windows"]) if made else pd.DataFrame({"lang": [], "turn": [], "windows": []}, dtype=object).astype({"turn": "int64"})

    found = texts.mapInPandas(run, "lang string, turn long, windows binary")
    # rows that share an id and a language count once: the least
    return found.groupBy("lang", "turn").agg(F.min("windows").alias("windows"))


def fit_language(docs: DataFrame, *, key: str = "doc_id", bound: int = 3000, per_text: int = 4, seed: int = 3) -> dict:
    """Trained on up to `per_text` windows of at most `bound` labelled whole texts (or one of each language, if those are more).

    The windows are cut on the executors: at most `per_text` * WINDOW bytes of a text reach the driver.
    """
    rows = sorted((r["lang"], r["turn"], bytes(r["windows"])) for r in sampled_windows(docs, key, bound, per_text).collect())
    langs = sorted({r[0] for r in rows})
    if not langs:
        return {"langs": []}
    number = {lang: i for i, lang in enumerate(langs)}
    xs = [np.frombuffer(w, np.uint8).reshape(-1, WINDOW) for _, _, w in rows]
    ys = np.repeat([number[lang] for lang, _, _ in rows], [len(x) for x in xs])
    return {"langs": langs, "net": train(np.concatenate(xs), ys, len(langs), seed=seed)}


def predict(model: dict, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    langs = model["langs"]
    pred, score = ["und"] * len(texts), np.ones(len(texts))
    if not langs:
        return pred, score
    total, count = np.zeros((len(texts), len(langs))), np.zeros(len(texts))
    held: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    n = 0

    def flush() -> None:
        nonlocal n
        if n:
            x, o = np.concatenate(held), np.concatenate(owner)
            np.add.at(total, o, window_scores(model["net"], x))
            held.clear(), owner.clear()
            n = 0

    live = [i for i, t in enumerate(texts) if t is not None and has_letter(t)]
    for i in live:
        w = windows_of(texts[i].encode("utf-8", "replace"))
        count[i] = len(w)
        for at in range(0, len(w), 4096):
            held.append(w[at : at + 4096])
            owner.append(np.full(len(held[-1]), i))
            n += len(held[-1])
            if n >= 4096:
                flush()
    flush()
    for i in live:
        p = np.exp(log_softmax((total[i] / count[i])[None]))[0]
        pred[i], score[i] = langs[int(p.argmax())], float(p.max())
    return pred, score


def identify(docs: DataFrame, model: dict, *, key: str = "doc_id") -> DataFrame:
    """One row per row of docs: key, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            lang, score = predict(shared.value, list(p["text"]))
            yield pd.DataFrame({key: p[key], "lang_pred": lang, "score": score})

    rows = docs.select(key, "text")
    out = rows.mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, lang_pred string, score double")
    return out.select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score")

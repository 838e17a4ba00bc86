"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of itself and of the lines before and after it. The field has the states bad and good; it is
fitted in numpy on a bounded sample of labelled documents (a document's label stands for all its lines, then the good
lines of bad documents are found by the field itself and it is fitted again). The forward-backward marginals of a
document's lines, weighted by their length, are its quality; a logistic curve fitted on the sample turns that into
a score.

Defined cases: null, empty and blank texts have one empty line and get the score of it; repeated rows are each scored;
null labels are not learned from; with no labels of both kinds every score is the label's mean, or 0.5; other columns
are ignored; a very long line or a text of very many lines costs memory in proportion to that text alone; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.llm.common import held_out, labelled_sample

MARKS = b"!#$%&*|"
#: Byte classes: mark, upper, digit, lower or other letter, space, sentence punctuation, other.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[:128] = 6
for _i, _chars in enumerate((MARKS, bytes(range(65, 91)), bytes(range(48, 58)), bytes(range(97, 123)), b" \t\r\x0b\x0c", b".,;:?'")):
    _CLASS[list(_chars)] = _i
N_LINE = 10


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x N_LINE features, lengths in bytes)."""
    raw = (text or "").encode("utf-8", "replace")
    lines = raw.split(b"\n")
    out = np.zeros((len(lines), N_LINE), np.float32)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    for i, line in enumerate(lines):
        n = len(line)
        if not n:
            out[i, 8] = 1
            continue
        share = np.bincount(_CLASS[np.frombuffer(line, np.uint8)], minlength=7) / n
        words = line.split()
        w = max(1, len(words))
        out[i, :4] = min(1.0, share[0] * 8), share[1], share[2], share[5] * 4
        out[i, 4] = 1 - len(set(words)) / w
        out[i, 5] = sum(map(bytes.__eq__, words[1:], words)) / w
        out[i, 6] = np.log1p(n) / 8
        out[i, 7] = min(2.0, n / w / 10)
    out[:, 9] = 1
    return out, sizes


def with_neighbours(x: np.ndarray) -> np.ndarray:
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    return np.concatenate([x, before, after], axis=1)


def _log_add(a: np.ndarray) -> np.ndarray:
    m = a.max(axis=-1)
    return m + np.log(np.exp(a - m[..., None]).sum(axis=-1))


def marginals(scores: np.ndarray, trans: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """scores (docs, lines, 2), padded -> P(state of each line), expected transition counts (2, 2)."""
    d, t, _ = scores.shape
    live = np.arange(t)[None, :] < lengths[:, None]
    f, b = np.zeros_like(scores), np.zeros_like(scores)
    f[:, 0] = scores[:, 0]
    for i in range(1, t):
        f[:, i] = np.where(live[:, i, None], scores[:, i] + _log_add(f[:, i - 1, None, :] + trans.T[None]), f[:, i - 1])
    for i in range(t - 2, -1, -1):
        b[:, i] = np.where(live[:, i + 1, None], _log_add(trans[None] + (scores[:, i + 1] + b[:, i + 1])[:, None, :]), 0)
    z = _log_add(f[:, -1])
    p = np.exp(f + b - z[:, None, None]) * live[..., None]
    pair = np.zeros((2, 2))
    if t > 1:
        q = f[:, :-1, :, None] + trans[None, None] + (scores[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]
        pair = (np.exp(np.minimum(q, 0)) * live[:, 1:, None, None]).sum(axis=(0, 1))
    return p, pair


def fit(features: list[np.ndarray], states: list[np.ndarray], rounds: int = 80, longest: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Weights (3 * N_LINE, 2) and transitions (2, 2), by Adam on the conditional likelihood. Long texts are cut into chains."""
    xs, ys = [], []
    for x, y in zip(features, states):
        for at in range(0, len(x), longest):
            xs.append(x[at : at + longest])
            ys.append(y[at : at + longest])
    order = np.argsort([len(x) for x in xs])
    batches = []
    for part in np.array_split(order, max(1, len(order) // 1500)):
        t = max(len(xs[i]) for i in part)
        x, y = np.zeros((len(part), t, xs[0].shape[1]), np.float32), np.zeros((len(part), t), int)
        n = np.array([len(xs[i]) for i in part])
        for j, i in enumerate(part):
            x[j, : n[j]], y[j, : n[j]] = xs[i], ys[i]
        batches.append((x, y, n))
    lines = sum(b[2].sum() for b in batches)
    w, trans = np.zeros((xs[0].shape[1], 2)), np.zeros((2, 2))
    state = [[np.zeros_like(a), np.zeros_like(a)] for a in (w, trans)]
    for step in range(1, rounds + 1):
        gw, gt = -1e-4 * w * lines, -1e-4 * trans * lines
        for x, y, n in batches:
            p, pair = marginals(x @ w, trans, n)
            live = np.arange(x.shape[1])[None, :] < n[:, None]
            gold = np.stack([1 - y, y], axis=-1) * live[..., None]
            gw += np.tensordot(x, gold - p, axes=([0, 1], [0, 1]))
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[:, :-1][live[:, 1:]], y[:, 1:][live[:, 1:]]), 1)
            gt += seen - pair
        for k, (a, g) in enumerate(((w, gw / lines), (trans, gt / lines))):
            m, v = state[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a += 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w, trans


def document_quality(x: np.ndarray, sizes: np.ndarray, w: np.ndarray, trans: np.ndarray) -> tuple[float, np.ndarray]:
    p = marginals((x @ w)[None], trans, np.array([len(x)]))[0][0, :, 1]
    weight = sizes + 1
    return float((p * weight).sum() / weight.sum()), p


def train(sample: list[tuple[str, int]]) -> dict:
    labels = [y for _, y in sample]
    if len(set(labels)) < 2:
        return {"flat": float(np.mean(labels)) if labels else 0.5}
    made = [line_features(t) for t, _ in sample]
    xs = [with_neighbours(x) for x, _ in made]
    ys = [np.full(len(x), y) for x, y in zip(xs, labels)]
    w, trans = fit(xs, ys)
    for i, y in enumerate(labels):  # the good lines inside bad documents
        if not y:
            p = document_quality(xs[i], made[i][1], w, trans)[1]
            if (p < 0.5).any():
                ys[i] = (p > 0.9).astype(int)
    w, trans = fit(xs, ys)
    q = np.array([document_quality(x, m[1], w, trans)[0] for x, m in zip(xs, made)])
    y = np.array(labels, float)
    a, b = 4.0, -2.0  # the score: a logistic curve over the quality
    for _ in range(400):
        s = 1 / (1 + np.exp(-(a * q + b)))
        h = s * (1 - s) + 1e-4
        g = np.array([((y - s) * q).mean() - 1e-4 * a, (y - s).mean()])
        m = np.array([[(h * q * q).mean() + 1e-4, (h * q).mean()], [(h * q).mean(), h.mean()]])
        step = np.linalg.solve(m, g)
        a, b = a + np.clip(step[0], -2, 2), b + np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return {"w": w, "trans": trans, "a": float(a), "b": float(b)}


def score(model: dict, texts: list[str | None]) -> np.ndarray:
    if "flat" in model:
        return np.full(len(texts), model["flat"])
    q = np.empty(len(texts))
    made = [line_features(t) for t in texts]
    order = np.argsort([len(x) for x, _ in made], kind="stable")
    at = 0
    while at < len(order):  # chains of like length together; a batch holds 40 000 lines or one document
        end = at + 1
        while end < len(order) and (end - at + 1) * len(made[order[end]][0]) <= 40_000:
            end += 1
        part = order[at:end]
        n = np.array([len(made[i][0]) for i in part])
        s = np.zeros((len(part), n.max(), 2))
        for j, i in enumerate(part):
            s[j, : n[j]] = with_neighbours(made[i][0]) @ model["w"]
        p = marginals(s, model["trans"], n)[0][..., 1]
        for j, i in enumerate(part):
            weight = made[i][1] + 1
            q[i] = (p[j, : n[j]] * weight).sum() / weight.sum()
        at = end
    return 1 / (1 + np.exp(-(model["a"] * q + model["b"])))


def fit_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", bound: int = 2000) -> dict:
    """A model fitted on at most `bound` labelled whole texts (and SAMPLE_BYTES of them) that are not held out."""
    return train(labelled_sample(docs, labels, label, bound))


def score_quality(docs: DataFrame, model: dict, *, key: str = "doc_id", threshold: float = 0.7) -> DataFrame:
    """One row per row of docs: key, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame({key: p[key], "score": score(shared.value, list(p["text"]))})

    rows = docs.select(key, "text")
    out = rows.mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, score double")
    return out.select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: dict, *, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, all columns, whose text scores at least the threshold. Only the text goes through Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(score(shared.value, list(texts)))

    return docs.filter(scored("text") >= threshold)

"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexical transducer maps words to classes: insult and threat (with weights), person, reference (determiners and copulas, which
point at somebody), negation and reporting verbs. Insults are *learned*: words and word beginnings that occur in labelled toxic
documents far more often than chance allows, weighted by their log odds (the listed ones start the lexicon). Threats and the
context classes are the listed words.

Four machines read the classes of a clause (a run of words up to sentence punctuation or a line end, however long):

* insult -> target: an insult counts only with a person, a reference or another insult in its clause, before or after it;
* threat -> target: a threat counts only with a person in its clause;
* negation: what stands close to a negation, before or after it, is weakened;
* reported speech: what follows a reporting verb, or stands right before one, is weakened.

They are composed once into one machine. It runs over the clause from the left and, mirrored, from the right; the pair of states at
an insult or a threat says which patterns are complete and gives the factor of its weight. Without a completed pattern a word
puts out nothing, so isolated words never score. A document's score is a logistic curve, fitted on the sample, over its matched
clauses' weights.

Defined cases: null, empty and blank texts have no clause and get the score of no match; repeated rows are each scored;
null labels are not learned from; without labels of both kinds the listed words alone decide; other columns are ignored;
very long texts and clauses are read as a whole; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import held_out, labelled_sample

# The classes' listed words in four languages.
INSULTS = "idiot moron stupid loser scum trash idioten dumm idiota imbécile estúpido crétin trottel".split()
THREATS = "kill hurt destroy tötet umbringen töten tuer tuerai matar mataré muérete".split()
PERSONS = "you your yours he she they them him her du dich dein ihr euch sie er tu te ton vous ils elle tú usted ustedes ellos".split()
REFERENCES = (
    "the a an this that these those is are was were such der die das den dem ein eine dieser diese dieses ist sind war "
    "le la les un une ce cet cette ces de des est sont el los las una ese esa este esta es son del"
).split()
NEGATIONS = "not no never isn aren nicht kein keine nie ne pas jamais nunca ni".split()
REPORTING = "said says claimed called reported quoted sagte sagt nannte dit disait appelé dijo dice llamó".split()

OTHER, INSULT, THREAT, PERSON, REFERENCE, NEGATION, REPORT = ALPHABET = range(7)
#: Words within which a target is close by, a negation weakens, and a reporting verb that follows weakens.
NEAR, NEGATION_REACH, REPORT_BEFORE = 4, 3, 3
#: Factors of a completed pattern by what completes it, (close by, further off), and of its context.
TARGETS = (PERSON, REFERENCE, INSULT)
INSULTED = {PERSON: (1.5, 1.0), REFERENCE: (1.0, 0.7), INSULT: (1.0, 0.8)}
THREATENED = {PERSON: (1.5, 1.0)}
NEGATED, REPORTED = 0.4, 0.5

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")
_ENDS = frozenset(".!?;\n")
#: Beginnings of words that may be learned.
STEMS = (4, 5, 6, 7, 8, 9)


def _tail(k: int, n: int, p: float) -> float:
    """log P(at least k of n) for rate p: the terms from k on, or what those below it leave, until they no longer count."""
    if k <= 0:
        return 0.0
    above = k > n * p
    i = k if above else k - 1
    first = math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    total = term = 1.0
    while term > 1e-17 * total and 0 < i + above <= n:
        term *= (n - i) / (i + 1) * p / (1 - p) if above else i / (n - i + 1) * (1 - p) / p
        i += 1 if above else -1
        total += term
    found = min(0.0, first + math.log(total))
    return found if above else math.log1p(-min(math.exp(found), 1 - 1e-16))


def pieces(word: str) -> list[str]:
    return [word] + [word[:k] + "-" for k in STEMS if len(word) > k]


def learn(sample: list[tuple[str, int]], least: int = 4) -> dict[str, float]:
    """Piece -> log odds, for pieces whose excess in toxic documents is beyond chance over all pieces tried."""
    toxic, all_ = Counter(), Counter()
    n_toxic, mass_toxic, mass = 0, 0, 0
    for text, label in sample:
        words = set(_TOKEN.findall(text.lower())) - _ENDS
        found = {p for w in words for p in pieces(w)}
        all_.update(found)
        mass += len(words)
        if label:
            toxic.update(found)
            n_toxic += 1
            mass_toxic += len(words)
    if not n_toxic or n_toxic == len(sample):
        return {}
    # the chance that an occurrence falls in a toxic document: the larger of its share of documents and of words
    base = min(0.9, max(n_toxic / len(sample), mass_toxic / max(1, mass)))
    tried = max(1, sum(v >= least for v in all_.values()))
    out = {}
    for piece, k in toxic.items():
        n = all_[piece]
        if k >= least and k / n > max(0.3, base) and _tail(k, n, base) + math.log(tried) < math.log(0.05):
            out[piece] = min(8.0, math.log((k + 0.5) / (n - k + 0.5)) - math.log(base / (1 - base)))
    # of a word and its beginnings the longest that explains nearly all of a shorter one's documents stands for it
    explained = {s for p in out for s in pieces(p.rstrip("-")) if s != p and s in out and toxic[p] >= 0.95 * toxic[s]}
    return {p: v for p, v in out.items() if p not in explained}


# -- the machines ---------------------------------------------------------------------------------------------------


class Machine:
    """A deterministic machine over the word classes as an explicit table: arcs[state][class] -> state. State 0 is the start.

    labels[state] is what it knows there of the words read so far.
    """

    def __init__(self, start, step: Callable):
        self.labels, self.arcs = [start], []
        number = {start: 0}
        for state in self.labels:  # grows while states are reached
            row = []
            for symbol in ALPHABET:
                after = step(state, symbol)
                if after not in number:
                    number[after] = len(self.labels)
                    self.labels.append(after)
                row.append(number[after])
            self.arcs.append(row)


def _since(symbol: int, reach: int, for_good: bool) -> Machine:
    """Words since the last such class: 1 right after it, 0 where there is none; beyond `reach` it is forgotten, or stays reach + 1."""
    return Machine(0, lambda n, s: 1 if s == symbol else n and (n + 1 if n < reach else (reach + 1) * for_good))


def compose(*machines: Machine) -> Machine:
    """All machines at once, over the states that can be reached: a state's label is the tuple of theirs."""
    joint = Machine((0,) * len(machines), lambda states, s: tuple(m.arcs[x][s] for m, x in zip(machines, states)))
    joint.labels = [tuple(m.labels[x] for m, x in zip(machines, states)) for states in joint.labels]
    return joint


def _knows(label: tuple) -> tuple:
    """What matters of a state's label: how near each kind of target is (0 none, 1 close by, 2 further off), whether a negation is
    in reach, and how near a reporting verb is."""
    near = lambda n, reach: 0 if not n else 1 if n <= reach else 2
    return (*(near(n, NEAR) for n in label[: len(TARGETS)]), label[-2] > 0, near(label[-1], REPORT_BEFORE))


def _factor(left: tuple, right: tuple, factors: dict) -> float:
    """The factor of a pattern between what is known from the left and from the right; 0 where it has no target."""
    found = [factors[kind][min(d) - 1] for i, kind in enumerate(TARGETS) if kind in factors and (d := [x[i] for x in (left, right) if x[i]])]
    factor = max(found, default=0.0) * (NEGATED if left[-2] or right[-2] else 1.0)
    return factor * (REPORTED if left[-1] or right[-1] == 1 else 1.0)


def _composed() -> tuple[Machine, list[int], dict[int, list[list[float]]]]:
    """The composed machine, each state's kind of knowledge, and per abusive class the factor of each pair of kinds."""
    m = compose(*[_since(t, NEAR, True) for t in TARGETS], _since(NEGATION, NEGATION_REACH, False), _since(REPORT, REPORT_BEFORE, True))
    kinds = sorted(set(map(_knows, m.labels)))
    tables = {c: [[_factor(a, b, factors) for b in kinds] for a in kinds] for c, factors in ((INSULT, INSULTED), (THREAT, THREATENED))}
    return m, [kinds.index(_knows(label)) for label in m.labels], tables


class Grammar:
    """The lexical transducer before the composed machine. Reading a clause, it puts out the weight of its completed patterns."""

    machine = knows = factors = None

    def __init__(self, lexicon: dict[str, float]):
        if Grammar.machine is None:
            Grammar.machine, Grammar.knows, Grammar.factors = _composed()
        self.weights = {w: 3.0 for w in INSULTS} | lexicon
        context = ((PERSON, PERSONS), (REFERENCE, REFERENCES), (NEGATION, NEGATIONS), (REPORT, REPORTING))
        self.context = {w: (c, 0.0) for c, words in context for w in words} | {w: (THREAT, 3.0) for w in THREATS}
        self.memo: dict[str, tuple[int, float]] = {}

    def arc(self, word: str) -> tuple[int, float]:
        """The word's class and weight."""
        hit = self.memo.get(word)
        if hit is None:
            found = [self.weights[p] for p in pieces(word) if p in self.weights]
            hit = self.context.get(word) or ((INSULT, max(found)) if found else (OTHER, 0.0))
            if len(self.memo) < 1_000_000:  # a memo only: beyond it words are looked up anew
                self.memo[word] = hit
        return hit

    def clause(self, words: list[str]) -> float:
        """The sum of the weights of the completed patterns."""
        found = [self.arc(w) for w in words]
        arcs, knows, state, left = self.machine.arcs, self.knows, 0, []
        for kind, _ in found:
            left.append(knows[state])
            state = arcs[state][kind]
        total, state = 0.0, 0
        for before, (kind, weight) in zip(reversed(left), reversed(found)):
            if weight:
                total += weight * self.factors[kind][before][knows[state]]
            state = arcs[state][kind]
        return total

    def document(self, text: str | None) -> tuple[float, float, int, int]:
        """(largest clause weight, sum of clause weights, clauses matched, tokens)."""
        if not text:
            return 0.0, 0.0, 0, 0
        tokens = _TOKEN.findall(text.lower())
        arc, memo = self.arc, self.memo
        hits = [i for i, w in enumerate(tokens) if (memo.get(w) or arc(w))[1]]
        best, total, n, end = 0.0, 0.0, 0, 0
        for i in hits:  # only clauses with an abusive word can pass the grammar
            if i < end:
                continue
            start = i
            while start > end and tokens[start - 1] not in _ENDS:
                start -= 1
            end = i
            while end < len(tokens) and tokens[end] not in _ENDS:
                end += 1
            w = self.clause(tokens[start:end])
            best, total, n = max(best, w), total + w, n + (w > 0)
        return best, total, n, len(tokens)


# -- fitting and scoring --------------------------------------------------------------------------------------------


def _inputs(found: list[tuple[float, float, int, int]]) -> np.ndarray:
    rows = [[1.0, min(b, 12.0) / 4, math.log1p(t) / 2, math.log1p(n), math.log1p(100 * t / (size + 20))] for b, t, n, size in found]
    return np.array(rows).reshape(-1, 5)


def fit(sample: list[tuple[str, int]]) -> dict:
    lexicon = learn(sample)
    labels = np.array([y for _, y in sample], float)
    model = {"lexicon": lexicon, "curve": np.array([-4.0, 3.0, 0.5, 0.0, 0.0])}
    if len(set(labels.tolist())) < 2:
        return model
    g = Grammar(lexicon)
    x = _inputs([g.document(t) for t, _ in sample])
    w = model["curve"].copy()
    for _ in range(60):  # Newton steps on the penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (labels - p) - 0.5 * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(5), grad)
        w += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    model["curve"] = w
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", bound: int = 8000) -> dict:
    """A model fitted on at most `bound` labelled whole texts (and SAMPLE_BYTES of them) that are not held out."""
    return fit(labelled_sample(docs, labels, label, bound))


def score_toxicity(docs: DataFrame, model: dict, *, key: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """One row per row of docs: key, held_out, score, predicted, clauses (matched)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar, curve = Grammar(shared.value["lexicon"]), shared.value["curve"]
        for p in parts:
            found = [grammar.document(t) for t in p["text"]]
            score = 1 / (1 + np.exp(-np.clip(_inputs(found) @ curve, -30, 30)))
            yield pd.DataFrame({key: p[key], "score": score, "clauses": [f[2] for f in found]})

    rows = docs.select(key, "text")
    out = rows.mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, score double, clauses int")
    return out.select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "clauses")

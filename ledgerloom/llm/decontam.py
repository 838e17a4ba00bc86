"""Benchmark decontamination by CGK embedding and bit-sampling LSH over item-sized windows.

Texts are runs of lower-cased words. A document is contaminated by an item of n words if some stretch of it is within
floor(edit_rate * n) word edits of the item. Windows of the item's length slide over the whole document, one word at a
time. Windows that cannot match are dropped without loss: k edits spoil at most 3k of an item's n - 2 three-word runs, so a window
with fewer than n - 2 - 3k runs of items of its length goes, and so does one in which more than k words are foreign to
them. The rest are embedded by random walks (Chakraborty, Goldenberg, Koucky): at each of 3n steps
the walk puts out its current word and a random bit of (step, word) says whether it moves on, so a small edit distance
becomes a small Hamming distance. Words at sampled steps form the keys of as many tables as reach `target_recall` for
an embedding that differs in half of its steps. Windows and items that share a key are candidates, and an exact
edit-distance alignment of the item to the stretch around the window decides.

The items are a stated query set: they go to all tasks in blocks of at most ITEMS items.

Defined cases: null, empty or wordless items and documents match nothing; an item of under 1 / edit_rate words must occur
exactly; repeated documents each match and repeated items match by each id; an empty table gives no rows; other columns are
ignored; a very long document is read in stretches that overlap by the longest item.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

ITEMS = 20_000
#: Words of documents handled at once.
STRETCH = 2_000_000
#: Pairs of window and item that a table of keys may put out at once.
PAIRS = 2_000_000
SAMPLED, WALKS = 3, 4
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def tables_for(target_recall: float, differing: float = 0.5) -> int:
    """Tables of SAMPLED steps that meet at least once with this probability."""
    return math.ceil(math.log(1 - target_recall) / math.log(1 - (1 - differing) ** SAMPLED))


def infix_distance(item: np.ndarray, stretch: np.ndarray) -> int:
    """Least edit distance of the item to any part of the stretch."""
    n = len(stretch) + 1
    at, row = np.arange(n), np.zeros(n, np.int64)
    for i, w in enumerate(item):
        new = np.empty(n, np.int64)
        new[0] = i + 1
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (stretch != w))
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())


def moves(word: np.ndarray, factor: np.uint64) -> np.ndarray:
    """A walk's bit for a word at a step (the step's odd factor): the top bit of a multiplicative hash."""
    return (((word.astype(np.uint64) + np.uint64(1)) * factor) >> np.uint64(63)).astype(np.int64)


def _among(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def filed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A table's distinct keys in order, where each one's members begin (and the last ends), and the members."""
    members = np.argsort(keys, kind="stable")
    values, begins = np.unique(keys[members], return_index=True)
    return values, np.append(begins, len(keys)), members


class Index:
    """The items of one block by length, with the walks' factors, the sampled steps and the items' keys."""

    def __init__(self, items: list[tuple[int, str]], edit_rate: float, target_recall: float, seed: int = 5):
        split = [(i, words_of(t)) for i, t in items]
        self.vocab = {w: k + 1 for k, w in enumerate(sorted({w for _, ws in split for w in ws}))}
        self.end = len(self.vocab) + 1  # what a walk reads past its string; 0 is any foreign word
        self.edit_rate = edit_rate
        rng = np.random.default_rng(seed)
        tables = tables_for(target_recall)
        by_length = defaultdict(list)
        for i, ws in split:
            if ws:
                by_length[len(ws)].append((i, np.array([self.vocab[w] for w in ws])))
        self.longest = max(by_length, default=0)
        self.pad = int(edit_rate * self.longest)
        self.groups = []
        self.runs, self.least = np.zeros(0, np.int64), 1 << 30  # three-word runs of the items whose windows must share some, and how many
        for n, group in sorted(by_length.items()):
            walks = []
            for w in range(WALKS):
                factors = rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                mine = tables // WALKS + (w < tables % WALKS)
                walks.append((factors, np.sort(rng.integers(0, 3 * n, (mine, SAMPLED)), axis=1)))
            x = np.stack([v for _, v in group])
            known = np.unique(x)
            keys = [[filed(col) for col in self.keys(x, *walk).T] for walk in walks]
            k = int(edit_rate * n)
            least = max(0, n - 2 - 3 * k)
            runs = np.unique(self.run_ids(x))
            if least:
                self.runs = np.union1d(self.runs, runs)
                self.least = min(self.least, least)
            self.groups.append((n, [i for i, _ in group], x, known, walks, keys, runs, least))

    def keys(self, x: np.ndarray, factors: np.ndarray, picks: np.ndarray) -> np.ndarray:
        """x (strings, n) -> (strings, tables): the CGK walk's words at the sampled steps, as one number each."""
        x = np.concatenate([x, np.full((len(x), 1), self.end)], axis=1)
        place, who, needed = np.zeros(len(x), np.int64), np.arange(len(x)), np.unique(picks)
        seen = {}
        for step in range(int(needed[-1]) + 1):
            word = x[who, np.minimum(place, x.shape[1] - 1)]
            if step in needed:
                seen[step] = word
            place += moves(word, factors[step])
        out = np.zeros((len(x), len(picks)), np.int64)
        for t, pick in enumerate(picks):
            for s in pick:
                out[:, t] = out[:, t] * (self.end + 1) + seen[int(s)]
        return out

    def run_ids(self, x: np.ndarray) -> np.ndarray:
        """Each three consecutive words as one number."""
        return (x[..., :-2] * (self.end + 1) + x[..., 1:-1]) * (self.end + 1) + x[..., 2:]

    def near_runs(self, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words within reach of enough shared runs, as (ids, segment, document of each segment)."""
        at = np.flatnonzero((ids[:-2] > 0) & (ids[1:-1] > 0) & (ids[2:] > 0))
        at = at[_among((ids[at] * (self.end + 1) + ids[at + 1]) * (self.end + 1) + ids[at + 2], self.runs)]
        reach = self.longest + self.pad + 3
        close = np.searchsorted(at, at + self.longest, "right") - np.searchsorted(at, at - self.longest)
        at = at[close >= self.least]
        edge = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edge, np.maximum(at - reach, 0), 1)
        np.add.at(edge, np.minimum(at + reach, len(ids)), -1)
        keep = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        if not len(keep):
            return ids[:0], keep, keep
        begins = np.concatenate(([True], (np.diff(keep) > 1) | (np.diff(owner[keep]) != 0)))
        return ids[keep], np.cumsum(begins) - 1, owner[keep][begins]

    def matches(self, ids: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """ids: words of several documents, each followed by `pad` foreign words; owner: the document of each word."""
        part, segment, documents = self.near_runs(ids, owner) if len(ids) > 2 else (ids[:0], ids[:0], ids[:0])
        for group in self.groups:
            if group[-1]:  # its windows must share runs
                for where, item, d in self._group_matches(part, segment, group):
                    yield int(documents[where]), item, d
            else:
                yield from self._group_matches(ids, owner, group)

    def _group_matches(self, ids: np.ndarray, owner: np.ndarray, group: tuple) -> Iterator[tuple[int, int, int]]:
        n, items, x, known, walks, keys, runs, least = group
        k = int(self.edit_rate * n)
        if len(ids) < n:
            return
        own = np.zeros(self.end + 1, bool)
        own[known] = True
        count = np.concatenate(([0], np.cumsum(own[ids], dtype=np.int64)))
        starts = np.flatnonzero(count[n:] - count[:-n] >= n - k)
        starts = starts[owner[starts] == owner[starts + n - 1]]
        if least and len(starts):
            shared = np.concatenate(([0], np.cumsum(_among(self.run_ids(ids), runs))))
            starts = starts[shared[starts + n - 2] - shared[starts] >= least]
        pairs: dict[tuple[int, int], list[int]] = defaultdict(list)
        for at in range(0, len(starts), 50_000):
            some = starts[at : at + 50_000]
            strings = ids[some[:, None] + np.arange(n)]
            met = []  # window * items + item, for those that share a key in some table
            for walk, tables in zip(walks, keys):
                mine = self.keys(strings, *walk)
                for t, (values, bounds, members) in enumerate(tables):
                    place = np.minimum(np.searchsorted(values, mine[:, t]), len(values) - 1)
                    row = np.flatnonzero(values[place] == mine[:, t])
                    for some_rows in np.array_split(row, 1 + int(np.diff(bounds)[place[row]].sum()) // PAIRS) if len(row) else ():
                        first, n_items = bounds[place[some_rows]], np.diff(bounds)[place[some_rows]]
                        again = np.repeat(np.arange(len(some_rows)), n_items)
                        turn = np.arange(len(again)) - np.repeat(np.cumsum(n_items) - n_items, n_items)
                        met.append(some_rows[again] * len(items) + members[first[again] + turn])
                        if sum(map(len, met)) > 4 * PAIRS:  # keys repeat pairs
                            met = [np.unique(np.concatenate(met))]
            for r, c in zip(*np.divmod(np.unique(np.concatenate(met)), len(items))) if met else ():
                pairs[int(owner[some[r]]), int(c)].append(int(some[r]))
        for (where, c), at in pairs.items():
            best, lo, item = None, at[0], x[c].tolist()
            for prev, s in zip(at, at[1:] + [None]):  # windows close together are aligned as one stretch
                if s is None or s - prev > n:
                    a, b = max(0, lo - k), min(len(ids), prev + n + k)
                    stretch = np.where(owner[a:b] == where, ids[a:b], 0)
                    there = set(stretch.tolist())
                    if sum(w not in there for w in item) <= k:  # else more than k edits for sure
                        d = infix_distance(x[c], stretch)
                        best = d if best is None else min(best, d)
                    lo = s
            if best is not None and best <= k:
                yield where, items[c], best


def _scan(index: Index, keys: list, texts: list[str | None]) -> Iterator[tuple]:
    ids, owner, size = [], [], 0

    def flush() -> Iterator[tuple]:
        if ids:
            found = {}
            for doc, item, d in index.matches(np.concatenate(ids), np.concatenate(owner)):
                found[doc, item] = min(d, found.get((doc, item), d))
            yield from ((doc, item, d) for (doc, item), d in found.items())

    best: dict[tuple[int, int], int] = {}
    for i, text in enumerate(texts):
        tokens = words_of(text)
        step = STRETCH - index.longest - index.pad
        for at in range(0, max(1, len(tokens)), step):
            part = tokens[at : at + STRETCH]
            ids.append(np.concatenate([np.fromiter(map(index.vocab.get, part, repeat(0)), np.int64, len(part)), np.zeros(index.pad, np.int64)]))
            owner.append(np.full(len(ids[-1]), i))
            size += len(ids[-1])
            if size >= STRETCH:
                for doc, item, d in flush():
                    best[doc, item] = min(d, best.get((doc, item), d))
                ids.clear(), owner.clear()
                size = 0
    for doc, item, d in flush():
        best[doc, item] = min(d, best.get((doc, item), d))
    for (doc, item), d in sorted(best.items()):
        yield keys[doc], item, d


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", edit_rate: float = 0.2, target_recall: float = 0.98) -> DataFrame:
    """key, item_id, edits: one row per document and benchmark item that it contains."""
    items = benchmark.select("item_id", "text").filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).dropDuplicates()
    n = items.count()
    blocks = max(1, -(-n // ITEMS))
    rows = docs.select(key, "text")
    schema = f"{key} {rows.schema[key].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}, edits int"
    out = None
    for b in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        shared = docs.sparkSession.sparkContext.broadcast(Index([(r[0], r[1]) for r in mine], edit_rate, target_recall))

        def run(parts: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = shared.value
            for p in parts:
                found = list(_scan(index, list(p[key]), list(p["text"]))) if index.groups else []
                yield pd.DataFrame(found, columns=[key, "item_id", "edits"]) if found else pd.DataFrame({key: p[key][:0], "item_id": [], "edits": []})

        found = rows.mapInPandas(run, schema)
        out = found if out is None else out.unionByName(found)
    return out

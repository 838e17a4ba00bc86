"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and which pairs of ids belong together.

Each text is encoded by a byte-level BPE (A, a space put before the text) and a piece model with byte fallback (B, which puts one
itself). Neither has tokens that reach from a visible character over a space, so texts are cut there, and each distinct word is encoded
once (a bounded store per worker); where a tokenizer's files do not show this, whole texts are encoded. Every token ends at a byte offset. An interval of the text is divided at an offset where tokens of both end: from the middle
token of A the ends of the other tokenizer are bisected in turn until both agree, upwards and then downwards. Both halves are divided
in the same way; an interval without such an end is a group. All intervals of a level, of all texts of a chunk, take their steps
together in numpy arrays, so a level costs a few array operations.

Every A token is linked to every B token of its group. A text's links are kept as distinct id pairs with how often they occur,
written once; then Spark counts in how many texts each pair occurs. A text meets the counts again in two ways: pairs with at least
a HEAVY-th of all occurrences, of which there are at most HEAVY, are broadcast; the others, none of which can be a hot key, are joined
by a shuffle. The highest count of an A id is one row per id of the vocabulary.

Defined cases: texts that are null, empty, or whose tokens' bytes are not the space and the text (A or B normalises or loses a
character) have no tokens: zeros and an empty groups_sha256. Special tokens' strings are plain text. Rows are told apart by their
place in the table, so null or repeated ids and repeated texts count by themselves; an empty table gives none; other columns are
ignored. A very long text is encoded by one task; its pairs are made and written in blocks of BLOCK, whatever the size of a group.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import col, cut

#: At most so many pairs are broadcast: those with at least one HEAVY-th of all occurrences.
HEAVY = 1_000_000
#: Bytes of text that are aligned together, and id pairs that are in memory (and in a row) together.
CHUNK, BLOCK = 1 << 20, 2 << 20
#: Words that a worker keeps with their tokens, and the longest of them.
KEPT, KEPT_CHARS = 400_000, 64
#: A group with more links than this has its repeated ids counted before they are paired.
SMALL = 16
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: how the byte-level tokenizer splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Where a word would be empty or end in white space.
BLANK_END = re.compile(r"^ |\s(?: |$)")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokenizer:
    """Tokenizer A from its JSON. Where its merges are in the order of their ids, ranks do the same work several times as fast."""

    def __init__(self, raw: bytes):
        import tiktoken

        spec = json.loads(raw)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.raw, self.bytes_of = raw, [b""] * size
        for t, i in ranks.items():
            self.bytes_of[i] = t
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocab["".join(m)] for m in merges]
        first = len(ranks) - len(merges)
        by_rank = made == list(range(first, len(ranks))) and spec["normalizer"] is None and not spec["model"].get("ignore_merges")
        by_rank = by_rank and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.quick = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}) if by_rank else None

    @functools.cached_property
    def full(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.raw.decode())
        made.encode_special_tokens = True
        return made

    def encode(self, text: str) -> np.ndarray:
        if self.quick is not None:
            try:
                return self.quick.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
            except BaseException as e:  # noqa: BLE001  a text its regular expressions give up on: a panic is no Exception
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.int64)


class PieceTokenizer:
    """Tokenizer B from its model file."""

    def __init__(self, raw: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        m = self.model
        self.space = m.piece_to_id("▁")
        self.bytes_of = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Both tokenizers, what is looked up by their ids, and the words met so far."""

    def __init__(self, raw_a: bytes, raw_b: bytes):
        self.a, self.b = ByteTokenizer(raw_a), PieceTokenizer(raw_b)
        self.len_a, self.len_b = (np.array([len(t) for t in k.bytes_of], np.int64) for k in (self.a, self.b))
        self.name_a, self.name_b = (pa.array([str(i) for i in range(len(k.bytes_of))]) for k in (self.a, self.b))
        self.by_word = self.a.quick is not None and not any(re.search(rb"\S.* ", t, re.S) for t in self.b.bytes_of if len(t) > 1)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def words(self, text: str) -> list[str]:
        """The text cut before each space that follows a visible character, without these spaces."""
        if not self.by_word:
            return [text]
        words = text.split(" ")
        if BLANK_END.search(text) is None:
            return words
        out, parts = [], []
        for w in words:
            parts.append(w)
            if w and not w[-1].isspace():
                out.append(" ".join(parts))
                parts = []
        return [*out, " ".join(parts)] if parts else out

    def encode(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Both tokenizers' ids (32 bits each) of a space and each word; None where their bytes are others.

        All words are encoded as one text, which its tokens' bytes show to be cut at their ends.
        """
        raws = [b" " + w.encode("utf-8", "surrogatepass") for w in words]
        if not words:
            return []
        whole = b"".join(raws)
        ends = np.cumsum([len(r) for r in raws])
        sides = []
        for ids, table, lengths in zip(self._both(" ".join(words)), (self.a.bytes_of, self.b.bytes_of), (self.len_a, self.len_b)):
            upto = np.cumsum(lengths[ids])
            at = np.searchsorted(upto, ends)
            good = len(ids) and upto[-1] == len(whole) and (upto[at] == ends).all() and b"".join(map(table.__getitem__, ids.tolist())) == whole
            if not good and len(words) == 1:
                return [None]
            if not good:  # some word is not made of its tokens' bytes: look for it in both halves
                return self.encode(words[: len(words) // 2]) + self.encode(words[len(words) // 2 :])
            raw, stops = ids.astype(np.int32).tobytes(), (4 * (at + 1)).tolist()
            sides.append([raw[lo:hi] for lo, hi in zip([0, *stops], stops)])
        return list(zip(*sides))

    def _both(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        b = self.b.encode([text])[0] if text else [self.b.space]
        return self.a.encode(" " + text), np.array(b, np.int64)

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids by A and B of each text, None where it has no tokens."""
        split = [self.words(t) if t else None for t in texts]
        new = {w for words in split if words for w in words} - self.known.keys()
        if len(self.known) + len(new) > KEPT:
            self.known.clear()
            new = {w for words in split if words for w in words}
        # words that end in white space would meet the next one's space: they go alone
        alone = [w for w in new if not self.by_word or not w or w[-1].isspace()]
        together = sorted(new.difference(alone))
        found = dict(zip(together, self.encode(together))) | {w: self.encode([w])[0] for w in alone}
        self.known.update((w, t) for w, t in found.items() if len(w) <= KEPT_CHARS)
        store = self.known if all(len(w) <= KEPT_CHARS for w in new) else self.known | found
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for words in split:
            got = list(map(store.__getitem__, words)) if words else [None]
            out.append(None if None in got else tuple(np.frombuffer(b"".join(x), np.int32).astype(np.int64) for x in zip(*got)))
        return out


@functools.lru_cache(1)
def aligner(raw_a: bytes, raw_b: bytes) -> Aligner:
    """Kept by a worker from one batch to the next."""
    return Aligner(raw_a, raw_b)


def middle_cuts(ea: np.ndarray, eb: np.ndarray, alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For intervals [alo, ahi) x [blo, bhi) the places (in A and B) of an end of both near the middle, -1 where there is none.

    The interval's own end, which is always shared, does not count.
    """
    middle = alo + (ahi - 2 - alo) // 2
    at_a, at_b = np.full(len(alo), -1), np.full(len(alo), -1)
    i, left = middle, np.arange(len(alo))
    while len(left):  # upwards
        j = np.searchsorted(eb, ea[i])
        same = (eb[j] == ea[i]) & (j < bhi[left] - 1)
        at_a[left[same]], at_b[left[same]] = i[same], j[same]
        on = ~same & (j < bhi[left] - 1)
        i, left = np.searchsorted(ea, eb[j[on]]), left[on]
        on = i < ahi[left] - 1
        i, left = i[on], left[on]
    left = np.flatnonzero(at_a < 0)
    i = middle[left] - 1
    on = i >= alo[left]
    i, left = i[on], left[on]
    while len(left):  # downwards
        j = np.searchsorted(eb, ea[i], "right") - 1
        same = (j >= blo[left]) & (eb[j] == ea[i])
        at_a[left[same]], at_b[left[same]] = i[same], j[same]
        on = ~same & (j >= blo[left])
        i, left = np.searchsorted(ea, eb[j[on]], "right") - 1, left[on]
        on = i >= alo[left]
        i, left = i[on], left[on]
    return at_a, at_b


def divide(ea: np.ndarray, eb: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends (exclusive, in A and in B tokens) of all groups in order.

    ea, eb: strictly rising byte ends of the tokens of several texts, one behind the other; a_ends, b_ends: where texts end in them.
    """
    alo, blo = np.concatenate([[0], a_ends[:-1]]), np.concatenate([[0], b_ends[:-1]])
    ahi, bhi = a_ends, b_ends
    done_a, done_b = [], []
    while len(alo):
        whole = (ahi - alo == 1) | (bhi - blo == 1)
        done_a.append(ahi[whole]), done_b.append(bhi[whole])
        alo, ahi, blo, bhi = alo[~whole], ahi[~whole], blo[~whole], bhi[~whole]
        at_a, at_b = middle_cuts(ea, eb, alo, ahi, blo, bhi)
        leaf = at_a < 0
        done_a.append(ahi[leaf]), done_b.append(bhi[leaf])
        alo, ahi, blo, bhi, at_a, at_b = (x[~leaf] for x in (alo, ahi, blo, bhi, at_a + 1, at_b + 1))
        # the halves side by side, so that intervals stay in order
        alo, ahi = np.stack([alo, at_a], 1).ravel(), np.stack([at_a, ahi], 1).ravel()
        blo, bhi = np.stack([blo, at_b], 1).ravel(), np.stack([at_b, bhi], 1).ravel()
    a, b = np.concatenate(done_a), np.concatenate(done_b)
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def _entries(group: np.ndarray, ids: np.ndarray, size: int, large: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times) of the tokens by group; the repeated ids of large groups are counted."""
    if not large.any():
        return group, ids, np.ones(len(ids), np.int64)
    big = large[group]
    key, times = np.unique(group[big] * size + ids[big], return_counts=True)
    g = np.concatenate([group[~big], key // size])
    order = np.argsort(g, kind="stable")
    return g[order], np.concatenate([ids[~big], key % size])[order], np.concatenate([np.ones(len(ids) - big.sum(), np.int64), times])[order]


def link_blocks(text: np.ndarray, group_a, ids_a, group_b, ids_b, size_a: int, size_b: int, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, code, times) of the distinct id pairs of each text, code = a * size_b + b, in blocks that never split an A id of a text.

    text: of each group; group_a, group_b: each token's group, rising.
    """
    n = len(text)
    large = np.bincount(group_a, minlength=n) * np.bincount(group_b, minlength=n) > SMALL
    g, a, na = _entries(group_a, ids_a, size_a, large)
    gb, b, nb = _entries(group_b, ids_b, size_b, large)
    first = np.searchsorted(gb, np.arange(n + 1))
    wide = (first[1:] - first[:-1])[g]  # B entries that an A entry meets in its group
    starts = np.zeros(1, np.int64)
    if wide.sum() > block:
        order = np.argsort(text[g] * size_a + a, kind="stable")
        g, a, na, wide = g[order], a[order], na[order], wide[order]
        fresh = np.flatnonzero(np.concatenate([[True], (text[g][1:] != text[g][:-1]) | (a[1:] != a[:-1])]))
        made = np.add.reduceat(wide, fresh)
        turn = (np.cumsum(made) - made) // block
        starts = fresh[np.flatnonzero(np.diff(turn, prepend=-1))]
    for lo, hi in zip(starts, [*starts[1:], len(g)]):
        w = wide[lo:hi]
        own = np.repeat(np.arange(lo, hi), w)
        other = np.arange(len(own)) - np.repeat(np.cumsum(w) - w, w) + first[g[own]]
        key = (text[g[own]] * size_a + a[own]) * size_b + b[other]
        if large.any():
            keys, where = np.unique(key, return_inverse=True)
            times = np.zeros(len(keys), np.int64)
            np.add.at(times, where, na[own] * nb[other])
        else:
            keys, times = np.unique(key, return_counts=True)
        yield keys // (size_a * size_b), keys % (size_a * size_b), times


def aligned_chunk(al: Aligner, texts: list[str | None], block: int = BLOCK) -> tuple[list[np.ndarray], list[str], Iterator]:
    """([n_a, n_b, n_groups, n_links] and groups_sha256 of each text, and the blocks of its links)."""
    got = al.tokens(texts)
    live = np.array([i for i, t in enumerate(got) if t is not None], np.int64)
    numbers, digests = [np.zeros(len(texts), np.int64) for _ in range(4)], [""] * len(texts)
    if not len(live):
        return numbers, digests, iter(())
    n_a, n_b = (np.array([len(got[i][k]) for i in live], np.int64) for k in (0, 1))
    a, b = (np.concatenate([got[i][k] for i in live]) for k in (0, 1))
    a_ends, b_ends = np.cumsum(n_a), np.cumsum(n_b)
    end_a, end_b = divide(np.cumsum(al.len_a[a]), np.cumsum(al.len_b[b]), a_ends, b_ends)
    in_a, in_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
    text = np.searchsorted(a_ends, end_a)  # of each group
    groups = np.bincount(text, minlength=len(live))
    links = np.concatenate([[0], np.cumsum(in_a * in_b)])
    upto = np.cumsum(groups)
    for column, values in zip(numbers, (n_a, n_b, groups, links[upto] - links[upto - groups])):
        column[live] = values

    def listed(names: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), names.take(pa.array(ids))), ",")

    sides = pc.binary_join_element_wise(listed(al.name_a, a, end_a), listed(al.name_b, b, end_b), "|")
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], upto]).astype(np.int32)), sides), ";")
    for i, s in zip(live, whole):
        digests[i] = hashlib.sha256(memoryview(s.as_buffer())).hexdigest()
    number = np.arange(len(text))
    blocks = link_blocks(live[text], np.repeat(number, in_a), a, np.repeat(number, in_b), b, len(al.len_a), len(al.len_b), block)
    return numbers, digests, blocks


def read_whole(spark: SparkSession, path: str) -> bytes:
    """A small file of the driver's machine or of any store that Spark reads."""
    if "://" not in path:
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).first()["content"])


def align(docs: DataFrame, *, key: str = "doc_id", text: str = "text", first: str = f"{TOKENIZERS}/byte_bpe_50k.json", second: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> tuple[DataFrame, DataFrame]:
    """(texts, links), both written: row, key, n_a, n_b, n_groups, n_links, groups_sha256 of each text; row, pairs (code, times).

    code = a * (ids of B) + b. A text's pairs may be several rows, none of which repeats a pair of another.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((read_whole(spark, first), read_whole(spark, second)))  # the tokenizers' files: a few MB
    rows = docs.select(F.monotonically_increasing_id().alias("row"), col(key).alias("key"), col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(*files.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            turn = (np.cumsum(sizes) - sizes) // CHUNK
            starts = np.flatnonzero(np.diff(turn, prepend=-1))
            for lo, hi in zip(starts, [*starts[1:], len(sizes)]):
                part = batch.slice(lo, hi - lo)
                numbers, digests, blocks = aligned_chunk(al, part.column("text").to_pylist())
                yield _record(part, np.arange(len(part)), numbers, digests, None, None, None)
                for where, code, times in blocks:
                    own, at = np.unique(where, return_index=True)
                    yield _record(part, own, None, None, np.append(at, len(where)), code, times)

    schema = f"row long, key {key_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<struct<code: long, times: long>>"
    made = cut(rows.mapInArrow(run, schema))
    texts = made.filter(F.col("pairs").isNull()).drop("pairs")
    return texts, made.filter(F.col("pairs").isNotNull()).select("row", "pairs")


def _record(part: pa.RecordBatch, own: np.ndarray, numbers, digests, offsets, code, times) -> pa.RecordBatch:
    """Rows of the texts `own` of a part, either with their numbers or with their pairs."""
    n = len(own)
    longs = [pa.nulls(n, pa.int64())] * 4 if numbers is None else [pa.array(x) for x in numbers]
    pair = pa.struct([("code", pa.int64()), ("times", pa.int64())])
    if offsets is None:
        pairs = pa.nulls(n, pa.list_(pair))
    else:
        pairs = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays([pa.array(code), pa.array(times)], fields=list(pair)))
    named = part.take(pa.array(own))
    columns = [named.column("row"), named.column("key"), *longs, pa.nulls(n, pa.string()) if digests is None else pa.array(digests, pa.string()), pairs]
    return pa.RecordBatch.from_arrays(columns, names=["row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])


def pair_counts(links: DataFrame, size_b: int) -> DataFrame:
    """code, count: in how many texts an id pair is linked; best: whether no pair of its A id has a higher one. Written."""
    counts = cut(links.select(F.explode("pairs.code").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("count")))
    a = F.expr(f"code div {size_b}").alias("a")
    most = counts.groupBy(a).agg(F.max("count").alias("most"))  # at most one row per id of A
    return cut(counts.withColumn("a", a).join(F.broadcast(most), "a").select("code", "count", (F.col("count") == F.col("most")).alias("best")))


def alignment(docs: DataFrame, *, key: str = "doc_id", text: str = "text", heavy: int = HEAVY, **tokenizers: str) -> DataFrame:
    """One row per row of docs: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    texts, links = align(docs, key=key, text=text, **tokenizers)
    size_b = piece_count(docs.sparkSession, tokenizers.get("second", f"{TOKENIZERS}/piece_bpe_32k.model"))
    counts = pair_counts(links, size_b)
    total = counts.agg(F.sum("count")).first()[0] or 0
    common = F.col("count") * F.lit(heavy) >= F.lit(total)
    each = links.select("row", F.inline("pairs"))
    sums = [F.sum(F.col("times") * F.col("count")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")]
    known = each.join(F.broadcast(counts.filter(common)), "code", "left")
    often = known.filter(F.col("count").isNotNull()).groupBy("row").agg(*sums)
    seldom = known.filter(F.col("count").isNull()).select("row", "code", "times").join(counts.filter(~common), "code").groupBy("row").agg(*sums)
    of_text = often.unionByName(seldom).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return texts.join(of_text, "row", "left").select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


@functools.lru_cache(4)
def _pieces(raw: bytes) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=raw).get_piece_size()


def piece_count(spark: SparkSession, path: str) -> int:
    return _pieces(read_whole(spark, path))

"""Temperature mixing of sources to target weights, realised as budgeted block permutations.

Weights: w_i ~ share_i ** a over the sources' token shares. The exponent a is bisected on [0, 1]:
the smallest a whose weights repeat no source more than `max_repeats` times, and, where the shares
are less even than `evenness` * ln(number of sources), the a whose entropy is that target; the larger of both.

Realisation: source i gets w_i * budget tokens. It is read in whole passes (epochs), each a permutation
of its documents by a keyed hash of key and text, and then part of one more pass, up to its budget. A permutation is cut into
about sqrt(documents) blocks by hash range: only block sums are ordered per source, and only the one block that
the budget ends in is ordered document by document, with equal documents as one; its last place is the source's bound. So no task
sees a whole source, and a second pass over the documents only compares each with its source's bound.

Defined cases: tokens are runs of non-space characters; documents without tokens (null, empty, blank) are never
emitted; null sources form one source; repeated rows each take part, and where the budget ends among copies as many of them as it
asks for; ties of the hash go by key, tokens and a digest of the text; an empty table gives none; other columns are passed on,
whatever their names, and mix_epoch, mix_block and mix_tokens are replaced; a very long text is one row of as many tokens.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import SPACE, col, cut, prefix

GRID = 1 << 20  # exponents are multiples of 1 / GRID


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACE + "+"), "")), F.lit(0)).cast("bigint")


def exponent(sources: DataFrame, budget: int, evenness: float, max_repeats: float) -> int:
    """In GRID-ths. Each job evaluates the 31 midpoints of the next five halvings over the source table."""
    total, n, least = sources.agg(F.sum("tokens"), F.count(F.lit(1)), F.min("tokens")).first()
    if not n or n == 1:
        return GRID
    share = F.col("tokens") / F.lit(float(total))
    lo, hi = 0, GRID
    while hi - lo > 1:
        step = max(1, (hi - lo) // 32)
        tried = list(range(lo + step, hi, step))
        aggs = []
        for k in tried:
            a = k / GRID
            p = F.pow(share, F.lit(a))
            aggs += [F.sum(p), F.sum(p * F.log(share))]
        row = sources.agg(*aggs).first()
        for j, k in enumerate(tried):
            a, z, s = k / GRID, row[2 * j], row[2 * j + 1]
            entropy = math.log(z) - a * s / z
            repeats = (least / total) ** a / z * budget / least
            # both fall as a grows (repeats) or must not fall under the target (entropy)
            if repeats <= max_repeats and entropy <= evenness * math.log(n):
                hi = k
                break
            lo = k
    return hi


def mix_sources(
    docs: DataFrame, *, source: str = "source", key: str = "doc_id", budget_tokens: int | None = None,
    evenness: float = 0.95, max_repeats: float = 4.0, seed: int = 7,
) -> DataFrame:
    """The rows of the mixture: docs' columns, mix_epoch (from 0), mix_block and mix_tokens, one row per use."""
    own = [c for c in docs.columns if c not in ("mix_epoch", "mix_block", "mix_tokens")]
    name = F.coalesce(col(source).cast("string"), F.lit("\u0000"))
    facts = [name.alias("src"), col(key).alias("key"), count_tokens(F.col("text")).alias("tokens"), F.md5("text").alias("digest")]
    slim = cut(docs.select(*facts).filter("tokens > 0"))
    sources = cut(slim.groupBy("src").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget_tokens is None else budget_tokens
    a = exponent(sources, budget, evenness, max_repeats) / GRID
    part = F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(a))
    whole = sources.agg(F.sum(part)).first()[0] or 1.0
    need = F.round(part / F.lit(whole) * F.lit(float(budget))).cast("bigint")
    plan = sources.select("src", "tokens", need.alias("need"), F.ceil(F.sqrt("n")).cast("bigint").alias("blocks"))
    plan = cut(plan.select("src", "blocks", F.expr("cast(need div tokens as int)").alias("full"), (F.col("need") % F.col("tokens")).alias("rest")))

    def place(epoch: Column, key: Column, digest: Column) -> Column:
        """Where a pass has a document, of 2^40 places."""
        text = F.concat_ws(":", F.lit(str(seed)), epoch, F.coalesce(key.cast("string"), F.lit("")), digest)
        return F.conv(F.substring(F.md5(text), 1, 10), 16, 10).cast("bigint")

    # the last pass: the block that the budget ends in, and there the last place
    last = slim.join(plan, "src").withColumn("place", place(F.col("full"), F.col("key"), F.col("digest")))
    last = last.withColumn("block", F.shiftright(F.col("place") * F.col("blocks"), 40))
    sums = cut(last.groupBy("src", "block").agg(F.sum("tokens").alias("sum"), F.max("rest").alias("rest")))
    upto = F.sum("sum").over(Window.partitionBy("src").orderBy("block"))
    ends = sums.withColumn("upto", upto).filter("upto > rest").groupBy("src").agg(F.min(F.struct("block", (F.col("upto") - F.col("sum")).alias("before"), "rest")).alias("e"))
    ends = cut(ends.select("src", F.col("e.block").alias("end"), F.col("e.before").alias("before"), F.col("e.rest").alias("rest")))
    edge = last.drop("rest").join(ends, "src").filter("block = end").groupBy("src", "before", "rest", "place", "key", "tokens", "digest").agg(F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy("src").orderBy("place", "key", "tokens", "digest").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("at", F.col("before") + F.coalesce(F.sum(F.col("tokens") * F.col("copies")).over(order), F.lit(0))).filter("at < rest")
    edge = edge.withColumn("uses", F.least("copies", F.ceil((F.col("rest") - F.col("at")) / F.col("tokens"))))
    tip = F.max(F.struct(F.struct("place", "key", "tokens", "digest").alias("bound"), "copies", "uses")).alias("t")
    bounds = cut(edge.groupBy("src").agg(tip).select("src", "t.*"))
    plan = cut(plan.drop("rest").join(ends.select("src", "end"), "src").join(bounds, "src", "left"))

    p = prefix(own)
    rows = docs.select(*[col(c) for c in own], *[f.alias(p + n) for f, n in zip(facts, ("src", "key", "tokens", "digest"))]).filter(F.col(p + "tokens") > 0)
    used = rows.join(plan.select(*[F.col(c).alias(p + c) for c in plan.columns]), p + "src")
    used = used.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col(p + "full"))))
    used = used.withColumn(p + "place", place(F.col("mix_epoch"), F.col(p + "key"), F.col(p + "digest")))
    used = used.withColumn("mix_block", F.shiftright(F.col(p + "place") * F.col(p + "blocks"), 40)).withColumn("mix_tokens", F.col(p + "tokens"))
    here = F.struct(*[F.col(p + c).alias(c) for c in ("place", "key", "tokens", "digest")])
    bound, whole_pass = F.col(p + "bound"), F.col("mix_epoch") < F.col(p + "full")
    at_end = ~whole_pass & (F.col("mix_block") == F.col(p + "end"))
    all_copies = F.col(p + "uses") >= F.col(p + "copies")
    inside = whole_pass | (F.col("mix_block") < F.col(p + "end")) | (at_end & F.coalesce((here < bound) | (here.eqNullSafe(bound) & all_copies), F.lit(False)))
    result = [*[col(c) for c in own], F.col("mix_epoch"), F.col("mix_block"), F.col("mix_tokens")]
    taken = used.filter(inside).select(*result)
    if bounds.filter("uses < copies").isEmpty():
        return taken
    # of the copies that a budget ends among as many as it asks for; equal rows are one row with a count
    split = used.filter(at_end & here.eqNullSafe(bound) & ~all_copies).groupBy(*result, p + "src", p + "uses").agg(F.count(F.lit(1)).alias(p + "n"))
    before = F.coalesce(F.sum(p + "n").over(Window.partitionBy(p + "src").orderBy(F.xxhash64(*result), *[col(c) for c in own]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    split = split.withColumn(p + "n", F.least(F.col(p + "n"), F.col(p + "uses") - before)).filter(F.col(p + "n") > 0)
    return taken.unionByName(split.withColumn(p + "n", F.explode(F.sequence(F.lit(1), F.col(p + "n").cast("int")))).select(*result))

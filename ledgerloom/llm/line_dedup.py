"""Site-relative line dedup: drop the lines that a large share of a site's pages carry.

Pages are told apart by their text, so that a page copied many times counts once: a boilerplate line
is one that many *different* pages of a host share. A line's count is over distinct pages per host;
it goes when count / pages of the host > `ratio` and count >= `min_pages`.

Defined cases: null or empty text stays as it is; blank lines always stay; a null host is a host of its own;
repeated rows all stay, each cleaned; an empty table gives none; columns other than text are passed on, whatever their names, and
columns named `lines_total` and `lines_dropped` are replaced; very long texts are split and joined within their row. Lines and pages
are told apart by 64-bit hashes: of lines whose hashes clash, all go where one does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import col, cut, prefix

#: Parts that a host's pages are dealt to where its lines do not fit a broadcast.
SALTS = 16


def _host(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit("\u0000"))


def boilerplate(docs: DataFrame, host: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, line, n, total): the hashes of each host's boilerplate lines.

    A host has at most (lines of its average page / ratio) of them.
    """
    pages = docs.select(_host(host).alias("host"), F.col("text")).filter(F.col("text").isNotNull())
    page = F.xxhash64("text").alias("page")
    totals = cut(pages.select("host", page).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("total")))
    written = F.filter(F.split("text", "\n"), lambda s: F.trim(s) != "")
    hashes = F.array_distinct(F.transform(written, lambda s: F.xxhash64(s)))
    lines = pages.select("host", page, F.explode(hashes).alias("line")).distinct()
    counts = cut(lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages))
    return counts.join(totals, "host").filter(F.col("n") > ratio * F.col("total"))


def dedup_lines(docs: DataFrame, *, host: str = "source", ratio: float = 0.02, min_pages: int = 5) -> DataFrame:
    """docs with boilerplate lines taken out of `text`, and the columns lines_total and lines_dropped.

    The hosts' line sets meet the pages by host and a salt of the page, so that a join that has to shuffle deals a host to SALTS
    parts; while they are small the planner sends them to the pages instead, which then stay where they are.
    """
    sets = boilerplate(docs, host, ratio, min_pages).groupBy("host").agg(F.collect_set("line").alias("bad"))
    named = [c for c in docs.columns if c not in ("lines_total", "lines_dropped")]
    p = prefix(named)
    sets = cut(sets.select(F.col("host").alias(p + "host"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(p + "salt"), F.col("bad").alias(p + "bad")))
    salt = F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")
    out = docs.select(*[col(c) for c in named], _host(host).alias(p + "host"), salt.alias(p + "salt")).join(sets, [p + "host", p + "salt"], "left")
    lines = F.split("text", "\n")
    # the page's own boilerplate is found by one intersection, and its few hashes are then looked for line by line
    hit = F.array_intersect(F.transform(lines, lambda s: F.xxhash64(s)), F.col(p + "bad"))
    out = out.withColumn(p + "hit", F.when(F.col(p + "bad").isNotNull(), hit))
    kept = F.filter(lines, lambda s: (F.trim(s) == "") | ~F.array_contains(F.col(p + "hit"), F.xxhash64(s)))
    out = out.withColumn(p + "kept", F.when(F.size(p + "hit") > 0, kept))
    text = F.when(F.col(p + "kept").isNotNull(), F.array_join(p + "kept", "\n")).otherwise(F.col("text")).alias("text")
    total = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    dropped = F.when(F.col(p + "kept").isNotNull(), F.size(lines) - F.size(p + "kept")).otherwise(0)
    return out.select(*[text if c == "text" else col(c) for c in named], total.alias("lines_total"), dropped.alias("lines_dropped"))

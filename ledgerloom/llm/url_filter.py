"""URL filter by a path-template tree per host, all in DataFrame expressions.

1. Segments that look variable (digits, hex, long ids) become `*`: a raw template.
   Pages are counted by (host, raw template) first; all later steps work on that far smaller table.
2. From the root down, as deep as the paths go, sibling branches whose labelled rates do not differ (two-proportion z test
   against the rest of their parent) are merged into one wildcard branch. The tree is a radix tree: a run of levels that hold one
   branch only is taken in one step, so there are as many rounds as levels that branch, however long the paths.
3. Rare children of a node with many are merged too while they have too few labels for that test.
4. A template is rejected when its smoothed share of bad labels passes a threshold.

Explicit rules come first: the longest rule that fits a URL decides.

Pages carry no labels of their own. `label_pages` derives them from their text: every line of a labelled document has the share of bad
ones among the documents that hold it; a page most of whose text is such lines is bad where they are, weighted by length.

Defined cases: a null URL or one without `://` has empty host and path, no rule, and the method's
verdict for the empty host; null labels do not count; repeated rows each count; an empty table gives none;
other columns of the input are ignored, whatever their names; a page without a key has no label; very long URLs are
branches like any other.
"""

from __future__ import annotations

import uuid
from itertools import count

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import cut, shared_dir

#: (verdict, host, path): a rule fits its host and all subdomains.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Labels below which the test of rates tells nothing about a rare branch.
FEW_LABELS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def raw_template(path: Column) -> Column:
    """The path's segments with variable ones as `*` (an extension stays)."""
    segments = F.split(F.regexp_replace(path, r"^/", ""), "/")
    variable = r"^(?:[^.]*[0-9][^.]*|[0-9a-fA-F-]{16,}|[^.]{40,})(\.[A-Za-z]{1,5})?$"
    return F.transform(segments, lambda s: F.regexp_replace(s, variable, "*$1"))


def _along(tree: DataFrame) -> DataFrame:
    """tree (host, raw, n, good, bad, node, depth) -> every path moved on to where its node's paths part, and whether it is done.

    All paths of a node are compared with a longest one of it. Where they first part from it they first part at all: up to there each
    level has one branch, which nothing can be merged with. A path that ends before that is done there.
    """
    longest = tree.groupBy("host", "node").agg(F.max_by("raw", F.struct(F.size("raw"), "raw")).alias("m"))
    rest = lambda c: F.slice(c, F.col("depth") + 1, F.greatest(F.size(c) - F.col("depth"), F.lit(0)))
    parts = F.zip_with(rest("raw"), rest("m"), lambda x, y: F.coalesce(x != y, F.lit(False)))
    at = F.array_position(parts, F.lit(True))
    apart = tree.join(longest, ["host", "node"]).withColumn("at", F.when(at > 0, (at - 1).cast("int"))).drop("m")
    chain = apart.groupBy("host", "node").agg(F.min("at").alias("chain"))
    moved = apart.drop("at").join(chain, ["host", "node"])
    left = F.size("raw") - F.col("depth")
    steps = F.least(left, F.coalesce("chain", left))
    taken = F.array_join(F.slice("raw", F.col("depth") + 1, steps), "/")
    node = F.when(steps > 0, F.concat("node", F.lit("/"), taken)).otherwise(F.col("node"))
    over = F.col("chain").isNull() | (left < F.col("chain"))
    return moved.select("host", "raw", "n", "good", "bad", node.alias("node"), (F.col("depth") + steps).cast("int").alias("depth"), over.alias("over"))


def _step(tree: DataFrame, min_children: int, min_share: float, z: float) -> DataFrame:
    """tree (host, raw, n, good, bad, node, depth) -> the same a level further down, and whether the path was at its end."""
    tree = tree.withColumn("level", F.get(F.col("raw"), F.col("depth")))
    child = cut(tree.groupBy("host", "node", "level").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")]))
    sums = [F.sum(c).alias(f"all_{c}") for c in ("n", "good", "bad")]
    parent = child.groupBy("host", "node").agg(*sums, F.count("level").alias("width"))
    child = child.join(parent, ["host", "node"])
    # rare children of a wide node are values, not structure, unless their labels tell otherwise
    rare = (F.col("width") > min_children) & (F.col("n") < min_share * F.col("all_n"))
    # a branch is merged with its siblings unless its labelled rate differs from theirs
    mine, rest = F.col("good") + F.col("bad"), F.col("all_good") + F.col("all_bad") - F.col("good") - F.col("bad")
    rate = (F.col("all_bad") + 0.5) / (F.col("all_good") + F.col("all_bad") + 1.0)
    gap = F.col("bad") / F.greatest(mine, F.lit(1)) - (F.col("all_bad") - F.col("bad")) / F.greatest(rest, F.lit(1))
    error = F.sqrt(rate * (1 - rate) * (1 / F.greatest(mine, F.lit(1)) + 1 / F.greatest(rest, F.lit(1))))
    alike = (F.col("width") > 1) & ((mine == 0) | (rest == 0) | (F.abs(gap) < z * error))
    name = F.when(F.col("level").isNull(), F.lit("")).when(alike | (rare & (mine < FEW_LABELS)), F.lit("/*")).otherwise(F.concat(F.lit("/"), F.col("level")))
    child = child.select("host", "node", "level", name.alias("step"))
    same = (F.col("t.host") == F.col("c.host")) & (F.col("t.node") == F.col("c.node")) & F.col("t.level").eqNullSafe(F.col("c.level"))
    columns = ["t.host", "t.raw", "t.n", "t.good", "t.bad", F.concat("t.node", "c.step").alias("node"), (F.col("t.depth") + 1).alias("depth")]
    return tree.alias("t").join(child.alias("c"), same).select(*columns, F.col("t.level").isNull().alias("over"))


def template_verdicts(counts: DataFrame, min_children: int, min_share: float, z: float, strength: float, threshold: float) -> DataFrame:
    """(host, raw, n, good, bad), written, one row per (host, raw) -> (host, raw, template, purity, rejected)."""
    spark, path = counts.sparkSession, f"{shared_dir(counts.sparkSession)}/templates-{uuid.uuid4().hex}"
    columns = ["host", "raw", "n", "good", "bad", "node"]
    tree = counts.withColumn("node", F.lit("")).withColumn("depth", F.lit(0))
    for turn in count():
        here = cut(_along(tree))
        here.filter("over").select(*columns).write.parquet(f"{path}/turn={2 * turn}")
        # a path that ends where others part counts as their sibling, so the node is taken as a whole
        open_ = here.filter("not over").drop("over")
        if open_.isEmpty():
            break
        here = cut(_step(open_, min_children, min_share, z))
        here.filter("over").select(*columns).write.parquet(f"{path}/turn={2 * turn + 1}")
        tree = here.filter("not over").drop("over")
    tree = spark.read.schema(here.select(*columns).schema).option("basePath", path).parquet(path)
    prior = counts.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("good") + F.sum("bad"), F.lit(0)) + 2.0)).alias("prior"))
    leaf = tree.groupBy("host", "node").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).join(F.broadcast(prior))
    purity = (F.col("bad") + strength * F.col("prior")) / (F.col("good") + F.col("bad") + strength)
    leaf = leaf.select("host", "node", purity.alias("purity"), (purity > threshold).alias("rejected"))
    return tree.select("host", "raw", "node").join(leaf, ["host", "node"]).select("host", "raw", F.col("node").alias("template"), "purity", "rejected")


def page_lines(html: Column) -> Column:
    """The visible lines of a page: block elements and line breaks part them, other tags go, white space is one space."""
    text = F.regexp_replace(html, r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->", "\n")
    text = F.regexp_replace(text, r"(?i)</?(?:p|br|div|li|ul|ol|h[1-6]|tr|td|th|table|nav|article|section|header|footer|main|body|html)\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.filter(F.transform(F.split(text, "\n"), _tidy), lambda s: s != "")


def _tidy(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"[ \t\r\f\u000B\u00A0]+", " "))


def label_pages(pages: DataFrame, docs: DataFrame, labels: DataFrame, *, key: str = "page_id", least: float = 0.5) -> DataFrame:
    """(key, bad): pages at least `least` of whose text (by length) is lines of labelled documents.

    labels: doc_id, bad. A line's rate is the share of bad ones among the labelled documents that hold it; a page is bad where the
    length-weighted mean of its known lines' rates is over a half.
    """
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("bad").isNotNull()).groupBy("doc_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    lines = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), lambda s: F.xxhash64(_tidy(s))), lambda h: h != F.xxhash64(F.lit(""))))
    known = docs.select("doc_id", lines.alias("lines")).join(marks, "doc_id").select(F.explode("lines").alias("line"), "bad").groupBy("line").agg(F.avg("bad").alias("rate"))
    held = pages.filter(F.col(key).isNotNull()).select(F.col(key).alias("page"), F.explode(page_lines(F.col("html"))).alias("s"))
    held = held.select("page", F.xxhash64("s").alias("line"), F.length("s").alias("size"))
    # lines that many pages share are counted once per page before they meet their rate
    met = held.groupBy("page", "line").agg(F.sum("size").alias("size")).join(known, "line", "left")
    seen = F.when(F.col("rate").isNotNull(), F.col("size")).otherwise(0)
    sums = met.groupBy("page").agg(F.sum("size").alias("all"), F.sum(seen).alias("seen"), F.sum(F.col("rate") * seen).alias("bad"))
    return sums.filter((F.col("seen") > 0) & (F.col("seen") >= least * F.col("all"))).select(F.col("page").alias(key), (F.col("bad") > 0.5 * F.col("seen")).alias("bad"))


def filter_urls(
    pages: DataFrame, labels: DataFrame, *, key: str = "page_id", rules=RULES,
    min_children: int = 20, min_share: float = 0.02, z: float = 1.96, strength: float = 4.0, threshold: float = 0.5,
) -> DataFrame:
    """Judge every row of pages (key, url). labels: (key, bad boolean), at most one row per key is used.

    Returns key, host, path, rule, verdict, template, purity.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col(key).alias("page"), host.alias("host"), path.alias("path")).withColumn("raw", raw_template(F.col("path")))
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("page")).agg(F.max(F.col("bad").cast("int")).alias("bad"))
    counts = cut(
        urls.join(marks, "page", "left").groupBy("host", "raw").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("bad") == 0).alias("good"), F.count_if(F.col("bad") == 1).alias("bad")
        )
    )
    verdicts = cut(template_verdicts(counts, min_children, min_share, z, strength, threshold))
    rule, decided = rule_for(F.col("host"), F.col("path"), rules)
    return (
        urls.join(verdicts, ["host", "raw"], "left")
        .select(
            F.col("page").alias(key), "host", "path", rule.alias("rule"),
            F.coalesce(decided, F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"), "template", "purity",
        )
    )

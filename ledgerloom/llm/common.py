"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.sources.shared import cut, shared_dir

__all__ = ["SPACE", "col", "cut", "held_out", "labelled_sample", "prefix", "shared_dir", "table"]

#: ASCII white space, as a regular expression class.
SPACE = r"[ \t-\r]"
#: Bytes of text that a classifier's sample may hold in all.
SAMPLE_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may see."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def prefix(columns: list[str]) -> str:
    """What no column's name begins with, in whatever case: helper columns are named with it."""
    p = "_h"
    while any(c.lower().startswith(p) for c in columns):
        p += "_"
    return p


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, max_bytes: int = SAMPLE_BYTES) -> list[tuple[str, int]]:
    """At most `bound` whole labelled texts of at most `max_bytes` in all, as sorted (text, label), from rows that are not held out.

    They are chosen by a hash of doc_id, those passed over that do not fit what is left of the bytes; of rows that share one the least text counts, and its greatest label. The two bounds are
    the documented limit of what a classifier is fitted on; all documents are scored.
    """
    ids = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    texts = cut(texts.withColumn("turn", F.xxhash64("doc_id")))
    chosen, total = [], 0
    for r in texts.select("turn", "doc_id", F.octet_length("text").alias("size")).orderBy("turn", "doc_id").collect():
        if total + r["size"] <= max_bytes:  # one that does not fit is passed over
            total += r["size"]
            chosen.append((r["turn"], r["doc_id"]))
    few = texts.sparkSession.createDataFrame(chosen, texts.select("turn", "doc_id").schema)  # at most `bound` rows
    return sorted((r["text"], r["label"]) for r in texts.join(F.broadcast(few), ["turn", "doc_id"]).select("text", "label").collect())

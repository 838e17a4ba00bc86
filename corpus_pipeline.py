"""A corpus pipeline from the training-data operators: each stage's output is written and read by the next.

Order: quality classifier, line dedup, SimHash near-dedup, benchmark decontamination, mixing to target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import decontam, line_dedup, mixing, quality, simhash
from ledgerloom.llm.common import cut, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


#: Keys that may be sent to all tasks (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Parts that a group of near copies is dealt to where its members meet the one that stays.
SALTS = 16


#: Rows that a Python worker is handed at once: what the near-copy stage counts together, and a few MB of texts.
BATCH = 4000


def _python_batches(spark: SparkSession) -> None:
    """Stages with Python workers hold few texts at once beside the JVM."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with a key of their content, which tells rows apart whose doc_id is null or shared; equal rows have equal keys."""
    return docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("row_key"))


def _by_keys(keyed: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """keyed with or without the rows of the keys (written, distinct). While they are few the texts stay where they are."""
    few = keys.count() <= BROADCAST_IDS
    return keyed.join(F.broadcast(keys) if few else keys, "row_key", how)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.7). It is fitted on the whole corpus' labelled rows.

    A null or empty text has the score of an empty line; equal texts are judged alike, so repeated rows stay or go together.
    """
    _python_batches(spark)
    model = quality.fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model).select(*COLUMNS)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without the lines that a large share of their source's pages carry; n_chars follows the text.

    Null and empty texts stay as they are, and so do blank lines; a null source is a source; repeated rows are each cleaned.
    """
    clean = line_dedup.dedup_lines(docs)
    changed = F.when(F.col("lines_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars")
    return clean.select(*[changed if c == "n_chars" else c for c in COLUMNS])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least doc_id, null last) of each group of near copies: five-word shingles, similarity 0.8 or more.

    Of equal rows one stays; different texts under one doc_id stay. Null and empty texts have no shingles and are copies of each other.
    """
    _python_batches(spark)
    keyed = _keyed(docs)
    found = simhash.near_duplicates_similar(keyed, key="row_key").groupBy("row_key").agg(F.min("component_id").alias("c"), F.count(F.lit(1)).alias("n"))
    found = cut(found.join(keyed.groupBy("row_key").agg(F.min("doc_id").alias("doc_id")), "row_key"))
    first = found.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).getField("row_key").alias("first"))
    # a group may hold a third of all rows: its members meet their first one in SALTS parts
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    gone = found.withColumn("salt", F.pmod("row_key", F.lit(SALTS)).cast("int")).join(first, ["c", "salt"])
    gone = cut(gone.filter("row_key <> first").select("row_key"))
    kept = _by_keys(keyed, gone, "left_anti")
    repeated = cut(found.filter("n > 1").select("row_key"))
    if repeated.isEmpty():
        return kept.select(*COLUMNS)
    one = _by_keys(kept, repeated, "left_semi").dropDuplicates(["row_key"])
    return one.unionByName(_by_keys(kept, repeated, "left_anti")).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (within a fifth of its words in edits), whatever their doc_id.

    Null and empty texts contain none; repeated rows stay or go together.
    """
    _python_batches(spark)
    keyed = _keyed(docs)
    leaks = cut(decontam.find_leaks(keyed, table(spark, sf_dir, "benchmark"), key="row_key").select("row_key").distinct())
    return _by_keys(keyed, leaks, "left_anti").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mixture: documents once per use, with the pass and the block they are read in.

    Documents without tokens (null, empty, blank) are in no mixture; repeated rows each take part; ties go as in mixing.mix_sources.
    """
    return mixing.mix_sources(docs).select(*COLUMNS, "mix_epoch", "mix_block", "mix_tokens")


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_boilerplate),
    ("SimHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]

#: The classifier and the fingerprints cannot be expressed in SQL; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

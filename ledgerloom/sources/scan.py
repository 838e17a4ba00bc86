"""Reading and writing chain tables laid out by block ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Schemas of the raw tables.
SCHEMAS = {
    "blocks": (
        "number bigint, hash binary, parent_hash binary, nonce binary, ommers_hash binary, logs_bloom binary, transactions_root binary, "
        "state_root binary, receipts_root binary, miner binary, difficulty string, total_difficulty string, extra_data binary, "
        "gas_limit decimal(20,0), gas_used decimal(20,0), timestamp bigint, mix_hash binary, base_fee_per_gas decimal(20,0), "
        "withdrawals_root binary, blob_gas_used decimal(20,0), excess_blob_gas decimal(20,0), parent_beacon_block_root binary, "
        "transaction_count bigint, transaction_hashes array<binary>, uncle_count bigint, size decimal(20,0)"
    ),
    "receipts": (
        "block_number bigint, block_timestamp bigint, transaction_hash binary, transaction_index bigint, from_address binary, to_address binary, "
        "cumulative_gas_used decimal(20,0), gas_used decimal(20,0), contract_address binary, status boolean, log_count bigint"
    ),
    "logs": "block_number bigint, block_timestamp bigint, transaction_hash binary, log_index bigint, address binary, topics array<binary>, data binary",
    "factories": "block_number bigint, block_timestamp bigint, factory_address binary, collection_name string",
    "calls_regular": "block_number bigint, block_timestamp bigint, contract_address binary, value binary",
    "calls_event": "block_number bigint, block_timestamp bigint, log_index bigint, target_address binary, value binary, is_reverted boolean, revert_reason string",
}
#: The names under which a configuration asks for columns, where those are others.
FIELDS = {
    "transactions": ("transaction_count", "transaction_hashes"), "uncles": ("uncle_count",), "from": ("from_address",), "to": ("to_address",), "logs": ("log_count",),
}
BUCKET = "block_bucket"


def block_of(df: DataFrame) -> str:
    return "number" if "number" in df.columns else "block_number"


def scan(spark: SparkSession, path: str, kind: str, *, blocks: tuple[int, int] | None = None, columns: list[str] | None = None, range_size: int = 10_000) -> DataFrame:
    """Rows of a raw table, pruned to the half-open block range by its partitions and then by its rows."""
    df = spark.read.schema(f"{SCHEMAS[kind]}, {BUCKET} bigint").parquet(path)
    if blocks is not None:
        lo, hi = blocks
        name = block_of(df)
        df = df.filter(F.col(BUCKET).between(lo // range_size, (hi - 1) // range_size) & (F.col(name) >= lo) & (F.col(name) < hi))
    return select_fields(df, columns) if columns else df.drop(BUCKET)


def scan_once_calls(spark: SparkSession, path: str) -> DataFrame:
    """Once-call files gain a column per function over time: their schemas are merged."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def select_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """The listed fields in table order; unknown ones are an error. A field is a column, or a name for some (FIELDS)."""
    asked = {c for f in fields for c in (FIELDS[f] if f in FIELDS and f not in df.columns else (f,))}
    unknown = asked - set(df.columns)
    if unknown:
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    return df.select(*[c for c in df.columns if c in asked])


def as_table(df: DataFrame, kind: str) -> DataFrame:
    """df with exactly the columns of a raw table: those it lacks are null, others go."""
    have = set(df.columns)
    parts = [c.strip().split(" ", 1) for c in columns_of(SCHEMAS[kind])]
    return df.select(*[(F.col(name) if name in have else F.lit(None)).cast(kind_).alias(name) for name, kind_ in parts])


def columns_of(schema: str) -> list[str]:
    """The columns of a schema text, at commas outside brackets."""
    out, depth = [""], 0
    for c in schema:
        depth += (c in "(<") - (c in ")>")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def bucketed(df: DataFrame, size: int) -> DataFrame:
    return df.withColumn(BUCKET, F.expr(f"{block_of(df)} div {size}"))


def write_ranges(df: DataFrame, path: str, size: int, mode: str = "append") -> None:
    """Block-range partitions; the commit protocol makes each write all or nothing. A range is one task's work at most."""
    out = bucketed(df, size)
    out.repartition(BUCKET).sortWithinPartitions(*[c for c in (block_of(df), "log_index") if c in df.columns]).write.mode(mode).partitionBy(BUCKET).parquet(path)


def resize_ranges(df: DataFrame, size: int) -> DataFrame:
    """Rows dealt to ranges of another size."""
    return bucketed(df.drop(BUCKET), size).repartitionByRange(BUCKET)


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that are in one table more often than in the other, with the side."""
    cols = a.columns
    return a.exceptAll(b.select(*cols)).withColumn("side", F.lit("left")).unionByName(b.select(*cols).exceptAll(a).withColumn("side", F.lit("right")))


def assert_same_rows(a: DataFrame, b: DataFrame) -> None:
    if not differing_rows(a, b).isEmpty():
        raise ValueError("the tables differ")


def all_ranges(first: int, last: int, size: int, spark: SparkSession) -> DataFrame:
    """Every range, so that empty ones are kept in reports."""
    return spark.range(first // size, last // size + 1).withColumnRenamed("id", "range")


def compact(rows: DataFrame, settled: DataFrame, size: int) -> DataFrame:
    """Rows of settled ranges, ready for write_ranges."""
    return rows.withColumn("range", F.expr(f"{block_of(rows)} div {size}")).join(settled.select("range"), "range", "left_semi").drop("range")


def tx_addresses(rows: DataFrame, receipts: DataFrame) -> DataFrame:
    """rows with the sender and receiver of their transaction."""
    return rows.join(receipts.select("transaction_hash", "from_address", "to_address"), "transaction_hash", "left")


def duration_seconds(text: Column) -> Column:
    """'15m', '5s', '2h', '1d' -> seconds; null otherwise."""
    n, unit = F.regexp_extract(text, r"^(\d+)([smhd])$", 1), F.regexp_extract(text, r"^(\d+)([smhd])$", 2)
    return F.when(n != "", n.try_cast("bigint") * F.when(unit == "s", 1).when(unit == "m", 60).when(unit == "h", 3600).otherwise(86_400))

"""The contract registry: JSON files that map contract names to addresses, events, calls and factories, as flat tables.

A file is an object keyed by contract name; a folder of files is a chain. Several fields come in more than one form: one address or a
list, one event or a list, a frequency as text, number or object. They are read as variants and brought to one form. All of it is
configuration, and joined to the data as small tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions.keccak import keccak_udf
from ledgerloom.functions.words import unshow


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """chain (the file's folder), value (its text) of all JSON files below the path."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    return files.select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("chain"), "value")


def _text(v: str, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _list(v: str, path: str) -> Column:
    """The elements of a list of objects, or of the object that stands for a list of one."""
    several, one = F.try_variant_get(v, path, "array<variant>"), F.try_variant_get(v, path, "variant")
    return F.coalesce(several, F.when(one.isNotNull(), F.array(one)))


def _texts(v: str, path: str) -> Column:
    several, one = F.try_variant_get(v, path, "array<string>"), _text(v, path)
    return F.coalesce(several, F.when(one.isNotNull(), F.array(one)))


def _events(owner: DataFrame) -> DataFrame:
    """owner: chain, contract, collection, v -> the events it lists; one without a name is known by its signature's."""
    e = owner.select("chain", "contract", "collection", F.explode(_list("v", "$.events")).alias("e"))
    signature = _text("e", "$.signature")
    return e.select("chain", "contract", "collection", F.coalesce(_text("e", "$.name"), F.substring_index(signature, "(", 1)).alias("name"), signature.alias("signature"))


def _calls(owner: DataFrame) -> DataFrame:
    """owner -> the calls it lists.

    frequency: once (also where none is stated), a number of blocks, a duration, or on_events, with the (source, event) pairs that
    set it off. params: (type, from_event, source, values) each: bound to an event's field, to the contract itself, or a list.
    """
    c = owner.select("chain", "contract", "collection", F.explode(_list("v", "$.calls")).alias("c"))
    triggers = F.transform(_list("c", "$.frequency.on_events"), lambda t: F.struct(_of(t, "$.source").alias("source"), _of(t, "$.event").alias("event")))
    params = F.transform(
        F.coalesce(_list("c", "$.params"), F.array().cast("array<variant>")),
        lambda p: F.struct(
            _of(p, "$.type").alias("type"), _of(p, "$.from_event").alias("from_event"), _of(p, "$.source").alias("source"),
            F.try_variant_get(p, "$.values", "array<string>").alias("values"),
        ),
    )
    frequency = F.when(triggers.isNotNull(), "on_events").otherwise(F.coalesce(F.lower(_text("c", "$.frequency")), F.lit("once")))
    return c.select(
        "chain", "contract", "collection", _text("c", "$.function").alias("function"), _text("c", "$.output_type").alias("output_type"),
        frequency.alias("frequency"), triggers.alias("triggers"), _text("c", "$.target").alias("target"), params.alias("params"),
    )


def _of(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _factories(contracts: DataFrame) -> DataFrame:
    """chain, contract, collection, v (the factory) per factory of a contract."""
    f = contracts.select("chain", "contract", F.explode(_list("v", "$.factories")).alias("v"))
    return f.select("chain", "contract", F.coalesce(_text("v", "$.collection_name"), _text("v", "$.collection")).alias("collection"), "v")


def registry(files: DataFrame) -> dict[str, DataFrame]:
    """files (chain, value) -> contracts, events, calls, factories.

    contracts: chain, contract, address (binary, a row per address), start_block. events and calls: chain, contract, collection (null
    for the contract's own, else that of the factory they belong to). factories: chain, contract, collection, event, signature, topic0,
    data_signature, and where the created address lies: place (topic or data), index, inner (of data[i][j]). A contract that two files of a chain
    define is an error, as is a file that is no JSON object.
    """
    parsed = files.select("chain", "value", F.from_json("value", "map<string,variant>").alias("m"))
    if parsed.filter(F.col("m").isNull()).limit(1).count():
        raise ValueError("a registry file is no JSON object")
    contracts = parsed.select("chain", F.explode("m").alias("contract", "v"))
    twice = contracts.groupBy("chain", "contract").count().filter("count > 1").first()
    if twice is not None:
        raise ValueError(f"contract {twice['contract']} is defined twice in {twice['chain']}")
    made = _factories(contracts)
    owners = contracts.select("chain", "contract", F.lit(None).cast("string").alias("collection"), "v").unionByName(made)
    hooks = made.select("chain", "contract", "collection", F.explode(_list("v", "$.factory_events")).alias("e"))
    types = F.concat_ws(",", *[F.nullif(_text("e", p), F.lit("")) for p in ("$.topics_signature", "$.data_signature")])
    where = F.trim(_text("e", "$.factory_parameters"))
    steps = F.transform(F.regexp_extract_all(where, F.lit(r"\[(\d+)\]"), 1), lambda i: i.cast("int"))
    found = hooks.select(
        "chain", "contract", "collection", _text("e", "$.name").alias("event"), F.concat(_text("e", "$.name"), F.lit("("), types, F.lit(")")).alias("signature"),
        _text("e", "$.data_signature").alias("data_signature"), F.when(where.startswith("topics["), "topic").otherwise("data").alias("place"), F.coalesce(F.get(steps, F.lit(0)), F.lit(0)).alias("index"), F.get(steps, F.lit(1)).alias("inner"),
    )
    return {
        "contracts": contracts.select(
            "chain", "contract", F.explode(_texts("v", "$.address")).alias("address"), F.coalesce(F.try_variant_get("v", "$.start_block", "bigint"), F.lit(0).cast("bigint")).alias("start_block"),
        ).withColumn("address", unshow(F.col("address"))),
        "events": _events(owners),
        "calls": _calls(owners),
        "factories": found.withColumn("topic0", keccak_udf(F.col("signature").cast("binary"))),
    }


def event_matchers(tables: dict[str, DataFrame]) -> DataFrame:
    """The contracts' own events by address: chain, contract, address, start_block, name, signature (with parameter names), topic0.

    topic0 is the hash of the signature's types, however the signature spells its parameters.
    """
    from ledgerloom.operators.decode import parse_event

    own = tables["events"].filter(F.col("collection").isNull())
    texts = [r["signature"] for r in own.select("signature").distinct().collect()]  # configuration
    topics = own.sparkSession.createDataFrame([(t, bytearray(parse_event(t)["topic0"])) for t in texts], "signature string, topic0 binary")
    return own.join(topics, "signature").join(tables["contracts"], ["chain", "contract"]).select("chain", "contract", "address", "start_block", "name", "signature", "topic0")


def match_registry(logs: DataFrame, matchers: DataFrame) -> DataFrame:
    """Logs of the registered contracts' events, from their start blocks on, with contract and event name."""
    hit = logs.withColumn("topic0", F.get("topics", F.lit(0))).join(matchers, ["address", "topic0"])
    return hit.filter(F.col("block_number") >= F.col("start_block"))


def word_of(types: str | None, index: int, inner: int | None) -> tuple[int, int | None, bool]:
    """Where the parameter data[index] or its member data[index][inner] lies: (word, inner, dynamic_array) as discover.created takes it.

    A static tuple or array lies in place, so its members are words of their own; others are pointed to. Without types every
    parameter is a word.
    """
    from ledgerloom.operators.decode import _size, is_dynamic, split_top

    kinds = split_top(types or "")
    if index >= len(kinds):
        return index, inner, False
    word = sum(1 if is_dynamic(k) else _size(k) // 32 for k in kinds[:index])
    kind = kinds[index]
    if inner is None or is_dynamic(kind):
        return word, inner, kind.endswith("[]")
    if kind.endswith("]"):
        return word + inner * (_size(kind[: kind.rindex("[")]) // 32), None, False
    return word + sum(_size(k) // 32 for k in split_top(kind[1:-1])[:inner]), None, False


def factory_matchers(tables: dict[str, DataFrame]) -> DataFrame:
    """The factories' creation events by address, as discover.created takes them."""
    places = ["data_signature", "place", "index", "inner"]
    paths = tables["factories"].select(*places).distinct().collect()  # configuration
    found = [(*p, *((p["index"], None, False) if p["place"] == "topic" else word_of(p["data_signature"], p["index"], p["inner"]))) for p in paths]
    schema = "data_signature string, place string, index int, inner int, word int, member int, dynamic_array boolean"
    known = tables["factories"].sparkSession.createDataFrame(found, schema)
    same = [tables["factories"][c].eqNullSafe(known[c]) for c in places]
    rows = tables["factories"].join(known, same).select("chain", "contract", "collection", "topic0", known["place"], F.col("word").alias("index"), F.col("member").alias("inner"), "dynamic_array")
    return rows.join(tables["contracts"], ["chain", "contract"]).select("address", "topic0", "collection", "place", "index", "inner", "dynamic_array", "start_block")

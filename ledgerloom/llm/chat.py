"""Chat formatting: records of any layout to canonical turns, and those to one training text with a loss mask.

Records come as rows with nested columns, as `spark.read.json` gives them: one wide table in which a layout's fields are those that
are not null. The sorted paths of a row's fields (of all that LAYOUTS names) are hashed; this fingerprint selects a layout, which is
plain data: where turns lie, which role each has, what orders them. A layout's optional fields give it one fingerprint per subset.
Layouts with a whole conversation per row are formatted where they are. Layouts with a row per turn are grouped by their key; the turns of
one task are put together before the shuffle, so a conversation of many rows does not send them one by one. A conversation is one
text in the end, and as such has to fit a row (2 GB).

Template: each turn is OPEN role newline text CLOSE newline. In a role or a text every `<` that backslashes (or none) and a bar follow
gets one backslash more, so no text holds a mark, and reading takes it off again. In a role backslashes are then doubled, and a newline is
a backslash and an n. The loss mask has an entry per turn: null, or for an assistant turn the (start, length) of its text in code points
of its piece, without marks.

Defined cases: null roles and texts are empty; turns are in the order of their place, nulls first, ties by role and text; repeated
rows are turns of their own; rows without key are one conversation; a row with none of the fields is a turn if the table has turn
rows; rows whose fields are no layout's come out with null layout and no text; an empty table gives none; other columns are ignored.
All of it is native and runs over texts of any length.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.llm.common import col, prefix

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: What the loss is taken over.
LEARNED = "assistant"

#: The layouts. `each`: an array of turns and the names of its role and text; `turns`: (role, fields joined by blank lines) in order;
#: `row`: a turn per row, as role, text, place, grouped by `key`, which is no field of the layout. `roles` renames roles.
LAYOUTS = (
    {"name": "turn rows", "needs": (), "may": ("turn", "role", "text"), "row": ("role", "text", "turn"), "key": "conv_id"},
    {"name": "messages", "needs": ("messages[].role",), "may": ("messages[].content",), "each": ("messages", "role", "content")},
    {"name": "shared", "needs": ("conversations[].from",), "may": ("conversations[].value", "system"), "each": ("conversations", "from", "value"), "before": ("system", ("system",)), "roles": {"human": "user", "gpt": "assistant"}},
    {"name": "instruction", "needs": ("instruction", "output"), "may": ("input", "system"), "turns": (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))},
    {"name": "prompt", "needs": ("prompt", "completion"), "may": ("system",), "turns": (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))},
    {"name": "question", "needs": ("question", "answer"), "may": ("context",), "turns": (("user", ("context", "question")), ("assistant", ("answer",)))},
    {"name": "request", "needs": ("request.prompt", "response.text"), "may": ("request.system",), "turns": (("system", ("request.system",)), ("user", ("request.prompt",)), ("assistant", ("response.text",)))},
)
TURN = "array<struct<role: string, text: string>>"


def _type_at(schema: T.StructType, path: str) -> T.DataType | None:
    """The type of a dotted path, where `a[].b` is the field b of the structs in the array a; None where there is none."""
    here: T.DataType = schema
    for step in path.split("."):
        if not isinstance(here, T.StructType) or (name := step.removesuffix("[]")) not in here.names:
            return None
        here = here[name].dataType
        if step.endswith("[]"):
            if not isinstance(here, T.ArrayType):
                return None
            here = here.elementType
    return here


def _field(path: str) -> Column:
    first, *rest = path.split(".")
    c = col(first)
    for step in rest:
        c = c.getField(step)
    return c


def _present(path: str) -> Column:
    if "[]." in path:
        array, name = path.split("[].")
        return F.coalesce(F.exists(_field(array), lambda e: e.getField(name).isNotNull()), F.lit(False))
    return _field(path).isNotNull()


def paths_of(layout: dict) -> list[str]:
    return sorted({*layout["needs"], *layout["may"]})


def fingerprint(records: DataFrame, layouts=LAYOUTS) -> Column:
    """Hash of the sorted paths of the row's fields, of all that the layouts name and the table has."""
    known = sorted({p for y in layouts for p in paths_of(y) if _type_at(records.schema, p) is not None})
    return F.xxhash64(F.concat_ws("\n", *[F.when(_present(p), F.lit(p)) for p in known]))


def fingerprints_of(layout: dict) -> list[Column]:
    """One hash per subset of the optional fields."""
    subsets = [c for n in range(len(layout["may"]) + 1) for c in combinations(layout["may"], n)]
    return [F.xxhash64(F.lit("\n".join(sorted({*layout["needs"], *some})))) for some in subsets]


def _usable(records: DataFrame, layouts) -> list[dict]:
    has = lambda p: _type_at(records.schema, p) is not None
    return [y for y in layouts if all(map(has, y["needs"])) and (y["needs"] or all(map(has, y["row"])))]


def _turn(role: Column, text: Column, renamed: dict | None = None) -> Column:
    role = F.coalesce(role.cast("string"), F.lit(""))
    for old, new in (renamed or {}).items():
        role = F.when(role == old, new).otherwise(role)
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _fixed(records: DataFrame, role: str, fields: tuple[str, ...]) -> Column:
    """One turn of the fields' texts, or null where all are."""
    there = [_field(f).cast("string") for f in fields if _type_at(records.schema, f) is not None]
    if not there:
        return F.lit(None).cast("struct<role: string, text: string>")
    return F.when(F.coalesce(*there).isNotNull(), _turn(F.lit(role), F.concat_ws("\n\n", *there)))


def canonical(records: DataFrame, layout: dict) -> Column:
    """The turns of a row as an array of (role, text), for layouts with a whole conversation per row."""
    if "turns" in layout:
        made = F.array(*[_fixed(records, role, fields) for role, fields in layout["turns"]])
        return F.filter(made, lambda t: t.isNotNull())
    array, role, text = layout["each"]
    names = _type_at(records.schema, f"{array}[]").names
    part = lambda e, name: e.getField(name) if name in names else F.lit(None)
    turns = F.transform(_field(array), lambda e: _turn(part(e, role), part(e, text), layout.get("roles")))
    if "before" in layout:
        turns = F.concat(F.filter(F.array(_fixed(records, *layout["before"])), lambda t: t.isNotNull()), turns)
    return turns


# -- the template --------------------------------------------------------------------------------------------------


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    # an n after an odd number of backslashes is a newline and takes the last of them; the others are pairs
    lines = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescaped(F.replace(lines, F.lit("\\\\"), F.lit("\\")))


def piece(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped_role(role), F.lit("\n"), escaped(text), F.lit(CLOSE + "\n"))


def loss_spans(turns: Column) -> Column:
    """An entry per turn: (start, length) of an assistant turn's text in its piece, in code points from 0; null for the others."""
    start = F.lit(len(OPEN) + len(LEARNED) + 1).alias("start")
    return F.transform(turns, lambda t: F.when(t.getField("role") == LEARNED, F.struct(start, F.length(escaped(t.getField("text"))).alias("length"))))


def pieces_of(formatted: Column) -> Column:
    """A formatted text cut after each turn, the marks' ends taken off."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    return F.slice(parts, 1, F.size(parts) - 1)


def read_back(formatted: Column) -> Column:
    """The turns that a formatted text holds."""
    body = lambda p: F.substr(p, F.lit(len(OPEN) + 1))
    at = lambda p: F.instr(body(p), "\n")
    return F.transform(
        pieces_of(formatted),
        lambda p: F.struct(unescaped_role(F.substr(body(p), F.lit(1), at(p) - 1)).alias("role"), unescaped(F.substr(body(p), at(p) + 1)).alias("text")),
    )


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    under = lambda p, s: unescaped(F.substr(p, s.getField("start") + 1, s.getField("length")))
    return F.array_join(F.zip_with(pieces_of(formatted), spans, under), "")


def format_chats(records: DataFrame, *, key: str = "conv_id", layouts=LAYOUTS) -> DataFrame:
    """key, layout, turns, formatted, loss_spans: a row per conversation. key is a column of the records (null where absent)."""
    used = _usable(records, layouts)
    print_, layout = f"{prefix(records.columns)}print", f"{prefix(records.columns)}layout"
    marked = F.lit(None).cast("string")
    for y in reversed(used):
        marked = F.when(F.col(print_).isin(*fingerprints_of(y)), y["name"]).otherwise(marked)
    by_row = [y for y in used if "row" in y]
    own_key = col(key) if key in records.columns else F.lit(None).cast("long")
    whole, rows = F.lit(None).cast(TURN), []
    for y in used:
        if "row" not in y:
            whole = F.when(F.col(layout) == y["name"], canonical(records, y)).otherwise(whole)
    inner = records.withColumn(print_, fingerprint(records, used)).withColumn(layout, marked)
    done = inner.filter(F.col(layout).isNull() | ~F.col(layout).isin("", *[y["name"] for y in by_row]))
    found = done.select(own_key.alias("key"), F.col(layout).alias("layout"), whole.alias("turns"))
    for y in by_row:
        role, text, place = y["row"]
        turns = inner.filter(F.col(layout) == y["name"]).select(
            col(y["key"]).alias("key"), F.col(layout).alias("layout"), F.struct(_field(place).alias("place"), _turn(_field(role), _field(text), y.get("roles")).alias("t")).alias("t"))
        rows.append(turns.groupBy("key", "layout").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: t.getField("t")).alias("turns")))
    for r in rows:
        found = found.unionByName(r)
    text = F.array_join(F.transform("turns", lambda t: piece(t.getField("role"), t.getField("text"))), "")
    return found.select(F.col("key").alias(key), "layout", "turns", text.alias("formatted"), loss_spans(F.col("turns")).alias("loss_spans"))

"""Chat formatting by schema fingerprints, with DataFrame functions only.

A table's nested field paths (``messages[].role``, ...) are hashed; the hash
selects a declarative mapping that turns the layout into canonical turns, an
array of (role, text). JSON records of mixed layouts select their mapping row by
row from the hash of the record's own paths. Formatting writes each turn between
markers and escapes the characters the markers are made of, so a text can hold
any control string and is read back exactly; ``loss_spans`` are the places of
the assistant texts.

Defined cases: null role, text or list entry counts as empty; rows of a
conversation are ordered by turn (nulls first), ties by role, then text; repeated
rows are turns of their own; a null conversation id is one conversation; a
conversation without turns formats to the empty string; an empty table gives an
empty result. Fields outside the known layouts are ignored whatever their names.
A layout that no mapping knows raises for a table; for JSON records its row has
layout null and turns null. One conversation is one output row, so its turns
meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN_TYPE = "array<struct<role:string,text:string>>"
OPEN, MIDDLE, CLOSE = "<turn ", ">", "</turn>\n"
#: Escapes in the order of writing; reading undoes them in reverse order.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
LOSS_ROLE = "assistant"
#: Role names of other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def paths(schema: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a schema's leaves."""
    if isinstance(schema, T.StructType):
        return [p for f in schema for p in paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(schema, T.ArrayType):
        return paths(schema.elementType, at + "[]")
    return [at]


def fingerprint(some: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(some))).encode()).hexdigest()


def _turn(role: Column, text: Column) -> Column:
    none = F.lit("")
    return F.struct(F.coalesce(role.cast("string"), none).alias("role"), F.coalesce(text.cast("string"), none).alias("text"))


def _role(c: Column) -> Column:
    out = F.lower(c)
    for k, v in ROLES.items():
        out = F.when(out == k, F.lit(v)).otherwise(out)
    return out


def _listed(name: str, role: str, text: str, rename: bool = False) -> Callable[[Callable], Column]:
    return lambda col: F.coalesce(
        F.transform(col(name), lambda m: _turn(_role(m[role]) if rename else m[role], m[text])), F.array().cast(TURN_TYPE))


def _pair(user: str, assistant: str, more: str | None = None, system: str | None = None) -> Callable[[Callable], Column]:
    def turns(col):
        ask = F.coalesce(col(user), F.lit(""))
        if more:
            extra = F.coalesce(col(more), F.lit(""))
            ask = F.when(extra == "", ask).otherwise(F.concat(ask, F.lit("\n\n"), extra))
        both = F.array(_turn(F.lit("user"), ask), _turn(F.lit(LOSS_ROLE), col(assistant)))
        if not system:
            return both
        first = F.array(_turn(F.lit("system"), col(system)))
        return F.when(F.coalesce(col(system), F.lit("")) == "", both).otherwise(F.concat(first, both))
    return turns


#: layout: (its field paths, canonical turns from them). ``turn_rows`` has one row per turn.
LAYOUTS: dict[str, tuple[tuple[str, ...], Callable | None]] = {
    "turn_rows": (("turn", "role", "text"), None),
    "messages": (("messages[].role", "messages[].content"), _listed("messages", "role", "content")),
    "from_value": (("conversations[].from", "conversations[].value"), _listed("conversations", "from", "value", True)),
    "instruction": (("instruction", "input", "output"), _pair("instruction", "output", "input")),
    "instruction_only": (("instruction", "output"), _pair("instruction", "output")),
    "prompt_response": (("prompt", "response"), _pair("prompt", "response")),
    "system_prompt_response": (("system", "prompt", "response"), _pair("prompt", "response", system="system")),
    "prompt_completion": (("prompt", "completion"), _pair("prompt", "completion")),
    "question_answer": (("question", "answer"), _pair("question", "answer")),
}
MAPPINGS = {fingerprint(list(p)): name for name, (p, _) in LAYOUTS.items()}
KNOWN = {p for ps, _ in LAYOUTS.values() for p in ps}


def layout_of(schema: T.StructType, id_col: str = "conv_id") -> str:
    """The layout whose paths hash to the hash of the schema's known paths; if other
    columns have known names too, the layout with most paths that is there whole."""
    known = {p for p in paths(schema) if p in KNOWN and p != id_col}
    if name := MAPPINGS.get(fingerprint(list(known))):
        return name
    whole = [ps for ps, _ in LAYOUTS.values() if known >= set(ps)]
    if not whole:
        raise ValueError(f"no mapping for the field paths {sorted(known) or paths(schema)}")
    return MAPPINGS[fingerprint(list(max(whole, key=len)))]


def canonical(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, layout, turns) for a table of any known layout."""
    name = layout_of(df.schema, id_col)
    if name == "turn_rows":
        t = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        rows = df.select(F.col(id_col).alias("id"), t.alias("t")).groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
        turns = F.transform("ts", lambda x: _turn(x["role"], x["text"]))
        return rows.select(F.col("id").alias(id_col), F.lit(name).alias("layout"), turns.cast(TURN_TYPE).alias("turns"))
    return df.select(id_col, F.lit(name).alias("layout"), LAYOUTS[name][1](F.col).cast(TURN_TYPE).alias("turns"))


def _has(name: str) -> Callable[[Column], Column]:
    return lambda entry: entry[name].isNotNull()


def _json_fields() -> T.StructType:
    """One schema with every known field, for reading records of any layout."""
    out: dict[str, T.DataType] = {}
    for p in sorted(KNOWN - {"turn", "role", "text"}):
        head, _, leaf = p.partition("[].")
        if leaf:
            out[head] = T.ArrayType((out[head].elementType if head in out else T.StructType()).add(leaf, "string"))
        else:
            out[p] = T.StringType()
    return T.StructType([T.StructField(k, v) for k, v in out.items()])


def canonical_json(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, layout, turns) for JSON records, each in a layout of its own: a record's
    known non-null paths are hashed and select its mapping."""
    schema = _json_fields()
    d = df.select(F.col(id_col).alias("id"), F.from_json(json_col, schema).alias("r"))
    there = []
    for f in schema:
        c = F.col("r")[f.name]
        if isinstance(f.dataType, T.ArrayType):
            there += [F.when(F.exists(c, _has(leaf.name)), F.lit(f"{f.name}[].{leaf.name}")) for leaf in f.dataType.elementType]
        else:
            there.append(F.when(c.isNotNull(), F.lit(f.name)))
    d = d.withColumn("fp", F.sha2(F.array_join(F.array_sort(F.filter(F.array(*there), lambda p: p.isNotNull())), "\n"), 256))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURN_TYPE)
    for fp, name in MAPPINGS.items():
        if make := LAYOUTS[name][1]:
            layout = F.when(F.col("fp") == fp, F.lit(name)).otherwise(layout)
            turns = F.when(F.col("fp") == fp, make(lambda c: F.col("r")[c]).cast(TURN_TYPE)).otherwise(turns)
    return d.select(F.col("id").alias(id_col), layout.alias("layout"), turns.alias("turns"))


def escape(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def formatted(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Adds ``formatted`` and ``loss_spans``: (start, end) of the trained texts in
    characters of it, end exclusive."""
    part = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE)).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == loss_role).alias("loss")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc, p):
        begin = acc["at"] + F.char_length(p["head"])
        end = begin + F.char_length(p["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + len(CLOSE)).alias("at"), F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    d = turns.withColumn("__parts", part)
    text = F.array_join(F.transform("__parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return d.withColumn("formatted", text).withColumn(
        "loss_spans", F.aggregate("__parts", start, step, lambda acc: acc["spans"])).drop("__parts")


def read_back(c: Column) -> Column:
    """The turns of a formatted conversation."""
    parts = F.filter(F.split(c, CLOSE), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substr(p, F.lit(len(OPEN) + 1), F.locate(MIDDLE, p) - len(OPEN) - 1)).alias("role"),
        unescape(F.substr(p, F.locate(MIDDLE, p) + 1)).alias("text")))


def under_mask(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")

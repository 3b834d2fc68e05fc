"""Chat formatting by schema fingerprint, in DataFrame functions only.

A layout is recognised by the hash of its sorted nested field paths.  Each known fingerprint
selects one declarative ``Mapping`` (where role and text are found); records of any layout become
canonical turns ``(conv_id, turn, role, text)``, which ``format_chat`` renders and ``read_back``
parses again.

Two kinds of input are served: tables, whose paths come from their schema, and a column of JSON
documents, whose paths are read from each document (``schema_of_variant``).

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  Inside a text every ``<``, any
number of backslashes and ``|`` gets one backslash more, so no control string can occur there, and
taking one away restores the text.  A role escapes ``%``, newline and ``<`` as ``%25``,
``%0A`` and ``%3C``.

Nulls: a null text or role is empty; rows with a null conversation id form one conversation.
Turns are ordered by turn, then role, then text; repeated rows are repeated turns.  An empty table
gives no rows.  A conversation is one output string, so its turns meet in one row by definition;
conversations never meet each other.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govframe.llm.common import fresh

START, END = "<|im_start|>", "<|im_end|>\n"


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a type; ``[]`` marks the elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint(paths: list[str]) -> str:
    """Hash of sorted field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``rows``: each row is a turn, with these columns for conversation, turn, role and text.
    ``list_path``: an array of turns, whose elements have ``role_field`` and ``text_field``.
    ``pairs``: (role, path) in order, for layouts with one field per speaker; absent or null
    fields of ``optional`` add no turn, and ``joined`` fields are appended to the turn before.
    ``roles`` renames the layout's role names to the canonical ones.
    """

    name: str
    paths: tuple[str, ...]
    rows: tuple[str, str, str, str] | None = None
    list_path: str | None = None
    role_field: str = "role"
    text_field: str = "content"
    pairs: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    joined: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = field(default=(("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant")))

    @property
    def key(self) -> str:
        return fingerprint(list(self.paths))


MAPPINGS = (
    Mapping("turn_rows", ("conv_id", "turn", "role", "text"), rows=("conv_id", "turn", "role", "text"), roles=()),  # canonical already
    Mapping("messages", ("conv_id", "messages[].role", "messages[].content"), list_path="messages"),
    Mapping("sharegpt", ("conv_id", "conversations[].from", "conversations[].value"), list_path="conversations", role_field="from", text_field="value"),
    Mapping("prompt", ("conv_id", "prompt", "response"), pairs=(("user", "prompt"), ("assistant", "response"))),
    Mapping("system_prompt", ("conv_id", "system", "prompt", "response"), pairs=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("instruction", ("conv_id", "instruction", "output"), pairs=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", ("conv_id", "instruction", "input", "output"), pairs=(("user", "instruction"), ("user", "input"), ("assistant", "output")), joined=("input",)),
)


def _renamed(role: Column, mapping: Mapping) -> Column:
    return reduce(lambda c, pair: F.when(role == pair[0], F.lit(pair[1])).otherwise(c), mapping.roles, role)


def _turn_array(mapping: Mapping, get) -> Column:
    """array<struct<turn,role,text>> of one record; ``get(path)`` reads a text field."""
    pairs: list[tuple[str, Column, Column]] = []
    for role, path in mapping.pairs:
        value = get(path)
        if path in mapping.joined:
            before_role, before, there = pairs[-1]
            pairs[-1] = (before_role, F.when(F.coalesce(F.length(value), F.lit(0)) > 0, F.concat(F.coalesce(before, F.lit("")), F.lit("\n\n"), value)).otherwise(before), there)
        else:
            pairs.append((role, value, value.isNotNull() if path in mapping.optional else F.lit(True)))
    turns = [F.when(there, F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), text.cast("string").alias("text"))) for i, (role, text, there) in enumerate(pairs)]
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


def mapping_for(schema: T.StructType, mappings: tuple[Mapping, ...] = MAPPINGS) -> Mapping:
    """The mapping whose fingerprint is that of ``schema``, or else of the fields of the only mapping that they contain most of."""
    paths = set(field_paths(schema))
    known = {m.key: m for m in mappings}
    if (exact := known.get(fingerprint(list(paths)))) is not None:
        return exact
    fitting = [m for m in mappings if set(m.paths) <= paths]  # other columns may be there too
    if not fitting:
        raise ValueError(f"no mapping for the field paths {sorted(paths)}")
    return max(fitting, key=lambda m: (len(m.paths), m.name))


def canonical_turns(df: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Turns (conv_id, turn, role, text) of a table whose layout one of ``mappings`` describes."""
    m = mapping_for(df.schema, mappings)
    if m.rows:
        conv, turn, role, text = (F.col(f"`{c}`") for c in m.rows)
        return df.select(conv.cast("long").alias("conv_id"), turn.cast("long").alias("turn"), _renamed(role.cast("string"), m).alias("role"), text.cast("string").alias("text"))
    if m.list_path:
        each = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.posexplode(m.list_path).alias("turn", "_turn"))
        return each.select("conv_id", F.col("turn").cast("long").alias("turn"), _renamed(F.col("_turn")[m.role_field].cast("string"), m).alias("role"), F.col("_turn")[m.text_field].cast("string").alias("text"))
    return df.select(F.col("conv_id").cast("long").alias("conv_id"), F.inline(_turn_array(m, F.col)))


def json_fingerprint(doc: Column) -> Column:
    """Hash of the field paths of a JSON document, from its variant schema; null for what is no JSON object.

    The schema text is cut to its structure: type names are dropped, and so are quotes around names.
    """
    shape = F.schema_of_variant(F.try_parse_json(doc))
    plain = F.regexp_replace(shape, r": (?:STRING|BIGINT|DOUBLE|BOOLEAN|VOID|BINARY|DATE|TIMESTAMP(?:_NTZ)?|FLOAT|VARIANT|DECIMAL\(\d+,\d+\))", "")
    return F.when(plain.startswith("OBJECT<"), F.substring(F.sha2(plain, 256), 1, 16))


def _shape(paths: tuple[str, ...]) -> str:
    """The structure text that ``json_fingerprint`` hashes, for given paths (objects list their fields in order)."""
    tree: dict = {}
    for p in paths:
        node = tree
        for part in p.split("."):
            node = node.setdefault(part, {})

    def text(node: dict) -> str:
        fields = []
        for name in sorted(n.removesuffix("[]") for n in node):
            inner, listed = node.get(name), node.get(f"{name}[]")
            fields.append(f"{name}: ARRAY<{text(listed)}>" if listed is not None else f"{name}: {text(inner)}" if inner else name)
        return f"OBJECT<{', '.join(fields)}>"

    return text(tree)


def json_turns(df: DataFrame, doc_col: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> tuple[DataFrame, DataFrame]:
    """Turns of a column of JSON documents of mixed layouts, and the rows that no mapping fits.

    A document's own fingerprint selects its mapping, row by row.
    """
    layout = fresh("_layout", df)
    keyed = df.withColumn(layout, json_fingerprint(F.col(doc_col)))
    doc, parts, known = F.col(doc_col), [], []
    for m in mappings:
        if m.rows:
            continue
        key = hashlib.sha256(_shape(m.paths).encode()).hexdigest()[:16]
        known.append(key)
        mine = keyed.filter(F.col(layout) == key)
        conv = F.get_json_object(doc, "$.conv_id").cast("long").alias("conv_id")
        if m.list_path:
            kind = f"array<struct<`{m.role_field}`: string, `{m.text_field}`: string>>"
            listed = mine.select(conv, F.posexplode(F.from_json(F.get_json_object(doc, f"$.{m.list_path}"), kind)).alias("turn", "_turn"))
            parts.append(listed.select("conv_id", F.col("turn").cast("long").alias("turn"), _renamed(F.col("_turn")[m.role_field], m).alias("role"), F.col("_turn")[m.text_field].alias("text")))
        else:
            parts.append(mine.select(conv, F.inline(_turn_array(m, lambda p, d=doc: F.get_json_object(d, f"$.{p}")))))
    rest = keyed.filter(F.col(layout).isNull() | ~F.col(layout).isin(known)).drop(layout)
    return reduce(DataFrame.unionByName, parts), rest


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%3C"), F.lit("<")), F.lit("%25"), F.lit("%"))


def format_chat(turns: DataFrame, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and length in code points of the learned texts)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head, body = F.concat(F.lit(START), escape_role(role), F.lit("\n")), escape_text(text)
    turn = F.struct(F.col("turn"), role.alias("role"), text.alias("text"), F.concat(head, body, F.lit(END)).alias("piece"), F.length(head).alias("lead"), F.length(body).alias("chars"), role.isin(*learned).alias("learn"))
    grouped = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,chars:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        span = F.array(F.struct((acc["at"] + t["lead"]).alias("start"), t["chars"].alias("chars")))
        return F.struct((acc["at"] + F.length(t["piece"])).alias("at"), F.when(t["learn"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return grouped.select("conv_id", F.concat_ws("", F.transform("ts", lambda t: t["piece"])).alias("formatted"), F.aggregate("ts", start, step, lambda acc: acc["spans"]).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with what its string says: turns (role and text, unescaped) and loss_text (the text under the mask)."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p != "")
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
            unescape_text(F.substr(p, F.instr(p, "\n") + F.lit(1))).alias("text"),
        ),
    )
    under = F.transform("loss_spans", lambda s: unescape_text(F.substr(F.col("formatted"), s["start"] + F.lit(1), s["chars"])))
    return formatted.select("*", turns.alias("turns"), F.concat_ws("", under).alias("loss_text"))

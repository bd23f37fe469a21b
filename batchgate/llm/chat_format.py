"""Chat formatting by schema fingerprints, DataFrame functions only.

Conversations arrive in different layouts: one row per turn, an array of
messages, prompt / response, instruction / input / output. A layout is known
by its fingerprint, a hash of its nested field paths; the fingerprint selects
a declarative mapping (plain SQL expressions) to canonical turns,
``array<struct<role, text>>``. Frames are fingerprinted by their schema,
JSON lines row by row (:func:`turns_from_json`).

Template: every turn stands between an opening and a closing control string,

    user       [INST]text[/INST]
    system     <<SYS>>text<</SYS>>
    assistant  <s>text</s>
    others     [ROLE]role[TEXT]text[/ROLE]

so any order of roles can be read back. Control strings inside texts get a
backslash after their first character; one that has backslashes there already
gets one more, so the escape is reversible and other text stays as it is.

Defined results
  * NULL text and NULL role count as empty; a conversation is formatted in
    the order of (turn, role, text), NULL turns first; repeated rows are kept.
  * A conversation is one output text, so its turns are gathered in one row;
    that is the only grouping here and it is as large as one conversation.
  * Empty tables give empty results; extra columns do not change a layout, for
    the fingerprint is taken over the fields that some mapping knows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"
#: Control strings of the template, by role.
OPEN = {"user": "[INST]", "system": "<<SYS>>", "assistant": "<s>"}
CLOSE = {"user": "[/INST]", "system": "<</SYS>>", "assistant": "</s>"}
ROLE, TEXT, END = "[ROLE]", "[TEXT]", "[/ROLE]"
_HIT = r"([\[<])(\\*)(/?INST\]|</?SYS>>|/?s>|/?ROLE\]|TEXT\])"
_ESCAPED = r"([\[<])\\(\\*)(/?INST\]|</?SYS>>|/?s>|/?ROLE\]|TEXT\])"
_TURN = (r"(?s)(\[INST\]|<<SYS>>|<s>|\[ROLE\])(.*?)(\[/INST\]|<</SYS>>|</s>|\[/ROLE\])")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _HIT, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


# ------------------------------------------------------------------ layouts

@dataclass(frozen=True)
class Layout:
    """A known layout: its nested field paths (besides the conversation id) and
    the SQL expression of its turns. ``rows`` layouts have a row per turn."""

    name: str
    paths: tuple[str, ...]
    turns: str
    rows: bool = False

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths) -> str:
    """Hash of a set of nested field paths, order and case aside."""
    return hashlib.sha256("\n".join(sorted({p.lower() for p in paths})).encode()).hexdigest()[:16]


def _messages(field: str, role: str, text: str) -> str:
    return (f"transform({field}, x -> named_struct('role', CASE x.{role} WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' "
            f"ELSE x.{role} END, 'text', x.{text}))")


LAYOUTS = (
    Layout("turn_rows", ("turn", "role", "text"), "array(named_struct('role', role, 'text', text))", rows=True),
    Layout("messages", ("messages[].role", "messages[].content"), _messages("messages", "role", "content")),
    Layout("from_value", ("conversations[].from", "conversations[].value"), _messages("conversations", "from", "value")),
    Layout("prompt_response", ("prompt", "response"),
           "array(named_struct('role', 'user', 'text', prompt), named_struct('role', 'assistant', 'text', response))"),
    Layout("prompt_completion", ("prompt", "completion"),
           "array(named_struct('role', 'user', 'text', prompt), named_struct('role', 'assistant', 'text', completion))"),
    Layout("instruction_input_output", ("instruction", "input", "output"),
           "array(named_struct('role', 'user', 'text', concat_ws('\\n\\n', instruction, nullif(input, ''))), "
           "named_struct('role', 'assistant', 'text', output))"),
    Layout("instruction_output", ("instruction", "output"),
           "array(named_struct('role', 'user', 'text', instruction), named_struct('role', 'assistant', 'text', output))"),
)
KNOWN = {p.lower() for layout in LAYOUTS if not layout.rows for p in layout.paths}        # paths of whole conversations


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested leaf paths of a type; arrays are marked ``[]``."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def layout_of(paths) -> Layout:
    """The layout whose fingerprint the fields have; fields that a layout does
    not know are left out of the fingerprint, so extra columns do no harm."""
    for layout in LAYOUTS:
        own = {p.lower() for p in layout.paths}
        if fingerprint(p for p in paths if p.lower() in own) == layout.fingerprint:
            return layout
    raise ValueError(f"no mapping for the schema fingerprint {fingerprint(paths)} of the fields {sorted(paths)}")


def _filled(turns: Column) -> Column:
    return F.transform(turns, lambda x: F.struct(F.coalesce(x["role"].cast("string"), F.lit("")).alias("role"),
                                                 F.coalesce(x["text"].cast("string"), F.lit("")).alias("text")))


def canonical(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """conv_id and canonical turns of a frame in any known layout."""
    layout = layout_of([p for p in field_paths(df.schema) if p != id_col])
    if layout.rows:
        rows = df.select(F.col(id_col).alias("conv_id"), F.col("turn").alias("_t"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        out = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
            F.col("_t").isNotNull().alias("z"), F.coalesce("_t", F.lit(0)).alias("t"), "role", "text"))).alias("turns"))
        return out.select("conv_id", _filled(F.col("turns")).alias("turns"))
    turns = F.coalesce(F.expr(layout.turns), F.expr(f"cast(array() AS {TURNS})"))
    return df.select(F.col(id_col).alias("conv_id"), _filled(turns).alias("turns"))


_JSON = ("messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, "
         "prompt string, response string, completion string, instruction string, input string, output string")


def turns_from_json(df: DataFrame, id_col: str = "conv_id", json_col: str = "json") -> DataFrame:
    """Canonical turns of JSON texts of mixed layouts, each row by its own fingerprint.

    The nested field paths of a row are read from the JSON, of arrays from all
    their elements. As in :func:`layout_of`, the first layout whose fingerprint
    the paths have that it knows is the row's; its fingerprint is returned.
    Rows that no layout fits (or whose JSON does not parse) get NULL turns and,
    for a report, the hash of the paths that any layout knows.
    """
    text = F.col(json_col)
    none = F.array().cast("array<string>")

    def inner(field: str) -> Column:
        items = F.coalesce(F.from_json(F.get_json_object(text, f"$.{field}"), "array<string>"), none)
        keys = F.flatten(F.transform(items, lambda x: F.coalesce(F.json_object_keys(x), none)))
        return F.transform(F.array_distinct(keys), lambda k: F.concat(F.lit(f"{field}[]."), k))

    def hashed(own) -> Column:
        kept = F.filter(F.col("_paths"), lambda k: k.isin(sorted({p.lower() for p in own})))
        return F.substring(F.sha2(F.array_join(kept, "\n"), 256), 1, 16)

    nested = [inner("messages"), inner("conversations")]
    top = F.coalesce(F.json_object_keys(text), none)
    paths = F.array_sort(F.array_distinct(F.transform(F.concat(top, *nested), lambda k: F.lower(k))))
    out = df.select(F.col(id_col).alias("_id"), paths.alias("_paths"), F.from_json(text, _JSON).alias("_v")).select("_id", "_paths", "_v.*")
    turns, name = F.lit(None).cast(TURNS), hashed(KNOWN)
    for layout in reversed(LAYOUTS):                          # the first that fits comes to stand outermost
        if not layout.rows:
            fits = hashed(layout.paths) == layout.fingerprint
            turns = F.when(fits, _filled(F.expr(layout.turns))).otherwise(turns)
            name = F.when(fits, F.lit(layout.fingerprint)).otherwise(name)
    return out.select(F.col("_id").alias("conv_id"), name.alias("fingerprint"), turns.alias("turns"))


# ----------------------------------------------------------------- template

def _piece(x: Column) -> Column:
    """One turn as text, and where its text stands in it."""
    role, text = x["role"], escaped(x["text"])
    named = F.concat(F.lit(ROLE), escaped(role), F.lit(TEXT))
    head, tail = named, F.lit(END)
    for name in OPEN:
        head = F.when(role == name, F.lit(OPEN[name])).otherwise(head)
        tail = F.when(role == name, F.lit(CLOSE[name])).otherwise(tail)
    return F.struct((role == "assistant").alias("loss"), F.concat(head, text, tail).alias("piece"),
                    F.length(head).cast("long").alias("at"), F.length(text).cast("long").alias("len"))


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, formatted text and loss_spans (start, len in code points of the
    formatted text; one span for each assistant text, in order)."""
    pieces = turns.select("conv_id", F.transform("turns", _piece).alias("p"))
    spans = F.expr("""aggregate(p, named_struct('pos', 0L, 'out', cast(array() AS array<struct<start:bigint,len:bigint>>)),
        (s, x) -> named_struct('pos', s.pos + length(x.piece),
                               'out', if(x.loss, concat(s.out, array(named_struct('start', s.pos + x.at, 'len', x.len))), s.out)),
        s -> s.out)""")
    return pieces.select("conv_id", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
                         spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Canonical turns back from a formatted text."""
    heads = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    bodies = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))

    def turn(head: Column, body: Column) -> Column:
        named = head == ROLE
        role = F.substring_index(body, TEXT, 1)
        text = F.when(named, F.substring(body, F.length(role) + F.lit(len(TEXT) + 1), F.length(body))).otherwise(body)
        for name in OPEN:
            role = F.when(head == OPEN[name], F.lit(name)).otherwise(role)
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.zip_with(heads, bodies, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    part = lambda x: unescaped(F.substring(formatted, (x["start"] + 1).cast("int"), x["len"].cast("int")))
    return F.array_join(F.transform(spans, part), "")


def format_conversations(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Any known layout -> conv_id, formatted, loss_spans."""
    return format_turns(canonical(df, id_col))

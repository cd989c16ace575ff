"""Chat formatting: layouts are recognised by a fingerprint of their nested field paths; declarative mappings turn
them into canonical turns; a template marks the turns and the text that training should learn.

Only DataFrame functions are used. A conversation becomes one row, so its turns meet in one task; nothing else does.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ESCAPE = "␛"
# Template: <|turn:ROLE|>\nTEXT<|end|>\n for each turn.
_OPEN, _ROLE_END, _END = "<|turn:", "|>\n", "<|end|>\n"
TURNS = "array<struct<role:string,text:string>>"


def shape(kind: T.DataType) -> str:
    """Nested field paths of a type, without the types of its leaves, in the notation of ``schema_of_variant``."""
    if isinstance(kind, T.StructType):
        return "OBJECT<" + ", ".join(f.name + (": " + s if (s := shape(f.dataType)) else "") for f in sorted(kind.fields, key=lambda f: f.name)) + ">"
    if isinstance(kind, T.ArrayType):
        inner = shape(kind.elementType)
        return f"ARRAY<{inner}>" if inner else "ARRAY"
    return ""


def fingerprint(paths: str) -> str:
    return hashlib.sha256(paths.encode()).hexdigest()


def record_paths(record: Column) -> Column:
    """As ``shape``, of each row's JSON text; null where it is no JSON."""
    described = F.schema_of_variant(F.try_parse_json(record))
    bare = F.regexp_replace(described, r": (?!OBJECT|ARRAY)[A-Z_]+(\(\d+,\d+\))?", "")
    return F.regexp_replace(bare, r"ARRAY<(?!OBJECT|ARRAY)[A-Z_]+(\(\d+,\d+\))?>", "ARRAY")


@dataclass(frozen=True)
class Layout:
    """A known layout: the type to read it as, and how to find its turns.

    ``turns``: path of an array of messages, with its role and text fields and an optional field to sort by; or
    ``parts``: (role, field, ...) for layouts of single fields, where the non-empty fields are joined by blank lines.
    """

    name: str
    ddl: str
    turns: tuple[str, str, str, str | None] | None = None
    parts: tuple[tuple[str, ...], ...] = ()

    @property
    def fingerprint(self) -> str:
        return fingerprint(shape(T.StructType.fromDDL(self.ddl)))


LAYOUTS = (
    Layout("turn rows", "turns array<struct<turn:bigint,role:string,text:string>>", turns=("turns", "role", "text", "turn")),
    Layout("messages", "messages array<struct<role:string,content:string>>", turns=("messages", "role", "content", None)),
    Layout("conversations", "conversations array<struct<from:string,value:string>>", turns=("conversations", "from", "value", None)),
    Layout("instruction", "instruction string, output string", parts=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction and input", "instruction string, input string, output string", parts=(("user", "instruction", "input"), ("assistant", "output"))),
    Layout("prompt and completion", "prompt string, completion string", parts=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt and response", "prompt string, response string", parts=(("user", "prompt"), ("assistant", "response"))),
    Layout("question and answer", "question string, answer string", parts=(("user", "question"), ("assistant", "answer"))),
    Layout("system prompt", "system string, prompt string, response string", parts=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
)
# Role names of other layouts.
ROLES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _mapped(layout: Layout, root: Column) -> Column:
    """Canonical turns of a value read with the layout's type."""
    if layout.turns:
        path, role, text, order = layout.turns
        messages = root[path] if order is None else F.array_sort(F.transform(root[path], lambda m: F.struct(m[order].alias("o"), m[role].alias(role), m[text].alias(text))))
        renamed = lambda r: F.coalesce(*[F.when(r == a, F.lit(b)) for a, b in ROLES.items()], r)
        return F.coalesce(F.transform(messages, lambda m: _turn(renamed(m[role]), m[text])), F.array().cast(TURNS))
    joined = [(role, F.array_join(F.filter(F.array(*[root[f] for f in fields]), lambda x: x != ""), "\n\n")) for role, *fields in layout.parts]
    # a layout's optional system field gives no turn when it is empty
    return F.filter(F.array(*[_turn(F.lit(role), text) for role, text in joined]), lambda t: (t["role"] != "system") | (t["text"] != ""))


def canonical_turns(df: DataFrame, key: str, name: str = "canonical") -> DataFrame:
    """``key`` and canonical turns of a typed table, whose layout is found by the fingerprint of its other columns.

    Raises ValueError for an unknown layout. Null roles and texts are empty; a null array has no turns.
    """
    record = T.StructType([f for f in df.schema.fields if f.name != key])
    found = {x.fingerprint: x for x in LAYOUTS}.get(fingerprint(shape(record)))
    if found is None:
        raise ValueError(f"no mapping for the layout {shape(record)}")
    return df.select(key, _mapped(found, F.struct(*[f.name for f in record.fields])).alias(name))


def canonical_records(df: DataFrame, key: str, record: str = "record", name: str = "canonical") -> DataFrame:
    """``key``, canonical turns and layout name of JSON texts in mixed layouts, told apart row by row.

    A row of unknown layout, or that is no JSON, is kept with null turns and a null layout.
    """
    marked = df.select(key, record, F.sha2(record_paths(F.col(record)), 256).alias("_print"))
    turns = F.coalesce(*[F.when(F.col("_print") == x.fingerprint, _mapped(x, F.from_json(record, x.ddl))) for x in LAYOUTS])
    layout = F.coalesce(*[F.when(F.col("_print") == x.fingerprint, F.lit(x.name)) for x in LAYOUTS])
    return marked.select(key, turns.alias(name), layout.alias("layout"))


def escape(text: Column) -> Column:
    """Control strings cannot appear in the result; ``unescape`` gives the text back."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.replace(F.replace(doubled, F.lit("<|"), F.lit(f"<{ESCAPE}|")), F.lit("|>"), F.lit(f"|{ESCAPE}>"))


def unescape(text: Column) -> Column:
    opened = F.replace(F.replace(text, F.lit(f"|{ESCAPE}>"), F.lit("|>")), F.lit(f"<{ESCAPE}|"), F.lit("<|"))
    return F.replace(opened, F.lit(ESCAPE * 2), F.lit(ESCAPE))


def format_turns(df: DataFrame, turns: str = "canonical", name: str = "segments", learn: str = "assistant") -> DataFrame:
    """``df`` with ``segments``: the formatted conversation in pieces of text, each with its loss flag.

    The pieces in order are the formatted text; ``loss`` is set on the texts of the role ``learn`` and nowhere else.
    """
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    each = F.transform(
        turns,
        lambda t: F.array(
            piece(F.concat(F.lit(_OPEN), escape(t["role"]), F.lit(_ROLE_END)), F.lit(False)),
            piece(escape(t["text"]), t["role"] == learn),
            piece(F.lit(_END), F.lit(False)),
        ),
    )
    return df.withColumn(name, F.flatten(each))


def formatted_text(segments: str = "segments") -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(formatted: Column) -> Column:
    """Canonical turns back from the formatted text."""
    parts = F.split(formatted, r"<\|end\|>\n")
    pattern = r"(?s)\A<\|turn:(.*?)\|>\n(.*)\z"
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(unescape(F.regexp_extract(p, pattern, 1)).alias("role"), unescape(F.regexp_extract(p, pattern, 2)).alias("text")),
    )


def read_loss(segments: str = "segments") -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def group_turns(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation with its ``turns``. Rows are sorted by turn, then role and text; null keys are one conversation."""
    return rows.groupBy(F.col(key).alias(key)).agg(
        F.collect_list(F.struct(F.col(turn).cast("bigint").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))).alias("turns")
    )


def digest(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """What can be read back from the formatted conversations."""
    read = formatted.select(key, "segments", formatted_text().alias("formatted"), read_loss().alias("learned"))
    read = read.withColumn("back", read_turns(F.col("formatted")))
    told = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        key,
        F.size("back").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )

"""Chat formatting: any known layout becomes canonical turns, then one marked text.

The layout of a row is told by its fingerprint, a hash of the nested field paths
that hold a value. A declarative mapping belongs to each fingerprint and makes the
canonical turns, an array of ``role, text``. DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"
OPEN, CLOSE, HEAD_END = "<|turn:", "<|end|>", "|>"
# Inside texts and roles: the escape itself doubled, '<' and '|' as two characters.
ESCAPE, LESS, BAR = "\\", "\\l", "\\p"
MASKED = "assistant"


def field_paths(kind: T.DataType, path: str) -> list[str]:
    """The leaf paths below a column; ``[]`` stands for the entries of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{path}.{f.name}")]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{path}[]")
    return [path]


def fingerprint(schema: T.StructType, skip: Sequence[str] = ()) -> Column:
    """The hash of the sorted paths that hold a value in the row.

    A path of a struct holds one if its field is not null, paths inside an array if
    the array is not null.
    """
    present: list[tuple[str, Column]] = []

    def walk(kind: T.DataType, path: str, value: Column) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}", value.getField(f.name))
        else:
            present.extend((p, value.isNotNull()) for p in field_paths(kind, path))

    for f in schema.fields:
        if f.name not in skip:
            walk(f.dataType, f.name, F.col(f"`{f.name}`"))
    parts = [F.when(there, F.lit(path)) for path, there in sorted(present, key=lambda x: x[0])]
    return F.xxhash64(F.concat_ws(",", *parts))


class Layout(NamedTuple):
    """A mapping: the paths that make the fingerprint, and where turns come from.

    ``fields`` are (role, path) pairs in order; paths that share a role are joined
    by a blank line. ``entries`` is (array, role field, text field) instead, where
    ``roles`` gives names other than the canonical ones.
    """

    paths: Sequence[str]
    fields: Sequence[tuple[str, str]] = ()
    entries: tuple[str, str, str] | None = None
    roles: Mapping[str, str] | None = None


# Fixed: names of roles in shared conversations, and the canonical ones.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

LAYOUTS: dict[str, Layout] = {
    "prompt": Layout(["prompt", "completion"], [("user", "prompt"), ("assistant", "completion")]),
    "response": Layout(["prompt", "response"], [("user", "prompt"), ("assistant", "response")]),
    "question": Layout(["question", "answer"], [("user", "question"), ("assistant", "answer")]),
    "instruction": Layout(["instruction", "output"], [("user", "instruction"), ("assistant", "output")]),
    "instruction with input": Layout(
        ["input", "instruction", "output"], [("user", "instruction"), ("user", "input"), ("assistant", "output")]
    ),
    "instruction with system": Layout(
        ["instruction", "output", "system"],
        [("system", "system"), ("user", "instruction"), ("assistant", "output")],
    ),
    "messages": Layout(["messages[].content", "messages[].role"], entries=("messages", "role", "content")),
    "shared": Layout(["conversations[].from", "conversations[].value"], entries=("conversations", "from", "value"), roles=ROLES),
}


def _has(schema: T.StructType, layout: Layout) -> bool:
    return set(layout.paths) <= {p for f in schema.fields for p in field_paths(f.dataType, f.name)}


def _turns(layout: Layout) -> Column:
    if layout.entries:
        array, role, text = layout.entries

        def name(given: Column) -> Column:
            for other, canonical_name in (layout.roles or {}).items():
                given = F.when(given == other, F.lit(canonical_name)).otherwise(given)
            return F.coalesce(given, F.lit(""))

        return F.transform(
            F.col(array),
            lambda m: F.struct(name(m[role]).alias("role"), F.coalesce(m[text], F.lit("")).alias("text")),
        )
    by_role: dict[str, list[Column]] = {}
    for role, path in layout.fields:
        by_role.setdefault(role, []).append(F.col(path))
    return F.array(*[
        F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *parts).alias("text"))
        for role, parts in by_role.items()
    ])


def canonical(
    rows: DataFrame, skip: Sequence[str], layouts: Mapping[str, Layout] = LAYOUTS
) -> DataFrame:
    """Add ``fingerprint``, ``layout`` and ``turns``; the columns in ``skip`` are no layout.

    A fingerprint that no mapping has gives null ``layout`` and null ``turns``: such
    rows stay, to be counted or mapped. Unknown roles are kept as they are.
    """
    usable = {name: layout for name, layout in layouts.items() if _has(rows.schema, layout)}
    marked = rows.withColumn("fingerprint", fingerprint(rows.schema, skip))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for key, layout in usable.items():
        same = F.col("fingerprint") == F.xxhash64(F.lit(",".join(sorted(layout.paths))))
        name = F.when(same, F.lit(key)).otherwise(name)
        turns = F.when(same, _turns(layout).cast(TURNS)).otherwise(turns)
    return marked.withColumns({"layout": name, "turns": turns})


def escape(text: Column) -> Column:
    """Text in which no control string can begin, since it holds no ``<``."""
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)), F.lit("<"), F.lit(LESS))


def escape_role(role: Column) -> Column:
    """The same without ``|``, so that the end of a head cannot be forged."""
    return F.replace(escape(role), F.lit("|"), F.lit(BAR))


def unescape(text: Column) -> Column:
    """The inverse of both: parts between doubled escapes hold only the other two."""
    parts = F.split(text, "\\\\\\\\")
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit(LESS), F.lit("<")), F.lit(BAR), F.lit("|")))
    return F.array_join(plain, ESCAPE)


def format_turns(turns: Column) -> Column:
    """One text: each turn between an opening mark with its role and a closing mark."""
    marked = F.transform(
        turns,
        lambda t: F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(HEAD_END + "\n"), escape(t["text"]), F.lit(CLOSE + "\n")),
    )
    return F.array_join(marked, "")


def parse_turns(formatted: Column) -> Column:
    """The turns read back from a formatted text; no text can forge a mark."""
    pieces = F.filter(F.split(formatted, CLOSE.replace("|", "\\|") + "\n"), lambda p: p != "")

    def one(piece: Column) -> Column:
        head = F.instr(piece, F.lit(HEAD_END + "\n"))  # roles hold no '|'

        return F.struct(
            unescape(F.substring(piece, F.lit(len(OPEN) + 1), head - len(OPEN) - 1)).alias("role"),
            unescape(F.substring(piece, head + len(HEAD_END) + 1, F.length(piece))).alias("text"),
        )

    return F.transform(pieces, one)


def loss_text(turns: Column, role: str = MASKED) -> Column:
    """All text under the loss mask: that of the turns of ``role``, in order."""
    masked = F.filter(turns, lambda t: t["role"] == role)
    return F.array_join(F.transform(masked, lambda t: t["text"]), "")


def gather_messages(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, messages`` from a table of one turn a row.

    Turns go by number, null first, then by role and text. A conversation is one
    text in the end, so its turns meet in one row.
    """
    entry = F.struct(
        F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("content")
    )
    gathered = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(entry)).alias("m"))
    messages = F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return gathered.select("conv_id", messages.alias("messages"))


def vary_layouts(messages: DataFrame) -> DataFrame:
    """The same conversations as a source of mixed layouts would hold them.

    A user and an assistant turn become prompt and completion, with a system turn
    before them an instruction layout, all others stay messages.
    """
    roles = F.array_join(F.transform("messages", lambda m: m["role"]), ",")
    pair, three = roles == "user,assistant", roles == "system,user,assistant"

    def content(k: int) -> Column:
        return F.get("messages", F.lit(k))["content"]

    return messages.select(
        "conv_id",
        F.when(pair, content(0)).alias("prompt"), F.when(pair, content(1)).alias("completion"),
        F.when(three, content(0)).alias("system"), F.when(three, content(1)).alias("instruction"),
        F.when(three, content(2)).alias("output"),
        F.when(~pair & ~three, F.col("messages")).alias("messages"),
    )


def format_conversations(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``layout``, ``formatted`` and ``turns`` read back from it.

    Null texts count as empty; a conversation without turns gives an empty text;
    rows of an unknown layout have null results.
    """
    found = canonical(rows, keep)
    found = found.select(*keep, "layout", format_turns(F.col("turns")).alias("formatted"))
    return found.withColumn("turns", parse_turns(F.col("formatted")))

"""Operator 10, chat formatting: schema fingerprints select declarative mappings into canonical turns.

A record's layout is its set of nested field paths; the hash of the sorted paths
is its fingerprint, which selects a mapping from a registry. A layout that is
met for the first time is resolved once: it takes the mapping that has the most
paths among those whose paths it holds, so that further fields such as ids or
tool calls do not hide a known layout. Mappings are data: where the turns are,
and which fields hold role and text. Tables and JSON records share all this.
Canonical turns are (conv_id, turn, role, text). Formatting makes one segment of
the conversation from each turn, without gathering conversations; the segments
in order are the formatted text. Reading back streams over a conversation's
sorted segments, so that a conversation of any length needs the memory of one.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents

#: The template's control strings, and what stands for them inside texts and roles.
OPEN, COLON, CLOSE = "### ", ": ", " </turn>\n"
ESCAPES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\e"}
ROLE_ESCAPES = {**ESCAPES, ":": "\\c", "\n": "\\n"}
_BACK = {"\\": "\\", "h": "###", "e": "</turn>", "c": ":", "n": "\n"}
LEARNED = "assistant"
#: Layouts that a registry remembers.
MAX_LAYOUTS = 100_000


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.

    Either `turns` names the list that holds them, with `role` and `text` as
    fields of its items, or `parts` lists (role, path) pairs of the record.
    `roles` renames roles.
    """

    paths: tuple[str, ...]
    turns: str = ""
    role: str = "role"
    text: str = "content"
    parts: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths) -> str:
    """The hash of a layout: its sorted distinct field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def paths_of(value: object, at: str = "") -> set[str]:
    """Nested field paths of a JSON value; `[]` stands for a list's items, nulls have the path of their field."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths_of(v, f"{at}.{k}" if at else k)} or {at}
    if isinstance(value, list):
        return {p for v in value for p in paths_of(v, f"{at}[]")} or {f"{at}[]"}
    return {at}


def schema_paths(kind: T.DataType, at: str = "") -> set[str]:
    """The same paths of a table's schema."""
    if isinstance(kind, T.StructType):
        return {p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)}
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return {at}


#: Layouts of JSON records.
RECORD_MAPPINGS = (
    Mapping(("messages[].role", "messages[].content"), turns="messages"),
    Mapping(("conversations[].from", "conversations[].value"), turns="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant"}),
    Mapping(("prompt", "response"), parts=(("user", "prompt"), ("assistant", "response"))),
    Mapping(("prompt", "completion"), parts=(("user", "prompt"), ("assistant", "completion"))),
    Mapping(("instruction", "output"), parts=(("user", "instruction"), ("assistant", "output"))),
    Mapping(("instruction", "input", "output"), parts=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping(("system", "instruction", "output"), parts=(("system", "system"), ("user", "instruction"), ("assistant", "output"))),
    Mapping(("system", "instruction", "input", "output"), parts=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping(("question", "answer.text"), parts=(("user", "question"), ("assistant", "answer.text"))),
)
#: Layouts of tables: rows by turn.
TABLE_MAPPINGS = (
    Mapping(("conv_id", "turn", "role", "text"), role="role", text="text"),
    Mapping(("conv_id", "turn", "message.role", "message.content"), role="message.role", text="message.content"),
)


def _get(record: object, path: str) -> object:
    for k in path.split("."):
        record = record.get(k) if isinstance(record, dict) else None
    return record


def _as_text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


class Registry:
    """Mappings by the fingerprints of layouts. Layouts that hold more than a mapping's paths are resolved when first met, and remembered."""

    def __init__(self, mappings: tuple[Mapping, ...]):
        self.mappings = sorted(mappings, key=lambda m: (-len(m.paths), m.paths))
        self.known: dict[str, Mapping | None] = {m.fingerprint: m for m in mappings}

    def of(self, paths: set[str]) -> tuple[str, Mapping | None]:
        """A layout's fingerprint and its mapping, None where no mapping fits. An empty list holds whatever its items might."""
        found = fingerprint(paths)
        if found not in self.known:
            if len(self.known) >= MAX_LAYOUTS:
                self.known = {m.fingerprint: m for m in self.mappings}
            empty = tuple(f"{p}." for p in paths if p.endswith("[]"))
            self.known[found] = next((m for m in self.mappings if all(p in paths or p.startswith(empty) for p in m.paths)), None)
        return found, self.known[found]


def canonical(record: object, registry: Registry) -> tuple[str, list[tuple[str, str]] | None]:
    """A record's fingerprint and turns; None for layouts without a mapping. Empty optional parts of a prompt make no turn."""
    found, m = registry.of(paths_of(record))
    if m is None:
        return found, None
    if m.parts:
        turns = [(role, _as_text(_get(record, p))) for role, p in m.parts]
        return found, [x for x in turns if x[1] or x[0] == LEARNED]
    items = _get(record, m.turns) or []
    return found, [(m.roles.get(r, r), _as_text(_get(x, m.text))) for x in items for r in [_as_text(_get(x, m.role))]]


def turns_from_json(records: DataFrame, mappings: tuple[Mapping, ...] = RECORD_MAPPINGS) -> DataFrame:
    """Turns of records(conv_id, record), record being JSON of any mapped layout: conv_id, turn, role, text, layout.

    Records that are null, aren't JSON (or nest deeper than Python's parser
    goes), have no mapping or no turns give one row with null turn, role and text
    and, where there is one, their fingerprint, so that they can be counted and
    nothing is lost in silence. Null roles and texts are empty; fields that a
    mapping does not name are left out. Other columns are ignored; no rows give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        registry = Registry(mappings)
        for b in batches:
            rows = []
            for conv, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    layout, turns = canonical(json.loads(raw), registry) if raw else (None, None)
                except (ValueError, RecursionError):
                    layout, turns = None, None
                rows += [(conv, k, r, t, layout) for k, (r, t) in enumerate(turns)] if turns else [(conv, None, None, None, layout)]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(cols, ["conv_id", "turn", "role", "text", "layout"])

    picked = records.select(F.col("conv_id").cast("bigint"), F.col("record").cast("string"))
    return picked.mapInArrow(run, "conv_id bigint, turn bigint, role string, text string, layout string")


def turns_from_table(table: DataFrame, mappings: tuple[Mapping, ...] = TABLE_MAPPINGS) -> DataFrame:
    """Canonical turns of a table with rows by turn, the fingerprint of its schema selecting the mapping as a record's does.

    Null roles and texts are empty, null conv_ids and turns stay, further columns are ignored; no rows give none.
    """
    paths = schema_paths(table.schema)
    found, m = Registry(mappings).of(paths)
    if m is None:
        raise ValueError(f"no mapping for the layout {found}: {sorted(paths)}")
    return table.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col(m.role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(m.text).cast("string"), F.lit("")).alias("text"))


def escaped(text: Column, escapes: dict[str, str] = ESCAPES) -> Column:
    """text without control strings. The backslash goes first, so that unescape() gets back any text."""
    for k, v in escapes.items():
        text = F.replace(text, F.lit(k), F.lit(v))
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text)


def format_turns(turns: DataFrame) -> DataFrame:
    """turns with segment, the turn's part of the formatted text, and its loss mask within that: loss_start, loss_len (code points).

    A segment is `### role: text </turn>` and a line end, with the control
    strings of texts and roles escaped. Only the texts of assistants are learned;
    other turns have a mask of length 0. Null roles and texts are empty.
    """
    turns = turns.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    body = escaped(F.col("text"))
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), ROLE_ESCAPES), F.lit(COLON))
    learned = F.col("role") == LEARNED
    return turns.select(
        "conv_id", "turn", "role", "text", F.concat(head, body, F.lit(CLOSE)).alias("segment"),
        F.length(head).cast("bigint").alias("loss_start"), F.when(learned, F.length(body)).otherwise(F.lit(0)).cast("bigint").alias("loss_len"),
    )


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    if not (segment.startswith(OPEN) and segment.endswith(CLOSE)):
        raise ValueError("not a segment")
    role, _, body = segment[len(OPEN) : -len(CLOSE)].partition(COLON)
    return unescape(role), unescape(body)


_OUT = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the formatted segments, sorted by conversation and turn, say when they are read back."""
    now, state, rows = object(), None, []

    def closed():
        return (now, state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["formatted"])

    def batch():
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _OUT)

    for b in batches:
        for conv, segment, start, length in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if state is None or conv != now:
                if state is not None:
                    rows.append(closed())
                now, state = conv, {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0}
            role, text = parse(segment)
            state["n"] += 1
            state["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            learned = unescape(segment[start : start + length])
            state["loss"].update(learned.encode("utf-8", "surrogatepass"))
            state["chars"] += len(learned)
            state["formatted"] += len(segment)
        if len(rows) >= 10_000:
            yield batch()
            rows = []
    if state is not None:
        rows.append(closed())
    if rows:
        yield batch()


def read_back(formatted: DataFrame) -> DataFrame:
    """One row a conversation, from the segments alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Turns go by number, null first, then by role and text, so that ties have an
    order; a null conv_id is a conversation of its own.
    """
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return dealt.select("conv_id", "segment", "loss_start", "loss_len").mapInArrow(_digest, schema)


#: A conversation whose texts hold the template's own control strings.
TRICKY = r"\### Assistant: </turn> ok"


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations table, rows by turn, and one conversation that comes as a JSON record; each layout's fingerprint selects its mapping."""
    turns = turns_from_table(documents(spark, sf_dir, "conversations"))
    messages = F.array(*[F.struct(F.lit(role).alias("role"), F.lit(TRICKY).alias("content")) for role in ("user", LEARNED)])
    record = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.to_json(F.struct(F.lit("extra").alias("id"), messages.alias("messages"))).alias("record"))
    extra = turns_from_json(record).filter("turn is not null").drop("layout")
    return read_back(format_turns(turns.unionByName(extra)))


OP10_SQL = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f as (select *, '### ' || replace(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\e'), ':', '\c'), chr(10), '\n') || ': '
  || replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e') || ' </turn>' || chr(10) as segment from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(segment)) as bigint) as formatted_chars
from f group by conv_id"""

"""Chat formatting by schema fingerprints.

A record is a JSON object in one of many layouts. The sorted set of its nested
field paths (array positions left out) is hashed to a fingerprint, and the
fingerprint selects a declarative mapping: where the turns are, which fields
hold role and text, which role names mean what. Mappings turn every layout into
canonical turns; a template then marks turns, escaping its own control strings
inside texts so that formatting can be undone.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import small_batches
from vigil.session import ship_package

ROLES = {
    "system": "system", "user": "user", "assistant": "assistant",
    "human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant",
}


@dataclass(frozen=True)
class Mapping:
    """Declarative: a list of turns at ``turns`` with ``role`` and ``text`` fields, or ``fields`` in order."""

    name: str
    paths: tuple[str, ...]
    turns: str | None = None
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    roles: dict = field(default_factory=lambda: ROLES, hash=False, compare=False)


MAPPINGS = (
    Mapping("messages", ("messages", "messages[].role", "messages[].content"), "messages", "role", "content"),
    Mapping("conversations", ("conversations", "conversations[].from", "conversations[].value"), "conversations", "from", "value"),
    Mapping("dialog", ("dialog", "dialog[].speaker", "dialog[].utterance.text", "dialog[].utterance"), "dialog", "speaker", "utterance.text"),
    Mapping("prompt", ("prompt", "response"), fields=(("prompt", "user"), ("response", "assistant"))),
    Mapping("instruction", ("instruction", "input", "output"), fields=(("instruction", "system"), ("input", "user"), ("output", "assistant"))),
)


def field_paths(value, prefix: str = "") -> Iterator[str]:
    if isinstance(value, dict):
        for name, inner in value.items():
            path = f"{prefix}.{name}" if prefix else name
            yield path
            yield from field_paths(inner, path)
    elif isinstance(value, list):
        for inner in value:
            yield from field_paths(inner, f"{prefix}[]")


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


REGISTRY = {fingerprint(m.paths): m for m in MAPPINGS}


def _at(value, path: str):
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical_turns(record: str | None, registry: dict[str, Mapping]) -> tuple[str | None, str | None, list[tuple[str, str, str]]]:
    """(fingerprint, mapping name, turns of canonical role, own role and text); no mapping and no turns where none fits."""
    try:
        value = json.loads(record) if record is not None else None
    except ValueError:
        return None, None, []
    if not isinstance(value, dict):
        return None, None, []
    print_ = fingerprint(field_paths(value))
    mapping = registry.get(print_)
    if mapping is None:
        return print_, None, []
    if mapping.turns is None:
        return print_, mapping.name, [(role, role, _text(_at(value, path))) for path, role in mapping.fields]
    turns = []
    for item in _at(value, mapping.turns):
        role = _text(_at(item, mapping.role))
        turns.append((mapping.roles.get(role.lower(), role), role, _text(_at(item, mapping.text))))
    return print_, mapping.name, turns


def _map_records(registry: dict[str, Mapping]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for id_, base, record in zip(*(batch.column(c).to_pylist() for c in ("id", "base", "record")), strict=True):
                print_, name, turns = canonical_turns(record, registry)
                rows = [(id_, base + i, *turn, print_, name) for i, turn in enumerate(turns)]
                out += rows or [(id_, base, None, None, None, print_, name)]
            columns = list(zip(*out, strict=True)) or [[]] * 7
            types = [pa.int64(), pa.int64(), *[pa.string()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["id", "turn", "role", "own_role", "text", "fingerprint", "mapping"],
            )

    return run


def map_records(records: DataFrame, *, registry: dict[str, Mapping] = REGISTRY) -> DataFrame:
    """Canonical turns ``id, turn, role, own_role, text, fingerprint, mapping`` of ``records (id, base, record)``.

    ``role`` is what the mapping makes of the record's ``own_role``.

    ``base`` orders a record's turns after those of the records before it, so
    a long conversation may come in several records. Null, malformed and unknown
    layouts give one row without role, text and mapping.
    """
    ship_package(records.sparkSession)
    small_batches(records.sparkSession)
    return records.select("id", "base", "record").mapInArrow(
        _map_records(registry), "id long, turn long, role string, own_role string, text string, fingerprint string, mapping string"
    )


#: The template: a turn is ROLE_MARK role "\n" text TURN_END. ESCAPE precedes
#: every control string inside a role or text, and itself.
ESCAPE = "\\"
TURN_END = "</turn>\n"
CONTROL = ("\\", "### ", "</turn>")


def escape(text: str) -> str:
    for control in CONTROL:
        text = text.replace(control, ESCAPE + control)
    return text


def unescape(text: str) -> str:
    out, at = [], 0
    while (mark := text.find(ESCAPE, at)) >= 0:
        out.append(text[at:mark])
        at = mark + 1
        if text.startswith(ESCAPE, at):
            out.append(ESCAPE)
            at += 1
    return "".join(out) + text[at:]


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and the start and end of its loss mask (empty unless the assistant speaks)."""
    head = f"### {escape(role)}".replace("\n", ESCAPE + "\n") + "\n"
    body = escape(text)
    loss = (len(head), len(head) + len(body)) if role == "assistant" else (0, 0)
    return head + body + TURN_END, *loss


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    at = formatted.index("\n")
    while (at - len(formatted[:at].rstrip(ESCAPE))) % 2:  # an escaped newline belongs to the role
        at = formatted.index("\n", at + 1)
    return unescape(formatted[len("### "):at]), unescape(formatted[at + 1 : -len(TURN_END)])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [format_turn(r or "", t or "") for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), batch.column("turn"), batch.column("seq"),
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int64()),
            ],
            names=["id", "turn", "seq", "formatted", "loss_start", "loss_end"],
        )


def format_chats(turns: DataFrame, *, role_col: str = "role") -> DataFrame:
    """``turns`` formatted with the roles of ``role_col``: ``id, turn, seq, formatted, loss_start, loss_end``, one row per turn.

    A conversation's formatted text is its rows' end to end by ``turn, seq``;
    the mask bounds are code points within the row. Null texts and roles are
    empty; repeated turns are kept, in the order of ``seq``. An empty table
    gives no rows.
    """
    ship_package(turns.sparkSession)
    rows = turns.filter("role is not null or text is not null").withColumn("seq", F.monotonically_increasing_id())
    return rows.select("id", "turn", "seq", F.col(role_col).alias("role"), "text").mapInArrow(
        _format, "id long, turn long, seq long, formatted string, loss_start long, loss_end long"
    )


class _Digest:
    def __init__(self, id_) -> None:
        self.id, self.turns, self.chars, self.loss_chars = id_, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, end: int) -> None:
        role, text = read_turn(formatted)
        masked = unescape(formatted[start:end])
        self.turns += 1
        self.chars += len(formatted)
        self.loss_chars += len(masked)
        self.all.update(f"{role}\n{text}\n".encode())
        self.loss.update(masked.encode())

    def row(self) -> tuple:
        return self.id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def out(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    current: _Digest | None = None
    for batch in batches:
        done: list[tuple] = []
        for id_, formatted, start, end in zip(*(batch.column(c).to_pylist() for c in ("id", "formatted", "loss_start", "loss_end")), strict=True):
            if current is None or current.id != id_:
                if current is not None:
                    done.append(current.row())
                current = _Digest(id_)
            current.add(formatted, start, end)
        yield out(done)
    if current is not None:
        yield out([current.row()])


def chat_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted turns.

    Conversations are spread by id and streamed in turn order: a task holds
    one row and two running digests, however long a conversation is.
    """
    ordered = formatted.repartition("id").sortWithinPartitions("id", "turn", "seq")
    return ordered.select("id", "formatted", "loss_start", "loss_end").mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


#: Turns a record holds at most when conversations are written as records.
RECORD_TURNS = 64


def as_records(conversations: DataFrame) -> DataFrame:
    """Conversations as JSON records in the layouts of ``MAPPINGS``.

    Conversations of a prompt and a response take the prompt layout, those of
    system, user and assistant the instruction layout; the rest is dealt to the
    message layouts by id. Turns come by number, null first; those of one number
    by role and text. A record holds ``RECORD_TURNS`` turns at most, whatever
    their numbers, so no conversation gathers whole. Null roles and texts read
    back empty; rows with a null ``conv_id`` are one conversation.
    """
    rows = conversations.select(
        F.col("conv_id").alias("id"), "turn", F.col("role").alias("r"), F.coalesce("text", F.lit("")).alias("x")
    ).withColumn("part", F.coalesce(F.floor(F.col("turn") / RECORD_TURNS), F.lit(0)))
    # numbers may repeat: a window streams the rows of a part and cuts it into records
    place = F.row_number().over(Window.partitionBy("id", "part").orderBy("turn", "r", "x")) - 1
    rows = rows.withColumn("cut", F.floor(place / RECORD_TURNS))
    parts = rows.groupBy("id", "part", "cut").agg(F.array_sort(F.collect_list(F.struct("turn", "r", "x"))).alias("t"))
    role = F.transform("t", lambda t: t["r"])
    one = lambda i: F.element_at("t", i)["x"]
    short = (F.col("part") == 0) & (F.col("cut") == 0)
    pick = F.pmod(F.col("id"), F.lit(3))

    def listed(name: str, who: str, what) -> Column:
        return F.to_json(F.struct(F.transform("t", lambda t: F.struct(t["r"].alias(who), what(t))).alias(name)), {"ignoreNullFields": "false"})

    record = (
        F.when(short & (role == F.array(F.lit("user"), F.lit("assistant"))), F.to_json(F.struct(one(1).alias("prompt"), one(2).alias("response"))))
        .when(
            short & (role == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))),
            F.to_json(F.struct(one(1).alias("instruction"), one(2).alias("input"), one(3).alias("output"))),
        )
        .when(pick == 0, listed("messages", "role", lambda t: t["x"].alias("content")))
        .when(pick == 1, listed("conversations", "from", lambda t: t["x"].alias("value")))
        .otherwise(listed("dialog", "speaker", lambda t: F.struct(t["x"].alias("text")).alias("utterance")))
    )
    base = F.shiftleft(F.col("part").cast("long"), 32) + F.col("cut") * RECORD_TURNS
    return parts.select("id", base.alias("base"), record.alias("record"))


def query(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    turns = map_records(as_records(rows.unionByName(probe)))
    return chat_digests(format_chats(turns, role_col="own_role"))


_ESCAPED = "(length(replace(replace(replace({x}, '\\', '\\\\'), '### ', '\\### '), '</turn>', '\\</turn>')))"
ORACLE_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + {_ESCAPED.format(x="role")} + length(role) - length(replace(role, chr(10), '')) + 1 + {_ESCAPED.format(x="text")} + 8)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

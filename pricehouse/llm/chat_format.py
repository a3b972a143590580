"""Chat formatting: layouts are told by a fingerprint of their fields.

The nested field paths of a record (``messages[].role``), sorted and hashed, select
a declarative mapping to canonical turns (conv_id, turn, role, text). The schema of a table of
turns is looked up the same way. Without an exact match the largest layout whose fields are
all there is taken, if no other filled field of a record is one that layouts have texts in: a record
that mixes two layouts is not guessed at, so no text is lost. A record without a mapping is
returned as such, with a NULL role. A table of turns is read as one whatever other columns it has.

Turns are formatted as a stream: sorted by conversation and turn inside their partition
and read once, so a conversation of any length needs the memory of one turn. Each turn
becomes one segment of the conversation's formatted text, with the characters that
count for the loss.

Defined cases: NULL texts and roles are empty; turns without a number come first, equal
numbers by role and text; repeated rows are turns of their own; a NULL conv_id is one
conversation; very long texts are turns like others, and a conversation of many turns is one
stream in one task; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"

#: Role whose texts count for the loss.
LEARNED = "assistant"


@dataclass(frozen=True)
class Layout:
    """Field paths of a layout, and where its turns are.

    ``turns`` lists (role, path) pairs of single fields; ``each`` names a list and, in
    it, the role and text fields. Where both are given, the single fields come first.
    """

    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


_LAYOUTS = (
    Layout(("conv_id", "turn", "role", "text")),
    Layout(("prompt", "completion"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout(("prompt", "response"), turns=(("user", "prompt"), ("assistant", "response"))),
    Layout(("system", "prompt", "response"), turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout(("instruction", "output"), turns=(("user", "instruction"), ("assistant", "output"))),
    Layout(("instruction", "input", "output"), turns=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout(("question", "answer"), turns=(("user", "question"), ("assistant", "answer"))),
    Layout(("messages[].role", "messages[].content"), each=("messages", "role", "content")),
    Layout(("conversations[].from", "conversations[].value"), each=("conversations", "from", "value")),
)
# Messages whose content is a list of parts, and layouts with a system text beside them.
_LAYOUTS += (Layout(("messages[].role", "messages[].content[].text"), each=("messages", "role", "content")),)
_LAYOUTS += tuple(
    Layout(("system", *x.paths), (("system", "system"), *x.turns), x.each)
    for x in _LAYOUTS
    if (x.turns or x.each) and "system" not in x.paths and {"system", *x.paths} not in [set(y.paths) for y in _LAYOUTS]
)
LAYOUTS = {fingerprint(x.paths): x for x in _LAYOUTS}
#: The largest first; of equal ones lists of turns, then in the order above.
_BY_SIZE = sorted(_LAYOUTS, key=lambda x: (-len(x.paths), x.each is None))

#: Role names of other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def paths_of(value, at: str = "") -> set[str]:
    """The nested field paths of a parsed record."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths_of(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in paths_of(v, f"{at}[]")} or {f"{at}[]"}
    return {at}


def _fields(paths: Iterable[str]) -> set[str]:
    """The outermost fields of paths."""
    return {re.split(r"[.\[]", p, maxsplit=1)[0] for p in paths}


#: Fields in which some layout has texts.
_TEXTS = _fields(p for x in _LAYOUTS for p in x.paths) - {"conv_id", "turn"}


def layout_of(paths: set[str], filled: set[str] | None = None) -> Layout | None:
    """The mapping of a record or table with these fields; None where it would leave known texts out.

    ``filled``: the outermost fields that are not empty, if that is known.
    """
    found = LAYOUTS.get(fingerprint(paths)) or next((x for x in _BY_SIZE if paths.issuperset(x.paths)), None)
    held = _fields(paths) if filled is None else filled
    return None if found and (held - _fields(found.paths)) & _TEXTS else found


def _schema_paths(kind: T.DataType, at: str = "") -> set[str]:
    if isinstance(kind, T.StructType):
        return {p for f in kind.fields for p in _schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)}
    if isinstance(kind, T.ArrayType):
        return _schema_paths(kind.elementType, f"{at}[]")
    return {at}


_TURNS = "conv_id bigint, turn bigint, role string, text string"


def table_turns(table: DataFrame) -> DataFrame:
    """Canonical turns of a table whose schema is a known layout.

    Layouts other than rows of turns need a ``conv_id`` column beside their fields.
    """
    paths = _schema_paths(table.schema)
    turns = _LAYOUTS[0]
    layout = turns if paths.issuperset(turns.paths) else layout_of(paths) or layout_of(paths - {"conv_id"})
    if layout is None:
        raise ValueError("no mapping for these fields: " + ", ".join(sorted(_schema_paths(table.schema))))
    ids = F.col("conv_id").cast("bigint").alias("conv_id")
    if not layout.turns and not layout.each:
        return table.select(ids, F.col("turn").cast("bigint"), "role", "text")
    lists = []
    if layout.turns:
        lists.append(F.array(*[F.struct(F.lit(r).alias("role"), F.col(p).cast("string").alias("text")) for r, p in layout.turns]))
    if layout.each:
        items, role, text = layout.each
        in_parts = f"{items}[].{text}[].text" in layout.paths
        said = (lambda x: F.array_join(F.transform(x[text], lambda p: p["text"]), "")) if in_parts else (lambda x: x[text])
        each = F.transform(
            F.col(items), lambda x: F.struct(x[role].cast("string").alias("role"), said(x).cast("string").alias("text"))
        )
        lists.append(F.coalesce(each, F.array().cast("array<struct<role:string,text:string>>")))
    turns = F.concat(*lists)
    spread = table.select(ids, F.posexplode(turns).alias("turn", "t"))
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return spread.select(
        "conv_id", F.col("turn").cast("bigint"), F.coalesce(known[F.col("t.role")], "t.role").alias("role"), "t.text"
    )


def turns_of(record: str | None) -> list[tuple[str | None, str | None]] | None:
    """(role, text) pairs of a JSON record, None without a mapping."""
    try:
        value = json.loads(record or "")
    except ValueError:
        return None
    if not isinstance(value, dict):
        return None
    layout = layout_of(paths_of(value), {k for k, v in value.items() if v not in (None, "", [], {})})
    if layout is None:
        return None
    found = [(role, _said(value.get(path))) for role, path in layout.turns]
    if layout.each:
        items, role, body = layout.each
        for m in value[items]:
            name = m.get(role) if isinstance(m, dict) else None
            name = name if name is None or isinstance(name, str) else json.dumps(name, ensure_ascii=False)
            found.append((ROLES.get(name, name), _said(m.get(body) if isinstance(m, dict) else m)))
    return found if layout.turns or layout.each else [(_said(value["role"]), _said(value["text"]))]


def _said(value) -> str | None:
    """A text; the texts of a list of parts; anything else as JSON."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, list):
        texts = [p.get("text") if isinstance(p, dict) and isinstance(p.get("text"), str) else p for p in value]
        return "".join(t if isinstance(t, str) else json.dumps(t, ensure_ascii=False) for t in texts)
    return json.dumps(value, ensure_ascii=False)


def record_turns(records: DataFrame) -> DataFrame:
    """Canonical turns of (conv_id, record) rows, each record JSON text of some layout.

    A record without a mapping is one row with turn -1, a NULL role and the record as text.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for conv, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                turns = turns_of(record)
                if turns is None:
                    rows.append((conv, -1, None, record))
                else:
                    rows += [(conv, i, role, text) for i, (role, text) in enumerate(turns)]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["conv_id", "turn", "role", "text"]
            )

    return records.select(F.col("conv_id").cast("bigint"), F.col("record").cast("string")).mapInArrow(run, _TURNS)


_OPENING, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_SEGMENT = re.compile(re.escape(START) + r"(.*?)\n(.*)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    """The text without any ``<|``: each such opening gets one more backslash inside."""
    return _OPENING.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def segment(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A formatted turn and the characters of it, from and to, that count for the loss."""
    head, body = f"{START}{_role_out(role or '')}\n", escape(text or "")
    end = len(head) + len(body) if role == LEARNED else len(head)
    return f"{head}{body}{END}\n", len(head), end


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of a segment."""
    found = _SEGMENT.fullmatch(formatted)
    return _role_in(found[1]), unescape(found[2])


_SEGMENTS = "conv_id bigint, position bigint, segment string, loss_from int, loss_to int"


def _formatted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, position = object(), 0
    for batch in batches:
        convs, roles, texts = (batch.column(i).to_pylist() for i in (0, 2, 3))
        places, made = [], []
        for own, role, text in zip(convs, roles, texts):
            conv, position = (own, position + 1) if own == conv else (own, 0)
            places.append(position)
            made.append(segment(role, text))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(places, pa.int64()), pa.array([m[0] for m in made], pa.string()),
                pa.array([m[1] for m in made], pa.int32()), pa.array([m[2] for m in made], pa.int32()),
            ],
            ["conv_id", "position", "segment", "loss_from", "loss_to"],
        )


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation, from its segments alone."""
    done: list[tuple] = []
    conv, state = None, None

    def closed():
        n, turns, chars, loss, total = state
        return conv, n, turns.hexdigest(), chars, loss.hexdigest(), total

    def flush():
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )

    for batch in batches:
        for own, position, text, begin, end in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if position == 0:
                if state:
                    done.append(closed())
                conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, said = parse(text)
            learned = unescape(text[begin:end])
            state[0] += 1
            state[1].update(f"{role}\n{said}\n".encode())
            state[2] += len(learned)
            state[3].update(learned.encode())
            state[4] += len(text)
        yield flush()
        done.clear()
    if state:
        done.append(closed())
        yield flush()


def _in_order(turns: DataFrame) -> DataFrame:
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    return turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(*order)


def format_turns(turns: DataFrame) -> DataFrame:
    """The segments of every conversation: conv_id, position, segment, loss_from, loss_to.

    A conversation's formatted text is its segments in order of position.
    """
    return _in_order(turns).mapInArrow(_formatted, _SEGMENTS)


def digests(turns: DataFrame) -> DataFrame:
    """Counts and digests of every conversation, read back from its formatted segments."""
    return _in_order(turns).mapInArrow(
        lambda batches: _digested(_formatted(batches)),
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )

"""Chat formatting by schema fingerprints.

A record is a JSON document in any of several layouts.  Its *fingerprint* is
the hash of the set of its nested field paths (list indexes left out).  Paths
that no layout names (ids, metadata, names of speakers) are set aside and
reported as ``extra_fields``; the fingerprint of the others selects one
declarative ``Layout``, which says where the turns are and how roles are
called.  A record that mixes the paths of two layouts matches neither, so no
text that some layout would show is left out unseen.  A new layout is a new
table entry, not new code.

Canonical turns are written as ``<|im_start|>role`` newline ``text``
``<|im_end|>`` newline.  Inside roles and texts every ``<`` + k backslashes + ``|``
gets one more backslash, so no text can hold a control string, and taking one
backslash away restores it exactly; in roles backslashes and line breaks are
escaped as well.  The loss mask is a list of spans (code points of the
formatted string) that cover exactly the assistant's texts.

Defined results: records with an unknown fingerprint (also invalid JSON, JSON
nested too deeply to be read, and no object at all) keep their row, with NULL
layout and output, here and in ``digests``; NULL, empty and missing texts and
roles of a turn are empty, an item that is no object is no turn; code points
that no UTF-8 text can hold (lone surrogates) become U+FFFD; turns of equal
number are ordered by role and text; a conversation id of NULL is one
conversation; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import ship_package

START, END = "<|im_start|>", "<|im_end|>"
_OPEN = re.compile(r"<(\\*)\|")
_CLOSED = re.compile(r"<\\(\\*)\|")
_LONE = re.compile("[\ud800-\udfff]")


@dataclass(frozen=True)
class Layout:
    """Either a list of turns (``turns``: path of the list, ``role`` and
    ``text``: paths inside an item) or named ``fields`` ((path, role), ...),
    one turn each."""

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


LAYOUTS = (
    Layout("messages", "messages", "role", "content"),
    Layout("message_parts", "messages", "role", "content[].text"),
    Layout("from_value", "conversations", "from", "value", roles={"human": "user", "gpt": "assistant"}),
    Layout("dialog", "data.dialog", "speaker", "utterance", roles={"customer": "user", "agent": "assistant"}),
    Layout("prompt", fields=(("prompt", "user"), ("completion", "assistant"))),
    Layout("prompt_response", fields=(("system", "system"), ("prompt", "user"), ("response", "assistant"))),
    Layout("instruction", fields=(("instruction", "user"), ("output", "assistant"))),
    Layout("instruction_input", fields=(("instruction", "system"), ("input", "user"), ("output", "assistant"))),
)


def field_paths(value: object, at: str = "") -> Iterator[str]:
    """Paths of all leaves; a list adds ``[]`` whatever its length."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from field_paths(v, f"{at}.{k}" if at else k)
    elif isinstance(value, list):
        for v in value:
            yield from field_paths(v, f"{at}[]")
    else:
        yield at


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def layout_paths(layout: Layout) -> set[str]:
    if layout.turns:
        return {f"{layout.turns}[].{layout.role}", f"{layout.turns}[].{layout.text}"}
    return {p for p, _ in layout.fields}


def registry(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    return {fingerprint(layout_paths(x)): x for x in layouts}


def vocabulary(layouts: tuple[Layout, ...] = LAYOUTS) -> set[str]:
    """The paths that some layout names."""
    return set().union(*map(layout_paths, layouts))


def _at(value: object, path: str) -> str:
    """The text at a path; lists on the way are joined; what is NULL, empty or
    missing is the empty text."""
    while path:
        if isinstance(value, list):
            return "".join(_at(v, path) for v in value)
        if not isinstance(value, dict):
            return ""
        step, _, path = path.partition(".")
        value = value.get(step.removesuffix("[]"))
        if step.endswith("[]"):
            return "".join(_at(v, path) for v in value) if isinstance(value, list) else ""
    if value is None or value in ([], {}):
        return ""
    return _LONE.sub("\ufffd", value if isinstance(value, str) else json.dumps(value, ensure_ascii=False))


def canonical_turns(record: dict, layout: Layout) -> list[tuple[str, str]]:
    if not layout.turns:
        return [(role, _at(record, path)) for path, role in layout.fields]
    items: object = record
    for step in layout.turns.split("."):
        items = items[step]
    turns = [(_at(x, layout.role), _at(x, layout.text)) for x in items if isinstance(x, dict)]
    return [(layout.roles.get(role, role), text) for role, text in turns]


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CLOSED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string and the loss spans."""
    out, loss, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{_escape_role(role)}\n", escape(text)
        if role == "assistant":
            loss.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    turns = []
    for part in formatted.split(START)[1:]:
        head, _, rest = part.partition("\n")
        turns.append((_unescape_role(head), unescape(rest[: rest.rindex(END)])))
    return turns


def masked_texts(formatted: str, loss: list[tuple[int, int]]) -> list[str]:
    return [unescape(formatted[a:b]) for a, b in loss]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def read_record(raw: str | None, known: dict[str, Layout], named: set[str]) -> tuple:
    """(fingerprint, layout's name, formatted, loss, extra fields) of one record."""
    mark = None
    try:
        record = json.loads(raw) if raw is not None else None
        if not isinstance(record, dict):
            return None, None, None, None, None
        paths = set(field_paths(record))
        mark = fingerprint(paths)
        layout = known.get(fingerprint(paths & named))
        if layout is None:
            return mark, None, None, None, None
        text, loss = format_turns(canonical_turns(record, layout))
    except (ValueError, RecursionError):
        return mark, None, None, None, None
    return mark, layout.name, text, [{"start": a, "end": b} for a, b in loss], sorted(_LONE.sub("\ufffd", p) for p in paths - named)


def _format_batches(layouts: tuple[Layout, ...]):
    kinds = (pa.string(), pa.string(), pa.string(), _SPANS, pa.list_(pa.string()))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, named = registry(layouts), vocabulary(layouts)
        for batch in it:
            columns = list(zip(*(read_record(raw, known, named) for raw in batch.column(1).to_pylist()), strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["id", "fingerprint", "layout", "formatted", "loss", "extra_fields"])

    return run


def format_chats(records: DataFrame, id_column: str = "conv_id", record: str = "record",
                 layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """id, fingerprint, layout, formatted, loss (spans), extra_fields of each
    JSON record."""
    ship_package(records.sparkSession)
    d = records.select(id_column, record)
    return d.mapInArrow(
        _format_batches(layouts),
        f"`{id_column}` {d.schema[0].dataType.simpleString()}, fingerprint string, layout string, formatted string, "
        "loss array<struct<start:bigint,end:bigint>>, extra_fields array<string>")


def conversations_as_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): each conversation as one JSON record, in the layout
    its shape suggests: a question and its answer become prompt records, with
    a system turn instruction records, longer ones message lists of three
    dialects."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    c = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    t = F.col("ts")
    role = F.transform(t, lambda x: x["role"])
    kind = F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)), F.lit(4))
    whole = {"ignoreNullFields": "false"}

    def renamed(names: dict[str, str]):
        def of(r):
            out = r
            for new, old in names.items():
                out = F.when(r == old, F.lit(new)).otherwise(out)
            return out
        return of

    # A dialect's own role names must not occur as roles, or reading back
    # would take them for the others.
    def free(*names: str):
        return ~F.exists(role, lambda r: r.isin(*names))

    gpt, agent = renamed({"human": "user", "gpt": "assistant"}), renamed({"customer": "user", "agent": "assistant"})
    three = (F.size(t) == 3) & (F.get(t, F.lit(0))["role"] == "system") & (F.get(t, F.lit(1))["role"] == "user") & (F.get(t, F.lit(2))["role"] == "assistant")
    get = lambda i: F.get(t, F.lit(i))["text"]
    two = (F.size(t) == 2) & (F.get(t, F.lit(0))["role"] == "user") & (F.get(t, F.lit(1))["role"] == "assistant")
    record = (
        F.when(two & (kind < 2), F.to_json(F.struct(get(0).alias("prompt"), get(1).alias("completion")), whole))
        .when(two, F.to_json(F.struct(get(0).alias("instruction"), get(1).alias("output")), whole))
        .when(three & (kind < 2), F.to_json(F.struct(get(0).alias("system"), get(1).alias("prompt"), get(2).alias("response")), whole))
        .when(three, F.to_json(F.struct(get(0).alias("instruction"), get(1).alias("input"), get(2).alias("output")), whole))
        .when((kind == 1) & free("human", "gpt"), F.to_json(F.struct(F.transform(
            t, lambda x: F.struct(gpt(x["role"]).alias("from"), x["text"].alias("value"))).alias("conversations")), whole))
        .when((kind == 2) & free("customer", "agent"), F.to_json(F.struct(F.struct(F.transform(
            t, lambda x: F.struct(agent(x["role"]).alias("speaker"), x["text"].alias("utterance"))).alias("dialog")).alias("data")), whole))
        .when(kind == 3, F.to_json(F.struct(F.transform(t, lambda x: F.struct(
            x["role"].alias("role"), F.array(F.struct(x["text"].alias("text"))).alias("content"))).alias("messages")), whole))
        .otherwise(F.to_json(F.struct(F.transform(
            t, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages")), whole)))
    return c.select("conv_id", record.alias("record"))


def _digest_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        rows = []
        for formatted, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if formatted is None:
                rows.append((None,) * 5)
                continue
            turns = parse(formatted)
            masked = masked_texts(formatted, [(x["start"], x["end"]) for x in loss])
            rows.append((
                len(turns),
                hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                sum(map(len, masked)), hashlib.sha256("".join(masked).encode()).hexdigest(), len(formatted)))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, t in zip(
                columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)]],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the formatted strings and their masks; NULLs
    for records that were not formatted."""
    ship_package(formatted.sparkSession)
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        _digest_batches,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

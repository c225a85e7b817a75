"""Chat formatting: records of many layouts to one template, and back.

A record is JSON. Its fingerprint is a hash of its nested field paths (those that some
layout knows), and picks the declarative layout that says where roles and texts stand: the
first one all of whose fields are there, whatever other fields the record has.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside
roles and texts are broken by a backslash after their first character, and a backslash is
doubled, so none is left in a text and escaping can be undone. The loss mask covers the
assistant's texts and nothing else.

Defined results: null texts and roles are empty. A text that is a list has the texts of its
parts, joined; a part without a text (an image, say) adds nothing. A record that is null, not
JSON, nested too deeply to read, of no known layout or with a turn that is no object has
``layout`` null and no turns; ``unread`` counts these. Half of a surrogate pair, which no text
can hold, becomes U+FFFD. Rows of a conversation are ordered by turn,
then by role and text; repeated rows stay. A conversation becomes one row, so the longest
one must fit into a task; conversations as such are never gathered.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import stage

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Strings that steer a model in some widely used template.
CONTROLS = (
    OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"
)
LEARNED_ROLE = "assistant"

TURNS = "array<struct<role:string,text:string>>"

# --- layouts ------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Where a record keeps its turns.

    Either ``items`` names a list of turns with fields ``role`` and ``text`` (where a text is
    made of parts, ``inside`` is the path in there), or ``parts``
    lists roles with the fields whose texts, joined by a blank line, are theirs. Fields
    in ``optional`` may be absent. ``roles`` renames roles.
    """

    name: str
    items: str = ""
    role: str = ""
    text: str = ""
    inside: str = ""
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self) -> set[str]:
        if self.items:
            inner = {f"{self.items}[].{self.role}", f"{self.items}[].{self.text}{self.inside}"}
            return inner | {*self.optional}
        return {name for _, names in self.parts for name in names} | {*self.optional}

    def required(self) -> set[str]:
        return self.paths() - {*self.optional}

    def turns(self, record: dict) -> list[tuple[str, str]] | None:
        """None where a turn is no object."""
        if self.items:
            turns = [("system", _text(record["system"]))] if record.get("system") else []
            for turn in record[self.items]:
                if not isinstance(turn, dict):
                    return None
                role = _text(turn.get(self.role))
                turns.append((self.roles.get(role, role), _text(turn.get(self.text))))
            return turns
        turns = []
        for role, names in self.parts:
            texts = [_text(record.get(name)) for name in names]
            if any(name in record for name in names):
                turns.append((role, "\n\n".join(text for text in texts if text)))
        return [turn for turn in turns if turn[0] != "system" or turn[1]]


_SHARED = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

LAYOUTS = (
    Layout("turns", items="turns", role="role", text="text"),
    Layout("messages", items="messages", role="role", text="content", optional=("system",)),
    Layout(
        "parts",
        items="messages",
        role="role",
        text="content",
        inside="[].text",
        optional=("system",),
    ),
    Layout(
        "shared",
        items="conversations",
        role="from",
        text="value",
        optional=("system",),
        roles=_SHARED,
    ),
    Layout(
        "instruction",
        parts=(
            ("system", ("system",)),
            ("user", ("instruction", "input")),
            ("assistant", ("output",)),
        ),
        optional=("system", "input"),
    ),
    Layout(
        "completion",
        parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))),
        optional=("system",),
    ),
    Layout(
        "response",
        parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
        optional=("system",),
    ),
    Layout("question", parts=(("user", ("question",)), ("assistant", ("answer",)))),
)


def _text(value) -> str:
    if isinstance(value, list):
        parts = (one.get("text") if isinstance(one, dict) else one for one in value)
        return "".join(part for part in parts if isinstance(part, str))
    return value if isinstance(value, str) else "" if value is None else json.dumps(value)


def _whole(text: str) -> str:
    """The text without halves of surrogate pairs, which JSON can write and no text can hold."""
    if text.isascii():
        return text
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def field_paths(value, path: str = "") -> set[str]:
    """Paths of all leaves; list items share one path. An empty list has the path of the list."""
    if isinstance(value, dict) and value:
        start = f"{path}." if path else ""
        return set().union(*(field_paths(one, start + name) for name, one in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(one, f"{path}[]") for one in value))
    return {path}


def fingerprint(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode("utf-8", "replace"), digest_size=8).hexdigest()


class Registry:
    """Layouts by the fingerprints of the fields that some layout knows."""

    def __init__(self, layouts: tuple[Layout, ...] = LAYOUTS):
        self.all = layouts
        self.known = set().union(*(layout.paths() for layout in layouts))
        self.layouts: dict[str, Layout | None] = {}

    def _layout(self, print_: str, paths: set[str]) -> Layout | None:
        if print_ not in self.layouts:
            fitting = (layout for layout in self.all if layout.required() <= paths)
            self.layouts[print_] = next(fitting, None)
        return self.layouts[print_]

    def read(self, record: str | None) -> tuple[str | None, str | None, list[tuple[str, str]]]:
        """Fingerprint, layout and turns of a record."""
        try:
            value = json.loads(record or "")
            if not isinstance(value, dict):
                return None, None, []
            paths = field_paths(value) & self.known
            print_ = fingerprint(paths)
            layout = self._layout(print_, paths)
            turns = layout.turns(value) if layout else None
        except (ValueError, RecursionError):
            return None, None, []
        if turns is None:
            return print_, None, []
        return print_, layout.name, [(_whole(role), _whole(text)) for role, text in turns]


# --- template -----------------------------------------------------------------------

_ESCAPED = re.compile("|".join(map(re.escape, sorted(("\\", *CONTROLS), key=len, reverse=True))))
_UNESCAPED = re.compile(r"\\(.)", re.DOTALL)
_ROLE = re.compile(r"((?:\\.|[^\\\n])*)\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the ranges that a model learns from."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head = f"{OPEN}{escape(role)}".replace("\n", "\\\n") + "\n"
        body = escape(text)
        if role == LEARNED_ROLE:
            mask.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}{CLOSE}\n")
        at += len(parts[-1])
    return "".join(parts), mask


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted conversation."""
    at = 0
    while at < len(formatted):
        head = _ROLE.match(formatted, at + len(OPEN))
        end = formatted.index(CLOSE, head.end())
        yield unescape(head[1]), unescape(formatted[head.end() : end])
        at = end + len(CLOSE) + 1


# --- jobs ---------------------------------------------------------------------------


#: How ``records`` writes conversations of any number of turns, and those of one question.
LONG_LAYOUTS = ("turns", "messages", "parts", "shared")
PAIR_LAYOUTS = ("instruction", "completion", "response", "question")


def _told(turns: Column, layout: str) -> Column:
    """Turns (``role, text``) as JSON of a layout."""
    asked, said = (turns[place]["text"] for place in (0, 1))
    if layout == "turns":
        return F.to_json(F.struct(turns.alias("turns")))
    if layout == "messages":
        all_ = F.transform(turns, lambda t: F.struct(t["role"], t["text"].alias("content")))
        return F.to_json(F.struct(all_.alias("messages"), F.lit("").alias("prompt")))
    if layout == "parts":

        def part(turn):
            text = F.struct(F.lit("text").alias("type"), turn["text"].alias("text"))
            return F.struct(turn["role"], F.array(text).alias("content"))

        return F.to_json(F.struct(F.transform(turns, part).alias("messages")))
    if layout == "shared":

        def shared(turn):
            name = F.when(turn["role"] == "user", "human").when(turn["role"] == "assistant", "gpt")
            return F.struct(
                F.coalesce(name, turn["role"]).alias("from"), turn["text"].alias("value")
            )

        return F.to_json(F.struct(F.transform(turns, shared).alias("conversations")))
    names = {
        "instruction": ("instruction", "output"),
        "completion": ("prompt", "completion"),
        "response": ("prompt", "response"),
        "question": ("question", "answer"),
    }[layout]
    return F.to_json(F.struct(asked.alias(names[0]), said.alias(names[1])))


def records(rows: DataFrame, conv_id: str = "conv_id", mixed: bool = False) -> DataFrame:
    """One ``record`` per conversation, from one row per turn.

    Records are of the layout ``turns``, or, if ``mixed``, of all layouts in turn by id: a
    question with its answer of any, a conversation whose roles another layout would rename of
    ``turns``, and others of those that hold any number of turns.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    grouped = rows.groupBy(F.col(conv_id).alias("conv_id"))
    grouped = grouped.agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    turns = F.transform("turns", lambda one: F.struct(one["role"], one["text"])).cast(TURNS)
    told = grouped.select("conv_id", turns.alias("turns"))
    record = _told(F.col("turns"), "turns")
    if mixed:
        number = F.pmod(F.col("conv_id").cast("long"), F.lit(len(LONG_LAYOUTS + PAIR_LAYOUTS)))
        role = [F.try_element_at("turns.role", F.lit(place)) for place in (1, 2)]
        pair = (F.size("turns") == 2) & (role[0] == "user") & (role[1] == "assistant")
        renamed = F.exists("turns", lambda one: one["role"].isin(*_SHARED))
        for place, layout in enumerate(LONG_LAYOUTS + PAIR_LAYOUTS):
            fits = pair if layout in PAIR_LAYOUTS else ~renamed
            wanted = number if layout in PAIR_LAYOUTS else number % len(LONG_LAYOUTS)
            chosen = fits & (wanted == place)
            record = F.when(chosen, _told(F.col("turns"), layout)).otherwise(record)
    return told.select("conv_id", record.alias("record"))


def unread(formatted: DataFrame) -> DataFrame:
    """One row: ``records``, and how many of them have no known layout."""
    return formatted.agg(
        F.count("*").alias("records"), F.count_if(F.col("layout").isNull()).alias("unread")
    )


_FORMATTED = (
    "formatted string, mask array<struct<start:int,end:int>>, fingerprint string, layout string"
)
_MASK = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def format_records(data: DataFrame, record: str = "record", layouts=LAYOUTS) -> DataFrame:
    """``conv_id`` with ``formatted``, ``mask``, ``fingerprint`` and ``layout``."""

    def write(batches):
        registry = Registry(layouts)
        for batch in batches:
            told, mask, prints, names = [], [], [], []
            for one in batch.column(1).to_pylist():
                print_, name, turns = registry.read(one)
                text, ranges = render(turns)
                told.append(text)
                mask.append([{"start": a, "end": b} for a, b in ranges])
                prints.append(print_)
                names.append(name)
            columns = [batch.column(0), pa.array(told, pa.string()), pa.array(mask, _MASK)]
            columns += [pa.array(prints, pa.string()), pa.array(names, pa.string())]
            yield pa.RecordBatch.from_arrays(
                columns, ["conv_id", "formatted", "mask", "fingerprint", "layout"]
            )

    kind = data.schema["conv_id"].dataType.simpleString()
    return data.select("conv_id", record).mapInArrow(write, f"conv_id {kind}, {_FORMATTED}")


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id`` with ``turns``, ``learned`` (all text under the mask, unescaped), ``layout``."""

    def read(batches):
        for batch in batches:
            turns, learned = [], []
            for text, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns.append([{"role": role, "text": body} for role, body in parse(text)])
                learned.append("".join(unescape(text[m["start"] : m["end"]]) for m in mask))
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            columns = [batch.column(0), pa.array(turns, kind), pa.array(learned, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column(1), batch.column(3)],
                ["conv_id", "turns", "learned", "formatted", "layout"],
            )

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "formatted", "mask", "layout").mapInArrow(
        read, f"conv_id {kind}, turns {TURNS}, learned string, formatted string, layout string"
    )


def write_and_read(data: DataFrame) -> DataFrame:
    """Format all records, store the result, and read it back."""
    return read_back(stage(format_records(data), "formatted"))

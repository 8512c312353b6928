"""Chat formatting from an event log.

A log has one row per event of a message: ``open`` (with the text it begins
with), ``delta`` (text is added), ``edit`` and ``regenerate`` (text is replaced,
further deltas add to it) and ``remove``.
``format_log`` deals the log to tasks by ranges of (conversation, turn,
message), sorts each range by sequence, folds the events of each message into
its final text, and renders the messages of a conversation one after the other:

* the template marks every turn; in texts a control string gets one backslash
  behind its first character, which reading back removes again;
* the output is rows of parts of at most ``PART_CHARS`` characters (or one
  message) with the spans under the loss mask, so no conversation has to fit
  into one cell or one task: a range border may fall inside a conversation, and
  the parts of a long one are written by many tasks.

``digest`` reads the parts back.  Conversations that one task wrote in one part
are finished there; only the parts of the others (two conversations a range at
most, and the long ones) are dealt by conversation and hashed in order, as a
stream, since a hash over a whole conversation is sequential by its nature.

Edge cases: null text is empty; a null role is the empty role; null
conversations form one conversation, null turns come first; messages of one
turn are ordered by role, then message name; equal rows stay separate messages;
a message is known from its first event on, and a removal is final; an event of another name stops the
job; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize

LOG_COLUMNS = ("conv_id", "turn", "role", "message", "seq", "event", "text")
PART_CHARS = 1_000_000
ROWS = 500  # rows of an output batch

# The marks around the text of each role; any other role is named in its mark
MARKS = {"user": ("<s>[INST] ", " [/INST]"), "system": ("<s>[SYS] ", " [/SYS]"), "assistant": (" ", "</s>")}
OTHER = ("<s>[ROLE {}] ", " [/ROLE]")
CONTROL = r"/?(?:s>|INST\]|SYS\]|ROLE)"

_ESCAPE = re.compile(rf"([<\[])(\\*{CONTROL})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*{CONTROL})")
_TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]|<s>\[SYS\] (?P<system>.*?) \[/SYS\]"
    r"|<s>\[ROLE (?P<name>[^\]]*)\] (?P<other>.*?) \[/ROLE\]| (?P<assistant>.*?)</s>", re.DOTALL)

SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
PARTS = pa.schema([("conv_id", pa.int64()), ("task", pa.int32()), ("part", pa.int64()), ("whole", pa.bool_()),
                   ("formatted", pa.large_string()), ("loss", SPANS)])
PARTS_DDL = "conv_id long, task int, part long, whole boolean, formatted string, loss array<struct<start: long, end: long>>"
DIGEST_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text) if "\\" in text else text


def render(role: str, text: str) -> tuple[str, str, str]:
    """(opening mark, escaped text, closing mark) of one turn."""
    left, right = MARKS.get(role) or (OTHER[0].format(quote(role, safe=" ")), OTHER[1])
    return left, escape(text), right


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a rendered part."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn begins at character {at}")
        kind = m.lastgroup
        yield unquote(m["name"]) if kind == "other" else kind, unescape(m[kind])
        at = m.end()


def event_log(conversations: DataFrame, piece: int = 512, draft: int = 40) -> DataFrame:
    """The log of clients that streamed each row of the table: every message is
    opened with a draft, then begun anew with its first piece (assistant turns
    are regenerated, others edited) and streamed in pieces of ``piece`` characters."""
    text = F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    # the text decides among messages of one turn and role, then the row itself
    rows = rows.withColumn("message", F.concat_ws(":", F.hex(F.xxhash64("text")), F.monotonically_increasing_id()))
    again = F.when(F.col("role") == "assistant", "regenerate").otherwise("edit")
    rows = rows.withColumn("pieces", F.regexp_extract_all("text", F.lit(f"[\\s\\S]{{1,{piece}}}"), F.lit(0)))

    def event(name, body):
        return F.struct(name.alias("event"), body.alias("text"))

    events = F.concat(
        F.array(event(F.lit("open"), F.substring("text", 1, draft)), event(again, F.coalesce(F.get("pieces", F.lit(0)), F.lit("")))),
        F.transform(F.slice("pieces", 2, F.greatest(F.size("pieces") - 1, F.lit(0))), lambda p: event(F.lit("delta"), p)))
    return (rows.select("conv_id", "turn", "role", "message", F.posexplode(events).alias("seq", "e"))
            .select("conv_id", "turn", "role", "message", F.col("seq").cast("long").alias("seq"), "e.event", "e.text"))


def _messages(batches) -> Iterator[tuple[int, str, str]]:
    """(conversation, role, final text) from a sorted log, message by message."""
    key, pieces, live = None, [], False
    for batch in batches:
        for *name, _, event, text in zip(*(c.to_pylist() for c in batch.columns)):
            if name != key:
                if live:
                    yield key[0], key[2] or "", "".join(pieces)
                key, pieces, live = name, [], True
            if event == "delta":
                pieces.append(text or "")
            elif event in ("open", "edit", "regenerate"):
                pieces = [text or ""]
            elif event == "remove":
                live = False
            else:
                raise ValueError(f"unknown event {event!r}")
    if live:
        yield key[0], key[2] or "", "".join(pieces)


def _in_batches(rows: Iterable[tuple], schema: pa.Schema, chars: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows as batches; ``chars`` is the place of a long text, which bounds a batch too."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[chars] or "") if chars is not None else 0
        if len(held) >= ROWS or size >= PART_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _render_parts(batches):
    """Parts of the conversations of one range, in order.  ``whole`` is set
    where the part surely is all of its conversation: the first and the last
    conversation of a range may go on in the next one."""
    task = TaskContext.get().partitionId()

    def rows():
        conv, out, loss, size, part, first = None, [], [], 0, 0, True
        started = False
        for c, role, text in _messages(batches):
            if started and (c != conv or size >= PART_CHARS):
                yield conv, task, part, c != conv and part == 0 and not first, "".join(out), loss
                first = first and c == conv
                part = part + 1 if c == conv else 0
                out, loss, size = [], [], 0
            conv, started = c, True
            left, body, right = render(role, text)
            if role == "assistant":
                loss.append({"start": size + len(left), "end": size + len(left) + len(body)})
            out += [left, body, right]
            size += len(left) + len(body) + len(right)
        if started:
            yield conv, task, part, False, "".join(out), loss

    yield from _in_batches(rows(), PARTS, 4)


def format_log(log: DataFrame) -> DataFrame:
    """Parts of every conversation: conv_id, task and part (their order), whole,
    formatted, and the loss spans in code points of ``formatted``."""
    order = ("conv_id", "turn", "role", "message")
    rows = log.select(*LOG_COLUMNS).repartitionByRange(*order).sortWithinPartitions(*order, "seq", "event", "text")
    return rows.mapInArrow(_render_parts, PARTS_DDL)


class _Reader:
    """Counts and hashes of one conversation, fed part by part."""

    def __init__(self):
        self.turns, self.loss, self.n, self.loss_chars, self.chars = sha256(), sha256(), 0, 0, 0

    def add(self, formatted: str, loss: list[dict]) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        for span in loss:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self, conv):
        return conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read_whole(batches):
    """Digests of whole conversations; other parts are passed on."""

    def rows():
        for batch in batches:
            for conv, task, part, whole, formatted, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if whole:
                    reader = _Reader()
                    reader.add(formatted, loss)
                    yield *reader.row(conv), None, None, None, None
                else:
                    yield conv, None, None, None, None, None, task, part, formatted, loss

    yield from _in_batches(rows(), pa.schema([*DIGEST, *[PARTS.field(n) for n in ("task", "part", "formatted", "loss")]]), 8)


def _read_parts(batches):
    """Digests of conversations whose parts follow each other."""

    def rows():
        reader, last = None, None
        for batch in batches:
            for conv, formatted, loss in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss"))):
                if reader is None or conv != last:
                    if reader:
                        yield reader.row(last)
                    reader, last = _Reader(), conv
                reader.add(formatted, loss)
        if reader:
            yield reader.row(last)

    yield from _in_batches(rows(), DIGEST)


def digest(parts: DataFrame) -> DataFrame:
    """conv_id, turns and their hash, text under the loss mask, size: all read
    back from the formatted parts."""
    names = [f.name for f in DIGEST]
    read = materialize(parts.mapInArrow(_read_whole, DIGEST_DDL + ", task int, part long, formatted string, loss array<struct<start: long, end: long>>"))
    split = (read.where("formatted is not null").select("conv_id", "task", "part", "formatted", "loss")
             .repartition("conv_id").sortWithinPartitions("conv_id", "task", "part"))
    return read.where("formatted is null").select(names).union(split.mapInArrow(_read_parts, DIGEST_DDL))

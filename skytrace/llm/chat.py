"""Chat formatting with typed content parts.

A turn's content is a list of parts. A visitor with one method per part type turns the list into
one text: text parts are escaped, image, audio and document parts become placeholders in order,
each with a reference to its attachment and the number of tokens it will expand to. Every turn is
formatted by itself, in parallel; a conversation is the concatenation of its turns by ``turn``.

A formatted turn is ``<s>role[INST]content[/INST]</s>`` and a line feed. Control strings all begin
with ``<`` or ``[``. In roles and texts a backslash is doubled and one is put behind every ``<`` and
``[``, so no control string can arise from a text, and reading back is exact: a pair of
backslashes stands for one, a single backslash for nothing.

Nulls and edges: a null text or part list is empty, a null role is the empty role, a null turn comes
first. Rows with a null ``conv_id`` form one conversation. Turns with equal numbers are ordered by
role and content; repeated rows are kept. Parts of an unknown type raise an error, as dropping them
would change the conversation. Other columns are ignored; an empty table gives no rows.

Reading back streams over turns sorted by conversation: a digest has to see its conversation in
order, but no more than one turn is held at a time.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.llm import text as T

BEGIN, BODY, BODY_END, END = "<s>", "[INST]", "[/INST]", "</s>\n"
TRAINED_ROLE = "assistant"
IMAGE_PATCH = 14
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 512

PART = ("struct<type:string, text:string, uri:string, width:int, height:int, seconds:double, "
        "pages:int>")
TURNS = ("conv_id bigint, turn bigint, role string, formatted string, "
         "loss_begin bigint, loss_end bigint, attachments array<struct<part:int, type:string, "
         "uri:string, offset:bigint, tokens:bigint>>, expanded_tokens bigint")
DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
          "loss_sha256 string, formatted_chars bigint")

_ESCAPED = re.compile(r"\\(\\?)")
_OPENERS = re.compile(r"[<\[]")
_TURN = re.compile(r"<s>(.*?)\[INST\](.*?)\[/INST\]</s>\n", re.DOTALL)


def escape(text: str) -> str:
    return _OPENERS.sub(r"\g<0>\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flattener:
    """Visits the parts of one turn in order; ``text`` and ``attachments`` are what it has seen."""

    def __init__(self, base: int):
        self.base = base  # code points before the content
        self.pieces: list[str] = []
        self.length = 0
        self.attachments: list[dict] = []

    def visit(self, parts: Iterable[dict]) -> str:
        for number, part in enumerate(parts):
            kind = part.get("type") or "text"
            method = getattr(self, f"visit_{kind}", None)
            if method is None:
                raise ValueError(f"unknown content part type {kind!r}")
            method(number, part)
        return "".join(self.pieces)

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def _attach(self, number: int, part: dict, tokens: int) -> None:
        self.attachments.append({"part": number, "type": part["type"], "uri": part.get("uri"),
                                 "offset": self.base + self.length, "tokens": tokens})
        self._add(f"<{part['type']}>")

    def visit_text(self, number: int, part: dict) -> None:
        self._add(escape(part.get("text") or ""))

    def visit_image(self, number: int, part: dict) -> None:
        patches = [math.ceil((part.get(side) or 0) / IMAGE_PATCH) for side in ("width", "height")]
        self._attach(number, part, patches[0] * patches[1])

    def visit_audio(self, number: int, part: dict) -> None:
        self._attach(number, part,
                     math.ceil((part.get("seconds") or 0) * AUDIO_TOKENS_PER_SECOND))

    def visit_document(self, number: int, part: dict) -> None:
        self._attach(number, part, (part.get("pages") or 0) * DOCUMENT_TOKENS_PER_PAGE)


def format_turn(role: str | None, parts: Iterable[dict] | None) -> dict:
    """Formatted text, loss span in code points, attachments and expanded tokens of a turn."""
    head = f"{BEGIN}{escape(role or '')}{BODY}"
    visitor = Flattener(len(head))
    body = visitor.visit(parts or [])
    trained = (role or "") == TRAINED_ROLE
    return {
        "formatted": f"{head}{body}{BODY_END}{END}",
        "loss_begin": len(head) if trained else None,
        "loss_end": len(head) + len(body) if trained else None,
        "attachments": visitor.attachments,
        "expanded_tokens": sum(a["tokens"] for a in visitor.attachments),
    }


def _formatted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 1024):
            rows = batch.slice(begin, 1024).to_pylist()
            done = [{"conv_id": r["conv_id"], "turn": r["turn"], "role": r["role"]}
                    | format_turn(r["role"], r["parts"]) for r in rows]
            yield pa.RecordBatch.from_pylist(done, schema=_TURN_SCHEMA)


_TURN_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
    ("formatted", pa.string()), ("loss_begin", pa.int64()), ("loss_end", pa.int64()),
    ("attachments", pa.list_(pa.struct([
        ("part", pa.int32()), ("type", pa.string()), ("uri", pa.string()),
        ("offset", pa.int64()), ("tokens", pa.int64())]))),
    ("expanded_tokens", pa.int64())])


def text_part(text: Column) -> Column:
    """A part list with one text part."""
    empty = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("type"), text.cast("string").alias("text"),
        empty.cast("string").alias("uri"), empty.cast("int").alias("width"),
        empty.cast("int").alias("height"), empty.cast("double").alias("seconds"),
        empty.cast("int").alias("pages")))


def parts_from_json(content: Column) -> Column:
    """The part list of a JSON text such as ``[{"type": "image", "uri": …, "width": 640, …}]``."""
    return F.from_json(content, f"array<{PART}>")


def format_turns(turns: DataFrame) -> DataFrame:
    """One formatted row per row of ``turns`` (``conv_id``, ``turn``, ``role``, ``parts``)."""
    return turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.col("role").cast("string"), "parts").mapInArrow(_formatted, TURNS)


def in_order(formatted: DataFrame) -> DataFrame:
    """Turns of each conversation together and in order; partitions are sorted with spilling."""
    return formatted.repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "formatted")


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, begin: int | None, end: int | None) -> None:
        self.chars += len(formatted)
        for role, body in _TURN.findall(formatted):
            self.n_turns += 1
            self.turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
        if begin is not None:
            masked = unescape(formatted[begin:end])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.chars)


def _read_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done) if done else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names)

    current = None
    for batch in batches:
        done = []
        for conv_id, formatted, begin, end in zip(*(
                T.column(batch, n).to_pylist()
                for n in ("conv_id", "formatted", "loss_begin", "loss_end"))):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Digest(conv_id)
            current.add(formatted, begin, end)
        yield rows(done)
    if current is not None:
        yield rows([current.row()])


def digests(formatted: DataFrame) -> DataFrame:
    """What reading back each conversation's formatted text and loss mask gives."""
    return in_order(formatted).select(
        "conv_id", "formatted", "loss_begin", "loss_end").mapInArrow(_read_back, DIGEST)


def placeholder_report(formatted: DataFrame) -> DataFrame:
    """Attachment references of each turn as rows, in the order of their placeholders."""
    return formatted.select("conv_id", "turn", F.inline("attachments"))


def to_json(parts: list[dict]) -> str:
    """The JSON text that ``parts_from_json`` reads."""
    return json.dumps(parts, ensure_ascii=False)

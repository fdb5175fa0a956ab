"""Chat formatting with typed content parts.

A turn's content is a list of parts (``Text``, ``Image``, ``Audio``, ``Document``). A visitor walks
the parts in order: text is escaped, the others become placeholders numbered in order of appearance,
with an attachment reference and the number of tokens the placeholder expands to in the model.

Template. A turn is ``<s>[role] body </s>``: ``<s>[`` role ``] `` body `` </s>``. Control strings hold a
``<`` or ``[``; inside roles and texts every ``\\``, ``<``, ``[`` and ``]`` is preceded by a ``\\``, so no
control string can appear in escaped text, and removing the backslashes restores it. A null role is
written ``<s>[-] ``, a role that is really ``-`` is escaped. Placeholders are ``<image 1>``, ``<audio 2>``,
``<document 3>``. The loss mask covers the bodies' text of assistant turns, placeholders excluded.

At scale each turn is formatted by itself (rows are repartitioned by conversation and sorted inside
partitions), then read back and folded in one streaming pass: no conversation is gathered in memory,
so one that holds a third of all rows costs time on one task but no memory. Hashing a conversation is
sequential by definition.

Defined cases: null text is empty; turns are ordered by turn (null first), then role and text, so
repeated rows and ties give one result; a null conv_id is a conversation of its own; an empty table gives
only what the query adds; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPED = re.compile(r"[\\<\[\]]")
UNESCAPE = re.compile(r"\\(.)", re.S)
TURN = re.compile(r"<s>\[((?:[^\\\]]|\\.)*)\] (.*?) </s>", re.S)
PLACEHOLDER = re.compile(r"(?<!\\)((?:\\\\)*)<(image|audio|document) (\d+)>")


def escape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1", text)


@dataclass(frozen=True)
class Text:
    text: str

    def accept(self, visitor):
        return visitor.text(self)


@dataclass(frozen=True)
class Image:
    ref: str
    width: int = 0
    height: int = 0

    def accept(self, visitor):
        return visitor.image(self)


@dataclass(frozen=True)
class Audio:
    ref: str
    seconds: float = 0.0

    def accept(self, visitor):
        return visitor.audio(self)


@dataclass(frozen=True)
class Document:
    ref: str
    pages: int = 1

    def accept(self, visitor):
        return visitor.document(self)


KINDS = {"text": Text, "image": Image, "audio": Audio, "document": Document}


def parse_parts(content: str | list | None) -> list:
    """Parts from a plain string, a list of dicts with a ``type``, or their JSON text in ``parts``."""
    if content is None:
        return []
    if isinstance(content, str):
        return [Text(content)]
    out = []
    for p in content:
        kind = KINDS.get(p.get("type", "text"))
        if kind is None:
            raise ValueError(f"unknown content part {p.get('type')!r}")
        out.append(kind(**{k: v for k, v in p.items() if k != "type"}))
    return out


@dataclass
class Flatten:
    """The visitor: flattened body, attachment references, expanded token count.

    ``count`` counts the tokens of a text (default: words); an image takes ``tile_tokens`` per tile of
    ``tile`` pixels a side (one tile at least), audio ``audio_rate`` a second, a document ``page_tokens`` a page.
    """

    count: Callable[[str], int] = lambda s: len(s.split())
    tile: int = 512
    tile_tokens: int = 256
    audio_rate: int = 25
    page_tokens: int = 1024
    first: int = 1
    body: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0

    def text(self, part: Text) -> None:
        self.body.append(escape(part.text or ""))
        self.tokens += self.count(part.text or "")

    def _attach(self, kind: str, ref: str, tokens: int) -> None:
        n = self.first + len(self.attachments)
        self.body.append(f"<{kind} {n}>")
        self.attachments.append({"n": n, "kind": kind, "ref": ref, "tokens": tokens})
        self.tokens += tokens

    def image(self, part: Image) -> None:
        tiles = max(1, -(-part.width // self.tile)) * max(1, -(-part.height // self.tile))
        self._attach("image", part.ref, tiles * self.tile_tokens)

    def audio(self, part: Audio) -> None:
        self._attach("audio", part.ref, int(-(-part.seconds * self.audio_rate // 1)))

    def document(self, part: Document) -> None:
        self._attach("document", part.ref, part.pages * self.page_tokens)


def format_turn(role: str | None, content, **options) -> tuple[str, list[dict], int]:
    """(formatted turn, attachments, tokens)."""
    v = Flatten(**options)
    for part in parse_parts(content):
        part.accept(v)
    tag = "-" if role is None else ("\\-" if role == "-" else escape(role))
    return f"<s>[{tag}] {''.join(v.body)} </s>", v.attachments, v.tokens


def read_turns(formatted: str) -> Iterator[tuple[str | None, str]]:
    """(role, text) of every turn of a formatted string, placeholders taken out, escapes undone."""
    at = 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"not a turn at {at}")
        at = m.end()
        yield (None if m[1] == "-" else unescape(m[1])), unescape(PLACEHOLDER.sub(r"\1", m[2]))
    if at != len(formatted):
        raise ValueError(f"not a turn at {at}")


FORMATTED = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()),
                       ("attachments", pa.string()), ("tokens", pa.int64())])


def format_conversations(conv: DataFrame, parts: str | None = None) -> DataFrame:
    """(conv_id, turn, role, text) -> one formatted row a turn, in turn order inside each partition.

    ``parts`` names a column with a JSON list of typed parts, used where it is not null. Placeholders are
    numbered through the whole conversation.
    """
    cols = ["conv_id", "turn", "role", "text"]
    src = conv.select(*cols, (F.col(parts) if parts else F.lit(None)).cast("string").alias("parts"))
    src = src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = object(), 1
        for b in batches:
            rows = []
            for cid, turn, role, text, parts_json in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if cid != last:
                    last, n = cid, 1
                out, att, tokens = format_turn(role, json.loads(parts_json) if parts_json else (text or ""), first=n)
                n += len(att)
                rows.append((cid, turn, out, json.dumps(att), tokens))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), FORMATTED, strict=True)] if rows
                else [pa.array([], type=f.type) for f in FORMATTED], schema=FORMATTED)

    return src.mapInArrow(run, "conv_id long, turn long, formatted string, attachments string, tokens long")


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digests(formatted: DataFrame) -> DataFrame:
    """Reads formatted turns back (rows of a conversation adjacent and in order) and hashes what they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cur, none = None, object()
        key = none

        def row():
            return (key, cur["n"], cur["turns"].hexdigest(), cur["loss_chars"], cur["loss"].hexdigest(), cur["chars"])

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), DIGEST, strict=True)], schema=DIGEST)

        for b in batches:
            rows = []
            for cid, out in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if cid != key or key is none:
                    if key is not none:
                        rows.append(row())
                    key, cur = cid, {"n": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0}
                cur["chars"] += len(out)
                for role, text in read_turns(out):
                    cur["n"] += 1
                    cur["turns"].update(f"{role or ''}\n{text}\n".encode())
                    if role == "assistant":
                        cur["loss_chars"] += len(text)
                        cur["loss"].update(text.encode())
            if rows:
                yield batch(rows)
        if key is not none:
            yield batch([row()])

    return formatted.select("conv_id", "formatted").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

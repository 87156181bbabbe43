"""Chat formatting with typed content parts."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,"
        "pages:int>")
FORMATTED = ("formatted string, loss_start long, loss_chars long, attachments "
             "array<struct<number:int,kind:string,ref:string,at:long,tokens:long>>")

_ATTACHMENT = pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()),
                         ("at", pa.int64()), ("tokens", pa.int64())])
_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + r"\n", re.DOTALL)


class Costs(NamedTuple):
    """Tokens that an attachment stands for once a model has read it."""

    image_tile: int = 256
    tile_pixels: int = 448
    audio_second: int = 25
    document_page: int = 1000


def escape(text: str) -> str:
    """Text in which no control string can begin: ``<|`` gets a backslash, and what looks escaped
    already gets one more."""
    return _OPENING.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _header(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role(header: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(header))


class Flattener:
    """Visits the parts of a turn in order and gathers its text, placeholders and attachments."""

    def __init__(self, costs: Costs):
        self.costs, self.pieces, self.length, self.attachments = costs, [], 0, []

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def _write(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def _attach(self, part: dict, tokens: int) -> None:
        number = len(self.attachments) + 1
        self.attachments.append({"number": number, "kind": part["kind"], "ref": part.get("ref"),
                                 "at": self.length, "tokens": tokens})
        self._write(f"<|{escape(part['kind'])}_{number}|>")

    def visit_text(self, part: dict) -> None:
        self._write(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        side = self.costs.tile_pixels
        tiles = (max(1, math.ceil((part.get("width") or 1) / side))
                 * max(1, math.ceil((part.get("height") or 1) / side)))
        self._attach(part, tiles * self.costs.image_tile)

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part.get("seconds") or 0) * self.costs.audio_second))

    def visit_document(self, part: dict) -> None:
        self._attach(part, max(1, part.get("pages") or 1) * self.costs.document_page)

    def visit_other(self, part: dict) -> None:
        self._attach(part, 0)


def format_turns(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text", parts: str | None = None,
                 costs: Costs = Costs(), trained: str = "assistant") -> DataFrame:
    """Each turn as a marked piece of chat; the pieces of a conversation in order are its text.

    Content is the plain column ``text`` or the column ``parts``, an array of :data:`PART`. Parts
    keep their order; an image, audio or document becomes a placeholder, listed in ``attachments``
    with its reference, its place and the tokens it expands to. Unknown kinds are kept with no
    tokens. The loss mask (``loss_start``, ``loss_chars``, in code points of the piece) covers the
    content of the ``trained`` role without the marks. A control string inside a text or role is
    escaped so that :func:`read_back` restores it.

    Returns conv, turn and the columns of :data:`FORMATTED`, one row per input row, repeated rows
    included. Null text, role or parts are empty; turns of any length stay whole; other columns are
    ignored. A turn is formatted on its own, so a conversation of any length is spread over tasks.
    """
    content = F.col(parts) if parts else F.array(F.struct(
        F.lit("text").alias("kind"), F.col(text).alias("text")))
    selected = turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"),
                            F.col(role).alias("_role"), content.alias("_parts"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formatted, starts, lengths, attached = [], [], [], []
            roles, contents = batch.column("_role").to_pylist(), batch.column("_parts").to_pylist()
            for who, given in zip(roles, contents):
                flat = Flattener(costs)
                for part in given or ():
                    flat.visit(part or {})
                body, head = "".join(flat.pieces), f"{START}{_header(who or '')}\n"
                formatted.append(f"{head}{body}{END}\n")
                masked = who == trained
                starts.append(len(head) if masked else 0)
                lengths.append(len(body) if masked else 0)
                attached.append([{**one, "at": one["at"] + len(head)} for one in flat.attachments])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_conv"), batch.column("_turn"), pa.array(formatted, pa.string()),
                 pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(attached, pa.list_(_ATTACHMENT))],
                names=["_conv", "_turn", "formatted", "loss_start", "loss_chars", "attachments"])

    kinds = dict(selected.dtypes)
    result = selected.mapInArrow(pieces, f"_conv {kinds['_conv']}, _turn {kinds['_turn']}, "
                                         f"{FORMATTED}")
    return result.withColumnsRenamed({"_conv": conv, "_turn": turn})


def parse_turn(piece: str) -> tuple[str, str]:
    """Role and text of a formatted piece, as they were before escaping."""
    found = _TURN.fullmatch(piece)
    if found is None:
        raise ValueError(f"not a formatted turn: {piece[:80]!r}")
    return _role(found[1]), unescape(found[2])


class _Digest:
    def __init__(self):
        self.turns, self.chars, self.loss = 0, 0, 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int, length: int) -> None:
        role, text = parse_turn(piece)
        self.turns_hash.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        learned = unescape(piece[start:start + length])
        self.loss_hash.update(learned.encode("utf-8", "surrogatepass"))
        self.turns += 1
        self.chars += len(piece)
        self.loss += len(learned)

    def row(self) -> tuple:
        return (self.turns, self.turns_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(),
                self.chars)


DIGEST = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def read_back(formatted: DataFrame, *, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Reads formatted conversations again: their turns, what is learned, and sizes, as digests.

    Turns are taken in order of ``turn``, then of their text. A digest over a whole conversation
    needs its turns one after another, so a conversation streams through one task, sorted on disk
    where it is long; what is held is two hash states and one batch. Turns without a conversation
    form one of their own.
    """
    selected = formatted.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"),
                                "formatted", "loss_start", F.col("loss_chars").alias("_loss"))
    kind = dict(selected.dtypes)["_conv"]
    ordered = selected.repartition("_conv").sortWithinPartitions("_conv", "_turn", "formatted")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, rows = None, None, []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0] for row in rows], batch_type),
                 *(pa.array([row[place] for row in rows], pa.string() if place in (2, 4)
                            else pa.int64()) for place in range(1, 6))],
                names=["_conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                       "formatted_chars"])

        batch_type = None
        for batch in batches:
            batch_type = batch.column("_conv").type
            for key, piece, start, length in zip(*(batch.column(name).to_pylist() for name in (
                    "_conv", "formatted", "loss_start", "_loss"))):
                if state is None or key != current:
                    if state is not None:
                        rows.append((current, *state.row()))
                    current, state = key, _Digest()
                state.add(piece, start, length)
            if len(rows) >= 1000:
                yield flush()
                rows = []
        if state is not None:
            rows.append((current, *state.row()))
        if rows:
            yield flush()

    return ordered.mapInArrow(digests, f"_conv {kind}, {DIGEST}").withColumnRenamed("_conv", conv)


def text_part(text: Column) -> Column:
    """A text as a part, for building the ``parts`` column."""
    return F.struct(F.lit("text").alias("kind"), text.alias("text"),
                    *[F.lit(None).cast(kind).alias(name) for name, kind in (
                        ("ref", "string"), ("width", "int"), ("height", "int"),
                        ("seconds", "double"), ("pages", "int"))])

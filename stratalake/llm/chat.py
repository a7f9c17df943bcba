"""Chat formatting with typed content parts.

A turn's content is a list of parts (text, image, audio, document). A visitor flattens them in order:
adjacent texts are joined and escaped, anything else becomes a placeholder, its reference goes to the list
of attachments and its size to the count of tokens it expands to. Control strings cannot be forged: in a text, any ``<``,
run of backslashes and ``|`` gets one more backslash, so the template's own ``<|`` never occurs, and
taking one backslash away restores the text.

Turns are formatted one by one; a conversation is its segments by turn, so one of any length is never
gathered.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bound_batches, columns_of

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens that one unit of a part expands to: an image patch, a second of sound, a page.
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 300}
LOSS_ROLE = "assistant"
#: Bytes of a conversation that one row carries to its digest.
PIECE_BYTES = 1 << 20

PLAIN, ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
PLACEHOLDER = re.compile(r"<\|(image|audio|document):([0-9]+)\|>")


def escape(text: str) -> str:
    return PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role as one line without control strings."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class PartVisitor:
    """Flattens the parts of one turn; after ``end_text``, ``body`` and ``attachments`` hold the result."""

    body: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    #: Adjacent texts, escaped together: a control string may be spread over them.
    adjacent: list[str] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.adjacent.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        self.attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self.attach("document", part)

    def visit_other(self, part: dict) -> None:
        raise ValueError(f"unknown kind of part: {part.get('type')}")

    def end_text(self) -> None:
        self.body.append(escape("".join(self.adjacent)))
        self.adjacent.clear()

    def attach(self, kind: str, part: dict) -> None:
        self.end_text()
        tokens = math.ceil(max(0.0, part.get("units") or 0) * TOKENS_PER_UNIT[kind])
        self.attachments.append({"ordinal": len(self.attachments), "type": kind, "ref": part.get("ref"), "tokens": tokens})
        self.body.append(f"<|{kind}:{len(self.attachments) - 1}|>")


def format_turn(role: str | None, parts: list[dict]) -> tuple[str, int, int, list[dict]]:
    """(segment, start and end of its body in code points, attachments)."""
    visitor = PartVisitor()
    for part in parts:
        visitor.visit(part)
    visitor.end_text()
    head, body = f"{START}{escape_role(role or '')}\n", "".join(visitor.body)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body), visitor.attachments


def parse_turn(segment: str) -> tuple[str, list[dict]]:
    """(role, parts) read back from a segment; an attachment comes back as its kind and ordinal, adjacent texts as one."""
    head, _, rest = segment.removeprefix(START).partition("\n")
    body, parts, at = rest.removesuffix(f"{END}\n"), [], 0
    for match in PLACEHOLDER.finditer(body):
        if match.start() > at:
            parts.append({"type": "text", "text": unescape(body[at : match.start()])})
        parts.append({"type": match[1], "ordinal": int(match[2])})
        at = match.end()
    if at < len(body):
        parts.append({"type": "text", "text": unescape(body[at:])})
    return unescape_role(head), parts


TURN_SCHEMA = (
    "conv_id bigint, turn bigint, segment string, loss_start int, loss_end int, "
    "attachments array<struct<ordinal:int, type:string, ref:string, tokens:bigint>>, expanded_tokens bigint"
)


def format_turns(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row for each row of ``turns(conv_id, turn, role, text)``: its formatted segment, the code points of
    it under the loss mask (empty unless the role is ``loss_role``), its attachments and their tokens.

    A column ``parts`` (array of structs with type, text, ref, units) is used if there is one and it is not
    null, and ``text`` otherwise. A null text or role is empty, null ids stay; repeated rows are each
    formatted; an unknown kind of part fails. Other columns are not read.
    """
    bound_batches(turns.sparkSession)
    has_parts = "parts" in turns.columns
    columns = [F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text", *(["parts"] if has_parts else [])]
    attachments = pa.list_(pa.struct([("ordinal", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))

    def run(batches):
        for batch in columns_of(batches):
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            given = batch.column("parts").to_pylist() if has_parts else [None] * batch.num_rows
            rows = [format_turn(r, [{"text": t}] if p is None else [x for x in p if x]) for r, t, p in zip(roles, texts, given)]
            under = [(a, b) if r == loss_role else (a, a) for r, (_, a, b, _) in zip(roles, rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), batch.column("turn"), pa.array([s for s, *_ in rows], pa.string()),
                    pa.array([a for a, _ in under], pa.int32()), pa.array([b for _, b in under], pa.int32()),
                    pa.array([x for *_, x in rows], attachments), pa.array([sum(a["tokens"] for a in x) for *_, x in rows], pa.int64()),
                ],
                names=["conv_id", "turn", "segment", "loss_start", "loss_end", "attachments", "expanded_tokens"],
            )

    return turns.select(*columns).mapInArrow(run, TURN_SCHEMA)


PIECE_SCHEMA = "conv_id bigint, task int, piece int, n_turns bigint, formatted_chars bigint, loss_chars bigint, said binary, loss binary"


def read_back(batches: Iterator[pa.RecordBatch], task: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of conversations, from segments in order: the bytes that the digests cover, read back from them."""
    names = [part.split()[0] for part in PIECE_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    held, number, out = None, 0, []

    def close():
        nonlocal number
        out.append((held[0], task, number, held[1], held[2], held[3], bytes(held[4]), bytes(held[5])))
        number += 1

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * len(types), types)], names=names)
        out.clear()
        return batch

    for batch in columns_of(batches):
        for conv, segment, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end"))):
            if held is not None and (held[0] != conv or len(held[4]) >= limit):
                close()
                held = None
            if held is None:
                held = [conv, 0, 0, 0, bytearray(), bytearray()]
            role, parts = parse_turn(segment)
            text = "".join(p["text"] if p["type"] == "text" else f"<|{p['type']}:{p['ordinal']}|>" for p in parts)
            masked = unescape(segment[start:end])
            held[1] += 1
            held[2] += len(segment)
            held[3] += len(masked)
            held[4] += f"{role}\n{text}\n".encode()
            held[5] += masked.encode()
        if sum(len(r[6]) for r in out) > 4 * limit or len(out) > 2000:
            yield flush()
    if held is not None:
        close()
    yield flush()


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation from its pieces in order; holds the state of one digest, never a conversation."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    state, out = None, []

    def close():
        out.append((state[0], state[1], state[4].hexdigest(), state[3], state[5].hexdigest(), state[2]))

    def flush():
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 6, types)], names=names)
        out.clear()
        return batch

    for batch in columns_of(batches):
        for conv, turns, chars, loss_chars, said, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n_turns", "formatted_chars", "loss_chars", "said", "loss"))):
            if state is None or state[0] != conv:
                if state is not None:
                    close()
                state = [conv, 0, 0, 0, hashlib.sha256(), hashlib.sha256()]
            state[1] += turns
            state[2] += chars
            state[3] += loss_chars
            state[4].update(said)
            state[5].update(loss)
        yield flush()
    if state is not None:
        close()
    yield flush()


def conversation_digests(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of each conversation, read
    back from the formatted segments.

    Turns are dealt by ranges of (conversation, turn), so a conversation that holds a third of all rows is
    formatted and read back by many tasks; only the digest itself, which must see its bytes in order, runs
    over pieces of it in one stream. Rows with one turn number are ordered by role, text and parts (nulls
    first); rows without a conv_id are one conversation. A column ``parts`` is used as in ``format_turns``; an
    attachment stands in both digests as its placeholder, so its reference and size are not covered.
    """
    order = ["conv_id", "turn", "role", "text", *(["parts"] if "parts" in turns.columns else [])]
    ranged = turns.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    segments = format_turns(ranged, loss_role).select("conv_id", "segment", "loss_start", "loss_end")
    pieces = segments.mapInArrow(lambda batches: read_back(batches, TaskContext.get().partitionId()), PIECE_SCHEMA)
    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "task", "piece")
    return dealt.mapInArrow(digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")

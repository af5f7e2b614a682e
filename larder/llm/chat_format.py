"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor
flattens them into one string, in order: text is escaped, every other part becomes a
placeholder of its kind, recorded with what it refers to and the number of tokens it
expands to. Turns are marked by control strings; the text of the trained roles is the
loss mask, kept as code point spans.

The formatted corpus has one row per turn, in order, so a conversation of any length
needs no row of its own length: a conversation's string is its rows' joined.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

START, END, BREAK = "<|im_start|>", "<|im_end|>", "\n"

#: The type of a column of content parts.
PARTS = "array<struct<type:string, text:string, ref:string, width:int, height:int, seconds:double, pages:int>>"
_FORMATTED = ("conv_id long, position long, formatted string, loss_start int, loss_end int, n_chars int, "
              "attachments array<struct<kind:string, ref:string, char_start:int, tokens:long>>, expanded_tokens long")

_OPENS = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    r"""``text`` without control strings: between ``<`` and ``|``, with backslashes or none between, one more backslash."""
    return _OPENS.sub(r"<\\\1|", text) if "<" in text and "|" in text else text


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return _ESCAPED.sub(r"<\1|", text) if "<\\" in text else text


def escape_role(role: str) -> str:
    """A role as one line without control strings."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


@dataclass
class TokenCosts:
    """Tokens that a placeholder expands to."""
    patch: int = 14
    per_second: float = 25.0
    per_page: int = 256

    def image(self, width: int | None, height: int | None) -> int:
        return math.ceil((width or 0) / self.patch) * math.ceil((height or 0) / self.patch)

    def audio(self, seconds: float | None) -> int:
        return math.ceil((seconds or 0.0) * self.per_second)

    def document(self, pages: int | None) -> int:
        return (pages or 0) * self.per_page


@dataclass
class Flattener:
    """Visits a turn's parts in order and gathers its string and its attachments."""
    costs: TokenCosts
    pieces: list[str] = field(default_factory=list)
    pending: list[str] = field(default_factory=list)
    length: int = 0
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        """An unknown kind is a document of no pages; a null part is nothing."""
        if part is not None:
            kind = part.get("type") or "text"
            getattr(self, f"visit_{kind}", self.visit_document)(part)

    def visit_text(self, part: dict) -> None:
        self.pending.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        self.attach("image", part, self.costs.image(part.get("width"), part.get("height")))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, self.costs.audio(part.get("seconds")))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, self.costs.document(part.get("pages")))

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.settle()
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "char_start": self.length, "tokens": tokens})
        self.add(f"<|{kind}|>")

    def settle(self) -> None:
        """Text parts in a row are one text: escaped together, or a control string could arise where they meet."""
        if self.pending:
            self.add(escape("".join(self.pending)))
            self.pending = []

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def done(self) -> str:
        self.settle()
        return "".join(self.pieces)


def format_turn(role: str, parts: Sequence[dict | None], trained: frozenset[str], costs: TokenCosts) -> tuple:
    """(formatted, loss_start, loss_end, n_chars, attachments, expanded_tokens) of one turn."""
    head = f"{START}{escape_role(role)}{BREAK}"
    flat = Flattener(costs)
    flat.add(head)
    for part in parts:
        flat.visit(part)
    body = flat.done()
    span = (len(head), len(body)) if role in trained else (0, 0)
    whole = body + END + BREAK
    return whole, *span, len(whole), flat.attachments, sum(a["tokens"] for a in flat.attachments)


def read_turn(formatted: str, loss_start: int, loss_end: int) -> tuple[str, str, str]:
    """(role, text, text under the loss mask) of a formatted turn; placeholders stay in the text as they are."""
    if not (formatted.startswith(START) and formatted.endswith(END + BREAK)):
        raise ValueError("not a formatted turn")
    line, body = formatted[len(START):-len(END + BREAK)].split(BREAK, 1)
    if START in body or END in body:
        raise ValueError("control string inside a turn")
    return unescape_role(line), unescape(body), unescape(formatted[loss_start:loss_end])


def ordered_turns(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """(conv, turn, role, content) in order of conversation and turn, null first, cut into ranges of rows.

    A long conversation is spread over several ranges. Rows of the same turn follow
    each other by role and content (for content parts: by role).
    """
    rows = chats.select(F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), F.col(content).alias("content"))
    ties = ["role", "content"] if dict(rows.dtypes)["content"] == "string" else ["role"]
    return rows.repartitionByRange("conv", "turn").sortWithinPartitions("conv", "turn", *ties)


def format_chats(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text",
                 trained: Sequence[str] = ("assistant",), costs: TokenCosts | None = None) -> DataFrame:
    """The formatted corpus, one row per turn, in order within and across partitions.

    ``content`` is a column of texts or of content parts (``PARTS``). Columns: conv_id,
    position (its low 33 bits count the rows of a partition, the partition above them; it grows
    with the turns of a conversation), formatted, loss_start and loss_end (code points of
    ``formatted`` under the loss mask, equal outside the trained roles), n_chars,
    attachments (kind, ref, char_start, tokens) and expanded_tokens.

    Null roles and contents are empty; rows without a conv_id are one conversation
    without an id. Repeated rows are turns each. An empty table gives no rows; further
    columns are ignored.
    """
    roles, costs = frozenset(trained), costs or TokenCosts()
    plain = dict(chats.dtypes)[content] == "string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches([whole]):
                contents = batch.column("content").to_pylist()
                turns = [format_turn(r, [{"text": c}] if plain else (c or []), roles, costs)
                         for r, c in zip(batch.column("role").to_pylist(), contents)]
                formatted, starts, ends, sizes, attached, tokens = (list(c) for c in zip(*turns))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv"), batch.column("position"), pa.array(formatted, pa.string()), pa.array(starts, pa.int32()),
                     pa.array(ends, pa.int32()), pa.array(sizes, pa.int32()), pa.array(attached, _ATTACHED), pa.array(tokens, pa.int64())],
                    names=["conv_id", "position", "formatted", "loss_start", "loss_end", "n_chars", "attachments", "expanded_tokens"])

    rows = ordered_turns(chats, conv_id, turn, role, content).withColumn("position", F.monotonically_increasing_id())
    return rows.select("conv", "position", "role", "content").mapInArrow(work, _FORMATTED)


_ATTACHED = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("char_start", pa.int32()), ("tokens", pa.int64())]))

_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, expanded_tokens long"
_PIECES = _DIGEST + ", seq long, turns binary, loss binary"


class _Conversation:
    """Sums of a conversation's turns, and their bytes until they are digested or handed on."""

    def __init__(self, conv: int | None, seq: int):
        self.conv, self.seq, self.cut = conv, seq, False
        self.n = self.loss_chars = self.chars = self.tokens = self.size = 0
        self.turns, self.loss = [], []

    def add(self, role: str, text: str, loss: str, chars: int, tokens: int) -> None:
        said = f"{role}\n{text}\n".encode("utf-8", "surrogatepass")
        self.turns.append(said)
        self.loss.append(loss.encode("utf-8", "surrogatepass"))
        self.n, self.size, self.loss_chars = self.n + 1, self.size + len(said), self.loss_chars + len(loss)
        self.chars, self.tokens = self.chars + chars, self.tokens + tokens

    def whole(self) -> tuple:
        turns, loss = (hashlib.sha256(b"".join(x)).hexdigest() for x in (self.turns, self.loss))
        return self.conv, self.n, turns, self.loss_chars, loss, self.chars, self.tokens, None, None, None

    def piece(self) -> tuple:
        return (self.conv, self.n, None, self.loss_chars, None, self.chars, self.tokens, self.seq,
                b"".join(self.turns), b"".join(self.loss))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*(f.split(" ") for f in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows), types)], names=list(names))


def read_back(formatted: DataFrame, piece_bytes: int = 1 << 20) -> DataFrame:
    """Digests of every conversation, parsed from its formatted rows (ordered as ``format_chats`` leaves them).

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    expanded_tokens). A partition digests the conversations that lie inside it. Those
    at its ends, which may go on in another, and those above ``piece_bytes`` hand on what was
    parsed in pieces of about that size, which are digested in order, one at a time (a
    digest isn't a sum: one conversation's is the work of one task). An empty table gives no rows.
    """
    columns = ("conv_id", "position", "formatted", "loss_start", "loss_end", "n_chars", "expanded_tokens")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first, out = None, True, []
        for batch in batches:
            for some in text_batches([batch]):
                for conv, position, text, a, b, chars, tokens in zip(*(some.column(c).to_pylist() for c in columns)):
                    if current is None or conv != current.conv:
                        if current is not None:
                            out.append(current.piece() if first or current.cut else current.whole())
                            first = False
                        current = _Conversation(conv, position)
                    elif current.size > piece_bytes:
                        yield _batch([current.piece()], _PIECES)
                        current = _Conversation(conv, position)
                        current.cut = True
                    current.add(*read_turn(text, a, b), chars, tokens)
                if out:
                    yield _batch(out, _PIECES)
                    out = []
        if current is not None:
            yield _batch([current.piece()], _PIECES)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, turns, loss = None, None, None

        def finished() -> tuple:
            return sums[0], sums[1], turns.hexdigest(), sums[2], loss.hexdigest(), sums[3], sums[4]

        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                conv, n, done, loss_n, loss_done, chars, tokens, _, said, masked = (c[i].as_py() for c in batch.columns)
                if sums is not None and (done is not None or conv != sums[0]):
                    out.append(finished())
                    sums = None
                if done is not None:
                    out.append((conv, n, done, loss_n, loss_done, chars, tokens))
                    continue
                if sums is None:
                    sums, turns, loss = [conv, 0, 0, 0, 0], hashlib.sha256(), hashlib.sha256()
                turns.update(said)
                loss.update(masked)
                sums[1:] = [x + y for x, y in zip(sums[1:], (n, loss_n, chars, tokens))]
            if out:
                yield _batch(out, _DIGEST)
        if sums is not None:
            yield _batch([finished()], _DIGEST)

    pieces = formatted.select(*columns).mapInArrow(parse, _PIECES)
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(join, _DIGEST)


def chat_digests(chats: DataFrame) -> DataFrame:
    """``read_back`` of the formatted table: one row per conversation."""
    return read_back(format_chats(chats))


def chat_digests_sql(extra: Sequence[tuple[int, int, str, str]] = ()) -> str:
    """DuckDB SQL for ``chat_digests`` over ``conversations`` and further (conv_id, turn, role, text) rows."""
    quoted = [f"SELECT {c}, {t}, '{r}', '{x}'" for c, t, r, x in extra]
    more = "".join(f" UNION ALL {q}" for q in quoted)
    return rf"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM
               (SELECT conv_id, turn, role, text FROM conversations{more})),
    f AS (SELECT *, length('{START}') + length('{END}') + 2
                 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g'))
                 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars FROM t)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(chars)::BIGINT AS formatted_chars, 0::BIGINT AS expanded_tokens
    FROM f GROUP BY conv_id
    """

"""Chat formatting with a compiled template: conversations to training text with a loss mask.

Turns are sorted within a conversation and rendered as a stream: a task holds one turn and one part of
the output, so a conversation of any number of turns needs no more memory than its longest text. The
output comes in parts (rows) of about ``PART_CHARS`` characters, cut between template pieces and never
inside a generation block, each with the spans to learn from.

Control strings inside texts are escaped by one backslash between ``<`` and ``|`` (one more where some stand there
already), which ``unescape`` takes out again; the role's line also escapes backslashes and line ends.

Defined cases: null text and null role are empty; turns of one conversation are ordered by turn (null
first), then role, then text, so repeated rows and ties have one result; rows without a conversation id
form one conversation with a null id; an empty table gives no conversation; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .templates import compile_template

TEMPLATE = """{%- for m in messages -%}
<|im_start|>{{ m.role | escape_line }}{{ '\\n' }}
{%- if m.role == 'assistant' -%}{% generation %}{{ m.text | escape }}{% endgeneration %}
{%- else -%}{{ m.text | escape }}{%- endif -%}
<|im_end|>{{ '\\n' }}
{%- endfor -%}"""

PART_CHARS = 1 << 16
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_line(text: str) -> str:
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


FILTERS = {"escape": escape, "escape_line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower,
           "length": len, "default": lambda v, other: other if v is None else v}


def _turns(batches, kinds: list):
    for b in batches:
        kinds[:] = [b.schema.field("conv").type]
        for conv, role, text in zip(*(b[c].to_pylist() for c in ("conv", "role", "text"))):
            yield conv, {"role": role or "", "text": text or ""}


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", template: str = TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, text, spans): the formatted conversations in parts, numbered from 0, with the
    half-open character spans of each part that carry loss."""
    kind = turns.schema[conv_col].dataType.simpleString()
    rows = (turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                         F.col(text_col).alias("text"))
                 .repartition("conv").sortWithinPartitions("conv", "turn", "role", "text"))

    def run(batches):
        render = compile_template(template, FILTERS)
        kinds: list[pa.DataType] = []
        stream = _turns(batches, kinds)
        head = next(stream, None)
        ready: list[tuple] = []
        while head is not None:
            conv = head[0]

            def own():
                nonlocal head
                while head is not None and head[0] == conv:
                    turn = head[1]
                    head = next(stream, None)
                    yield turn

            part, pieces, size, spans, since = 0, [], 0, [], None
            messages = own()
            for piece in render({"messages": messages}):
                if piece is True:
                    since = size
                elif piece is False:
                    spans.append({"start": since, "end": size})
                    since = None
                else:
                    pieces.append(piece)
                    size += len(piece)
                if size >= part_chars and since is None:
                    ready.append((conv, part, "".join(pieces), spans))
                    part, pieces, size, spans = part + 1, [], 0, []
                    yield _part_rows(ready, kinds[0])
            for _ in messages:           # turns that the template does not ask for
                pass
            if pieces or not part:
                ready.append((conv, part, "".join(pieces), spans))
            if len(ready) >= 64:
                yield _part_rows(ready, kinds[0])
        if ready:
            yield _part_rows(ready, kinds[0])

    return (rows.mapInArrow(run, f"conv {kind}, part bigint, text string, spans array<struct<start: bigint, end: bigint>>")
                .withColumnRenamed("conv", conv_col))


def _part_rows(ready: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    conv, part, text, spans = zip(*ready)
    ready.clear()
    return pa.RecordBatch.from_arrays([pa.array(conv, kind), pa.array(part, pa.int64()), pa.array(text, pa.string()), pa.array(spans, SPANS)],
                                      ["conv", "part", "text", "spans"])


# a turn as the template writes it; no control string is left inside a role or a text
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def read_back(parts: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digests read from formatted parts as ``format_conversations`` returns them (a conversation's parts
    together and in order, which holds for its output without another shuffle): conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars. A turn that spans parts is held until its end arrives."""
    kind = parts.schema[conv_col].dataType.simpleString()
    out = (f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint")

    def run(batches):
        conv, state, done = None, None, []

        def close():
            if state is not None:
                n, turns, loss, n_loss, n_chars, rest = state
                if rest:
                    raise ValueError(f"conversation {conv}: {len(rest)} characters outside of turns")
                done.append((conv, n, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars))

        for b in batches:
            own = b.schema.field(0).type
            for c, part, text, spans in zip(*(b.column(k).to_pylist() for k in range(4))):
                if state is None or part == 0:
                    close()
                    conv, state = c, [0, hashlib.sha256(), hashlib.sha256(), 0, 0, ""]
                state[4] += len(text)
                for s in spans:
                    learned = unescape(text[s["start"]:s["end"]])
                    state[3] += len(learned)
                    state[2].update(learned.encode())
                rest, end = state[5] + text, 0
                for m in TURN.finditer(rest):
                    if m.start() != end:
                        raise ValueError(f"conversation {c}: text outside of turns")
                    state[0] += 1
                    state[1].update(f"{unescape_line(m[1])}\n{unescape(m[2])}\n".encode())
                    end = m.end()
                state[5] = rest[end:]
            if len(done) >= 1024:
                yield _digest_rows(done, own)
        close()
        if done:
            yield _digest_rows(done, own)

    return (parts.select(F.col(conv_col).alias("conv"), "part", "text", "spans").mapInArrow(run, out)
                 .withColumnRenamed("conv", conv_col))


def _digest_rows(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    conv, *rest = zip(*done)
    done.clear()
    conv = pa.array(conv, kind)
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([conv, *map(pa.array, rest)], names)

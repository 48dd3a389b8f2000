"""Chat formatting with loss masks, by a compiled template.

``format_conversations`` renders each conversation (its rows by turn) and returns
it as pieces in order: (conv_id, part, text, loss), one row per turn plus one
for text after the last, ``loss`` being the spans [start, end) of the text, in
characters, that generation markers cover. Control strings of the template inside a
message are escaped before it is rendered, reversibly: ESCAPE is put before
every control string and every ESCAPE, so the output can be read back to the
same turns (``read_back``). A conversation is never held whole: rows stream through
the template in order of turn, and a conversation of any length is as many pieces.

Rows of one conversation must meet in order, so they go to one task, where they
stream.

Defined results: null texts and roles are empty; rows with a null ``conv_id`` form
a conversation; rows of the same turn go by role and text, nulls first, repeated rows stay; a
template that yields nothing gives empty pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .template import compile_template

ESCAPE = "\\"
OPEN, CLOSE = "### ", "</turn>"
#: The production template: a heading with the role, the text, a closing mark; assistant texts are learnt.
TEMPLATE = (
    "{% for message in messages %}"
    "{{ '### ' ~ message.role ~ ':\\n' }}"
    "{% if message.plain_role == 'assistant' %}{% generation %}{{ message.text }}{% endgeneration %}"
    "{% else %}{{ message.text }}{% endif %}"
    "{{ '</turn>' ~ '\\n' }}"
    "{% endfor %}"
)
_CONTROL = (ESCAPE, OPEN, CLOSE, ":\n")
_ESCAPED = re.compile("|".join(map(re.escape, sorted(_CONTROL, key=len, reverse=True))))
_PIECES = "part long, text string, loss array<struct<start:long,end:long>>"
_FLUSH = 512


def escape(text: str, control: re.Pattern = _ESCAPED) -> str:
    return control.sub(lambda m: ESCAPE + m[0], text)


def _unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("_key", "role", "text")))


def format_conversations(df: DataFrame, template: str = TEMPLATE, control: tuple[str, ...] = _CONTROL) -> DataFrame:
    """(conv_id, part, text, loss) of (conv_id, turn, role, text); parts of a conversation lie in one
    partition, in order. ``control``: the strings to escape in messages, ESCAPE among them."""
    render = compile_template(template)
    pattern = re.compile("|".join(map(re.escape, sorted(control, key=len, reverse=True))))
    key_type = df.schema["conv_id"].dataType.simpleString()
    rows = (df.select(F.col("conv_id").alias("_key"), "turn", F.col("role").cast("string").alias("role"),
                      F.col("text").cast("string").alias("text"))
            .repartition("_key").sortWithinPartitions("_key", "turn", "role", "text"))

    def run(batches):
        for batch in _batched(_pieces(render, pattern, _turns(batches)), rows_schema):
            yield batch

    rows_schema = pa.schema([("conv_id", _arrow_type(key_type)), ("part", pa.int64()), ("text", pa.string()),
                             ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    return rows.mapInArrow(run, f"conv_id {key_type}, {_PIECES}")


def _arrow_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


def _pieces(render, pattern, turns):
    """(conversation, part, text, loss spans): a piece ends where the template asks for the next message."""
    for key, group in groupby(turns, key=lambda t: t[0]):
        asked = 0

        def messages():
            nonlocal asked
            for _, role, text in group:
                asked += 1
                yield {"role": escape(role or "", pattern), "plain_role": role or "", "text": escape(text or "", pattern)}
            asked += 1

        part, text, loss, size, seen = 0, [], [], 0, None
        for piece, marked in render({"messages": messages()}):
            # the loop reads one message ahead, so a piece belongs to the message before the last asked for
            at = asked
            if seen is not None and at != seen and text:
                yield key, part, "".join(text), loss
                part, text, loss, size = part + 1, [], [], 0
            seen = at
            if marked and piece:
                if loss and loss[-1]["end"] == size:
                    loss[-1]["end"] = size + len(piece)
                else:
                    loss.append({"start": size, "end": size + len(piece)})
            text.append(piece)
            size += len(piece)
        for _ in group:  # a template that reads no message
            pass
        yield key, part, "".join(text), loss


def _batched(pieces, schema):
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece[2])
        if len(held) >= _FLUSH or size > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


class Reader:
    """Reads formatted text of the production template back to turns, piece by piece."""

    _mark = re.compile(r"\\.|### |:\n|</turn>\n", re.S)

    def __init__(self):
        self.rest, self.role = "", None

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn that ends in what has been fed."""
        self.rest += text
        at = start = 0
        heading = "role" if self.role is None else "text"
        while True:
            m = self._mark.search(self.rest, at)
            if not m:
                break
            at = m.end()
            mark = m[0]
            if mark.startswith(ESCAPE):
                continue
            if mark == OPEN and heading == "role":
                start = at
            elif mark == ":\n" and heading == "role":
                self.role, start, heading = _unescaped(self.rest[start:m.start()]), at, "text"
            elif mark.startswith(CLOSE) and heading == "text":
                yield self.role, _unescaped(self.rest[start:m.start()])
                self.role, start, heading = None, at, "role"
        self.rest = self.rest[start:]


def read_back(text: str) -> list[tuple[str, str]]:
    return list(Reader().feed(text))


_DIGEST = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from formatted pieces as they lie in their partitions."""
    key_type = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches):
        stream = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss"))))
        out = []
        for key, group in groupby(stream, key=lambda r: r[0]):
            reader, turns, learnt = Reader(), hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for _, text, loss in group:
                chars += len(text)
                for span in loss:
                    plain = _unescaped(text[span["start"]:span["end"]])
                    loss_chars += len(plain)
                    learnt.update(plain.encode("utf-8", "surrogatepass"))
                for role, content in reader.feed(text):
                    n_turns += 1
                    turns.update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
            out.append((key, n_turns, turns.hexdigest(), loss_chars, learnt.hexdigest(), chars))
            if len(out) >= _FLUSH:
                yield _digest_batch(out, key_type)
                out = []
        if out:
            yield _digest_batch(out, key_type)

    return formatted.mapInArrow(run, f"conv_id {key_type}, {_DIGEST}")


def _digest_batch(rows, key_type):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [_arrow_type(key_type), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_conversations(conversations.union(extra)))

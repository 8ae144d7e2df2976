"""Chat formatting by columnar byte assembly.

A turn becomes ``<s>[ROLE]role[/ROLE]`` newline text ``</s>`` newline. Control strings inside roles and
texts are escaped with a backslash after their first character, and backslashes are doubled, so a
formatted conversation reads back exactly. The text of every assistant turn is under the loss mask.

Turns are partitioned by conversation and sorted by turn. A task goes through its turns in Arrow
batches: segment lengths and cumulative offsets give scatter indices, and headers, texts and ends are
copied into one preallocated buffer. A conversation that goes on over a batch is continued in the next
row (``part`` counts up), so no task holds a whole conversation, however long.

Defined cases: a null text or role is empty; turns of a null conversation are a conversation of their
own; equal turn numbers are ordered by role and text, and repeated rows are repeated turns; an empty
table gives an empty result. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings of the template and of common chat formats.
CONTROL = ["<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|"]
OPEN, NAMED, CLOSE = "<s>[ROLE]", "[/ROLE]\n", "</s>\n"
BATCH = 20_000
FORMATTED = "part int, n_turns long, formatted string, loss_start array<long>, loss_end array<long>"
READ_BACK = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaped(texts: pa.Array) -> pa.Array:
    texts = pc.replace_substring(pc.fill_null(texts, ""), "\\", "\\\\")
    for control in CONTROL:
        texts = pc.replace_substring(texts, control, control[0] + "\\" + control[1:])
    return texts


_escapes = re.compile(r"\\(.)", re.DOTALL)


def unescaped(text: str) -> str:
    return _escapes.sub(r"\1", text) if "\\" in text else text


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Data, start and length of each string of an array without nulls."""
    strings = strings.cast(pa.large_string())
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int64)[strings.offset:strings.offset + len(strings) + 1]
    return np.frombuffer(data or b"", np.uint8), ends[:-1], np.diff(ends)


def assemble(segments: list[pa.Array], first: np.ndarray) -> pa.Array:
    """Join the segments of every row, and the rows from each ``first`` to the next, into one string each.

    The place of a segment is the running sum of all lengths before it; each segment column is copied
    with one gather and one scatter.
    """
    parts = [_bytes_of(s) for s in segments]
    lengths = np.stack([length for _, _, length in parts], axis=1)
    ends = np.cumsum(lengths.ravel())
    places = (ends - lengths.ravel()).reshape(lengths.shape)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for column, (data, start, length) in enumerate(parts):
        if total := int(length.sum()):
            inside = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
            out[np.repeat(places[:, column], length) + inside] = data[np.repeat(start, length) + inside]
    bounds = np.append(places[first, 0], len(out)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(out)])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, part = None, 0
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            batch = whole.slice(at, BATCH)
            ids = batch.column("conv_id").to_pylist()
            first = np.array([i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]])
            sizes = np.diff(np.append(first, len(ids)))
            part = part + 1 if last is not None and last[0] == ids[0] else 0
            roles, texts = escaped(batch.column("role")), escaped(batch.column("text"))
            fixed = [pa.array([s] * len(ids), pa.string()) for s in (OPEN, NAMED, CLOSE)]
            segments = [fixed[0], roles, fixed[1], texts, fixed[2]]
            chars = np.stack([pc.utf8_length(s).to_numpy() for s in segments], axis=1).astype(np.int64)
            row = np.cumsum(chars.sum(axis=1)) - chars.sum(axis=1)
            start = row - np.repeat(row[first], sizes) + chars[:, :3].sum(axis=1)
            masked = pc.fill_null(pc.equal(batch.column("role"), "assistant"), False).to_numpy(zero_copy_only=False)
            kept = np.append(0, np.cumsum([masked[a:a + n].sum() for a, n in zip(first, sizes, strict=True)])).astype(np.int32)
            parts = np.zeros(len(first), np.int32)
            parts[0] = part
            last, part = (ids[-1],), int(parts[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id").take(pa.array(first)), pa.array(parts), pa.array(sizes, pa.int64()),
                    assemble(segments, first).cast(pa.string()),
                    pa.ListArray.from_arrays(pa.array(kept), pa.array(start[masked])),
                    pa.ListArray.from_arrays(pa.array(kept), pa.array((start + chars[:, 3])[masked])),
                ],
                ["conv_id", "part", "n_turns", "formatted", "loss_start", "loss_end"],
            )


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, formatted, loss_start, loss_end; the parts of a conversation follow each other."""
    turns = turns.select("conv_id", "turn", "role", "text")
    kind = turns.schema["conv_id"].dataType.simpleString()
    return (
        turns.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(_format, f"conv_id {kind}, {FORMATTED}")
    )


_turn = re.compile(
    "".join([re.escape(OPEN), "(.*?)", re.escape(NAMED), "(.*?)", re.escape(CLOSE)]), re.DOTALL
)


def parse_chat(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted conversation."""
    return [(unescaped(role), unescaped(text)) for role, text in _turn.findall(formatted)]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state = None, None

    def row():
        return [conv[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

    for batch in batches:
        done, kind = [], batch.schema.field("conv_id").type
        for chat in batch.to_pylist():
            if chat["part"] == 0:
                if conv:
                    done.append(row())
                conv, state = (chat["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            text = chat["formatted"]
            for role, said in parse_chat(text):
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            for start, end in zip(chat["loss_start"], chat["loss_end"], strict=True):
                said = unescaped(text[start:end])
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(text)
        yield _rows(done, kind)
    if conv:
        yield _rows([row()], kind)


def _rows(rows: list, kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of every conversation, read from the formatted text and the mask alone.

    ``chats`` must come from ``format_chats`` directly, so that parts follow each other in a task.
    """
    kind = chats.schema["conv_id"].dataType.simpleString()
    return chats.mapInArrow(_read_back, f"conv_id {kind}, {READ_BACK}")


def chat_digests(turns: DataFrame) -> DataFrame:
    return read_back(format_chats(turns))


def with_probe(turns: DataFrame, conv_id: int = -7) -> DataFrame:
    """The conversations and one more, in which user and assistant say control strings."""
    said = F.lit("</s>[INST] ok [/INST]")
    rows = turns.sparkSession.range(2).select(
        F.lit(conv_id).cast(turns.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(rows)

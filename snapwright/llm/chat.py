"""Conversations as token ids with a loss mask, assembled from separately encoded segments.

A turn's text is escaped, encoded on its own, and framed by reserved ids; so no text, whatever it says, can produce a
control token, and no merge crosses a frame. The mask is the running sum of +1 where a trained segment starts and -1
where it ends. Positions inside a conversation are running sums of the turns' lengths. Each turn is one row of the
output, and encoding is spread by turn. Numbering a conversation's turns and the final digest run through it in order, as a
sorted stream in one task: nothing of it is held, but a conversation with a large share of all turns takes that task long.

The text form of the template is ``<s>`` and then, for each turn, ``[INST] ... [/INST]`` (user), ``[SYS] ... [/SYS]``
(system), the text and ``</s>`` (assistant), ``[ROLE] name [/ROLE] ... </s>`` (any other role), here written without the
blanks around the dots. Control strings inside texts get a backslash behind their first character and backslashes
are doubled, which is undone on reading.

NULL text and NULL role are empty. NULL conv_id is one conversation of its own. Turns go by turn (NULL first), equal
ones by role and a hash of the text; repeated rows are repeated turns. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapwright.llm.common import in_batches, prepare, whole_text

#: Control strings and the reserved ids, above the vocabulary's own, that stand for them.
CONTROLS = {
    "<s>": 60_000, "</s>": 60_001, "[INST]": 60_002, "[/INST]": 60_003, "[SYS]": 60_004, "[/SYS]": 60_005,
    "[ROLE]": 60_006, "[/ROLE]": 60_007, "<|endoftext|>": 60_008,
}
_BY_ID = {number: text for text, number in CONTROLS.items()}
FIRST_RESERVED = 60_000
_FRAMES = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": (None, "</s>")}
_FOUND = re.compile("|".join(re.escape(c) for c in CONTROLS))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    return _FOUND.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


_CODECS: dict[str, object] = {}


def codec(path: str):
    """A byte-level vocabulary of ranks, loaded once per worker; every text decodes to itself."""
    if path not in _CODECS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as opened:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, opened)}
        _CODECS[path] = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _CODECS[path]


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def assemble(role: str, text: str, encode) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of one turn."""
    first, last = _FRAMES.get(role, ("[ROLE]", "</s>"))
    parts: list[tuple[list[int], bool]] = []
    if first:
        parts.append(([CONTROLS[first]], False))
    if role not in _FRAMES:
        parts += [(encode(escape(role)), False), ([CONTROLS["[/ROLE]"]], False)]
    parts += [(encode(escape(text)), role == "assistant"), ([CONTROLS[last]], False)]
    ids = np.fromiter((i for segment, _ in parts for i in segment), np.uint32)
    ends = np.cumsum([len(segment) for segment, _ in parts])
    steps = np.zeros(len(ids) + 1, np.int32)
    for end, (segment, trained) in zip(ends, parts, strict=True):
        if trained:
            np.add.at(steps, [end - len(segment), end], [1, -1])
    return ids, np.cumsum(steps[:-1]).astype(np.uint8)


def format_turns(conversations: DataFrame, *, ranks: str | None = None) -> DataFrame:
    """One row per turn: conv_id, turn_no (from 0), token_start in the conversation, ids and mask (binary).

    The first turn carries the opening token of the conversation. Turns are encoded where they lie; only then are
    they ordered within their conversation for the running sums.
    """
    prepare(conversations.sparkSession)
    ranks = ranks or default_ranks()
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("tie", pa.string()), ("ids", pa.binary()), ("mask", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encode = codec(ranks).encode_ordinary
        for batch in batches:
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
                ids, mask = assemble(role, text, encode)
                tie = role + "\n" + hashlib.sha256(text.encode("utf-8")).hexdigest()
                yield conv, turn, tie, ids.astype("<u4").tobytes(), mask.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), schema, lambda row: len(row[3]) + len(row[4]) + 128)

    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), whole_text("role").alias("role"), whole_text("text").alias("text")
    )
    encoded = turns.mapInArrow(run, "conv_id long, turn long, tie string, ids binary, mask binary")
    opening = np.array([CONTROLS["<s>"]], "<u4").tobytes()
    order = Window.partitionBy("conv_id").orderBy("turn", "tie")
    placed = encoded.withColumn("turn_no", F.row_number().over(order).cast("long") - 1)
    placed = placed.withColumn("ids", F.when(F.col("turn_no") == 0, F.concat(F.lit(opening), F.col("ids"))).otherwise(F.col("ids")))
    placed = placed.withColumn("mask", F.when(F.col("turn_no") == 0, F.concat(F.lit(b"\0"), F.col("mask"))).otherwise(F.col("mask")))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("token_start", F.coalesce(F.sum(F.octet_length("mask")).over(before), F.lit(0)).cast("long"))
    return placed.select("conv_id", "turn_no", "token_start", "ids", "mask")


def read_turn(ids: np.ndarray, mask: np.ndarray, decode) -> tuple[str, str, str, int]:
    """Role, text, text under the mask, and number of characters in text form of one formatted turn."""
    marks = np.flatnonzero(ids >= FIRST_RESERVED)
    names = [_BY_ID[int(i)] for i in ids[marks]]
    if names and names[0] == "<s>":
        marks, names, opened = marks[1:], names[1:], len("<s>")
    else:
        opened = 0
    first = int(marks[0]) if len(names) > 1 else (-1 if not opened else 0)
    segment = lambda a, b: decode(ids[a:b].tolist())
    if names[0] == "[ROLE]":
        written_role, text = segment(first + 1, int(marks[1])), segment(int(marks[1]) + 1, int(marks[2]))
        role = unescape(written_role)
    else:
        role = {"[INST]": "user", "[SYS]": "system", "</s>": "assistant"}[names[0]]
        written_role, text = "", segment(first + 1, int(marks[-1]))
    under = unescape(decode(ids[mask.astype(bool)].tolist()))
    return role, unescape(text), under, opened + len(written_role) + len(text) + sum(map(len, names))


def read_turns(formatted: DataFrame, *, ranks: str | None = None) -> DataFrame:
    """Roles, texts and trained texts decoded from the ids: conv_id, turn_no, role, text, loss_text, formatted_chars."""
    prepare(formatted.sparkSession)
    ranks = ranks or default_ranks()
    schema = pa.schema(
        [("conv_id", pa.int64()), ("turn_no", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("loss_text", pa.string()), ("formatted_chars", pa.int64())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        bytes_of = codec(ranks).decode_bytes
        decode = lambda ids: bytes_of(ids).decode("utf-8")
        for batch in batches:
            for conv, turn_no, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn_no", "ids", "mask")), strict=True):
                yield conv, turn_no, *read_turn(np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.uint8), decode)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), schema, lambda row: 4 * (len(row[3]) + len(row[4])) + 64)

    return formatted.select("conv_id", "turn_no", "ids", "mask").mapInArrow(
        run, "conv_id long, turn_no long, role string, text string, loss_text string, formatted_chars long"
    )


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest runs through its texts in order, so a conversation's turns pass one task, as a sorted stream.
    """
    fields = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    schema = pa.schema(fields)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, state = None, None
        for batch in batches:
            for conv, role, text, loss, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss_text", "formatted_chars")), strict=True):
                if state is None or conv != key:
                    if state is not None:
                        yield key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += chars
        if state is not None:
            yield key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), schema, lambda row: 256)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def write_formatted(conversations: DataFrame, folder: str, *, ranks: str | None = None) -> None:
    format_turns(conversations, ranks=ranks).write.parquet(folder)


def read_formatted(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("conv_id long, turn_no long, token_start long, ids binary, mask binary").parquet(folder)

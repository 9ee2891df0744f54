"""Chat formatting by token-level assembly.

Each turn's text is encoded on its own and reserved ids above the vocabulary
are spliced in for the control strings, so no text, whatever it says, can
produce a control id. In the rendered text the same holds: control strings
occurring in content are escaped reversibly. The loss mask covers the tokens
of assistant texts; token places come from prefix sums of segment lengths.

Template: ``<<SYS>>text<</SYS>>`` for system, ``[INST]text[/INST]`` for user,
``<s>text</s>`` for assistant, ``<|role|>name<|text|>text<|end|>`` for any
other role.

Segments are encoded where the rows lie; nothing is gathered per
conversation: the result is one row per turn with its place, so a very long
conversation is many rows. :func:`read_back` parses ids again, streaming over
each conversation in turn order, with memory for one turn.

Defined cases: null role or text is empty; turns go by number, nulls first,
ties by role and text; repeated rows are turns of their own; a null
conversation id is a conversation of its own; an empty table gives no row;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import default_paths, tokens
from ledgerlake.llm.common import prepare, written

# The template's control strings; their ids follow the vocabulary.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>"]
FOREIGN = ["<|endoftext|>", "<|im_start|>", "<|im_end|>"]
AROUND = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
FIRST_RESERVED = 50_257
RESERVED = {c: FIRST_RESERVED + i for i, c in enumerate(CONTROL)}

_INNER = "|".join(re.escape(c[1:]) for c in CONTROL + FOREIGN)
_HOT = re.compile(rf"([\[<])(?={_INNER})")
_MARK = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """Break every control string by a backslash after its first character;
    backslashes of the text are doubled."""
    return _HOT.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _MARK.sub(r"\1", text)


def segments(role: str, text: str) -> list[tuple[str, bool, bool]]:
    """(string, is control, under the loss) parts of one turn."""
    body = escape(text)
    if role in AROUND:
        a, b = AROUND[role]
        return [(a, True, False), (body, False, role == "assistant"), (b, True, False)]
    return [("<|role|>", True, False), (escape(role), False, False), ("<|text|>", True, False), (body, False, False), ("<|end|>", True, False)]


TURN = "conv_id long, turn long, role string, text string"


def format_turns(conversations: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per turn: ``conv_id``, ``position`` (from 0), ``token_start``,
    ``input_ids`` (array<int>), ``loss_start``, ``loss_length`` (the masked
    tokens, places within the turn) and ``chars`` (rendered code points)."""
    prepare(conversations.sparkSession)
    ranks, _ = paths or default_paths()
    source = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches):
        import pyarrow as pa

        encode = tokens(ranks, None)
        for b in batches:
            ids, start, length, chars = [], [], [], []
            parts = [segments(r, t) for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
            plain = iter(encode.batch([s for p in parts for s, control, _ in p if not control]))
            for p in parts:
                row, begin, masked = [], 0, 0
                for s, control, loss in p:
                    piece = np.array([RESERVED[s]], np.int32) if control else next(plain)
                    if loss:
                        begin, masked = sum(map(len, row)), len(piece)
                    row.append(piece)
                ids.append(np.concatenate(row))
                start.append(begin)
                length.append(masked)
                chars.append(sum(len(s) for s, _, _ in p))
            cols = {n: b.column(n) for n in ("conv_id", "turn", "role")}
            cols |= {
                "tie": b.column("h"),
                "input_ids": pa.array(ids, pa.list_(pa.int32())),
                "loss_start": pa.array(start, pa.int32()),
                "loss_length": pa.array(length, pa.int32()),
                "chars": pa.array(chars, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(cols)

    coded = source.withColumn("h", F.xxhash64("text")).mapInArrow(
        run, "conv_id long, turn long, role string, tie long, input_ids array<int>, loss_start int, loss_length int, chars long"
    )
    coded = written(coded, "turns")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "tie")
    place = coded.withColumn("n", F.size("input_ids"))
    return place.select(
        "conv_id",
        (F.row_number().over(order) - 1).cast("long").alias("position"),
        F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("token_start"),
        "input_ids",
        "loss_start",
        "loss_length",
        "chars",
    )


class Reader:
    """Parses the ids of one turn after the other and keeps running digests."""

    def __init__(self, decode):
        self._decode = decode
        self.conv, self.turns, self.loss_chars, self.chars = None, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, loss_start: int, loss_length: int) -> None:
        cut = np.flatnonzero(ids >= FIRST_RESERVED)
        marks = [CONTROL[i - FIRST_RESERVED] for i in ids[cut].tolist()]
        between = [self._decode(ids[a + 1 : b]) for a, b in zip(cut[:-1], cut[1:])]
        if marks[0] == "<|role|>":
            role, text = unescape(between[0]), unescape(between[1])
        else:
            role, text = next(r for r, (a, _) in AROUND.items() if a == marks[0]), unescape(between[0])
        self.turns += 1
        self.chars += sum(map(len, marks)) + sum(map(len, between))
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if loss_length:
            masked = unescape(self._decode(ids[loss_start : loss_start + loss_length]))
            self.loss.update(masked.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(masked)

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(turns: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Per conversation, from the token ids and masks alone: ``conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    ranks, _ = paths or default_paths()
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        import pyarrow as pa

        bpe = tokens(ranks, None)._bpe

        def decode(ids):
            return bpe.decode_bytes(ids.tolist()).decode("utf-8", "surrogatepass")

        held: Reader | None = None
        for b in batches:
            done = []
            flat, off = b.column("input_ids").values.to_numpy(), b.column("input_ids").offsets.to_numpy()
            start, length = b.column("loss_start").to_numpy(), b.column("loss_length").to_numpy()
            for i, conv in enumerate(b.column("conv_id").to_pylist()):
                if held is None or held.conv != conv:
                    if held is not None:
                        done.append(held.row())
                    held = Reader(decode)
                    held.conv = conv
                held.add(flat[off[i] : off[i + 1]], int(start[i]), int(length[i]))
            if done:
                yield _batch(pa, done)
        if held is not None:
            yield _batch(pa, [held.row()])

    names = [c.split()[0] for c in schema.split(", ")]

    def _batch(pa, rows):
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    slim = turns.select("conv_id", "position", "input_ids", "loss_start", "loss_length")
    return slim.repartition("conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(run, schema)


def format_conversations(conversations: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Format all conversations and return what reading the output back gives."""
    return read_back(format_turns(conversations, paths), paths)

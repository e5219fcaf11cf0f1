"""Chat formatting by token-level assembly, with a loss mask.

A conversation becomes <s> and, per turn, an opening marker, the text and </s>.
Markers are reserved ids beyond the tokenizer's own; texts are encoded apart from
them, segment by segment, so no merge crosses a marker. A control string inside
a text is escaped first: ESCAPE is put after the first character of every
control string and of every control string that is escaped already, which
`unescape` takes out again. The loss mask is the running sum of +1 where an
assistant's text begins and -1 where it ends.

The formatted table holds one row per turn (conv_id, place, turn, role, ids,
loss): the ids of the rows of a conversation by `place` are one training example.
Places come from a range sort of the turns and prefix counts, and turns are encoded and decoded
where they then lie, so the turns of a conversation, however many, meet in no task, but
for the digests of `read_back`, which pass over its decoded texts in order.

Defined results: turns are ordered by turn (null last), then role, then text; a
null role or text is empty; roles other than system, user and assistant get a
marker that states them as text; a null conv_id is a conversation of its own;
repeated rows are repeated turns; an empty table formats nothing. Other columns
are not formatted.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import parallelism, ranked

# Markers in the order of their reserved ids; the last opens a role stated as text, closed by the one before.
MARKERS = ("<s>", "</s>", "[SYS]", "[INST]", "[/INST]", "[/ROLE]", "[ROLE]")
OPENERS = {"system": "[SYS]", "user": "[INST]", "assistant": "[/INST]"}
# Control strings of common templates are escaped like our own.
CONTROL = (*MARKERS, "[/SYS]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<unk>", "<pad>")
ESCAPE = "\u2060"  # word joiner
TARGET = "assistant"
FORMATTED = "conv_id long, place long, turn long, role string, ids array<int>, loss array<byte>"

_ESCAPABLE = re.compile("|".join(f"(?<={re.escape(c[0])})(?={ESCAPE}*{re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile("|".join(f"(?<={re.escape(c[0])}){ESCAPE}(?={ESCAPE}*{re.escape(c[1:])})" for c in CONTROL))


def escape(text: str) -> str:
    """No control string is left: each gets one ESCAPE more after its first character."""
    return _ESCAPABLE.sub(ESCAPE, text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


class Codec:
    """A tokenizer and the reserved ids after its own."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.base = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.reserved = {marker: self.base + i for i, marker in enumerate(MARKERS)}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False) if ids else ""


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def assemble(codec: Codec, first: bool, role: str, role_ids: list[int], text_ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """A turn's ids, and its mask as the running sum of the text's begin and end."""
    at = codec.reserved
    opening = [at[OPENERS[role]]] if role in OPENERS else [at["[ROLE]"], *role_ids, at["[/ROLE]"]]
    before = ([at["<s>"]] if first else []) + opening
    ids = np.array([*before, *text_ids, at["</s>"]], np.int32)
    steps = np.zeros(len(ids) + 1, np.int8)
    if role == TARGET:
        steps[len(before)] += 1
        steps[len(before) + len(text_ids)] -= 1
    return ids, np.cumsum(steps[:-1], dtype=np.int8)


def format_turns(turns: DataFrame, path: str) -> DataFrame:
    """Rows of FORMATTED for every row of turns (conv_id, turn, role, text)."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        # A null conv_id is a conversation, a null turn comes last.
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conversation"),
        F.col("turn").isNull().alias("undated"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                roles = part.column("role").to_pylist()
                texts = own.encode([escape(t) for t in part.column("text").to_pylist()])
                stated = own.encode([escape(r) for r in roles])
                first = [place == 0 for place in part.column("place").to_pylist()]
                made = [assemble(own, *turn) for turn in zip(first, roles, stated, texts, strict=True)]
                lists = zip(*made, strict=True)
                columns = [pa.array(c, t) for c, t in zip(lists, (pa.list_(pa.int32()), pa.list_(pa.int8())), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names[:4]), *columns], names=names)

    names = [c.split()[0] for c in FORMATTED.split(", ")]
    placed = ranked(rows, "conversation", ["undated", "turn", "role", "text"], unkept=("undated",))
    return placed.select("conv_id", F.col("rank").alias("place"), "turn", "role", "text").mapInArrow(run, FORMATTED)


def read_turn(codec: Codec, ids: list[int], loss: list[int]) -> tuple[str, str, str, int]:
    """(role, text, text under the mask, code points of the formatted turn), from ids and mask alone."""
    roles = {codec.reserved[marker]: role for role, marker in OPENERS.items()}
    at = codec.reserved
    marks = [i for i, x in enumerate(ids) if x >= codec.base]
    shown = sum(len(MARKERS[ids[i] - codec.base]) for i in marks)
    opener = marks[1] if ids[0] == at["<s>"] else marks[0]
    raw_role = ""
    if ids[opener] == at["[ROLE]"]:
        closed = marks[marks.index(opener) + 1]
        raw_role = codec.decode(ids[opener + 1 : closed])
        role, begin = unescape(raw_role), closed + 1
    else:
        role, begin = roles[ids[opener]], opener + 1
    raw = codec.decode(ids[begin : marks[-1]])
    under = [x for x, m in zip(ids, loss, strict=True) if m]
    return role, unescape(raw), unescape(codec.decode(under)), shown + len(raw_role) + len(raw)


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"


DECODED = "conv_id long, place long, said binary, under string, chars long, tokens long, loss_tokens long"


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """Per conversation, from the formatted ids and masks: digests and counts of READ."""
    spark = formatted.sparkSession

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            out = []
            for ids, loss in zip(batch.column("ids").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                role, text, under, chars = read_turn(own, ids, loss)
                out.append((f"{role}\n{text}\n".encode(), under, chars, len(ids), sum(loss)))
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = (pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("place"), *arrays], names=[c.split()[0] for c in DECODED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = [], None

        def closed(s):
            return (s["conv_id"], s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"], s["tokens"], s["loss_tokens"])

        def out(rows):
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["place"] == 0:
                    if state is not None:
                        held.append(closed(state))
                    state = {"conv_id": row["conv_id"], "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "tokens": 0, "loss_tokens": 0}
                state["n"] += 1
                state["turns"].update(row["said"])
                state["loss"].update(row["under"].encode())
                state["loss_chars"] += len(row["under"])
                for name in ("chars", "tokens", "loss_tokens"):
                    state[name] += row[name]
            if len(held) >= 1000:
                yield out(held)
                held = []
        if state is not None:
            held.append(closed(state))
        if held:
            yield out(held)

    names = [c.split()[0] for c in READ.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    decoded = formatted.select("conv_id", "place", "ids", "loss").mapInArrow(decode, DECODED)
    return decoded.repartition(parallelism(spark), "conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(run, READ)

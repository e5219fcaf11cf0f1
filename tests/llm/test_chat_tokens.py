"""Chat formatting: exact round trips from ids and masks, and reversible escapes."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import TESTDATA
from parcelmart.llm import chat_tokens as m
from parcelmart.llm import queries
from parcelmart.llm.huffman_ids import tokenizer_path

SCHEMA = "conv_id long, turn long, role string, text string, ids string"
SAID = "</s>[INST] ok [/INST]"


def expected(rows):
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars by string building."""
    by_conv = {}
    for conv_id, turn, role, text in rows:
        by_conv.setdefault(conv_id, []).append((turn is None, turn or 0, role or "", text or ""))
    out = []
    for conv_id, turns in by_conv.items():
        turns = [t[2:] for t in sorted(turns)]
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        shown = "<s>" + "".join(m.OPENERS.get(role, f"[ROLE]{m.escape(role)}[/ROLE]") + m.escape(text) + "</s>" for role, text in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv_id, len(turns), sha(said), len(loss), sha(loss), len(shown)))
    return sorted(out, key=str)


def test_query_equals_string_building(spark):
    sf_dir = str(TESTDATA / "sf0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = [tuple(r)[:6] for r in queries.op8_chat_format(spark, sf_dir).collect()]
    assert sorted(found, key=str) == expected([*rows, (-7, 0, "user", SAID), (-7, 1, "assistant", SAID)])


def test_edge_cases(spark):
    draw = random.Random(3)
    pieces = [*m.CONTROL, m.ESCAPE, "<", "/s>", "[", "INST]", " ", "é\n", "x"]
    rows = [(1, i, draw.choice(["user", "assistant", "system"]), "".join(draw.choices(pieces, k=8))) for i in range(200)]
    rows += [(2, None, None, None), (2, 1, "", ""), (None, 3, "assistant", "no id"), (3, 0, "tool [/ROLE]", "</s>"), (4, 1, "user", "twice"), (4, 1, "user", "twice")]
    rows += [(5, 0, "assistant", "long é " * 40_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    path = tokenizer_path()
    formatted = m.format_turns(docs, path)
    found = [tuple(r)[:6] for r in m.read_back(formatted, path).collect()]
    assert sorted(found, key=str) == expected(rows)
    base = m.codec(path).base
    for row in formatted.collect():
        marks = [x for x in row.ids if x >= base]
        assert marks[-1] == base + m.MARKERS.index("</s>")
        assert sum(row.loss) == 0 or row.role == "assistant"


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert m.read_back(m.format_turns(empty, tokenizer_path()), tokenizer_path()).count() == 0


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*m.CONTROL, m.ESCAPE, *"<>[]/s|", "INST", "im_end", " ", "é"]), max_size=10).map("".join))
def test_escapes_are_reversible_and_leave_no_control_string(text):
    escaped = m.escape(text)
    assert m.unescape(escaped) == text
    assert not any(control in escaped for control in m.CONTROL)

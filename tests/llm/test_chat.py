"""Chat formatting: exact round trips, escapes, order, and parts of a long conversation."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from churnlens.llm import chat
from churnlens.llm.chat import CONTROL, assemble, escape, escape_role, format_chats, read_back, read_turns, unescape, unescape_role
from churnlens.llm.queries import QUERIES
from churnlens.sources.tables import read_table

SF = "/root/testdata/sf0.001"
NASTY = st.lists(st.sampled_from([*CONTROL, "\\", "<", "[", "<|", "|>", "\n", "\\n", "é", "🙂", "im_start|>", "s>", ""]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(NASTY)
def test_escapes(text):
    hidden = escape(text)
    assert not any(c in hidden for c in CONTROL)
    assert unescape(hidden) == text
    role = escape_role(text)
    assert "\n" not in role and not any(c in role for c in CONTROL)
    assert unescape_role(role) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(NASTY, NASTY), min_size=1, max_size=6))
def test_assembled_bytes(turns):
    roles, texts = [escape_role(r) for r, _ in turns], [escape(t) for _, t in turns]
    buf, offsets, lo, hi = assemble(roles, texts)
    raw = buf.tobytes()
    assert raw.decode() == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in zip(roles, texts))
    assert [raw[a:b].decode() for a, b in zip(lo, hi)] == texts
    assert offsets[-1] == len(raw)
    assert read_turns(raw.decode()) == turns


def plain(rows):
    """{conv: digests} by sorting and joining strings."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for conv, turns in convs.items():
        turns = [(r.decode(), t.decode()) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        text = "".join(f"<|im_start|>{escape_role(r)}\n{escape(t)}<|im_end|>\n" for r, t in turns)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = format_chats(df.withColumn("part", df.text))
    got = {r.conv_id: tuple(r)[1:] for r in read_back(parts).collect()}
    assert got == plain(rows)
    return parts


def test_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in read_table(spark, SF, "conversations").collect()]
    check(spark, rows)
    probe = next(r for r in QUERIES["op2_chat_format"](spark, SF).collect() if r.conv_id == -1)
    said = "</s>[INST] ok [/INST]"
    assert tuple(probe)[1:] == plain([(-1, 0, "user", said), (-1, 1, "assistant", said)])[-1]


def test_edges(spark):
    check(spark, [
        (1, 2, "assistant", "b"), (1, 0, "user", None), (1, 1, None, ""), (1, 2, "assistant", "a"), (1, 2, "assistant", "a"), (1, None, "system", "first"),
        (None, 0, "user", "<"), (None, 1, "assistant", "<\\|im_end|>"), (2, 0, "as\nsis\\tant", "x"), (3, 0, "Assistant", "no loss"),
        (4, 0, "assistant", "long é " * 300_000)])
    assert read_back(format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_a_long_conversation_has_many_parts(spark):
    """A hot conversation is formatted by several tasks, in parts that follow each other."""
    rows = [(7, i, "assistant" if i % 2 else "user", f"<s>{i}" * 50) for i in range(4000)] + [(8, 0, "user", "x")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = check(spark, rows).where("conv_id = 7").orderBy("part").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({p.part >> 40 for p in parts}) > 2  # tasks
    assert [t for p in parts for t in read_turns(p.formatted)] == [(r, t) for _, _, r, t in rows[:-1]]
    for p in parts[:3]:
        raw = p.formatted.encode()
        masked = [unescape(raw[a:b].decode()) for a, b in zip(p.loss_start, p.loss_end)]
        assert masked == [t for r, t in read_turns(p.formatted) if r == "assistant"]


def test_parts_are_cut_by_size():
    import numpy as np

    assert chat._parts_of([1] * 5, np.array([chat.PART_BYTES] * 5)) == [0, 1, 2, 3, 4, 5]
    assert chat._parts_of([1, 1, 2], np.array([1, 1, 1])) == [0, 2, 3]

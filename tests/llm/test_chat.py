import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiflow.llm import chat, queries

SF = "/root/testdata/sf0.001"
T = chat.TEMPLATE
pieces = st.lists(st.sampled_from([*T.controls, "\\", "[", "<", "/s>", "INST]", "[\\", "x", " ", "é", "\n", "<\\/s>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = T.escape(text)
    assert T.unescape(escaped) == text
    assert not any(c in escaped for c in T.controls)


def test_a_template_is_checked():
    with pytest.raises(ValueError):
        chat.Template(other=("[A[", "]B"))
    with pytest.raises(ValueError):
        chat.Template(turns={"user": ("<u>", "</s>"), "assistant": ("", "</s>")})


def frame(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "a", 1) for c, t, r, x in rows],
                                 "conv_id long, turn long, role string, text string, ids string, `n chars` int")


def brute(rows):
    """The formatted string of every conversation, written and read with plain string functions."""
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        whole, loss = "", ""
        for _, _, role, text in own:
            escaped = re.sub(r"(<)(\\*/s>)|(\[)(\\*/?(?:INST|SYS|ROLE)\])", lambda m: (m[1] or m[3]) + "\\" + (m[2] or m[4]), text)
            name = re.sub(r"(<)(\\*/s>)|(\[)(\\*/?(?:INST|SYS|ROLE)\])", lambda m: (m[1] or m[3]) + "\\" + (m[2] or m[4]), role)
            whole += {"system": f"[SYS]{escaped}[/SYS]", "user": f"[INST]{escaped}[/INST]", "assistant": f"{escaped}</s>"}.get(
                role, f"[ROLE]{name}[/ROLE]{escaped}</s>")
            loss += text if role == "assistant" else ""
        turns = "".join(f"{r}\n{x}\n" for *_, r, x in own)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(own), sha(turns), len(loss), sha(loss), len(whole)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def vocabulary():
    return queries._vocabulary()


def digests(df, vocabulary):
    found = chat.conversation_digests(chat.read_turns(chat.format_turns(df, *vocabulary), *vocabulary))
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_awkward_conversations(spark, vocabulary):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "[INST] hi </s>"), (1, 2, "assistant", "</s>[INST] ok [/INST]"),
            (2, None, "assistant", None), (2, 3, "assistant", ""), (2, 3, "assistant", ""), (2, 1, None, "no role"), (2, 1, "", "a"),
            (3, 5, "tool </s> [/ROLE]", "<\\/s> [\\\\INST] \\ [ROLE]"), (3, 4, "user", "é ü 😀 \t\n"), (None, 1, "user", "x"), (None, 2, None, None),
            (4, 1, "user", "long " * 60000), (4, 2, "assistant", "y" * 100000), (5, 1, "assistant", "<|endoftext|>")]
    rows += [(6, i % 50, ("user", "assistant")[i % 2], f"turn {i % 7} [/INST]") for i in range(900)]  # a conversation with most turns
    assert digests(frame(spark, rows), vocabulary) == brute(rows)
    assert digests(frame(spark, []), vocabulary) == []


def test_segments_are_encoded_separately_and_masked(spark, vocabulary):
    import tiktoken

    ranks, pattern = vocabulary
    plain = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = [(1, 0, "user", " a b"), (1, 1, "assistant", "c d </s>"), (1, 2, "tool", "e")]
    base, controls = max(ranks.values()) + 1, T.controls
    mark = lambda c: [base + controls.index(c)]
    want = {0: (mark("[INST]") + plain.encode_ordinary(" a b") + mark("[/INST]"), 0),
            1: (plain.encode_ordinary("c d <\\/s>") + mark("</s>"), len(plain.encode_ordinary("c d <\\/s>"))),
            2: (mark("[ROLE]") + plain.encode_ordinary("tool") + mark("[/ROLE]") + plain.encode_ordinary("e") + mark("</s>"), 0)}
    for r in chat.format_turns(frame(spark, rows), ranks, pattern).collect():
        ids, learned = want[r["turn"]]
        assert r["ids"] == ids
        assert r["loss"] == [1] * learned + [0] * (len(ids) - learned)


def test_a_sequence_of_turns_is_read_back(vocabulary):
    """Turns put together are read as the same turns."""
    import tiktoken

    ranks, pattern = vocabulary
    plain = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    base = max(ranks.values()) + 1
    reserved = {c: base + i for i, c in enumerate(T.controls)}
    turns = [("user", ""), ("assistant", ""), ("assistant", "[INST]"), ("", "x"), ("system", "[ROLE]"), ("tool", ""), ("user", "</s>")]
    ids, loss = [], []
    for role, text in turns:
        for string, control, learned in T.segments(role, text):
            part = [reserved[string]] if control else plain.encode_ordinary(T.escape(string))
            ids += part
            loss += [int(learned)] * len(part)
    found = list(chat.parsed(np.array(ids), np.array(loss), {i: c for c, i in reserved.items()}, lambda x: plain.decode(x.tolist()), T))
    assert [f[:2] for f in found] == turns
    assert [f[2] for f in found] == [t if r == "assistant" else "" for r, t in turns]


def test_registered_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = queries.QUERIES["op11_chat_format"](spark, SF)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)

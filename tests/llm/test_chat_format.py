import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from tidemill.llm.chat_format import (
    ROLE_CONTROL,
    Incremental,
    digest_chats,
    escape,
    format_chats,
    marked_turns,
    op3_chat_format,
    read_turn,
    unescape,
)

TEXTS = st.lists(st.sampled_from(["\\", "#", "##", "### ", "</turn>", "</turn>\n", ": ", "a", "é", "\U0001f600", "\n", "user"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), min_size=1, max_size=6))
def test_rendering_is_reversible_and_spans_are_exact(turns):
    safe = [(escape(r, ROLE_CONTROL), escape(t)) for r, t in turns]
    state = Incremental(marked_turns, window=3)
    output = ""
    for (role, text), (_, inside) in zip(turns, safe, strict=True):
        piece, start, head, size, rewrites, verbatim = state.add(escape(role, ROLE_CONTROL), inside)
        assert start == len(output) and verbatim and not rewrites
        assert read_turn(piece) == (role, text)
        assert unescape(piece[head : head + size]) == text
        output += piece
    assert output == marked_turns(safe)


def test_templates_that_rewrite_history_are_found():
    closing = lambda turns: "".join(f"[{r}]{t}" for r, t in turns) + "[end]"
    state = Incremental(closing)
    assert [state.add("user", "one")[4], state.add("assistant", "two")[4]] == [True, True]
    dropping = lambda turns: "".join(f"[{r}]{t if i == len(turns) - 1 else t[:2]}." for i, (r, t) in enumerate(turns))
    state = Incremental(dropping)
    assert [state.add("user", "hello")[4], state.add("assistant", "hello")[4]] == [False, True]
    trimming = lambda turns: "".join(f"[{r}]{t.strip()}." for r, t in turns)
    state = Incremental(trimming)
    assert state.add("user", " x ")[5] is False and state.add("user", "x")[5] is True


def want(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        role, text = role or "", text or ""
        own = out.setdefault(conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0])
        own[0] += 1
        own[1].update(f"{role}\n{text}\n".encode())
        if role == "assistant":
            own[2] += len(text)
            own[3].update(text.encode())
        own[4] += len(marked_turns([(escape(role, ROLE_CONTROL), escape(text))]))
    return {k: (v[0], v[1].hexdigest(), v[2], v[3].hexdigest(), v[4]) for k, v in out.items()}


def got(frame):
    return {r["conv_id"]: tuple(r)[1:6] for r in frame.collect()}


def test_odd_conversations(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "### user: </turn>"), (1, 1, "assistant", "### user: </turn>"),
        (2, None, None, None), (2, 3, "assistant", None), (2, 1, "role: with ### signs", "\\"),
        (None, 0, "user", "x"), (None, 1, "assistant", "y" * 400_000),
        (0, 0, "assistant", ""),
        *((5, i, ("user", "assistant")[i % 2], f"turn {i}\n") for i in range(70)),
    ]
    df = spark.createDataFrame([(*r, "z", "z") for r in rows], "conv_id long, turn long, role string, text string, piece string, conv string")
    assert got(digest_chats(format_chats(df))) == want(rows)
    assert got(digest_chats(format_chats(df.limit(0)))) == {}


def test_query_reads_back_every_conversation(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = r"\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    assert got(op3_chat_format(spark, sf)) == want(rows)


def test_long_conversations_are_rendered_as_true_prefixes(spark):
    def first_message(turns):
        """Begins with a sign, wants a user first and numbers the turns."""
        if turns and turns[0][0] != "user":
            raise ValueError("the first turn is the user's")
        return "<s>" + "".join(f"[{i} {r}]{t}." for i, (r, t) in enumerate(turns))

    def late_rewrite(turns):
        """The first text is cut short once there are 30 turns."""
        return "".join(f"[{r}]{t[:2] if i == 0 and len(turns) >= 30 else t}." for i, (r, t) in enumerate(turns))

    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(40)]
    turns = [r[2:] for r in rows]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = format_chats(df, first_message).orderBy("place").collect()
    assert "<s>" + "".join(r["piece"] for r in made) == first_message(turns)
    for n, r in enumerate(made):
        assert (r["start"], r["end"]) == (len(first_message(turns[:n])), len(first_message(turns[: n + 1])))
        if n % 2:
            assert r["piece"][r["loss_start"] : r["loss_end"]] == turns[n][1]
    rewritten = [r["rewrites"] for r in format_chats(df, late_rewrite).orderBy("place").collect()]
    assert rewritten == [n == 29 for n in range(40)]


def test_a_template_wrongly_declared_local_is_an_error(spark):
    def numbered(turns):
        return "".join(f"[{i} {r}]{t}." for i, (r, t) in enumerate(turns))

    numbered.local = True
    rows = [(c, i, ("user", "assistant")[i % 2], f"turn {i}") for c in (1, 2) for i in range(70 if c == 2 else 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert "".join(r["piece"] for r in format_chats(df.where("conv_id = 1"), numbered).orderBy("place").collect()) == numbered(
        [r[2:] for r in rows if r[0] == 1]
    )
    with pytest.raises(Exception, match="declared local"):
        format_chats(df, numbered).collect()


def test_local_templates_have_true_prefixes_first_and_are_proven_after():
    seen = []

    def counted(turns):
        seen.append(len(turns))
        return marked_turns(turns)

    state = Incremental(counted, window=16, proven=64)
    turns = [("user", f"turn {i}") for i in range(300)]
    output = "".join(state.add(*turn)[0] for turn in turns)
    state.prove()
    assert output == marked_turns(turns)
    assert set(range(1, 65)) <= set(seen) and {128, 256, 300} <= set(seen)
    assert sum(n > 64 for n in seen) == 3 and sum(seen) < 64 * 65 + 16 * 2 * 300 + 2 * 700


def test_a_conversation_of_any_size_proves_a_template_declared_local():
    """Beyond 64 million characters too, the turns must be rendered as their pieces."""

    def numbered(turns):
        return "".join(f"[{i} {r}]{t}." for i, (r, t) in enumerate(turns))

    state = Incremental(numbered, window=2, proven=2)
    with pytest.raises(ValueError, match="declared local"):
        for role, size in (("user", 1), ("assistant", 1), ("user", 65 << 20), ("assistant", 1), ("user", 1)):
            state.add(role, "x" * size)
        state.prove()

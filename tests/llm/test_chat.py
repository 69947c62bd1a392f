"""Chat windows against their definition, and the texts read back from them."""

from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm import chat

hard = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "/", "s>", "\n", "é", "<\\s>", "[\\\\INST]", "n"]), max_size=8).map("".join)


@given(hard)
@settings(max_examples=400, deadline=None)
def test_escaping_is_reversible_and_leaves_no_control(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROLS)


@given(st.lists(st.tuples(hard, hard), max_size=5))
@settings(max_examples=200, deadline=None)
def test_windows_read_back(turns):
    c = chat._Conversation(10**6, 0)
    for role, text in turns:
        assert c.add(role, text) is None
    window = c.close()
    assert (chat.read_window(window["text"]) if window else []) == turns


def frame(spark, rows):
    full = [(*r, "x") for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, window string")


def test_budget_history_and_masks(spark):
    rows = [(1, 0, "system", "sys one"), (1, 1, "user", "a b c"), (1, 2, "assistant", "d e"), (1, 3, "user", "f"),
            (1, 4, "assistant", "g h i j k l m n"), (1, 5, "user", "o")]
    got = sorted(chat.format_chats(frame(spark, rows), budget=6, history=3).collect(), key=lambda r: r["window"])
    spans = [(r["first_turn"], r["last_turn"], r["n_repeated"], r["n_tokens"]) for r in got]
    # The system turn stays; history before a span holds at most three tokens, whole turns only.
    assert spans == [(0, 1, 0, 5), (2, 3, 2, 8), (4, 4, 3, 13), (5, 5, 1, 3)]
    repeated = [[t for _, t in chat.read_window(r["text"])[: r["n_repeated"]]] for r in got]
    assert repeated == [[], ["sys one", "a b c"], ["sys one", "d e", "f"], ["sys one"]]
    masked = [[r["text"][a:b] for a, b in r["loss"]] for r in got]
    assert masked == [[], ["d e"], ["g h i j k l m n"], []]


def brute(rows):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in (turns, loss)]
        out[conv] = (len(own), sha[0], len(loss), sha[1])
    return out


def test_digests_of_hard_rows(spark):
    held = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", held), (-7, 1, "assistant", held), (2, 1, "assistant", None), (2, 0, None, "x"), (2, None, "user", ""),
            (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, 0, "user", "tie"), (None, 0, "user", "no id"),
            (4, 0, "as\nsistant", "\\n"), (5, 0, "assistant", "long \U0001f600 " * 3000)]
    rows += [(6, i, ["user", "assistant"][i % 2], f"turn {i} " * 20) for i in range(60)]
    for budget, history in [(1024, 256), (50, 30), (1, 0)]:
        windows = chat.format_chats(frame(spark, rows), budget=budget, history=history)
        got = {r["conv_id"]: r for r in chat.digests(windows).collect()}
        read = {k: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for k, r in got.items()}
        assert read == brute(rows)
        assert all(r["formatted_chars"] > 0 for r in got.values())
    assert chat.format_chats(frame(spark, [])).count() == 0

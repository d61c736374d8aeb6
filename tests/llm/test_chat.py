from __future__ import annotations

import brute
import pytest
from hypothesis import given, settings, strategies as st

from ledgerline.llm.chat import conversation_digests, format_turns, parse, render

PIECES = st.sampled_from(
    ["### ", "\\### ", "\\\\### ", "</turn>", "\\</turn>", "\\\\</turn>", "\n", "\r\n", "\\", "### user:\n", "\n</turn>\n", "x", ":"]
)
TEXTS = st.lists(st.one_of(PIECES, st.text(max_size=4)), max_size=10).map("".join)


@settings(max_examples=400, deadline=None)
@given(turns=st.lists(st.tuples(TEXTS, TEXTS), max_size=4))
def test_any_turns_are_read_back(turns):
    whole = "".join(render(role, text) for role, text in turns)
    assert [found[:2] for found in parse(whole)] == turns


def test_only_conflicting_texts_are_escaped():
    assert render("user", "a\\b # ## <turn>") == "### user:\na\\b # ## <turn>\n</turn>\n"
    assert render("user", "### x </turn>") == "### user:\n\\### x \\</turn>\n</turn>\n"
    assert render("user", "\\### Assistant: </turn> ok") == "### user:\n\\\\### Assistant: \\</turn> ok\n</turn>\n"


@pytest.mark.parametrize("bad", ["x", "### user:\nx", "### user\nx\n</turn>\n", "### u:\n### x\n</turn>\n", "### u:\n</turn> \n</turn>\n"])
def test_what_does_not_fit_is_an_error(bad):
    with pytest.raises(ValueError):
        list(parse(bad))


ROWS = [
    (1, 1, "assistant", "second é \U0001f600"),
    (1, 0, "user", "first"),
    (2, 0, None, None),
    (2, 1, "assistant", None),
    (3, 5, "assistant", "\\### Assistant: </turn> ok"),
    (3, 5, "assistant", "\\### Assistant: </turn> ok"),
    (3, None, "a:b\\n\n", "\n</turn>\n### user:\n"),
    (3, 4, "assistant", ""),
    (4, 0, "assistant", "long " * 40_000),
    (None, 0, "assistant", "no id"),
]
SCHEMA = "conv_id long, turn long, role string, text string, formatted string, conversation int"


def test_digests(spark):
    rows = spark.createDataFrame([(*r, "odd", 5) for r in ROWS], SCHEMA).repartition(4)
    got = {r.conversation: tuple(r)[1:] for r in conversation_digests(format_turns(rows)).collect()}
    for conv in {r[0] for r in ROWS}:
        turns = sorted((r for r in ROWS if r[0] == conv), key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in turns]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[conv] == (
            len(turns),
            brute.sha("".join(f"{role}\n{t}\n" for role, t in turns).encode()),
            len(loss),
            brute.sha(loss.encode()),
            sum(len(render(role, t)) for role, t in turns),
        )


def test_many_turns_of_one_conversation_arrive_in_order(spark):
    rows = spark.range(25_000).selectExpr("1L conv_id", "id turn", "'user' role", "string(id) text").repartition(7)
    (row,) = conversation_digests(format_turns(rows)).collect()
    assert row.n_turns == 25_000
    assert row.turns_sha256 == brute.sha("".join(f"user\n{k}\n" for k in range(25_000)).encode())


def test_mask_covers_trained_text_only(spark):
    rows = spark.createDataFrame([(*r, "odd", 5) for r in ROWS], SCHEMA)
    for r in format_turns(rows).collect():
        masked = r.formatted[r.loss_start : r.loss_end]
        assert bool(masked) == (r.role_read == "assistant" and r.text_read != "")


def test_empty(spark):
    rows = spark.createDataFrame([], SCHEMA)
    assert conversation_digests(format_turns(rows)).count() == 0

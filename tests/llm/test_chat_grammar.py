from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from alpenglow.llm import chat_grammar as g

PIECES = st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "<\\\\/s>", "[\\INST]", "<", "[", "\\", "\n", "a", "/s>", "INST]", "é"])
TEXT = st.lists(PIECES, max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["assistant", "user"]) | TEXT, TEXT), max_size=5))
def test_any_turns_come_back(turns):
    rendered = [g.render_turn(role, text)[0] for role, text in turns]
    assert [x[:2] for x in g.parse("".join(rendered))] == turns


@given(TEXT)
def test_escape_is_reversible(text):
    assert g.unescape(g.escape(text)) == text


@pytest.mark.parametrize("broken", ["text", "<s>no end", "<s>[INST]user[/INST]", "<s>a</s>b", "[INST]user\nx[/INST]", "<s>a<s>b</s>"])
def test_what_is_not_grammar_is_refused(broken):
    with pytest.raises(ValueError):
        g.parse(broken)


def test_plain_text_is_left_alone():
    assert g.render_turn("assistant", "fine < text") == ("<s>fine < text</s>", 3, 14, 0)
    assert g.render_turn("user", "ok")[0] == "<s>[INST]user\nok[/INST]"


def test_digest_of_frames(spark):
    rows = [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a"), (1, 2, "assistant", "c"), (2, None, None, None), (2, 0, "user", "x"),
            (2, 0, "user", "x"), (None, 0, "assistant", ""), (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS formatted")
    found = {r["conv_id"]: r for r in g.digest(g.render(frame)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert found[1]["n_turns"] == 3 and found[1]["turns_sha256"] == sha("user\na\nassistant\nb</s>\nassistant\nc\n")
    assert found[1]["loss_sha256"] == sha("b</s>c") and found[1]["loss_chars"] == 6
    assert found[2]["turns_sha256"] == sha("\n\nuser\nx\nuser\nx\n") and found[2]["loss_chars"] == 0
    assert found[None]["n_turns"] == 1 and found[None]["loss_sha256"] == sha("")
    assert found[-1]["loss_sha256"] == sha("</s>[INST] ok [/INST]")
    assert g.digest(g.render(frame.limit(0))).count() == 0


def test_clashing_columns_null_ids_and_very_long_texts(spark):
    long = "word </s> " * 30_000
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", long), (3, 0, "user", long)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    wide = frame.selectExpr("*", "'x' AS formatted", "'y' AS n_turns", "1 AS loss")
    plain, more = (sorted(map(repr, g.digest(g.render(x)).collect())) for x in (frame, wide))
    assert plain == more and len(plain) == 2
    found = {r["conv_id"]: r for r in g.digest(g.render(wide)).collect()}
    assert found[None]["loss_chars"] == len(long) and found[None]["loss_sha256"] == hashlib.sha256(long.encode()).hexdigest()

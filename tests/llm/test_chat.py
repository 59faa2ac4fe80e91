from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trackloom.llm import chat, queries

TEXT = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "a", "/", "é", "\n"]), max_size=8).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "[SEP]"]), TEXT), max_size=6))
def test_round_trip(turns):
    pieces = list(chat.compile_template(chat.TEMPLATE)({"role": r, "text": t} for r, t in turns))
    assert list(chat.read_turns(t for t, _ in pieces)) == turns
    assert "".join(chat.unescape(t) for t, marked in pieces if marked) == "".join(t for r, t in turns if r == "assistant")


def test_constants_are_folded_and_branches_pruned():
    assert chat.parse("a{{ 'b' + 'c' }}d{# note #}{% if 'x' == 'x' %}e{% else %}f{% endif %}") == [("text", "abcd"), ("text", "e")]
    assert chat.parse("{% if not true %}x{% elif m.role == 'a' %}y{% endif %}")[0][0] == "if"


@pytest.mark.parametrize("bad", ["{{ m.__class__ }}", "{{ open('x') }}", "{{ m | upper }}", "{% for x in y %}", "{% endif %}", "{{ }}", "{{ a b }}", "{% import os %}", "{{ 1 }}"])
def test_templates_are_sandboxed(bad):
    with pytest.raises(chat.TemplateError):
        chat.parse(bad)


def test_nulls_and_long_conversations(spark):
    rows = [(1, 0, None, None), (1, None, "user", "first"), (None, 0, "assistant", "x"), *((2, k, "user", f"t{k}") for k in range(3000)), (3, 0, "assistant", "x[INST]\\" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part", "2 as formatted")
    got = {r["conv_id"]: r for r in chat.read_back(chat.render(df)).collect()}
    assert got[1]["n_turns"] == 2 and got[2]["n_turns"] == 3000 and got[None]["loss_chars"] == 1 and got[2]["loss_chars"] == 0
    assert got[3]["loss_chars"] == 8 * 50_000
    assert chat.read_back(chat.render(df.limit(0))).count() == 0


def test_query_has_the_extra_conversation(spark, data):
    row = queries.op5_chat(spark, data).where("conv_id = -7").first()
    assert row["n_turns"] == 2 and row["loss_chars"] == len("</s>[INST] ok [/INST]")

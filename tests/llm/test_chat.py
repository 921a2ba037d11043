import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickerloom.llm import chat


def render(source, messages=()):
    return "".join(s[0] for s in chat.compile_template(source)(iter(messages)) if s)


def test_language():
    m = [{"role": "user", "text": " Hi "}, {"role": "x", "text": "b"}]
    assert render("a{{ 'b' + 'c' }}{% if 1 == 2 %}no{% else %}yes{% endif %}") == "abcyes"
    assert render("{% for m in messages %}{{ loop.index }}{% if loop.first %}F{% endif %}{% if loop.last %}L{% endif %}{{ m['text'] | trim }};{% endfor %}", m) == "1FHi;2Lb;"
    assert render("{% set a = 'q' | upper %}{{ a }}{{ none }}{{ missing.deep.er }}") == "Q"
    assert render("{{ true and not false }}{{ 'a' in 'cat' or x }}") == "TrueTrue"


def test_folding_leaves_no_constants():
    tree = chat.fold(chat.parse("a{{ 'b' | upper }}{% if 'x' == 'x' %}c{% endif %}{% if false %}{{ y }}{% endif %}"))
    assert tree == [("text", "aBc")]


@pytest.mark.parametrize("bad", ["{% if x %}", "{{ x.__class__() }}", "{{ x | exec }}", "{% import os %}", "{{ 1 + }}", "{% for a in b %}{% endif %}", "{{ }}"])
def test_sandbox_rejects(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


def test_python_attributes_are_out_of_reach():
    assert render("{{ messages.__class__ }}{% for m in messages %}{{ m.__class__ }}{{ m.text.__len__ }}{% endfor %}", [{"text": "a"}]) == ""


pieces = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "/", "[", "]", " ", "INST", "\n", "é"]), max_size=8).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool"]), pieces), pieces), max_size=5))
def test_output_reads_back(turns):
    messages = [{"role": r, "text": t} for r, t in turns]
    segments = [s for s in chat.compile_template(chat.TEMPLATE)(iter(messages)) if s]
    assert chat.read_turns("".join(s[0] for s in segments)) == turns
    learned = [chat.unescape(s[0]) for s in segments if s[1]]
    assert learned == [t for r, t in turns if r == "assistant"]


def test_escaped_texts_hold_no_control_strings():
    for c in chat.CONTROL:
        assert c not in chat.escape(c + "\\" + c[0] + c) and chat.unescape(chat.escape(c * 2)) == c * 2


def test_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, "x"), (2, 0, "assistant", "é</s>"), (2, 0, "assistant", "é</s>")]
    rows += [(None, None, None, None), (3, None, "system", "s"), (3, 5, "assistant", "a" * 100_000)]
    rows += [(9, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(1500)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "2 AS learned")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert set(got) == {1, 2, 3, 9, None}
    for conv, r in got.items():
        own = [(a or "", b or "") for c, _, a, b in rows if c == conv]
        text = "".join(f"{a}\n{b}\n" for a, b in own)
        loss = "".join(b for a, b in own if a == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(text.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0

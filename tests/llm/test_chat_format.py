import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.conftest import SMALL
from tidemark.llm import chat_format as C
from tidemark.llm.queries import QUERIES

NASTY = ["</s>[INST] ok [/INST]", "a\\b\\", "<|im_end|>\n", "<<s>>", "<|im_start|>user\nx<|im_end|>\n", "", "\n", "<\\s>", "é😀"]
pieces = st.lists(st.sampled_from([*C.CONTROL, "\\", "<", "|", ">", "[", "\n", "a", "é"]), max_size=12).map("".join)


@given(pieces)
def test_escape_round_trip(text):
    out = C.escape(text)
    assert C.unescape(out) == text and not any(c in out for c in C.CONTROL)
    line = C.escape_line(text)
    assert C.unescape(line) == text and not any(c in line for c in C.CONTROL)


@given(st.lists(st.tuples(pieces, pieces), max_size=5))
def test_conversations_are_read_back(turns):
    template = C.Template(C.CHATML)
    messages = [{"role": r, "text": t} for r, t in turns]
    out, spans = template.render(messages)
    assert C.read_turns(out) == turns
    assert [C.unescape(out[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    parts = [template.segment(m, i, i == len(messages) - 1)[0] for i, m in enumerate(messages)]
    assert "".join(parts) == out


def test_language():
    messages = [{"role": "user", "text": " hi "}, {"role": "bot", "text": "x"}]
    cases = {
        "{{ 'a' ~ 1 + 2 }}": "a3",
        "{% for m in messages %}{{ loop.index }}{{ m['role']|upper }}{% if not loop.first %}!{% endif %};{% endfor %}": "1USER;2BOT!;",
        "{% set x = 'q' %}{{ x }}{{ x in 'qr' }}": "qTrue",
        "{% if 1 == 2 %}a{% elif 2 > 1 and not false %}b{% else %}c{% endif %}": "b",
        "{%- for m in messages -%} {{- m.text|trim -}} {%- endfor -%}": "hix",
        "a{# no #}b{{ nothing }}{{ m.nothing }}": "ab",
        "{{ (1 + 1) == 2 or x }}": "True",
    }
    for source, want in cases.items():
        assert C.Template(source).render(messages)[0] == want, source


def test_constants_are_folded():
    tree = C.Template("a{{ 'b' ~ 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}{% if false %}no{% endif %}").tree
    assert tree == (C.Emit(C.Const("abcd")),)


@pytest.mark.parametrize(
    "source", ["{{ x.__class__ }}", "{{ x['_y'] }}", "{{ x|eval }}", "{{ f(x) }}", "{% import os %}", "{% for m in x %}", "{{ 1 + }}", "{% endif %}", "{{ a ; b }}"]
)
def test_what_is_not_in_the_language(source):
    with pytest.raises(C.TemplateError):
        C.Template(source)


def want(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss)


def test_query(spark):
    got = {r.conv_id: tuple(r)[1:5] for r in QUERIES["op6_chat_format"](spark, SMALL).collect()}
    by = {-1: [("user", NASTY[0]), ("assistant", NASTY[0])]}
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect():
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {k: want(v) for k, v in by.items()}


def test_odd_rows(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY)]
    rows += [(2, 0, None, None), (2, 0, None, None), (2, None, "user", "first"), (None, 1, "x\ny", "null id"), (3, 1, "user", "z" * 2_000_000)]
    turns = spark.createDataFrame([(*r, "other", "other") for r in rows], "conv_id long, turn long, role string, text string, position string, last string")
    got = {r.conv_id: tuple(r)[1:5] for r in C.digests(C.segments(turns)).collect()}
    assert got == {
        1: want([(r, t) for _, _, r, t in rows[: len(NASTY)]]),
        2: want([("user", "first"), ("", ""), ("", "")]),
        3: want([("user", "z" * 2_000_000)]),
        None: want([("x\ny", "null id")]),
    }
    assert C.digests(C.segments(turns.limit(0))).count() == 0

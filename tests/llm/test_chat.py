import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentimill.llm import chat as c

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[/TEXT]", "\\", "<", "[", "s>", "INST]", "/", " ",
          "\n", "ok", "é", "🙂", "[/INST] [INST]", "<<s>>", ""]
SOME = st.lists(st.sampled_from(PIECES), max_size=6).map("".join) | st.text(max_size=12)
ROLES = st.sampled_from(["user", "assistant", "system", "tool", "", "a[TEXT]b", "<s>"])
SCHEMA = "conv_id long, turn long, role string, text string, place string, formatted string, part string"


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(ROLES, SOME), max_size=5))
def test_rendered_turns_are_read_back(turns):
    template, reader = c.compiled(c.DEFAULT)
    text, spans = template.render(turns)
    assert list(reader.read(iter([text]))) == turns
    assert list(reader.read(iter(text))) == turns                         # cut anywhere
    assert [c.Escape.undo(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@settings(max_examples=500, deadline=None)
@given(SOME, SOME, SOME)
def test_escaped_text_holds_no_control_string(before, text, after):
    escape = c.Parser(c.DEFAULT).parse().escape
    escaped = escape(text)
    assert escape.undo(escaped) == text
    for control in escape.controls:
        assert control not in escaped
        for n in range(1, len(control)):                                  # nor is one made with what stands beside it
            assert not escaped.startswith(control[n:]) and not escaped.endswith(control[:n])
    assert not text or not any(escaped in control for control in escape.controls)


def test_language():
    source = ("{# note #}{% control '@@' %}{% set sep = '-' ~ '-' %}<{{ sep }}>{% for m in messages %}"
              "{% if not loop.first and 1 + 1 == 2 %}, {% endif %}{{ loop.index0 + 1 }}:{{ m.role | upper }}"
              "{% generation %}={{ m.text | trim | escape }}{% endgeneration %}{% if loop.last %}.{% endif %}"
              "{% if m.text in 'abc' or m.text | length > 3 %}!{% else %}?{% endif %}{% endfor %}</>")
    text, spans = c.Compiled(source).render([("a", " x@@ "), ("b", "b"), ("c", None)])
    assert text == "<-->1:A=x@\\@\\!, 2:B=b!, 3:C=.!</>"
    assert [text[a:b] for a, b in spans] == ["=x@\\@\\", "=b", "="]
    assert c.Compiled(source).render([]) == ("", [])


def test_constants_are_folded():
    tree = c.Parser("{% set on = 2 > 1 %}{% for m in messages %}a{{ 'b' ~ 'c' | upper }}{% if on and m.text == 'x' %}d{% endif %}"
                    "{% if not on %}never{% elif on %}e{% else %}never{% endif %}{{ 1 + 2 }}{% endfor %}").parse()
    assert tree.turn == (c.Text("abC"), c.If(((c.Op("==", (c.Name("m.text"), c.Const("x"))), (c.Text("d"),)),)), c.Text("e3"))


@pytest.mark.parametrize("source", [
    "no loop", "{% for m in messages %}", "{% for m in others %}{% endfor %}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}",
    "{% for m in messages %}{{ open('x') }}{% endfor %}", "{% for m in messages %}{{ m.text | shell }}{% endfor %}",
    "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}", "{% import os %}{% for m in messages %}{% endfor %}",
    "{% for m in messages %}{{ 1 + 'a' }}{% endfor %}", "{% for m in messages %}{{ ((m.text) }}{% endfor %}", "{{ m.text }}",
    "{% control 'x' %}{% for m in messages %}{% endfor %}", "{% for m in messages %}{{ " + "(" * 99 + "1" + ")" * 99 + " }}{% endfor %}",
    "{% for m in messages %}" + "{% if m.text %}" * 99 + "{% endif %}" * 99 + "{% endfor %}", "x" * 70_000])
def test_what_is_unknown_fails_at_once(source):
    with pytest.raises(c.TemplateError):
        c.Compiled(source)


@pytest.mark.parametrize("turn", ["{{ m.role }}", "@@{{ m.text | escape }}@@", "@@{{ m.role | escape }}{{ m.text | escape }}@@",
                                  "@@{{ m.role | escape }}##{{ m.text | escape }}", "{{ m.role | escape }}@@{{ m.text | escape }}##"])
def test_unreadable_templates(turn):
    source = "{% control '@@', '##' %}{% for m in messages %}" + turn + "{% endfor %}"
    with pytest.raises(c.TemplateError):
        c.Reader(c.Compiled(source).tree)


def test_another_template_reads_back():
    source = ("{% control '<|start|>', '<|mid|>', '<|end|>' %}begin\n{% for m in messages %}<|start|>{{ m.role | escape }}<|mid|>"
              "{% generation %}{{ m.text | escape }}{% endgeneration %}<|end|>\n{% endfor %}finish")
    template = c.Compiled(source)
    turns = [("a|", "x<|end|>y<"), ("", "|>"), ("<|mid|>", "\\<|end|>\n")]
    text, _ = template.render(turns)
    assert text.startswith("begin\n") and text.endswith("finish")
    assert list(c.Reader(template.tree).read(iter([text[:9], text[9:30], text[30:]]))) == turns
    with pytest.raises(ValueError):
        list(c.Reader(template.tree).read(iter([text[:-1]])))


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((-1 if turn is None else turn, role or "", text or ""))
    out = set()
    template, _ = c.compiled(c.DEFAULT)
    for conv, own in turns.items():
        own = [(r, t) for _, r, t in sorted(own, key=lambda x: (x[0], x[1], x[2].encode()))]
        said = "".join(t for r, t in own if r == "assistant")
        out.add((conv, len(own), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest(), len(said),
                 hashlib.sha256(said.encode()).hexdigest(), len(template.render(own)[0])))
    return out


def run(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, "p", "f", "q") for r in rows], SCHEMA).repartition(parts)
    got = c.round_trip(df).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {tuple(r) for r in got}


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "</s>"), (1, 2, None, "x"), (2, 0, None, None), (None, 0, "user", "no id"),
            (None, None, "assistant", "null turn"), (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "assistant", "b"),
            (3, 0, "assistant", "a"), (4, 5, "tool", "long " * 300_000), (4, 2, "assistant", "\\" * 999), (5, 0, "assistant", ""),
            (6, 0, "user", "x" * 70 + "b"), (6, 0, "user", "x" * 70 + "a")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == set()
    assert run(spark, rows[:1]) == brute(rows[:1])


def test_a_conversation_of_many_rows_is_formatted_by_many_tasks(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i} [INST]") for i in range(4000)]
    rows += [(100 + i, j, "user", f"{i} {j}") for i in range(300) for j in range(3)]
    assert run(spark, rows) == brute(rows)
    df = spark.createDataFrame([(*r, "p", "f", "q") for r in rows], SCHEMA)
    tasks = c.placed_turns(df).filter("conv_id = 7")
    assert sorted(r.place for r in tasks.collect()) == list(range(4000))
    assert tasks.filter("last").count() == 1


def test_two_planted_texts(spark):
    like = spark.createDataFrame([], SCHEMA).select("conv_id", "turn", "role", "text")
    assert {tuple(r) for r in c.round_trip(c.planted(spark, like)).collect()} == brute(
        [(-1, k, r, "</s>[INST] ok [/INST]") for k, r in enumerate(("user", "assistant"))])

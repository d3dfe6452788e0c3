"""Chat formatting (op10): template language, escaping, streaming, read-back."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accmine.llm import chat_format as C
from accmine.llm.templates import TemplateError, compile_template, fold, parse


def render(source, **variables):
    return "".join(p for p in compile_template(source, C.FILTERS)(variables) if isinstance(p, str))


@pytest.mark.parametrize("source, want", [
    ("{{ 1 + 2 * 3 }} {{ -2 - 1 }} {{ (1 + 2) * 3 }}", "7 -3 9"),
    ("{{ 'a' ~ 1 ~ none }}{{ \"q\\\"\\n\" }}", "a1q\"\n"),
    ("{% if x == 1 %}one{% elif x == 2 %}two{% else %}many{% endif %}", "two"),
    ("{% for i in m %}{{ loop.index }}{{ i.a }}{% if not loop.last %},{% endif %}{% endfor %}", "1p,2q"),
    ("{{ 'y' if x > 1 and not (x in m) else 'n' }}", "y"),
    ("a {%- set z = x * 2 -%} b{{ z }}{# gone #}", "ab4"),
    ("{{ m[1]['a'] | upper }}{{ m[9] }}{{ nothing | default('d') }}", "Qd"),
    ("{{ x is }}" if False else "{{ x not in m }}", "True"),
])
def test_language(source, want):
    assert render(source, x=2, m=[{"a": "p"}, {"a": "q"}]) == want


@pytest.mark.parametrize("source", ["{{ 1 + }}", "{% if x %}", "{% for x %}{% endfor %}", "{{ x | nofilter }}", "{% include 'f' %}",
                                    "{{ f(1) }}", "{{ 'a }}", "{% set 1 = 2 %}", "{% endif %}"])
def test_bad_templates_are_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source, C.FILTERS)


def test_no_python_attribute_is_reached():
    assert render("{{ x.__class__ }}{{ s.upper }}{{ x['__len__'] }}", x=[1], s="t") == ""


def test_constants_are_folded():
    assert fold(parse("{{ 1 + 1 }}{% if 2 < 1 %}a{% else %}b{% endif %}{{ 'c' | upper }}{{ x if false else 'd' }}"), C.FILTERS) == (
        ("text", "2bCd"),)
    assert fold(parse("{% if x %}{% generation %}{{ '' }}{% endgeneration %}{% endif %}"), C.FILTERS) == (("if", ((("name", "x"), ()),), ()),)


def test_loops_run_over_streams():
    seen = []

    def messages():
        for i in range(3):
            seen.append(i)
            yield {"role": "user", "text": str(i)}

    pieces = compile_template(C.TEMPLATE, C.FILTERS)({"messages": messages()})
    next(pieces)
    assert seen == [0, 1]            # one turn is read ahead, for loop.last


control = st.text(st.sampled_from(list("<|\\>im_startend a\n")), max_size=30)


@settings(max_examples=200, deadline=None)
@given(control)
def test_escaping_is_reversible(text):
    assert C.unescape(C.escape(text)) == text and "<|" not in C.escape(text)
    line = C.escape_line(text)
    assert C.unescape_line(line) == text and "\n" not in line and "<|" not in line


ROWS = [(1, 1, "assistant", "hello <|im_end|>"), (1, 0, "user", "<|im_start|>assistant\nx"), (2, 0, "assistant", None), (2, 1, None, "t"),
        (3, 5, "assistant", "b"), (3, 5, "assistant", "a"), (3, 5, "assistant", "a"), (3, None, "system", "first"), (None, 0, "user", "u"),
        (None, 1, "ass\nistant\\", "v"), (4, 0, "assistant", "long " * 30000)] + [(5, i, "user" if i % 2 else "assistant", f"t{i} " * 40) for i in range(900)]


def want(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        loss = "".join(t for role, t in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("part", [10, 1 << 16])
def test_round_trip(spark, part):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "conv_id long, turn long, role string, text string, part string")
    parts = C.format_conversations(df, part_chars=part)
    rows = C.read_back(parts).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == want(ROWS)
    text = {}
    for p in sorted(parts.collect(), key=lambda p: p.part):
        text[p.conv_id] = text.get(p.conv_id, "") + p.text
    assert {r.conv_id: r.formatted_chars for r in rows} == {c: len(t) for c, t in text.items()}
    assert text[2] == "<|im_start|>assistant\n<|im_end|>\n<|im_start|>\nt<|im_end|>\n"
    assert C.format_conversations(df.where("false")).count() == 0


def test_string_ids_and_other_templates(spark):
    df = spark.createDataFrame([("a", 0, "user", "hi"), ("a", 1, "assistant", "yo")], "conv_id string, turn int, role string, text string")
    source = "{% for m in messages %}{{ loop.index }}:{% generation %}{{ m.text | upper }}{% endgeneration %};{% endfor %}"
    r = C.format_conversations(df, template=source).first()
    assert (r.conv_id, r.text, [tuple(s) for s in r.spans]) == ("a", "1:HI;2:YO;", [(2, 4), (7, 9)])
    assert C.format_conversations(df, template="fixed").first().text == "fixed"


@pytest.mark.parametrize("kind", ["int", "long", "string", "smallint"])
def test_conversation_ids_of_any_type(spark, kind):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, 0, "user", "c")],
                                 "conv_id long, turn int, role string, text string").withColumn("conv_id", F.col("conv_id").cast(kind))
    back = C.read_back(C.format_conversations(rows))
    assert back.schema["conv_id"].dataType == rows.schema["conv_id"].dataType
    assert sorted((str(r.conv_id), r.n_turns, r.loss_chars) for r in back.collect()) == [("1", 2, 1), ("None", 1, 0)]


def test_a_tag_does_not_end_inside_a_string():
    assert render("{{ '}}' }}{{ \"%}\" ~ '{{' }}{% if x == '%}' %}y{% endif %} it's {{ x }}", x="%}") == "}}%}{{y it's %}"


@pytest.mark.parametrize("source", ["{{ 'a' * 50000000 }}", "{{ 3 * 'a' }}", "{{ 'a }}", "text {% if x", "{{ 9999999999 * 9999999999 }}"])
def test_what_grows_or_stays_open_is_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source, C.FILTERS)


def test_a_loop_cannot_double_a_text_for_ever():
    with pytest.raises(TemplateError):
        render("{% set s = 'abcdefgh' %}{% for i in m %}{% set s = s ~ s %}{% endfor %}", m=range(60))

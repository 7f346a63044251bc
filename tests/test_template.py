"""Templates as Column expressions, against what the template language gives by hand."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunefeed.functions.chat import render_chat, render_prompt
from tunefeed.functions.messages import MESSAGES
from tunefeed.functions.template import TemplateError, compile_template
from tunefeed.operators.training_text import append_text, turns_to_text
from tunefeed.plans.queries import BRACKETS, LINES, NUMBERED

TALK = [("system", "Be brief."), ("user", " Hi\n"), ("assistant", "Hello."), ("user", "Bye"), ("assistant", "Bye!")]
SHORT = [("user", "One"), ("assistant", "Two")]


@pytest.fixture(scope="module")
def rows(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("messages", MESSAGES)])
    return spark.createDataFrame([(0, TALK), (1, SHORT), (2, []), (3, None), (4, [("user", None), (None, "x")])], schema)


def texts(rows, source, prompt=False, **variables):
    template = compile_template(source, **variables)
    render = render_prompt if prompt else render_chat
    return [r.t for r in rows.select("id", render(F.col("messages"), template).alias("t")).orderBy("id").collect()]


def test_three_forms(rows):
    lines = texts(rows, LINES, prompt=True)
    assert lines[1] == "<|im_start|>user\nOne<|im_end|>\n<|im_start|>assistant\nTwo<|im_end|>\n<|im_start|>assistant\n"
    assert lines[2:] == ["<|im_start|>assistant\n", None, "<|im_start|>user\n<|im_end|>\n<|im_start|>\nx<|im_end|>\n<|im_start|>assistant\n"]
    brackets = texts(rows, BRACKETS, bos_token="<s>", eos_token="</s>")
    assert brackets[0] == "<s>[INST] <<SYS>>\nBe brief.\n<</SYS>>\n\n Hi [/INST] Hello. </s><s>[INST] Bye [/INST] Bye! </s>"
    assert brackets[1] == "<s>[INST] One [/INST] Two </s>" and brackets[2:4] == ["", None]
    numbered = texts(rows, NUMBERED, bos_token="<s>")
    assert numbered[0] == "<s><USER 1/4>Hi\n<model 2/4>Hello.\n<USER 3/4>Bye\n<model 4/4>Bye!"
    assert texts(rows, NUMBERED, prompt=True, bos_token="<s>")[1:3] == ["<s><USER 1/2>One\n<model 2/2>Two\n<model>", "<s><model>"]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        # White space: a block takes the line break behind it and the blanks before it.
        ("a\n  {% if true %}\nb\n  {% endif %}\nc\n", "a\nb\nc"),
        ("a\n  {%+ if true %}b{% endif %}", "a\n  b"),
        ("a {%- if true -%}  b  {%- endif %} c", "ab c"),
        ("a\n  {{ 'x' }}\n  b", "a\n  x\n  b"),
        ("a\n  {{- 'x' -}}\n  b", "axb"),
        ("a\n{# no\n%} #}\nb{#- no -#} c", "a\nbc"),
        ("{% if true %}\n\n{% endif %}", "\n"),
        ("x\n\n", "x\n"),
        ("{{ '%}' ~ \"}}\" ~ '\\t\\'' }}", "%}}}\t'"),
        # Expressions.
        ("{{ 1 + 2 * 3 - 7 // 2 }}|{{ -1 % 3 }}|{{ (1 + 2) * 3 }}", "4|2|9"),
        ("{{ 'a' + 'b' ~ 1 ~ none ~ true }}|{{ missing }}|{{ none }}", "ab1NoneTrue||None"),
        ("{{ 'y' if 1 < 2 and not 2 <= 1 else 'n' }}{{ 'z' if false }}", "y"),
        ("{{ missing | default('d') }}{{ '' | default('e') }}{{ '' | default('e', true) }}", "de"),
        ("{{ 'x' if missing is defined else 'y' }}{{ 'x' if messages is defined else 'y' }}", "yx"),
        ("{{ messages | length }}|{{ messages[-1].role }}|{{ (messages | first).role }}|{{ messages[9].role }}", "5|assistant|system|"),
        ("{% for m in messages[1:-1] %}{{ loop.index0 }}{{ m['role'] }} {% endfor %}", "0user 1assistant 2user "),
        ("{% for m in messages[-2:] %}{{ m.content }}{% endfor %}{% for m in messages[7:] %}x{% endfor %}", "ByeBye!"),
        ("{% for m in messages if m.role in ['user', 'tool'] %}{{ loop.index }}/{{ loop.length }}{% endfor %}", "1/22/2"),
        ("{% for m in messages %}{{ '-' if loop.previtem is defined and loop.previtem.role == 'user' else '+' }}{% endfor %}", "++-+-"),
        ("{% for m in messages %}{{ loop.nextitem.role ~ ',' if not loop.last }}{% endfor %}", "user,assistant,user,assistant,"),
        ("{% for m in messages %}{% if (m.role == 'user') == (loop.index0 % 2 == 1) %}y{% else %}n{% endif %}{% endfor %}", "yyyyy"),
        ("{% for m in messages %}{% if 'y' in m.content and m.content.startswith('B') %}{{ loop.revindex }}{% endif %}{% endfor %}", "21"),
        ("{% for m in messages %}{{ m.content.strip('.! \\n') | upper }}{% endfor %}", "BE BRIEFHIHELLOBYEBYE"),
        ("{% for m in messages %}{{ m.content | replace('B', 'b') | trim }};{% endfor %}", "be brief.;Hi;Hello.;bye;bye!;"),
        # A name set in a loop is gone after it; one set in a branch stays.
        ("{% set x = 'a' %}{% for m in messages %}{% set x = m.role %}{% endfor %}{{ x }}", "a"),
        ("{% if messages[0].role == 'user' %}{% set x = 'a' %}{% else %}{% set x = 'b' %}{% set y = 'c' %}{% endif %}{{ x ~ y }}", "bc"),
        ("{% for a in messages[:2] %}{% for b in messages[:2] %}{{ loop.index }}{% endfor %}{{ loop.index }};{% endfor %}", "121;122;"),
        ("{% if false %}{{ raise_exception('never') }}{% elif messages %}{% generation %}g{% endgeneration %}{% endif %}", "g"),
        ("{{ messages[0].role or 'none' }}{{ missing or 'none' }}{{ messages[0].role and 'x' }}", "systemnonex"),
        ("{% if tools and tools.first.name or messages[0].role == 'user' %}a{% elif messages[1].role == 'user' and true %}b{% endif %}", "b"),
        ("{{ 'p' if add_generation_prompt else 'q' }}{% if tools %}{{ tools.name }}{% endif %}", "q"),
    ],
)
def test_language(rows, source, want):
    assert texts(rows.filter("id = 0"), source) == [want]


def test_raise_only_where_the_branch_is_taken(rows):
    source = "{% for m in messages %}{% if m.role not in ['user', 'assistant'] %}{{ raise_exception('role ' ~ m.role) }}{% endif %}{{ m.role }}{% endfor %}"
    assert texts(rows.filter("id IN (1, 2)"), source) == ["userassistant", ""]
    with pytest.raises(Exception, match="role system"):
        texts(rows.filter("id = 0"), source)


@pytest.mark.parametrize(
    ("source", "named"),
    [
        ("{% macro f() %}{% endmacro %}", "macro"),
        ("{{ range(3) }}", "range"),
        ("{{ messages | tojson }}", "tojson"),
        ("{{ messages }}", "messages"),
        ("{{ messages[0].role.title() }}", "title"),
        ("{% for m in messages %}", "without an end"),
        ("{% endif %}", "endif"),
        ("{% for k, v in messages %}{% endfor %}", "loop"),
        ("{{ 1.5 }}", "1.5"),
        ("{{ 'a' - 1 }}", "text - number"),
        ("{% if messages[0].role == 'a' %}{% set x = 1 %}{% else %}{% set x = 'a' %}{% endif %}", "number in one branch"),
        ("{% set ns.x = 1 %}", "ns.x"),
        ("{{ loop.depth if false }}{% for m in messages %}{{ loop.depth }}{% endfor %}", "depth"),
        ("text {% if", "without an end"),
    ],
)
def test_what_is_not_known_is_refused(spark, source, named):
    with pytest.raises(TemplateError, match=named):
        compile_template(source)


def test_no_python_per_row(spark, rows):
    plan = rows.select(render_chat(F.col("messages"), compile_template(NUMBERED)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_training_text_takes_a_template(spark):
    template = compile_template(LINES)
    df = spark.createDataFrame([(1, "Do", None, " it "), (2, None, None, None)], "id int, instruction string, input string, output string")
    got = {r.id: r.text for r in append_text(df, template).collect()}
    assert got[1] == "<|im_start|>system\n/no_think<|im_end|>\n<|im_start|>user\nDo<|im_end|>\n<|im_start|>assistant\nit<|im_end|>\n"
    turns = spark.createDataFrame([(7, 1, "assistant", "b"), (7, 0, "user", "a")], "conv_id int, turn int, role string, text string")
    assert [tuple(r) for r in turns_to_text(turns, template).collect()] == [
        (7, "<|im_start|>system\n/no_think<|im_end|>\n<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n")
    ]

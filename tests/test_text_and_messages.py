import random

import pytest
from pyspark.sql import functions as F

from tunefeed.functions.chat import ChatTemplate, render_chat, render_prompt
from tunefeed.functions.messages import MESSAGES, detect_shape, ensure_system_turn
from tunefeed.functions.text import PY_WS, build_user_text, clean_text
from tunefeed.operators.training_text import (
    append_text,
    project_text,
    turns_to_conversations,
    turns_to_text,
    with_messages,
)
from tunefeed.plans.views import mixed_rows

IDEOGRAPHIC = chr(0x3000)


def expected_messages(row):
    """The rule, row by row."""
    if row.get("conversations"):
        turns = [(t["role"], t["content"]) for t in row["conversations"]]
        return turns if turns[0][0] == "system" else [("system", "/no_think"), *turns]
    inst, inp, out = ((row.get(c) or "").strip() for c in ("instruction", "input", "output"))
    user = inst + (f"\n\n[入力]\n{inp}" if inp else "")
    return [("system", "/no_think"), ("user", user), ("assistant", out)]


def expected_text(row):
    return "\n".join(f"<|{r or ''}|>{c or ''}<|end|>" for r, c in expected_messages(row))


SCHEMA = (
    "id int, instruction string, input string, output string, "
    "conversations array<struct<role:string,content:string>>"
)


def random_rows(n, seed=5):
    rng = random.Random(seed)
    words = ["a", "日本", "é", "x y", ""]

    def text():
        if rng.random() < 0.15:
            return None
        pad = "".join(rng.choice(PY_WS) for _ in range(rng.randrange(3)))
        return pad + rng.choice(words) + "".join(rng.choice(PY_WS) for _ in range(rng.randrange(3)))

    def conversation():
        roles = ["system", "user", "assistant", "System", None]
        return [(rng.choice(roles), text()) for _ in range(rng.randrange(4))]

    return [
        (i, text(), text(), text(), conversation() if rng.random() < 0.6 else None)
        for i in range(n)
    ]


def as_dict(row):
    d = row.asDict(recursive=True)
    return d


def test_strip_set_is_pythons():
    assert sorted(PY_WS) == [chr(i) for i in range(0x110000) if chr(i).isspace()]


@pytest.mark.parametrize(
    "raw, clean",
    [
        (None, ""),
        ("", ""),
        (f"{IDEOGRAPHIC}a{IDEOGRAPHIC}", "a"),
        (f"a{IDEOGRAPHIC}b", f"a{IDEOGRAPHIC}b"),
        ("\t\n\x1c\x85 a ", "a"),
        ("​a", "​a"),
    ],
)
def test_clean_text(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(clean_text(F.col("c"))).first()[0] == clean


@pytest.mark.parametrize(
    "inst, inp, user",
    [
        ("do", None, "do"),
        ("do", f"\t{IDEOGRAPHIC}", "do"),
        ("", "x", "\n\n[入力]\nx"),
        (" do ", " x ", "do\n\n[入力]\nx"),
        (None, None, ""),
    ],
)
def test_build_user_text(spark, inst, inp, user):
    df = spark.createDataFrame([(inst, inp)], "a string, b string")
    assert df.select(build_user_text(F.col("a"), F.col("b"))).first()[0] == user


@pytest.mark.parametrize(
    "conv, n_turns, first",
    [
        ([("user", "  a ")], 2, ("system", "/no_think")),
        ([(None, "a")], 2, ("system", "/no_think")),
        ([("System", "a"), ("user", "b")], 3, ("system", "/no_think")),
        ([("user", "b"), ("system", "s")], 3, ("system", "/no_think")),
        ([("system", "s"), ("user", "b")], 2, ("system", "s")),
    ],
)
def test_ensure_system_turn(spark, conv, n_turns, first):
    df = spark.createDataFrame([(conv,)], "c array<struct<role:string,content:string>>")
    got = df.select(ensure_system_turn(F.col("c"))).first()[0]
    assert (len(got), tuple(got[0])) == (n_turns, first)
    assert [tuple(t) for t in got[-len(conv):]] == conv


def test_detect_shape(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [("user", "a")])], f"id int, c {MESSAGES.simpleString()}")
    got = df.select("id", detect_shape(F.col("c"))).collect()
    assert dict(map(tuple, got)) == {1: "triple", 2: "triple", 3: "conversation"}


def test_random_rows_follow_the_rule(spark):
    df = spark.createDataFrame(random_rows(400), SCHEMA)
    for row in append_text(with_messages(df)).collect():
        d = as_dict(row)
        assert [(m["role"], m["content"]) for m in d["messages"]] == expected_messages(d)
        assert d["text"] == expected_text(d)


def test_mixed_view_follows_the_rule(spark):
    rows = append_text(mixed_rows(spark, "/root/testdata/sf0.01")).collect()
    assert len(rows) == 100
    for row in rows:
        assert row["text"] == expected_text(as_dict(row))


def test_short_cut_for_triples_equals_the_array_form(spark):
    df = spark.createDataFrame(random_rows(100), SCHEMA).drop("conversations")
    both = with_messages(df).select(render_chat(F.col("messages")).alias("a"), "id")
    got = project_text(df, keep=("id",)).join(both, "id")
    assert got.filter(~F.col("text").eqNullSafe(F.col("a"))).count() == 0
    assert got.count() == 100


@pytest.mark.parametrize("columns", [["output"], ["instruction"], ["conversations"], ["other"]])
def test_missing_columns_count_as_null(spark, columns):
    df = spark.createDataFrame(random_rows(30), SCHEMA).withColumn("other", F.lit(1))
    for row in append_text(df.select(*columns)).collect():
        assert row["text"] == expected_text(as_dict(row))


def test_other_turn_keys_are_dropped_and_order_does_not_matter(spark):
    df = spark.createDataFrame(
        [([("b", 1, "user")],)], "conversations array<struct<content:string,weight:int,role:string>>"
    )
    got = with_messages(df).first()["messages"]
    assert [tuple(m) for m in got] == [("system", "/no_think"), ("user", "b")]


def test_turns_may_be_maps(spark):
    df = spark.createDataFrame(
        [([{"role": "system", "content": "s"}, {"content": "c", "x": "y"}],)],
        "conversations array<map<string,string>>",
    )
    row = append_text(with_messages(df)).first()
    assert [tuple(m) for m in row["messages"]] == [("system", "s"), (None, "c")]
    assert row["text"] == "<|system|>s<|end|>\n<||>c<|end|>"


def test_project_keeps_text_only(spark):
    df = spark.createDataFrame(random_rows(5), SCHEMA)
    assert project_text(df).columns == ["text"]
    assert append_text(df).columns == [*df.columns, "text"]


def test_template_markers_are_parameters(spark):
    df = spark.createDataFrame([([("user", "a"), ("assistant", "b")],)], f"m {MESSAGES.simpleString()}")
    template = ChatTemplate("[", "]", "!", "/")
    row = df.select(
        render_chat(F.col("m"), template).alias("c"), render_prompt(F.col("m"), template).alias("p")
    ).first()
    assert row["c"] == "[user]a!/[assistant]b!"
    assert row["p"] == "[user]a!/[assistant]b!/[assistant]"


def test_one_conversation_with_a_third_of_all_turns(spark):
    """Gathering in parts gives the same as gathering at once."""
    turns = [(0, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(500)]
    turns += [(c, t, "system" if t == 0 and c % 2 else "user", f"{c}-{t}") for c in range(1, 251) for t in range(4)]
    random.Random(1).shuffle(turns)
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    expected = {}
    for c, _, role, text in sorted(turns, key=lambda r: r[:2]):
        expected.setdefault(c, []).append({"role": role, "content": text})
    for gather in (64, 4096):
        conv = turns_to_conversations(df, gather_turns=gather)
        got = {r["conv_id"]: as_dict(r)["conversations"] for r in conv.collect()}
        assert got == expected
        texts = {r["conv_id"]: r["text"] for r in turns_to_text(df, gather_turns=gather).collect()}
        assert texts == {c: expected_text({"conversations": v}) for c, v in expected.items()}

import hashlib
import re

import numpy as np
import pytest

from tunefeed.llm import positional_index
from tunefeed.llm.positional_index import build_index, contamination, drop_contaminated, phrase_matches, proximity_matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    by_size = {}
    for w in windows:
        by_size.setdefault(len(w), set()).add(w)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n, known in by_size.items():
            for i in range(len(w) - n + 1):
                if (t := tuple(w[i : i + n])) in known:
                    hit |= set(range(i, i + n))
                    found |= windows[t]
        found = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def ours(spark, docs, items):
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, block int, keys string")
    test = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, n_words int")
    return sorted((tuple(r) for r in contamination(build_index(df), test).collect()), key=repr)


def test_edges(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [
        (1, "x " + item.upper() + " y"),
        (2, item.replace("five", "5")),
        (3, None),
        (4, ""),
        (5, "one two three four five"),
        (5, "six seven eight nine ten eleven"),  # would go on from the row before
        (None, item + " " + item),
        (7, "tiny é word, again: tiny É word"),
        (8, "a " * 50000 + item),
    ]
    items = [(1, item), (2, item), (10, "tiny é"), (None, "again"), (11, None), (12, ""), (9, "-- !!"), (1, "a a a")]
    assert ours(spark, docs, items) == brute(docs, items)
    assert ours(spark, docs, []) == brute(docs, [])
    assert ours(spark, [], items) == []


def test_random_words(spark):
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(rng.choice(list("abc"), rng.integers(0, 400)))) for i in range(60)]
    items = [(i, " ".join(rng.choice(list("abc"), rng.integers(1, 14)))) for i in range(80)]
    assert ours(spark, docs, items) == brute(docs, items)


def test_groups_of_items(spark, monkeypatch):
    monkeypatch.setattr("tunefeed.llm.positional_index.GROUP_WINDOWS", 7)
    rng = np.random.default_rng(4)
    docs = [(i, " ".join(rng.choice(list("ab"), 60))) for i in range(20)]
    items = [(i, " ".join(rng.choice(list("ab"), 9))) for i in range(40)]
    assert ours(spark, docs, items) == brute(docs, items)


def test_a_text_that_many_items_share(spark, monkeypatch):
    """It is one class; what goes to the driver is bounded by distinct windows, not by items."""
    monkeypatch.setattr(positional_index, "GROUP_WINDOWS", 20)
    hot = " ".join(f"hot{i}" for i in range(15))
    items = [(i, hot) for i in range(3000)] + [(5000 + i, f"own {i} words of item {i} that stand here and there {i}") for i in range(40)]
    items += [(5000, hot.upper()), (7, "own 7 words of item 7 that stand here and there 7")]
    docs = [(1, "x " + hot), (2, "see own 7 words of item 7 that stand here and there 7"), (3, "none of them")]
    groups = []
    inner = positional_index._groups
    monkeypatch.setattr(positional_index, "_groups", lambda *a: [groups.append(g) or g for g in inner(*a)])
    assert ours(spark, docs, items) == brute(docs, items)
    assert sum(len(g["sizes"]) for g in groups) == 6 + 40 * 3 and max(len(g["sizes"]) for g in groups) < 50
    assert max(len(c) for g in groups for c in g["classes"]) == 2


def test_matches(spark):
    docs = spark.createDataFrame([(1, "q a b c"), (2, "c x b y a"), (3, "a b"), (4, "c a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c")], "item_id long, text string")
    index = build_index(docs)
    assert sorted(map(tuple, phrase_matches(index, items).collect())) == [(1, 7, 1, 3), (4, 7, 1, 3)]
    near = proximity_matches(index, items, slack=2)
    assert {r.key for r in near.collect()} == {1, 2, 4}
    assert {r.key for r in proximity_matches(index, items, slack=1).collect()} == {1, 4}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    items = spark.read.parquet(f"/root/testdata/{sf}/benchmark.parquet")
    got = sorted((tuple(r) for r in contamination(build_index(docs), items).collect()), key=repr)
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert got == want and any(r[5] for r in got)


def test_texts_stay_where_they_are(spark, monkeypatch):
    """Also where contaminated rows are too many for the session's threshold: only beyond SENT do texts move."""
    item = "one two three four five six seven eight nine ten"
    rows = [(i % 50 if i % 9 else None, f"{i} {item}" if i % 3 == 0 else f"{i} {item[4:]}") for i in range(400)] + [(7, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    monkeypatch.setattr(positional_index, "SENT", 1000, raising=False)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = drop_contaminated(docs, items)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, kept.collect()), key=repr)
        monkeypatch.setattr(positional_index, "SENT", 10)
        assert sorted(map(tuple, drop_contaminated(docs, items).collect()), key=repr) == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert got == sorted((r for r in rows if item not in (r[1] or "")), key=repr)
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_blocks_are_carried_packed(spark):
    """The JVM gets one value of a block's postings, however many terms it has."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(300))) for i in range(40)] + [(40, "")], "doc_id long, text string")
    index = build_index(docs)
    assert {f.name: f.dataType.simpleString() for f in index.schema} == {"keys": "array<bigint>", "sizes": "array<int>", "postings": "binary", "block": "bigint"}
    items = spark.createDataFrame([(1, " ".join(f"w7x{j}" for j in range(50, 60)))], "item_id long, text string")
    assert [tuple(r) for r in phrase_matches(index, items).collect()] == [(7, 1, 50, 10)]

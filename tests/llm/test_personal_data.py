import hashlib
import itertools
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tunefeed.llm import personal_data as pd_
from tunefeed.llm.arrow_text import text_bytes
from tunefeed.llm.personal_data import KINDS, all_spans, find_personal_data, mask_personal_data, pattern_spans, train_field

FIELD = train_field()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    """The four patterns over a whole text, in code points."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


PIECES = ["a", "é", "@", ".", "b.c", "1", "0", "25", "256", "4111111111111111", "4111 1111 1111 1111", " ", "-", "+1", "(", ")", "555-0123", "\n", "%", "00000000001"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), max_size=5))
def test_patterns_equal_a_plain_search(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    found = pd_._by_text(pattern_spans(data, offsets), data, offsets)
    assert [pd_._written(found.get(i, [])) for i in range(len(texts))] == [plain(t) for t in texts]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    field = pd_.Field()
    field.step[:] = rng.normal(0, 1, field.step.shape)
    emissions = rng.normal(0, 2, (9, len(pd_.LABELS)))
    begin, length = np.array([0, 3, 4]), np.array([3, 1, 4])
    got = field.viterbi(emissions, begin, length)
    step = field.step + field.barred
    for b, n in zip(begin, length):
        def value(path, b=b):
            full = [0, *path, 0]
            return sum(step[x, y] for x, y in zip(full, full[1:])) + sum(emissions[b + i, y] for i, y in enumerate(path))
        best = max(itertools.product(range(len(pd_.LABELS)), repeat=int(n)), key=value)
        assert tuple(got[b : b + n]) == best


def test_viterbi_in_pieces_is_the_same():
    rng = np.random.default_rng(2)
    field = pd_.Field()
    field.step[:] = rng.normal(0, 1, field.step.shape)
    length = np.array([1, 300, 2, 2, 40, 7, 300, 1, 90])
    emissions = rng.normal(0, 2, (int(length.sum()), len(pd_.LABELS)))
    begin = np.cumsum(length) - length
    whole = field.viterbi(emissions, begin, length)
    for cells, batch in ((1, 1), (50, 4), (310, 2), (1000, 3)):
        assert np.array_equal(field.viterbi(lambda at: emissions[at], begin, length, cells, batch), whole)


def test_long_runs_take_time_in_proportion():
    for text in ("a" * 10**6 + "@", "a@" * 10**6, "1" * 10**6 + ".1.1.", "1." * 500_000, "+1 " * 300_000, "1" * 10**6):
        data, offsets = text_bytes(pa.array([text]))
        start = time.process_time()
        found = pattern_spans(data, offsets)
        assert time.process_time() - start < 3
        assert all(text.isascii() and a < b <= len(text) for a, b, _ in found)


def test_memory_of_a_long_text_of_numbers_beside_short_ones():
    """A sequence of 40,000 tokens does not make room for each short one in its length."""
    texts = ["12345 " * 40_000, *(f"call {i} now" for i in range(3000))]
    data, offsets = text_bytes(pa.array(texts))
    tracemalloc.start()
    all_spans(FIELD, data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def test_gradient_is_the_slope():
    texts, _ = pd_._labelled(pd_.LABELLED)
    start, end, shape, seq = pd_._tokens(*text_bytes(pa.array(texts[:6])))
    used = seq >= 0
    windows, seq = pd_._windows(shape[used], seq[used]), seq[used]
    length = np.bincount(seq)
    begin = np.cumsum(length) - length
    field = pd_.Field()
    gold = np.zeros(seq.size, np.int64)
    base, slopes = field.gradient(windows, gold, begin, length)
    for w, g in zip([field.single, field.step], [slopes[0], slopes[2]], strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        w[at] += 1e-5
        assert abs((field.gradient(windows, gold, begin, length)[0] - base) / 1e-5 - g[at]) < 1e-2
        w[at] -= 1e-5


def spans(text):
    data, offsets = text_bytes(pa.array([text]))
    return {(KINDS[k], text.encode()[a:b].decode()) for a, b, k in all_spans(FIELD, data, offsets)[1]}


def test_field_finds_what_patterns_miss_and_leaves_the_rest():
    assert spans("so the number (612) 555-0147 is hers") == {("phone", "(612) 555-0147")}
    assert spans("erou the 2362971821055609 the for") == {("card", "2362971821055609")}
    assert spans("pay by 2362 9718 2105 5609 soon") == {("card", "2362 9718 2105 5609")}
    for clean in ("in 1999 and 2001", "version 3.2.1 of 12", 'token = "c80fd45a66f8564ae70609f7b2a26100e64e830e"', "on 2023-05-06 at 10:15", "no digits here @ all", "costs 12,500.00"):
        assert spans(clean) == set(), clean


def test_edges(spark):
    long = "word " * 300_000 + "x.y@z.example"
    texts = [(1, None), (2, ""), (3, "é é +1 (974) 555-3436 é"), (None, "10.0.0.1 10.0.0.256"), (5, long), (5, "4111 1111 1111 1111"), (5, "4111 1111 1111 1111")]
    df = spark.createDataFrame([(*t, "s") for t in texts], "doc_id long, text string, spans string")
    rows = find_personal_data(df, FIELD).collect()
    assert len(rows) == len(texts)
    want = sorted((hashlib.sha256(plain(t or "").encode()).hexdigest()) for _, t in texts)
    assert sorted(r.base_sha256 for r in rows) == want
    assert [r.spans for r in rows if r.doc_id == 3] == ["phone:4:21"]
    assert find_personal_data(df.limit(0), FIELD).collect() == []
    masked = {r.doc_id: r.text for r in mask_personal_data(df.filter("doc_id < 5 OR doc_id IS NULL"), FIELD).collect()}
    assert masked[3] == "é é <PHONE> é" and masked[1] is None and masked[2] == "" and masked[None].startswith("<IP> ")


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    for r in find_personal_data(docs, FIELD).collect():
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        for kind in KINDS:
            assert r[f"n_{kind}"] == want.count(kind + ":")
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert r.n_added == 0 or re.search("[0-9]", texts[r.doc_id])

import re
import zlib

import numpy as np
import pyarrow as pa

from tunefeed.llm import language_id
from tunefeed.llm.arrow_text import text_bytes
from tunefeed.llm.language_id import MARGIN, _threshold, features, fit, identify, languages, train
from tunefeed.llm.queries import op4_language_id


def test_held_out_accuracy_and_calibration(spark):
    rows = op4_language_id(spark, "/root/testdata/sf0.1").collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out]
    right = np.array([r.lang_pred == docs[r.doc_id].lang for r in out])
    assert right.mean() > 0.99
    assert abs(np.mean([r.score for r in out]) - right.mean()) < 0.02
    # No text that is identified rightly is rejected.
    assert not any(r.rejected for r in rows if r.lang_pred == docs[r.doc_id].lang)


def test_edges(spark):
    de, en = "der die und ist nicht straße ", "the and with that is of "
    rows = [(i, de if i % 2 else en, "de" if i % 2 else "en", "x") for i in range(200)]
    odd = [(900, None, "de", "x"), (901, "", "en", "x"), (902, "123 !!", "en", "x"), (903, de * 40_000, None, "x"), (None, "The Of And", None, "x"), (904, "ß", "de", "x")]
    df = spark.createDataFrame(rows + odd + odd[:1], "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in languages(df).collect()}
    assert languages(df).count() == len(rows) + len(odd) + 1
    for key in (900, 901, 902):
        assert (got[key].lang_pred, got[key].score, got[key].rejected) == ("und", 0.0, True)
    assert got[903].lang_pred == "de" and got[None].lang_pred == "en" and got[904].lang_pred in ("de", "en")
    assert all(0 <= r.score <= 1 for r in got.values())
    assert languages(df.limit(0)).collect() == []
    unlabelled = languages(df.drop("lang").selectExpr("*", "CAST(NULL AS string) AS lang")).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
    assert {r.doc_id for r in unlabelled if r.rejected} == {900, 901, 902}


def test_predict_equals_a_plain_mean_and_softmax(spark):
    """One text after the other, one subword after the other."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = train(docs)
    texts = [r.text for r in docs.select("text").limit(40).collect()] + ["x", "é", "a b", "1a"]
    data, offsets = text_bytes(pa.array(texts))
    best, score = model.predict(data, offsets)
    for text, i, p in zip(texts, best, score, strict=True):
        raw = b" " + re.sub(rb"[A-Z]", lambda m: m.group().lower(), text.encode()) + b" "
        grams = [raw[j : j + n] for n in (2, 3, 4) for j in range(len(raw) - n + 1)]
        codes = [(int.from_bytes(g, "little") + (len(g) << 40)) * 0x9E3779B97F4A7C15 % 2**64 >> 48 for g in grams]
        z = np.mean([model.logits[c].astype(float) for c in codes], axis=0) / model.temperature
        want = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert i == want.argmax() and abs(p - want.max()) < 1e-4


def test_rejection_is_calibrated_from_two_sides():
    sure = np.array([0.9, 0.99, 0.999])
    low = _threshold(sure, np.array([0.95] * 50))  # cannot be told apart: by right answers alone
    assert abs(low - 0.9 / (0.9 + 0.1 * MARGIN)) < 1e-9
    between = _threshold(sure, np.array([0.3] * 50))
    assert 0.3 < between < low < 0.9
    assert _threshold(sure[:0], sure) == 0.0


def test_copies_of_a_text_are_drawn_like_other_rows(spark):
    """A third of the rows is one text; the sample stays near its size."""
    other = [(f"the {i} of and", "en") for i in range(2000)] + [(f"der {i} und die", "de") for i in range(2000)]
    df = spark.createDataFrame(other + [("one text that all share", "en")] * 2000, "text string, lang string")
    sizes = []
    fitted = language_id.fit
    try:
        language_id.fit = lambda examples, labels, **rest: sizes.append(len(labels)) or fitted(examples, labels, **rest)
        train(df, sample=400)
    finally:
        language_id.fit = fitted
    assert 300 < sizes[0] < 500


def test_labels_are_not_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = train(docs)
    a = identify(docs, model).select("doc_id", "lang_pred").collect()
    b = identify(docs.selectExpr("doc_id", "text", "'zz' AS lang", "'s' AS source"), model).select("doc_id", "lang_pred").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_features_do_not_cross_texts():
    both = features(np.frombuffer(b"abcd", np.uint8), np.array([0, 2, 4]))
    one = features(np.frombuffer(b"ab", np.uint8), np.array([0, 2]))
    assert both[0][0].tolist() == one[0][0].tolist()
    assert fit([], []).languages == []

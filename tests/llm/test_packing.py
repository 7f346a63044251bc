import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tunefeed.llm.packing import pack_documents, pack_pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(rows, texts, capacity=1024):
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


def test_windows_hold_each_piece_once_within_capacity():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 50, 900):
        sizes = rng.integers(1, 513, n)
        windows = pack_pieces(sizes, 1024)
        assert sorted(i for w in windows for i in w) == list(range(n))
        assert all(sizes[w].sum() <= 1024 for w in windows)
    assert len(windows) * 1024 < sizes.sum() * 1.1


def test_window_count_rises():
    # 3 x 600 fit into two windows by their sum, but not by their sizes.
    assert len(pack_pieces(np.array([600, 600, 600]), 1024)) == 3


def test_edges(spark):
    texts = {1: None, 2: "", 3: "a b" * 3000, 4: "x <|endoftext|> y", 5: "it's   \n\n ok", 6: "été 'sting"}
    df = spark.createDataFrame([(k, v, "z") for k, v in texts.items()], "doc_id long, text string, length string")
    check(pack_documents(df, PATH).collect(), texts)
    assert pack_documents(df.limit(0), PATH).collect() == []
    twice = pack_documents(df.filter("doc_id = 5").union(df.filter("doc_id = 5")), PATH)
    assert twice.filter("start = 0").count() == 2


def test_ids_come_out(spark):
    df = spark.createDataFrame([(1, "one two three " * 500)], "doc_id long, text string")
    rows = pack_documents(df, PATH, emit_ids=True).orderBy("start").collect()
    ids = Tokenizer.from_file(PATH).encode("one two three " * 500).ids
    assert [i for r in rows for i in r.ids] == [*ids, 0]


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = pack_documents(docs, PATH).collect()
    sequences = check(rows, texts)
    assert sum(r.length for r in rows) > 0.9 * 1024 * sequences

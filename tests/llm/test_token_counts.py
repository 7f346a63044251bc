import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa
from tokenizers import Tokenizer

from tunefeed.llm.arrow_text import text_bytes
from tunefeed.llm.token_counts import _count, count_tokens, proven_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PIECES = ["a", "B", "1", "²", "'", "'s", "'re", "'ll", "t", " ", "  ", "\n", "\t", " ", "　", "!", "é", "日本", "\x1c", "\x85", "<|endoftext|>", "\U0001f600"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PIECES)).map("".join), st.text()), max_size=8))
def test_counts_equal_the_library(texts):
    got = _count(PATH, proven_tokens(PATH), *text_bytes(pa.array(texts, pa.string())))
    assert got.tolist() == [len(LIBRARY.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_proof_leaves_out_what_does_not_stand_alone():
    proven = set(proven_tokens(PATH).to_pylist())
    assert b" the" in proven and b"<|endoftext|>" not in proven
    assert all(len(LIBRARY.encode(p.decode()).ids) == 1 for p in list(proven)[:2000])


def test_table(spark):
    texts = {1: None, 2: "", 3: "word " * 40000, 4: "é" * 600}
    df = spark.createDataFrame([(k, v, 0) for k, v in texts.items()], "doc_id long, text string, n_tokens int")
    rows = {r.doc_id: r for r in count_tokens(df, PATH).collect()}
    for k, text in texts.items():
        n = len(LIBRARY.encode(text or "").ids)
        assert (rows[k].n_bytes, rows[k].n_tokens, rows[k].over_limit) == (len((text or "").encode()), n, n > 512)
    assert count_tokens(df.limit(0), PATH).count() == 0
    whole = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: len(e.ids) for r, e in zip(whole.collect(), LIBRARY.encode_batch([r.text or "" for r in whole.collect()], add_special_tokens=False))}
    assert {r.doc_id: r.n_tokens for r in count_tokens(whole, PATH).collect()} == want

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
import test_packing
import test_pigeonring
import test_positional_index
from test_personal_data import plain

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = spark.createDataFrame(
        [
            (None, "An odd row without an id, but with text of its own in it", "en", "s", None),
            (None, "An odd row without an id, but with text of its own in it", "en", "s", None),
            (5_000_000, None, "en", "s", 0),
            (5_000_001, "", None, None, 0),
            (5_000_002, "1234 5678 !!", "en", "s", 12),
        ],
        docs.schema,
    )
    docs = docs.union(extra)
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "personal_data", "packing"]

    def through(name, docs):
        path = f"{tmp_path}/{name}"
        stage[name](spark, docs, SF_DIR).write.parquet(path)
        return spark.read.parquet(path)

    known = through("language_id", docs)
    assert known.columns == columns
    gone = Counter(rows_of(docs)) - Counter(rows_of(known))
    letters = [r for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")]
    assert all(not re.search(r"[^\W\d_]", r[1] or "") for r in gone if r[0] and r[0] >= 5_000_000)
    assert known.count() == len(letters)

    single = through("near_dedup", known)
    rows = known.collect()
    prints = {i: test_pigeonring.fingerprint(r.text) for i, r in enumerate(rows)}
    group = test_pigeonring.groups(prints)
    kept = {}
    for i, r in enumerate(rows):
        best = kept.get(group[i])
        if best is None or (r.doc_id is None, r.doc_id or 0) < (best.doc_id is None, best.doc_id or 0):
            kept[group[i]] = r
    assert rows_of(single) == sorted((tuple(r) for r in kept.values()), key=repr)

    clean = through("decontamination", single)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = single.collect()
    hit = {w[0] for w in test_positional_index.brute([(i, r.text) for i, r in enumerate(rows)], items) if w[5]}
    assert rows_of(clean) == sorted((tuple(r) for i, r in enumerate(rows) if i not in hit), key=repr) and hit

    masked = through("personal_data", clean)
    assert masked.columns == columns and masked.count() == clean.count()
    before = {r.doc_id: r for r in clean.collect()}
    changed = 0
    for r in masked.collect():
        assert plain(r.text) == "" and r.n_chars == len(r.text)
        if not re.search("[0-9@+]", before[r.doc_id].text):
            assert r.text == before[r.doc_id].text
        changed += r.text != before[r.doc_id].text
    assert changed

    pieces = through("packing", masked).collect()
    test_packing.check(pieces, {r.doc_id: r.text for r in masked.collect()})


def test_extra_columns_come_through(spark, tmp_path):
    """Columns named like those that operators make are neither read nor replaced."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    names = ("score", "rejected", "__row", "__fp", "lang_pred", "extra_0", "root")
    docs = docs.withColumns({n: F.concat(F.lit(f"{n} "), "doc_id") for n in names})
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.dtypes == docs.dtypes
        rows = out.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns[:2] == ["doc_id", "start"] and rows.count() > 100

import re

import pytest

from tunefeed.llm.queries import op3_secret_scan
from tunefeed.llm.secret_scan import candidates, labelled_findings, scan, train_forest, features


@pytest.fixture(scope="module")
def model(spark):
    return train_forest(labelled_findings(spark))


def brute(text):
    """Place by place: an assigned value, else a run."""
    text, out, at = text or "", [], 0
    name = re.compile(r"""(token|secret|passw|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential)[\w-]{0,16}["'`]?\s{0,3}[=:]\s{0,3}["'`]?\Z""", re.I | re.A)
    while at < len(text):
        value = re.compile(r"""[^\s"'`]{8,}""", re.A).match(text, at)
        run = re.compile(r"[A-Za-z0-9+/_=-]{16,}").match(text, at)
        if value and name.search(text[max(at - 60, 0) : at]):
            found = value
        elif run and not re.match(r"[A-Za-z0-9+/_=-]", text[at - 1 : at]):
            found = run
        else:
            at += 1
            continue
        out.append((found.group(), text[: found.start()], text[found.end() :]))
        at = found.end()
    return out


def test_candidates_equal_a_plain_search(spark):
    texts = {1: None, 2: "", 3: "x" * 16, 4: "a" * 15, 5: "é" + "b1" * 9 + "é " + "/+_=-" * 4 + "\n" + "c" * 20, 6: "Z" * 20_000 + " " + "q" * 17, 7: 'password = "hunter2-Pass" PWD: Xk9$vT2!qLp8@mZ4wR, token=short secret:\n  "spaced out"', 8: "api-key_of_mine`:`a.b.c.d.é;x` author = somebody auth : ....,,,,;;;; x: " + "y" * 16 + "$z"}
    df = spark.createDataFrame([(k, v, None, "s") for k, v in texts.items()] + [(None, "k" * 16, "p", "s")], "doc_id long, text string, source string, secret string")
    got = {}
    for r in candidates(df).orderBy("key", "nth").collect():
        got.setdefault(r.key, []).append(r)
    assert set(got) == {3, 5, 6, 7, 8, None}
    assert [r.secret for r in got[7]] == ["hunter2-Pass", "Xk9$vT2!qLp8@mZ4wR,"]
    for key, rows in got.items():
        want = brute(texts.get(key, "k" * 16))
        assert [r.nth for r in rows] == list(range(1, len(want) + 1))
        for r, (secret, before, after) in zip(rows, want, strict=True):
            assert r.secret == secret and before.endswith(r.before) and after.startswith(r.after)
    assert candidates(df.limit(0)).collect() == []


def test_forest_on_findings_it_has_not_seen(spark, model):
    rows = model.transform(features(labelled_findings(spark, seed=99))).selectExpr("avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS right").first()
    assert rows.right > 0.97


def test_judgements(spark, model):
    texts = [
        (1, 'the token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" with'),
        (2, 'DIE!! TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!! ER'),
        (3, "thatthedthernesserationing and einverlichkeitenschaft"),
        (4, "see commit 186661156f3f9905942d70850a01cbf23a203f82 for it"),
        (5, "the 4047549990366437 and +1234567890123456"),
        (6, 'api_key: "your_api_key_goes_here"'),
        (8, 'password = "hunter2-Pass!" and'),
        (9, "DB_PASSWORD: Xk9$vT2!qLp8@mZ4wR"),
        (10, "auth_token = os.environ[TOKEN_NAME]"),
        (11, "the password: something else, and the secret: thereafter"),
        (7, "aws_secret_access_key = wJalrXUtnFEMIK7MDENGbPxRfiCYzEXAMPLe9Key0 done"),
    ]
    df = spark.createDataFrame([(*t, "src1") for t in texts + texts[:1]], "doc_id long, text string, source string")
    got = [r.doc_id for r in scan(df, model).collect()]
    assert sorted(got) == [1, 1, 2, 7, 8, 9]
    assert scan(df.limit(0), model).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()
    planted = {(r.doc_id, m.group(1)) for r in docs for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', r.text or "")}
    rows = op3_secret_scan(spark, "/root/testdata/sf0.1").collect()
    import hashlib

    found = {(r.doc_id, r.secret_sha256) for r in rows}
    want = {(d, hashlib.sha256(s.encode()).hexdigest()) for d, s in planted}
    assert len(want & found) >= 0.99 * len(want) and len(found - want) <= 0.02 * len(want)

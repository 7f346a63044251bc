import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tunefeed.llm.license_notices import NOTICES, Notice, Scanner, _scan, find_notices, notice_summary, seeds

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normal(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [(m.group(), m.start(), m.end()) for m in WORD.finditer(lower)]


def distances(notice, text):
    """Edit distance of the notice to each prefix of the text."""
    row = list(range(len(notice) + 1))
    out = [row[-1]]
    for c in text:
        new = [row[0] + 1]
        for j, p in enumerate(notice):
            new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (p != c)))
        row = new
        out.append(row[-1])
    return out


def brute(notice, joined):
    """Least edits of a place that begins at each word, and the ends that have them."""
    out = {}
    for at in range(len(joined)):
        if at and joined[at - 1] != " ":
            continue
        piece = joined[at : at + len(notice.text) + notice.edits]
        near = distances(notice.text, piece)
        ends = {n: e for n, e in enumerate(near) if n and (at + n == len(joined) or joined[at + n] == " ")}
        allowed = {n: e for n, e in ends.items() if e <= notice.edits and not set(notice.whole) - set(piece[:n].split(" "))}
        if allowed:
            least = min(allowed.values())
            out[at] = (least, {at + n for n, e in allowed.items() if e == least})
    return out


def damaged(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        i, kind = rng.randrange(len(text)), rng.randrange(3)
        if kind == 0:
            text[i] = rng.choice("aelst ")
        elif kind == 1:
            text.insert(i, rng.choice("aelst "))
        elif len(text) > 1:
            del text[i]
    return "".join(text)


@pytest.mark.parametrize("seed", range(6))
def test_no_place_is_missed(seed):
    rng = random.Random(seed)
    scanner = Scanner(NOTICES)
    filler = "the of a license general public software free permission mit apache any is with bsd version".split()
    words = []
    for _ in range(60):
        notice = rng.choice(NOTICES)
        words += rng.choices(filler, k=rng.randrange(4))
        words += damaged(rng, notice.text, rng.randrange(notice.edits + 3)).split()
    joined = " ".join(words)
    for i, notice in enumerate(NOTICES):
        begins = {int(a) for a in range(len(joined)) if a == 0 or joined[a - 1] == " "}
        want = brute(notice, joined)
        hits = set()
        for last, (size, where) in scanner.seeds.iter(joined):
            for own, offset in where:
                if own == i:
                    near = last + 1 - size - offset
                    hits |= {a for a in begins if abs(a - near) <= notice.edits}
        # Every place begins where a seed says (pigeonhole), ...
        assert set(want) <= hits
        # ... the library finds the least edits of each, ...
        got = {a: (e, b) for e, a, b in scanner._verified(joined, i, hits)}
        if not notice.whole:
            assert set(got) == set(want)
        for at, (edits, end) in got.items():
            assert at in want and want[at][0] == edits and end in want[at][1]
        # ... and of overlapping ones the better is kept; each place overlaps one that is.
        kept = [(e, a, b) for a, b, own, e in scanner.places(joined) if own == i]
        assert {a for a, (e, _) in got.items() if e == 0} <= {a for _, a, _ in kept}
        for at, (edits, end) in got.items():
            assert any(a < end and at < b and (e, a) <= (edits, at) for e, a, b in kept)
        fuzzy = sorted((a, b) for e, a, b in kept if e)
        assert all(x[1] <= y[0] for x, y in zip(fuzzy, fuzzy[1:]))


def test_seeds_cover_the_notice():
    for notice in NOTICES:
        cut = seeds(notice)
        assert len(cut) == notice.edits + 1 and "".join(p for _, p in cut) == notice.text
        assert all(notice.text[a:].startswith(p) and p for a, p in cut)
    with pytest.raises(ValueError):
        Scanner((Notice("x", "mit", 3),))


def test_spans_are_code_points_of_the_text():
    text = "éé\x00 /* The MIT\n * Licence, 日本 GNU GENERAL--public\tlicens */"
    n, found = _scan(Scanner(NOTICES), pa.array([None, text, "", "mit", "license"]))
    assert n.tolist() == [0, len(normal(text)), 0, 1, 1]  # words of two texts are never joined
    assert [len(f) for f in found] == [0, 2, 0, 0, 0]
    assert [(f["label"], f["edits"], text[f["begin"] : f["end"]]) for f in found[1]] == [
        ("mit", 1, "MIT\n * Licence"),
        ("gpl", 1, "GENERAL--public\tlicens"),
    ]
    assert [(f["word"], f["n_words"]) for f in found[1]] == [(2, 2), (6, 3)]


def base_of(text):
    words = [w for w, _, _ in normal(text)]
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        own = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    at = [i for i, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), min(at, default=None), max(at, default=None), labels


LONG = "word " * 30_000 + "MIT License " * 3_000 + "the Apache Licence"
TEXTS = [
    None, "", " \n", "MIT License", "mit-license/MIT_License", "summit license", "it license", "mitlicense", LONG, LONG,
    "GNU General Public License", "the GNU Lesser General Public License v3", "apache license mit license apache license",
    "Permission is hereby granted, free of charge, to any\n# person obtaining a copy", "permission is granted free of charge to any person",
    "Redistribution and use in source & binary forms, with or without modifications", "mit é license", "lice nse", "mit license\x00",
]


def test_table(spark):
    rows = [(i, t, "x", 7) for i, t in enumerate(TEXTS)] + [(None, "mit license", "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, findings string, n_words int")
    got = {r.doc_id: r for r in notice_summary(find_notices(df)).collect()}
    assert len(got) == len(rows)
    for i, text, _, _ in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(text)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert (r.score == 1) == (r.n_base > 0) if r.labels == r.base_labels else 0 < r.score <= 1
    labels = [got[i].labels for i in range(len(TEXTS))]
    assert labels[5:8] == ["", "", ""] and labels[11] == "gpl,lgpl" and labels[13] == "mit" and labels[15] == "bsd"
    assert labels[14] == "" and labels[16] == "" and labels[8] == labels[9] == "apache,mit"
    assert find_notices(df.limit(0)).collect() == []
    own = find_notices(df, (Notice("own", "obtaining a copy", 1),)).filter("size(findings) > 0").collect()
    assert [r.doc_id for r in own] == [13]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: base_of(r.text) for r in docs.collect()}
    got = {r.doc_id: tuple(r)[1:6] for r in notice_summary(find_notices(docs)).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 0

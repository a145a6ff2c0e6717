import random
import re

import duckdb
import pytest

from rankloom.llm import licences, plans

from .helpers import documents, odd_rows


def brute_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def wordings(parts):
    """All lists of words that a template without regions accepts; a region gives None for each of its words."""
    if not parts:
        return [[]]
    head, rest = parts[0], wordings(parts[1:])
    if isinstance(head, licences.Optional):
        some = [[], *(w for c in head.choices for w in wordings(c))]
    elif isinstance(head, licences.Region):
        some = [[None] * k for k in range(head.low, head.high + 1)]
    else:
        some = [[head.decode()]]
    return [a + b for a in some for b in rest]


def brute_matches(words, template):
    """All (first, last) that any wording fits, cut to the earliest and longest ones."""
    fits = {}
    for wording in wordings(licences.parse(template)):
        for i in range(len(words) - len(wording) + 1):
            if all(w is None or w == words[i + k] for k, w in enumerate(wording)):
                fits[i] = max(fits.get(i, -1), i + len(wording) - 1)
    out, last = [], -1
    for start, end in sorted(fits.items()):
        if start > last:
            out.append((start, end))
            last = end
    return out


TEMPLATES = {
    "a": "x y [z] x",
    "b": "<1-2> y x",
    "c": "x [y|z [y]] <0-3> z",
    "d": "y <2-2> [x] y",
}


def test_automaton_against_all_wordings():
    draw = random.Random(5)
    machine = licences.Automaton.of(TEMPLATES)
    for _ in range(400):
        words = draw.choices("xyzw", k=draw.randint(0, 14))
        got = machine.run([w.encode() for w in words])
        want = [(n, a, b) for n, t in TEMPLATES.items() for a, b in brute_matches(words, t)]
        assert got == sorted(want), words


@pytest.mark.parametrize("wrong", ["", "[a]", "<0-2>", "a ]", "[a", "a | b", "a <3-2>", "a > b"])
def test_wrong_templates(wrong):
    with pytest.raises(ValueError):
        licences.Automaton.of({"t": wrong})


MIT = licences.TEMPLATES["mit-text"][1].replace("[", "").replace("]", "").capitalize()
TEXTS = [
    "Released under the MIT License.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.",
    "licensed under the apache license version 3",
    "Copyright (c) A. Author\n\n" + MIT + " and more",
    "Copyright (c) A. Author\n\n" + MIT.replace("merge", "merges"),
    "mit license mit license apache-license general public\tlicense",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "SPDX-License-Identifier: Apache-2.0",
    "MİT License ünder the MIT\u0085license",
    "no licence here",
]
LABELS = ["mit", "gpl", "apache,cc", "apache", "mit", "", "apache,gpl,mit", "gpl", "spdx", "", ""]


def digest(spark, rows, monkeypatch):
    monkeypatch.setattr(plans, "table", lambda *_: documents(spark, rows))
    return plans.licence_scan(spark, "").collect()


def test_texts(spark, monkeypatch):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + odd_rows()
    out = digest(spark, rows, monkeypatch)
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert [by_id[i]["labels"] for i in range(len(TEXTS))] == LABELS
    for i, text, _ in rows:
        if i is None:
            continue
        words, r = brute_words(text), by_id[i]
        places = [
            (k, label) for p, label in licences.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()
        ]
        starts = [k for k, _ in places]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert 0 <= r["score"] < 1 and (r["score"] > 0) == bool(r["labels"])
    assert by_id[4]["score"] > 0.98 > by_id[0]["score"]
    assert digest(spark, [], monkeypatch) == []


def test_spans_and_long_texts(spark):
    long = "word " * 300_000 + "Released under the MIT License. " + "word " * 300_000
    found = licences.scan(documents(spark, [(1, long, "en"), (2, TEXTS[2], "en")])).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert [(m["template"], m["first"], m["last"]) for m in by_id[1]["matches"]] == [("mit-notice", 300_000, 300_004)]
    assert [(m["template"], m["first"], m["last"]) for m in by_id[2]["matches"]] == [("apache-notice", 7, 14), ("cc-notice", 0, 6)]


def test_sql_is_the_same(spark, monkeypatch, tmp_path):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [r for r in odd_rows() if r[1] != "\x00"]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    theirs = duck.execute(licences.scan_sql())
    names = [c[0] for c in theirs.description]
    ours = digest(spark, rows, monkeypatch)
    assert sorted((tuple(r[c] for c in names) for r in ours), key=str) == sorted(theirs.fetchall(), key=str)

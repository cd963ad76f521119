import re
import time

from tests.llm.fixtures import documents
from tidewell.llm import license_scan
from tidewell.llm.license_rules import rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    """Base columns, and kept detections as (first word, word after the last, label)."""
    w = tokens(text)
    places, labels = [], set()
    for phrase, label in license_scan.BASE:
        p = phrase.split()
        found = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    t = " " + "".join(x + " " for x in w)
    spans = []
    for order, (label, keyword, priority, pattern) in enumerate(rules()):
        if f" {keyword}" in t and keyword.split()[0] in w:
            spans += [(m.start(), m.end(), priority, order, label) for m in re.finditer(f"(?<= )(?:{pattern})(?= )", t)]
    beats = lambda e, d: (e[2], e[1] - e[0], -e[3]) > (d[2], d[1] - d[0], -d[3]) and e[0] <= d[0] and e[1] >= d[1]
    kept = [d for d in spans if not any(beats(e, d) for e in spans)]
    own = sorted((t[: a].count(" ") - 1, t[:b].count(" "), label) for a, b, _, _, label in kept)
    every = labels | {d[4] for d in kept if d[2] > 10}
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(every)), own


CASES = [
    "Released under the MIT License. Under the MIT license!",
    "Licensed under the Apache License, Version 2.0. And CC BY-NC CC BY-NC 4.0, cc by nc",
    "This work is licensed under the GNU General Public License, version 3.\nGNU Lesser General Public License v2.1 or GPL",
    "BSD-3-Clause and the Apache License; public domain dedication; Creative Commons Attribution-NonCommercial-ShareAlike 4.0 License",
    "All rights reserved. Copyright (c) 2019. SPDX-License-Identifier: MIT",
    "mit under the mit licenses underthe mit license",
    "GPL3 LGPLv2 AGPL3.0 mplv2 MPL-2.0, licence ouverte; BSD Zero Clause License, gnu gplv3 only, \u212acc by nc",
    "the Mozilla Public License 2.0 " * 60 + "x " * 30000,
]


def test_against_brute_force(spark):
    df, rows = documents(spark, extra=[(700 + i, t) for i, t in enumerate(CASES)])
    got = license_scan.scan(df).collect()
    want = sorted((str(d), *brute(t)[:6]) for d, t in rows)
    assert sorted(map(str, want)) == sorted(str((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)) for r in got)
    by = dict(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id >= 700:
            assert sorted((d["first"], d["last"], d["label"]) for d in r.detections) == brute(by[r.doc_id])[6]
        assert 0 <= r.score <= 1
    assert {r.labels for r in got if r.doc_id == 702} == {"gpl-3,lgpl-2.1"}


def test_rules_are_sound(spark):
    assert len(rules()) > 200
    for _, keyword, priority, pattern in rules():
        assert 0 < priority <= 100 and keyword == keyword.strip().lower()
        re.compile(pattern)
    plan = license_scan.scan(documents(spark)[0])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert license_scan.scan(documents(spark)[0].limit(0)).count() == 0


def test_every_pattern_implies_its_keyword():
    """The prefilter loses nothing: the shortest readings of each pattern hold the keyword, its first word whole."""
    for label, keyword, _, pattern in rules():
        assert "|" not in re.sub(r"\(\?:[^()]*\)", "", re.sub(r"\(\?:[^()]*\)\??", "", pattern)), pattern  # no alternatives outside groups
        least = pattern
        while "(?:" in least:
            least = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)(\??)", lambda m: "" if m[2] else m[1], least)
        least = re.sub(r"\\?.\?", lambda m: "", least)
        assert f" {keyword}" in f" {least} ", (label, keyword, least)


def test_many_spans(spark):
    text = "mit license " * 3000
    got = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(got.detections) == 5999 and got.n_words == 6000


def test_time_grows_with_the_text(spark):
    """Twice as many detections in twice the text take no more than two and a half times as long."""

    def seconds(n):
        df = spark.createDataFrame([(1, "released under the mit license and gpl v3 or later. " * n)], "doc_id long, text string")
        times = []
        for _ in range(2):
            began = time.perf_counter()
            assert len(license_scan.scan(df).first().detections) >= 2 * n
            times.append(time.perf_counter() - began)
        return min(times)

    seconds(10)
    start, two, four = seconds(1), seconds(2000), seconds(4000)
    assert four - start < 2.5 * max(two - start, 1.0)

import os
import re

import pytest

from tidewell.llm import url_rules

URLS = [None, "", "no scheme", "http://a.COM", "http://a.com/", "http://example.com/en/x?y=/en/", "https://www.example.com/en/1", "https://x.www.example.com/en/1", "http://notexample.com/en/", "http://b.net/es/1#t", "http://b.net/fr", "http://b.net/fr/", "http://c.org?x=1", "http://c.org#/en/", "ftp://U:p@H.org:80/es/Ä?b", "x://http://y.com/", "http://d.org/es/9", "http://e.org/en/9", "http://é.net/es/"]


def brute(url):
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else None


def pages(spark, extra=()):
    urls = URLS + [f"http://s{i % 7}.net/{'es' if i % 2 else 'de'}/{i}" for i in range(200)] + list(extra)
    return spark.createDataFrame([(i, u, None, "z") for i, u in enumerate(urls)] + [(3, URLS[3], None, "z"), (None, None, None, None)], "page_id long, url string, html string, rule string"), urls


def test_rules_and_mined_verdicts(spark):
    df, urls = pages(spark)
    got = url_rules.judge(df).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        host, path, rule, verdict = brute(urls[r.page_id] if r.page_id is not None else None)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    by = {urls[r.page_id]: r.verdict for r in got if r.page_id is not None}
    assert by["http://d.org/es/9"] == "block" and by["http://c.org?x=1"] == "allow" and by[None] == "allow"


def test_nothing_to_mine(spark):
    df, _ = pages(spark)
    assert url_rules.judge(df.limit(0)).count() == 0
    none = url_rules.judge(df.where("url is null or url like '%org%'"))
    assert {r.verdict for r in none.collect()} == {"allow"}
    assert "Python" not in url_rules.judge(df)._jdf.queryExecution().toString()


def test_no_rule_is_crowded_out(spark):
    many = [f"m{i}" for i in range(13)]  # 1092 sure combinations of up to four tokens
    five = list("abcde")
    rows = [(many, True)] * 10 + [(["odd"], i > 0) for i in range(10)] + [(five, True)] * 10 + [([x for x in five if x != y], False) for y in five for _ in range(10)]
    rules = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, blocked boolean")).collect()
    kept = url_rules.shortest([(list(r.a), r.c) for r in rules])
    assert sorted(kept) == sorted([([m], 1.0) for m in many] + [(["odd"], 0.9), (five, 1.0)])


@pytest.mark.parametrize("literal", [1000, 0])
def test_all_rules_decide(spark, monkeypatch, literal):
    monkeypatch.setattr(url_rules, "LITERAL", literal)
    names = "&".join(f"m{i}=1" for i in range(10))
    extra = [f"http://x.net/es/?{names}"] * 300 + [f"http://y.net/fr/odd/{i}" for i in range(9)] * 5 + ["http://y.com/odd/1/2"] * 5 + ["http://z.org/odd/1/2"] * 2
    df, urls = pages(spark, extra)
    got = url_rules.judge(df)
    odd = [r for r in got.collect() if r.page_id is not None and urls[r.page_id] == extra[-1]]
    assert len(odd) == 2 and all(r.verdict == "block" and r.confidence == pytest.approx(45 / 52) for r in odd)
    assert got.count() == len(urls) + 2 and "Python" not in got._jdf.queryExecution().toString()


def test_a_host_that_can_only_be_blocked_is_no_rule(spark):
    """Of a net host the stated rules label blocked pages only; its other pages are no evidence for a block."""
    rows = [(i, f"http://s{i % 7}.net/{('es', 'de', 'it')[i % 3]}/{i}") for i in range(300)] + [(400 + i, f"http://t.com/de/{i}") for i in range(50)]
    got = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert {r.verdict for r in got if r.rule is None} == {"allow"}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables are not here")
def test_held_out_verdicts(spark):
    got = url_rules.held_out(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"))
    assert got["precision"] > 0.9 and got["precision"] > got["base"]
    assert got["unlabelled"] < 0.2

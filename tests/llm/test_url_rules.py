"""URL verdicts against a plain reading of the rules, and mined rules on a clear case."""

import re

from deskpulse.llm import url_rules
from deskpulse.llm.queries import op9_url_filters


def plain(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, verdict)
        for verdict, h, p in url_rules.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_query_on_whole_table(spark, sf_dir):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = op9_url_filters(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = plain(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("allow" if r["confidence"] is None else "block"))


URLS = [
    None, "", "no scheme/es/", "http://", "http://NET/es/x", "http://example.com/en/", "https://www.example.com/en/a?b#c",
    "https://x.www.Example.COM/en/", "ftp://a.net/fr/?q", "http://anet/es/", "http://com", "http://com/", "x://y://z.net/es/",
    "http://a.net?x=/es/", "http://a.com#/en/", "http://ÉXAMPLE.com/en/", "http://e.com/" + "long/" * 20_000, "http://a\nb.net/es/\n",
]


def test_edges_and_repeats(spark):
    rows = [(i, u, "old") for i, u in enumerate(URLS)] + [(None, "http://a.net/es/", "old"), (3, "http://", "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    nothing = spark.createDataFrame([], "url string, bad boolean")
    got = url_rules.judge(pages, nothing).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain(url)
        r = by_id[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), url
    assert url_rules.judge(pages.where("false"), nothing).collect() == []


def test_mined_rules_block_token_combinations(spark):
    good = [f"http://site{i % 7}.org/en/{i}" for i in range(400)] + [f"http://ads.org/en/{i}" for i in range(100)]
    good += [f"http://site{i % 7}.org/win/{i}" for i in range(100)]
    bad = [f"http://ads.org/win/{i}?clickid=1" for i in range(100)]
    labelled = spark.createDataFrame([(u, False) for u in good] + [(u, True) for u in bad] + [(None, True), (good[0], None)], "url string, bad boolean")
    mined = url_rules.mine_rules(labelled).collect()
    assert mined
    for r in mined:
        tokens = set(r["antecedent"])
        hits = [u for u in good + bad if tokens <= set(plain_tokens(u))]
        assert r["confidence"] == len([u for u in hits if u in bad]) / len(hits) >= url_rules.MIN_CONFIDENCE
        assert r["key"] in tokens
    assert ["host=ads.org", "path=win"] in [sorted(r["antecedent"]) for r in mined]
    pages = spark.createDataFrame([(1, "http://ads.org/win/7"), (2, "http://ads.org/en/7"), (3, "http://site1.org/win/7"), (4, "http://new.org/x?clickid=4")], "page_id long, url string")
    verdicts = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, labelled).collect()}
    assert verdicts == {1: "block", 2: "allow", 3: "allow", 4: "block"}


def plain_tokens(url):
    host, path, _, _ = plain(url)
    labels = host.split(".")
    tokens = ["scheme=" + url.split("://")[0]] + ["host=" + ".".join(labels[i:]) for i in range(len(labels))]
    tokens += ["path=" + w for w in re.split(r"[/\d]+", path) if w]
    query = url.split("?")[1].split("#")[0] if "?" in url else ""
    tokens += ["query=" + q.split("=")[0] for q in query.split("&") if q]
    return tokens + (["fragment"] if "#" in url else [])

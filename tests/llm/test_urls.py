"""Rules and propagation against plain Python."""

import re

import numpy as np
import pytest

from tests.conftest import SF
from tidemark.llm import urls
from tidemark.llm.queries import op4_url_filters


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path, rules=urls.RULES):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return (best.text, best.verdict) if best else (None, None)


URLS = [None, "", "no scheme", "http://A.Example.ORG/es/1", "http://example.org/en/12?x#y", "http://x.example.org/en/2", "ftp://com/de/",
        "http://com", "http://notcom/de/", "http://a.com/fr/?q=://b", "http://a.com/it/", "://only.net/p", "http://É.com/de/x#z", "http://org?x=/",
        "http://h.org/", "http:///nohost", "mailto:x", "http://a.com/de"]


def test_rules(spark):
    df = spark.createDataFrame([(i, u, None, "k") for i, u in enumerate(URLS)], "page_id long, url string, html string, HOST string")
    rows = {r.page_id: r for r in urls.judge(df).collect()}
    for i, u in enumerate(URLS):
        host, path = split(u)
        assert (rows[i].host, rows[i].path) == (host, path)
        text, verdict = rule(host, path)
        assert rows[i].rule == text
        assert rows[i].verdict in ("allow", "block") and (verdict is None or rows[i].verdict == verdict)


def rank(edges, seeds, steps=200):
    hosts = sorted({h for e in edges for h in e[:2]} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    move = np.zeros((len(hosts), len(hosts)))
    for a, b, n in edges:
        move[at[b], at[a]] += n / sum(e[2] for e in edges if e[0] == a)
    seed = np.array([seeds.get(h, 0.0) for h in hosts])
    score = seed.copy()
    for _ in range(steps):
        score = seed + urls.DAMPING * move @ score
    return dict(zip(hosts, score, strict=True))


def test_propagation_equals_the_linear_system(spark):
    edges = [("a", "b", 3), ("a", "c", 1), ("b", "c", 2), ("c", "a", 1), ("d", "c", 5), ("e", "e2", 1)]
    seeds = {"a": 1.0, "d": 0.5}
    got = urls.propagate(spark.createDataFrame(edges, "src string, dst string, n long"),
                         spark.createDataFrame(list(seeds.items()), "host string, weight double"), steps=60)
    expected = rank(edges, seeds)
    for r in got.collect():
        assert r.score == pytest.approx(expected[r.host], rel=1e-2)
    assert {r.host for r in got.collect()} == {h for h, s in expected.items() if s > 0}


def test_propagation_goes_on_until_the_tolerance(spark):
    edges = [("a", "b", 1), ("b", "a", 1), *((f"c{i}", f"c{i + 1}", 1) for i in range(40))]
    seeds = {"a": 1.0, "c0": 1.0}
    frames = (spark.createDataFrame(edges, "src string, dst string, n long"),
              spark.createDataFrame(list(seeds.items()), "host string, weight double"))
    got = {r.host: r.score for r in urls.propagate(*frames).collect()}
    assert got == pytest.approx(rank(edges, seeds), rel=1e-3)
    with pytest.raises(RuntimeError):
        urls.propagate(*frames, steps=2)


def test_distrust_reaches_the_linking_host_and_trust_the_linked(spark):
    link = '<a class=x href="{}">t</a> <A HREF=\'//{}/p\'>u</A> <a href="/local">v</a>'
    rows = [(1, "http://spam.com/de/1", ""), (2, "http://farm.net/1", link.format("http://spam.com/de/9", "SPAM.com")), (3, "http://farm.net/2", None),
            (4, "http://good.org/1", link.format("https://friend.net/x?y", "friend.net")), (5, "http://friend.net/1", ""), (6, "http://lone.net/", "")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i].verdict for i in range(1, 7)] == ["block", "block", "block", "allow", "allow", "allow"]
    assert got[2].distrust > 0 and got[2].trust == 0 and got[5].trust > 0 and got[6].trust == got[6].distrust == 0


def test_nulls_repeats_empty(spark):
    df = spark.createDataFrame([(None, None, None), (1, "http://x.com/de/", None), (1, "http://x.com/de/", None)], "page_id long, url string, html string")
    assert sorted(r.verdict for r in urls.judge(df).collect()) == ["allow", "block", "block"]
    assert urls.judge(df.limit(0)).collect() == []


def test_query(spark):
    rows = {r.page_id: r for r in op4_url_filters(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        host, path = split(p.url)
        text, verdict = rule(host, path)
        r = rows[p.page_id]
        assert (r.host, r.path, r.rule) == (host, path, text) and (verdict is None or verdict == r.verdict)

"""URL rules and host reputation against plain versions."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from runway.llm import urls

PAGES = "page_id long, url string"
LABELLED = "url string, bad boolean"


def beta_tail(a, b, limit, n=2_000_000):
    t = (np.arange(n) + 0.5) / n * math.pi / 2
    w = (2 * a - 1) * np.log(np.sin(t)) + (2 * b - 1) * np.log(np.cos(t))
    w = np.exp(w - w.max())
    return w[np.sin(t) ** 2 > limit].sum() / w.sum()


def plain(sites, limit):
    """Posterior bounds of {site: (domain, suffix, n, k)} by loops."""
    def strength(children):  # {parent: [(n, k)]}
        of = {p: [x for x in c if x[0]] for p, c in children.items()}
        of = {p: c for p, c in of.items() if c}
        g, p, n = sum(map(len, of.values())), len(of), sum(x[0] for c in of.values() for x in c)
        if g <= p or n <= g:
            return 10.0
        b = w = n2 = 0.0
        for c in of.values():
            m, mean = sum(x[0] for x in c), sum(x[1] for x in c) / sum(x[0] for x in c)
            b += sum(x * (y / x - mean) ** 2 for x, y in c)
            w += sum(x * (y / x) * (1 - y / x) for x, y in c)
            n2 += sum(x * x for x, _ in c) / m
        b, w, n0 = b / (g - p), w / (n - g), (n - n2) / (g - p)
        if b + (n0 - 1) * w <= 0:
            return 10.0
        return 1 / min(max((b - w) / (b + (n0 - 1) * w), 1e-4), 0.9) - 1

    domains, ends = {}, {}
    for d, s, n, k in sites.values():
        x = domains.setdefault((d, s), [0, 0])
        x[0], x[1] = x[0] + n, x[1] + k
    for (d, s), (n, k) in domains.items():
        x = ends.setdefault(s, [0, 0])
        x[0], x[1] = x[0] + n, x[1] + k
    ms = strength({d: [(n, k) for e, _, n, k in sites.values() if e == d] for d, *_ in sites.values()})
    md = strength({s: [x for (_, t), x in domains.items() if t == s] for s in ends})
    me = strength({0: list(ends.values())})
    base = (sum(k for _, k in ends.values()) + limit / 2) / (sum(n for n, _ in ends.values()) + 1)
    out = {}
    for site, (d, s, n, k) in sites.items():
        es = (me * base + ends[s][1]) / (me + ends[s][0])
        dm = (md * es + domains[d, s][1]) / (md + domains[d, s][0])
        a, b = ms * dm + k, ms * (1 - dm) + n - k
        out[site] = (a / (a + b), beta_tail(a, b, limit, 200_000))
    return out


@pytest.mark.parametrize("a,b,limit", [(0.4, 1.6, 0.25), (2, 5, 0.25), (30, 70, 0.3), (5000, 15000, 0.25), (3e7, 7e7, 0.3), (0.02, 5, 0.5), (9, 0.3, 0.9)])
def test_tail(spark, a, b, limit):
    got = spark.range(1).select(urls.tail(F.lit(float(a)), F.lit(float(b)), limit)).first()[0]
    assert got == pytest.approx(beta_tail(a, b, limit), abs=2e-3)


def test_reputation_equals_plain_version(spark):
    r = np.random.default_rng(3)
    truth = {f"h{i}.d{i % 4}.{'com' if i % 2 else 'co.uk'}": (f"d{i % 4}.{'com' if i % 2 else 'co.uk'}", "com" if i % 2 else "co.uk", i % 4) for i in range(24)}
    pages, labelled, sites = [], [], {}
    for site, (d, s, kind) in truth.items():
        n = int(r.integers(0, 40))
        bad = r.random(n) < (0.1, 0.2, 0.5, 0.8)[kind]
        sites[site] = (d, s, n, int(bad.sum()))
        pages += [(len(pages), f"http://user@{site.upper()}:80/x")]
        labelled += [(f"https://{site}/p{j}?q", bool(x)) for j, x in enumerate(bad)]
    labelled.append(("http://other.org/", None))
    got = {x["site"]: x for x in urls.reputation(spark.createDataFrame(pages, PAGES), spark.createDataFrame(labelled, LABELLED).where("bad IS NOT NULL")).collect()}
    want = plain(sites, urls.LIMIT)
    assert set(got) == set(want)
    for site, (rate, bound) in want.items():
        assert got[site]["n"] == sites[site][2] and got[site]["k"] == sites[site][3]
        assert got[site]["rate"] == pytest.approx(rate, abs=1e-9) and got[site]["bound"] == pytest.approx(bound, abs=2e-3)


def test_hosts_paths_rules_and_verdicts(spark):
    cases = {
        None: ("", "", None), "": ("", "", None), "no scheme/en/": ("", "", None), "x://": ("", "", None),
        "HTTP://A.Com/En/Ü?x#y": ("a.com", "/En/Ü", "com/"), "http://com/": ("com", "/", "com/"), "http://a.com": ("a.com", "", None),
        "http://xcom/": ("xcom", "/", None), "http://m.example.com/en/1": ("m.example.com", "/en/1", "example.com/en/"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/"),
        "http://a.www.example.com/en/#t": ("a.www.example.com", "/en/", "www.example.com/en/"),
        "http://badexample.com/en/": ("badexample.com", "/en/", "com/"), "http://x.net/es/1?u=://b.com/": ("x.net", "/es/1", "net/es/"),
        "http://x.net/fr": ("x.net", "/fr", None), "http://ÄB.net#/fr/": ("Äb.net", "", None), "a://b://c.net/fr/": ("b:", "//c.net/fr/", None),
        "http://h.org?a/b": ("h.org", "", None), "http://evil.biz/" + "z" * 20000: ("evil.biz", "/" + "z" * 20000, None)}
    pages = spark.createDataFrame([*enumerate(cases), (None, "http://evil.biz/a"), (0, "http://evil.biz/a")], PAGES).withColumns(
        {c: F.lit(1) for c in ("site", "n", "k", "rule", "host", "bad", "prior", "html")})
    labelled = spark.createDataFrame([(f"http://evil.biz/{i}", True) for i in range(60)] + [(f"http://x.net/{i}", False) for i in range(600)], LABELLED)
    rows = urls.judge(pages, labelled).collect()
    assert len(rows) == len(cases) + 2
    by = {r["page_id"]: r for r in rows if r["path"] != "/a"}
    for i, (url, (host, path, rule)) in enumerate(cases.items()):
        assert (by[i]["host"], by[i]["path"], by[i]["rule"]) == (host, path, rule), url
        said = {None: None, "com/": "allow", "www.example.com/en/": "allow"}.get(rule, "block")
        assert by[i]["verdict"] == (said or ("block" if host == "evil.biz" else "allow")), url
    assert [r["verdict"] for r in rows if r["path"] == "/a"] == ["block", "block"]
    none = urls.judge(pages.limit(0), labelled)
    assert none.count() == 0
    free = urls.judge(pages, labelled.limit(0), rules=()).collect()
    assert {r["verdict"] for r in free} == {"allow"} and {r["n_labelled"] for r in free} == {0}


def test_levels(spark):
    cases = {"a.b.example.com": ("example.com", "com"), "com": ("com", "com"), "x.y.co.uk": ("y.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"),
             "xco.uk": ("xco.uk", "uk"), "10.0.0.1:8080": ("10.0.0.1", "10.0.0.1"), "u:p@h.org:1": ("h.org", "org"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in cases], "host string")
    _, domain, suffix = urls.levels(F.col("host"))
    got = {r[0]: (r[1], r[2]) for r in df.select("host", domain, suffix).collect()}
    assert {h: g for h, g in got.items() if h != "co.uk"} == {h: c for h, c in cases.items() if h != "co.uk"}
    assert got["co.uk"][0] == "co.uk"


def test_outcomes_of_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.com/en/7?x=9"), (2, "http://a.com/8.html#t"), (3, "http://a.com/9/"), (4, "http://a.com/x7"),
                                   (5, None), (6, "http://a.com/99999999999999999999")], PAGES)
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, None), (8, 1, 0), (9, None, 1), (10, 0, 0), (None, 0, 0), (11, None, None)], "doc_id long, quality int, toxic int")
    assert {(r[0], r[2]) for r in urls.outcomes(pages, labels).collect()} == {(1, False), (2, True), (3, True)}

import math

from newsflow.llm import reputation


def verdicts(spark, urls, **how):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    return {r.page_id: r for r in reputation.judge(pages, **how).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [
        "http://A.Example.ORG/en/12?x#y", "https://example.org/es/1", "http://x.org/z", "http://x.org", "http://notexample.org/es/",
        "ftp://b.COM/fr/", "http://b.com/De/", "http://b.com/de/?q", None, "no scheme", "http://", "://h?p/de/", "http://a.net#/f", "HTTP://É.com/fr/a\nb",
    ]
    got = verdicts(spark, urls)
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(urls))] == [
        ("a.example.org", "/en/12", "example.org/en/1"), ("example.org", "/es/1", "example.org/es/"), ("x.org", "/z", "org/"),
        ("x.org", "", None), ("notexample.org", "/es/", "org/"), ("b.com", "/fr/", "com/fr/"), ("b.com", "/De/", None),
        ("b.com", "/de/", "com/de/"), ("", "", None), ("", "", None), ("", "", None), ("h", "", None), ("a.net", "", None),
        ("É.com", "/fr/a\nb", "com/fr/"),
    ]
    assert [got[i].verdict for i in (0, 1, 2, 5, 7)] == ["block", "block", "allow", "allow", "block"]
    assert verdicts(spark, []) == {}


def test_reputation_follows_outcomes(spark):
    outcomes = [("bad.site.net", 1)] * 60 + [("bad.site.net", 0)] * 2 + [("good.site.net", 0)] * 60 + [("few.other.net", 1)]
    outcomes += [(f"h{i}.worse.net", 1) for i in range(40)] + [("x.net", None)]
    urls = ["http://bad.site.net/", "http://good.site.net/", "http://few.other.net/", "http://new.worse.net/", "http://new.place.info/"]
    labelled = spark.createDataFrame(outcomes, "host string, bad int")
    got = verdicts(spark, urls, outcomes=labelled, rules=())
    assert [got[i].verdict for i in (0, 1, 3, 4)] == ["block", "allow", "block", "allow"]
    # the filter acts on the bound: a long record proves more than the domain of an unseen host, or one bad page
    assert got[0].bound_bad > got[3].bound_bad > got[1].bound_bad
    assert got[2].bound_bad < got[0].bound_bad
    want = hierarchy([h for h in {*(h for h, _ in outcomes), *(got[i].host for i in got)}], outcomes)
    for row in got.values():
        mean, bound = want[row.host]
        assert math.isclose(row.mean_bad, mean) and math.isclose(row.bound_bad, bound)
        assert row.verdict == ("block" if bound > reputation.LIMIT else "allow")


def hierarchy(hosts, outcomes):
    """``{host: (mean, bound)}``, level by level from the overall share down, in plain Python."""
    outcomes = [(h, b) for h, b in outcomes if b is not None]
    prior = {"": ((sum(b for _, b in outcomes) + 1) / (len(outcomes) + 2), len(outcomes) + 2)}
    parent = lambda name: ""
    for labels in (1, 2, None):
        cut = lambda h, k=labels: h if k is None else ".".join(h.split(".")[-k:])
        groups = {cut(h): [b for o, b in outcomes if cut(o) == cut(h)] for h in hosts}
        above = {g: prior[parent(g)] for g in groups}
        full = [(len(v), sum(v), above[g][0]) for g, v in groups.items() if v]
        base = sum(m * (1 - m) for _, _, m in full)
        excess = sum(m * (1 - m) * (n - 1) for n, _, m in full)
        r = (sum(n * (bad / n - m) ** 2 for n, bad, m in full) - base) / excess if excess else 0
        strength = max(1.0, min(1000.0, 1 / r - 1)) if r > 0 else 1000.0
        prior = {}
        for g, v in groups.items():
            k = min(strength, above[g][1])
            prior[g] = (sum(v) + k * above[g][0]) / (len(v) + k), len(v) + k
        parent = (lambda name: name.split(".")[-1]) if labels == 1 else (lambda name: ".".join(name.split(".")[-2:]))
    return {h: (m, m - reputation.Z * math.sqrt(m * (1 - m) / (w + 1))) for h, (m, w) in prior.items()}


def test_null_and_repeated_pages(spark):
    pages = [(None, "http://a.org/es/"), (1, None), (1, None), (1, "http://a.com/de/"), (1, "http://a.com/de/")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, bound_bad string")
    got = sorted((r.page_id or 0, r.host, r.verdict) for r in reputation.judge(df).collect())
    assert got == [(0, "a.org", "allow"), (1, "", "allow"), (1, "", "allow"), (1, "a.com", "block"), (1, "a.com", "block")]


def test_plan_is_native(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = reputation.judge(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

from pyspark.sql import functions as F

from lexiflow.llm import url_reputation as U
from lexiflow.llm.catalog import RULES

URLS = {
    "https://A.Example.ORG/es/1?x": ("a.example.org", "/es/1", "example.org/es/"),
    "http://example.org/en/12#t": ("example.org", "/en/12", "example.org/en/1"),
    "http://example.org/en/2": ("example.org", "/en/2", "org/"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/"),
    "http://b.com/de/": ("b.com", "/de/", "com/de/"), "http://b.com/fr/x": ("b.com", "/fr/x", "com/fr/"),
    "http://b.com/de": ("b.com", "/de", None), "http://x.org": ("x.org", "", None), "http://x.org?a/b": ("x.org", "", None),
    "no scheme": ("", "", None), "a://b://c/d": ("b:", "//c/d", None), "://É.com/fr/": ("É.com", "/fr/", "com/fr/"), None: ("", "", None),
    "http://u\nv.com/p\nq?": ("u\nv.com", "/p\nq", None),
}


def test_host_path_rule(spark, stored):
    df = stored(list(enumerate(URLS)), "page_id long, url string").selectExpr("*", "'h' as host", "1 as mean")
    none = stored([], "page_id long, bad boolean", 1)
    got = {r.page_id: (r.host, r.path, r.rule) for r in U.filter_urls(df, none, RULES).collect()}
    assert got == dict(enumerate(URLS.values()))


def test_domains(spark):
    cfg = U.ReputationConfig()
    for host, domain, suffix in [("a.b.example.com", "example.com", "com"), ("x.y.co.uk", "y.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"),
                                 ("localhost", "localhost", "localhost"), ("a.com:80", "a.com", "com"), ("", "", "")]:
        r = spark.range(1).select(U.registered_domain(F.lit(host), cfg), U.host_suffix(F.lit(host), cfg)).first()
        assert tuple(r) == (domain, suffix)


def pages_of(hosts):
    return [(i, f"http://{h}/p{i}") for i, h in enumerate(hosts)]


def test_shrinkage(spark, stored):
    hosts = ["bad.a.net"] * 60 + ["good.a.net"] * 60 + ["one.b.net"] + ["new.c.net"]
    labels = [(i, i < 60 or i == 120) for i in range(121)] + [(None, True), (3, None), (999, True)]
    df = stored(pages_of(hosts) + [(0, "http://bad.a.net/p0")], "page_id long, url string")
    rep = {r.host: r for r in U.filter_urls(df, stored(labels, "page_id long, bad boolean")).collect()}
    assert rep["bad.a.net"].verdict == "block" and rep["good.a.net"].verdict == "allow"
    # one bad page is too little to block a host, and a host never seen has its parents' rate
    assert rep["one.b.net"].verdict == "allow" and rep["new.c.net"].verdict == "allow"
    assert rep["good.a.net"].bad_rate < rep["new.c.net"].bad_rate < rep["bad.a.net"].bad_rate
    assert all(r.bad_low <= r.bad_rate <= r.bad_high for r in rep.values())


def test_no_labels_and_no_pages(spark, stored):
    df = stored(pages_of(["a.net"]), "page_id long, url string", 1)
    none = stored([], "page_id long, bad boolean", 1)
    r = U.filter_urls(df, none).first()
    assert r.verdict == "allow" and abs(r.bad_rate - 0.5) < 1e-9
    assert U.filter_urls(stored([], "page_id long, url string", 1), none).count() == 0

import random

from pyspark.sql import functions as F

from tallyroute.llm import urlfilter as u
from tallyroute.llm.queries import URL_RULES


def judged(spark, urls, listed=("bad.example.org",), rules=URL_RULES):
    pages = spark.createDataFrame([(i, url, "h", "k") for i, url in enumerate(urls)], "page_id long, url string, host string, key string")
    found = u.judge(pages, rules, u.names(spark, list(listed)))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    return {urls[r.page_id]: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}


def test_rules_and_parts(spark):
    found = judged(
        spark,
        [None, "", "no scheme/x", "http://A.Net/", "http://net", "http://x.example.net/en/1?q#f", "http://xexample.net/en/", "ftp://example.net/EN/",
         "http://W.example.com/de/", "http://example.com/de", "http://b.org/fr/x#y", "http://borg/fr/", "a://b://c/d", "http://BAD.example.org/x", "http://www.bad.example.org?x",
         "http://notbad.example.org/", "http://É.NET/\nx", "://", "http://x.net?/"],
    )
    assert found == {
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "no scheme/x": ("", "", None, "allow"),
        "http://A.Net/": ("a.net", "/", "net/", "block"),
        "http://net": ("net", "", None, "allow"),
        "http://x.example.net/en/1?q#f": ("x.example.net", "/en/1", "example.net/en/", "allow"),
        "http://xexample.net/en/": ("xexample.net", "/en/", "net/", "block"),
        "ftp://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
        "http://W.example.com/de/": ("w.example.com", "/de/", "example.com/de/", "block"),
        "http://example.com/de": ("example.com", "/de", None, "allow"),
        "http://b.org/fr/x#y": ("b.org", "/fr/x", "org/fr/", "allow"),
        "http://borg/fr/": ("borg", "/fr/", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "http://BAD.example.org/x": ("bad.example.org", "/x", None, "block"),
        "http://www.bad.example.org?x": ("www.bad.example.org", "", None, "block"),
        "http://notbad.example.org/": ("notbad.example.org", "/", None, "allow"),
        "http://É.NET/\nx": ("É.net", "/\nx", "net/", "block"),
        "://": ("", "", None, "allow"),
        "http://x.net?/": ("x.net", "", None, "allow"),
    }


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(u, "BITS_PER_KEY", 2)  # poor filters, so that several levels are needed
    keys = spark.range(3_000).select(F.concat(F.lit("h"), "id", F.lit(".example")).alias("key"))
    listed = keys.where("xxhash64(key) % 5 = 0").union(spark.createDataFrame([("elsewhere",), (None,), ("H0.EXAMPLE",)], "key string"))
    levels = u.cascade(keys, listed)
    assert len(levels) > 3
    wanted = {r.key.lower() for r in listed.collect() if r.key}
    for r in keys.select("key", u.is_listed(F.col("key"), levels).alias("in")).collect():
        assert r["in"] == (r.key in wanted)


def test_random_hosts(spark):
    draw = random.Random(2)
    hosts = [".".join(draw.choices(["a", "b", "c", "dd"], k=draw.randint(1, 5))) for _ in range(300)]
    listed = set(draw.sample(hosts, 20))
    found = judged(spark, sorted({f"http://{h}/" for h in hosts}), listed, rules=[])
    for host, _, rule, verdict in found.values():
        parents = {host.split(".", i)[-1] for i in range(host.count(".") + 1)}
        assert rule is None and verdict == ("block" if parents & listed else "allow")


def test_odd_tables(spark):
    assert judged(spark, []) == {}
    assert judged(spark, ["http://a.b/"], listed=[])["http://a.b/"][3] == "allow"
    long = "x." * 200_000 + "bad.example.org"
    assert judged(spark, [f"http://{long}/"])[f"http://{long}/"][3] == "block"
    lone = "y" * 400_000
    assert judged(spark, [f"http://{lone}/", "http://....net/"])[f"http://{lone}/"][3] == "allow"
    pages = spark.createDataFrame([(None, "http://bad.example.org/"), (1, "http://bad.example.org/"), (1, "http://bad.example.org/")], "page_id long, url string")
    assert [r.verdict for r in u.judge(pages, URL_RULES, u.names(spark, ["bad.example.org"])).collect()] == ["block"] * 3


def test_levels_are_bounded_by_the_list(spark):
    """Of many unlisted keys about as many pass the first level as there are listed ones."""
    keys = spark.range(60_000).select(F.concat(F.lit("h"), F.col("id").cast("string")).alias("key"))
    listed = u.names(spark, [f"h{i}" for i in range(0, 60_000, 10_000)])
    levels = u.cascade(keys, listed)
    assert sum(len(level.cells) for level in levels) < 200 and len(levels[1].cells) <= 40
    found = keys.where(u.is_listed(F.col("key"), levels)).collect()
    assert sorted(r.key for r in found) == sorted(r.key for r in listed.collect())

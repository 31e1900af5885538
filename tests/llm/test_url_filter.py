import numpy as np

from tablewright.llm import url_filter

ENTRIES = [
    ("net", "/", "block", True), ("example.net", "/en/", "allow", True), ("example.com", "/de/", "block", True), ("org", "/fr/", "allow", True),
    ("spam.example.com", "", "block", False), ("x.y", "/p", "block", False), ("x.y", "/p", "block", False), (None, "/", "block", False),
    ("dup.z", "", "allow", True), ("dup.z", "", "block", True),
]
URLS = [
    "http://a.net/", "http://a.net", "http://a.net?x", "HTTP://B.Example.NET/en/x", "http://example.net/en", "http://example.com/de/#a",
    "http://notexample.com/de/", "http://org/fr/", "http://a.org/fr/?://b", "http://WWW.spam.example.com/de/1", "http://spam.example.com",
    "http://x.y/p?q", "http://x.y/", "http://a.x.y/pq", "no scheme.net/", "", None, "http://", "://net/", "a://dup.z/x", "http://É.net/ä", "http://a.net//",
]


def brute(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (ruled, len(h + p), len(h), verdict, h + p)
        for h, p, verdict, ruled in ENTRIES
        if h and host and ("." + host).endswith("." + h) and path.startswith(p)
    ]
    best = max(fits, default=(False, 0, 0, "allow", None))
    return host, path, best[4] if best[0] else None, best[3]


def test_judge(spark):
    urls = URLS + URLS[:3]
    pages = spark.createDataFrame([(i, u, "old", 1) for i, u in enumerate(urls)], "page_id long, url string, verdict string, key int")
    entries = spark.createDataFrame(ENTRIES, "host string, path string, verdict string, ruled boolean")
    got = {r.page_id: r for r in url_filter.judge(pages, entries).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == brute(u), u
        assert got[i].url == u and got[i].key == 1


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "SHARD", 7)
    monkeypatch.setattr(url_filter, "PROBES", 5)
    listed = spark.createDataFrame([(f"h{i}.com", "", "block", False) for i in range(0, 100, 2)], "host string, path string, verdict string, ruled boolean")
    pages = spark.createDataFrame([(i, f"http://www.h{i % 100}.com/x") for i in range(300)], "page_id long, url string")
    for r in url_filter.judge(pages, listed).collect():
        assert r.verdict == ("allow" if r.page_id % 2 else "block")


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string, ruled boolean")
    some = spark.createDataFrame(ENTRIES, none.schema)
    assert url_filter.judge(pages, some).collect() == [] and url_filter.judge(pages, none).collect() == []
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge(one, none).collect()] == [(1, "http://a.b/c", "a.b", "/c", None, "allow")]


def test_collisions_are_confirmed():
    digests = np.array([5, 5, 9, 5], np.uint64)
    strings = [b"b", b"a", b"c", b"ab"]
    held = url_filter.DigestArray(*url_filter.DigestArray.pack(digests, strings))
    found = held.find(np.array([5, 5, 5, 5, 9, 9, 1, 2**64 - 1], np.uint64), [b"a", b"ab", b"b", b"x", b"c", b"a", b"a", b"a"])
    assert (found >= 0).tolist() == [True, True, True, False, True, False, False, False]
    held.close()
    empty = url_filter.DigestArray(*url_filter.DigestArray.pack(np.zeros(0, np.uint64), []))
    assert empty.find(np.array([1], np.uint64), [b"a"]).tolist() == [-1]
    empty.close()

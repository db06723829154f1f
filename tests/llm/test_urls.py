import random

from logquarry.llm.urls import ALLOW, BLOCK, RULES, build_trie, filter_urls, match, op2_url_filter, split_url


def brute(rules, url, default=ALLOW):
    host, path = split_url(url)
    fits = [
        (h.count("."), len(p), v == BLOCK, h + p, v)
        for v, h, p in rules
        if ("." + host).endswith("." + h) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[3:] if fits else (None, default)))


URLS = [
    None, "", "no scheme", "http://a.net", "http://a.net/", "http://NET/x", "https://x.example.net/en/1?q#f",
    "http://example.net/en", "http://example.net?x/en/", "http://example.com/de/", "http://example.com/deutsch",
    "http://sub.example.com/de/x/y", "ftp://a.org/fr/#x", "http://a.org/fr", "http://xnet/", "a://b://c.net/", "http:///net/",
    "http://example.net:80/en/", "http://É.NET/Ä?", "http://a.net\n/x", "http://..net//",
]


def test_split_url():
    assert split_url("HTTP://ExÄmple.NET/Pa?x") == ("exÄmple.net", "/Pa")
    assert split_url("x://a#b/c") == ("a", "") and split_url("x://a?b/c") == ("a", "") and split_url("a/b") == ("", "")


def test_queries_rules_against_brute_force(make):
    frame = make([(i, u, "x", 1) for i, u in enumerate(URLS)] + [(None, "http://a.net/", None, None)] * 2, "page_id long, url string, rule string, id int")
    got = sorted((tuple(r) for r in filter_urls(frame, RULES).collect()), key=str)
    want = sorted(((i, *brute(RULES, u)) for i, u in [*enumerate(URLS), (None, "http://a.net/"), (None, "http://a.net/")]), key=str)
    assert got == want
    assert filter_urls(frame.limit(0), RULES).count() == 0
    assert {r["verdict"] for r in filter_urls(frame, [], default=BLOCK).collect()} == {BLOCK}


def test_random_rules_in_one_and_in_many_tries(make):
    random.seed(3)
    labels, parts = ["a", "b", "com", "net"], ["", "x", "xy", "en"]
    host = lambda: ".".join(random.choices(labels, k=random.randint(1, 3)))
    path = lambda: "/" + "/".join(random.choices(parts, k=random.randint(1, 3)))
    rules = [(random.choice([ALLOW, BLOCK]), host(), random.choice([path(), ""])) for _ in range(60)]
    urls = [f"http://{host()}{path()}" for _ in range(400)]
    trie = build_trie(rules)
    for u in urls:
        h, p, rule, verdict = brute(rules, u)
        assert (match(trie, h, p) or (0, 0, None, ALLOW))[2:] == (rule, verdict)
    frame = make(list(enumerate(urls)), "page_id long, url string")
    want = sorted((i, *brute(rules, u)) for i, u in enumerate(urls))
    for size in (100, 7):
        assert sorted(tuple(r) for r in filter_urls(frame, rules, rules_per_trie=size).collect()) == want


def test_query_judges_every_page(spark):
    sf = "/root/testdata/sf0.001"
    assert op2_url_filter(spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()

import re

from bibliospark.llm import url_filter as uf

from .helpers import rows

PAGES = "page_id long, url string, html string"


def brute(url):
    """(host, path, rule, its verdict) of the four rules of the contract."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (v, h + p) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    verdict, rule = max(fits, key=lambda x: len(x[1]), default=(None, None))
    return host, path, rule, verdict


URLS = [
    "http://a.example.net/en/1", "http://example.net/en/", "http://EXAMPLE.NET/en/x?q=1", "http://example.net/EN/x", "http://example.net",
    "http://example.net?x", "http://net/", "http://x.net/a#b", "http://xnet/", "http://example.com/de/1", "http://m.example.com/de",
    "http://w.org/fr/2", "http://org/fr/", "http://w.org/de/2", "http://example.net.evil/en/", "ftp://a.b.net/c", "no scheme", "", None,
    "://net/", "http://", "http:///path", "a://b://c.net/", "http://É.NET/ü", "http://x.net\n/a", "http://u:p@h.net:80/en/", "HTTP://Z.ORG/fr/\n",
    "http://" + "a." * 3000 + "net/" + "p/" * 3000,
]


def test_host_path_and_rule(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], PAGES)
    got = {r.page_id: r for r in uf.judge_urls(pages).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute(u)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict or "allow"), u


def test_repeats_clashing_columns_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", None), (1, "http://a.net/x", None), (None, "http://a.org/", None), (None, None, None)], PAGES)
    pages = pages.selectExpr("*", "'h' AS host", "'r' AS rule", "'t' AS tokens", "'v' AS verdict")
    got = rows(uf.judge_urls(pages), "page_id", "host", "rule", "verdict")
    assert got == [(None, "", None, "allow"), (None, "a.org", None, "allow"), (1, "a.net", "net/", "block"), (1, "a.net", "net/", "block")]
    assert uf.judge_urls(pages.limit(0)).count() == 0


def labelled(spark, n=400):
    """Pages of hosts without an explicit rule: casino words are bad, but not on one honest site."""
    made, marks = [], []
    for i in range(n):
        bad = i % 4 == 0
        honest = i % 20 == 1
        host = f"best-casino-{i % 7}.example.info" if bad else "museum-casino.example.edu" if honest else f"site{i % 9}.example.info"
        made.append((i, f"https://{host}/{['news', 'shop'][i % 2]}/{i}", None))
        marks.append((i, "block" if bad else "allow"))
    return spark.createDataFrame(made, PAGES), spark.createDataFrame(marks, "page_id long, verdict string")


def test_mined_rules_decide_the_rest(spark):
    pages, marks = labelled(spark)
    got = {r.page_id: r.verdict for r in uf.judge_urls(pages, marks).collect()}
    want = {r.page_id: r.verdict for r in marks.collect()}
    assert sum(got[i] == want[i] for i in want) >= 0.97 * len(want)
    unseen = spark.createDataFrame([(10_000, "http://another-casino-9.example.info/x", None)], PAGES)
    more = {r.page_id: r.verdict for r in uf.judge_urls(pages.unionByName(unseen), marks).collect()}
    assert more[10_000] == "block"


def test_pruned_rules(spark):
    pages, marks = labelled(spark)
    tokens = uf.tokens(uf.F.col("url"), uf.host(uf.F.col("url")), uf.path(uf.F.col("url")))
    mined = uf.mine_rules(pages.join(marks, "page_id").select(tokens.alias("tokens"), "verdict")).collect()
    assert mined
    conf = {(frozenset(r.tokens), r.verdict): r.confidence for r in mined}
    for (t, v), c in conf.items():
        assert c >= uf.MIN_CONFIDENCE
        assert not any(other < t and v == w and c <= d for (other, w), d in conf.items())


def test_thirty_query_names_are_one_item(spark):
    """A template's query names occur together: no subset of them is mined, and any of them tells the template."""
    names = [f"q{i}" for i in range(30)]
    made, marks = [], []
    for i in range(200):
        spam = i % 2 == 0
        query = "&".join(f"{n}={i}" for n in names) if spam else f"id={i}"
        made.append((i, f"https://site{i % 5}.example.info/page?{query}", None))
        marks.append((i, "block" if spam else "allow"))
    pages, labels = spark.createDataFrame(made, PAGES), spark.createDataFrame(marks, "page_id long, verdict string")
    tokens = uf.tokens(uf.F.col("url"), uf.host(uf.F.col("url")), uf.path(uf.F.col("url")))
    mined = uf.mine_rules(pages.join(labels, "page_id").select(tokens.alias("tokens"), "verdict")).collect()
    assert 0 < len(mined) < 50
    assert any(sorted(f"query={n}" for n in names) == r.alike[0] for r in mined if r.n == 1 and r.verdict == "block")
    more = spark.createDataFrame([(500, "https://other.example.org/x?q7=1", None), (501, "https://other.example.org/x?id=1", None)], PAGES)
    got = {r.page_id: r.verdict for r in uf.judge_urls(pages.unionByName(more), labels).collect()}
    assert got[500] == "block" and got[501] == "allow" and all(got[i] == v for i, v in marks)


def test_no_python_in_the_plan(spark):
    pages, marks = labelled(spark, 40)
    plan = uf.judge_urls(pages, marks)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("BatchEval|Pandas|MapInArrow", plan)

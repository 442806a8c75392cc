import pytest

from tests.llm.conftest import frame  # noqa: F401  (documents are not used here)
from tradeloom.llm import url_filters

SCHEMA = "page_id bigint, url string, html string, host string, label string, features string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [r for _, r in url_filters.RULES if (host == (n := r.split("/")[0]) or host.endswith("." + n)) and path.startswith(r[len(n) :])]
    return max(fits, key=len, default=None)


URLS = [
    None, "", "no scheme/com/", "http://a.com", "http://a.com/", "http://A.COM/x?y=1#z", "https://com/", "https://xcom/", "http://example.com/en/1",
    "http://www.example.com/en/1", "http://m.www.example.com/en/", "http://EXAMPLE.com/en", "http://example.com/EN/1", "http://b.net/es/1", "http://net/fr/",
    "http://b.net/de/1", "http://b.net?x=/es/", "http://b.net#/es/", "ftp://x://y.com/", "http://user@h.com:80/p", "a\nb://q.com/z", "http://É.com/", "http://İ.net/es/",
    "://com/", "http:///path", "http://x.org/" + "a/" * 5000 + "?" + "k=v&" * 500,
] * 2


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "x", "y", "z") for i, u in enumerate(urls)], SCHEMA)


def test_hosts_paths_and_rules(spark):
    rows = {r.page_id: r for r in url_filters.judged(pages(spark, URLS)).collect()}
    assert len(rows) == len(URLS)
    verdicts = {r: v for v, r in url_filters.RULES}
    for i, url in enumerate(URLS):
        host, path = split(url)
        rule = rule_of(host, path)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule), url
        assert rows[i].verdict == verdicts[rule] if rule else rows[i].verdict in ("allow", "block")


def test_trees_learn_what_labelled_urls_show(spark):
    good = [f"http://site{i}.example{i % 9}.com/page" for i in range(150)]
    bad = [f"http://b{i}.net/es/{i * 987654321 % 10**12}?a={i}&b=2&c=3&d=4" for i in range(150)]
    new = [f"http://news{i}.org/page" for i in range(20)] + [f"http://b{i}.org/es/{i * 123456789 % 10**12}?a={i}&b=2&c=3&d=4" for i in range(1, 20)]
    rows = {r.page_id: r for r in url_filters.judged(pages(spark, good + bad + new)).collect()}
    verdicts = [rows[300 + k].verdict for k in range(len(new))]
    assert all(rows[300 + k].rule is None for k in range(len(new)))
    assert verdicts[:20].count("allow") >= 19 and verdicts[20:].count("block") >= 18


@pytest.mark.parametrize("urls, verdict", [(["http://x.org/"] * 3, "allow"), (["http://a.com/", "http://x.org/"], "allow"), (["http://a.net/fr/", "q"], "block")])
def test_without_both_labels(spark, urls, verdict):
    assert {r.verdict for r in url_filters.judged(pages(spark, urls)).collect()} == {verdict}


def test_nothing(spark):
    assert url_filters.judged(pages(spark, [])).collect() == []


def test_no_python_on_the_main_path(spark):
    plan = url_filters.judged(pages(spark, URLS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan

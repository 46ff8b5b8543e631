"""URL verdicts against a direct reading of the rules."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa

from longrec.llm import url_filter

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.net", "/en/x", "block"), ("example.net", "/en/x/y", "allow"),
    ("org", "", "block"), ("a.org", "/p", "allow"), ("a.org", "/p", "block"), ("b.org", "/é", "allow"), ("", "/robots", "block"),
    ("deep.example.net", "/", "allow"), ("co", None, "block"), (None, "/", "block"), ("x", "/", None),
]
URLS = [
    (1, "https://www.example.net/en/1"), (2, "http://EXAMPLE.net/en/xy?q#f"), (3, "http://example.net/en/x/yes"), (4, "http://example.net/EN/"),
    (5, None), (6, ""), (7, "no scheme/en/"), (8, "x://net"), (9, "x://net?/"), (10, "x://notnet/"), (11, "x://a.org/private"), (12, "x://a.org"),
    (13, "x://b.org/éa"), (14, "x://.b.org/e"), (15, "x:///robots.txt"), (16, "x://other.de/robots"), (17, "x://y.deep.example.net/en/x"),
    (18, "x://co:80/"), (19, "x://sub.co"), (19, "x://sub.co"), (None, "x://a.net/a://b"), (20, "x://net" + "/long" * 20_000), (21, "x://Ä.net/\n?"),
    (22, "x://net./"), (23, "://example.net#/"),
]


def brute(url, rules, default="allow"):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")
    fitting = [
        (len(h.split(".")) if h else 0, len(p or ""), v == "block", h.lower() + (p or ""), v) for h, p, v in rules
        if h is not None and v is not None and (not h or host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p or "")
    ]
    best = max(fitting, default=None)
    return host, path, best and best[3], best[4] if best else default


def frames(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "old", 1) for i, u in urls], "page_id long, url string, RULE string, c0 int")
    return pages, spark.createDataFrame(rules, "host string, path string, verdict string")


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect())))


def test_verdicts(spark):
    pages, rules = frames(spark, URLS, RULES)
    got = url_filter.judge(pages, rules)
    assert got.columns == ["page_id", "url", "c0", "host", "path", "rule", "verdict"]
    wanted = sorted(repr((i, *brute(u, RULES))) for i, u in URLS)
    assert rows(got) == wanted
    # one rule a block
    assert rows(url_filter.judge(pages, rules, block_bytes=1)) == wanted
    kept = url_filter.allowed(pages, rules)
    assert kept.columns == pages.columns
    assert sorted(map(repr, (r.page_id for r in kept.collect()))) == sorted(repr(i) for i, u in URLS if brute(u, RULES)[3] == "allow")


def test_without_rows_or_rules(spark):
    pages, rules = frames(spark, URLS, RULES)
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {(r.rule, r.verdict) for r in url_filter.judge(pages, rules.limit(0), default="block").collect()} == {(None, "block")}


def test_url_column_of_a_result_name(spark):
    pages, rules = frames(spark, URLS[:2], RULES)
    got = url_filter.judge(pages.select("page_id", pages["url"].alias("host")), rules, url_col="host")
    assert rows(got) == sorted(repr((i, *brute(u, RULES))) for i, u in URLS[:2])


LABELS = st.sampled_from(["a", "b", "ab", "c", ""])


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.lists(LABELS, max_size=3).map(".".join), st.lists(LABELS, max_size=3).map("/".join), st.sampled_from(["allow", "block"])), max_size=8),
    st.lists(st.tuples(st.lists(LABELS, max_size=4).map(".".join), st.lists(LABELS, max_size=4).map("/".join)), max_size=8),
)
def test_trie(rules, urls):
    # an empty host and one that begins with a dot are different things; paths begin with a slash
    rules = [(h.strip("."), p and "/" + p, v) for h, p, v in rules]
    urls = [(h, p and "/" + p) for h, p in urls]
    trie = url_filter.Trie(rules)
    found, _ = trie.match(pa.array([h for h, _ in urls], pa.string()), pa.array([p for _, p in urls], pa.string()))
    got = [(trie.texts[k], trie.verdicts[k]) if k >= 0 else (None, "allow") for k in found]
    assert got == [brute("x://" + h + p, rules)[2:] for h, p in urls]

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from postlake.llm import queries, urls

SF = "/root/testdata/sf0.01"


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def brute_rule(host, path, rules):
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[3:] if fit else (None, None)


def brute_rank(edges, seeds, steps, damping=0.85):
    out = defaultdict(list)
    for a, b in edges:
        out[a].append(b)
    total = sum(seeds.values())
    base = {h: (1 - damping) * w / total for h, w in seeds.items()} if total else {}
    rank = dict(base)
    for _ in range(steps):
        new = Counter(base)
        for a, r in rank.items():
            for b in out[a]:
                new[b] += damping * r / len(out[a])
        rank = dict(new)
    return rank


def brute(pages, rules, steps=urls.ITERATIONS):
    rows = [(i, *split(u), x) for i, u, x in pages]
    ruled = [(i, h, p, *brute_rule(h, p, rules)) for i, h, p, _ in rows]
    edges = set()
    for (_, h, _, x) in rows:
        for link in re.findall(r"""(?i)\shref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)""", x or ""):
            to = split(link if "://" in link else "x:" + link)[0]
            if h and to and h != to:
                edges.add((h, to))
    trust = brute_rank(edges, Counter(h for _, h, _, _, v in ruled if h and v == "allow"), steps)
    distrust = brute_rank({(b, a) for a, b in edges}, Counter(h for _, h, _, _, v in ruled if h and v == "block"), steps)
    n = max(1, len({h for _, h, *_ in ruled if h}))
    verdict = lambda h: "block" if distrust.get(h, 0) > trust.get(h, 0) and distrust.get(h, 0) * n > urls.DISTRUST_FLOOR else "allow"
    return [(i, h, p, r, v or verdict(h), trust.get(h, 0), distrust.get(h, 0)) for i, h, p, r, v in ruled]


def page(i, url, *links):
    return i, url, "".join(f'<a class=x href="{x}">t</a>' for x in links)


PAGES = [
    page(1, "http://Good.com/a", "http://friend.org/x", "/local", "//cdn.org/y"), page(2, "https://friend.org/?q", "http://far.org"),
    page(3, "http://bad.net/es/x", "http://good.com/"), page(4, "ftp://shill.org#t", "HTTP://BAD.net/es/", "http://bad.net"),
    page(5, "http://shill.org/2", "http://far.org"), page(6, "http://bad.net/other"), page(7, None, "http://bad.net"), (8, "no scheme", None),
    page(9, "://x.example.com/en/1"), page(10, "http://www.example.com/en/"), page(11, "http://notexample.com/en/"), page(12, "http://a.b.example.com/EN/"),
    page(13, "http://com"), page(14, "http://com/"), page(15, "http://user@ÄB.net:80/fr/?"), page(1, "http://Good.com/a", "http://friend.org/x"),
    page(None, "http://hub.org/", *[f"http://h{i}.org/" for i in range(60)], "http://bad.net/"), (16, "", ""), (17, "http:///p", ""),
]
RULES = queries.URL_RULES


@pytest.mark.parametrize("rules", [RULES, RULES + [("block", "good.com", "/"), ("allow", "good.com", "/a")], []])
def test_matches_brute_force(spark, rules):
    df = spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], "page_id long, url string, html string, host string, rule string")
    got = [tuple(r) for r in urls.judge_urls(df.repartition(3), rules).collect()]
    key = lambda r: (str(r[0]), *map(str, r[1:5]), *(round(x, 9) for x in r[5:]))
    assert sorted(map(key, got)) == sorted(map(key, brute(PAGES, rules)))
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", PAGES)
    want = con.execute(urls.judge_sql(rules)).fetchall()
    assert sorted(map(lambda r: tuple(map(str, r)), want)) == sorted(tuple(map(str, r[:5])) for r in got)
    if rules is RULES:
        verdict = {r[0]: r[4] for r in got}
        assert verdict[4] == "block" and verdict[2] == "allow" and verdict[7] == "allow"


def test_chain_of_more_links_than_the_sql_has_steps(spark):
    chain = [page(i, f"http://c{i}.org/", f"http://c{i + 1}.org/") for i in range(14)]
    pages = [*chain, page(14, "http://c14.org/", "http://bad.net/"), page(15, "http://bad.net/es/x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judge_urls(df, RULES).collect()}
    want = {r[0]: r for r in brute(pages, RULES, 40)}
    assert got[0].verdict == want[0][4] == "block" and got[0].distrust == pytest.approx(0.15 * 0.85 ** 15)
    assert all(got[i].distrust == pytest.approx(r[6]) and got[i].verdict == r[4] for i, r in want.items())


def test_ranks_of_a_cycle_converge(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")]
    links = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("a", 3, 0), ("b", 1, 0), ("d", 0, 2)], "host string, trusted long, blocked long")
    got = {r.host: r for r in urls.propagate(links, seeds, 0.5, 1e-3).collect()}
    trust = brute_rank(edges, {"a": 3, "b": 1}, 60, 0.5)
    distrust = brute_rank([(b, a) for a, b in edges], {"d": 2}, 60, 0.5)
    for h in "abcd":
        assert 0 <= trust.get(h, 0) - got[h].trust + 1e-12 <= 1e-3 and 0 <= distrust.get(h, 0) - got[h].distrust + 1e-12 <= 1e-3


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge_urls(df, RULES).collect() == []


def test_query(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(SF + "/pages.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op8_urls(spark, SF).collect())
    assert [(*r[:3], str(r[3]), r[4]) for r in got] == sorted((*r[:3], str(r[3]), r[4]) for r in brute(pages, RULES))

"""URL filter: host and path rules, and PageRank over the host graph for all URLs that no rule decides.

Trust flows from the hosts whose pages rules allow along the links between hosts; distrust flows from the hosts whose
pages rules block against the links, to hosts that link to them. Each host gets one verdict from the two ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, materialize, prepare, release

DAMPING = 0.85
#: Ranks are iterated until all that is still to be spread is below this share of the mean rank of a host.
TOLERANCE = 0.001
#: Iterations that the SQL spells out; it gives the same ranks where no walk is longer.
ITERATIONS = 12
#: A host is blocked if its distrust is above its trust and above this share of the mean rank of a host.
DISTRUST_FLOOR = 0.1

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Targets of links to other hosts: an href that has a host.
HREF = r"""(?i)[\t\n\f\r ]href[\t\n\f\r ]*=[\t\n\f\r ]*["']?[\t\n\f\r ]*((?:[a-z][a-z0-9+.-]*:)?//[^"'\t\n\f\r >]+)"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is no ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL_PARTS, 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host itself and all its parent domains."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Add rule and rule_verdict to rows of page_id, host, path.

    ``rules``: host, path, verdict. A rule fits its host and all subdomains if the path starts with the rule's. The
    longest fitting rule (host and path together) wins; of equal length, that with the longer host, then block.
    Rules are looked up once for each distinct host.
    """
    hosts = pages.where("host <> ''").groupBy("host").agg(F.count("*").alias("pages"))
    wide = hosts.withColumn("rule_host", F.explode(host_suffixes(F.col("host"))))
    named = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_says")).distinct()
    of_host = wide.join(named, "rule_host").groupBy("host").agg(F.first("pages").alias("pages"), F.collect_list(F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"), F.length("rule_host").alias("host_length"),
        (F.col("rule_says") == "block").alias("blocks"), "rule_host", "rule_path", "rule_says")).alias("rules"))
    known = attach(pages, materialize(of_host, "url-rules"), "host", "pages", ["page_id"])
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    best = F.array_max(fits)
    return known.withColumn("_best", best).select(
        *[F.col(c) for c in pages.columns], F.concat(F.col("_best.rule_host"), F.col("_best.rule_path")).alias("rule"),
        F.col("_best.rule_says").alias("rule_verdict"))


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Distinct links between different hosts: src, dst."""
    links = pages.select(url_host(F.col(url_col)).alias("src"), F.explode(F.regexp_extract_all(F.col(html_col), F.lit(HREF), F.lit(1))).alias("href"))
    href = F.when(F.startswith("href", F.lit("//")), F.concat(F.lit("x:"), "href")).otherwise(F.col("href"))
    return links.select("src", url_host(href).alias("dst")).where("src <> '' and dst <> '' and src <> dst").distinct()


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank of trust along the links and of distrust against them: host, trust, distrust.

    ``seeds``: host, trusted, blocked (weights). Each kind of seed shares a total of 1; the rank that reaches a host
    without further links leaves the walk. Both ranks go through the same job, under a key of kind and host; a host
    with very many links is split by ``attach``. Steps go on until no rank can grow by ``tolerance`` any more: what a
    step adds falls by the damping each time, so all steps to come add at most damping / (1 - damping) of the last.
    """
    edges = links.select(F.concat(F.lit("t:"), "src").alias("src"), F.concat(F.lit("t:"), "dst").alias("dst")) \
        .union(links.select(F.concat(F.lit("d:"), "dst"), F.concat(F.lit("d:"), "src")))
    edges = materialize(edges, "url-edges")
    n_edges = edges.count()
    sums = seeds.agg(F.sum("trusted").alias("t"), F.sum("blocked").alias("b")).first()
    share = lambda kind, col, total: seeds.where(F.col(col) > 0).select(
        F.concat(F.lit(kind), "host").alias("node"), (F.col(col) / F.lit(float(total or 1))).alias("seed"), F.lit(0).cast("long").alias("degree"))
    base = share("t:", "trusted", sums["t"]).union(share("d:", "blocked", sums["b"])).union(
        edges.groupBy(F.col("src").alias("node")).agg(F.lit(0.0).alias("seed"), F.count("*").alias("degree")))
    base = materialize(base.groupBy("node").agg(F.sum("seed").alias("seed"), F.sum("degree").alias("degree")), "url-nodes")
    first = (1 - damping) * F.col("seed")
    rank = base.select("node", first.alias("rank"), first.alias("gain"), "degree")
    none, left = F.lit(0.0), float("inf")
    while n_edges and left > tolerance:
        sends = rank.where("degree > 0 and gain > 0")
        sent = attach(edges, sends.select(F.col("node").alias("src"), (F.col("gain") / F.col("degree")).alias("each"), "degree"),
                      "src", "degree", ["dst"], total=n_edges)
        flow = sent.where("each is not null").select(
            F.col("dst").alias("node"), none.alias("rank"), (damping * F.col("each")).alias("gain"), F.lit(0).cast("long").alias("degree"))
        both = rank.select("node", "rank", none.alias("gain"), "degree").union(flow).groupBy("node").agg(
            F.sum("rank").alias("rank"), F.sum("gain").alias("gain"), F.sum("degree").alias("degree"))
        last, rank = rank, materialize(both.withColumn("rank", F.col("rank") + F.col("gain")), "url-rank")
        if hasattr(last, "scratch"):
            release(last)
        left = (rank.where("degree > 0").agg(F.sum("gain")).first()[0] or 0.0) * damping / (1 - damping)
    kind = F.substring("node", 1, 2)
    return rank.groupBy(F.expr("substring(node, 3)").alias("host")).agg(
        F.coalesce(F.sum(F.when(kind == "t:", F.col("rank"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(kind == "d:", F.col("rank"))), F.lit(0.0)).alias("distrust"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", damping: float = DAMPING, tolerance: float = TOLERANCE,
               distrust_floor: float = DISTRUST_FLOOR) -> DataFrame:
    """Judge every URL: page_id, host, path, rule, verdict, trust, distrust.

    ``rules``: (verdict, host, path) tuples, or a DataFrame of host, path, verdict. The longest fitting rule decides;
    else the host's ranks do (see ``DISTRUST_FLOOR``). Seeds weigh the number of a host's pages that rules allow or
    block. A null URL, or one without ``://``, has an empty host and path, no rule and no rank, and is allowed. Null
    html has no links. Repeated rows are judged alike, once each. Ranks are short of their limit by at most
    ``tolerance`` / hosts.
    """
    spark = pages.sparkSession
    prepare(spark)
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(h, p, v) for v, h, p in rules], "host string, path string, verdict string")
    url = F.col(url_col)
    parts = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    ruled = materialize(match_rules(parts, rules), "url-ruled")
    counts = materialize(ruled.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("rule_verdict") == "allow").alias("trusted"),
        F.count_if(F.col("rule_verdict") == "block").alias("blocked")), "url-hosts")
    hosts = max(1, counts.count())
    ranks = propagate(host_links(pages, url_col, html_col), counts, damping, tolerance / hosts)
    judged = counts.select("host", "pages").join(ranks, "host", "left").select(
        "host", "pages", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") * hosts > distrust_floor)
    judged = materialize(judged.withColumn("host_verdict", F.when(bad, "block").otherwise("allow")), "url-judged")
    out = attach(ruled, judged, "host", "pages", ["page_id"])
    return out.select(F.col("page_id").alias(id_col), "host", "path", "rule",
                      F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict"),
                      F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def judge_sql(rules: list[tuple[str, str, str]], damping: float = DAMPING, iterations: int = ITERATIONS,
              distrust_floor: float = DISTRUST_FLOOR) -> str:
    """The same judgement of the table ``pages`` as one SQL statement, a common table expression for each iteration."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    host = lambda url: f"translate(regexp_extract({url}, '{URL_PARTS}', 1), '{UPPER}', '{LOWER}')"
    rows = ", ".join(f"({quote(v)}, {quote(h)}, {quote(p)})" for v, h, p in rules) or "(NULL, NULL, NULL)"
    ranks, last = [], {}
    for kind, weight, src, dst in (("t", "trusted", "src", "dst"), ("d", "blocked", "dst", "src")):
        ranks.append(f"""{kind}e AS (SELECT {src} AS u, {dst} AS v, count(*) OVER (PARTITION BY {src}) AS n FROM links),
{kind}0 AS (SELECT host, {1 - damping} * {weight} / sum({weight}) OVER () AS r FROM hosts WHERE {weight} > 0)""")
        for i in range(iterations):
            ranks.append(f"""{kind}{i + 1} AS (SELECT host, sum(r) AS r FROM (SELECT host, r FROM {kind}0 UNION ALL
  SELECT v, {damping} * r / n FROM {kind}{i} JOIN {kind}e ON host = u) GROUP BY host)""")
        last[kind] = f"{kind}{iterations}"
    steps = ",\n".join(ranks)
    return f"""
WITH parts AS (SELECT row_number() OVER () AS row_id, page_id, html, coalesce({host('url')}, '') AS host,
  coalesce(regexp_extract(url, '{URL_PARTS}', 2), '') AS path FROM pages),
rules(says, rule_host, rule_path) AS (VALUES {rows}),
best AS (SELECT row_id, rule_host || rule_path AS rule, says FROM parts JOIN rules
  ON host <> '' AND (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, says DESC) = 1),
ruled AS (SELECT parts.*, rule, says FROM parts LEFT JOIN best USING (row_id)),
hosts AS (SELECT host, count(*) FILTER (says = 'allow') AS trusted, count(*) FILTER (says = 'block') AS blocked
  FROM ruled WHERE host <> '' GROUP BY host),
hrefs AS (SELECT host AS src, unnest(regexp_extract_all(html, {quote(HREF)}, 1)) AS href FROM parts),
links AS (SELECT DISTINCT src, dst FROM (SELECT src, {host("CASE WHEN starts_with(href, '//') THEN 'x:' || href ELSE href END")} AS dst FROM hrefs)
  WHERE src <> '' AND dst <> '' AND src <> dst),
{steps},
judged AS (SELECT hosts.host, coalesce(d.r, 0) > coalesce(t.r, 0) AND coalesce(d.r, 0) * count(*) OVER () > {distrust_floor} AS bad
  FROM hosts LEFT JOIN {last['t']} t ON t.host = hosts.host LEFT JOIN {last['d']} d ON d.host = hosts.host)
SELECT page_id, ruled.host, path, rule, coalesce(says, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN judged ON judged.host = ruled.host
"""

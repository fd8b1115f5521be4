"""URL filters: explicit rules, and trust and distrust that spread over the links between hosts.

Trust is a personalised PageRank from the hosts of allowed pages along the links; distrust is one from the hosts of blocked pages
against them, as a page that links to a bad host is suspect. Each starts at the seed hosts by their numbers of such pages and sums to one; weighted by
all pages of its kind, it tells how many allowed or blocked pages stand behind a host. A host with more distrust than trust is blocked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .job import ascii_lower, discard, spread_join, stored


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]

#: Links to another host: absolute ones and those that leave the scheme out.
LINK = r"(?i)\bhref\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or no ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ranked(rules: list[Rule]) -> list[Rule]:
    """Longest first; of two equally long ones the one that blocks."""
    return sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The number in ``ranked`` of the rule that fits, or null."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(ranked(rules)))):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(k)).otherwise(out)
    return out


def judged(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """The rows with host, path, rule (its text) and by_rule (its verdict)."""
    pages = pages.drop("host", "path", "rule", "by_rule").withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    number = rule_for(F.col("host"), F.col("path"), rules)
    texts, verdicts = F.array(*[F.lit(r.text) for r in ranked(rules)]), F.array(*[F.lit(r.verdict) for r in ranked(rules)])
    return pages.withColumn("number", number).withColumns({"rule": F.get(texts, "number"), "by_rule": F.get(verdicts, "number")}).drop("number")


def host_links(pages: DataFrame, host_col: str = "host", html_col: str = "html") -> DataFrame:
    """(source, target, n) for each two different hosts, one of which links to the other."""
    urls = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), F.lit(1)))
    links = pages.select(F.col(host_col).alias("source"), F.explode(urls).alias("url"))
    links = links.select(
        "source",
        host_of(F.when(F.startswith("url", F.lit("//")), F.concat(F.lit("http:"), F.col("url"))).otherwise(F.col("url"))).alias("target")
    )
    return links.where("source <> '' AND target <> '' AND source <> target").groupBy("source", "target").agg(F.count("*").alias("n"))


#: What a few more steps may still move, as a share of all rank.
SETTLED = 1e-10


def propagate(links: DataFrame, trusted: DataFrame, blocked: DataFrame, damping: float = 0.85, steps: int = 400, steps_per_table: int = 5) -> DataFrame:
    """(host, trust, distrust, trust_pages, distrust_pages) of every host that either reaches.

    ``trusted`` and ``blocked`` hold host, without repeats, and pages. trust and distrust sum to one each, if they have a seed; the others are the same times
    the seeds' pages. What a host without links can't pass on goes back to the seeds. Both run at once, as ranks of two kinds over the links and
    over the reversed links; the ranks are written to the shared folder every ``steps_per_table`` steps, which ends their lineage. They have
    settled when so many steps together move less than SETTLED of the whole; that this takes more than ``steps`` is an error. Without
    a link every rank is its seed's, and no step is taken.
    """
    both = links.select(F.lit("trust").alias("kind"), "source", "target", "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "n")
    )
    out = both.groupBy("kind", "source").agg(F.sum("n").alias("total"))
    edges = stored(both.join(out, ["kind", "source"]).select("kind", "source", "target", (F.col("n") / F.col("total")).alias("share")))
    seeds = trusted.select(F.lit("trust").alias("kind"), "host", "pages").unionByName(blocked.select(F.lit("distrust").alias("kind"), "host", "pages"))
    start = stored(seeds.select("kind", "host", F.col("pages").cast("double").alias("score")))
    total = stored(start.groupBy("kind").agg(F.sum("score").alias("all")))  # a row for each of the two kinds
    ranks, tables = start, [edges, start, total]
    settled = edges.isEmpty()
    for _ in range(0, steps, steps_per_table):
        if settled:
            break
        before = ranks
        for _ in range(steps_per_table):
            passed = ranks.withColumnRenamed("host", "source").join(edges, ["kind", "source"]).groupBy("kind", F.col("target").alias("host")).agg(
                F.sum(damping * F.col("score") * F.col("share")).alias("score")
            )
            back = total.join(passed.groupBy("kind").agg(F.sum("score").alias("sum")), "kind", "left").select(
                "kind", (1 - F.coalesce("sum", F.lit(0.0)) / F.col("all")).alias("back")
            )
            again = start.join(F.broadcast(back), "kind").select("kind", "host", (F.col("score") * F.col("back")).alias("score"))
            ranks = passed.unionByName(again).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        ranks = stored(ranks)
        tables.append(ranks)
        signed = ranks.unionByName(before.select("kind", "host", (-F.col("score")).alias("score"))).groupBy("kind", "host").agg(F.abs(F.sum("score")).alias("moved"))
        moved = signed.groupBy("kind").agg(F.sum("moved").alias("moved")).join(total, "kind").agg(F.max(F.col("moved") / F.col("all"))).first()[0]
        settled = moved is None or moved < SETTLED
    if not settled:
        raise ValueError(f"the ranks haven't settled after {steps} steps")
    ranks = ranks.join(F.broadcast(total), "kind").withColumn("rank", F.col("score") / F.col("all"))
    of = lambda kind, c, name: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(c))), F.lit(0.0)).alias(name)
    scores = stored(
        ranks.groupBy("host").agg(of("trust", "rank", "trust"), of("distrust", "rank", "distrust"), of("trust", "score", "trust_pages"), of("distrust", "score", "distrust_pages"))
    )
    discard(*tables)
    return scores


#: Sums in another order differ less than this; trust and distrust this close are a tie.
TIE = 1e-9


def judge(
    pages: DataFrame, rules: list[Rule] = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    damping: float = 0.85, steps: int = 400
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The verdict is that of the longest rule which fits the url; else ``block`` if more distrust than trust reaches the page's host, else
    ``allow``. A host's own pages that rules decide are seeds, so without any link a host with more blocked than allowed pages is blocked as a whole; a
    host that nothing reaches, and a tie, is allowed. A null url has an empty host and path, fits no rule and links to nothing. Repeated rows
    count as often as they are there. Other columns aren't read.
    """
    rows = judged(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")), rules)
    seeds = rows.where(F.col("by_rule").isNotNull() & (F.col("host") != "")).groupBy("by_rule", "host").agg(F.count("*").alias("pages"))
    scores = propagate(
        host_links(rows), *(seeds.where(F.col("by_rule") == v).select("host", "pages") for v in ("allow", "block")), damping=damping,
        steps=steps
    )
    bad = scores.where(F.col("distrust_pages") > F.col("trust_pages") * (1 + TIE) + TIE).select("host", F.lit("block").alias("by_links"))
    rows = spread_join(rows.select("page_id", "host", "path", "rule", "by_rule"), bad, ["host"], by="page_id", how="left")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_links", F.lit("allow")).alias("verdict"))


def duckdb_sql(rules: list[Rule] = RULES, damping: float = 0.85, steps: int = 150) -> str:
    """The same in DuckDB, with as many steps written out as leave less than SETTLED to move."""
    lower = lambda c: f"translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = lambda c: lower(f"coalesce(regexp_extract({c}, '(?s)^.*?://([^/?#]*)', 1), '')")
    case = lambda f: "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{f(r)}'" for r in ranked(rules)
    ) + " END"
    step = lambda k: f"""p{k} AS MATERIALIZED (SELECT e.kind, e.target AS host, sum({damping} * r.score * e.share) AS score FROM r{k} r JOIN edges e ON e.kind = r.kind AND e.source = r.host GROUP BY 1, 2),
b{k} AS MATERIALIZED (SELECT kind, 1 - coalesce((SELECT sum(score) FROM p{k} WHERE p{k}.kind = t.kind), 0) / t.total AS back FROM t),
r{k + 1} AS MATERIALIZED (SELECT kind, host, sum(score) AS score FROM (SELECT * FROM p{k} UNION ALL SELECT kind, host, score * back FROM r0 JOIN b{k} USING (kind)) GROUP BY 1, 2)"""  # noqa: E731
    ranks = [step(k) for k in range(steps)]
    link = LINK.replace("'", "''")
    return f"""
WITH p AS (SELECT page_id, html, {host("url")} AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
j AS (SELECT *, {case(lambda r: r.text)} AS rule, {case(lambda r: r.verdict)} AS by_rule FROM p),
l0 AS (SELECT host AS source, unnest(list_distinct(regexp_extract_all(coalesce(html, ''), '{link}', 1))) AS url FROM p),
l1 AS (SELECT source, {host("CASE WHEN starts_with(url, '//') THEN 'http:' || url ELSE url END")} AS target FROM l0),
l AS (SELECT source, target, count(*) AS n FROM l1 WHERE source <> '' AND target <> '' AND source <> target GROUP BY 1, 2),
both_ways AS (SELECT 'trust' AS kind, source, target, n FROM l UNION ALL SELECT 'distrust', target, source, n FROM l),
edges AS MATERIALIZED (SELECT kind, source, target, n / sum(n) OVER (PARTITION BY kind, source) AS share FROM both_ways),
r0 AS MATERIALIZED (SELECT CASE by_rule WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*)::DOUBLE AS score FROM j WHERE by_rule IS NOT NULL AND host <> '' GROUP BY 1, 2),
t AS MATERIALIZED (SELECT kind, sum(score) AS total FROM r0 GROUP BY 1),
{", ".join(ranks)},
bad AS (SELECT host FROM r{steps} GROUP BY host HAVING coalesce(sum(score) FILTER (kind = 'distrust'), 0) > coalesce(sum(score) FILTER (kind = 'trust'), 0) * (1 + {TIE}) + {TIE})
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN bad.host IS NOT NULL THEN 'block' END, 'allow') AS verdict FROM j LEFT JOIN bad USING (host)
"""

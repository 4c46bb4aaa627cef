"""URL verdicts from prefix rules, and for the rest from trust that travels along links.

A rule names a host (with its subdomains) and the beginning of a path; of the rules that fit,
the longest decides. Hosts are joined by their pages' links: an edge runs from a page's host to the host of
each absolute link, weighted by its share of the host's links. Trust starts at hosts by the share of their pages that
allow rules cover, distrust by the share that block rules cover. Personalised PageRank moves
trust along the edges; distrust moves against them, to hosts that link to blocked ones, until both are settled. A URL without a rule is
blocked if its host's distrust is at least `BLOCK` and above its trust, else allowed.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up
to ``?``, ``#`` or the end. NULL urls and those without ``://`` have both empty, no rule and no
host to judge: they are allowed. Pages with NULL html have no links; empty hosts have no edges. Ties between rules of equal
length go to the first. Repeated pages count as often as they occur; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import staged, table

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Share that moves on, rounds of moving in the SQL (by then settled), distrust that blocks.
DAMPING, ROUNDS, BLOCK = 0.85, 150, 0.5
#: Rounds end when all that is still to move cannot change a host's trust or distrust by more than this.
SETTLED = 1e-9


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, NULL without one."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):  # the last one that fits counts
        own = (host == rule_host) | host.endswith("." + rule_host)
        fits = own & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Host edges (src, dst, weight): weights of a source add up to one."""
    found = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r"""(?i)(?:href|src)\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""), F.lit(1))
    target = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    pairs = (
        pages.select(host_of(F.col(url)).alias("src"), F.explode(found).alias("link"))
        .select("src", host_of(target).alias("dst")).where("src != dst and src != '' and dst != ''")
        .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    )
    out = pairs.groupBy("src").agg(F.sum("n").alias("all"))
    return pairs.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("weight"))


def propagate(hosts: DataFrame, edges: DataFrame, damping: float = DAMPING) -> DataFrame:
    """``hosts`` (host, trust_seed, distrust_seed) with trust and distrust, on the scale of the seeds.

    Each round moves on what came in the round before and adds it up, so the sums never pass the settled values.
    """
    spark_edges = staged(edges, "edges")
    state = staged(hosts.select("host", "trust_seed", "distrust_seed", F.col("trust_seed").alias("trust"), F.col("distrust_seed").alias("distrust")), "trust")
    if spark_edges.isEmpty():
        return state
    everyone = spark_edges.select(F.col("src").alias("host")).unionByName(spark_edges.select(F.col("dst").alias("host"))).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    # a host no edge reaches keeps its seed: restarts are on the scale of the seeds
    state = staged(everyone.join(state, "host", "full").select(
        "host", *[zero(c).alias(c) for c in ("trust_seed", "distrust_seed", "trust", "distrust")],
        zero("trust").alias("trust_step"), zero("distrust").alias("distrust_step")), "trust")
    while True:
        # all trust that moves shrinks by the damping, and so does the largest distrust of a host
        trust_left, distrust_left = state.agg(F.sum("trust_step"), F.max("distrust_step")).first()
        if max(trust_left or 0.0, distrust_left or 0.0) * damping / (1 - damping) < SETTLED:
            return state.drop("trust_step", "distrust_step")
        forward = spark_edges.join(state.where("trust_step > 0").select(F.col("host").alias("src"), "trust_step"), "src").groupBy(
            F.col("dst").alias("host")).agg(F.sum(F.col("trust_step") * F.col("weight")).alias("came"))
        backward = spark_edges.join(state.where("distrust_step > 0").select(F.col("host").alias("dst"), "distrust_step"), "dst").groupBy(
            F.col("src").alias("host")).agg(F.sum(F.col("distrust_step") * F.col("weight")).alias("back"))
        came, back = damping * zero("came"), damping * zero("back")
        state = staged(state.join(forward, "host", "left").join(backward, "host", "left").select(
            "host", "trust_seed", "distrust_seed", (F.col("trust") + came).alias("trust"), (F.col("distrust") + back).alias("distrust"),
            came.alias("trust_step"), back.alias("distrust_step")), "trust")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: id, host, path, rule and verdict, with its host's trust and distrust."""
    kept = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, verdict = fitting(rules, F.col("host"), F.col("path"))
    parsed = kept.select("page_id", host.alias("host"), path.alias("path")).withColumns({"rule": name, "ruled": verdict})
    share = lambda kind: F.avg(F.when(F.col("ruled") == kind, 1.0).otherwise(0.0))
    seeds = parsed.where("host != ''").groupBy("host").agg(share("allow").alias("trust_seed"), share("block").alias("distrust_seed"))
    scores = staged(propagate(seeds, links(kept)).select("host", "trust", "distrust"), "host-trust")
    bad = (F.col("distrust") >= BLOCK) & (F.col("distrust") > F.col("trust"))
    own = F.when(F.coalesce(bad, F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return parsed.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    """The same rules and `ROUNDS` rounds of moving, after which less than 1e-10 of a seed is left to move."""
    by_length = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    case = lambda value: "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(k, h, p)}'" for k, h, p in by_length) + " END"
    return rf"""
WITH RECURSIVE parsed AS (
  SELECT page_id, html,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
ruled AS (SELECT *, {case(lambda k, h, p: h + p)} AS rule, {case(lambda k, h, p: k)} AS ruled FROM parsed),
found AS (
  SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '(?i)(?:href|src)\s*=\s*["'']?((?:https?:)?//[^"''\s>]+)', 1)) AS link FROM parsed),
pairs AS (
  SELECT src, translate(regexp_extract(link, '^(?:https?:)?//([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst, count(*) AS n
  FROM found GROUP BY ALL),
edges AS (
  SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS w FROM pairs WHERE src <> dst AND src <> '' AND dst <> ''),
seeds AS (
  SELECT host, avg(CASE WHEN ruled = 'allow' THEN 1.0 ELSE 0.0 END) AS ts, avg(CASE WHEN ruled = 'block' THEN 1.0 ELSE 0.0 END) AS ds
  FROM ruled WHERE host <> '' GROUP BY host),
state AS (
  SELECT 0 AS i, host, coalesce(ts, 0.0) AS ts, coalesce(ds, 0.0) AS ds, coalesce(ts, 0.0) AS t, coalesce(ds, 0.0) AS d
  FROM seeds FULL JOIN (SELECT src AS host FROM edges UNION SELECT dst FROM edges) e USING (host)
  UNION ALL
  SELECT n.i + 1, n.host, n.ts, n.ds, n.ts + {DAMPING} * coalesce(f.v, 0), n.ds + {DAMPING} * coalesce(b.v, 0)
  FROM state n
  LEFT JOIN (SELECT dst AS host, sum(s.t * w) AS v FROM edges JOIN state s ON s.host = src GROUP BY dst) f ON f.host = n.host
  LEFT JOIN (SELECT src AS host, sum(s.d * w) AS v FROM edges JOIN state s ON s.host = dst GROUP BY src) b ON b.host = n.host
  WHERE n.i < {ROUNDS})
SELECT page_id, ruled.host, path, rule, coalesce(ruled, CASE WHEN d >= {BLOCK} AND d > t THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN (SELECT host, t, d FROM state WHERE i = {ROUNDS}) s ON s.host = ruled.host
"""


ORACLE = _oracle()

"""URL filter: host/path rules, else propagated link-graph scores (DataFrame
functions only).

A rule names a host and the start of a path and fits the host with all its
subdomains; the longest fitting rule decides. Every other page gets its host's
verdict: trust is a personalised PageRank from the hosts whose pages the rules
allow, along links; distrust is one from the hosts whose pages they block,
against the links (who links to a blocked host is distrusted). A seed's weight
is the share of its pages with such a rule.

Edges are the absolute links in the pages, weighted by their number, and links
of weight 1 both ways between a host and its parent domain (down to two labels),
so sites with relative links only are connected too. Links are counted map-side
first, ranks are rows of a table, and each round is one join and one sum; every
``CUT`` rounds the ranks are checkpointed.

A plain score shrinks with a host's number of neighbours and says little by
itself, so each is divided by what the same walk brings the host when every page
is a seed: distrust becomes the share of blocked pages, trust of allowed ones,
among the pages that reach the host, each in [0, 1] whatever the size of the
graph. A host is blocked if distrust exceeds trust by more than the share of
blocked pages among all: what reaches it is worse than the corpus at large.
``judge`` (query ``op2_urls``) walks ``ROUNDS`` rounds, so SQL can repeat it.

``judge_by_share`` (query ``op2_urls_share``) walks until no share changes by
``BOUND`` in ``CUT`` rounds and blocks from a difference of ``BLOCK_AT`` on.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits
no rule and is allowed (an empty host has no edges and no score); a null html has
no links, a very long one all of its links; repeated pages weigh as often as they
come; a null page_id is kept; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ubeat.llm.common import checkpoint

#: (verdict, host, start of the path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING = 0.85
ROUNDS = 12
CUT = 4
BLOCK_AT = 0.25
#: Shares: the largest change that ends the walk, per ``CUT`` rounds.
BOUND = 1e-4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?((?:[a-z][a-z0-9+.\-]*:)?//[^\s"'<>]*)"""


def _after_scheme(url: Column, mark: str) -> Column:
    at = F.instr(url, mark)
    return F.when(at > 0, url.substr(at + len(mark), F.length(url))).otherwise("")


def url_host(url: Column, mark: str = "://") -> Column:
    rest = F.coalesce(_after_scheme(url, mark), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url, "://"), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule and the rule's verdict (or nulls)."""
    out = pages.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    rule = verdict = None
    for kind, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:])):
        fits = (((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path))
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return out.withColumn("rule", rule).withColumn("ruled", verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts; ``pages`` has host and html."""
    links = (pages.where("host != ''").select("host", F.explode(F.regexp_extract_all(F.col("html"), F.lit(_LINK), 1)).alias("to"))
             .select(F.col("host").alias("src"), url_host(F.col("to"), "//").alias("dst")))
    links = links.where("dst != ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))
    seen = pages.select("host").union(links.select("dst")).where("host != ''").distinct()
    labels = F.split("host", r"\.")
    chain = F.transform(F.sequence(F.lit(1), F.greatest(F.size("labels") - 1, F.lit(1))),
                        lambda i: F.array_join(F.slice(F.col("labels"), i, F.size("labels")), "."))
    pair = (seen.withColumn("labels", labels).where("size(labels) > 2").withColumn("chain", chain)
            .select(F.explode(F.arrays_zip(F.expr("slice(chain, 1, size(chain) - 1)").alias("child"),
                                           F.expr("slice(chain, 2, size(chain) - 1)").alias("parent"))).alias("p"))
            .select("p.child", "p.parent").distinct())
    both = (pair.select(F.col("child").alias("src"), F.col("parent").alias("dst"))
            .union(pair.select("parent", "child")).withColumn("weight", F.lit(1).cast("long")))
    return (links.unionByName(both).where("src != dst").groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


def _steps(edges: DataFrame, kind: str, a: str, b: str, damping: float) -> DataFrame:
    total = edges.groupBy(F.col(a).alias("at")).agg(F.sum("weight").alias("total"))
    return edges.select(F.col(a).alias("at"), F.col(b).alias("to"), "weight").join(total, "at").select(
        "at", "to", F.lit(kind).alias("kind"), (F.lit(damping) * F.col("weight") / F.col("total")).alias("p"))


def _walk(pages: DataFrame, damping: float) -> DataFrame:
    """(at, to, kind, p): a step along links for trust, against them for distrust."""
    edges = checkpoint(host_edges(pages))
    return checkpoint(_steps(edges, "trust", "src", "dst", damping).union(_steps(edges, "distrust", "dst", "src", damping)))


def _round(walk: DataFrame, ranks: DataFrame, seeds: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """One round; ``kinds`` has the direction of every score."""
    sent = walk.join(ranks, walk["at"] == ranks["host"]).select(
        F.col("to").alias("host"),
        *[F.when(F.col("kind") == k, F.col("p") * F.col(c)).otherwise(0.0).alias(c) for c, k in kinds.items()])
    return sent.union(seeds).groupBy("host").agg(*[F.sum(c).alias(c) for c in kinds])


def _share(kind: str) -> Column:
    return F.avg(F.when(F.col("ruled") == kind, 1.0).otherwise(0.0))


def host_scores(pages: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) from ``pages`` with host, html and ruled."""
    walk = _walk(pages, damping)
    seeds = checkpoint(pages.where("host != ''").groupBy("host").agg(
        (_share("allow") * (1 - damping)).alias("trust"), (_share("block") * (1 - damping)).alias("distrust")))
    ranks = seeds
    for i in range(rounds):
        ranks = _round(walk, ranks, seeds, {"trust": "trust", "distrust": "distrust"})
        if i % CUT == CUT - 1:
            ranks = checkpoint(ranks)
    return ranks.select("host", F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust"))


def host_shares(pages: DataFrame, damping: float = DAMPING, bound: float = BOUND, rounds: int | None = None) -> DataFrame:
    """(host, trust, distrust) as shares of the walk's mass; ``pages`` as for
    ``host_scores``. ``rounds`` rounds, or until no share changes by ``bound`` in
    ``CUT`` rounds. A host that no page reaches has shares 0."""
    walk = _walk(pages, damping)
    seeds = checkpoint(pages.where("host != ''").groupBy("host").agg(
        (_share("allow") * (1 - damping)).alias("trust"), (_share("block") * (1 - damping)).alias("distrust"),
        F.lit(1 - damping).alias("trust_mass"), F.lit(1 - damping).alias("distrust_mass")))
    kinds = {"trust": "trust", "distrust": "distrust", "trust_mass": "trust", "distrust_mass": "distrust"}

    def shares(ranks: DataFrame) -> DataFrame:
        return ranks.select("host", *[F.when(F.col(f"{k}_mass") > 0, F.col(k) / F.col(f"{k}_mass")).otherwise(0.0).alias(k)
                                      for k in ("trust", "distrust")])

    if rounds is not None:
        ranks = seeds
        for i in range(rounds):
            ranks = _round(walk, ranks, seeds, kinds)
            if i % CUT == CUT - 1:
                ranks = checkpoint(ranks)
        return shares(ranks).select("host", F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust"))
    ranks, change = seeds, bound
    while change >= bound:
        before = ranks
        for _ in range(CUT):
            ranks = _round(walk, ranks, seeds, kinds)
        ranks = checkpoint(ranks)
        old, new = shares(before).alias("old"), shares(ranks).alias("new")
        moved = [F.abs(F.coalesce(F.col(f"old.{k}"), F.lit(0.0)) - F.col(f"new.{k}")) for k in ("trust", "distrust")]
        change = new.join(old, F.col("old.host") == F.col("new.host"), "left").agg(F.max(F.greatest(*moved))).first()[0] or 0.0
    return shares(ranks)


def blocked_share(pages: DataFrame) -> float:
    """The share of pages (with a host) that a rule blocks, to nine digits."""
    return pages.where("host != ''").agg(F.round(_share("block"), 9)).first()[0] or 0.0


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page."""
    seen = ruled(pages.select("page_id", "url", "html"), rules)
    over = F.round(F.col("distrust") - F.col("trust"), 9) > F.lit(blocked_share(seen))
    blocked = F.coalesce(over, F.lit(False))
    return (seen.select("page_id", "host", "path", "rule", "ruled").join(host_shares(seen, rounds=ROUNDS), "host", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict")))


def judge_by_share(pages: DataFrame, rules=RULES) -> DataFrame:
    """Like ``judge``, by shares: (page_id, host, path, rule, verdict)."""
    seen = ruled(pages.select("page_id", "url", "html"), rules)
    blocked = F.coalesce(F.col("distrust") - F.col("trust") >= BLOCK_AT, F.lit(False))
    return (seen.select("page_id", "host", "path", "rule", "ruled").join(host_shares(seen), "host", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict")))


def op2_urls(spark, sf_dir) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_urls_share(spark, sf_dir) -> DataFrame:
    return judge_by_share(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _sql() -> str:
    host = r"translate(regexp_extract({0}, '^([^/?#]*)', 1), '" + _UPPER + "', '" + _LOWER + "')"
    order = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1:]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in order]
    case = lambda i: "CASE " + " ".join(f"WHEN {f} THEN '{(r[1] + r[2], r[0])[i]}'" for f, r in zip(fits, order, strict=True)) + " END"
    link = _LINK.replace("'", "''")
    ranks = ["r0 AS (SELECT * FROM seeds)"]
    for i in range(ROUNDS):
        ranks.append(f"""r{i + 1} AS MATERIALIZED (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust,
  sum(trust_mass) AS trust_mass, sum(distrust_mass) AS distrust_mass FROM (
  SELECT w.dst AS host, {DAMPING} * w.weight / o.total * r.trust AS trust, 0.0::DOUBLE AS distrust,
         {DAMPING} * w.weight / o.total * r.trust_mass AS trust_mass, 0.0::DOUBLE AS distrust_mass
  FROM edges w JOIN outs o USING (src) JOIN r{i} r ON r.host = w.src
  UNION ALL SELECT w.src, 0.0, {DAMPING} * w.weight / n.total * r.distrust, 0.0, {DAMPING} * w.weight / n.total * r.distrust_mass
  FROM edges w JOIN ins n USING (dst) JOIN r{i} r ON r.host = w.dst
  UNION ALL SELECT * FROM seeds) GROUP BY host)""")
    return f"""
WITH RECURSIVE cut AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, html, {host.format('rest')} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
seen AS MATERIALIZED (SELECT *, {case(0)} AS rule, {case(1)} AS ruled FROM parts),
links AS (SELECT src, {host.format("substr(l, instr(l, '//') + 2)")} AS dst FROM (
  SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS l FROM seen WHERE host != '')),
hosts AS (SELECT host FROM seen WHERE host != '' UNION SELECT dst FROM links WHERE dst != ''),
chain AS (SELECT host AS child, substr(host, instr(host, '.') + 1) AS parent FROM hosts
          WHERE len(string_split(host, '.')) > 2
          UNION SELECT parent, substr(parent, instr(parent, '.') + 1) FROM chain WHERE len(string_split(parent, '.')) > 2),
edges AS MATERIALIZED (SELECT src, dst, sum(weight)::DOUBLE AS weight FROM (
  SELECT src, dst, count(*) AS weight FROM links WHERE dst != '' GROUP BY ALL
  UNION ALL SELECT child, parent, 1 FROM chain UNION ALL SELECT parent, child, 1 FROM chain)
  WHERE src != dst GROUP BY src, dst),
outs AS (SELECT src, sum(weight) AS total FROM edges GROUP BY src),
ins AS (SELECT dst, sum(weight) AS total FROM edges GROUP BY dst),
seeds AS MATERIALIZED (SELECT host, avg(CASE WHEN ruled = 'allow' THEN 1.0::DOUBLE ELSE 0 END) * {1 - DAMPING} AS trust,
  avg(CASE WHEN ruled = 'block' THEN 1.0::DOUBLE ELSE 0 END) * {1 - DAMPING} AS distrust,
  {1 - DAMPING}::DOUBLE AS trust_mass, {1 - DAMPING}::DOUBLE AS distrust_mass
  FROM seen WHERE host != '' GROUP BY host),
base AS (SELECT round(avg(CASE WHEN ruled = 'block' THEN 1.0::DOUBLE ELSE 0 END), 9) AS share FROM seen WHERE host != ''),
{", ".join(ranks)}
SELECT s.page_id, s.host, s.path, s.rule, coalesce(s.ruled,
  CASE WHEN round(round(CASE WHEN r.distrust_mass > 0 THEN r.distrust / r.distrust_mass ELSE 0 END, 9)
       - round(CASE WHEN r.trust_mass > 0 THEN r.trust / r.trust_mass ELSE 0 END, 9), 9) > (SELECT share FROM base)
       THEN 'block' ELSE 'allow' END) AS verdict
FROM seen s LEFT JOIN r{ROUNDS} r ON r.host = s.host"""


SQL = _sql()

"""URL filter: rules first, then a tree of path templates for each host.

Urls that a rule fits are the labels. The path of every url is a branch of its host's tree,
in which variable segments are generalised from the root down: digits become ``#``, and of the values below one
generalised prefix those that make up little of it each become ``*``, if they are many. A template is
rejected if its smoothed share of blocked labels is above a half. The share is taken
along any host, domain (the last two labels), host and the prefixes of the template: a branch that does not differ
statistically from the level above is merged with it, branches that differ from it to the same side are merged
with one another unless they differ from that too, and each merged branch keeps its share, smoothed towards the level above.
A host without labels is judged by the tree of its domain, or of all hosts.

All steps are DataFrame operations on different (host, path) pairs with counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stage

#: (verdict, host, path); the longest that fits wins.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Values that make up this share of their parent's paths at most are variable, if they are so many.
VALUES, SHARE = 20, 0.05
#: Weight of the level above, in labelled urls, and the bound of the test that keeps a branch apart.
PRIOR, DISTANCE = 5.0, 1.96


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct (rule, verdict); null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def templates(paths: DataFrame) -> DataFrame:
    """Adds ``template`` to rows of different ``host``, ``path``, of any depth.

    Level by level: below a prefix of fewer than ``VALUES`` different paths nothing can be variable, so a level reads
    only what larger prefixes hold.
    """
    rows = paths.select("host", "path", F.regexp_replace("path", "[0-9]+", "#").alias("shape"))
    now = rows.select("host", "shape").distinct().select("*", F.split("shape", "/", -1).alias("parts"), F.lit("").alias("prefix"))
    now, done, depth = stage(now), [], 0
    while not now.isEmpty():
        cells = now.withColumn("segment", F.expr(f"get(parts, {depth})"))
        # Values first, then their number: a hot host is counted before it is shuffled.
        values = cells.groupBy("host", "prefix", "segment").agg(F.count("*").alias("n"))
        large = values.groupBy("host", "prefix").agg(F.sum("n").alias("total")).filter(F.col("total") >= VALUES)
        rare = F.col("n") <= SHARE * F.col("total")
        large = values.filter("segment is not null").join(large, ["host", "prefix"]).groupBy("host", "prefix").agg(
            (F.count(F.when(rare, 1)) >= VALUES).alias("many"), F.collect_list(F.when(~rare, F.col("segment"))).alias("common")
        )
        general = F.when(F.col("many") & ~F.array_contains("common", F.col("segment")), "*").otherwise(F.col("segment"))
        cells = stage(cells.join(large, ["host", "prefix"], "left").withColumn("segment", F.when(F.col("many").isNotNull(), general)).drop("many", "common"))
        rest = F.expr(f"slice(parts, {depth + 1}, size(parts))")
        done.append(cells.filter("segment is null").select("host", "shape", F.concat("prefix", F.array_join(rest, "/")).alias("template")))
        last = F.size("parts") == depth + 1
        done.append(cells.filter(F.col("segment").isNotNull() & last).select("host", "shape", F.concat("prefix", "segment").alias("template")))
        now = stage(cells.filter(F.col("segment").isNotNull() & ~last).select("host", "shape", "parts", F.concat("prefix", "segment", F.lit("/")).alias("prefix")))
        depth += 1
    if not done:
        return paths.select("host", "path", F.col("path").alias("template"))
    return rows.join(reduce(DataFrame.union, done), ["host", "shape"]).select("host", "path", "template")


def _apart(b: Column, t: Column, share: Column) -> Column:
    return F.abs(b / t - share) > DISTANCE * F.sqrt(share * (1 - share) / t)


def _levels(rows: DataFrame) -> DataFrame:
    """The share of blocked labels of each (host, template), along any host, domain, host and prefixes."""
    counts = stage(
        rows.groupBy("host", "template").agg(
            F.sum(F.when(F.col("label") == "block", F.col("n")).otherwise(0)).alias("b"),
            F.sum(F.when(F.col("label").isNotNull(), F.col("n")).otherwise(0)).alias("t"),
        )
        .withColumn("domain", F.concat(F.lit("d:"), F.regexp_extract("host", r"([^.]*\.)?[^.]*$", 0)))
        .withColumn("site", F.concat(F.lit("h:"), F.col("host")))
        # The last part is the template's own: pages that lie at an inner node are a branch of it.
        .withColumn("parts", F.concat(F.split("template", "/", -1), F.array(F.lit("\0"))))
    )
    # Every node of the trees of any host, of the domains and of the hosts, with the node above it. The root's hash is that of the first part.
    above = F.expr("case when k > 1 then scope when scope = site then domain when scope = domain then '' end")
    cells = counts.filter("t > 0").select("*", F.explode(F.array(F.lit(""), F.col("domain"), F.col("site"))).alias("scope"))
    cells = cells.select("*", F.explode(F.expr("sequence(1, size(parts))")).alias("k"))
    cells = cells.select("scope", F.expr("xxhash64(slice(parts, 1, k))").alias("node"), above.alias("up"), F.expr("xxhash64(slice(parts, 1, greatest(k - 1, 1)))").alias("up_node"), "b", "t")
    nodes = stage(cells.groupBy("scope", "node", "up", "up_node").agg(F.sum("b").alias("b"), F.sum("t").alias("t")))
    parents = nodes.select(F.col("scope").alias("up"), F.col("node").alias("up_node"), (F.col("b") / F.col("t")).alias("share"))
    b, t, share = F.col("b"), F.col("t"), F.col("share")
    apart = nodes.join(parents, ["up", "up_node"]).filter(_apart(b, t, share)).withColumn("side", b / t > share)
    pools = apart.groupBy("up", "up_node", "side").agg((F.sum("b") / F.sum("t")).alias("pool"), F.sum("b").alias("pool_b"), F.sum("t").alias("pool_t"))
    own = _apart(b, t, F.col("pool"))
    apart = stage(apart.join(pools, ["up", "up_node", "side"]).select(
        "scope", "node", F.when(own, b).otherwise(F.col("pool_b")).alias("b"), F.when(own, t).otherwise(F.col("pool_t")).alias("t")
    ))
    whole = counts.agg(F.sum("b").alias("b"), F.sum("t").alias("t")).first()
    first = ((whole["b"] or 0) + 1) / ((whole["t"] or 0) + 2)

    root = F.xxhash64(F.array(F.lit("")))
    known = nodes.filter((F.col("node") == root) & (F.col("scope") != "")).select("scope")
    leaves = counts.join(known.select(F.col("scope").alias("site"), F.lit(True).alias("by_site")), "site", "left")
    leaves = leaves.join(known.select(F.col("scope").alias("domain"), F.lit(True).alias("by_domain")), "domain", "left")
    leaves = leaves.withColumn("scope", F.expr("case when by_site then site when by_domain then domain else '' end"))
    way = "concat(case when by_site then array(named_struct('k', 0, 'scope', domain, 'node', xxhash64(array('')))) else array() end, transform(sequence(1, size(parts)), k -> named_struct('k', k, 'scope', scope, 'node', xxhash64(slice(parts, 1, k)))))"
    steps = leaves.select("host", "template", F.explode(F.expr(way)).alias("w")).select("host", "template", "w.*")
    steps = steps.join(apart, ["scope", "node"], "left").groupBy("host", "template").agg(
        F.array_sort(F.collect_list(F.when(F.col("t").isNotNull(), F.struct("k", "b", "t")))).alias("steps")
    )
    smoothed = F.aggregate("steps", F.lit(float(first)), lambda acc, x: (x["b"] + PRIOR * acc) / (x["t"] + PRIOR))
    return steps.select("host", "template", smoothed.alias("purity"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """For each row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity``.

    ``rule`` is null where none fits; then ``verdict`` is the method's. Only ``page_id`` and ``url``
    are read. A null url, or one without ``://``, has empty host and path and is judged
    by its (empty) template; without any label the share is a half, which allows. Repeated rows stay.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    found = stage(rows.groupBy("host", "path").agg(F.count("*").alias("n")).withColumn("r", rule_of(F.col("host"), F.col("path"), rules)))
    named = stage(templates(found).join(found, ["host", "path"]).select("host", "path", "template", "n", "r"))
    purity = _levels(named.select("host", "template", "n", F.col("r.verdict").alias("label")))
    judged = named.join(purity, ["host", "template"]).select(
        "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", F.when(F.col("purity") > 0.5, "block").otherwise("allow")).alias("verdict"), "template", "purity",
    )
    return rows.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "template", "purity")

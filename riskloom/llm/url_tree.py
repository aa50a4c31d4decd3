"""URL filters: domain and path rules, and a path-template tree for what no rule decides.

The tree is built level by level with grouped counts, one level of path segments at
a time, over distinct (host, path) rows with their counts:

1. Segments that are variable by form (numbers, long hexadecimal strings) are ``*``.
   Under one template prefix of a host, a level whose segments are nearly all
   different (more than ``MOST_CHILDREN`` of them, each met ``LEAST_EACH`` times or
   less on average) is ``*`` as a whole.
2. Sibling branches whose labelled shares do not differ by more than ``MERGE_Z``
   standard errors from what their siblings have in common are one branch.
3. A template's purity is its share of blocked labels, smoothed by its parent's with
   ``PRIOR`` pseudo-counts, from the root over host suffixes and the host down to the
   template.  Urls of templates with purity of at least ``REJECT`` are blocked.

Labels are the urls that the rules decide.  A host with a third of all rows is
counted by map-side combined aggregates and never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.sources.scratch import materialise

DEPTH = 6
MOST_CHILDREN = 20
LEAST_EACH = 3.0
MERGE_Z = 2.0
PRIOR = 4.0
REJECT = 0.8

# Rule (host and path), verdict.
RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
_VARIABLE = r"^([0-9]+([._-][0-9]+)*(\.[A-Za-z]{1,5})?|[0-9A-Fa-f]{8,}(-[0-9A-Fa-f]{4,})*)$"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for NULL."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for NULL."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits the host or a domain above it and begins the path."""
    tested = []
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        tested.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*tested)


def _segments(path: Column, depth: int) -> Column:
    """The first ``depth`` segments of a path, variable ones as ``*``; what is deeper is one ``**``."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    typed = F.transform(parts, lambda s: F.when(s.rlike(_VARIABLE), F.lit("*")).otherwise(s))
    deep = F.when(F.size(parts) > depth, F.array(F.lit("**"))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.slice(typed, 1, depth), deep)


def templates(counted: DataFrame, depth: int = DEPTH, most_children: int = MOST_CHILDREN, least_each: float = LEAST_EACH) -> DataFrame:
    """Adds ``template`` (segments generalised) to rows of host, path, n (rows), labelled, blocked; written.

    Each level is a written table, since the next one reads it twice; levels that no
    path reaches are left out.
    """
    tree = counted.withColumn("seg", _segments(F.col("path"), depth)).withColumn("template", F.array().cast("array<string>"))
    tree = materialise(tree, "tree")
    deepest = tree.agg(F.max(F.size("seg"))).first()[0] or 0
    for level in range(1, deepest + 1):
        tree = tree.withColumn("child", F.when(F.size("seg") >= level, F.element_at("seg", F.lit(level))))
        # counts per distinct child first, then per parent: a hot parent has as many rows as children
        children = tree.filter(F.col("child").isNotNull()).groupBy("host", "template", "child").agg(F.sum("n").alias("n"))
        wide = children.filter("child <> '*'").groupBy("host", "template").agg(F.count("*").alias("kinds"), F.sum("n").alias("rows"))
        wide = wide.filter((F.col("kinds") > most_children) & (F.col("rows") <= least_each * F.col("kinds"))).select("host", "template", F.lit(True).alias("variable"))
        tree = tree.join(wide, ["host", "template"], "left")
        step = F.when(F.col("child").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.when(F.col("variable"), F.lit("*")).otherwise(F.col("child"))))
        tree = materialise(tree.withColumn("template", F.concat("template", step)).drop("variable", "child"), "tree")
    return tree.drop("seg")


def _smoothed(blocked: Column, labelled: Column, parent: Column, prior: float) -> Column:
    return (blocked + prior * parent) / (labelled + prior)


def purities(tree: DataFrame, merge_z: float = MERGE_Z, prior: float = PRIOR) -> DataFrame:
    """host, template, purity of every template of ``tree`` (host, template, n, labelled, blocked)."""
    leaves = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    leaves = materialise(leaves, "templates")
    # the chain of host suffixes: com, example.com, blog.example.com
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    hosts = leaves.groupBy("host").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    chain = hosts.select("host", "labelled", "blocked", F.posexplode(suffixes).alias("place", "suffix"))
    domains = chain.groupBy("suffix").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    whole = hosts.agg(F.coalesce(F.sum("labelled"), F.lit(0)).alias("l"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b")).first()
    root = (whole["b"] + 0.5) / (whole["l"] + 1.0)
    placed = chain.select("host", "place", "suffix").join(domains, "suffix")
    ordered = F.array_sort(F.collect_list(F.struct("place", "labelled", "blocked")))
    from_root = F.aggregate(ordered, F.lit(root), lambda above, d: _smoothed(d["blocked"], d["labelled"], above, prior))
    of_host = placed.groupBy("host").agg(from_root.alias("above"))
    level = leaves.join(of_host, "host").select("host", "template", "above")
    deepest = leaves.agg(F.max(F.size("template"))).first()[0] or 0
    for k in range(1, deepest + 1):
        nodes = leaves.filter(F.size("template") >= k).groupBy("host", F.slice("template", 1, k).alias("node"))
        nodes = nodes.agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
        siblings = W.partitionBy("host", F.slice("node", 1, k - 1)) if k > 1 else W.partitionBy("host")
        nodes = nodes.withColumn("all_labelled", F.sum("labelled").over(siblings)).withColumn("all_blocked", F.sum("blocked").over(siblings))
        common = (F.col("all_blocked") + 0.5) / (F.col("all_labelled") + 1.0)
        error = F.sqrt(common * (1 - common) / F.greatest(F.col("labelled"), F.lit(1)))
        alike = (F.col("labelled") > 0) & (F.abs(F.col("blocked") / F.greatest(F.col("labelled"), F.lit(1)) - common) <= merge_z * error)
        nodes = nodes.withColumn("alike", alike)
        # like branches are one: their labels are pooled
        pool = [F.sum(F.when(F.col("alike"), F.col(c)).otherwise(0)).over(siblings) for c in ("labelled", "blocked")]
        nodes = nodes.withColumn("pool_labelled", pool[0]).withColumn("pool_blocked", pool[1])
        own = [F.when(F.col("alike"), F.col("pool_" + c)).otherwise(F.col(c)).alias("node_" + c) for c in ("labelled", "blocked")]
        nodes = nodes.select(F.col("host").alias("node_host"), "node", *own)
        level = level.join(nodes, (F.col("host") == F.col("node_host")) & (F.slice("template", 1, k) == F.col("node")) & (F.size("template") >= k), "left")
        below = F.when(F.col("node").isNotNull(), _smoothed(F.col("node_blocked"), F.col("node_labelled"), F.col("above"), prior)).otherwise(F.col("above"))
        level = level.select("host", "template", below.alias("above"))
    return level.select("host", "template", F.col("above").alias("purity"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", depth: int = DEPTH, reject: float = REJECT) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every row of ``pages``.

    A NULL url, or one without ``://``, has an empty host and path and is judged as the
    template of those.  Repeated rows get equal verdicts; without any labelled url the
    purity is no evidence and nothing but rules blocks; an empty table
    gives an empty result.  Only the id and url columns are read.
    """
    url = F.col(url_col).cast("string")
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("hit", longest_rule(F.col("host"), F.col("path"), rules))
    blocked = (F.col("hit.verdict") == "block").cast("bigint")
    counted = parsed.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.sum(F.col("hit").isNotNull().cast("bigint")).alias("labelled"),
        F.sum(F.coalesce(blocked, F.lit(0).cast("bigint"))).alias("blocked"),
    )
    tree = templates(counted, depth)
    pure = purities(tree)
    known = tree.select("host", "path", "template").join(pure, ["host", "template"])
    judged = parsed.join(known, ["host", "path"], "left")
    labels = tree.agg(F.sum("labelled")).first()[0] or 0
    by_tree = F.when((F.col("purity") >= reject) & F.lit(labels > 0), F.lit("block")).otherwise(F.lit("allow"))
    shown = F.concat(F.lit("/"), F.array_join("template", "/"))
    return judged.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce(F.col("hit.verdict"), by_tree).alias("verdict"),
        shown.alias("template"), "purity",
    )

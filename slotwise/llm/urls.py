"""URL filter: list rules plus a path-template tree per host.

Rules (host and path prefix, longest fit wins) label part of the pages. Per
host, path segments form a tree; below a node, segments become a wildcard if
they look like values (numbers, hex strings, long slugs) or if the node has more
than ``BRANCHES`` different ones of which none dominates. Sibling branches whose
pages have compatible label counts are merged, and each resulting template is
judged by its share of blocked among labelled pages, smoothed by ``STRENGTH``
pages of its prior. The prior of a branch is what its labelled siblings say, each
counted once and smoothed by ``SIBLINGS`` of the prior of the node above (0 above
the root): beside nine blocked branches an unlabelled one is blocked, beside two
it is not. Unlabelled pages of a template at or above ``REJECT`` are blocked.

All steps are aggregations by (host, node): a host with a third of all pages is
counted map-side first. The tree is walked level by level for ``LEVELS``
segments; deeper segments stand together as one.

Defined cases: a null url, or one without ``://``, has an empty host and path,
no rule and, like an empty table's templates, no labels: allowed; repeated rows
and null ids get a row each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import checkpointed, join_null_safe, table

# Fixed by the query contract: (rule, verdict).
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
LEVELS = 6
BRANCHES = 24
DOMINANT = 0.2
REJECT = 0.8
STRENGTH = 4.0  # pseudo-pages of the prior in a template's purity
SIBLINGS = 2.0  # pseudo-branches of the node above in a node's prior
COMPATIBLE = 6.63  # chi-square limit for merging a branch into its group, 1 % level


def parsed(urls: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path``."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # (?s) and \z: a url may hold line ends
    host = F.translate(F.regexp_extract(url, r"(?s)\A(?:(?!://).)*://([^/?#]*)", 1), upper, upper.lower())
    path = F.regexp_extract(url, r"(?s)\A(?:(?!://).)*://[^/?#]*([^?#]*)", 1)
    return urls.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _shape(segment: Column) -> Column:
    """Segments that look like values, by kind; others as they are."""
    return (
        F.when(segment.rlike(r"\A[0-9]+\z"), "{n}")
        .when(segment.rlike(r"\A[0-9]+(\.[A-Za-z0-9]+)\z"), F.concat(F.lit("{n}"), F.regexp_extract(segment, r"(\.[A-Za-z0-9]+)\z", 1)))
        .when(segment.rlike(r"\A[0-9a-fA-F-]{16,}\z"), "{x}")
        .when((F.length(segment) > 40) | segment.rlike(r"([-_].*){5,}"), "{s}")
        .otherwise(segment)
    )


def _template_counts(shapes: DataFrame) -> DataFrame:
    """``host, raw, block, allow, n``: pages per host and shaped path."""
    label = lambda v: F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0))
    return shapes.groupBy("host", "raw", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("host", "raw").agg(
        label("block").alias("block"), label("allow").alias("allow"), F.sum("n").alias("n")
    )


def priors(paths: DataFrame) -> DataFrame:
    """``host, template, prior`` of the rows ``host, raw, template, block, allow``.

    The branches of a node are its paths' next segments, merged or not; each is
    judged once by its labelled pages. The prior of a template comes down the
    nodes of its path; a node with one branch says nothing of its own.
    """
    nodes = paths.select("host", "raw", "template", "block", "allow", F.explode(F.sequence(F.lit(0), F.size("template"))).alias("d"))
    below = nodes.filter(F.col("d") < F.size("template")).groupBy("host", F.slice("template", F.lit(1), F.col("d")).alias("node"), F.get("raw", F.col("d")).alias("seg"))
    branch = below.agg(F.sum("block").alias("b"), F.sum("allow").alias("a"))
    share = F.when(F.col("b") + F.col("a") > 0, F.col("b") / (F.col("b") + F.col("a")))
    said = branch.groupBy("host", "node").agg(F.sum(share).alias("s"), F.count(share).alias("c"), F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
    nodes = nodes.select("host", "template", "d").distinct()
    path = nodes.filter((F.col("d") < F.size("template")) | (F.size("template") == 0)).select(
        "host", "template", "d", F.slice("template", F.lit(1), F.col("d")).alias("node")
    )
    path = join_null_safe(path, said, ["host", "node"], "left").groupBy("host", "template").agg(
        F.array_sort(F.collect_list(F.struct("d", F.coalesce("s", F.lit(0.0)).alias("s"), F.coalesce("c", F.lit(0)).alias("c")))).alias("p")
    )
    down = F.aggregate("p", F.lit(0.0), lambda prior, n: (n["s"] + SIBLINGS * prior) / (n["c"] + SIBLINGS))
    return path.select("host", "template", down.alias("prior"))


def path_templates(pages: DataFrame, levels: int = LEVELS, branches: int = BRANCHES) -> DataFrame:
    """``host, raw, template, block, allow, n, purity`` from ``host, raw, label``.

    ``raw``: array of shaped segments; ``label``: block, allow or null. Counts
    and purity are of the template after merging.
    """
    t = checkpointed(_template_counts(pages).withColumn("template", F.array().cast("array<string>")))
    deepest = t.agg(F.max(F.size("raw"))).first()[0] or 0
    for k in range(min(levels, deepest)):
        # One row per (host, template so far, segment): pre-aggregated before it is counted by node.
        seg = F.get("raw", F.lit(k))
        seg = F.when(seg.isNull(), F.lit("")).otherwise(seg) if k < levels - 1 else F.when(F.size("raw") > k, F.lit("**")).otherwise(F.lit(""))
        t = t.withColumn("seg", seg)
        node = t.groupBy("host", "template", "seg").agg(F.sum("n").alias("m"), F.sum("block").alias("b"), F.sum("allow").alias("a"))
        total = node.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("k"), F.sum("m").alias("sum_m"), F.max("m").alias("max_m")
        )
        wide = (F.col("k") > branches) & (F.col("max_m") < DOMINANT * F.col("sum_m"))
        node = join_null_safe(node, total, ["host", "template"])
        node = node.withColumn("name", F.when(wide & (F.col("seg") != ""), "*").otherwise(F.col("seg")))
        # Siblings with the same majority label are candidates for one branch; a
        # branch joins if its counts are compatible with those of all candidates.
        major = F.when(F.col("b") > F.greatest("a", F.col("m") - F.col("a") - F.col("b")), "block").when(
            F.col("a") > F.col("m") - F.col("a") - F.col("b"), "allow"
        ).otherwise("none")
        named = node.groupBy("host", "template", "name").agg(F.sum("m").alias("m"), F.sum("b").alias("b"), F.sum("a").alias("a")).withColumn("major", major)
        pool = named.filter("name <> ''").groupBy("host", "template", "major").agg(
            F.sum("m").alias("pm"), F.sum("b").alias("pb"), F.sum("a").alias("pa"), F.count(F.lit(1)).alias("pk")
        )
        named = join_null_safe(named, pool, ["host", "template", "major"], "left")
        chi = F.lit(0.0)
        for own, all_ in (("b", "pb"), ("a", "pa")):
            p = F.col(all_) / F.col("pm")
            expected = F.col("m") * p
            chi = chi + F.when((p > 0) & (p < 1), (F.col(own) - expected) ** 2 / (expected * (1 - p))).otherwise(F.lit(0.0))
        joins = (F.col("name") != "") & (F.col("pk") > 1) & (chi <= COMPATIBLE)
        named = named.select(
            "host", "template", "name", F.when(F.col("name") == "", "").when(joins, F.concat(F.lit("~"), "major")).otherwise(F.col("name")).alias("branch")
        )
        node = join_null_safe(node.select("host", "template", "seg", "name"), named, ["host", "template", "name"])
        t = join_null_safe(t, node.select("host", "template", "seg", "branch"), ["host", "template", "seg"])
        t = t.withColumn("template", F.when(F.col("branch") == "", F.col("template")).otherwise(F.array_append("template", F.col("branch")))).drop("seg", "branch")
        t = checkpointed(t)  # the next level reads it twice
    total = t.groupBy("host", "template").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.sum("n").alias("n"))
    total = join_null_safe(total, priors(t), ["host", "template"])
    total = total.withColumn("purity", (F.col("block") + STRENGTH * F.col("prior")) / (F.col("block") + F.col("allow") + STRENGTH)).drop("prior")
    return join_null_safe(t.select("host", "raw", "template"), total, ["host", "template"])


def judge_urls(urls: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, reject: float = REJECT) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` per input row."""
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in r])
    p = parsed(urls, id_col, url_col).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    p = p.withColumn("label", F.when(F.col("rule").isNotNull(), F.element_at(verdicts, F.col("rule"))))
    p = p.withColumn("raw", F.transform(F.filter(F.split("path", "/"), lambda x: x != ""), _shape))
    t = path_templates(p.select("host", "raw", "label"))
    p = join_null_safe(p, t.select("host", "raw", "template", "purity"), ["host", "raw"])
    method = F.when(F.col("purity") >= reject, "block").otherwise("allow")
    return p.select("page_id", "host", "path", "rule", F.coalesce("label", method).alias("verdict"), F.array_join("template", "/").alias("template"), "purity")


def op10_path_templates(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))

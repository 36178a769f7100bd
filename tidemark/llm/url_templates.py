"""URL filtering by a path-template tree, in built-in expressions only.

Every URL is cut into host and path. Explicit rules decide first. The rest is
judged by templates learned per host:

1. **shapes**: in each path segment, long hexadecimal and digit runs become
   classes; URLs with the same host and shape are counted together, so the tree
   is built from counts;
2. **tree**, level by level: rare children of a node are a variable segment and
   become the wildcard ``*``. Frequent children with the same most common
   continuation form a cluster; those that do not differ statistically from the
   cluster merge into its wildcard ``*(continuation)``, the others stay literal
   branches. Next segments are compared always, by total variation against a
   tolerance plus the child's sampling noise; labels only where the child has
   any: its purity must be near its cluster's. Each child is compared with
   its cluster, never with single siblings, so the work is linear;
3. **rejection**: a template is rejected if its purity is high enough. Labels are
   the verdicts of the rules (and any that the caller adds); a template without
   labels is allowed.

The *purity* is the smoothed share of block among the labelled URLs; to the smoothing
each unlabelled URL adds one at the prior, so a branch without labels takes the
verdict of its siblings where most of them are labelled, and one labelled
branch among many without does not decide for the others.

Defined results: a null URL, or one without ``://``, has empty host and path and
is a row like any other; repeated rows are counted and returned each; segments
beyond ``depth`` are one segment; a page without verdict by rule or template is
allowed; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TreeSettings:
    depth: int = 6  # levels of the tree
    support: int = 5  # URLs that a literal branch has at least
    apart: float = 0.2  # difference of purity from which a labelled branch is unlike its cluster
    tolerance: float = 0.1  # total variation that still counts as similar, beside noise
    noise: float = 0.5  # times sqrt(number of kinds of continuation / URLs)
    prior: float = 0.5  # share of block that a template without labels is taken to have
    strength: float = 4.0  # labelled URLs that the prior counts as
    reject: float = 0.8  # purity from which a template is rejected


def purity(block: Column, labelled: Column, none: Column, s: TreeSettings) -> Column:
    """Share of block, smoothed by ``strength`` URLs and all unlabelled ones at the prior."""
    return (block + F.lit(s.prior) * (none + F.lit(s.strength))) / (labelled + none + F.lit(s.strength))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is asked first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, F.lit(rule.name)).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _shape(path: Column, depth: int) -> Column:
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    shaped = F.transform(segments, lambda s: F.regexp_replace(F.regexp_replace(s, r"[0-9a-f]{12,}", "<hex>"), r"[0-9]+", "<n>"))
    deep = F.array(F.array_join(F.slice(shaped, depth, F.greatest(F.size(shaped), F.lit(1))), "/"))
    return F.when(F.size(shaped) <= depth, shaped).otherwise(F.concat(F.slice(shaped, 1, depth - 1), deep))


def _grow(shapes: DataFrame, level: int, s: TreeSettings) -> DataFrame:
    """``shapes`` with one more segment of the template: a literal or a wildcard."""
    here = shapes.where(F.size("shape") > level)
    # Continuations of each child: next segment ("" at the end of the path).
    following = F.coalesce(F.get("shape", F.lit(level + 1)), F.lit(""))
    labelled = F.col("block") + F.col("allow")
    events = (
        here.select("host", "template", F.col("shape")[level].alias("child"), following.alias("next"), "block", labelled.alias("labelled"), "none")
        .groupBy("host", "template", "child", "next")
        .agg(F.sum(F.col("labelled") + F.col("none")).alias("n"), *(F.sum(c).alias(c) for c in ("block", "labelled", "none")))
    )
    children = (
        events.groupBy("host", "template", "child")
        .agg(
            F.sum("n").alias("n_child"), F.count(F.lit(1)).alias("kinds"), F.max(F.struct("n", "next"))["next"].alias("cluster"),
            *(F.sum(c).alias(f"child_{c}") for c in ("block", "labelled", "none")),
        )
        .where(F.col("n_child") >= s.support)
    )
    frequent = events.drop("block", "labelled", "none").join(children, ["host", "template", "child"])
    clusters = children.groupBy("host", "template", "cluster").agg(
        F.count(F.lit(1)).alias("members"),
        F.sum("n_child").alias("n_cluster"),
        purity(F.sum("child_block"), F.sum("child_labelled"), F.sum("child_none"), s).alias("cluster_purity"),
    )
    pools = frequent.groupBy("host", "template", "cluster", "next").agg(F.sum("n").alias("n_pool"))
    # Total variation: the sum of what the child has more of than its cluster.
    excess = F.greatest(F.col("n") / F.col("n_child") - F.col("n_pool") / F.col("n_cluster"), F.lit(0.0))
    own = purity(F.col("child_block"), F.col("child_labelled"), F.col("child_none"), s)
    other_labels = (F.col("child_labelled") > 0) & (F.abs(own - F.col("cluster_purity")) > s.apart)
    unlike = F.col("distance") > s.tolerance + s.noise * F.sqrt(F.col("kinds") / F.col("n_child"))
    alone = (F.col("members") == 1) | unlike | other_labels
    wildcard = F.concat(F.lit("*("), "cluster", F.lit(")"))
    of_child = ("n_child", "kinds", "members", "child_block", "child_labelled", "child_none", "cluster_purity")
    branches = (
        frequent.join(pools, ["host", "template", "cluster", "next"])
        .join(clusters, ["host", "template", "cluster"])
        .groupBy("host", "template", "child", "cluster", *of_child)
        .agg(F.sum(excess).alias("distance"))
        .select("host", "template", "child", F.when(alone, F.col("child")).otherwise(wildcard).alias("branch"))
    )
    grown = shapes.withColumn("child", F.get("shape", F.lit(level))).join(branches, ["host", "template", "child"], "left")
    segment = F.when(F.col("child").isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.coalesce("branch", F.lit("*"))))
    return grown.select("host", "shape", "block", "allow", "none", F.concat("template", segment).alias("template"))


def template_table(urls: DataFrame, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """(host, shape, template, rejected, ...) from rows of (host, shape, label); label is block, allow or null."""

    def count(cond):
        return F.count(F.when(cond, 1))

    label = F.col("label")
    shapes = materialize(
        urls.groupBy("host", "shape").agg(
            count(label == "block").alias("block"), count(label == "allow").alias("allow"), count(label.isNull()).alias("none")
        ).withColumn("template", F.lit("")),
        "url-shapes",
    )
    deepest = shapes.agg(F.max(F.size("shape"))).first()[0] or 0
    for level in range(min(deepest, settings.depth)):
        shapes = materialize(_grow(shapes, level, settings), f"url-tree-{level}")
    block, labelled = F.sum("block"), F.sum(F.col("block") + F.col("allow"))
    templates = shapes.groupBy("host", "template").agg(
        purity(block, labelled, F.sum("none"), settings).alias("purity"), labelled.alias("labelled")
    )
    rejected = (F.col("labelled") > 0) & (F.col("purity") >= settings.reject)
    templates = materialize(templates.withColumn("rejected", rejected), "url-templates")
    return shapes.join(templates, ["host", "template"])


def filter_urls(pages: DataFrame, rules: tuple[UrlRule, ...], settings: TreeSettings = TreeSettings(), label: str | None = None) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict.

    ``label`` names a column with further labels (block, allow or null); a
    rule's verdict goes before it.
    """
    host, path = url_parts(F.col("url").cast("string"))
    extra = F.col(label) if label else F.lit(None).cast("string")
    cut = pages.select("page_id", host.alias("host"), path.alias("path"), extra.alias("label"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    known, shape = F.coalesce(verdict, "label").alias("label"), _shape(F.col("path"), settings.depth).alias("shape")
    urls = cut.select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"), known, shape)
    judged = template_table(urls.select("host", "shape", "label"), settings)
    rejected = materialize(judged.where("rejected").select("host", "shape", "rejected"), "url-rejected")
    judged = urls.join(rejected, ["host", "shape"], "left")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("rejected"), F.lit("block")), F.lit("allow")).alias("verdict")
    )

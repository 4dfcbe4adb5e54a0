"""URL filters: explicit host/path rules, and a path-template tree per host.

The tree generalises variable path segments into wildcards, merges subtrees
whose label rates do not differ significantly from the branch above them, and
rejects templates whose branch has too low a smoothed labelled purity.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, read, salted, spread, stored

WILD = "{*}"


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("com", "/en/", "block"),
    UrlRule("example.com", "/en/7", "allow"),
    UrlRule("net", "/de/", "allow"),
    UrlRule("example.net", "/de/8", "block"),
    UrlRule("org", "/es/", "block"),
)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def first_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last that fits wins
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def _shape(segment: Column) -> Column:
    """Segments that are variable by their form alone: runs of digits, long hex runs."""
    return F.regexp_replace(F.regexp_replace(segment, r"[0-9a-f]{16,}", "{x}"), r"[0-9]+", "{n}")


def templates(pages: DataFrame, max_children: int = 50, least_share: float = 0.02) -> DataFrame:
    """Distinct (host, raw) with their template, from pages (host, path).

    ``raw`` is the path by segment form.  Going down the tree, the children with
    less than ``least_share`` of their node's pages each become one wildcard
    where there are more than ``max_children`` of them, whatever the number of
    pages.  The descent ends where no node has more than ``max_children`` paths
    below it, as no wildcard can follow there: a path of any depth costs no
    steps of its own.
    """
    counted = pages.groupBy("host", "raw").agg(F.count(F.lit(1)).alias("n"))
    nodes = counted.withColumn("seg", F.expr("slice(split(raw, '/', -1), 2, greatest(size(split(raw, '/', -1)) - 1, 0))")).withColumn("template", F.lit(""))
    deepest = nodes.agg(F.max(F.size("seg"))).first()[0] or 0
    for d in range(deepest):
        below = nodes.filter(F.size("seg") > d)
        if below.groupBy("host", "template").agg(F.count(F.lit(1)).alias("paths")).filter(F.col("paths") > max_children).isEmpty():
            rest = F.slice("seg", F.lit(d + 1), F.greatest(F.size("seg") - d, F.lit(0)))
            nodes = nodes.withColumn("template", F.concat("template", F.when(F.size("seg") > d, F.concat(F.lit("/"), F.array_join(rest, "/"))).otherwise("")))
            break
        here = F.get("seg", F.lit(d))
        children = below.groupBy("host", "template", here.alias("child")).agg(F.sum("n").alias("n"))
        whole = children.groupBy("host", "template").agg(F.sum("n").alias("whole"), F.count(F.lit(1)).alias("width")).filter(F.col("width") > max_children).drop("width")
        rare = salted(children, F.col("child")).join(spread(whole), ["host", "template", "_salt"]).filter(F.col("n") < least_share * F.col("whole")).drop("_salt", "whole")
        wide = rare.groupBy("host", "template").agg(F.count(F.lit(1)).alias("width")).filter(F.col("width") > max_children)
        wide = rare.join(wide, ["host", "template"], "left_semi").select("host", "template", "child", F.lit(True).alias("wild"))
        step = F.when(F.size("seg") <= d, F.col("template")).otherwise(F.concat("template", F.lit("/"), F.when(F.col("wild"), WILD).otherwise(F.col("child"))))
        nodes = salted(nodes.withColumn("child", here), F.xxhash64("raw"))
        nodes = stored(nodes.join(spread(wide), ["host", "template", "child", "_salt"], "left").select("host", "raw", "n", "seg", step.alias("template")), "templates")
    return nodes.select("host", "raw", "template")


def _path(host: Column, template: Column) -> Column:
    """Hashes of the nodes from the host down to a template, which say the same for the same way down."""
    return F.aggregate(F.split(template, "/", -1), F.array(F.xxhash64(host)), lambda nodes, seg: F.array_append(nodes, F.xxhash64(F.element_at(nodes, -1), seg)))


def branches(leaf: DataFrame, z: float) -> DataFrame:
    """leaf (host, template, seen, good) with the node whose branch a template belongs to.

    Going down, a node stays in the branch above it while its share of good
    pages lies within ``z`` standard errors of that branch's, else it opens its
    own; nodes without labelled pages stay.  So whole subtrees are merged, at
    any depth.  Only a template's own nodes meet in one group.
    """
    leaf = stored(leaf.withColumn("path", _path(F.col("host"), F.col("template"))), "url-leaves")
    counts = leaf.filter("seen > 0").select(F.explode("path").alias("node"), "seen", "good").groupBy("node").agg(F.sum("seen").alias("n_seen"), F.sum("good").alias("n_good"))
    steps = salted(leaf.select("host", "template", F.posexplode("path").alias("depth", "node")), F.xxhash64("template"))
    met = steps.join(spread(counts), ["node", "_salt"])
    way = met.groupBy("host", "template").agg(F.array_sort(F.collect_list(F.struct("depth", "node", "n_seen", "n_good"))).alias("way"))

    def merged(branch: Column, node: Column) -> Column:
        share = branch["n_good"] / branch["n_seen"]
        error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-6)) / node["n_seen"])
        return F.when(F.abs(node["n_good"] / node["n_seen"] - share) > z * error, node).otherwise(branch)

    last = F.aggregate(F.slice("way", F.lit(2), F.greatest(F.size("way") - 1, F.lit(0))), F.get("way", F.lit(0)), merged)
    out = leaf.join(way.select("host", "template", last["node"].alias("branch")), ["host", "template"], "left")
    return out.select("host", "template", "seen", "good", F.coalesce("branch", F.get("path", F.lit(0))).alias("branch"))


def rejected_templates(pages: DataFrame, labels: DataFrame, prior: float = 8.0, least_purity: float = 0.5, z: float = 1.96) -> DataFrame:
    """host, raw of the paths whose template is rejected.

    pages: page_id, host, raw.  labels: page_id, good (0 or 1); of conflicting
    ones the smaller counts.  A branch, as ``branches`` merges them, is rejected
    where (good + prior * overall share) / (labelled + prior) < ``least_purity``.
    A branch without labelled pages has the overall share.
    """
    marked = pages.join(labels.groupBy("page_id").agg(F.min("good").alias("good")), "page_id")
    by_raw = stored(marked.groupBy("host", "raw").agg(F.count(F.lit(1)).alias("seen"), F.sum("good").cast("double").alias("good")), "url-labels")
    tree = templates(pages)
    whole = by_raw.agg((F.sum("good") / F.sum("seen")).alias("share")).first()["share"]
    if whole is None:
        return tree.select("host", "raw").limit(0)
    joined = tree.join(by_raw, ["host", "raw"], "left").fillna({"seen": 0, "good": 0.0})
    leaf = stored(branches(joined.groupBy("host", "template").agg(F.sum("seen").alias("seen"), F.sum("good").alias("good")), z), "url-branches")
    pooled = leaf.groupBy("branch").agg(F.sum("seen").alias("n_seen"), F.sum("good").alias("n_good"))
    bad = pooled.filter((F.col("n_good") + prior * whole) / (F.col("n_seen") + prior) < least_purity).select("branch")
    bad = salted(leaf.select("host", "template", "branch"), F.xxhash64("template")).join(spread(bad), ["branch", "_salt"], "left_semi").select("host", "template")
    return salted(tree, F.xxhash64("raw")).join(spread(bad), ["host", "template", "_salt"], "left_semi").select("host", "raw")


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    pages needs page_id and url; labels page_id and good.  A null url or one
    without ``://`` has empty host and path, fits no rule and is judged like
    any other template (of the empty host).  Null page ids are judged but carry
    no label; rows repeating a page id are each judged.  Without labels nothing
    but the rules blocks.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, verdict = first_rule(F.col("host"), F.col("path"), rules)
    rows = stored(rows.select("page_id", "host", "path", _shape(F.col("path")).alias("raw"), name.alias("rule"), verdict.alias("said")), "urls")
    bad = rejected_templates(rows.select("page_id", "host", "raw"), labels).withColumn("bad", F.lit(True))
    judged = salted(rows, F.xxhash64("path", "page_id")).join(spread(bad), ["host", "raw", "_salt"], "left")
    own = F.when(F.col("bad"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("said", own).alias("verdict"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: a page whose path names a labelled document has that document's quality."""
    pages, labels = read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels")
    named = pages.select("page_id", F.expr(r"try_cast(nullif(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1), '') as bigint)").alias("doc_id"))
    quality = labels.groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    marked = named.join(quality, "doc_id").select("page_id", "good")
    return filter_urls(pages, marked)

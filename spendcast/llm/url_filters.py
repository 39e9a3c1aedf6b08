"""URL filters: explicit rules, then a tree of path templates per host.

Variable segments become wildcards: those with digits, and the children of a node
when they are many and hardly repeat.  Children of one node whose shares of good
labels do not differ significantly merge into one branch.  Each branch's purity is
smoothed towards its parent's, up to the host's and the overall share; a template
is rejected when the purity at its end is too low.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import pin

#: (verdict, host and path); a rule fits its host and all subdomains.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: A node's children are variable when they have at least so many values, and on
#: average at most so many urls to a value.
VARIABLE_VALUES = 50
VARIABLE_REPEATS = 2.0
#: Siblings whose difference is below this many standard errors merge, and those
#: whose shares agree when rounded to this part.
MERGE_Z = 2.58
SHARES = 64
#: Weight of the prior in labelled urls, and the purity below which to block.
PRIOR = 20.0
LEAST_PURITY = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules=None) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(RULES if rules is None else rules, key=lambda r: len(r[1])):
        h, p = text[:text.index("/")], text[text.index("/"):]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _templates(pages: DataFrame) -> DataFrame:
    """Adds ``t``, the segments of the template, to pages with host and path."""
    parts = F.transform(F.split("path", "/", -1), lambda s: F.regexp_replace(s, r"^[^.]*[0-9][^.]*", "*"))
    p = pages.withColumn("parts", parts)
    paths = pin(p.groupBy("host", "parts").agg(F.count(F.lit(1)).alias("n")))
    # no node below this depth has children enough
    deep = (paths.groupBy("host", F.size("parts").alias("depth")).agg(F.count(F.lit(1)).alias("k"))
            .withColumn("k", F.sum("k").over(W.partitionBy("host").orderBy(F.desc("depth")))))
    deepest = deep.where(F.col("k") >= VARIABLE_VALUES).agg(F.max("depth")).first()[0] or 0
    t = paths.withColumn("t", F.col("parts"))
    for at in range(deepest):
        t = (t.withColumn("parent", F.slice("t", 1, at)).withColumn("here", F.size("t") > at)
             .withColumn("leaf", F.size("t") == at + 1))
        values = t.where("here").groupBy("host", "parent", "leaf", F.col("t")[at].alias("value")).agg(F.sum("n").alias("n"))
        wild = (values.groupBy("host", "parent", "leaf").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
                .where((F.col("k") >= VARIABLE_VALUES) & (F.col("n") <= VARIABLE_REPEATS * F.col("k")))
                .select("host", "parent", "leaf", F.lit(True).alias("wild")))
        named = F.transform("t", lambda s, i: F.when(i == at, F.lit("*")).otherwise(s))
        t = pin(t.join(wild, ["host", "parent", "leaf"], "left").select(
            "host", "parts", "n", F.when(F.col("wild") & F.col("here"), named).otherwise(F.col("t")).alias("t")))
    return p.join(t.drop("n"), ["host", "parts"]).drop("parts")


def _nodes(templates: DataFrame, *more: str) -> DataFrame:
    """A row for every node on the way to a template; its end is a node of its own
    beside those that go on."""
    d = templates.select("host", "t", *more, F.explode(F.sequence(F.lit(1), F.size("t"))).alias("level"))
    return d.withColumn("leaf", F.col("level") == F.size("t")).withColumn("node", F.expr("slice(t, 1, level)"))


def _merge(shares: Column) -> Column:
    """Groups of neighbouring shares (bucket, n, g; ascending) that do not differ."""
    def step(groups, x):
        y = F.get(groups, F.size(groups) - 1)
        n = x["n"] + y["n"]
        pooled = (x["g"] + y["g"]) / n
        error = F.sqrt(pooled * (1 - pooled) * (1 / x["n"] + 1 / y["n"]))
        group = lambda first, n, g: F.array(F.struct(
            first.alias("first"), x["bucket"].alias("last"), n.alias("n"), g.alias("g")))
        alike = F.abs(x["g"] / x["n"] - y["g"] / y["n"]) <= MERGE_Z * error
        return F.when(alike, F.concat(F.slice(groups, 1, F.size(groups) - 1), group(y["first"], n, x["g"] + y["g"]))).otherwise(
            F.concat(groups, group(x["bucket"], x["n"], x["g"])))
    return F.aggregate(shares, F.array().cast("array<struct<first:int,last:int,n:double,g:double>>"), step)


def _branches(leaves: DataFrame) -> DataFrame:
    """Labelled nodes with the counts of their branch, n_b and g_b, and of all
    labelled urls under their parent, n_p."""
    nodes = pin(_nodes(leaves, "n", "g").groupBy("host", "level", "leaf", "node").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
                .withColumn("parent", F.expr("slice(node, 1, level - 1)"))
                .withColumn("bucket", F.round(F.col("g") / F.col("n") * SHARES).cast("int")))
    shares = nodes.groupBy("host", "parent", "bucket").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    groups = shares.groupBy("host", "parent").agg(  # at most SHARES + 1 to a parent
        F.sum("n").alias("n_p"), F.sort_array(F.collect_list(F.struct("bucket", "n", "g"))).alias("shares"))
    own = F.filter("groups", lambda x: (x["first"] <= F.col("bucket")) & (F.col("bucket") <= x["last"]))[0]
    return (nodes.join(groups.select("host", "parent", "n_p", _merge(F.col("shares")).alias("groups")), ["host", "parent"])
            .withColumn("own", own).select("host", "level", "leaf", "node", F.col("own.n").alias("n_b"), F.col("own.g").alias("g_b"), "n_p"))


def judge(pages: DataFrame, labels: DataFrame, rules=None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, purity.

    ``labels``: (page_id, good 0/1) of some pages.  A null url or one without
    ``://`` has empty host and path, fits no rule and is judged with its like;
    hosts without labels take the overall share; with no labels at all everything
    is allowed.  Repeated rows are judged alike; an empty table gives an empty
    result."""
    host, path = host_of(F.col("url").cast("string")), path_of(F.col("url").cast("string"))
    base = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = labels.where("good is not null").groupBy("page_id").agg(F.max("good").cast("double").alias("good"))
    tree = pin(_templates(base).join(known, "page_id", "left"))
    seen = tree.where("good is not null")
    leaves = pin(seen.groupBy("host", "t").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("good").alias("g")))
    of_host = pin(leaves.groupBy("host").agg(F.sum("n").alias("n_h"), F.sum("g").alias("g_h")))
    overall = of_host.agg((F.sum("g_h") / F.sum("n_h")).alias("p")).first()[0]
    prior = F.lit(1.0 if overall is None else overall)
    towards = lambda g, n, p: (F.coalesce(g, F.lit(0.0)) + PRIOR * p) / (F.coalesce(n, F.lit(0.0)) + PRIOR)
    # a branch that holds all labels of its parent tells nothing new
    way = (_nodes(tree.select("host", "t").distinct()).join(_branches(leaves).where("n_b < n_p"), ["host", "level", "leaf", "node"])
           .groupBy("host", "t").agg(F.sort_array(F.collect_list(F.struct("level", "n_b", "g_b"))).alias("way")))
    d = tree.join(way, ["host", "t"], "left").join(of_host, "host", "left")
    host_purity = towards(F.col("g_h"), F.col("n_h"), prior)
    purity = F.aggregate(F.coalesce("way", F.array().cast("array<struct<level:int,n_b:double,g_b:double>>")), host_purity,
                         lambda p, x: towards(x["g_b"], x["n_b"], p))
    d = d.withColumn("purity", purity)
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") < LEAST_PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return d.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, method).alias("verdict"),
                    F.concat("host", F.array_join("t", "/")).alias("template"), "purity")

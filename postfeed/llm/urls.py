"""URL filters by a path-template tree.

Paths are generalised, so that variable segments become wildcards, and summed by host. From each host down, branches
with too few pages or labels become one, and branches whose labelled shares do not differ are merged with one
another, whatever their siblings are like. What is left are templates such as /fr/*.html. A template is rejected
if its labelled purity, smoothed towards the share of all pages, is below that share beyond doubt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postfeed.llm.common import settled, written
from postfeed.operators.keyed import keyed_join

# Pages and labels a segment needs to be a branch of its own, and how many standard errors the labelled
# shares of two branches have to differ.
MIN_PAGES, MIN_LABELS, DIFFERENT = 20, 10, 2.6

# Branches of a node whose labelled shares lie in the same step are summed first, which bounds what a node has to compare.
STEPS = 64

# Labels' worth of the overall share that is added to each template, and how many standard errors its purity
# has to be below that share.
PRIOR_LABELS, DOUBT = 10.0, 1.645

# Host and path of each rule, and its verdict.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))

# The step of all branches of a node that have too few pages or labels.
_FEW = -1

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AFTER = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ? or #, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, _AFTER, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty without ://."""
    return F.coalesce(F.regexp_extract(url, _AFTER, 2), F.lit(""))


def rule_column(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does.

    A rule fits its host and all subdomains, where the path starts with the rule's.
    """
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, said in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def generalised(path: Column) -> Column:
    """The path with long segments, and runs of digits and what is between them, as one mark each; ( is escaped."""
    short = F.regexp_replace(F.regexp_replace(path, "[^/]{41,}", "*"), "[0-9]+", "*")
    return F.regexp_replace(F.regexp_replace(short, r"\*(?:[A-Za-z_-]{0,8}\*)+", "*"), r"\(", "%28")


def _sums(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def groups_of_branches(branches: DataFrame) -> DataFrame:
    """The groups of each node (host, node): arrays of steps, labels, good and count of branches, by labelled share.

    ``branches`` has host, node, step, labels and good. In order of share a step joins the group before it unless
    the two differ. What has too few pages or labels is a step too, if together it has enough labels. A node that
    has too few labels for two groups, or labels of one kind only, has none.
    """
    steps = branches.groupBy("host", "node", "step").agg(F.count(F.lit(1)).alias("count"), *_sums("labels", "good"))
    entry = F.struct((F.col("good") / F.col("labels")).alias("share"), "step", "labels", "good", "count")
    enough = F.when(F.col("labels") >= MIN_LABELS, entry)
    nodes = steps.groupBy("host", "node").agg(F.sort_array(F.collect_list(enough)).alias("entries"), *_sums("labels", "good"))
    nodes = nodes.where((F.col("labels") >= 2 * MIN_LABELS) & (F.col("good") > 0) & (F.col("good") < F.col("labels")))
    share = "(c.good + e.good) / (c.labels + e.labels)"
    error = f"sqrt(greatest({share} * (1 - {share}), 1e-6D) * (1 / c.labels + 1 / e.labels))"
    groups = f"""aggregate(
        entries, cast(array() AS array<struct<steps: array<bigint>, labels: bigint, good: bigint, count: bigint>>),
        (groups, e) -> if(
            exists(slice(groups, -1, least(size(groups), 1)), c -> abs(c.good / c.labels - e.good / e.labels) <= {DIFFERENT}D * {error}),
            transform(groups, (c, i) -> if(
                i < size(groups) - 1, c,
                struct(concat(c.steps, array(e.step)) AS steps, c.labels + e.labels AS labels, c.good + e.good AS good, c.count + e.count AS count)
            )),
            concat(groups, array(struct(array(e.step) AS steps, e.labels AS labels, e.good AS good, e.count AS count)))
        ))"""
    return nodes.select("host", "node", F.expr(groups).alias("groups"))


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (host, form, n, labels, good), one row each, with ``template``.

    One level of the tree at a time, over the paths whose node can still be divided; all others are finished and not
    read again. A branch goes by its segment, a group of several by its number in order of share, all
    branches together by *, and those with too few labels by (other). What is below a node that cannot be divided
    is one template that ends in **. There are as many levels as the deepest node with labels of both kinds has.
    """
    spark = paths.sparkSession
    segments = F.when(F.col("form") == "", F.array().cast("array<string>")).otherwise(F.split(F.expr("substring(form, 2)"), "/"))
    rows = written(paths.withColumns({"segments": segments, "node": F.lit(""), "open": F.col("form") != ""}), "paths")
    levels, depth = [rows], 0
    while not rows.where("open").isEmpty():
        step = rows.where("open").withColumn("segment", F.get("segments", F.lit(depth)))
        branches = step.groupBy("host", "node", "segment").agg(*_sums("n", "labels", "good"))
        own = (F.col("n") >= MIN_PAGES) & (F.col("labels") >= MIN_LABELS)
        place = F.floor(STEPS * F.col("good") / F.col("labels"))
        branches = written(branches.withColumn("step", F.when(own, place).otherwise(F.lit(_FEW).cast("bigint"))), "branches")
        told = branches.join(groups_of_branches(branches), ["host", "node"])
        told = told.withColumn("at", F.expr("get(filter(sequence(1, size(groups)), i -> array_contains(groups[i - 1].steps, step)), 0)"))
        single = (F.col("step") != _FEW) & (F.expr("groups[at - 1].count") == 1)
        name = F.when(F.col("at").isNull(), "(other)").when(single, F.col("segment")).when(F.size("groups") == 1, "*")
        names = told.select("host", "node", "segment", name.otherwise(F.format_string("(%d)", "at")).alias("name"))
        grown = step.join(names, ["host", "node", "segment"], "left")
        node = F.concat("node", F.lit("/"), F.coalesce("name", F.lit("**")))
        more = F.col("name").isNotNull() & (F.size("segments") > depth + 1)
        rows = grown.select("host", "form", "n", "labels", "good", F.when(more, F.col("segments")).alias("segments"), node.alias("node"), more.alias("open"))
        rows, depth = written(rows, "paths"), depth + 1
        levels.append(rows)
    done = levels[0].where("NOT open")
    for level in levels[1:]:
        done = done.unionByName(level.where("NOT open"))
    return done.select("host", "form", "n", "labels", "good", F.col("node").alias("template"))


def judged(paths: DataFrame) -> DataFrame:
    """``paths`` with template, its ``purity`` and whether it is ``rejected``."""
    placed = templates(paths)
    labels, good = paths.agg(F.sum("labels"), F.sum("good")).first()
    overall = good / labels if labels else 1.0
    sums = placed.groupBy("host", "template").agg(*_sums("labels", "good"))
    weight = F.col("labels") + PRIOR_LABELS
    sums = sums.withColumn("purity", (F.col("good") + PRIOR_LABELS * overall) / weight)
    error = F.sqrt(F.greatest(F.col("purity") * (1 - F.col("purity")), F.lit(0.0)) / weight)
    sums = sums.select("host", "template", "purity", (F.col("purity") + DOUBT * error < overall).alias("rejected"))
    return placed.select("host", "form", "template").join(sums, ["host", "template"])


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, template, purity.

    ``labels`` has url and label (1 good, 0 bad); a null label is none, and of labels of one url that contradict each
    other the good one counts; an empty url has none. A rule's verdict goes before the method's. A url that is null or has no :// has
    an empty host and path, and its template is judged like any other. Without labels every purity is 1 and
    nothing is rejected. Repeated urls count as often as they are there. Null and repeated ids are rows like any
    other; other columns are not looked at; very long paths are read whole; an empty table gives an empty result.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("__url"))
    known = labels.where("url IS NOT NULL AND label IS NOT NULL").groupBy(F.col("url").alias("__url")).agg(F.max(F.col("label").cast("int")).alias("label"))
    rows = keyed_join(rows, known, "__url", "left", spread="page_id")
    rows = rows.select("page_id", host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"), "label")
    rows = written(rows.withColumn("form", generalised(F.col("path"))), "pages")
    good = F.coalesce(F.sum("label"), F.lit(0)).alias("good")
    paths = rows.groupBy("host", "form").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("labels"), good)
    told = settled(pages.sparkSession, "templates", lambda: judged(written(paths, "sums")))
    # Neither a host nor an empty form has a slash before the form's first, so the two together are a key.
    key = F.concat(F.lit("-"), "host", "form").alias("__path")
    told = told.select(key, "template", "purity", "rejected")
    out = keyed_join(rows.select("page_id", "host", "path", key), told, "__path", "left", spread="page_id")
    rule, said = rule_column(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("rejected"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(said, method).alias("verdict"), "template", "purity")

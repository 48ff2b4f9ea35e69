"""URL filters: path templates per host, judged by smoothed labelled purity, behind fixed rules.

Paths are walked from the root. At every node of a host's tree (the host and the template so
far) the distinct next segments are counted. Where they are many for the node's pages, the
segment is variable and becomes ``*``. Of the remaining branches, those whose labelled share of
bad pages does not differ significantly from the rest of the node's become one branch, ``+``;
the others keep their name. The walk goes on, level after level, until every page's path has ended
or is the only one left at its node, which then keeps the rest of it by name. A template's share of bad labelled pages is smoothed towards its host's, and that towards the share among
all labelled pages; a template above ``BLOCK_FROM`` is blocked.

Rules come first: a rule names a host and the beginning of a path, fits the host and all its
subdomains, and the longest that fits decides.

Everything is DataFrame operations. Nulls and edges: a null url, or one without ``://``, has an
empty host and path, fits no rule and is judged with its like; repeated rows are judged alike;
a url without a label counts for the tree, not for shares. Column names must not begin with
``_url``.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import attach_groups, table, work_table

#: Verdict, host, beginning of the path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: A segment is variable if a node has so many different ones, and so many for its pages.
VARIABLE_FROM, VARIABLE_SHARE = 8, 0.2
#: Standard errors by which a branch must differ to stay apart.
APART = 2.58
#: Pages' worth of prior belief, and the smoothed share of bad pages that blocks a template.
PRIOR, BLOCK_FROM = 10.0, 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host: Column, path: Column, rules: Sequence = RULES) -> tuple[Column, Column]:
    """The rule that decides, as host and path in one string, and its verdict; null if none fits."""
    name = verdict = None
    for says, at, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(begin)
        name = F.when(fits, F.lit(at + begin)).otherwise(F.lit(None) if name is None else name)
        verdict = F.when(fits, F.lit(says)).otherwise(F.lit(None) if verdict is None else verdict)
    return name, verdict


def _smoothed(bad: Column, labelled: Column, towards: Column) -> Column:
    return (bad + PRIOR * towards) / (labelled + PRIOR)


def with_templates(pages: DataFrame, *, host: str = "host", path: str = "path", bad: str = "bad") -> DataFrame:
    """Adds ``template``. ``bad`` is 1 or 0 where a page has a label, else null."""
    n_rows = pages.count()
    rows = (pages.withColumn("_url_segments", F.filter(F.split(path, "/"), lambda s: s != ""))
            .withColumn("template", F.lit("")))
    level, finished = 0, []
    while True:
        left = F.slice("_url_segments", level + 1, F.greatest(F.size("_url_segments") - level, F.lit(0)))
        rows = rows.withColumn("_url_next", F.coalesce(F.get("_url_segments", F.lit(level)), F.lit(""))).withColumn(
            "_url_rest", F.concat_ws("/", left))
        node, child = [host, "template"], [host, "template", "_url_next"]
        children = (rows.groupBy(*child).agg(
            F.count(F.lit(1)).alias("_n"), F.count(bad).alias("_url_labelled"),
            F.coalesce(F.sum(bad), F.lit(0)).alias("_url_bad"),
            F.min(F.xxhash64("_url_rest")).alias("_url_least"), F.max(F.xxhash64("_url_rest")).alias("_url_most")))
        children = work_table(children, "url_branches")
        nodes = children.groupBy(*node).agg(
            F.count(F.lit(1)).alias("_n"), F.sum("_n").alias("_url_pages"),
            F.sum("_url_labelled").alias("_url_all_labelled"), F.sum("_url_bad").alias("_url_all_bad"),
            (F.min("_url_least") == F.max("_url_most")).alias("_url_alone"))
        known = attach_groups(children.withColumnRenamed("_n", "_url_n"), nodes.withColumn(
            "_url_children", F.col("_n")), node, n_rows)
        variable = ((F.col("_url_children") >= VARIABLE_FROM)
                    & (F.col("_url_children") >= VARIABLE_SHARE * F.col("_url_pages")))
        own, rest = F.col("_url_labelled"), F.col("_url_all_labelled") - F.col("_url_labelled")
        pooled = F.col("_url_all_bad") / F.col("_url_all_labelled")
        gap = F.abs(F.col("_url_bad") / own - (F.col("_url_all_bad") - F.col("_url_bad")) / rest)
        error = F.sqrt(pooled * (1 - pooled) * (1 / own + 1 / rest))
        apart = (own > 0) & (rest > 0) & (gap > APART * error)
        branch = (F.when(F.col("_url_next") == "", "").when(variable, "/*")
                  .when(F.col("_url_children") == 1, F.concat(F.lit("/"), F.col("_url_next")))
                  .when(apart, F.concat(F.lit("/"), F.col("_url_next"))).otherwise("/+"))
        branches = known.select(*child, branch.alias("_url_branch"), "_url_alone", F.col("_url_n").alias("_n"))
        ended = F.col("_url_next") == ""
        step = F.when(~ended & F.col("_url_alone"), F.concat(F.lit("/"), "_url_rest")).otherwise(F.col("_url_branch"))
        walked = work_table(attach_groups(rows, branches, child, n_rows).withColumn(
            "template", F.concat("template", step)).withColumn("_url_done", ended | F.col("_url_alone")).drop(
            "_url_next", "_url_branch", "_url_rest", "_url_alone"), "url_walk")
        finished.append(walked.filter("_url_done").drop("_url_done", "_url_segments"))
        rows = walked.filter("not _url_done").drop("_url_done")
        n_rows, level = rows.count(), level + 1
        if not n_rows:
            break
    return reduce(DataFrame.unionByName, finished)


def filter_urls(pages: DataFrame, *, url_col: str = "url", bad: str = "bad", rules: Sequence = RULES) -> DataFrame:
    """The pages with ``host, path, rule, verdict, template, bad_share``."""
    host, path = host_and_path(F.col(url_col))
    parts = pages.withColumn("host", host).withColumn("path", path)
    rows = work_table(with_templates(parts, bad=bad), "url_templates")
    by = ["host", "template"]
    found = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.count(bad).alias("_url_labelled"),
                                  F.coalesce(F.sum(bad), F.lit(0)).alias("_url_bad"))
    hosts = found.groupBy("host").agg(F.sum("_url_labelled").alias("_url_host_labelled"),
                                      F.sum("_url_bad").alias("_url_host_bad"), F.count(F.lit(1)).alias("_url_n"))
    labelled, total_bad = rows.agg(F.count(bad), F.coalesce(F.sum(bad), F.lit(0))).first()
    overall = F.lit(total_bad / labelled if labelled else 0.0)
    n_rows = rows.count()
    judged = attach_groups(found, hosts, ["host"], n_rows, size="_url_n").withColumn(
        "bad_share", _smoothed(F.col("_url_bad"), F.col("_url_labelled"), _smoothed(
            F.col("_url_host_bad"), F.col("_url_host_labelled"), overall)))
    rows = attach_groups(rows, judged.select(*by, "_n", "bad_share"), by, n_rows)
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_share") > BLOCK_FROM, "block").otherwise("allow")
    return (rows.withColumn("rule", name).withColumn("verdict", F.coalesce(verdict, method)))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages with ``bad`` from the label of the document that the last number of the path names."""
    name = F.regexp_extract(host_and_path(F.col("url"))[1], r"([0-9]{1,18})[^0-9/]*/?$", 1)
    worst = labels.groupBy("doc_id").agg(F.max(
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    numbered = pages.withColumn("_url_doc", F.when(name != "", name.cast("long")))
    # Pages without a number would all meet in one task.
    with_label = numbered.filter("_url_doc is not null").join(
        worst.withColumnRenamed("doc_id", "_url_doc"), "_url_doc", "left")
    return (with_label.select(*pages.columns, "bad").unionByName(
        numbered.filter("_url_doc is null").select(*pages.columns, F.lit(None).cast("int").alias("bad"))))


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    pages = labelled_pages(table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels"))
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "template")

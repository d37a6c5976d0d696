"""URL filter by a path-template tree, in DataFrame functions only.

URLs are counted by host and path first, digits folded to ``#``, so a hot host is a few rows. The tree of each host is
then walked level by level: under a node with many rare segments, those are generalised into one wildcard; the other
branches are merged and judged together. But a branch, rare or not, whose labelled share of bad pages differs from its
parent's by a two-proportion test stands alone. A template is rejected if its smoothed share of bad labelled
pages is above a limit. Explicit rules come first: the longest one that fits decides.

Labels of pages are those of the labels table under the page's own number; no other table says anything of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Rules of the query: host and path, verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
LEVELS = 4
#: A node with more than this many different segments that each hold no more than this share of its pages has a wildcard for them.
DISTINCT, SHARE = 12, 0.05
#: Sibling branches differ at this many standard errors.
ERRORS = 2.0
#: Weight of the whole table's share of bad pages in a template's, in pages; and the limit.
SMOOTH, LIMIT = 20.0, 0.5
#: Templates of more than one page in HOT are at most HOT; they are sent to where the pages are.
HOT = 10_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path then up to ``?``, ``#`` or the end.
    Both are empty for a null URL or one without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of the longest rule that fits (rule, verdict), or null. A rule fits its host and all subdomains, if the path
    starts with the rule's; of equally long ones the last in order wins."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for text, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _template(path: Column) -> Column:
    return F.regexp_replace(path, "[0-9]+", "#")


def judge_templates(counts: DataFrame) -> DataFrame:
    """host, template and rejected of rows (host, template, n, labelled, bad): the tree's verdicts."""
    steps = F.split(F.regexp_replace("template", r"\A/", ""), "/")
    # levels past LEVELS are one segment
    rows = counts.withColumn("steps", F.when(F.size(steps) > LEVELS, F.concat(F.slice(steps, 1, LEVELS - 1), F.array(F.array_join(F.slice(steps, LEVELS, F.size(steps)), "/")))).otherwise(steps))
    rows = rows.withColumn("node", F.lit(""))
    rows = stage(rows, "templates")
    for level in range(LEVELS):
        # a template that has ended goes on as itself
        rows = rows.withColumn("step", F.when(F.size("steps") > level, F.element_at("steps", level + 1)).otherwise(F.lit(None)))
        segments = rows.where("step is not null").groupBy("host", "node", "step").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        whole = segments.groupBy("host", "node").agg(F.sum("n").alias("all_n"), F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"))
        rare = F.col("n") <= SHARE * F.col("all_n")
        varied = segments.join(whole, ["host", "node"]).where(rare).groupBy("host", "node").agg((F.count("*") > DISTINCT).alias("varied"))
        parents = whole.join(varied, ["host", "node"], "left")
        share = F.col("all_bad") / F.nullif("all_labelled", F.lit(0))
        labelled = F.nullif("labelled", F.lit(0))
        alike = F.abs(F.col("bad") / labelled - share) <= ERRORS * F.sqrt(share * (1 - share) / labelled)
        folded = F.when(rare & F.coalesce("varied", F.lit(False)), F.lit("*")).otherwise(F.lit("~"))
        # without labels a branch is alike
        name = F.when(F.coalesce(alike, F.lit(True)), folded).otherwise(F.col("step"))
        chosen = segments.join(parents, ["host", "node"]).select("host", "node", "step", name.alias("name"))
        rows = rows.join(chosen, ["host", "node", "step"], "left").withColumn("node", F.when(F.col("step").isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), F.coalesce("name", F.lit("*"))))).drop("name", "step")
        rows = stage(rows, "templates")  # small: one row for each host and template; without it each level would double the plan
    overall = rows.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("labelled"), F.lit(0)), F.lit(0.0))).first()[0]
    merged = rows.groupBy("host", "node").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    purity = (F.col("bad") + SMOOTH * F.lit(overall)) / (F.col("labelled") + SMOOTH)
    verdicts = merged.select("host", "node", (purity > LIMIT).alias("rejected"))
    return rows.join(verdicts, ["host", "node"]).select("host", "template", "n", "node", "rejected")


def filter_urls(pages: DataFrame, labels: DataFrame, *, page_col: str = "page_id", url_col: str = "url", label_id_col: str = "doc_id", rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and template of every page.

    A page is labelled bad if its label row says low quality or toxic. Templates are judged by the labels of pages that no
    rule decides; a rule sets its own pages' verdict only.
    Pages without host belong to one tree of their own. Without labelled pages nothing is rejected but by rules. Null
    ids are kept; repeated rows count as often as they come; repeated labels of one id count once, bad if any is.
    An empty table gives no rows. Only the named columns are read.
    """
    host, path = host_and_path(F.col(f"`{url_col}`"))
    rows = pages.select(F.col(f"`{page_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("template", _template(F.col("path")))
    known = labels.groupBy(F.col(f"`{label_id_col}`").alias("_id")).agg(F.max(((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).cast("int")).alias("label"))
    judged = rows.join(known, rows["page_id"] == known["_id"], "left").withColumn("bad", F.when(F.col("fit").isNull(), F.col("label")))
    counts = judged.groupBy("host", "template").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    verdicts = stage(judge_templates(counts), "verdicts")
    many = F.col("n") > (verdicts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] / HOT)
    hot, key = F.broadcast(verdicts.where(many).drop("n")), ["host", "template"]
    out = rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(verdicts.where(~many).drop("n"), key))
    own = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"), F.col("node").alias("tree_node"))

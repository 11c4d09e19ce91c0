"""URL filters: rules, and per host a tree of path templates judged by labelled purity.

A path's segments are the levels of its host's tree. Numbers and hexadecimal ids are generalised
by their form, other segments of a node by their counts: one that holds little of a node with many
branches becomes a wildcard. Sibling branches with the same rest of the template and similar
shares of labelled urls are merged. A template is rejected if the smoothed share of bad urls among
its labelled ones is high.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import join_counted, materialize

WILDCARD = "*"
MERGED = "+"
# a node with more branches than this keeps those with at least KEPT_SHARE of its urls
BRANCHES = 8
KEPT_SHARE = 0.05
# branches differ if a share is this many standard errors from that of their siblings
ERRORS = 2.0
# smoothed purity: STRENGTH labelled urls are added, half of them bad
STRENGTH = 4.0
REJECT = 0.7
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"))
# a host with one of these words, between dots and hyphens, is labelled bad
BAD_WORDS = ("bets", "casino", "pills", "porn", "spam", "viagra")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def fitting_rule(rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, action) of the longest rule that fits columns host and path, else NULL.

    Of equally long rules the one listed first wins.
    """
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        at, _, start = rule.partition("/")
        fits = ((F.col("host") == at) | F.endswith("host", F.lit("." + at))) & F.startswith(
            "path", F.lit("/" + start))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def by_words(words: Sequence[str] = BAD_WORDS) -> Column:
    """Label of column host: true if it has one of the words, else NULL."""
    parts = F.split("host", "[.-]")
    return F.when(F.arrays_overlap(parts, F.array(*map(F.lit, words))), True)


def segments(path_column: Column) -> Column:
    """The path's segments with numbers as <n> and hexadecimal ids as <x>."""
    general = F.regexp_replace(F.regexp_replace(
        path_column, "(?i)(?<![0-9a-z])(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{8,}(?![0-9a-z])", "<x>"),
        "[0-9]+", "<n>")
    return F.split(F.regexp_replace(general, "^/", ""), "/")


_COUNTS = ("n", "bad", "good")


def _sums(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(*(F.sum(c).alias(c) for c in _COUNTS))


def _set(level: int, value: Column) -> Column:
    """The template with another segment at a level (from 1)."""
    return F.concat(F.slice("template", 1, level - 1), F.array(value),
                    F.slice("template", F.lit(level + 1), F.size("template")))


def _generalise(tree: DataFrame, level: int) -> DataFrame:
    """Wildcards for the small branches of nodes with many, at one level."""
    has = tree.filter(F.size("template") >= level).withColumns({
        "prefix": F.slice("template", 1, level - 1), "segment": F.col("template")[level - 1]})
    child = has.groupBy("host", "prefix", "segment").agg(F.sum("n").alias("held"))
    node = child.groupBy("host", "prefix").agg(F.sum("held").alias("all"), F.count("*").alias("k"))
    small = (child.join(node.filter(F.col("k") > BRANCHES), ["host", "prefix"])
             .filter(F.col("held") < KEPT_SHARE * F.col("all"))
             .select("host", "prefix", "segment", F.lit(True).alias("small")))
    changed = (has.join(small, ["host", "prefix", "segment"], "left")
               .withColumn("template", F.when(F.col("small"), _set(level, F.lit(WILDCARD)))
                           .otherwise(F.col("template"))))
    return materialize(changed.select(*tree.columns).unionByName(
        tree.filter(F.size("template") < level)))


def _merge(tree: DataFrame, level: int) -> DataFrame:
    """Siblings that differ at one level only and have similar shares of labels become one.

    Those with shares in the same quarters form a family; a member whose shares still differ from
    the rest of its family by more than chance stays apart.
    """
    has = tree.filter(F.size("template") >= level)
    shares = _sums(has, "host", "template")
    quarter = F.concat(*(F.floor(4 * F.col(c) / F.col("n")).cast("string") for c in ("bad", "good")))
    family = _set(level, F.concat(F.lit(MERGED), F.when(quarter != "00", quarter).otherwise("")))
    member = shares.withColumn("family", family)
    whole = _sums(member, "host", "family").toDF("host", "family", *(f"{c}_all" for c in _COUNTS))

    def similar(c: str) -> Column:
        rest_n = F.col("n_all") - F.col("n")
        rest = F.col(f"{c}_all") - F.col(c)
        share = (F.col(f"{c}_all") + 1) / (F.col("n_all") + 2)
        error = F.sqrt(share * (1 - share) * (1 / F.col("n") + 1 / rest_n))
        return F.abs(F.col(c) / F.col("n") - rest / rest_n) <= ERRORS * error

    alike = (member.join(whole, ["host", "family"])
             .filter(F.col("n_all") > F.col("n")).filter(similar("bad") & similar("good"))
             .select("host", "template", F.col("family").alias("merged")))
    changed = (has.join(alike, ["host", "template"], "left")
               .withColumn("template", F.coalesce("merged", "template")))
    return materialize(changed.select(*tree.columns).unionByName(
        tree.filter(F.size("template") < level)))


def build_templates(urls: DataFrame) -> DataFrame:
    """host, form, n, template, purity, rejected: what each host's forms of paths belong to.

    `urls` has host, form (segments) and bad: true, false, or NULL if not labelled. They are
    counted per form first; all later steps work on these counts, host by host, and are written
    to the shared folder level by level.
    """
    tree = materialize(urls.groupBy("host", "form").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("bad"),
        F.count(F.when(~F.col("bad"), 1)).alias("good")).withColumn("template", F.col("form")))
    depth = tree.agg(F.max(F.size("form"))).first()[0] or 0
    for level in range(1, depth + 1):
        tree = _generalise(tree, level)
    for level in range(depth, 0, -1):
        tree = _merge(tree, level)
    purity = (F.col("bad") + STRENGTH / 2) / (F.col("bad") + F.col("good") + STRENGTH)
    judged = _sums(tree, "host", "template").select("host", "template", purity.alias("purity"))
    return tree.select("host", "form", "n", "template").join(judged, ["host", "template"]).select(
        "host", "form", "n", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
        "purity", (F.col("purity") >= REJECT).alias("rejected"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
          label: Column | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity: one row per page row.

    Urls that a rule covers are labelled by it, others by `label` (of host and path: true for
    bad, false for good, NULL for unknown; by default BAD_WORDS). The verdict is the rule's or,
    without one, block if the url's template is rejected. NULL urls and such without :// have an
    empty host and path, which make a host of their own. Repeated rows each count and get their
    row, as do NULL ids. No rows give no rows. Columns other than page_id and url are not read.
    """
    parsed = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    by_rule = parsed.withColumn("__rule", fitting_rule(rules))
    bad = F.coalesce(F.col("__rule.action") == "block", by_words() if label is None else label)
    urls = materialize(by_rule.select("page_id", "host", "path", F.col("__rule.rule").alias("rule"),
                                      F.col("__rule.action").alias("action"), bad.alias("bad"),
                                      segments(F.col("path")).alias("form")))
    templates = materialize(build_templates(urls))
    verdict = F.coalesce("action", F.when(F.col("rejected"), "block").otherwise("allow"))
    return join_counted(urls, templates, ["host", "form"], "n").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")

"""URL filtering by association rules.

A url's items are its scheme, top-level domain, registered domain, whole host, first host label, first path segment,
form of its last segment, query keys and fragment: nine at most, so a page supports at most 512 combinations.
FP-growth mines the combinations that labelled pages share (a page is labelled by the row of ``labels`` with its id:
bad when its quality is 0 or it is toxic). Rules "combination -> bad" below the support, confidence or lift limits are
dropped, and so are rules that a shorter rule with the same or a higher confidence makes needless. What is left is at
most 512 / support rules. Matching uses an inverted index: a rule is filed under the rarest of its items, and a url is
tested only against the rules filed under its own items.

A fixed host and path rule, the longest that fits, comes before the mined rules. A null url, or one without ://, has
an empty host and path and is allowed unless a mined rule says otherwise (it has no items, so none does). Repeated
rows are judged alike; without labels there are no mined rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import table
from tidemark.session import settle

#: Fixed values: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

SUPPORT = 0.002  # share of the labelled pages
LEAST_PAGES = 20  # and so many of them at least
CONFIDENCE = 0.5
LIFT = 1.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with host and path."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    return df.withColumns({"host": F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER),
                           "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def fixed_rule(rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest fixed rule that fits host and path; null where none fits."""
    text = verdict = F.lit(None).cast("string")
    for said, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text, verdict = F.when(fits, F.lit(host + path)).otherwise(text), F.when(fits, F.lit(said)).otherwise(verdict)
    return text, verdict


def items(url: str = "url") -> Column:
    """The distinct items of a url; none for null or without ://."""
    labels = F.split("host", r"\.")
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    keys = F.array_sort(F.transform(F.regexp_extract_all(url, F.lit(r"[?&]([^=&#?]+)"), 1), F.lower))
    last = F.get(segments, F.size(segments) - 1)

    def item(kind: str, value: Column, there: Column) -> Column:
        return F.when(there & (value != ""), F.concat(F.lit(kind + ":"), value))

    known = F.col("host") != ""
    found = [
        item("scheme", F.lower(F.substring_index(url, "://", 1)), known),
        item("tld", F.element_at(labels, -1), known),
        item("domain", F.substring_index("host", ".", -2), known & (F.size(labels) > 1)),
        item("host", F.col("host"), known),
        item("label", F.get(labels, F.lit(0)), known & (F.size(labels) > 2)),
        item("path", F.get(segments, F.lit(0)), known & (F.size(segments) > 1)),
        item("last", F.regexp_replace(last, "[0-9]+", "#"), known & (F.size(segments) > 0)),
        item("query", F.array_join(keys, ","), known),
        item("fragment", F.lit("yes"), known & F.instr(F.col(url), "#").cast("boolean")),
    ]
    return F.array_distinct(F.array_compact(F.array(*found)))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT,
         least: int = LEAST_PAGES) -> DataFrame:
    """Rules (rule_items, confidence, lift, support) from rows of (items, bad)."""
    labelled = settle(labelled, "url-labels")
    support = min(1.0, max(support, least / max(1, labelled.count())))
    bad = F.lit("=bad")
    rows = labelled.select(F.when(F.col("bad"), F.array_append("items", bad)).otherwise(F.col("items")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(rows)
    rules = settle(model.associationRules.where((F.col("consequent")[0] == bad) & (F.col("lift") >= lift)).select(
        F.array_sort("antecedent").alias("rule_items"), "confidence", "lift", "support"), "url-rules")
    # A rule is needless when leaving items out gives a rule at least as sure: look its subsets up by key, as each
    # combination of at most nine items has at most 512 of them.
    subsets = rules.select("rule_items", "confidence", F.explode(reduce(
        lambda got, i: F.concat(got, F.transform(F.filter(got, lambda _: F.size("rule_items") > i),
                                                 lambda s: F.concat(s, F.slice("rule_items", i + 1, 1)))),
        range(9), F.array(F.array().cast("array<string>")))).alias("shorter"))
    shorter = rules.select(F.col("rule_items").alias("shorter"), F.col("confidence").alias("surer"))
    needless = subsets.where(F.size("shorter") < F.size("rule_items")).join(shorter, "shorter").where(
        F.col("surer") >= F.col("confidence")).select("rule_items").distinct()
    return rules.join(needless, "rule_items", "left_anti")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url with the best confidence of the rules that it matches, from rows of distinct (url, items)."""
    ranked = rules.withColumn("rule_id", F.xxhash64("rule_items")).select("*", F.explode("rule_items").alias("item"))
    spread = urls.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("pages"))
    index = ranked.join(spread, "item").groupBy("rule_items", "confidence").agg(
        F.min_by("item", F.struct("pages", "item")).alias("item"))
    hits = urls.withColumn("item", F.explode("items")).join(index, "item").where(
        F.size(F.array_except("rule_items", "items")) == 0)
    return hits.groupBy("url").agg(F.max("confidence").alias("confidence"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    pages = parts(table(spark, sf_dir, "pages").select("page_id", "url"))
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad"))
    labels = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
    with_items = pages.withColumn("items", items())
    rules = mine(with_items.join(labels, "page_id").select("items", "bad"))
    urls = with_items.where(F.col("url").isNotNull()).groupBy("url").agg(F.first("items").alias("items"))
    mined = matched(urls, rules)
    rule, said = fixed_rule()
    return pages.join(mined, "url", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(said, F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "confidence")

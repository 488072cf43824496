"""Quality by a hashed n-gram log-likelihood ratio between trusted documents and the whole corpus.

Tokens are the last three code points of words, which keeps the vocabulary of an open corpus small. Single tokens and
pairs are hashed into ``BUCKETS`` cells; the counts of the trusted documents (``labels`` with quality 1) and of all
documents give two smoothed multinomials. A document's score is the mean log ratio of its n-grams. It is kept when
the base rules pass and its score is at least ``THRESHOLD``. Everything is column expressions.

The words of null or empty texts are none: such a document fails the base rules and has score 0. Without labels every
ratio is 0 and only the base rules decide. Repeated rows count and are judged row by row; more columns are ignored.
Windows are compared by 64-bit hashes within one document.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import table

BUCKETS = 1 << 14
SMOOTHING = 1.0
THRESHOLD = -0.5
BROADCAST_BYTES = 64 << 20  # trusted ids are broadcast up to this size, joined by shuffle beyond it

_SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words_: Column) -> Column:
    """Words in three-word windows that occur twice or more."""
    return bind(words_, _repeat_words)  # bound, as a filter would else split the text anew for every window


def _repeat_words(w: Column) -> Column:
    windows = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>"))

    def again(s: Column) -> Column:
        return F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))

    starts = F.sort_array(F.transform(bind(F.sort_array(windows), again), lambda x: x["i"]))
    return F.aggregate(
        starts, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct((i + 3).alias("end"), (a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n")),
        lambda a: a["n"])


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, text, w (words) and the base columns."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    shown = docs.select("*", words(F.col("text")).alias("w"))
    shown = shown.withColumns({
        "n_words": F.size("w").cast("long"),
        "word_chars": F.length(F.regexp_replace(text, _SPACE, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(F.col("w"))})
    return shown.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def ngram_buckets(w: Column, buckets: int = BUCKETS) -> Column:
    """Cells of the single tokens and the pairs of words ``w``."""
    def cells(t: Column) -> Column:
        return F.concat(
            F.transform(t, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int")),
            F.transform(t, lambda x, i: F.pmod(F.xxhash64(x, F.get(t, i + 1), F.lit(2)), F.lit(buckets)).cast("int")))

    return bind(F.transform(w, lambda x: F.substring(x, -3, 3)), cells)


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """The log ratio of each cell: ``buckets`` numbers, from all documents and all trusted ids."""
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("target", F.lit(1))
    if ids.count() * 16 <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    cells = docs.select("doc_id", "text").join(ids, "doc_id", "left").select(
        "target", F.explode(ngram_buckets(words(F.col("text")), buckets)).alias("cell"))
    counts = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("raw"), F.count("target").alias("target")).collect()
    raw, target = [0] * buckets, [0] * buckets
    for row in counts:
        raw[row["cell"]], target[row["cell"]] = row["raw"], row["target"]
    if not sum(target):
        return [0.0] * buckets
    rest = math.log(sum(raw) + SMOOTHING * buckets) - math.log(sum(target) + SMOOTHING * buckets)
    return [math.log((t + SMOOTHING) / (r + SMOOTHING)) + rest for t, r in zip(target, raw)]


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with w, the base columns, score and kept."""
    ratios = F.from_json(F.lit(json.dumps([round(x, 9) for x in log_ratios(docs, trusted, buckets)])), "array<double>")
    cells = ngram_buckets(F.col("w"), buckets)
    total = bind(cells, lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + F.get(ratios, x)) / F.size(c))
    return base_rules(docs).withColumn("score", F.round(F.coalesce(F.when(F.size("w") > 0, total), F.lit(0.0)), 6)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op1_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base columns, score and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, trusted_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")

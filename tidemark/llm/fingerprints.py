"""Document fingerprints by consistent weighted sampling.

A term is a pair of neighbouring words (the first word also follows an empty one); its weight is how often it occurs.
A fingerprint has ``BINS`` samples, and every term competes in every sample: for a term with weight w, r and c are
Gamma(2, 1) and b is uniform, all taken from the hash of the term and the number of the sample. t = floor(ln w / r + b)
with rank ln c - r (t - b + 1); the sample keeps the term and t of the smallest rank. Two texts agree in a sample with
the probability of their generalised Jaccard similarity, so the share of agreeing samples estimates it.

``drawn`` makes the draws of a table with columns only, and the query takes its rows from there. Three independent
exponentials a, d and h give the same r, c and b: c = a + d, g = ln(c / a), r = g + h, b = h / r (a Gamma(2, 1) is the sum
of two exponentials, and the share of one in it is uniform and independent of the sum). Then exp(rank) is a * exp(-r t),
and a itself for weight 1. As it is at least (1 - exp(-a)) * exp(-h) / w, most draws are left out before any logarithm.
Ranks are compared as 1 - exp(-exp(rank)), which is a hash as it stands for weight 1. ``signature`` is the same method with
numpy and hashes of its own, for a column by itself, ``CHUNK`` terms at a time. Terms are 64-bit hashes of word pairs.

A null or empty text has no terms and an empty fingerprint; two empty fingerprints are alike with 1, an empty and a
filled one with 0. The next document is the next row by doc_id (null first, repeated ids in the order of their
texts); a single document is its own next.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import mix, table, window_hashes, word_hashes, word_spans

BINS = 64
LIKELY = 40.0  # exp(rank) of a sample is exponential with the sum of weights: above this over the sum with 4e-18
PARTS = 4  # ranges of ids for each shuffle partition, so the samples of a range are grouped in memory
CHUNK = 1024  # terms whose draws are held at a time

_LOW, _HALF = np.uint64(0xFFFFFFFF), np.uint64(32)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def weighted_terms(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct word pairs of UTF-8 bytes by hash, in order, and how often each occurs."""
    found = word_hashes(raw, *word_spans(raw))
    return np.unique(window_hashes(np.concatenate((np.zeros(1, np.uint64), found)), 2), return_counts=True)


def _uniforms(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In (0, 1), from both halves of a hash."""
    u, v = (bits >> _HALF).astype(np.float64), (bits & _LOW).astype(np.float64)
    for x in (u, v):
        x += 0.5
        x *= 2.0 ** -32
    return u, v


def _least(terms: np.ndarray, weights: np.ndarray, salts: np.ndarray, limit: float) -> tuple[np.ndarray, ...]:
    """Rank, term and t of the smallest rank of every salt, among the ranks that can lie below ln ``limit``.

    With r = -ln q and c = -ln p, exp(rank) is at least (1 - p) q / w: only draws with less than ``limit`` there need logs.
    """
    rows = np.arange(len(salts))
    best, chosen, step = np.full(len(salts), np.inf), np.zeros(len(salts), np.uint64), np.zeros(len(salts), np.int64)
    for at in range(0, len(terms), CHUNK):
        h, w = terms[at:at + CHUNK], weights[at:at + CHUNK].astype(np.float64)
        first = mix(h ^ salts[:, None])
        second = mix(first + _STEP)
        q, v = _uniforms(first)
        q *= v
        p, v = _uniforms(second)
        p *= v
        np.subtract(1.0, p, out=v)
        v *= q
        v /= w
        k = np.flatnonzero(v < limit)
        r, c, b = -np.log(q.ravel()[k]), -np.log(p.ravel()[k]), _uniforms(mix(second.ravel()[k] + _STEP))[0]
        t = np.floor(np.log(w)[k % len(h)] / r + b)
        rank, steps = np.full(v.shape, np.inf), np.zeros(v.shape)
        rank.ravel()[k], steps.ravel()[k] = np.log(c) - r * (t - b + 1), t
        least = rank.argmin(axis=1)
        lower = rank[rows, least] < best
        best = np.where(lower, rank[rows, least], best)
        chosen, step = np.where(lower, h[least], chosen), np.where(lower, steps[rows, least].astype(np.int64), step)
    return best, chosen, step


def samples(terms: np.ndarray, weights: np.ndarray, bins: int = BINS) -> np.ndarray:
    """For every sample its number * 2**32 + 32 bits of the term and t of the smallest rank; none without terms."""
    if not len(terms):
        return np.zeros(0, dtype=np.int64)
    rows, salts = np.arange(bins), mix(np.arange(1, bins + 1, dtype=np.uint64) * _STEP)
    limit = 8.0 / weights.sum()  # exp(rank) of a sample is exponential with the sum of weights: above this in 1 of 3,000
    best, chosen, step = _least(terms, weights, salts, limit)
    above = np.flatnonzero(~(best < np.log(limit)))
    if len(above):
        best[above], chosen[above], step[above] = _least(terms, weights, salts[above], np.inf)
    return (rows << 32) + (mix(chosen + step.astype(np.uint64) * _STEP) & _LOW).astype(np.int64)


def _signatures(texts: pa.Array, bins: int) -> pa.Array:
    found = [samples(*weighted_terms((x or "").encode()), bins) for x in texts.to_pylist()]
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *found]), pa.int64()))


def signature(text: Column, bins: int = BINS) -> Column:
    """The samples of a text, by number: none where it has no words."""
    return F.arrow_udf(lambda texts: _signatures(texts, bins), "array<bigint>")(text)


def _uniform(bits: Column) -> Column:
    """In (0, 1), from the upper 52 bits of a hash."""
    return (F.shiftrightunsigned(bits, 12) + 0.5) * 2.0 ** -52


def term_runs(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, total (the sum of weights), term and weight of each distinct word pair of ``text``; a null term without words."""
    space = F.lit(" \t\n\x0b\f\r")
    bare = F.trim("text", space)
    words = F.when(F.length(bare) > 0, F.split(bare, r"[\x20\x09-\x0D]+"))
    pairs = F.sort_array(F.transform("words", lambda x, i: F.xxhash64(F.get("words", i - 1), x)))
    starts = F.array_compact(F.transform("pairs", lambda x, i: F.when(x.eqNullSafe(F.get("pairs", i - 1)), None).otherwise(i)))
    runs = F.transform("starts", lambda at, i: F.struct(
        F.get("pairs", at).alias("term"), (F.coalesce(F.get("starts", i + 1), F.col("total")) - at).alias("weight")))
    rows = texts.select(*keys, words.alias("words")).select(*keys, pairs.alias("pairs"))
    rows = rows.select(*keys, "pairs", F.size("pairs").alias("total"), starts.alias("starts"))
    return rows.select(*keys, "total", runs.alias("runs")).select(*keys, "total", F.inline_outer("runs"))


def drawn(texts: DataFrame, keys: list[str], bins: int = BINS, likely: float = LIKELY) -> DataFrame:
    """keys, number and sample: number * 2**32 + 32 bits of the term and t of the smallest rank; null without words.

    ``keys`` tell the rows of ``texts`` apart; a row without words is one row here.
    """
    single = F.col("weight") == 1
    bound = F.lit(float(likely)) * F.col("weight") / F.col("total")
    terms = term_runs(texts, keys).select(*keys, "term", "weight", bound.alias("bound"), (bound * 2.0 ** 52).cast("long").alias("cells"))
    numbers = F.broadcast(texts.sparkSession.range(bins).select(F.col("id").cast("int").alias("number")))
    first = F.xxhash64("term", "number")  # 1 - exp(-a)
    second = F.xxhash64(first)  # exp(-h)
    can_win = F.when(single, F.shiftrightunsigned(first, 12) <= F.col("cells")).otherwise(_uniform(first) * _uniform(second) < F.col("bound"))
    rows = terms.join(numbers, F.when(F.col("term").isNull(), F.col("number") == 0).otherwise(can_win))
    rows = rows.select(*keys, "number", "term", "weight", _uniform(first).alias("u"), F.when(~single, -F.log1p(-_uniform(first))).alias("a"),
                       F.when(~single, -F.log(_uniform(F.xxhash64(second)))).alias("d"), F.when(~single, -F.log(_uniform(second))).alias("h"))
    rows = rows.withColumn("r", F.log((F.col("a") + F.col("d")) / F.col("a")) + F.col("h"))
    rows = rows.withColumn("t", F.coalesce(F.floor((F.log("weight") + F.col("h")) / F.col("r")), F.lit(0)))  # ln w / r + b
    rank = F.when(F.col("t") > 0, -F.expm1(-F.col("a") * F.exp(-F.col("r") * F.col("t")))).otherwise(F.col("u"))
    bits = F.xxhash64("term", "t").bitwiseAND(F.lit(0xFFFFFFFF))
    sample = F.when(F.col("term").isNotNull(), F.shiftleft(F.col("number").cast("long"), 32) + bits)
    rows = rows.select(*keys, "number", rank.alias("rank"), sample.alias("sample"))
    return rows.groupBy(*keys, "number").agg(F.min_by("sample", "rank").alias("sample"))


def likeness(a: Column, b: Column) -> Column:
    """Agreeing samples among the samples that either side fills."""
    def filled(s):
        return F.transform(s, lambda x: F.shiftright(x, 32))

    either = F.size(F.array_union(filled(a), filled(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def _as_text(s: Column) -> Column:
    return F.array_join(F.transform(s, F.hex), ".")


def _range_starts(docs: DataFrame, ranges: int) -> list[int]:
    """Ids that start ranges of about equal size; the smallest id is the first."""
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)]) if ranges > 1 else F.array(F.lit(1.0))
    row = docs.agg(F.min("doc_id").alias("least"), F.percentile_approx("doc_id", shares, max(10_000, 20 * ranges)).alias("q")).first()
    return [] if row["least"] is None else sorted({row["least"], *row["q"]})


def _range_of(doc_id: Column, starts: list[int]) -> Column:
    """Number of the range that holds doc_id: the last start that is not above it, found in two steps."""
    step = max(1, round(len(starts) ** 0.5))
    blocks = [starts[i:i + step] for i in range(0, len(starts), step)]
    heads = F.lit([b[0] for b in blocks]).cast("array<bigint>")
    inner = F.lit([b + [None] * (step - len(b)) for b in blocks]) if len(blocks) > 1 else F.lit([blocks[0]])
    block = F.size(F.filter(heads, lambda x: x <= doc_id)) - 1
    inside = F.size(F.filter(F.get(inner, block), lambda x: x.isNotNull() & (x <= doc_id))) - 1
    return F.coalesce(F.greatest(block, F.lit(0)) * step + F.greatest(inside, F.lit(0)), F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """part, row (place in its part), again, doc_id, text and next_text, the text of the next document by doc_id.

    Rows go to ranges of ids, sorted inside; the row that starts a range also goes, marked ``again``, to the end of the range before.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranges = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = _range_starts(docs, ranges)
    if starts:
        n = len(starts)
        # null ids come before the smallest id, so a null row, if there is one, is the first of all
        head = F.col("doc_id").isin(starts[1:]) if n > 1 else F.lit(False)
        part = _range_of(F.col("doc_id"), starts)
        here = F.struct(part.alias("part"), F.lit(False).alias("again"))
        before = F.struct((part - 1).alias("part"), F.lit(True).alias("again"))
        first = docs.agg(F.min(F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), F.xxhash64("text"), F.col("text"))).alias("m")).select("m.doc_id", "m.text")
        placed = docs.withColumn("at", F.explode(F.when(head, F.array(here, before)).otherwise(F.array(here))))
        closing = first.withColumn("at", F.struct(F.lit(n - 1).alias("part"), F.lit(True).alias("again")))
        placed = placed.unionByName(closing)
    else:
        n = 1
        placed = docs.withColumn("at", F.struct(F.lit(0).alias("part"), F.lit(False).alias("again")))
    dealt = placed.select("doc_id", "text", "at.part", "at.again").repartition(n, "part")
    order = Window.partitionBy("part").orderBy("again", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    following = F.coalesce(F.lead("text").over(order), F.col("text"))
    return dealt.select("part", F.row_number().over(order).alias("row"), "again", "doc_id", "text", following.alias("next_text"))


def edited(text: Column, other: Column) -> Column:
    """The last quarter of the code points replaced by as many from the start of ``other``."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(other, F.lit(1), quarter))


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and of its edited text, with their likeness to it and to the next document."""
    row = ["part", "row", "again", "doc_id", "n_chars", "digest"]
    pairs = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    pairs = pairs.select("part", "row", "again", "doc_id", F.length("text").cast("long").alias("n_chars"),
                         F.unhex(F.sha2("edited", 256)).alias("digest"), "text", "edited")
    of_text, of_edited = F.struct(F.lit(False).alias("is_edited"), "text"), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text"))
    both = pairs.select(*row, F.inline(F.when(F.col("again"), F.array(of_text)).otherwise(F.array(of_text, of_edited))))
    samples_of = {name: F.sort_array(F.collect_list(F.when(F.col("is_edited") == is_edited, F.col("sample"))))
                  for name, is_edited in (("sig", False), ("edited_sig", True))}
    held = drawn(both, [*row, "is_edited"]).groupBy(*row).agg(*[c.alias(name) for name, c in samples_of.items()])
    following = F.lead("sig").over(Window.partitionBy("part").orderBy("row"))
    held = held.withColumn("next_sig", F.coalesce(following, F.col("sig"))).where("NOT again")
    return held.select(
        "doc_id", "n_chars", F.lower(F.hex("digest")).alias("edited_sha256"),
        _as_text(F.col("sig")).alias("fingerprint"), _as_text(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))


def op7_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint_pairs(table(spark, sf_dir, "documents"))

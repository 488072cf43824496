"""Quality by positive-unlabelled learning: trusted positives against unlabelled web text.

Labels say only which documents are trusted (quality 1); documents labelled 0 are never used as negatives. A logistic
model over what a text looks like (pairs of character classes, hashed words, bucketed shape statistics) minimises the
non-negative unbiased risk  pi E_P[l(f)] + max(0, E_U[l(-f)] - pi E_P[l(-f)]): where the second part goes below zero, a step
is taken against it, so the model can not drive the risk of unlabelled text below nothing.

The class prior pi is estimated from all training documents: models of two halves tell positives from unlabelled text
and score the half they have not seen; among the documents above a score, unlabelled mass over positive mass is at least
pi, and the smallest such ratio with a confidence margin is taken (best-bin estimate). Scores are counted in bins.

The models are fitted on samples by id hash: about ``POSITIVES`` trusted and ``UNLABELLED`` other training documents. All
documents are scored. Null and empty texts are texts without words and get the score of one. Without trusted documents every
score is 0.5. A document is trusted when all its non-null labels are 1; repeated ids count once in a sample (smallest text)
and are scored row by row; a null doc_id is never trusted and not held out. Lang, source and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.ranked_search import rows_a_batch
from tidemark.llm.text import table, window_hashes, word_hashes, word_spans
from tidemark.session import settle

POSITIVES, UNLABELLED = 3000, 6000
STEPS, RATE, DECAY = 150, 0.05, 1e-4
THRESHOLD = 0.7
BINS, SPAN = 2000, 12.0
CONFIDENCE = 0.1

_PUNCTUATION = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
_CLASS = np.zeros(256, np.int32)  # control characters
for _number, _members in enumerate((range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), range(0x80, 0x100), [0x20], [0x0A],
                                    *([c] for c in _PUNCTUATION)), start=1):
    _CLASS[list(_members)] = _number
CLASSES = int(_CLASS.max()) + 1
PAIRS, WORDS = CLASSES * CLASSES, 1 << 14
_SHARES = np.array([0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9])
_LENGTHS = np.array([1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 8, 10, 14, 20, 40])
_COUNTS = np.array([1, 2, 4, 8, 16, 32, 64, 128, 512, 2048, 8192])
_EDGES = [_COUNTS, _LENGTHS, _COUNTS, *[_SHARES] * 8]
WIDTH = PAIRS + WORDS + 12 * len(_EDGES)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(place, value) of a text's features."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    kinds = _CLASS[np.frombuffer(raw, np.uint8)]
    pairs = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=PAIRS)
    seen = np.flatnonzero(pairs)
    starts, ends = word_spans(raw)
    hashes = word_hashes(raw.lower(), starts, ends)
    words, times = np.unique(hashes, return_counts=True)
    runs = window_hashes(hashes, 3)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n, size = max(1, len(hashes)), max(1, len(raw))
    of_kind = np.bincount(kinds, minlength=CLASSES)
    shown = [len(hashes), (ends - starts).sum() / n, len(hashes) / max(1, len(lines)),
             1 - len(words) / n, times.max(initial=0) / n, 1 - len(np.unique(runs)) / max(1, len(runs)),
             1 - len(set(lines)) / max(1, len(lines)), of_kind[7:].sum() / size, *(of_kind[[3, 2, 4]] / size)]
    places = [PAIRS + WORDS + 12 * i + np.searchsorted(edges, value, side="right") for i, (edges, value) in enumerate(zip(_EDGES, shown))]
    return (np.concatenate([seen, PAIRS + (words % np.uint64(WORDS)).astype(np.int64), places]).astype(np.int32),
            np.concatenate([np.sqrt(pairs[seen] / size), np.sqrt(times / n), np.full(len(places), 0.5)]).astype(np.float32))


class Sparse:
    """Rows of (place, value) lists, with products by a weight vector."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.sizes = np.asarray([len(p) for p, _ in rows], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.places = np.concatenate([p for p, _ in rows])
        self.values = np.concatenate([v for _, v in rows])

    def __len__(self) -> int:
        return len(self.sizes)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w[self.places] * self.values, self.starts)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.places, np.repeat(g, self.sizes) * self.values, WIDTH + 1)[:WIDTH + 1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def risk_parts(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Positive part and (possibly negative) rest of the unbiased risk of scores, with logistic loss."""
    loss = lambda z: np.logaddexp(0, -z).mean()
    return prior * loss(positive), loss(-unlabelled) - prior * loss(-positive)


def risk_slopes(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Descent slopes for the scores of both groups; below zero the step goes against the second part alone."""
    up, un = _sigmoid(positive), _sigmoid(unlabelled)
    rest_p, rest_u = -prior * up / len(up), un / len(un)
    if risk_parts(positive, unlabelled, prior)[1] < 0:
        return -rest_p, -rest_u
    return prior * (up - 1) / len(up) + rest_p, rest_u


def fit(positive: Sparse, unlabelled: Sparse, prior: float | None, steps: int = STEPS) -> np.ndarray:
    """Weights by Adam on the non-negative risk; without a prior, on telling the two groups apart."""
    w, m, v = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1), np.zeros(WIDTH + 1)
    for t in range(1, steps + 1):
        zp, zu = positive.dot(w) + w[-1], unlabelled.dot(w) + w[-1]
        if prior is None:
            gp, gu = (_sigmoid(zp) - 1) / (2 * len(zp)), _sigmoid(zu) / (2 * len(zu))
        else:
            gp, gu = risk_slopes(zp, zu, prior)
        g = positive.back(gp) + unlabelled.back(gu) + DECAY * w
        g[-1] = gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def best_bin_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Class prior from counts of both groups in bins of rising score."""
    n_p, n_u = positive.sum(), unlabelled.sum()
    if not n_p or not n_u:
        return 0.5
    above_p, above_u = positive[::-1].cumsum() / n_p, unlabelled[::-1].cumsum() / n_u
    margin = sum(np.sqrt(np.log(4 / CONFIDENCE) / (2 * n)) for n in (n_p, n_u))
    good = above_p > 0
    best = np.argmin(above_u[good] / above_p[good] + margin / above_p[good])
    return float(np.clip(above_u[good][best] / above_p[good][best], 0.02, 0.98))


# --- over tables ------------------------------------------------------------------------------------------------------

def trusted_ids(labels: DataFrame) -> DataFrame:
    ids = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"))
    return ids.where("q = 1").select("doc_id")


def _place(salt: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 30)) / float(1 << 30)


def _collect_features(rows: DataFrame) -> list:
    """(half, place, value) of a bounded sample, in order of doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([p.tobytes() for p, _ in found], pa.binary()),
                 pa.array([v.tobytes() for _, v in found], pa.binary())], ["doc_id", "half", "places", "vals"])

    once = rows.groupBy("doc_id").agg(F.min("half").alias("half"), F.min("text").alias("text"))
    shown = once.mapInArrow(run, "doc_id long, half int, places binary, vals binary").collect()
    return [(r["half"], (np.frombuffer(r["places"], np.int32), np.frombuffer(r["vals"], np.float32)))
            for r in sorted(shown, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))]


def score_texts(docs: DataFrame, models: list[np.ndarray], which: Column | None = None, name: str = "margin") -> DataFrame:
    """``docs`` without its text, with the margin by the model whose number ``which`` gives."""
    held = docs.sparkSession.sparkContext.broadcast(models)
    rows = docs.withColumn("_model", which if which is not None else F.lit(0))
    kept = [c for c in docs.columns if c != "text"]
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, number in zip(batch.column(names.index("text")).to_pylist(), batch.column(len(names) - 1).to_pylist()):
                w = held.value[number]
                places, values = features(text)
                out.append(float(w[places] @ values + w[-1]))
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in kept), pa.array(out, pa.float64())], [*kept, name])

    return rows.mapInArrow(run, docs.select(*kept).withColumn(name, F.lit(0.0)).schema)


def train(docs: DataFrame, trusted: DataFrame) -> tuple[np.ndarray, float] | None:
    """Weights and class prior from training documents (doc_id, text) and the trusted ids among them."""
    known = settle(docs.where("doc_id IS NOT NULL").select("doc_id").join(trusted, "doc_id", "left_semi").distinct(), "trusted-ids")
    n_p, n_u = known.count(), docs.count()
    if not n_p:
        return None
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int").alias("half")
    some = known.where(_place("p") < min(1.0, POSITIVES / n_p))  # about POSITIVES ids, whatever the table holds
    positives = _collect_features(docs.join(F.broadcast(some), "doc_id", "left_semi").select("doc_id", "text", half))
    others = _collect_features(docs.where(_place("u") < min(1.0, UNLABELLED / n_u)).select("doc_id", "text", half))
    if not positives or not others:
        return None
    halves = []
    for h in (0, 1):
        p, u = [f for k, f in positives if k == h], [f for k, f in others if k == h]
        halves.append(fit(Sparse(p), Sparse(u), None) if p and u else np.zeros(WIDTH + 1))
    margins = score_texts(docs.select("doc_id", "text"), halves, 1 - half)
    marked = margins.join(known.withColumn("trusted", F.lit(1)), "doc_id", "left")
    place = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.col("margin") + SPAN) * (BINS / (2 * SPAN))))).cast("int")
    counted = marked.groupBy(place.alias("bin")).agg(F.count("trusted").alias("p"), F.count(F.lit(1)).alias("u")).collect()
    in_p, in_u = np.zeros(BINS), np.zeros(BINS)
    for r in counted:
        in_p[r["bin"]], in_u[r["bin"]] = r["p"], r["u"]
    prior = best_bin_prior(in_p, in_u)
    return fit(Sparse([f for _, f in positives]), Sparse([f for _, f in others]), prior), prior


def op12_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    with rows_a_batch(spark, 2000):
        model = train(docs.where(~held_out), trusted_ids(table(spark, sf_dir, "labels")))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    if model is None:
        judged = rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    else:
        judged = score_texts(rows, [model[0]]).select("doc_id", "held_out", (1 / (1 + F.exp(-F.col("margin")))).alias("score"))
    return judged.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

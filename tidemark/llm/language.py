"""Language of code-switched text by a linear-chain conditional random field over words.

A word's features are its prefixes and suffixes (affixes), its letter trigrams and the word itself (lexicon), hashed
into ``FEATURES`` weights per label; labels of neighbours are scored by a learned transition matrix. Training is on
code-switched sequences: runs of words from documents of different languages, each word labelled with its document's
lang. A text's words are labelled by forward-backward; its language is the one with the largest expected number of
words, its score that share.

The model is fitted on at most ``TRAIN_DOCS`` labelled documents per language, chosen by hash of doc_id over the whole
table; every other step reads all documents. Null text, or text without a letter: ``und`` with score 0. Without a
labelled document every text is ``und``. Ties go to the first label in alphabetical order; repeated rows get the same.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import modest_batches, table

FEATURES = 1 << 16
PER_WORD = 16  # features of a word at most; a long word's trigrams are spread over it
TRAIN_DOCS = 300
RUN = 12  # mean words of a run in a training sequence
LENGTH, BATCH = 48, 64
CACHED_WORDS = 300_000
CELLS = 1_000_000  # padded words that are decoded together

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features_of(word: str) -> list[int]:
    """Hashed features, padded with the empty feature ``FEATURES``."""
    edged = f"^{word}$"
    inner = [edged[i:i + 3] for i in range(len(edged) - 2)]
    step = -(-len(inner) // (PER_WORD - 8)) or 1
    names = ["b", f"w{word}", *(f"p{word[:k]}" for k in (1, 2, 3)), *(f"s{word[-k:]}" for k in (1, 2, 3)),
             *(f"t{g}" for g in inner[::step])][:PER_WORD]
    found = [zlib.crc32(n.encode("utf-8", "surrogatepass")) % FEATURES for n in names]
    return found + [FEATURES] * (PER_WORD - len(found))


@dataclass
class Field:
    """Weights of a chain: ``emit`` (features + 1, labels), ``move`` (labels, labels)."""

    labels: list[str]
    emit: np.ndarray
    move: np.ndarray
    cache: dict[str, int] = field(default_factory=dict)
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))

    def __getstate__(self):
        return {"labels": self.labels, "emit": self.emit, "move": self.move, "cache": {}, "table": np.zeros((0, 0), np.float32)}

    def scores(self, words: Sequence[str]) -> np.ndarray:
        return np.concatenate([self.emit[np.asarray([features_of(w) for w in words[i:i + 20_000]])].sum(axis=1)
                               for i in range(0, len(words), 20_000)]) if words else np.zeros((0, len(self.labels)), np.float32)

    def numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of ``table`` for the words of each text."""
        wanted = set().union(*texts)
        if len(self.cache) + len(wanted) > CACHED_WORDS:
            self.cache.clear()
        new = [w for w in wanted if w not in self.cache]
        if not self.cache:
            self.table = np.zeros((0, len(self.labels)), np.float32)
        at = len(self.cache)
        self.cache.update(zip(new, range(at, at + len(new))))
        self.table = np.concatenate([self.table[:at], self.scores(new)])
        return [np.fromiter(map(self.cache.__getitem__, t), np.int64, len(t)) for t in texts]


def forward_backward(emit: np.ndarray, move: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities (time, batch, labels) and expected transitions of padded sequences, longest first."""
    steps, _, n = emit.shape
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    m = np.exp(move - move.max())
    alive = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")  # sequences that reach each step
    alpha, beta, pairs = np.zeros_like(e), np.ones_like(e), np.zeros_like(move)
    for t in range(steps):
        k = alive[t]
        a = e[t, :k] * (alpha[t - 1, :k] @ m) if t else e[t, :k]
        alpha[t, :k] = a / a.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        k = alive[t + 1]
        right = e[t + 1, :k] * beta[t + 1, :k]
        b = right @ m.T
        beta[t, :k] = b / b.sum(axis=1, keepdims=True)
    share = alpha * beta
    share /= np.maximum(share.sum(axis=2, keepdims=True), 1e-30)
    return share, pairs, alpha, beta, e, m, alive


def _expected_moves(alpha, beta, e, m) -> np.ndarray:
    """Expected transitions of sequences of one length."""
    right = e[1:] * beta[1:]
    joint = alpha[:-1, :, :, None] * m * right[:, :, None, :]
    return (joint / joint.sum(axis=(2, 3), keepdims=True)).sum(axis=(0, 1))


def fit(docs: list[tuple[str, list[str]]], epochs: int = 2, rate: float = 0.3, decay: float = 1e-4, seed: int = 7) -> Field:
    """Train on (lang, words) by gradient steps over code-switched sequences."""
    labels = sorted({lang for lang, _ in docs})
    n = len(labels)
    model = Field(labels, np.zeros((FEATURES + 1, n), np.float32), np.zeros((n, n), np.float64))
    if not labels:
        return model
    dice = np.random.default_rng(seed)
    vocab: dict[str, int] = {}
    streams = [np.asarray([vocab.setdefault(w, len(vocab)) for lang, ws in docs if lang == label for w in ws] or [0], np.int64)
               for label in labels]
    if not vocab:
        return model
    feats = np.asarray([features_of(w) for w in vocab])
    past, past_move = np.full((FEATURES + 1, n), 1e-6, np.float32), np.full((n, n), 1e-6)
    total = sum(map(len, streams))
    lengths = np.full(BATCH, LENGTH)
    for _ in range(max(1, epochs * total // (LENGTH * BATCH))):
        stay = dice.random((LENGTH, BATCH)) > 1 / RUN
        y = dice.integers(n, size=(LENGTH, BATCH))
        at = np.stack([dice.integers(len(s), size=(LENGTH, BATCH)) for s in streams])
        w = np.empty((LENGTH, BATCH), np.int64)
        place = np.zeros(BATCH, np.int64)
        for t in range(LENGTH):
            fresh = ~stay[t] if t else np.ones(BATCH, bool)
            y[t] = np.where(fresh, y[t], y[t - 1] if t else y[t])
            place = np.where(fresh, at[y[t], t, np.arange(BATCH)], place + 1)
            for label in range(n):
                mine = y[t] == label
                w[t, mine] = streams[label][place[mine] % len(streams[label])]
        f = feats[w]
        share, _, alpha, beta, e, m, _ = forward_backward(model.emit[f].sum(axis=2), model.move, lengths)
        grad = -share
        np.put_along_axis(grad, y[:, :, None], np.take_along_axis(grad, y[:, :, None], 2) + 1, 2)
        flat = f.reshape(-1)
        step = np.stack([np.bincount(flat, np.repeat(grad[:, :, k].ravel(), PER_WORD), FEATURES + 1) for k in range(n)], axis=1)
        step = (step / BATCH - decay * model.emit).astype(np.float32)
        past += step * step
        model.emit += rate * step / np.sqrt(past)
        model.emit[FEATURES] = 0
        seen = np.zeros((n, n))
        np.add.at(seen, (y[:-1].ravel(), y[1:].ravel()), 1)
        move = (seen - _expected_moves(alpha, beta, e, m)) / BATCH
        past_move += move * move
        model.move += rate * move / np.sqrt(past_move)
    return model


def label_texts(model: Field, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, share of words) of each text."""
    out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
    if not model.labels:
        return out
    split = [words_of(t) for t in texts]
    numbers = model.numbers(split)
    order = sorted((i for i in range(len(texts)) if split[i]), key=lambda i: -len(split[i]))
    while order:
        size = max(1, CELLS // len(split[order[0]]))
        group, order = order[:size], order[size:]
        lengths = np.asarray([len(split[i]) for i in group])
        emit = np.zeros((lengths[0], len(group), len(model.labels)), np.float32)
        for k, i in enumerate(group):
            emit[:lengths[k], k] = model.table[numbers[i]]
        share = forward_backward(emit, model.move.astype(np.float32), lengths)[0]
        share[np.arange(lengths[0])[:, None] >= lengths[None, :]] = 0
        expected = share.sum(axis=0, dtype=np.float64) / lengths[:, None]
        for i, row in zip(group, expected):
            best = int(np.argmax(row))
            out[i] = model.labels[best], round(float(min(1.0, row[best])), 6)
    return out


def train(docs: DataFrame, per_language: int = TRAIN_DOCS) -> Field:
    """Fit on a sample of rows (doc_id, text, lang): the share of each language that gives about ``per_language`` rows."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return fit([])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (place < min(1.0, per_language / n)))
    sample = rows.where(chosen).select("lang", "doc_id", "text").collect()
    sample.sort(key=lambda r: (r["lang"], r["doc_id"] is None, r["doc_id"] or 0, r["text"]))
    return fit([(r["lang"], words_of(r["text"])) for r in sample])


def predict(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; only the text is read for them."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = label_texts(held.value, batch.column(names.index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())], [*names, "lang_pred", "score"])

    shape = docs.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    return docs.mapInArrow(run, shape)


def op4_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    modest_batches(spark, 2000)
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = train(docs.where(~held_out).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")

"""Removal of passages that earlier documents already hold, by repeated-phrase automata.

Windows are ``WINDOW`` consecutive words. Each has a signal phrase: the one of its ``PHRASE``-word runs with the smallest
hash (the last of equal ones), so equal windows have equal signal phrases.

1. Propose: every document gives its signal phrases, each with a hash of the stretch of windows that it signals.
2. Confirm: a phrase recurs when two documents give it. When all give it with the same stretch, the stretch as a whole
   recurs and the smallest doc_id is its source; else its windows have to be compared one by one.
3. Locate: documents with recurring phrases are dealt into shards by id; each shard's phrases are compiled into an
   Aho-Corasick automaton, and the shard's documents are streamed through it, which gives every occurrence.
4. Decide: windows under a whole recurring stretch are removed from all documents but the source. The other windows
   found are reduced by hash to the smallest doc_id, counted before they are shuffled, and joined back.

A word is removed when a removed window covers it. Windows are judged on the input. Null, empty and short texts have no
windows and stay as they are. Rows that share a doc_id with different texts are judged as documents of that id; rows
with a null doc_id are kept whole and are no source. Windows and phrases are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.quality import words
from tidemark.llm.text import mix, modest_batches, table, window_hashes, word_hashes, word_spans
from tidemark.session import settle

WINDOW = 50
PHRASE = 10
SHARD_DOCS = 250


class Signals:
    """The windows of one text: hashes, and the word at which each window's signal phrase starts."""

    def __init__(self, text: str, window: int = WINDOW, phrase: int = PHRASE) -> None:
        self.raw = text.encode()
        self.starts, self.ends = word_spans(self.raw)
        self.windows = self.at = np.zeros(0, np.int64)
        if len(self.starts) < window:
            return
        hashes = word_hashes(self.raw, self.starts, self.ends)
        self.windows = window_hashes(hashes, window)
        self.phrases = window_hashes(hashes, phrase)
        width = window - phrase + 1
        view = np.lib.stride_tricks.sliding_window_view(self.phrases, width)
        self.at = np.arange(len(self.windows)) + width - 1 - np.argmin(view[:, ::-1], axis=1)
        self.first = np.flatnonzero(np.diff(self.at, prepend=-1))  # first window of each stretch
        self.signal = self.phrases[self.at[self.first]]
        size = np.diff(self.first, append=len(self.at))
        # A stretch is told by its first and last window, its length and the sum of all its windows.
        total = np.add.reduceat(mix(self.windows), self.first)
        self.stretch = mix(total ^ mix(self.windows[self.first] + size.astype(np.uint64)) ^ self.windows[self.first + size - 1])


def signal_phrases(docs: DataFrame) -> DataFrame:
    """Distinct (doc_id, th, phrase, stretch)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for doc_id, th, text in zip(*(c.to_pylist() for c in batch.columns)):
                s = Signals(text)
                if len(s.windows):
                    pairs = np.unique(np.stack([s.signal, s.stretch]), axis=1)
                    n = pairs.shape[1]
                    for column, value in zip(columns, (np.full(n, doc_id, np.int64), np.full(n, th, np.int64), *pairs.view(np.int64))):
                        column.append(value)
            flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in flat], ["doc_id", "th", "phrase", "stretch"])

    return docs.mapInArrow(run, "doc_id long, th long, phrase long, stretch long")


_LOCATED = "doc_id long, th long, text string, sure array<int>, open array<int>, hashes array<long>"


def locate(candidates: DataFrame) -> DataFrame:
    """Per document: windows under whole recurring stretches (sure), windows still open and their hashes.

    ``candidates`` has doc_id, th, text and found, an array of (phrase, source): source is null where windows decide.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        for batch in batches:
            rows = []
            automaton = ahocorasick.Automaton()
            for doc_id, th, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                s = Signals(text)
                if not len(s.windows):
                    continue
                source = {np.uint64(f["phrase"] % (1 << 64)): f["source"] for f in found}
                parts = s.raw.split()
                plain = f" {b' '.join(parts).decode()} "
                for phrase, at in dict(zip(s.signal.tolist(), s.at[s.first].tolist())).items():
                    if np.uint64(phrase) in source:
                        automaton.add_word(f" {b' '.join(parts[at:at + PHRASE]).decode()} ", phrase)
                rows.append((doc_id, th, text, s, source, plain))
            if len(automaton):
                automaton.make_automaton()
            out = []
            for doc_id, th, text, s, source, plain in rows:
                gaps = np.flatnonzero(np.frombuffer(plain.encode("utf-32-le"), np.uint32) == 0x20)
                state = np.zeros(len(s.phrases), np.int8)  # of a phrase's place: 1 recurs as a whole, 2 by windows
                for end, phrase in automaton.iter(plain) if len(automaton) else ():
                    if (key := np.uint64(phrase)) in source:
                        at = int(np.searchsorted(gaps, end)) - PHRASE
                        whole = source[key]
                        state[at] = 2 if whole is None else int(whole < doc_id)
                of_window = state[s.at]
                open_ = np.flatnonzero(of_window == 2)
                out.append({"doc_id": doc_id, "th": th, "text": text, "sure": np.flatnonzero(of_window == 1).tolist(),
                            "open": open_.tolist(), "hashes": s.windows[open_].view(np.int64).tolist()})
            yield pa.RecordBatch.from_pylist(out, _ARROW)

    return candidates.mapInArrow(run, _LOCATED)


_ARROW = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("text", pa.string()), ("sure", pa.list_(pa.int32())),
                    ("open", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64()))])
_CHANGED = "doc_id long, th long, n_removed long, kept_sha256 string, kept_text string"


def _cut(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Texts without the words that the windows ``sure`` and ``more`` cover; rows without any are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, th, text, sure, more in zip(*(c.to_pylist() for c in batch.columns)):
                at = np.asarray([*(sure or []), *(more or [])], np.int64)
                if not len(at):
                    continue
                raw = text.encode()
                starts, ends = word_spans(raw)
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, np.minimum(at + window, len(starts)), -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = [raw[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist())]
                # What stays of the text: each run of removed words goes with the white space before it.
                first = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0) > 0)
                last = np.flatnonzero(np.diff(gone.astype(np.int8), append=0) < 0)
                parts, at_byte = [], 0
                for a, b in zip(first.tolist(), last.tolist()):
                    parts.append(raw[at_byte:ends[a - 1] if a else starts[a]])
                    at_byte = int(ends[b])
                text_left = b"".join([*parts, raw[at_byte:]]).decode()
                out.append((doc_id, th, int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest(), text_left))
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             [c.split()[0] for c in _CHANGED.split(", ")])

    return rows.mapInArrow(run, _CHANGED)


def repeats(docs: DataFrame) -> DataFrame:
    """The documents that lose words: doc_id, th (hash of the text), n_removed, kept_sha256, kept_text."""
    spark = docs.sparkSession
    modest_batches(spark, SHARD_DOCS)
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("th"), "text")
    signals = settle(signal_phrases(docs.select("doc_id", "th", "text")), "signals")
    recurring = signals.groupBy("phrase").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.min("stretch").alias("s"), F.max("stretch").alias("z"))
    recurring = recurring.where("least < most").select("phrase", F.when(F.col("s") == F.col("z"), F.col("least")).alias("source"))
    found = signals.select("doc_id", "th", "phrase").join(recurring, "phrase").where("source IS NULL OR source < doc_id")
    found = found.distinct().groupBy("doc_id", "th").agg(F.collect_list(F.struct("phrase", "source")).alias("found"))
    located = settle(locate(docs.dropDuplicates(["doc_id", "th"]).join(found, ["doc_id", "th"]).select("doc_id", "th", "text", "found")),
                     "located")
    open_ = located.select("doc_id", "th", F.explode(F.arrays_zip("open", "hashes")).alias("w")).select(
        "doc_id", "th", F.col("w.open").alias("at"), F.col("w.hashes").alias("h"))
    least = open_.groupBy("h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    more = open_.join(least.select("h", "least"), "h").where("least < doc_id").groupBy("doc_id", "th").agg(F.collect_list("at").alias("more"))
    return settle(_cut(located.select("doc_id", "th", "text", "sure").join(more, ["doc_id", "th"], "left")), "changed")


def op3_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    changed = repeats(docs).drop("kept_text")
    w = words(F.col("text"))
    base = docs.select("doc_id", F.xxhash64("text").alias("th"), F.size(w).cast("long").alias("n_words"),
                       F.sha2(F.array_join(w, " "), 256).alias("whole"))
    return base.join(changed, ["doc_id", "th"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


#: For the checking engine: every window against the smallest document in which it starts.
OP3_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x : x <> '') AS w FROM documents),
v AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM w WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i+49], ' ')) AS h FROM v),
m AS (SELECT h, min(doc_id) AS least FROM h GROUP BY 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM h JOIN m USING (h) WHERE least < doc_id),
g2 AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY 1),
k AS (SELECT w.doc_id, len(w) AS n, coalesce(len(gone), 0) AS r, w,
      coalesce(gone, []) AS gone FROM w LEFT JOIN g2 USING (doc_id)),
u AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w),
s AS (SELECT u.doc_id, string_agg(x, ' ' ORDER BY u.i) AS kept FROM u LEFT JOIN g ON g.doc_id = u.doc_id AND g.i = u.i WHERE g.i IS NULL GROUP BY 1)
SELECT k.doc_id, n::BIGINT AS n_words, r::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM k LEFT JOIN s USING (doc_id)
"""

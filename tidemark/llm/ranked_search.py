"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are dealt into shards as they are scanned, so texts are not shuffled. A shard's grid has a row for each term
(falling frequency) and a column for each document (rising length); a cell holds the term's impact in the document. The
grid is a quadtree in level order: each node has a mark for its four quarters that are not empty and the largest impact
below it, stored as its distance from its parent's. Children are found by counting marks (rank), so there are no
pointers. The index of all terms of all documents is a table with one row a shard.

A search walks the rows of an item's terms together: a range of documents has one node for each term, its bound is the
sum of weight times largest impact, and ranges are opened best first, a batch at a time, until no range can reach the
k-th score. Leaves give exact scores. Shards return k documents an item, which are merged in two steps.

Terms are compared by 64-bit hashes. Null texts have no term and are not counted. Items are searched in blocks of bounded
size. Rows of one item_id are one item with the terms of all of them (a null item_id is such an id too); an item without
a term has no result. Rows of one doc_id are separate documents; of equal scores the smaller doc_id comes first, a
null doc_id last. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import table, word_hashes
from tidemark.session import new_path

TOP = 50
SHARD_DOCS = 1 << 14
SHARD_TERMS = 1_000_000  # occurrences of terms in a shard, but for a longer single text
CHUNK_BYTES = 1 << 20
ITEM_BYTES = 32 << 20  # texts of the items that are searched together
BATCH = 512  # ranges opened at a time

_TERM = np.ones(256, dtype=bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _TERM[_low:_high + 1] = False
_ONES = np.array([bin(i).count("1") for i in range(16)], dtype=np.int32)


@contextmanager
def rows_a_batch(spark: SparkSession, rows: int):
    """The Arrow batch size for the jobs run inside; the caller's setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# --- terms ------------------------------------------------------------------------------------------------------------

def term_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], _TERM[np.frombuffer(raw, dtype=np.uint8)], [0])).astype(np.int8))
    return np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)


def _chunks(texts: list[str | None]) -> Iterator[tuple[bytes, np.ndarray, int]]:
    """Texts joined by line ends up to CHUNK_BYTES: bytes, start of each text, number of the first one."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > CHUNK_BYTES:
            yield b"\n".join(held), np.cumsum([0, *(len(h) + 1 for h in held[:-1])]), first
            held, size, first = [], 0, i
        held.append(raw)
        size += len(raw)
    if held:
        yield b"\n".join(held), np.cumsum([0, *(len(h) + 1 for h in held[:-1])]), first


def terms_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of its text) of every occurrence of a term; only A-Z are lower-cased."""
    hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
    for raw, begins, first in _chunks(texts):
        starts, ends = term_spans(raw)
        hashes.append(word_hashes(raw.lower(), starts, ends))
        owners.append((first + np.searchsorted(begins, starts, side="right") - 1).astype(np.int32))
    return np.concatenate(hashes), np.concatenate(owners)


def corpus_counts(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = total = 0
        for batch in batches:
            for raw, begins, _ in _chunks(batch.column(0).to_pylist()):
                n = np.diff(np.searchsorted(term_spans(raw)[0], np.append(begins, len(raw) + 1)))
                filled, total = filled + int((n > 0).sum()), total + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array([filled]), pa.array([total])], ["filled", "total"])

    r = docs.select("text").mapInArrow(run, "filled long, total long").agg(F.sum("filled"), F.sum("total")).first()
    return (r[0] or 0), (r[1] or 0)


# --- the grid ---------------------------------------------------------------------------------------------------------

def _spread(v: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers at every second place."""
    v = v.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
                        (1, 0x5555555555555555)):
        v = (v | (v << np.uint64(shift))) & np.uint64(mask)
    return v


def _gather(v: np.ndarray) -> np.ndarray:
    """Every second bit, the inverse of _spread."""
    v = v & np.uint64(0x5555555555555555)
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF),
                        (16, 0x00000000FFFFFFFF)):
        v = (v | (v >> np.uint64(shift))) & np.uint64(mask)
    return v.astype(np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    m = 100 - 50 + (50 * n * docs) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Treap:
    """Quadtree levels from the root: marks of the nodes, and impact maxima of the nodes below them."""

    marks: list[np.ndarray]
    drops: list[np.ndarray]
    peak: int

    @classmethod
    def build(cls, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, height: int) -> Treap:
        code = (_spread(rows) << np.uint64(1)) | _spread(cols)
        order = np.argsort(code)
        return cls.of_codes(code[order], values[order], height)

    @classmethod
    def of_codes(cls, code: np.ndarray, values: np.ndarray, height: int) -> Treap:
        """From cells in Morton order."""
        marks, drops = [], []
        for _ in range(height):
            above = code >> np.uint64(2)
            first = np.flatnonzero(np.concatenate(([True], above[1:] != above[:-1])))
            marks.append(np.bitwise_or.reduceat(np.left_shift(1, (code & np.uint64(3)).astype(np.uint8), dtype=np.uint8), first))
            top = np.maximum.reduceat(values, first)
            drops.append(np.repeat(top, np.diff(np.append(first, len(code)))) - values)
            code, values = above[first], top
        return cls(marks[::-1], [d.astype(np.uint32) for d in drops[::-1]], int(values[0]))


class Walk:
    """A treap made ready for searching: children by rank, absolute maxima; node -1 stands for an empty quarter."""

    def __init__(self, treap: Treap) -> None:
        self.height = len(treap.marks)
        self.marks = [np.append(m, np.uint8(0)) for m in treap.marks]
        self.first, self.peaks = [], [np.array([treap.peak, 0], np.int64)]
        for marks, drops in zip(treap.marks, treap.drops):
            ones = _ONES[marks]
            self.first.append(np.append(np.cumsum(ones) - ones, 0).astype(np.int32))
            self.peaks.append(np.append(np.repeat(self.peaks[-1][:-1], ones) - drops, 0))

    def top(self, rows: np.ndarray, weights: np.ndarray, k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(scores, columns) that hold all of the k best columns with a score of at least ``least``, ties at the last place included."""
        scores, cols = np.zeros(0, np.int64), np.zeros(0, np.int64)
        open_: dict[int, tuple] = {0: (np.array([self.peaks[0][0] * weights.sum()]), np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int32))}
        while open_:
            level = max(open_, key=lambda x: (open_[x][0].max(), x))
            bound, at, nodes = open_.pop(level)
            if len(bound) > BATCH:
                order = np.argpartition(-bound, BATCH)
                rest = order[BATCH:]
                rest = rest[bound[rest] >= least]
                if len(rest):
                    open_[level] = bound[rest], at[rest], nodes[rest]
                at, nodes, bound = at[order[:BATCH]], nodes[order[:BATCH]], bound[order[:BATCH]]
            live = bound >= least
            if not live.any():
                continue
            if not live.all():
                at, nodes = at[live], nodes[live]
            marks, first = self.marks[level][nodes], self.first[level][nodes]
            bit = 2 * ((rows >> (self.height - 1 - level)) & 1)
            found = []
            for half in (0, 1):
                quarter = (bit + half).astype(np.uint8)
                child = np.where((marks >> quarter) & 1, first + _ONES[marks & ((np.uint8(1) << quarter) - np.uint8(1))], -1)
                b = self.peaks[level + 1][child] @ weights
                keep = b >= least
                found.append((b[keep], 2 * at[keep] + half, child[keep]))
            bound, at = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            if level + 1 == self.height:
                scores, cols = np.concatenate([scores, bound]), np.concatenate([cols, at])
                if len(scores) > k:
                    least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                    keep = scores >= least
                    scores, cols = scores[keep], cols[keep]
            elif len(bound):
                nodes = np.concatenate([f[2] for f in found])
                if level + 1 in open_:
                    b, a, v = open_[level + 1]
                    bound, at, nodes = np.concatenate([b, bound]), np.concatenate([a, at]), np.concatenate([v, nodes])
                open_[level + 1] = bound, at, nodes
        return scores, cols


# --- the index table --------------------------------------------------------------------------------------------------

INDEX = ("shard string, doc_ids array<bigint>, terms binary, rows binary, df binary, "
         "peak bigint, level_nodes array<int>, marks binary, drops binary")
HITS = "item_id long, doc_id long, score long, part int"
# an index row is some megabytes: a row group holds few of them, so a reader never has many at once
WRITING = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}


def _shard(name: str, ids: list, hashes: np.ndarray, owner: np.ndarray, docs: int, terms: int) -> pa.RecordBatch:
    """The index row of some documents."""
    n = np.bincount(owner, minlength=len(ids))
    order = np.lexsort((np.array([i is None for i in ids]), n))
    column = np.empty(len(ids), np.int64)
    column[order] = np.arange(len(ids))
    vocab, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
    row = np.empty(len(vocab), np.int64)
    row[np.argsort(-times, kind="stable")] = np.arange(len(vocab))
    code = (_spread(row)[which] << np.uint64(1)) | _spread(column)[owner]
    code.sort()
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    tf = np.diff(np.append(first, len(code)))
    code = code[first]
    values = impacts(tf, n[order][_gather(code)], docs, terms)
    df = np.bincount(_gather(code >> np.uint64(1)), minlength=len(vocab))[row]
    height = max(1, (max(len(vocab), len(ids)) - 1).bit_length())
    treap = Treap.of_codes(code, values, height)
    return pa.RecordBatch.from_arrays([
        pa.array([name]), pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
        *(pa.array([v.astype(kind).tobytes()], pa.binary()) for v, kind in ((vocab, "<u8"), (row, "<u4"), (df, "<u4"))),
        pa.array([treap.peak]), pa.array([[len(m) for m in treap.marks]], pa.list_(pa.int32())),
        pa.array([np.concatenate(treap.marks).tobytes()], pa.binary()),
        pa.array([np.concatenate(treap.drops).astype("<u4").tobytes()], pa.binary())],
        ["shard", "doc_ids", "terms", "rows", "df", "peak", "level_nodes", "marks", "drops"])


def build_index(docs: DataFrame, counts: tuple[int, int], shard_docs: int = SHARD_DOCS, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """One row for each shard of (doc_id, text); documents without a term are in none."""
    n_docs, n_terms = counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        ids, hashes, owners, held = [], [], [], 0
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found, owner = terms_of(texts)
            sizes = np.bincount(owner, minlength=len(keys))
            ends = np.cumsum(sizes)
            at = 0
            while at < len(keys):  # as many of the batch as the shard takes
                room = np.searchsorted(ends, (ends[at - 1] if at else 0) + shard_terms - held, side="right")
                to = int(min(len(keys), at + shard_docs - len(ids), max(room, at if ids else at + 1)))
                if to > at:
                    a, b = int(ends[at - 1]) if at else 0, int(ends[to - 1])
                    full = at + np.flatnonzero(sizes[at:to])
                    number = np.full(to - at, -1, np.int32)
                    number[full - at] = len(ids) + np.arange(len(full))
                    ids += [keys[i] for i in full]
                    hashes.append(found[a:b])
                    owners.append(number[owner[a:b] - at])
                    held += b - a
                    at = to
                if at < len(keys) and ids:
                    yield _shard(f"{part}-{made}", ids, np.concatenate(hashes), np.concatenate(owners), n_docs, n_terms)
                    ids, hashes, owners, held, made = [], [], [], 0, made + 1
        if ids:
            yield _shard(f"{part}-{made}", ids, np.concatenate(hashes), np.concatenate(owners), n_docs, n_terms)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)


def _open(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, Walk]:
    row = {name: batch.column(name)[i].as_py() for name in ("terms", "rows", "peak", "level_nodes", "marks", "drops")}
    sizes = np.asarray(row["level_nodes"])
    marks = np.split(np.frombuffer(row["marks"], np.uint8), np.cumsum(sizes)[:-1])
    drops = np.split(np.frombuffer(row["drops"], "<u4"), np.cumsum([int(_ONES[m].sum()) for m in marks])[:-1])
    return np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["rows"], "<u4").astype(np.int64), Walk(Treap(marks, drops, row["peak"]))


# --- search -----------------------------------------------------------------------------------------------------------

def _items(rows: list) -> list[tuple[int | None, np.ndarray]]:
    """(item_id, distinct terms) of the rows of a block."""
    found, owner = terms_of([r["text"] for r in rows])
    cuts = np.searchsorted(owner, np.arange(len(rows) + 1))
    held: dict[int | None, list] = {}
    for i, r in enumerate(rows):
        held.setdefault(r["item_id"], []).append(found[cuts[i]:cuts[i + 1]])
    return [(key, np.unique(np.concatenate(parts))) for key, parts in held.items()]


def weights(index: DataFrame, terms: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of sorted terms, by their document counts over all shards."""
    held = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(held.value), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                own, df = np.frombuffer(batch.column(0)[i].as_py(), "<u8"), np.frombuffer(batch.column(1)[i].as_py(), "<u4")
                at = np.minimum(np.searchsorted(own, held.value), len(own) - 1)
                total += np.where(own[at] == held.value, df[at], 0)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["place", "df"])

    df = np.zeros(len(terms), np.int64)
    for r in index.select("terms", "df").mapInArrow(run, "place long, df long").groupBy("place").agg(F.sum("df").alias("df")).collect():
        df[r["place"]] = r["df"]  # the terms of one block of items
    return np.asarray([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def search_block(index: DataFrame, rows: list, n_docs: int, k: int) -> DataFrame:
    """(item_id, doc_id, score, part): for each item of a block the k best of the shards of every task."""
    items = _items(rows)
    terms = np.unique(np.concatenate([t for _, t in items]))
    weight = weights(index, terms, n_docs)
    queries = [(key, own, weight[np.searchsorted(terms, own)]) for key, own in items]
    held = index.sparkSession.sparkContext.broadcast([(key, own[w > 0], w[w > 0]) for key, own, w in queries if (w > 0).any()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        best: list[list[tuple[int, bool, int]]] = [[] for _ in held.value]  # (-score, no doc_id, doc_id) over the shards of this task
        for batch in batches:
            for i in range(batch.num_rows):
                own, own_rows, walk = _open(batch, i)
                ids = batch.column("doc_ids")[i].as_py()
                for place, (_, wanted, w) in enumerate(held.value):
                    at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                    there = own[at] == wanted
                    if there.any():
                        mine = best[place]
                        found, cols = walk.top(own_rows[at[there]], w[there], k, -mine[-1][0] if len(mine) == k else 1)
                        if len(found):
                            mine += [(-s, ids[c] is None, ids[c] or 0) for s, c in zip(found.tolist(), cols.tolist())]
                            mine.sort()
                            del mine[k:]
        keys = [key for (key, _, _), mine in zip(held.value, best) for _ in mine]
        rows = [row for mine in best for row in mine]
        yield pa.RecordBatch.from_arrays([
            pa.array(keys, pa.int64()), pa.array([None if missing else d for _, missing, d in rows], pa.int64()),
            pa.array([-s for s, _, _ in rows], pa.int64()), pa.array([TaskContext.get().partitionId()] * len(rows), pa.int32())],
            ["item_id", "doc_id", "score", "part"])

    return index.mapInArrow(run, HITS)


def ranked(index: DataFrame, items: DataFrame, counts: tuple[int, int], k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of the index for every item, blocks of items one after another."""
    spark = index.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES)
    path = new_path(spark, "ranked-hits")
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        if rows and counts[0]:
            with rows_a_batch(spark, 1):
                search_block(index, rows, counts[0], k).write.mode("append").parquet(path)
    hits = spark.read.schema(HITS).parquet(path) if blocks and counts[0] else spark.createDataFrame([], HITS)
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    group = F.pmod(F.xxhash64("part"), F.lit(64))
    part = hits.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", group).orderBy(*by))).where(F.col("rank") <= k)
    whole = part.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*by))).where(F.col("rank") <= k)
    return whole.select("item_id", "rank", "doc_id", "score")


def op13_k2_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score: the 50 best of all documents for each benchmark item."""
    docs = table(spark, sf_dir, "documents")
    with rows_a_batch(spark, 500):
        counts = corpus_counts(docs)
        path = new_path(spark, "treaps")
        index = build_index(docs, counts)
        index.write.options(**WRITING).parquet(path)
    return ranked(spark.read.schema(INDEX).parquet(path), table(spark, sf_dir, "benchmark"), counts)


OP13_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
filled AS (SELECT row_id, doc_id, terms, len(terms)::BIGINT AS n FROM split WHERE len(terms) > 0),
size AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM filled),
cells AS (SELECT row_id, term, count(*)::BIGINT AS tf FROM (SELECT row_id, unnest(terms) AS term FROM filled) GROUP BY ALL),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM cells GROUP BY term), size),
scored AS (
  SELECT item_id, row_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM wanted JOIN cells USING (term) JOIN weight USING (term) JOIN filled USING (row_id), size
  GROUP BY item_id, row_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored JOIN filled USING (row_id) WHERE score > 0
QUALIFY rank <= 50
"""

"""Best-fit packing by hierarchical residual rounds.

Token pieces are dealt into buckets of a few thousand by a hash of their key. Every bucket packs its pieces best-fit
in decreasing length. A bin that is nearly full is emitted. Of the others only those that can still be joined go up:
after best fit a bucket holds at most one bin that is half empty, so each bucket hands up that bin and its emptiest
others, as items, to the bucket above it (``FAN`` buckets each), where best fit runs again; the rest is emitted. The
rounds end when one bucket is left. Each bucket is bounded, whatever the input's size.

Null texts count as empty (one piece with the end id only). Ties in length are ordered by key, so a lost task packs
the same again; repeated rows are packed once each.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import modest_batches, table
from tidemark.llm.tokens import library_encoder, vocabulary
from tidemark.session import settle

CAPACITY = 1024
END_ID = 2
BUCKET_PIECES = 4096
FAN = 16
NEARLY_FULL = 1020

_PIECES = "row_id long, doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Open bins by room; the tightest bin that takes an item is found in a bit mask."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.mask = capacity, 0
        self.by_room: dict[int, list[int]] = defaultdict(list)
        self.used: list[int] = []

    def place(self, size: int) -> tuple[int, int]:
        """Bin and offset of an item."""
        fitting = self.mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = self.by_room[room].pop()
            if not self.by_room[room]:
                self.mask &= ~(1 << room)
        else:
            bin_, room = len(self.used), self.capacity
            self.used.append(0)
        offset = self.used[bin_]
        self.used[bin_] += size
        if (left := room - size) > 0:
            self.by_room[left].append(bin_)
            self.mask |= 1 << left
        return bin_, offset


def pack(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, best-fit by decreasing size; fill of every bin."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    fit = BestFit(capacity)
    for i in np.argsort(-sizes, kind="stable"):
        bins[i], offsets[i] = fit.place(int(sizes[i]))
    return bins, offsets, np.asarray(fit.used, dtype=np.int64)


def cut(n_tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first may be shorter."""
    head = n_tokens % capacity or min(n_tokens, capacity)
    starts = [0, *range(head, n_tokens, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n_tokens])]


def pieces(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document with the checksum of their ids; row_id tells repeated rows apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tail = library_encoder(vocabulary_path), np.uint32(END_ID).tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, row_id, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                             encoder(batch.column(2))):
                raw = found + tail
                rows += [(row_id, doc_id, k, a, n, zlib.crc32(raw[4 * a:4 * (a + n)]))
                         for k, (a, n) in enumerate(cut(len(raw) // 4, capacity))]
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = [c.split()[0] for c in _PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), "text").mapInArrow(run, _PIECES)


def _handed_up(fill: np.ndarray, last: bool) -> np.ndarray:
    """Bins that go to the next round: the half-empty one and the emptiest others, FAN at most."""
    if last:
        return np.zeros(0, np.int64)
    open_ = np.flatnonzero(fill < NEARLY_FULL)
    return open_[np.argsort(fill[open_], kind="stable")[:FAN]]


def best_fit(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (row_id, piece, length and more) with sequence_id and offset; items is read more than once, so settled."""
    buckets = max(1, -(-items.count() // BUCKET_PIECES))
    level, width = 0, buckets

    def first(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "row_id", "piece"], na_position="first", ignore_index=True)
        bins, offsets, fill = pack(part["length"].to_numpy(), capacity)
        part["bin"], part["offset"] = (key[0] << 32) + bins, offsets
        up = np.zeros(len(fill), bool)
        up[_handed_up(fill, buckets == 1)] = True
        part["fill"], part["up"] = fill[bins], up[bins]
        return part

    kept = items.columns
    placed = settle(items.withColumn("bucket", F.pmod(F.xxhash64("row_id", "piece"), F.lit(buckets))).groupBy("bucket").applyInPandas(
        first, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields])
        + ", bucket long, bin long, offset long, fill long, up boolean"), "packed")
    open_bins = placed.where("up").groupBy("bin").agg(F.first("fill").alias("fill"), F.first("bucket").alias("bucket"))
    moves = None  # bin -> target bin and the offset in it, one round after the other
    while width > 1:
        width, level = -(-width // FAN), level + 1
        last = width == 1

        def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(["fill", "bin"], ascending=[False, True], ignore_index=True)
            bins, offsets, fill = pack(part["fill"].to_numpy(), capacity)
            owner = part["bin"].to_numpy()[np.unique(bins, return_index=True)[1]]
            up = np.zeros(len(fill), bool)
            up[_handed_up(fill, last)] = True
            return pd.DataFrame({"bin": part["bin"], "target": owner[bins], "shift": offsets, "total": fill[bins],
                                 "up": up[bins], "bucket": key[0]})

        step = settle(open_bins.withColumn("bucket", F.floor(F.col("bucket") / FAN)).groupBy("bucket").applyInPandas(
            merge, "bin long, target long, shift long, total long, up boolean, bucket long"), f"packed-{level}")
        open_bins = step.where("up").groupBy(F.col("target").alias("bin")).agg(
            F.first("total").alias("fill"), F.first("bucket").alias("bucket"))
        if moves is None:
            moves = step.select("bin", "target", "shift")
        else:
            then = step.select(F.col("bin").alias("target"), F.col("target").alias("to"), F.col("shift").alias("more"))
            moves = settle(moves.join(then, "target", "left").select(
                "bin", F.coalesce("to", "target").alias("target"),
                (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")), f"moves-{level}")
    if moves is not None:
        placed = placed.join(moves, "bin", "left").withColumns({
            "bin": F.coalesce("target", "bin"), "offset": F.col("offset") + F.coalesce("shift", F.lit(0))})
    return placed.select(*kept, F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    found = settle(pieces(docs, vocabulary_path, capacity), "pieces")
    return best_fit(found, capacity).drop("row_id")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packing of all documents into sequences of at most 1024 tokens."""
    modest_batches(spark)
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary())

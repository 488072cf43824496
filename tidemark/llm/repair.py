"""Token-id files compressed by Re-Pair grammars.

Documents are dealt into shards by doc_id range, sorted, encoded, and cut into blocks of whole documents. Inside a
block frequent pairs of adjacent ids are replaced by nonterminals, again and again, until no pair is frequent; a pair
never spans two documents. A block is one row of a Parquet file: its documents, the place of each in the symbol
sequence, the rules (pairs) and the length of each rule's expansion, so one document, or a part of it, is decoded
without the others. Each round replaces all pairs at or above a frequency that halves from round to round.

Null texts count as empty: only the end id is stored. Repeated doc_ids are kept as separate documents in unspecified
order among themselves; null doc_ids come first. An empty table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import modest_batches, table
from tidemark.llm.tokens import library_encoder, vocabulary
from tidemark.session import new_path

END_ID = 2
VOCABULARY = 50257  # first nonterminal
BLOCK_TOKENS = 1 << 18
LEAST_FREQUENCY = 8
SHARD_BYTES = 32 << 20

FILE_SCHEMA = ("shard int, block int, n_docs int, n_tokens long, doc_ids binary, id_nulls binary, symbol_ends binary, "
               "rules binary, rule_lengths binary, symbols binary")


@dataclass
class Grammar:
    symbols: np.ndarray  # uint32
    ends: np.ndarray  # symbols up to the end of each document
    rules: np.ndarray  # (n, 2) uint32
    lengths: np.ndarray  # tokens of each rule


_SLOT_BITS = 17


def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A slot for each pair."""
    h = left * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h += right
    h *= np.uint32(0x85EBCA77)
    return (h >> np.uint32(32 - _SLOT_BITS)).astype(np.intp)


def _chosen(at: np.ndarray, rule: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending positions (and their rules) those that do not overlap: in a run of neighbours every second one, from its first."""
    if not len(at):
        return at, rule
    first = np.concatenate(([True], np.diff(at) > 1))
    run = at[first][np.cumsum(first) - 1]
    taken = (at - run) % 2 == 0
    return at[taken], rule[taken]


def compress(tokens: np.ndarray, ends: np.ndarray, base: int = VOCABULARY, least: int = LEAST_FREQUENCY) -> Grammar:
    """Replace frequent pairs of ``tokens`` (documents end at ``ends``) until none occurs ``least`` times."""
    seq, ends = tokens.astype(np.uint32), ends.astype(np.int64)
    last = np.zeros(len(seq), dtype=bool)
    last[ends - 1] = True
    rules: list[np.ndarray] = []
    lengths = np.zeros(0, dtype=np.uint32)
    frequency = max(least, len(seq) >> 9)
    while len(seq) > 1:
        slot = _slot(seq[:-1], seq[1:])
        busy = np.bincount(slot, minlength=1 << _SLOT_BITS) >= frequency  # a pair is no more frequent than its slot
        at = np.flatnonzero(busy.take(slot) & ~last[:-1])
        pairs = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
        found, counts = np.unique(pairs, return_counts=True)
        found = found[counts >= frequency]
        if len(found):
            left, right = (found >> np.uint64(32)).astype(np.uint32), found.astype(np.uint32)
            of_slot = np.zeros(1 << _SLOT_BITS, dtype=np.int32)
            of_slot[_slot(left, right)] = np.arange(len(found), dtype=np.int32)  # of several in a slot one; the others' turn comes later
            rule = of_slot.take(slot.take(at))
            wanted = found.take(rule) == pairs
            at, rule = _chosen(at[wanted], rule[wanted])
            keep = np.bincount(rule, minlength=len(found)) > 1
            number = np.cumsum(keep) - 1 + base + len(lengths)
            at, rule = at[keep[rule]], rule[keep[rule]]
            left, right = left[keep], right[keep]
            lengths = np.concatenate([lengths, _length(left, base, lengths) + _length(right, base, lengths)])
            rules.append(np.stack([left, right], axis=1))
            seq[at] = number[rule]
            last[at] = last[at + 1]
            stay = np.ones(len(seq), dtype=bool)
            stay[at + 1] = False
            seq, last = seq[stay], last[stay]
        if frequency == least and not len(found):
            break
        if frequency > least or not len(found):
            frequency = max(least, frequency // 2)
    return Grammar(seq, np.flatnonzero(last) + 1, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), lengths)


def _length(symbols: np.ndarray, base: int, lengths: np.ndarray) -> np.ndarray:
    out = np.ones(len(symbols), dtype=np.uint32)
    rule = symbols >= base
    out[rule] = lengths[symbols[rule].astype(np.int64) - base]
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, base: int = VOCABULARY) -> np.ndarray:
    """Tokens of some symbols; each pass opens every nonterminal once."""
    seq = np.asarray(symbols, dtype=np.uint32)
    while (rule := seq >= base).any():
        width = rule.astype(np.int64) + 1
        place = np.cumsum(width) - width
        out = np.empty(int(width.sum()), dtype=np.uint32)
        pair = rules[seq[rule].astype(np.int64) - base]
        out[place[~rule]] = seq[~rule]
        out[place[rule]], out[place[rule] + 1] = pair[:, 0], pair[:, 1]
        seq = out
    return seq


def expand_all(grammar: Grammar, base: int = VOCABULARY) -> np.ndarray:
    """All tokens of a grammar: every rule is opened once, then symbols are copied from the opened rules."""
    opened = expand(np.arange(base, base + len(grammar.rules), dtype=np.uint32), grammar.rules, base)
    starts = np.cumsum(grammar.lengths, dtype=np.int64) - grammar.lengths
    source = np.concatenate([opened, grammar.symbols])
    width = _length(grammar.symbols, base, grammar.lengths)
    ends = np.cumsum(width, dtype=np.int64)
    begin = np.arange(len(opened), len(source))
    rule = grammar.symbols >= base
    begin[rule] = starts[grammar.symbols[rule].astype(np.int64) - base]
    return source[np.repeat(begin - ends + width, width) + np.arange(ends[-1] if len(ends) else 0)]


def tokens_at(grammar: Grammar, doc: int, start: int, length: int, base: int = VOCABULARY) -> np.ndarray:
    """``length`` tokens of document number ``doc`` from ``start``, opening only the symbols that cover them."""
    symbols = grammar.symbols[grammar.ends[doc - 1] if doc else 0:grammar.ends[doc]]
    ends = np.cumsum(_length(symbols, base, grammar.lengths))
    low, high = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, start + length)
    skipped = int(ends[low - 1]) if low else 0
    return expand(symbols[low:high + 1], grammar.rules, base)[start - skipped:start - skipped + length]


def write_ids(docs: DataFrame, path: str, vocabulary_path: str, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write doc_id, text as grammar files in ascending doc_id order."""
    spark = docs.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def block(shard: int, number: int, ids: list, found: list[bytes]) -> dict:
        tail = np.uint32(END_ID).tobytes()
        tokens = np.frombuffer(b"".join(x + tail for x in found), dtype="<u4")
        g = compress(tokens, np.cumsum([len(x) // 4 + 1 for x in found]))
        return {"shard": shard, "block": number, "n_docs": len(ids), "n_tokens": len(tokens),
                "doc_ids": np.asarray([i or 0 for i in ids], dtype="<i8").tobytes(),
                "id_nulls": bytes(i is None for i in ids), "symbol_ends": g.ends.astype("<u4").tobytes(),
                "rules": g.rules.astype("<u4").tobytes(), "rule_lengths": g.lengths.astype("<u4").tobytes(),
                "symbols": g.symbols.astype("<u4").tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, number = library_encoder(vocabulary_path), TaskContext.get().partitionId(), 0
        ids, found, size = [], [], 0
        for batch in batches:
            for doc_id, coded in zip(batch.column(0).to_pylist(), encoder(batch.column(1))):
                ids.append(doc_id)
                found.append(coded)
                size += len(coded) // 4 + 1
                if size >= block_tokens:
                    yield pa.RecordBatch.from_pylist([block(shard, number, ids, found)], _arrow())
                    ids, found, size, number = [], [], 0, number + 1
        if ids:
            yield pa.RecordBatch.from_pylist([block(shard, number, ids, found)], _arrow())

    dealt = docs.select("doc_id", "text").repartitionByRange(width, "doc_id").sortWithinPartitions("doc_id")
    dealt.mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)


def _arrow() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in FILE_SCHEMA.split(", "))])


def _grammar(row: dict) -> Grammar:
    return Grammar(np.frombuffer(row["symbols"], "<u4"), np.frombuffer(row["symbol_ends"], "<u4").astype(np.int64),
                   np.frombuffer(row["rules"], "<u4").reshape(-1, 2), np.frombuffer(row["rule_lengths"], "<u4"))


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and (on request) ids of every stored document."""
    blocks = spark.read.schema(FILE_SCHEMA).parquet(path)
    schema = "shard int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                g = _grammar(row)
                tokens = expand_all(g)
                per_symbol = np.cumsum(_length(g.symbols, VOCABULARY, g.lengths), dtype=np.int64)
                ends = per_symbol[g.ends - 1]
                starts = np.concatenate(([0], ends[:-1]))
                raw, n = tokens.astype("<u4").tobytes(), len(ends)
                ids = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.frombuffer(row["id_nulls"], np.uint8) > 0)
                columns = [pa.array(np.full(n, row["shard"], np.int32)), pa.array(np.full(n, row["block"], np.int32)), ids,
                           pa.array(starts), pa.array(ends - starts),
                           pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64())]
                names = ["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = np.concatenate(([0], ends)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    # Ids before a block: inside its shard by a window per shard; before the shard by a window over one row per shard.
    sizes = blocks.select("shard", "block", "n_tokens")
    in_shard = sizes.withColumn("before", F.coalesce(F.sum("n_tokens").over(
        Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn("earlier", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    starts = in_shard.join(shards, "shard").select("shard", "block", (F.col("before") + F.col("earlier")).alias("before"))
    shown = ["doc_id", (F.col("inside") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids]
    return blocks.mapInArrow(run, schema).join(starts, ["shard", "block"]).select(*shown)


def op2_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 as read back from the written files."""
    modest_batches(spark)
    path = new_path(spark, "repair-ids")
    write_ids(table(spark, sf_dir, "documents"), path, vocabulary())
    return read_ids(spark, path, with_ids=False)

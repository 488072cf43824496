"""Byte-level BPE by a priority queue of merge ranks over a doubly linked symbol list.

encode: every byte of a pre-token is a symbol; adjacent pairs wait in a heap by (rank, position). The best pair is
merged into its left symbol, its new neighbours enter the heap, and entries whose symbols have changed are skipped.
Frequent pre-tokens are remembered. decode: the vocabulary's byte strings are concatenated, for a whole batch at once.

Null texts count as empty and give no ids. Repeated rows give the same ids; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import modest_batches, table
from tidemark.llm.tokens import ChunkEncoder, vocabulary

#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


# Memory bounds only, for the workers of all cores of an executor together: the latest ones are remembered.
KEPT_PRE_TOKENS = 100_000
KEPT_CHUNKS = 500_000
BATCH_ROWS = 500


class BytePairCodec:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab, letters = file["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.of_byte = [0] * 256
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        self.rules: list[tuple[int, int, int]] = []  # left, right and merged id by rank
        none: dict[int, int] = {}
        self.ranks = [none] * size  # by left id: rank << 32 of each right id
        for rank, merge in enumerate(file["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = vocab[left], vocab[right]
            self.rules.append((a, b, vocab[left + right]))
            if self.ranks[a] is none:
                self.ranks[a] = {}
            self.ranks[a][b] = rank << 32
        self._pre_token = regex.compile(PRE_TOKEN)
        self._merged = lru_cache(maxsize=KEPT_PRE_TOKENS)(lambda word: self._merge(word.encode()))
        self._bytes = pa.array(self.strings, pa.large_binary())
        self._at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _merge(self, raw: bytes) -> list[int]:
        ids = [self.of_byte[b] for b in raw]
        n, ranks, rules = len(ids), self.ranks, self.rules
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [m | i for i, (a, b) in enumerate(zip(ids, ids[1:])) if (m := ranks[a].get(b)) is not None]
        heapq.heapify(queue)  # an entry is rank << 32 | position
        while queue:
            entry = heapq.heappop(queue)
            left, right, new = rules[entry >> 32]
            i = entry & 0xFFFFFFFF
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:  # stale
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (m := ranks[new].get(ids[k])) is not None:
                    heapq.heappush(queue, m | i)
            if (h := before[i]) >= 0 and (m := ranks[ids[h]].get(new)) is not None:
                heapq.heappush(queue, m | h)
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self._at_special.split(text) if self._at_special else [text]:
            if piece in self.special:
                out.append(self.special[piece])
            else:
                for word in self._pre_token.findall(piece):
                    out += self._merged(word)
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(self.encode(t), dtype="<u4").tobytes() for t in texts]

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", errors="replace")

    def decode_many(self, ids: pa.ListArray) -> list[str | None]:
        """The text of every list; null for a null one."""
        found = self._bytes.take(ids.flatten())
        at = np.frombuffer(found.buffers()[1], np.int64)[found.offset:found.offset + len(found) + 1]
        raw = found.buffers()[2].to_pybytes() if len(found) else b""
        ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(ids), 0).to_pylist()])
        ends = at[ends].tolist() if len(found) else [0] * len(ends)
        return [raw[a:b].decode("utf-8", errors="replace") if there else None
                for a, b, there in zip(ends, ends[1:], ids.is_valid().to_pylist())]


@lru_cache(maxsize=2)
def codec(path: str) -> tuple[BytePairCodec, ChunkEncoder]:
    """One codec and chunk cache per Python worker."""
    own = BytePairCodec(path)
    return own, ChunkEncoder(own.encode_many, list(own.special), KEPT_CHUNKS)


def _with(batch: pa.RecordBatch, name: str, found: pa.Array, drop: str | None = None) -> pa.RecordBatch:
    """``batch`` with a column in the place of ``name``, at its end."""
    kept = [(c, n) for c, n in zip(batch.columns, batch.schema.names) if n not in (name, drop)]
    return pa.RecordBatch.from_arrays([*(c for c, _ in kept), found], [*(n for _, n in kept), name])


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, text: str, out: str, keep_text: bool = True) -> Iterator[pa.RecordBatch]:
    own = codec(path)[1]
    for batch in batches:
        found = own(batch.column(text))
        ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), dtype="<i4")))
        yield _with(batch, out, ids, None if keep_text else text)


def decode_batches(batches: Iterator[pa.RecordBatch], path: str, ids: str, out: str) -> Iterator[pa.RecordBatch]:
    own = codec(path)[0]
    for batch in batches:
        yield _with(batch, out, pa.array(own.decode_many(batch.column(ids)), pa.string()))


def _added(df: DataFrame, *more: T.StructField, drop: str | None = None) -> T.StructType:
    names = {f.name for f in more} | {drop}
    return T.StructType([*(f for f in df.schema.fields if f.name not in names), *more])


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the token ids of its text."""
    ids = T.StructField(out, T.ArrayType(T.IntegerType()))
    return df.mapInArrow(lambda batches: encode_batches(batches, path, text, out), _added(df, ids))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids (null ids: null)."""
    return df.mapInArrow(lambda batches: decode_batches(batches, path, ids, out), _added(df, T.StructField(out, T.StringType())))


def there_and_back(df: DataFrame, path: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ids and the text that they decode to in the place of its text: both in one Python worker a task."""
    fields = T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(out, T.StringType())
    return df.mapInArrow(lambda batches: decode_batches(encode_batches(batches, path, text, ids, False), path, ids, out),
                         _added(df, *fields, drop=text))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    modest_batches(spark, BATCH_ROWS)
    path = vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = there_and_back(docs, path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))

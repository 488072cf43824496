"""Exact tokenisation of whole texts by chunks that a cache holds.

The pre-tokenizer never lets a token cross a single space, except inside a run of white space. So a text is cut
before such spaces, each distinct chunk is encoded once per worker, and the ids of a text are the joined ids of its
chunks. Texts for which the cut could matter (special token, control separators) are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_CHUNKS = 1_000_000  # a memory bound only: the chunks used last are kept, half of them for sure

JOINED = 256

_SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"  # of texts without control separators
_RUN = rf"{_SPACE} (?:{_SPACE}|\z)"
_CUT = re.compile(r" (?=\S)|(?<!\s) ")
_ODD = r"[\x1c-\x1f]"

EncodeMany = Callable[[list[str]], list[bytes]]


def chunks(text: str) -> list[str]:
    """Parts between the spaces at which cutting is safe: ' '.join(parts) is the text."""
    return _CUT.split(text) if _RUN.search(text) else text.split(" ")


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, encode_many: EncodeMany, special: Sequence[str], limit: int = CACHED_CHUNKS) -> None:
        self._encode, self._special, self._limit = encode_many, tuple(special), limit
        self._inner: list[dict[str, bytes]] = [{}, {}]  # chunks used since the last turn, and those of the turn before
        self._first: list[dict[str, bytes]] = [{}, {}]

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts have a special token or control separators (2), or spaces at which cutting is not safe (1)."""
        whole = pc.match_substring_regex(texts, _ODD)
        for s in self._special:
            whole = pc.or_(whole, pc.match_substring(texts, s))
        return np.where(whole, 2, np.asarray(pc.match_substring_regex(texts, _RUN), np.int8))

    def _known(self, cache: list[dict[str, bytes]], wanted: list[str], lead: str) -> list[bytes]:
        """The ids of distinct chunks, kept for the next call."""
        recent, before = cache
        found = list(map(recent.get, wanted))
        holes = [i for i, ids in enumerate(found) if ids is None]
        keys = [wanted[i] for i in holes]
        fresh = list(map(before.get, keys)) if before else [None] * len(holes)
        new = [j for j, ids in enumerate(fresh) if ids is None]
        for j, ids in zip(new, self._encode([lead + keys[j] for j in new]), strict=True):
            fresh[j] = ids
        for i, ids in zip(holes, fresh):
            found[i] = ids
        if len(recent) + len(holes) > self._limit // 2:
            cache[:] = [{}, recent]
        if len(holes) <= self._limit // 2:
            cache[0].update(zip(keys, fresh))
        return found

    def _of_chunks(self, lists: pa.ListArray) -> list[bytes]:
        """Ids of texts given as lists of their chunks: each distinct chunk is looked up once."""
        parts = lists.flatten().dictionary_encode()
        wanted, place = parts.dictionary.to_numpy(zero_copy_only=False).tolist(), parts.indices.to_numpy().astype(np.int64)
        ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
        heads, head = np.unique(place[ends[:-1]], return_inverse=True)
        place[ends[:-1]] = len(wanted) + head
        ids = self._known(self._inner, wanted, " ") + self._known(self._first, [wanted[i] for i in heads], "")
        found = pa.array(ids, pa.large_binary()).take(pa.array(place))
        at = np.frombuffer(found.buffers()[1], np.int64)[ends].tolist()
        raw = memoryview(found.buffers()[2] or b"")
        return [bytes(raw[a:b]) for a, b in zip(at, at[1:])]

    def __call__(self, texts: Sequence[str | None] | pa.Array) -> list[bytes]:
        """A null text is an empty one."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = pc.fill_null(texts, "")
        out: list[bytes] = [b""] * len(texts)
        odd = self._odd(texts)

        def put(kind: int, encode: Callable[[pa.Array], list[bytes]]) -> None:
            at = np.flatnonzero(odd == kind)
            if len(at):
                for i, ids in zip(at.tolist(), encode(texts.take(pa.array(at))), strict=True):
                    out[i] = ids

        put(0, lambda some: self._of_chunks(pc.split_pattern(some, " ")))
        put(1, lambda some: self._of_chunks(pa.array(map(_CUT.split, some.to_pylist()), pa.list_(pa.string()))))
        put(2, lambda some: self._encode(some.to_pylist()))
        return out


@lru_cache(maxsize=2)
def library_encoder(path: str) -> ChunkEncoder:
    """The tokenizers library with a public vocabulary file, one per Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    special = [t["content"] for t in rules["added_tokens"]]
    whole_bytes = rules.get("normalizer") is None and (rules.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
    spaced = np.zeros(tool.get_vocab_size(with_added_tokens=True), dtype=bool)  # tokens whose first byte is a space
    for token, i in tool.get_vocab(with_added_tokens=False).items():
        spaced[i] = whole_bytes and token.startswith("\u0120")

    def encode_many(texts: list[str]) -> list[bytes]:
        """Many short texts in one call: what starts with its only space is cut there again, else the special token,
        whose id no other text gives, ends each."""
        if not special or any(s in "".join(texts) for s in special):
            return [np.asarray(e.ids, dtype="<u4").tobytes() for e in tool.encode_batch_fast(texts, add_special_tokens=False)]
        mark, out = tool.token_to_id(special[0]), []
        groups = [texts[at:at + JOINED] for at in range(0, len(texts), JOINED)]
        listed = ["\0".join(some) for some in groups]
        joined = pa.array([x.replace("\0", "") for x in listed], pa.large_string())
        unsafe = pc.or_(pc.match_substring_regex(joined, _ODD), pc.match_substring_regex(joined, _RUN)).to_pylist()
        for some, text, odd in zip(groups, listed, unsafe):
            n = len(some)
            spaces = text.count("\0") + 1 == text.count("\0 ") + 1 == text.count(" ") == n and text[0] == " "
            if spaces and not odd:
                ids = np.asarray(tool.encode_batch_fast([text.replace("\0", "")], add_special_tokens=False)[0].ids, dtype="<u4")
                raw, starts = ids.tobytes(), (np.flatnonzero(spaced[ids]) * 4).tolist()
                if len(starts) == n:
                    out += [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)])]
                    continue
            ids = np.asarray(tool.encode_batch_fast([special[0].join([*some, ""])], add_special_tokens=False)[0].ids, dtype="<u4")
            raw, ends = ids.tobytes(), (np.flatnonzero(ids == mark) * 4).tolist()
            out += [raw[a:b] for a, b in zip([0, *(e + 4 for e in ends)], ends)]
        return out

    return ChunkEncoder(encode_many, special)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

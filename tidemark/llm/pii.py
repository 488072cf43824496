"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Four base kinds are always reported when their own test holds. Three more kinds are added by the method, each only
with a score of at least ``threshold``: iban (mod-97), ssn and secret (context words). A span's score starts from its
kind, gains from a passed checksum and from a kind's context word within ``reach`` code points before it.

Null texts count as empty and have no spans; texts are searched whole; ties are ordered by start, then kind. Time grows with
the length of a text, also for long runs of one sort of characters: an email is searched outward from each @, an ip only from
the start of a run of digits, a secret as a whole run. A column that would clash with ``pii`` raises an error.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import modest_batches, table

REACH = 40
THRESHOLD = 0.6
BASE_KINDS = ("email", "ip", "card", "phone")

_DIGITS = re.compile("[^0-9]")
_HAS_DIGIT = re.compile("[0-9]")


def luhn(text: str) -> bool:
    digits = _DIGITS.sub("", text)
    doubled = (d * 2 - 9 if d > 4 else d * 2 for d in map(int, digits[-2::-2]))
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def mod_97(text: str) -> bool:
    """ISO 13616: first four characters to the end, letters as 10 to 35, remainder 1."""
    plain = text.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _ip(text: str) -> bool:
    plain = [p.lstrip("0") or "0" for p in text.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in plain)


def _card(text: str) -> bool:
    return 12 <= len(_DIGITS.sub("", text)) <= 19 and luhn(text)


def _phone(text: str) -> bool:
    return 9 <= len(_DIGITS.sub("", text)) <= 15


def _ssn(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_RUN = re.compile(r"[A-Za-z0-9_-]{20,}+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost spans of local part, @ and domain: the local part reaches back to the last @ or span at most."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        floor = domain.end() if domain else at + 1
        if domain:
            yield start, domain.end()
        at = text.find("@", floor)


def matches(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text))


def secrets(text: str) -> Iterator[tuple[int, int]]:
    """Runs of 20 or more letters, digits, _ and -, with a digit; without hyphens at the ends."""
    for m in _RUN.finditer(text):
        core = m[0].strip("-")
        if len(core) >= 20 and _HAS_DIGIT.search(core):
            start = m.start() + len(m[0]) - len(m[0].lstrip("-"))
            yield start, start + len(core)


@dataclass(frozen=True)
class Kind:
    name: str
    propose: Callable[[str], Iterator[tuple[int, int]]]
    hint: str  # a character without which the pattern cannot match; empty: none
    valid: Callable[[str], bool] | None
    start: float
    checked: float
    words: tuple[str, ...]


KINDS = (
    Kind("email", emails, "@", None, 0.8, 0.0,
         ("mail", "contact", "correo", "courriel")),
    Kind("ip", matches(re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")), ".", _ip, 0.4, 0.3, ("ip", "server", "host", "address")),
    Kind("card", matches(re.compile(r"[0-9](?:[\x20-]?[0-9])+")), "", _card, 0.3, 0.5,
         ("card", "visa", "carte", "karte", "tarjeta")),
    Kind("phone", matches(re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")), "+", _phone, 0.5, 0.2,
         ("tel", "phone", "call", "mobile", "fax")),
    Kind("iban", matches(re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")), "", mod_97, 0.2, 0.6,
         ("iban", "account", "konto", "compte", "cuenta")),
    Kind("ssn", matches(re.compile(r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b")), "-", _ssn, 0.2, 0.2, ("ssn", "social", "security")),
    Kind("secret", secrets, "", None, 0.3, 0.0,
         ("token", "key", "secret", "password", "passwd", "bearer")),
)
ORDER = {k.name: i for i, k in enumerate(KINDS)}

_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                      T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])


def spans_of(text: str | None, threshold: float = THRESHOLD, reach: int = REACH) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, end exclusive, by start and then kind."""
    if not text:
        return []
    digits = _HAS_DIGIT.search(text) is not None
    found = []
    for kind in KINDS:
        if kind.hint not in text or not (digits or kind.name == "email"):
            continue
        for start, end in kind.propose(text):
            if kind.valid and not kind.valid(text[start:end]):
                continue
            before = text[max(0, start - reach):start].lower()
            score = kind.start + kind.checked + 0.3 * any(w in before for w in kind.words)
            if kind.name in BASE_KINDS or score >= threshold:
                found.append((kind.name, start, end, round(min(score, 1.0), 6)))
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def redact(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    """Each span becomes <KIND>; of overlapping spans the earlier one names the place."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _digest(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans)


def find_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``pii``, an array of (kind, start, end, score)."""
    kept = df.columns
    if "pii" in kept:
        raise ValueError("the table has a column named pii: rename it first")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[dict(zip(("kind", "start", "end", "score"), s)) for s in spans_of(t)]
                    for t in batch.column(kept.index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), pa.array(rows, kind)],
                                             [*kept, "pii"])

    shown = df.select(*[f"`{c}`" for c in kept])
    return shown.mapInArrow(run, T.StructType([*shown.schema.fields, T.StructField("pii", T.ArrayType(_SPAN))]))


def redact_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of its text replaced by <KIND>; texts without a span stay as they are."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [redact(t, spans_of(t)) for t in batch.column(names.index(text)).to_pylist()]
            columns = [pa.array(clean, pa.string()) if n == text else batch.column(i) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(run, df.schema)


def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the four base counts, base_sha256 and all spans of every document."""
    modest_batches(spark)
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def of(*kinds):
        return F.filter("pii", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(of(*BASE_KINDS)), 256).alias("base_sha256"),
                        joined(F.col("pii")).alias("spans"), F.to_json("pii").alias("scored"))

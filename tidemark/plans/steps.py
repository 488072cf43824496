"""Resumable steps: every result is published under a name, with a manifest, and a rerun skips what is unchanged.

A step's digest covers the library's sources, its name, its settings, the steps it needs (by their digests) and the tables it reads. A table is
told by its schema, its plan and the names, sizes and times of its files; rows that are in no file are told by their count and
hashes. The result is written to a new folder first. Then the pointer ``<folder>/<step>/CURRENT``, the step's manifest, is replaced by
one rename (local disks, which have no renaming over a file, delete the old pointer just before), so a reader has the old result or
the new one, never a part, and a run that was stopped goes on behind the last step that was published. The result before the last one stays for readers that still hold it; older ones are deleted.
"""

from __future__ import annotations

import hashlib
import json
import re
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, is_dataclass
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"
_RUNNING = re.compile(r"#\d+L?|_pyspark_[0-9a-f]{32}|(?<=\b[xyz])_\d+\b")  # numbers that differ from one session to the next


_STEPS: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)  # one thread of a driver at a time works on a step


@cache
def code_digest() -> str:
    """The sources of this package: results of other code are not taken for those of this one."""
    top = Path(__file__).resolve().parents[1]
    held = hashlib.sha256()
    for path in sorted(p for p in top.rglob("*.py") if p.relative_to(top).parts[0] != "llm"):
        held.update(str(path.relative_to(top)).encode() + path.read_bytes())
    return held.hexdigest()


def _sha(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=lambda x: asdict(x) if is_dataclass(x) else str(x)).encode()).hexdigest()


def table_digest(df: DataFrame) -> str:
    """What a table is made of, without running it where its rows come from files alone."""
    plan = _RUNNING.sub("", df._jdf.queryExecution().analyzed().treeString(True, False, 1 << 30, False, False))  # no list cut short
    if re.search(r"LocalRelation|LogicalRDD|InMemoryRelation", plan) or not df.inputFiles():
        bits = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).alias("x"),
                      F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")).cast("string").alias("s")).first()
        return _sha(df.schema.json(), list(bits))
    return _sha(df.schema.json(), plan, sorted(_file_facts(df.sparkSession, path) for path in df.inputFiles()))


def _file_facts(spark: SparkSession, path: str) -> list:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
    return [path, status.getLen(), status.getModificationTime()]


class Steps:
    """The published results of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.ran: list[str] = []  # steps that this run had to do
        self._stopped = threading.Event()

    # --- small files, by the file system that Spark has for the folder

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))

    def _files(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _put(self, text: str, *parts: str) -> None:
        """Replace a small file by one rename."""
        jvm, target = self.spark._jvm, self._path(*parts)
        temporary = self._path(*parts[:-1], f".{uuid.uuid4().hex}")
        out = self._files().create(temporary, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        rename = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri() if temporary.toUri().getScheme() else self._files().getUri(),
                                                            self.spark._jsc.hadoopConfiguration()).rename(temporary, target, rename)

    def manifest(self, name: str) -> dict | None:
        """Digest, settings, path and rows of the published result of a step."""
        place = self._path(name, POINTER)
        if not self._files().exists(place):
            return None
        stream = self._files().open(place)
        try:
            text = bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        return json.loads(text)

    # --- steps

    def stop(self) -> None:
        """No further step begins in this run; those that are being built are still published."""
        self._stopped.set()

    def run(self, name: str, build: Callable[[str], Mapping | None], settings: object = None, tables: Mapping[str, DataFrame] | None = None,
            needs: Sequence[str] = ()) -> dict:
        """The manifest of a step; ``build`` writes into the folder it is given, unless the published result is of the same digest."""
        with _STEPS[f"{self.folder}/{name}"]:
            if self._stopped.is_set():
                raise RuntimeError(f"{name} was not begun: the run was stopped")
            return self._run(name, build, settings, tables, needs)

    def _run(self, name: str, build: Callable[[str], Mapping | None], settings: object, tables: Mapping[str, DataFrame] | None,
             needs: Sequence[str]) -> dict:
        wanted = _sha(code_digest(), name, settings, {k: table_digest(df) for k, df in (tables or {}).items()}, {n: self.manifest(n)["digest"] for n in needs})
        now = self.manifest(name)
        if now and now["digest"] == wanted:
            return now
        path = f"{self.folder}/{name}/{uuid.uuid4().hex}"
        facts = dict(build(path) or {})
        made = {"step": name, "digest": wanted, "path": path, "settings": json.loads(json.dumps(
            settings, default=lambda x: asdict(x) if is_dataclass(x) else str(x))), "previous": now and now["path"], **facts}
        self._put(json.dumps(made), name, POINTER)
        self.ran.append(name)
        if now and now.get("previous"):
            self._files().delete(self.spark._jvm.org.apache.hadoop.fs.Path(now["previous"]), True)
        return made

    def table(self, name: str, build: Callable[[], DataFrame], settings: object = None, tables: Mapping[str, DataFrame] | None = None,
              needs: Sequence[str] = ()) -> DataFrame:
        """A step whose result is a table."""
        def write(path: str) -> dict:
            df = build()
            df.write.parquet(path)
            return {"rows": self.spark.read.schema(df.schema).parquet(path).count(), "schema": df.schema.json()}

        self.run(name, write, settings, tables, needs)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        from pyspark.sql.types import StructType

        made = self.manifest(name)
        return self.spark.read.schema(StructType.fromJson(json.loads(made["schema"]))).parquet(made["path"])

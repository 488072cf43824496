"""Corpus cleaning in stages; each works on all that the one before it kept.

quality rules -> n-gram Jaccard join (one document of each group stays) -> substring dedup -> PII -> best-fit packing.

Rows with a null text, or without a word, fail the quality rules. Repeated rows of one doc_id and text count as one in
the Jaccard join and one of them stays; other texts under that doc_id are documents of their own. The near-duplicate
stage takes five words and a similarity of 0.8. A text from which passages were cut goes when no word is left. Columns
that a table has besides, of any name, are carried along up to the last stage, which returns pieces.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.llm import jaccard, packing, passages, pii, quality  # noqa: E402
from tidemark.llm.shipping import ship  # noqa: E402
from tidemark.llm.text import modest_batches  # noqa: E402
from tidemark.llm.tokens import vocabulary  # noqa: E402
from tidemark.session import new_path, tune  # noqa: E402


def _ready(spark: SparkSession) -> None:
    ship(tune(spark))
    modest_batches(spark)


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it now is, where the table has it."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of the table has them."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    _ready(spark)
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held")
    judged = quality.judge(docs.select("doc_id", "text", held), quality.trusted_documents(spark, sf_dir))
    return judged.where("kept").select("held.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document with the smallest doc_id of each group; rows with a null doc_id stay."""
    _ready(spark)
    doc, th = _free(docs, "nd_doc", "nd_th")
    found = jaccard.components(docs, n=5, percent=80).where("leads AND doc_id IS NOT NULL")
    stay = found.select(F.col("doc_id").alias(doc), F.col("th").alias(th)).distinct()
    named = docs.join(stay, (F.col("doc_id") == F.col(doc)) & F.xxhash64("text").eqNullSafe(F.col(th)), "left_semi")
    one = named.withColumn(th, F.xxhash64("text")).dropDuplicates(["doc_id", th]).drop(th)
    return one.unionByName(docs.where("doc_id IS NULL"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that earlier documents hold; a document without any words left goes."""
    _ready(spark)
    doc, th, kept = _free(docs, "rp_doc", "rp_th", "rp_kept")
    changed = passages.repeats(docs).select(F.col("doc_id").alias(doc), F.col("th").alias(th), F.col("kept_text").alias(kept))
    joined = docs.join(changed, (F.col("doc_id") == F.col(doc)) & (F.xxhash64("text") == F.col(th)), "left")
    cut = joined.withColumn("text", F.coalesce(kept, "text")).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _counted(cut.select(*[f"`{c}`" for c in docs.columns]))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span of personal data replaced by its kind."""
    _ready(spark)
    return _counted(pii.redact_pii(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents packed into sequences of at most 1024 tokens."""
    _ready(spark)
    return packing.pack_documents(docs, vocabulary())


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("personal_data", personal_data), ("packing", pack)]
ORACLE_SQL = None  # tokens, and hashes by Spark's own functions, have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

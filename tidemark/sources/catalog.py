"""Saved tables, parameterised SQL and the catalogue listing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reload_tables(spark: SparkSession, tables: Mapping[str, DataFrame], database: str, folder: str) -> list[str]:
    """Replace every table of the database. Spark has no foreign keys, so the order does not matter."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in tables.items():
        df.write.mode("overwrite").option("path", f"{folder}/{name}").saveAsTable(f"{database}.{name}")
    return [f"{database}.{name}" for name in tables]


def load_scores(spark: SparkSession, scores_path: str, database: str, folder: str) -> bool:
    """The score mart, only when it has been published."""
    try:
        scores = spark.read.parquet(scores_path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return False
        raise
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    reload_tables(spark, {"ml_customer_scores": scores}, database, folder)
    return True


def query_df(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None, **tables: DataFrame) -> DataFrame:
    """SQL with named markers; ``{name}`` in the text stands for a given DataFrame."""
    return spark.sql(sql, args=dict(params or {}), **tables)


def schema_catalog(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, columns) of the saved tables, read from the catalogue only."""
    rows = [(t.name, [c.name for c in spark.catalog.listColumns(f"{database}.{t.name}")])
            for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(sorted(rows), "table_name string, columns array<string>")


def schema_text(catalog: DataFrame) -> DataFrame:
    return catalog.select(F.format_string("%s(%s)", "table_name", F.array_join("columns", ", ")).alias("line")).orderBy("line")

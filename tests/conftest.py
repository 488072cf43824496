import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tidemark-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
               .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)


@pytest.fixture(scope="session")
def make(spark):
    """Rows from VALUES text: make('a int, d date', (1, '2024-01-01'), ...)."""
    def build(schema, *rows):
        kinds = [c.split()[1] if "(" not in c else c.split(maxsplit=1)[1] for c in _columns(schema)]
        raw = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows],
                                    ", ".join(f"{n} string" for n in [c.split()[0] for c in _columns(schema)]))
        return raw.selectExpr(*[f"CAST({c.split()[0]} AS {k}) AS {c.split()[0]}" for c, k in zip(_columns(schema), kinds)])
    return build


def _columns(schema):
    parts, depth, now = [], 0, ""
    for ch in schema:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(now.strip())
            now = ""
        else:
            now += ch
    return [*parts, now.strip()]

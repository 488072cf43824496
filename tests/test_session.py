"""Session settings."""

from tidemark.session import settle, tune

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


def test_a_table_of_many_rows_in_small_files_is_not_broadcast(spark):
    inner = spark.newSession()
    inner.conf.unset(LIMIT)
    tune(inner)
    few = settle(inner.range(800_000).selectExpr("id AS customer_id", "CAST('2020-01-01' AS date) AS day"), "test-anchors")
    many = settle(inner.range(3_000_000).selectExpr("id % 800000 AS customer_id", "id AS event"), "test-events")
    size = int(few._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert size < 10 << 20  # Spark alone would broadcast it
    joined = many.join(few, "customer_id").groupBy("day").count()
    assert joined.collect()[0]["count"] == 3_000_000
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def test_limits_of_the_session_that_are_smaller_stay(spark):
    inner = spark.newSession()
    for limit, kept in (("256k", "256k"), ("-1", "-1"), ("20m", str(1 << 20))):
        inner.conf.set(LIMIT, limit)
        assert tune(inner).conf.get(LIMIT) == kept

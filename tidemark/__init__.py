"""Subscription analytics as Spark DataFrame, SQL and MLlib jobs."""

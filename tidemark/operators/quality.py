"""Cleaning and data quality. Nothing is silently repaired: what is changed is counted."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import count_if
from tidemark.functions.intervals import as_of
from tidemark.functions.ordering import exact_percentiles
from tidemark.schemas import DATE_COLUMNS, PRIMARY_KEYS, RULES, SCHEMAS

# The accepted spellings of each country and device, compared trimmed and in lower case.
COUNTRY_SPELLINGS: dict[str, list[str]] = {
    "United States": ["us", "usa", "u.s.a", "united states"],
    "United Kingdom": ["uk", "u.k.", "britain", "united kingdom"],
    "India": ["in", "india", "bharat"],
    "United Arab Emirates": ["uae", "u.a.e", "united arab emirates"],
    "Canada": ["ca", "canada"],
    "Australia": ["au", "australia"],
    "Germany": ["de", "germany"],
    "France": ["fr", "france"],
    "Spain": ["es", "spain"],
    "Italy": ["it", "italy"],
    "Japan": ["jp", "japan"],
    "South Korea": ["kr", "s. korea", "south korea"],
    "Mexico": ["mx", "mexico"],
    "Brazil": ["br", "brazil"],
    "Argentina": ["ar", "argentina"],
    "South Africa": ["za", "south africa"],
    "Nigeria": ["ng", "nigeria"],
    "Philippines": ["ph", "philippines"],
    "Indonesia": ["id", "indonesia"],
    "Poland": ["pl", "poland"],
}
DEVICE_SPELLINGS: dict[str, list[str]] = {
    "Mobile": ["mobile", "phone", "smartphone"],
    "Tablet": ["tablet", "ipad"],
    "Laptop": ["laptop", "desktop", "pc"],
    "Smart TV": ["smart tv", "smarttv", "tv"],
    "Gaming Console": ["gaming console", "console", "playstation/xbox"],
}
UNKNOWN = "Unknown"


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the first by ``order``. Spark drops repeats per task before the shuffle."""
    first = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def duplicates_removed(df: DataFrame, key: str) -> DataFrame:
    """C01 count: rows beyond the first of their key, from one count per key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("removed"))


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _title(c: Column) -> Column:
    """Capital after every non-letter, small letters elsewhere."""
    words = F.split(F.lower(c), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), "")


def canonical(df: DataFrame, column: str, spellings: Mapping[str, Sequence[str]], missing: str | None = None) -> DataFrame:
    """Accepted spelling, else Title Case; NULL becomes ``missing``."""
    pairs = [F.lit(text) for name, aliases in spellings.items() for alias in aliases for text in (alias, name)]
    accepted = df.sparkSession.range(1).select(F.explode(F.create_map(*pairs)).alias("_alias", "_name"))  # fixed list
    tidy = _stripped(F.col(column))
    found = df.withColumn("_key", F.lower(tidy)).join(F.broadcast(accepted), F.col("_key") == F.col("_alias"), "left")
    value = F.coalesce("_name", _title(tidy))
    if missing is not None:
        value = F.coalesce(value, F.lit(missing))
    return found.withColumn(column, value).drop("_key", "_alias", "_name")


def valid_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Values outside the range become NULL."""
    return df.withColumn(column, F.when(F.col(column).between(low, high), F.col(column)))


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.agg(count_if(~F.col(column).between(low, high)).alias("invalid"))


def impute_median(df: DataFrame, column: str, group: str, whole_numbers: bool = False) -> DataFrame:
    """Median of the group, else of the table. Medians are taken over the known values of a
    column with few distinct values (ages, percentages), of which Spark keeps counts only."""
    medians = df.groupBy(F.col(group).alias("_group")).agg(F.median(column).alias("_median"))
    overall = df.agg(F.median(column)).scalar()
    joined = df.join(medians, F.col(group).eqNullSafe(F.col("_group")), "left")
    value = F.coalesce(F.col(column).cast("double"), F.col("_median"), overall)
    if whole_numbers:
        value = F.bround(value, 0).cast("int")
    return joined.withColumn(column, value).drop("_group", "_median")


def most_frequent(df: DataFrame, column: str, default: str) -> Column:
    """Ties go to the smallest value."""
    top = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.desc("_n"), column).limit(1).select(column))
    return F.coalesce(top.scalar(), F.lit(default))


def impute_mode(df: DataFrame, column: str, default: str = "English") -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), most_frequent(df, column, default)))


def parse_dates(df: DataFrame, columns: Iterable[str], pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Malformed dates become NULL."""
    return df.withColumns({c: F.try_to_date(c, pattern) for c in columns if c in df.columns})


def bad_dates(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd") -> DataFrame:
    """C09 count: missing and malformed together."""
    return df.agg(count_if(F.try_to_date(column, pattern).isNull()).alias("bad_dates"))


def upper_tail(df: DataFrame, columns: Sequence[str], p: float = 0.995, **cutting) -> DataFrame:
    """(measure, value) of an interpolated high percentile; outliers stay in the table."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("_v")) for c in columns])).alias("x")).select("x.*")
    return exact_percentiles(long, ["measure"], "_v", {"p": p}, **cutting).select("measure", F.col("p").alias("value"))


def rating_sentiment(rating: str = "rating") -> Column:
    """C11: an unknown rating is Neutral."""
    return F.when(F.col(rating) <= 2, "Negative").when(F.col(rating) >= 4, "Positive").otherwise("Neutral")


def sentiment_audit(feedback: DataFrame) -> DataFrame:
    rule = rating_sentiment()
    return feedback.withColumn("rating_sentiment", rule).withColumn("disagrees", ~F.col("sentiment_label").eqNullSafe(rule))


def price_mismatches(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Equal (plan, price) pairs are counted before the catalogue is joined."""
    pairs = subscriptions.groupBy("plan_id", "monthly_price").agg(F.count(F.lit(1)).alias("_n"))
    catalogue = plans.select("plan_id", F.col("monthly_price").alias("_listed"))
    same = F.coalesce(F.round("monthly_price", 2) == F.round("_listed", 2), F.lit(False))
    return pairs.join(catalogue, "plan_id", "left").agg(
        F.coalesce(F.sum(F.when(~same, F.col("_n"))), F.lit(0)).alias("mismatches"))


def resolve_payments(payments: DataFrame, subscriptions: DataFrame, **cutting) -> DataFrame:
    """Subscription of each payment.

    The subscription running on the payment date, else the last one started before it. A subscription
    runs until the next one starts; the last runs to its cancellation or end day, else on. Of several
    that start on one day only the highest id can hold, so one row per customer and day is enough.
    """
    at = F.struct(F.col("subscription_id").alias("subscription_id"), F.col("subscription_end_date").alias("ends"),
                  F.col("cancellation_date").alias("cancelled"))
    starts = subscriptions.where(F.col("subscription_start_date").isNotNull()).groupBy(
        "customer_id", "subscription_start_date").agg(F.max_by(at, "subscription_id").alias("_s"))
    history = Window.partitionBy("customer_id").orderBy("subscription_start_date")
    last_day = F.coalesce(F.col("_s.cancelled"), F.col("_s.ends"))
    until = F.coalesce(F.lead("subscription_start_date").over(history), F.date_add(last_day, 1),
                       F.lit("2100-01-01").cast("date"))
    states = starts.select("customer_id", "subscription_start_date", F.struct(
        F.col("_s.subscription_id").alias("subscription_id"), until.alias("until"),
        F.col("_s.cancelled").alias("cancelled")).alias("_state"))
    found = as_of(payments.drop("subscription_id"), states.withColumnRenamed("_state", "_s"), "customer_id",
                  "payment_date", "payment_id", "subscription_start_date", "_s", **cutting)
    resolution = (F.when(F.col("_s.subscription_id").isNull(), "unresolved")
                  .when(F.col("payment_date") < F.col("_s.until"), "active").otherwise("fallback"))
    late = F.coalesce(F.col("payment_date") > F.col("_s.cancelled"), F.lit(False))
    return found.withColumns({"subscription_id": F.col("_s.subscription_id"), "resolution": resolution,
                              "after_cancellation": late}).drop("_s")


def orphan_counts(tables: Mapping[str, DataFrame], parent: str = "customers", key: str = "customer_id") -> DataFrame:
    """Rows whose key is missing from the parent; a NULL key is an orphan. One row per key is shuffled."""
    known = tables[parent].select(key)
    parts = []
    for name, df in tables.items():
        if name != parent and key in df.columns:
            per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            parts.append(per_key.join(known, key, "left_anti").agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans")).select(F.lit(name).alias("table_name"), "orphans"))
    return _stack(parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """C16"""
    return _stack([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
                   for name, df in tables.items()])


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """D16"""
    return _stack([df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"))
        for name, df in tables.items()])


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def rule_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """C17: (table, column, rule, violations) for the declared rules whose columns are present."""
    parts = []
    for name, df in tables.items():
        rules, key, columns = RULES[name], PRIMARY_KEYS[name], set(df.columns)
        counts: list[tuple[str, str, Column]] = []
        counts += [(c, "not_null", count_if(F.col(c).isNull())) for c in rules.not_null if c in columns]
        counts += [(c, f"length<={n}", count_if(F.length(F.col(c).cast("string")) > n))
                   for c, n in rules.max_length if c in columns]
        counts += [(c, f"numeric({p},{s})", count_if(F.abs(F.col(c)) >= F.lit(10 ** (p - s))))
                   for c, p, s in rules.digits if c in columns]
        wide = df.agg(*[count.alias(f"_{i}") for i, (_, _, count) in enumerate(counts)])
        parts.append(wide.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(rule).alias("rule"),
                     F.col(f"_{i}").alias("violations")) for i, (c, rule, _) in enumerate(counts)])).alias("x")).select("x.*"))
        repeated = duplicates_removed(df.where(F.col(key).isNotNull()), key)
        parts.append(repeated.select(F.lit(name).alias("table_name"), F.lit(key).alias("column_name"),
                                     F.lit("unique").alias("rule"), F.col("removed").alias("violations")))
        for c, parent, parent_key in rules.foreign_keys:
            if c in columns and parent in tables:
                per_key = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
                known = tables[parent].select(F.col(parent_key).alias(c))
                parts.append(per_key.join(known, c, "left_anti").agg(
                    F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
                    F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                    F.lit(f"references {parent}").alias("rule"), "violations"))
    return _stack(parts)


def named_customers(raw_customers: DataFrame, order: str) -> DataFrame:
    """First row per customer with canonical names; ages as delivered."""
    customers = canonical(keep_first(raw_customers, "customer_id", order).drop(order), "country", COUNTRY_SPELLINGS)
    return customers.fillna({c: UNKNOWN for c in ("country", "city") if c in customers.columns})


def clean_tables(raw: Mapping[str, DataFrame], order: str = "_ord") -> dict[str, DataFrame]:
    """The cleaned tables. ``raw['customers']`` carries the file order in ``order``."""
    tables = dict(raw)
    customers = named_customers(raw["customers"], order)
    customers = impute_median(valid_range(customers, "age", 13, 100), "age", "country", whole_numbers=True)
    tables["customers"] = impute_mode(customers, "preferred_language")
    for name, columns in DATE_COLUMNS.items():
        tables[name] = parse_dates(tables[name], columns)
    viewing = canonical(tables["viewing_activity"], "device_type", DEVICE_SPELLINGS, UNKNOWN)
    if "login_location" in viewing.columns:
        viewing = canonical(viewing, "login_location", COUNTRY_SPELLINGS, UNKNOWN)
    tables["viewing_activity"] = impute_median(viewing, "completion_percentage", "content_id")
    payments = resolve_payments(tables["payments"], tables["subscriptions"])
    tables["payments"] = payments.drop("resolution", "after_cancellation")
    return {name: tables[name] for name in SCHEMAS if name in tables}


def clean_all(raw: Mapping[str, DataFrame], order: str = "_ord") -> tuple[dict[str, DataFrame], DataFrame]:
    """Cleaned tables and the one-row report."""
    tables = clean_tables(raw, order)
    return tables, quality_report(raw, tables, order)


def quality_report(raw: Mapping[str, DataFrame], clean: Mapping[str, DataFrame], order: str = "_ord") -> DataFrame:
    """The counts of one cleaning run as a single row."""
    ages = named_customers(raw["customers"], order)
    views = clean["viewing_activity"]
    measures = [c for c in ("watch_duration_minutes", "session_duration_minutes") if c in views.columns]
    tails = upper_tail(views, measures).unionByName(upper_tail(clean["payments"], ["amount"]))
    as_map = F.map_from_entries(F.collect_list(F.struct("table_name", "n")))  # one entry per table
    orphans = orphan_counts(clean).withColumnRenamed("orphans", "n").agg(as_map)
    counts = row_counts(clean).withColumnRenamed("row_count", "n").agg(as_map)
    disagree = sentiment_audit(clean["customer_feedback"]).agg(count_if(F.col("disagrees")))
    return raw["customers"].sparkSession.range(1).select(
        duplicates_removed(raw["customers"], "customer_id").scalar().alias("customer_duplicate_rows_removed"),
        out_of_range(ages, "age", 13, 100).scalar().alias("invalid_age_rows"),
        tails.agg(F.map_from_entries(F.collect_list(F.struct("measure", "value")))).scalar().alias("p995"),
        bad_dates(raw["support_tickets"], "ticket_date").scalar().alias("invalid_ticket_dates_to_null"),
        disagree.scalar().alias("feedback_rating_label_disagreements"),
        price_mismatches(clean["subscriptions"], clean["subscription_plans"]).scalar().alias(
            "subscription_plan_price_mismatch_rows"),
        clean["payments"].agg(count_if(F.col("subscription_id").isNull())).scalar().alias(
            "payments_unresolved_subscription_id"),
        orphans.scalar().alias("orphan_customer_fk_counts"), counts.scalar().alias("row_counts"))

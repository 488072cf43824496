"""Checking SQL of cleaning and data quality, with the messy inputs both engines derive from the tables."""

from checks.sqltext import CTES, big, day, num, sql
from tidemark.operators.quality import COUNTRY_SPELLINGS, DEVICE_SPELLINGS
from tidemark.schemas import PRIMARY_KEYS, RULES
from tidemark.sources.bindings import TABLES

# Messy inputs, valid in both engines.
MESSY = {
    "messy_customers": """
SELECT customer_id, first_name, CASE WHEN customer_id % 11=0 THEN NULL WHEN customer_id % 7=0 THEN ' USA ' WHEN customer_id % 7=1 THEN 'u.k.'
 WHEN customer_id % 7=2 THEN 'Bharat' WHEN customer_id % 7=3 THEN 'atlantis' ELSE country END country,
 CASE WHEN customer_id % 13=0 THEN NULL ELSE age END age,
 CASE WHEN customer_id % 10=0 THEN NULL ELSE preferred_language END preferred_language FROM {customers}""",
    "messy_tickets": """
SELECT ticket_id, CASE WHEN ticket_id % 50=0 THEN '2025-13-45' WHEN ticket_id % 77=0 THEN NULL
 WHEN ticket_id % 91=0 THEN '2025-02-29' ELSE CAST(ticket_date AS VARCHAR(10)) END ticket_date FROM {support_tickets}""",
    "messy_facts": """
SELECT ticket_id fact_id, CASE WHEN ticket_id % 9=0 THEN NULL WHEN ticket_id % 8=0 THEN -customer_id ELSE customer_id END customer_id
 FROM {support_tickets}""",
}
for _name, _text in MESSY.items():
    CTES[_name] = _text.replace("{", "").replace("}", "")


def _mapped(column: str, spellings: dict[str, list[str]]) -> str:
    cases = " ".join(f"WHEN lower(trim({column})) IN ({', '.join(repr(a) for a in aliases)}) THEN '{name}'"
                     for name, aliases in spellings.items())
    title = f"upper(substr(trim({column}),1,1)) || lower(substr(trim({column}),2))"
    return f"CASE {cases} ELSE {title} END"


CTES["cleaned_ages"] = f"""SELECT customer_id, COALESCE({_mapped('country', COUNTRY_SPELLINGS)},'Unknown') country,
 CASE WHEN age BETWEEN 13 AND 100 THEN age END age FROM messy_customers"""

CTES["resolved"] = """
WITH s AS (SELECT *, LEAD(subscription_start_date) OVER(PARTITION BY customer_id ORDER BY subscription_start_date, subscription_id) nx FROM subscriptions),
seg AS (SELECT *, COALESCE(nx, COALESCE(cancellation_date, subscription_end_date)+1, DATE '2100-01-01') e FROM s),
act AS (SELECT p.payment_id, seg.subscription_id, seg.cancellation_date, ROW_NUMBER() OVER(PARTITION BY p.payment_id ORDER BY seg.subscription_start_date DESC) rn
 FROM payments p JOIN seg USING(customer_id) WHERE p.payment_date>=seg.subscription_start_date AND p.payment_date<seg.e),
fb AS (SELECT p.payment_id, s.subscription_id, s.cancellation_date, ROW_NUMBER() OVER(PARTITION BY p.payment_id ORDER BY s.subscription_start_date DESC, s.subscription_id DESC) rn
 FROM payments p JOIN subscriptions s USING(customer_id) WHERE s.subscription_start_date<=p.payment_date)
SELECT p.payment_id, p.customer_id, p.payment_date, COALESCE(a.subscription_id, f.subscription_id) subscription_id,
 CASE WHEN a.subscription_id IS NOT NULL THEN 'active' WHEN f.subscription_id IS NOT NULL THEN 'fallback' ELSE 'unresolved' END resolution,
 COALESCE(p.payment_date > CASE WHEN a.subscription_id IS NOT NULL THEN a.cancellation_date ELSE f.cancellation_date END, FALSE) after_cancellation
FROM payments p LEFT JOIN act a ON a.payment_id=p.payment_id AND a.rn=1 LEFT JOIN fb f ON f.payment_id=p.payment_id AND f.rn=1"""

WITH_CUSTOMER = ["subscriptions", "viewing_activity", "payments", "support_tickets", "customer_feedback", "churn_labels"]
COLUMNS = {
    "customers": {"customer_id", "first_name", "country", "preferred_language", "customer_segment", "acquisition_channel", "age", "registration_date"},
    "subscription_plans": {"plan_id", "plan_name", "monthly_price"},
    "subscriptions": {"subscription_id", "customer_id", "plan_id", "subscription_start_date", "subscription_status", "monthly_price"},
    "content": {"content_id", "title", "genre", "content_type"},
    "viewing_activity": {"viewing_id", "customer_id", "content_id", "viewing_date", "completion_percentage", "device_type"},
    "payments": {"payment_id", "customer_id", "payment_date", "amount", "payment_status"},
    "support_tickets": {"ticket_id", "customer_id", "issue_category", "issue_subcategory", "priority", "ticket_status", "resolution_time_hours"},
    "customer_feedback": {"feedback_id", "customer_id", "sentiment_label"},
    "churn_labels": {"customer_id", "churned", "churn_reason"},
}


def _rules() -> str:
    parts = []
    for t in TABLES:
        r, has = RULES[t], COLUMNS[t]

        def one(c: str, rule: str, bad: str) -> None:
            parts.append(f"SELECT '{t}' table_name, '{c}' column_name, '{rule}' AS rule, COUNT(*) FILTER(WHERE {bad}) violations FROM {t}")

        for c in r.not_null:
            if c in has:
                one(c, "not_null", f"{c} IS NULL")
        for c, n in r.max_length:
            if c in has:
                one(c, f"length<={n}", f"length(CAST({c} AS VARCHAR))>{n}")
        for c, p, s in r.digits:
            if c in has:
                one(c, f"numeric({p},{s})", f"abs({c})>={10 ** (p - s)}")
        k = PRIMARY_KEYS[t]
        parts.append(f"SELECT '{t}', '{k}', 'unique', COUNT({k})-COUNT(DISTINCT {k}) FROM {t}")
        for c, parent, pk in r.foreign_keys:
            if c in has:
                parts.append(f"SELECT '{t}', '{c}', 'references {parent}', COUNT(*) FILTER(WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pk} FROM {parent})) FROM {t}")
    return " UNION ALL ".join(parts)


SQL = {
    "c01_keep_first": sql("""
SELECT doc_id, text, lang FROM (SELECT *, ROW_NUMBER() OVER(PARTITION BY text ORDER BY doc_id) rn FROM dup_docs) WHERE rn=1"""),
    "c01_duplicates_removed": sql(f"SELECT {big('COUNT(*)-COUNT(DISTINCT text)')} removed FROM dup_docs"),
    "c02_country": sql(f"SELECT customer_id, {_mapped('country', COUNTRY_SPELLINGS)} country FROM messy_customers"),
    "c03_device": sql(f"SELECT viewing_id, COALESCE({_mapped('device_type', DEVICE_SPELLINGS)},'Unknown') device_type FROM viewing_activity"),
    "c04_fill_unknown": sql("SELECT customer_id, COALESCE(country,'Unknown') country FROM messy_customers"),
    "c05_valid_age": sql("SELECT customer_id, CASE WHEN age BETWEEN 13 AND 100 THEN age END age FROM messy_customers"),
    "c05_invalid_ages": sql("SELECT COUNT(*) FILTER(WHERE age NOT BETWEEN 13 AND 100) invalid FROM messy_customers"),
    "c06_impute_age": sql("""
WITH m AS (SELECT country, median(age) md FROM cleaned_ages GROUP BY 1)
SELECT customer_id, country, CAST(round_even(COALESCE(age, m.md, (SELECT median(age) FROM cleaned_ages)),0) AS INT) age
FROM cleaned_ages JOIN m USING(country)"""),
    "c07_impute_completion": sql("""
WITH v AS (SELECT viewing_id, content_id, CAST(completion_percentage AS DOUBLE) c FROM viewing_activity),
m AS (SELECT content_id, median(c) md FROM v GROUP BY 1)
SELECT viewing_id, round(COALESCE(c, m.md, (SELECT median(c) FROM v)),6) completion_percentage FROM v JOIN m USING(content_id)"""),
    "c08_impute_language": sql("""
SELECT customer_id, COALESCE(preferred_language, (SELECT preferred_language FROM messy_customers WHERE preferred_language IS NOT NULL
 GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1), 'English') preferred_language FROM messy_customers"""),
    "c09_parse_dates": sql(f"SELECT ticket_id, {day('TRY_CAST(ticket_date AS DATE)')} ticket_date FROM messy_tickets"),
    "c09_bad_dates": sql("SELECT COUNT(*) FILTER(WHERE TRY_CAST(ticket_date AS DATE) IS NULL) bad_dates FROM messy_tickets"),
    "c10_upper_tail": sql(f"""
SELECT 'watch_duration_minutes' measure, round(quantile_cont({num('watch_duration_minutes')}, 0.995),6) AS value FROM viewing_activity
UNION ALL SELECT 'amount', round(quantile_cont({num('amount')}, 0.995),6) FROM payments"""),
    "c11_sentiment_audit": sql("""
WITH x AS (SELECT feedback_id, rating, sentiment_label, CASE WHEN rating<=2 THEN 'Negative' WHEN rating>=4 THEN 'Positive' ELSE 'Neutral' END rating_sentiment FROM customer_feedback)
SELECT *, sentiment_label IS DISTINCT FROM rating_sentiment disagrees FROM x"""),
    "c12_price_mismatches": sql(f"""
SELECT {big('COUNT(*)')} mismatches FROM subscriptions s LEFT JOIN subscription_plans p USING(plan_id)
WHERE s.monthly_price IS DISTINCT FROM p.monthly_price OR s.monthly_price IS NULL"""),
    "c13_asof_resolve": sql(f"SELECT payment_id, customer_id, {day('payment_date')} payment_date, subscription_id, resolution FROM resolved"),
    "c14_resolution_counts": sql("SELECT resolution, COUNT(*) payments FROM resolved GROUP BY 1"),
    "c18_after_cancellation": sql("SELECT payment_id, subscription_id, after_cancellation FROM resolved WHERE after_cancellation"),
    "c15_orphans": sql(" UNION ALL ".join(
        f"SELECT '{t}' table_name, COUNT(*) FILTER(WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM customers)) orphans FROM {t}"
        for t in [*WITH_CUSTOMER, "messy_facts"])),
    "c16_row_counts": sql(" UNION ALL ".join(f"SELECT '{t}' table_name, COUNT(*) row_count FROM {t}" for t in TABLES)),
    "c17_rule_violations": sql(_rules()),
}

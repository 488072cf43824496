"""Checking SQL of the feature table."""

from checks.sqltext import CTES, day, half_even, num, sql

CTES["data_end"] = """SELECT MAX(x) de FROM (SELECT MAX(viewing_date) x FROM viewing_activity UNION ALL SELECT MAX(payment_date) FROM payments
 UNION ALL SELECT MAX(ticket_date) FROM support_tickets UNION ALL SELECT MAX(feedback_date) FROM customer_feedback)"""
CTES["anchors"] = """SELECT customer_id, churned, churn_date, churn_reason,
 COALESCE(CASE WHEN churned THEN churn_date END, de) anchor_date FROM churn_labels, data_end"""
for _short, _table, _date in (("ev", "viewing_activity", "viewing_date"), ("ep", "payments", "payment_date"),
                              ("et", "support_tickets", "ticket_date"), ("ef", "customer_feedback", "feedback_date"),
                              ("es", "subscriptions", "subscription_start_date")):
    CTES[_short] = f"""SELECT e.*, a.anchor_date, date_diff('day',e.{_date},a.anchor_date) age FROM {_table} e
 JOIN anchors a USING(customer_id) WHERE e.{_date} IS NOT NULL AND e.{_date}<=a.anchor_date"""


def _mean(days: int, c: str) -> str:
    w = f"FILTER(WHERE age<{days})"
    return f"CAST(SUM({c}) {w} AS DOUBLE)/nullif(COUNT({c}) {w},0)"


CTES["f_sub"] = f"""
WITH r AS (SELECT *, ROW_NUMBER() OVER(PARTITION BY customer_id ORDER BY subscription_start_date DESC, subscription_id DESC) rn,
 COUNT(*) OVER(PARTITION BY customer_id) n FROM es)
SELECT a.customer_id, COALESCE(r.plan_id,'Unknown') current_plan_id, COALESCE(r.subscription_status,'Unknown') current_subscription_status,
 COALESCE(r.auto_renew,FALSE) auto_renew, COALESCE({num('r.monthly_price')},0.0) current_monthly_price,
 CAST(COALESCE(n-1,0) AS BIGINT) plan_changes, COALESCE(p.plan_name,'Unknown') current_plan
FROM anchors a LEFT JOIN r ON r.customer_id=a.customer_id AND r.rn=1 LEFT JOIN subscription_plans p ON p.plan_id=r.plan_id"""
CTES["f_view"] = f"""
WITH g AS (SELECT customer_id, {_mean(90, 'watch_duration_minutes')} a1, COUNT(*) FILTER(WHERE age<30) s30, COUNT(*) FILTER(WHERE age<90) s90,
 CAST(SUM(watch_duration_minutes) FILTER(WHERE age<30) AS BIGINT) w30, CAST(SUM(watch_duration_minutes) FILTER(WHERE age BETWEEN 30 AND 59) AS BIGINT) wp,
 {_mean(90, 'completion_percentage')} c90, COUNT(DISTINCT viewing_date) FILTER(WHERE age<90) ad, COUNT(DISTINCT device_type) FILTER(WHERE age<90) dd,
 COUNT(DISTINCT ct.genre) FILTER(WHERE age<90) gd, MAX(viewing_date) lv, CAST(COUNT(*) AS DOUBLE)/COUNT(DISTINCT date_trunc('month',viewing_date)) lf,
 CAST(SUM(watch_duration_minutes*(5-2*(age//30))) FILTER(WHERE age<180) AS DOUBLE)/35 tr
 FROM ev LEFT JOIN content ct USING(content_id) GROUP BY 1)
SELECT a.customer_id, COALESCE(a1,0.0) avg_watch_time_per_session, COALESCE(s30,0) sessions_30d, COALESCE(s90,0) sessions_90d,
 COALESCE(w30,0) watch_minutes_30d, COALESCE(wp,0) watch_minutes_prev30d,
 greatest(-500.0,least(500.0,COALESCE((CAST(COALESCE(w30,0) AS DOUBLE)-COALESCE(wp,0))/nullif(wp,0)*100,0.0))) watch_minutes_change_pct_30d,
 COALESCE(c90,0.0) avg_completion_90d, CAST(COALESCE(ad,0) AS INT) active_days_90d, CAST(COALESCE(dd,0) AS INT) device_diversity_90d,
 CAST(COALESCE(gd,0) AS INT) genre_diversity_90d, lv last_view_date,
 CAST(greatest(COALESCE(date_diff('day',lv,a.anchor_date),999),0) AS INT) days_since_last_activity,
 COALESCE(lf,0.0) login_frequency, COALESCE(tr,0.0) monthly_watch_time_trend FROM anchors a LEFT JOIN g USING(customer_id)"""
CTES["f_pay"] = f"""
WITH g AS (SELECT customer_id, COUNT(*) FILTER(WHERE age<90) pc, COUNT(*) FILTER(WHERE age<90 AND payment_status='Failed') fc,
 {num("SUM(amount) FILTER(WHERE payment_status='Success')")} clv, COUNT(*) FILTER(WHERE payment_status='Success') sc,
 MAX(payment_date) FILTER(WHERE payment_status='Failed') lf FROM ep GROUP BY 1)
SELECT a.customer_id, COALESCE(pc,0) payment_count_90d, COALESCE(fc,0) failed_payment_count, COALESCE(CAST(fc AS DOUBLE)/nullif(pc,0),0.0) failed_payment_rate,
 COALESCE(clv,0.0) customer_lifetime_value, COALESCE(sc,0) successful_payment_count, lf last_failed_payment_date,
 CAST(greatest(COALESCE(date_diff('day',lf,a.anchor_date),999),0) AS INT) days_since_last_failed_payment FROM anchors a LEFT JOIN g USING(customer_id)"""
CTES["f_sup"] = f"""
WITH g AS (SELECT customer_id, COUNT(*) n, COUNT(*) FILTER(WHERE age<90) n90, COUNT(*) FILTER(WHERE age<180) n180,
 {_mean(180, 'customer_satisfaction_score')} cs, {_mean(180, 'resolution_time_hours')} rt,
 COUNT(*) FILTER(WHERE age<180 AND customer_satisfaction_score<=2) lo, COUNT(*) FILTER(WHERE age<90 AND priority IN ('High','Critical')) hp FROM et GROUP BY 1)
SELECT a.customer_id, COALESCE(n,0) support_ticket_count, COALESCE(n90,0) support_ticket_count_90d, COALESCE(cs,3.0) avg_customer_satisfaction,
 COALESCE(rt,0.0) avg_resolution_time_180d, COALESCE(lo,0) low_csat_tickets_180d, COALESCE(CAST(lo AS DOUBLE)/nullif(n180,0),0.0) low_csat_ticket_rate_180d,
 COALESCE(hp,0) high_priority_tickets_90d FROM anchors a LEFT JOIN g USING(customer_id)"""
CTES["f_fb"] = f"""
WITH g AS (SELECT customer_id, COUNT(*) n, {_mean(180, 'rating')} r, COUNT(*) FILTER(WHERE rating<=2) k FROM ef WHERE age<180 GROUP BY 1)
SELECT a.customer_id, COALESCE(n,0) feedback_count_180d, COALESCE(r,3.0) avg_feedback_rating_180d, COALESCE(k,0) negative_feedback_count_180d,
 COALESCE(CAST(k AS DOUBLE)/nullif(n,0),0.0) negative_feedback_rate_180d FROM anchors a LEFT JOIN g USING(customer_id)"""


def _r(c: str) -> str:
    """Twice the average rank."""
    return f"(2*RANK() OVER(ORDER BY {c})-2+COUNT(*) OVER(PARTITION BY {c})+1)"


CTES["f_score"] = f"""
WITH r AS (SELECT customer_id, 2*COUNT(*) OVER() m, {_r('days_since_last_activity')} a, {_r('sessions_90d')} b, {_r('avg_completion_90d')} c,
 {_r('monthly_watch_time_trend')} d, {_r('failed_payment_rate')} e, {_r('days_since_last_failed_payment')} f, {_r('support_ticket_count_90d')} g,
 {_r('low_csat_ticket_rate_180d')} h, {_r('avg_resolution_time_180d')} i
 FROM f_view JOIN f_pay USING(customer_id) JOIN f_sup USING(customer_id))
SELECT customer_id, {half_even('35*(m-a)+30*b+20*c+15*d', 'm')} engagement_score, {half_even('70*e+30*(m-f)', 'm')} billing_risk_score,
 {half_even('40*g+35*h+25*i', 'm')} support_friction_score FROM r"""
CTES["ftable"] = """
SELECT c.*, a.churned, a.churn_date, a.churn_reason, a.anchor_date,
 CAST(greatest(date_diff('day',c.registration_date,a.anchor_date),0) AS INT) customer_tenure_days, s.* EXCLUDE(customer_id), v.* EXCLUDE(customer_id),
 p.* EXCLUDE(customer_id), t.* EXCLUDE(customer_id), f.* EXCLUDE(customer_id), x.* EXCLUDE(customer_id)
FROM customers c JOIN anchors a ON a.customer_id=c.customer_id JOIN f_sub s ON s.customer_id=c.customer_id JOIN f_view v ON v.customer_id=c.customer_id
JOIN f_pay p ON p.customer_id=c.customer_id JOIN f_sup t ON t.customer_id=c.customer_id JOIN f_fb f ON f.customer_id=c.customer_id
JOIN f_score x ON x.customer_id=c.customer_id"""

SQL = {
    "f01_data_end": sql(f"SELECT {day('de')} data_end FROM data_end"),
    "f02_anchors": sql(f"SELECT customer_id, churned, {day('churn_date')} churn_date, churn_reason, {day('anchor_date')} anchor_date FROM anchors"),
    "f03_event_window": sql(f"SELECT ticket_id, customer_id, {day('anchor_date')} anchor_date, CAST(age AS INT) days_before_anchor FROM et WHERE age<90"),
    "f04_attach_default": sql("SELECT customer_id, COUNT(t.ticket_id) tickets FROM customers c LEFT JOIN support_tickets t USING(customer_id) GROUP BY 1"),
    "f10_tenure": sql("""SELECT customer_id, CAST(greatest(date_diff('day',c.registration_date,a.anchor_date),0) AS INT) customer_tenure_days
FROM customers c JOIN anchors a USING(customer_id)"""),
    "f11_f13_subscription_state": sql("SELECT * FROM f_sub"),
    "f14_f25_viewing": sql(f"SELECT * REPLACE({day('last_view_date')} AS last_view_date) FROM f_view"),
    "f26_f30_payments": sql(f"SELECT * REPLACE({day('last_failed_payment_date')} AS last_failed_payment_date) FROM f_pay"),
    "f31_f35_support": sql("SELECT * FROM f_sup"),
    "f36_f38_feedback": sql("SELECT * FROM f_fb"),
    "f39_f41_scores": sql("SELECT * FROM f_score"),
    "f42_feature_table": sql(f"""SELECT * REPLACE(CAST(churned AS INT) AS churned, {', '.join(
        f'{day(c)} AS {c}' for c in ('registration_date', 'churn_date', 'anchor_date', 'last_view_date', 'last_failed_payment_date'))}) FROM ftable"""),
}

"""Checking SQL of fact packs, metrics, segments, policy, retrieval and exploration."""

from checks import featuresql  # noqa: F401 - adds the feature CTEs
from checks.sqltext import CTES, MONTH, big, day, half_even, half_up, mean, num, sql
from tidemark.operators.segments import INPUTS as SEGMENT_INPUTS

AT = "1998-03-01"
P06_WEIGHTS = {"engagement_score": -0.25, "failed_payment_rate": 8.0, "days_since_last_activity": 0.0625, "sessions_90d": -0.5,
               "avg_customer_satisfaction": -1.5, "support_ticket_count_90d": 2.0, "plan_changes": -0.125,
               "negative_feedback_rate_180d": 4.0, "customer_tenure_days": -0.03125, "watch_minutes_30d": -0.25,
               "current_monthly_price": 0.5}
NUMERIC = """age churned customer_tenure_days current_monthly_price plan_changes avg_watch_time_per_session sessions_30d sessions_90d
watch_minutes_30d watch_minutes_prev30d watch_minutes_change_pct_30d avg_completion_90d active_days_90d device_diversity_90d genre_diversity_90d
days_since_last_activity login_frequency monthly_watch_time_trend payment_count_90d failed_payment_count failed_payment_rate customer_lifetime_value
successful_payment_count days_since_last_failed_payment support_ticket_count support_ticket_count_90d avg_customer_satisfaction
avg_resolution_time_180d low_csat_tickets_180d low_csat_ticket_rate_180d high_priority_tickets_90d feedback_count_180d avg_feedback_rating_180d
negative_feedback_count_180d negative_feedback_rate_180d engagement_score billing_risk_score support_friction_score""".split()
# filled inputs that m02 shows; the checking SQL fills the same ones
M02_NUMERIC = [c for c in NUMERIC if c not in ("churned", "successful_payment_count")]
M02_CATEGORICAL = ["country", "acquisition_channel", "customer_segment", "preferred_language", "current_plan", "current_plan_id", "auto_renew"]
CORRELATED = [c for c in NUMERIC if c != "churned"]

# A fifth of the rows by hash order, dealt to the classes by largest remainder.
HELD_OUT = """
placed AS (SELECT customer_id, {label} AS y, COUNT(*) OVER (PARTITION BY {label}) AS size, COUNT(*) OVER () AS total,
  row_number() OVER (PARTITION BY {label} ORDER BY CAST('0x' || substr(md5(customer_id || '-42'),1,8) AS BIGINT), customer_id) AS place FROM {table}),
classes AS (SELECT DISTINCT y, size, total, (total * 20 + 99) // 100 AS wanted FROM placed),
seats AS (SELECT y, wanted * size // total + CASE WHEN row_number() OVER (ORDER BY wanted * size % total DESC, y)
  <= wanted - SUM(wanted * size // total) OVER () THEN 1 ELSE 0 END AS seats FROM classes),
split AS (SELECT customer_id, place <= seats AS is_test FROM placed JOIN seats ON placed.y IS NOT DISTINCT FROM seats.y)"""

CTES["cm"] = f"""
SELECT c.country, {MONTH('churn_date')} m, CAST(COUNT(*) AS BIGINT) n FROM churn_labels cl JOIN customers c USING(customer_id) WHERE churned AND churn_date IS NOT NULL GROUP BY 1,2"""
CTES["vm"] = f"""SELECT c.country, {MONTH('viewing_date')} m, {mean('watch_duration_minutes')} a, COUNT(DISTINCT v.customer_id) u
FROM viewing_activity v JOIN customers c USING(customer_id) GROUP BY 1,2"""
CTES["pm"] = f"""SELECT c.country, {MONTH('payment_date')} m, {half_up("COUNT(*) FILTER(WHERE payment_status='Failed')", 'COUNT(*)', 4)} a, COUNT(*) n
FROM payments p JOIN customers c USING(customer_id) GROUP BY 1,2"""
CTES["tm"] = f"""SELECT c.country, {MONTH('ticket_date')} m, COUNT(*) n, {mean('customer_satisfaction_score')} a
FROM support_tickets t JOIN customers c USING(customer_id) GROUP BY 1,2"""


def _periods(cte: str, columns: str) -> str:
    return sql(f"""
WITH s AS (SELECT *, 'current' AS p, m AS mon FROM {cte} UNION ALL SELECT *, 'previous', CAST(m+INTERVAL 1 MONTH AS DATE) FROM {cte})
SELECT country, {day('mon')} AS month, p AS period, {columns} FROM s WHERE mon=DATE '{AT}'""")


def _pack(cte: str, column: str, fact: str) -> str:
    return f"""SELECT COALESCE(a.country,b.country) country, COALESCE(a.m,b.m2) mon, '{fact}' fact, CAST(a.{column} AS DOUBLE) cur, CAST(b.{column} AS DOUBLE) prev
FROM {cte} a FULL JOIN (SELECT *, CAST(m+INTERVAL 1 MONTH AS DATE) m2 FROM {cte}) b ON a.country=b.country AND a.m=b.m2"""


PERIODS = {"weekly": 7, "monthly": 30, "quarterly": 90}
CTES["periods"] = "SELECT * FROM (VALUES ('weekly',7),('monthly',30),('quarterly',90)) t(period, days)"
CTES["ranchor"] = """SELECT MAX(x) d FROM (SELECT MAX(payment_date) x FROM payments UNION ALL SELECT MAX(viewing_date) FROM viewing_activity
UNION ALL SELECT MAX(churn_date) FROM churn_labels)"""


def _window(table: str, date: str, value: str, where: str = "TRUE") -> str:
    return f"(SELECT {value} FROM {table} WHERE {where} AND {date} > d - to_days(days))"


CTES["rfacts"] = f"""SELECT period, days, d, {num("COALESCE(" + _window('payments', 'payment_date', 'SUM(amount)', "payment_status='Success'") + ",0)")} revenue,
 {_window('churn_labels', 'churn_date', 'COUNT(*)', 'churned')} churned_customers, {_window('customers', 'registration_date', 'COUNT(*)')} new_customers,
 {_window('viewing_activity', 'viewing_date', 'COUNT(DISTINCT customer_id)')} active_viewers,
 {_window('support_tickets', 'ticket_date', mean('customer_satisfaction_score'))} avg_csat FROM periods, ranchor"""
CTES["rtop"] = """SELECT period, issue_subcategory, n, rn FROM (SELECT period, issue_subcategory, COUNT(*) n,
 ROW_NUMBER() OVER(PARTITION BY period ORDER BY COUNT(*) DESC, issue_subcategory) rn
 FROM support_tickets, periods, ranchor WHERE ticket_date > d - to_days(days) GROUP BY 1,2) WHERE rn<=5"""

CTES["sweep"] = """
WITH t AS (SELECT CAST(0.1 AS DOUBLE)+i*((CAST(0.9 AS DOUBLE)-CAST(0.1 AS DOUBLE))/160) th FROM range(161) r(i)),
g AS (SELECT th, COUNT(*) FILTER(WHERE score>=th AND label=1) tp, COUNT(*) FILTER(WHERE score>=th AND label=0) fp, COUNT(*) FILTER(WHERE score<th AND label=1) fn FROM t, scored GROUP BY th)
SELECT th threshold, tp, fp, fn, CASE WHEN 5*tp+4*fn+fp=0 THEN 0.0 ELSE CAST(5*tp AS DOUBLE)/(5*tp+4*fn+fp) END f_beta FROM g"""
CTES["confusion"] = """SELECT COUNT(*) FILTER(WHERE label=0 AND score<0.5) tn, COUNT(*) FILTER(WHERE label=0 AND score>=0.5) fp,
 COUNT(*) FILTER(WHERE label=1 AND score<0.5) fn, COUNT(*) FILTER(WHERE label=1 AND score>=0.5) tp FROM scored"""


def _d(n: str, d: str) -> str:
    return f"COALESCE(CAST({n} AS DOUBLE)/nullif({d},0),0.0)"


_CLASS = "CAST({h} AS DOUBLE)"
CTES["perclass"] = f"""SELECT '0' cls, {_d('tn', 'tn+fn')} p, {_d('tn', 'tn+fp')} r, {_d('2*tn', '2*tn+fn+fp')} f, tn+fp s FROM confusion
UNION ALL SELECT '1', {_d('tp', 'tp+fp')}, {_d('tp', 'tp+fn')}, {_d('2*tp', '2*tp+fp+fn')}, tp+fn FROM confusion"""

CTES["seg_ftable"] = "SELECT f.*, s.cluster_id FROM ftable f JOIN segments s ON s.customer_id=f.customer_id"
CTES["seg_profile"] = f"""SELECT cluster_id, {', '.join(f'AVG(CAST({c} AS DOUBLE)) {c}' for c in SEGMENT_INPUTS)}, COUNT(*) customer_count FROM seg_ftable GROUP BY 1"""
CTES["seg_median"] = f"SELECT {', '.join(f'median(CAST({c} AS DOUBLE)) m_{c}' for c in SEGMENT_INPUTS)} FROM ftable"
CTES["retained"] = f"""
WITH x AS (SELECT f.*, s.score churn_probability, CASE WHEN s.score<=0.30 THEN 'Low' WHEN s.score<=0.55 THEN 'Medium' WHEN s.score<=0.75 THEN 'High' ELSE 'Critical' END risk_band,
 'C' || g.cluster_id cluster_name FROM ftable f JOIN scored s ON s.customer_id=f.customer_id LEFT JOIN segments g ON g.customer_id=f.customer_id),
r AS (SELECT *, 2*COUNT(*) OVER() m, {featuresql._r('customer_lifetime_value')} a, {featuresql._r('churn_probability')} b FROM x),
q AS (SELECT *, CAST(a AS DOUBLE)/m clv_percentile, CAST(b AS DOUBLE)/m risk_percentile FROM r)
SELECT *, CASE WHEN risk_percentile>=0.80 AND clv_percentile>=0.75 THEN 'Priority human outreach + personalized save offer'
 WHEN risk_percentile>=0.80 AND failed_payment_rate>0.20 THEN 'Payment-recovery journey + temporary grace period'
 WHEN risk_percentile>=0.80 AND avg_customer_satisfaction<=2.5 THEN 'Senior support callback + service recovery'
 WHEN risk_percentile>=0.70 AND engagement_score<40 THEN 'Personalized content re-engagement campaign'
 WHEN risk_percentile>=0.70 THEN 'Targeted retention incentive'
 WHEN clv_percentile>=0.80 THEN 'Loyalty/value reinforcement; avoid unnecessary discount'
 ELSE 'No urgent intervention; continue lifecycle messaging' END recommended_action, {half_even('60*b+40*a', 'm', 1)} priority_score FROM q"""
CTES["docs"] = """
SELECT 'ticket' AS source, CAST(ticket_id AS VARCHAR) id, customer_id, CAST(ticket_date AS VARCHAR) AS date, issue_category category, issue_subcategory subcategory,
 CAST(NULL AS INT) rating, ticket_description AS text FROM support_tickets
UNION ALL SELECT 'feedback', CAST(feedback_id AS VARCHAR), customer_id, CAST(feedback_date AS VARCHAR), 'Customer Feedback', sentiment_label, rating, feedback_text FROM customer_feedback"""
CTES["wide_vectors"] = "SELECT vec_id, CAST(embedding AS DOUBLE[]) e FROM vectors"
CTES["fenced"] = """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '```SQL' || chr(10) || 'select ' || doc_id || ';' || chr(10) || '```' WHEN 1 THEN '  select * from t; '
 WHEN 2 THEN '```' || chr(10) || 'select lang' || chr(10) || '```  ' ELSE 'select ' || lang || ' from docs;;' END sql FROM dup_docs"""
_RETENTION = ("customer_id, churn_probability, risk_band, customer_lifetime_value, clv_percentile, cluster_name, engagement_score, "
              "failed_payment_rate, support_ticket_count_90d, avg_customer_satisfaction, recommended_action, priority_score")


def _hist(table: str, c: str, bins: int, by: str = "") -> str:
    b = f"{by}, " if by else ""
    return sql(f"""
WITH x AS (SELECT {b}CAST({c} AS DOUBLE) v FROM {table} WHERE {c} IS NOT NULL),
e AS (SELECT MIN(v) lo, (MAX(v)-MIN(v))/{bins} w FROM x)
SELECT {b}CAST(COALESCE(least(floor((v-lo)/nullif(w,0)),{bins - 1}),0) AS INT) bin,
 round(lo+CAST(COALESCE(least(floor((v-lo)/nullif(w,0)),{bins - 1}),0) AS INT)*w,6) bin_start, COUNT(*) n FROM x, e GROUP BY ALL""")


def _box(table: str, groups: str, c: str) -> str:
    names = groups.split(", ")
    inner, same = ", ".join(f"x.{g}" for g in names), " AND ".join(f"x.{g} IS NOT DISTINCT FROM f.{g}" for g in names)
    return sql(f"""
WITH x AS (SELECT {groups}, CAST({c} AS DOUBLE) v FROM {table} WHERE {c} IS NOT NULL),
q AS (SELECT {groups}, quantile_cont(v,0.25) q1, quantile_cont(v,0.5) md, quantile_cont(v,0.75) q3 FROM x GROUP BY {groups}),
f AS (SELECT *, q1-1.5*(q3-q1) lf, q3+1.5*(q3-q1) uf FROM q)
SELECT {inner}, round(q1,6) q1, round(md,6) median, round(q3,6) q3, round(lf,6) lower_fence, round(uf,6) upper_fence, round(MIN(v),6) minimum, round(MAX(v),6) maximum,
 round(MIN(v) FILTER(WHERE v BETWEEN lf AND uf),6) whisker_low, round(MAX(v) FILTER(WHERE v BETWEEN lf AND uf),6) whisker_high,
 COUNT(*) FILTER(WHERE v NOT BETWEEN lf AND uf) outliers, COUNT(*) n FROM x JOIN f ON {same} GROUP BY {inner},q1,md,q3,lf,uf""")


def _counts(table: str, c: str, n: int | None = None) -> str:
    return sql(f"SELECT {c}, COUNT(*) n FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1" + (f" LIMIT {n}" if n else ""))


def _share(table: str, c: str) -> str:
    return sql(f"SELECT {c}, COUNT(*) n, {half_up('100*COUNT(*)', f'(SELECT COUNT(*) FROM {table})')} share_pct FROM {table} GROUP BY 1")


def _churn(g: str, tail: str = "") -> str:
    return sql(f"SELECT {g}, COUNT(*) customers, {half_up('100*COUNT(*) FILTER(WHERE churned)', 'COUNT(*)', 6)} churn_pct FROM ftable GROUP BY 1 {tail}")


SQL = {
    "r01_churn": _periods("cm", "n"),
    "r02_engagement": _periods("vm", "a avg_watch_minutes, u viewers"),
    "r03_payments": _periods("pm", "a failed_payment_rate, n payments"),
    "r04_support": _periods("tm", "n tickets, a avg_csat"),
    "r05_plan_mix": sql(f"""
WITH l AS (SELECT *, ROW_NUMBER() OVER(PARTITION BY customer_id ORDER BY subscription_start_date DESC, subscription_id DESC) rn FROM subscriptions
 WHERE subscription_start_date < DATE '{AT}' + INTERVAL 1 MONTH)
SELECT c.country, p.plan_name, COUNT(*) customers FROM l JOIN customers c USING(customer_id) JOIN subscription_plans p USING(plan_id) WHERE rn=1 GROUP BY 1,2"""),
    "r05_plan_mix_by_month": sql(f"""
WITH lm AS (SELECT customer_id, plan_id, m FROM (SELECT customer_id, plan_id, {MONTH('subscription_start_date')} m,
 ROW_NUMBER() OVER(PARTITION BY customer_id, {MONTH('subscription_start_date')} ORDER BY subscription_start_date DESC, subscription_id DESC) rn FROM subscriptions) WHERE rn=1),
sp AS (SELECT lm.*, c.country, LEAD(m) OVER(PARTITION BY customer_id ORDER BY m) nx FROM lm JOIN customers c USING(customer_id)),
chg AS (SELECT DISTINCT country, plan_id, m FROM sp UNION SELECT DISTINCT country, plan_id, nx FROM sp WHERE nx IS NOT NULL)
SELECT chg.country, p.plan_name, {day('chg.m')} AS month, COUNT(sp.customer_id) customers FROM chg JOIN subscription_plans p USING(plan_id)
LEFT JOIN sp ON sp.country=chg.country AND sp.plan_id=chg.plan_id AND sp.m<=chg.m AND (sp.nx IS NULL OR sp.nx>chg.m) GROUP BY 1,2,3"""),
    "r06_fact_packs": sql(f"""
WITH k AS ({' UNION ALL '.join([_pack('cm', 'n', 'churned'), _pack('vm', 'a', 'avg_watch_minutes'), _pack('vm', 'u', 'viewers'), _pack('pm', 'a', 'failed_payment_rate'),
        _pack('pm', 'n', 'payments'), _pack('tm', 'n', 'tickets'), _pack('tm', 'a', 'avg_csat')])})
SELECT country, {day('mon')} AS month, fact, cur AS current, prev AS previous FROM k"""),
    "r07_anchor": sql(f"SELECT {day('d')} anchor FROM ranchor"),
    "r08_revenue": sql("SELECT period, revenue FROM rfacts"),
    "r09_churned": sql("SELECT period, churned_customers FROM rfacts"),
    "r10_new_customers": sql("SELECT period, new_customers FROM rfacts"),
    "r11_active_viewers": sql("SELECT period, active_viewers FROM rfacts"),
    "r12_csat": sql("SELECT period, avg_csat FROM rfacts"),
    "r13_top_complaints": sql("SELECT period, issue_subcategory, n, CAST(rn AS INT) rank FROM rtop"),
    "r14_report_text": sql("""
WITH c AS (SELECT period, string_agg(issue_subcategory || ' (' || n || ')', ', ' ORDER BY rn) s FROM rtop GROUP BY 1)
SELECT period, concat_ws(chr(10), '# ' || upper(substr(period,1,1)) || substr(period,2) || ' subscription report', '', '- Period ending: ' || d,
 '- Revenue from successful payments: $' || format('{:,.2f}', revenue), '- Churned customers: ' || churned_customers, '- New customers: ' || new_customers,
 '- Active viewers: ' || active_viewers, '- Average CSAT: ' || COALESCE(format('{:,.2f}', avg_csat),'None'), '- Top complaints: ' || COALESCE(s,'')) report
FROM rfacts LEFT JOIN c USING(period)"""),
    "m02_preprocess": sql(f"""
WITH {HELD_OUT.format(table='ftable', label='churned')}, rows AS (SELECT f.*, t.is_test FROM ftable f JOIN split t USING(customer_id)),
fill AS (SELECT {', '.join(f'median(CAST({c} AS DOUBLE)) "{c}"' for c in M02_NUMERIC)} FROM rows WHERE NOT is_test),
{', '.join(f"""mode_{c} AS (SELECT CAST({c} AS VARCHAR) v FROM rows WHERE NOT is_test AND {c} IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)""" for c in M02_CATEGORICAL)}
SELECT customer_id, {', '.join(f'round(COALESCE(CAST(rows."{c}" AS DOUBLE), fill."{c}", 0.0), 6) AS "{c}"' for c in M02_NUMERIC)},
 {', '.join(f"COALESCE(CAST({c} AS VARCHAR), (SELECT v FROM mode_{c}), '') AS {c}" for c in M02_CATEGORICAL)}
FROM rows, fill WHERE is_test"""),
    "m03_hold_out": sql(f"WITH {HELD_OUT.format(table='scored', label='label')} SELECT customer_id, is_test FROM split"),
    "m04_class_weights": sql("""WITH c AS (SELECT COUNT(*) n, COUNT(*) FILTER(WHERE label=1) p FROM scored)
SELECT n-p negatives, p positives, CAST(n-p AS DOUBLE)/p scale_pos_weight, CAST(n AS DOUBLE)/(2*(n-p)) weight_0, CAST(n AS DOUBLE)/(2*p) weight_1 FROM c"""),
    "m10_threshold_sweep": sql("SELECT round(threshold,9) threshold, tp, fp, fn, round(f_beta,9) f_beta FROM sweep"),
    "m10_best_threshold": sql("SELECT round(threshold,9) threshold, tp, fp, fn, round(f_beta,9) f_beta FROM sweep ORDER BY sweep.f_beta DESC, sweep.threshold LIMIT 1"),
    "m11_metrics": sql(f"""SELECT CAST(0.5 AS DOUBLE) threshold, {_d('tp+tn', 'tp+tn+fp+fn')} accuracy, {_d('tp', 'tp+fp')} AS precision, {_d('tp', 'tp+fn')} recall,
 {_d('2*tp', '2*tp+fp+fn')} f1, {_d('5*tp', '5*tp+4*fn+fp')} f2, tn, fp, fn, tp FROM confusion"""),
    "m12_roc_auc": sql("""
WITH r AS (SELECT label, 2*RANK() OVER(ORDER BY score)-2+COUNT(*) OVER(PARTITION BY score)+1 r2 FROM scored),
s AS (SELECT SUM(r2) FILTER(WHERE label=1) t, COUNT(*) FILTER(WHERE label=1) p, COUNT(*) n FROM r)
SELECT round(CAST(t-p*(p+1) AS DOUBLE)/(2*p*(n-p)),9) roc_auc FROM s"""),
    "m13_average_precision": sql("""
WITH g AS (SELECT score, SUM(label) pos, COUNT(*) n FROM scored GROUP BY 1),
c AS (SELECT pos, SUM(pos) OVER(ORDER BY score DESC) tp, SUM(n) OVER(ORDER BY score DESC) seen, SUM(pos) OVER() p FROM g)
SELECT round(SUM(CAST(pos AS DOUBLE)/p*tp/seen),9) average_precision FROM c"""),
    "m14_classification_report": sql("""SELECT cls AS class, round(p,9) AS precision, round(r,9) recall, round(f,9) f1, s support FROM perclass
UNION ALL SELECT 'macro avg', round(AVG(p),9), round(AVG(r),9), round(AVG(f),9), CAST(SUM(s) AS BIGINT) FROM perclass
UNION ALL SELECT 'weighted avg', round(SUM(p*s)/SUM(s),9), round(SUM(r*s)/SUM(s),9), round(SUM(f*s)/SUM(s),9), CAST(SUM(s) AS BIGINT) FROM perclass"""),
    "m15_risk_bands": sql("""SELECT customer_id, score, CASE WHEN score<=0.30 THEN 'Low' WHEN score<=0.55 THEN 'Medium' WHEN score<=0.75 THEN 'High' ELSE 'Critical' END risk_band FROM scored"""),
    "m18_regression_metrics": sql("""SELECT round(AVG(abs(label-score)),9) mae, round(sqrt(AVG((label-score)*(label-score))),9) rmse,
 round(1-AVG((label-score)*(label-score))/var_pop(label),9) r2 FROM scored"""),
    "m20_z_scores": sql(f"SELECT customer_id, {', '.join(f'round(COALESCE((CAST({c} AS DOUBLE)-AVG(CAST({c} AS DOUBLE)) OVER())/nullif(stddev_pop(CAST({c} AS DOUBLE)) OVER(),0),0.0),6) {c}' for c in SEGMENT_INPUTS)} FROM ftable"),
    "m23_profiles": sql(f"SELECT cluster_id, {', '.join(f'round({c},6) {c}' for c in SEGMENT_INPUTS)}, customer_count FROM seg_profile"),
    "m24_segment_names": sql("""SELECT cluster_id, customer_count, CASE
 WHEN customer_lifetime_value>=m_customer_lifetime_value AND engagement_score>=m_engagement_score AND failed_payment_rate<=m_failed_payment_rate THEN 'High-Value Loyal'
 WHEN engagement_score<m_engagement_score AND (failed_payment_rate>m_failed_payment_rate OR avg_customer_satisfaction<m_avg_customer_satisfaction) THEN 'At-Risk Low-Engagement'
 WHEN customer_tenure_days<m_customer_tenure_days AND customer_lifetime_value<m_customer_lifetime_value THEN 'New / Developing'
 WHEN failed_payment_rate>m_failed_payment_rate THEN 'Billing-Fragile' WHEN support_ticket_count_90d>m_support_ticket_count_90d THEN 'Support-Intensive'
 ELSE 'Core Mainstream' END || ' (C' || cluster_id || ')' cluster_name FROM seg_profile, seg_median"""),
    "m26_correlations": sql(f"""
WITH k AS ({' UNION ALL '.join(f"SELECT '{c}' feature, round(corr(CAST({c} AS DOUBLE), CAST(churned AS INT)),6) correlation FROM ftable" for c in CORRELATED)})
SELECT * FROM k WHERE correlation IS NOT NULL AND NOT isnan(correlation) ORDER BY abs(correlation) DESC, feature LIMIT 20"""),
    "p01_join": sql("SELECT customer_id, churn_probability, risk_band, cluster_name FROM retained"),
    "p02_percentiles": sql("SELECT customer_id, clv_percentile, risk_percentile FROM retained"),
    "p03_actions": sql("SELECT customer_id, recommended_action FROM retained"),
    "p04_priority": sql("SELECT customer_id, priority_score FROM retained"),
    "p05_recommendations": sql(f"SELECT {_RETENTION} FROM retained"),
    "p06_linear_contributions": sql(f"""
WITH l AS ({' UNION ALL '.join(f"SELECT customer_id, '{c.replace('_', ' ')}' feature, CAST({w} AS DOUBLE)*CAST({c} AS DOUBLE) contribution, CAST({c} AS DOUBLE) transformed_value FROM ftable" for c, w in P06_WEIGHTS.items())}),
r AS (SELECT *, ROW_NUMBER() OVER(PARTITION BY customer_id ORDER BY abs(contribution) DESC, feature) rn FROM l)
SELECT customer_id, CAST(rn AS INT) factor_rank, feature, contribution, CASE WHEN contribution>0 THEN 'increases risk' ELSE 'reduces risk' END direction, transformed_value FROM r WHERE rn<=8"""),
    "t01_documents": sql("SELECT * FROM docs"),
    "t03_normalise": sql("SELECT vec_id, round(sqrt(list_sum(list_transform(e, lambda x: x*x))),6) norm_before, round(e[1]/sqrt(list_sum(list_transform(e, lambda x: x*x))),6) first_value FROM wide_vectors"),
    "t05_topk_similar": sql("""
WITH q AS (SELECT e FROM wide_vectors ORDER BY vec_id LIMIT 1)
SELECT vec_id, label, round(list_dot_product(w.e, q.e),6) similarity FROM wide_vectors w JOIN vectors USING(vec_id), q ORDER BY similarity DESC, vec_id LIMIT 8"""),
    "t06_topk_batch": sql("""
WITH s AS (SELECT a.vec_id query_id, b.vec_id id, round(list_dot_product(a.e,b.e),6) similarity FROM wide_vectors a, wide_vectors b),
r AS (SELECT *, ROW_NUMBER() OVER(PARTITION BY query_id ORDER BY similarity DESC, id) rn FROM s)
SELECT query_id, id, similarity, CAST(rn AS INT) rank FROM r WHERE rn<=8"""),
    "t07_evidence_pack": sql("""
WITH r AS (SELECT *, ROW_NUMBER() OVER(PARTITION BY subcategory ORDER BY source, id) rn FROM docs)
SELECT subcategory, string_agg('[' || upper(source) || ':' || id || '] date=' || date || ' category=' || category || ' subcategory=' || subcategory || ' rating='
 || COALESCE(CAST(rating AS VARCHAR),'None') || chr(10) || text, chr(10) || chr(10) ORDER BY rn) context, COUNT(*) record_count FROM r WHERE rn<=8 GROUP BY 1"""),
    "t08_strip_fence": sql("""
SELECT doc_id, rtrim(trim(regexp_replace(regexp_replace(trim(sql, ' ' || chr(10)), '^```(?:sql)?\\s*', '', 'i'), '\\s*```$', ''), ' ' || chr(10)), ';') AS sql FROM fenced"""),
    "t11_csv_preview": sql("""SELECT 'customer_id,country,age' AS line UNION ALL
SELECT concat_ws(',', customer_id, country, age) FROM (SELECT * FROM customers ORDER BY customer_id LIMIT 100)"""),
    "d01_kpis": sql(f"""SELECT COUNT(*) customers, {half_up('100*COUNT(*) FILTER(WHERE churned)', 'COUNT(*)', 1)} churn_pct,
 (SELECT {num('SUM(amount)')} FROM payments WHERE payment_status='Success') successful_revenue, (SELECT COUNT(*) FROM scored WHERE score>0.55) high_risk_customers,
 (SELECT {mean('customer_satisfaction_score')} FROM support_tickets) avg_csat FROM churn_labels"""),
    "d02_churn_by_plan": _churn("current_plan"),
    "d03_sample": sql("SELECT customer_id, country, customer_segment FROM customers ORDER BY md5(customer_id || '-42'), customer_id LIMIT 3000"),
    "d04_filtered": sql("SELECT customer_id, country, current_plan FROM ftable WHERE country IN ('NATION_1','NATION_2','NATION_3') AND current_plan IN ('Premium','Basic')"),
    "d04_options": sql("SELECT DISTINCT current_plan FROM ftable WHERE current_plan IS NOT NULL"),
    "d05_customer_grid": sql("""SELECT customer_id, country, current_plan, customer_segment, engagement_score, failed_payment_rate, avg_customer_satisfaction,
 customer_lifetime_value, CAST(churned AS INT) churned FROM ftable"""),
    "d06_age_histogram": _hist("customers", "age", 35),
    "d06_tenure_by_churn": _hist("(SELECT customer_tenure_days, CAST(churned AS INT) churned FROM ftable)", "customer_tenure_days", 30, "churned"),
    "d06_age_by_churn": _hist("(SELECT age, CAST(churned AS INT) churned FROM ftable)", "age", 35, "churned"),
    "d06_watch_histogram": _hist("viewing_activity", "watch_duration_minutes", 60),
    "d06_completion_histogram": _hist("viewing_activity", "completion_percentage", 40),
    "d06_amount_histogram": _hist("payments", "amount", 50, "payment_status"),
    "d06_csat_histogram": _hist("support_tickets", "customer_satisfaction_score", 5),
    "d07_plan_churn_box": _box("(SELECT current_plan, CAST(churned AS INT) churned, engagement_score FROM ftable)", "current_plan, churned", "engagement_score"),
    "d07_engagement_box": _box("(SELECT CAST(churned AS INT) churned, engagement_score FROM ftable)", "churned", "engagement_score"),
    "d07_resolution_box": _box("support_tickets", "issue_category", "resolution_time_hours"),
    "d07_rating_box": _box("customer_feedback", "sentiment_label", "rating"),
    "d07_failed_rate_box": _box("(SELECT CAST(churned AS INT) churned, failed_payment_rate FROM ftable)", "churned", "failed_payment_rate"),
    "d07_ticket_volume_box": _box("(SELECT CAST(churned AS INT) churned, support_ticket_count FROM ftable)", "churned", "support_ticket_count"),
    "d08_countries": _counts("customers", "country", 20),
    "d08_subcategories": _counts("support_tickets", "issue_subcategory", 15),
    "d08_channels": _counts("customers", "acquisition_channel"),
    "d08_devices": _counts("viewing_activity", "device_type"),
    "d08_categories": _counts("support_tickets", "issue_category"),
    "d09_segment_mix": _share("customers", "customer_segment"),
    "d09_plan_mix": _share("ftable", "current_plan"),
    "d10_recurring_revenue": sql("SELECT current_plan, CAST(SUM(CAST(current_monthly_price AS DECIMAL(12,2))) AS DOUBLE) current_monthly_price FROM ftable GROUP BY 1"),
    "d11_churn_by_country": _churn("country", "ORDER BY 3 DESC, 1 LIMIT 20"),
    "d12_monthly_minutes": sql(f"SELECT strftime(viewing_date,'%Y-%m') AS month, {big('SUM(watch_duration_minutes)')} watch_duration_minutes FROM viewing_activity GROUP BY 1"),
    "d13_minutes_by_genre": sql(f"SELECT genre, {big('SUM(watch_duration_minutes)')} watch_duration_minutes FROM viewing_activity JOIN content USING(content_id) GROUP BY 1"),
    "d14_failed_history": sql(f"SELECT {day(MONTH('payment_date'))} AS month, COUNT(*) failed_payments FROM payments WHERE payment_status='Failed' GROUP BY 1"),
    "d15_cluster_sizes": sql("SELECT cluster_id, COUNT(*) customers FROM segments GROUP BY 1"),
    "d15_cluster_top": sql("""SELECT customer_id, cluster_id, customer_lifetime_value, CAST(rn AS INT) rank FROM (SELECT *,
 ROW_NUMBER() OVER(PARTITION BY cluster_id ORDER BY customer_lifetime_value DESC, customer_id) rn FROM seg_ftable) WHERE rn<=100"""),
    "d16_table_shapes": sql(" UNION ALL ".join(f"SELECT '{t}' table_name, (SELECT COUNT(*) FROM {t}) row_count, CAST({n} AS INT) column_count" for t, n in (
        ("customers", 8), ("subscription_plans", 3), ("subscriptions", 9), ("content", 4), ("viewing_activity", 7), ("payments", 5),
        ("support_tickets", 10), ("customer_feedback", 6), ("churn_labels", 4)))),
    "s07_parameterised_query": sql("SELECT country, COUNT(*) n FROM customers WHERE age>=40 AND acquisition_channel='Paid' GROUP BY 1"),
}
_ROWS = " UNION ALL ".join(f"SELECT '{t}' table_name, COUNT(*) row_count FROM {t}" for t in (
    "customers", "subscription_plans", "subscriptions", "content", "viewing_activity", "payments", "support_tickets", "customer_feedback", "churn_labels"))
SQL |= {
    "s01_read_raw_csv": sql(f"SELECT customer_id, first_name, country, preferred_language, customer_segment, acquisition_channel, age, {day('registration_date')} registration_date FROM customers"),
    "s02_read_processed": sql(f"SELECT customer_id, churned, {day('churn_date')} churn_date, churn_reason FROM churn_labels"),
    "s03_write_iso_csv": sql(f"SELECT ticket_id, {day('ticket_date')} ticket_date FROM support_tickets"),
    "s05_reload_tables": sql(_ROWS),
    "s09_jsonl_documents": sql("SELECT * FROM docs"),
    "s10_feature_dates": sql(f"SELECT customer_id, {day('anchor_date')} anchor_date, {day('last_view_date')} last_view_date FROM ftable"),
    "s12_views": sql("""SELECT 'v_current_subscription' view_name, COUNT(*) n FROM latest UNION ALL SELECT 'v_customer_clv', COUNT(*) FROM customers
UNION ALL SELECT 'v_customer_support_summary', COUNT(*) FROM customers"""),
}

"""The same results in plain SQL over the provided tables, written apart from the Spark code.

Every statement starts from the raw-table mapping, cleans on its own terms and joins payment by payment: no pre-aggregation, no
shared helper. Counts are cast to BIGINT, flags to INT; money is summed as DECIMAL(28,6) and leaves as DOUBLE.
"""

from lendrisk.sources.provided import RAW_LOANS_SQL, RAW_MEMBERS_SQL, RAW_PAYMENTS_SQL

_CTES = {
    "raw_members": RAW_MEMBERS_SQL,
    "raw_loans": RAW_LOANS_SQL,
    "raw_payments": RAW_PAYMENTS_SQL,
    "kept_members": "SELECT DISTINCT ON (member_id) * FROM raw_members ORDER BY member_id, ingest_seq",
    "mc": """
        SELECT * REPLACE (
                 upper(left(trim(first_name), 1)) || lower(substring(trim(first_name), 2)) AS first_name,
                 upper(left(trim(last_name), 1)) || lower(substring(trim(last_name), 2)) AS last_name,
                 nullif(nullif(email, ''), ' ') AS email,
                 nullif(nullif(nullif(phone, 'N/A'), 'n/a'), '') AS phone),
               cast(credit_score IS NULL AS INT) AS credit_score_missing
        FROM (SELECT * EXCLUDE (ingest_seq) FROM kept_members)""",
    "lc": """
        SELECT * REPLACE (
                 upper(left(loan_type, 1)) || substring(loan_type, 2) AS loan_type,
                 abs(original_amount) AS original_amount),
               cast(interest_rate IS NULL AS INT) AS rate_missing
        FROM raw_loans""",
    "pc": """
        SELECT * REPLACE (
                 nullif(nullif(payment_date, ''), ' ') AS payment_date,
                 abs(actual_amount) AS actual_amount,
                 upper(left(payment_status, 1)) || lower(substring(payment_status, 2)) AS payment_status)
        FROM raw_payments""",
    # One row per cleaned payment with 1/0 marks and the exact past-due amount.
    "marked": """
        SELECT *, CASE payment_status WHEN 'Late' THEN 1 WHEN 'Missed' THEN 1 ELSE 0 END AS is_late,
               CASE payment_status WHEN 'Missed' THEN 1 ELSE 0 END AS is_missed,
               cast(CASE is_late WHEN 1 THEN expected_amount - actual_amount ELSE 0 END AS DECIMAL(28, 6)) AS owed
        FROM pc""",
    "lp": "SELECT * FROM lc JOIN marked USING (loan_id)",
    "mlp": "SELECT *, first_name || ' ' || last_name AS member_name FROM mc JOIN lp USING (member_id)",
    "totals": """
        SELECT member_id, member_name, city, credit_score, account_status,
               cast(sum(is_late) AS BIGINT) AS late_payment_count,
               cast(sum(is_missed) AS BIGINT) AS missed_payment_count,
               cast(sum(owed) AS DOUBLE) AS total_amount_past_due,
               count(payment_id) AS total_payments,
               round(100e0 * sum(is_late) / nullif(count(payment_id), 0), 1) AS delinquency_rate
        FROM mlp GROUP BY ALL""",
    "flagged": "SELECT * FROM totals WHERE account_status = 'Active' AND late_payment_count >= 3",
    "extent": """
        SELECT min(late_payment_count) AS l0, max(late_payment_count) AS l1,
               min(missed_payment_count) AS m0, max(missed_payment_count) AS m1,
               min(total_amount_past_due) AS a0, max(total_amount_past_due) AS a1 FROM flagged""",
    "points": """
        SELECT flagged.*, round_even((
                 (late_payment_count - l0) / cast(l1 - l0 + 1 AS DOUBLE) * 0.4e0
               + (missed_payment_count - m0) / cast(m1 - m0 + 1 AS DOUBLE) * 0.3e0
               + (total_amount_past_due - a0) / (a1 - a0 + 1) * 0.2e0
               + delinquency_rate / 100e0 * 0.1e0) * 100e0, 1) AS risk_score
        FROM flagged, extent""",
    "scored": """
        SELECT *, CASE WHEN risk_score NOT BETWEEN 0 AND 100 THEN NULL WHEN risk_score > 75 THEN 'Critical Risk'
                       WHEN risk_score > 50 THEN 'High Risk' WHEN risk_score > 25 THEN 'Moderate Risk'
                       ELSE 'Low Risk' END AS risk_tier
        FROM points""",
    "scored3": """
        SELECT *, CASE WHEN risk_score > 40 THEN 'High Risk' WHEN risk_score >= 20 THEN 'Moderate Risk'
                       ELSE 'Low Risk' END AS risk_tier
        FROM points""",
    "summary": """
        SELECT member_id, member_name, loan_id, loan_type, original_amount, interest_rate, loan_status, origination_date,
               count(payment_id) AS total_payments, cast(sum(is_late) AS BIGINT) AS late_payments,
               cast(sum(is_missed) AS BIGINT) AS missed_payments, cast(sum(owed) AS DOUBLE) AS amount_past_due,
               round(100e0 * sum(is_late) / nullif(count(payment_id), 0), 1) AS loan_delinquency_rate
        FROM mlp GROUP BY ALL""",
    "detail": """
        SELECT member_id, member_name, loan_id, loan_type, payment_id, due_date, payment_date, expected_amount,
               actual_amount, expected_amount - actual_amount AS shortfall, payment_status,
               cast(CASE WHEN payment_date IS NULL THEN NULL
                         WHEN payment_date > due_date
                           THEN date_diff('day', try_cast(due_date AS DATE), try_cast(payment_date AS DATE))
                         ELSE 0 END AS INT) AS days_late
        FROM mlp""",
    "worst": "SELECT * FROM flagged ORDER BY late_payment_count DESC, member_id LIMIT 1",
    "by_type": """
        SELECT loan_type, count(DISTINCT loan_id) AS total_loans, cast(sum(is_late) AS BIGINT) AS late_payments,
               count(payment_id) AS total_payments,
               round(100e0 * sum(is_late) / nullif(count(payment_id), 0), 1) AS delinquency_rate_pct,
               cast(sum(owed) AS DOUBLE) AS amount_at_risk
        FROM lp GROUP BY loan_type""",
    "by_month": """
        SELECT left(due_date, 7) AS "month", count(payment_id) AS total_payments,
               cast(sum(is_late) AS BIGINT) AS late_payments,
               round(100e0 * sum(is_late) / nullif(count(payment_id), 0), 1) AS delinquency_rate_pct
        FROM marked GROUP BY 1""",
    "banded": """
        SELECT *, CASE WHEN credit_score IS NULL THEN 'Unknown' WHEN credit_score < 600 THEN 'Below 600 (Poor)'
                       WHEN credit_score < 650 THEN '600-649 (Below Avg)' WHEN credit_score < 700 THEN '650-699 (Fair)'
                       WHEN credit_score < 750 THEN '700-749 (Good)' ELSE '750+ (Excellent)' END AS credit_tier
        FROM mc""",
    "by_tier": """
        SELECT credit_tier, count(DISTINCT member_id) AS member_count, cast(sum(is_late) AS BIGINT) AS late_payments,
               count(payment_id) AS total_payments,
               round(100e0 * sum(is_late) / nullif(count(payment_id), 0), 1) AS delinquency_rate_pct
        FROM mlp JOIN (SELECT member_id, credit_tier FROM banded) USING (member_id) GROUP BY credit_tier""",
    "by_city": """
        SELECT city, count(DISTINCT member_id) AS member_count, cast(sum(is_late) AS BIGINT) AS late_payments,
               count(payment_id) AS total_payments,
               round(100e0 * sum(is_late) / nullif(count(payment_id), 0), 1) AS delinquency_rate_pct
        FROM mlp GROUP BY city""",
}

# Each body names the tables above that it needs; the tables those need are added in front, in the order given above.
_BODIES = {
    "load_counts": """
        SELECT 'raw_members' AS "table", count(*) AS "rows" FROM raw_members
        UNION ALL SELECT 'raw_loans', count(*) FROM raw_loans
        UNION ALL SELECT 'raw_payments', count(*) FROM raw_payments""",
    "csv_ingest_members": "SELECT * FROM mc",
    "csv_ingest_trend": "SELECT * FROM by_month",
    "dedup_members": "SELECT * FROM kept_members",
    "normalize_names": """
        SELECT ingest_seq, member_id,
               concat(upper(trim(first_name)[1]), lower(trim(first_name)[2:])) AS first_name,
               concat(upper(trim(last_name)[1]), lower(trim(last_name)[2:])) AS last_name
        FROM raw_members""",
    "null_tokens_members": """
        SELECT ingest_seq, CASE WHEN phone NOT IN ('N/A', 'n/a', '') THEN phone END AS phone,
               CASE WHEN email NOT IN ('', ' ') THEN email END AS email
        FROM raw_members""",
    "null_tokens_payments": """
        SELECT payment_id, CASE WHEN payment_date NOT IN ('', ' ') THEN payment_date END AS payment_date
        FROM raw_payments""",
    "missing_flags_members": """
        SELECT ingest_seq, credit_score, CASE WHEN credit_score IS NULL THEN 1 ELSE 0 END AS credit_score_missing
        FROM raw_members""",
    "missing_flags_loans": """
        SELECT loan_id, interest_rate, CASE WHEN interest_rate IS NULL THEN 1 ELSE 0 END AS rate_missing
        FROM raw_loans""",
    "abs_amounts_loans": "SELECT loan_id, abs(original_amount) AS original_amount FROM raw_loans",
    "abs_amounts_payments": "SELECT payment_id, abs(actual_amount) AS actual_amount FROM raw_payments",
    "normalize_loan_type": """
        SELECT loan_id, concat(upper(loan_type[1]), loan_type[2:]) AS loan_type FROM raw_loans""",
    "canonical_loan_type": """
        SELECT loan_id, CASE lower(loan_type) WHEN 'auto loan' THEN 'Auto Loan' WHEN 'personal loan' THEN 'Personal Loan'
                             WHEN 'credit card' THEN 'Credit Card' WHEN 'student loan' THEN 'Student Loan'
                             WHEN 'mortgage' THEN 'Mortgage' WHEN 'home equity' THEN 'Home Equity' END AS loan_type
        FROM raw_loans""",
    "normalize_status": """
        SELECT upper(payment_status[1]) || lower(payment_status[2:]) AS payment_status, count(*) AS payments
        FROM raw_payments GROUP BY 1""",
    "members_clean": "SELECT * FROM mc",
    "loans_clean": "SELECT * FROM lc",
    "payments_clean": "SELECT * FROM pc",
    "member_credit_bands": "SELECT member_id, credit_score, credit_tier FROM banded",
    "loan_payment_stats": """
        SELECT loan_id, count(payment_id) AS total_payments, cast(sum(is_late) AS BIGINT) AS late_payments,
               cast(sum(is_missed) AS BIGINT) AS missed_payments, cast(sum(owed) AS DOUBLE) AS past_due
        FROM marked GROUP BY loan_id""",
    "member_delinquency": "SELECT * FROM flagged",
    "member_delinquency_min12": "SELECT * FROM totals WHERE account_status = 'Active' AND late_payment_count >= 12",
    "delinquency_by_loan_type": "SELECT * FROM by_type",
    "delinquency_by_canonical_loan_type": """
        SELECT CASE lower(loan_type) WHEN 'auto loan' THEN 'Auto Loan' WHEN 'personal loan' THEN 'Personal Loan'
                    WHEN 'credit card' THEN 'Credit Card' WHEN 'student loan' THEN 'Student Loan'
                    WHEN 'mortgage' THEN 'Mortgage' WHEN 'home equity' THEN 'Home Equity' END AS loan_type,
               count(DISTINCT loan_id) AS total_loans, cast(sum(is_late) AS BIGINT) AS late_payments,
               count(payment_id) AS total_payments,
               round(100e0 * sum(is_late) / nullif(count(payment_id), 0), 1) AS delinquency_rate_pct,
               cast(sum(owed) AS DOUBLE) AS amount_at_risk
        FROM lp GROUP BY 1""",
    "monthly_delinquency_trend": "SELECT * FROM by_month",
    "delinquency_by_credit_tier": "SELECT * FROM by_tier",
    "delinquency_by_city": "SELECT * FROM by_city",
    "member_loan_summary": "SELECT * FROM summary",
    "payment_detail": "SELECT * FROM detail",
    "payment_detail_sorted": "SELECT * FROM detail ORDER BY member_id, due_date",
    "population_ranges": """
        SELECT l0 AS min_late_payment_count, l1 AS max_late_payment_count,
               m0 AS min_missed_payment_count, m1 AS max_missed_payment_count,
               a0 AS min_total_amount_past_due, a1 AS max_total_amount_past_due,
               (SELECT min(delinquency_rate) FROM flagged) AS min_delinquency_rate,
               (SELECT max(delinquency_rate) FROM flagged) AS max_delinquency_rate
        FROM extent""",
    "risk_score_terms": """
        SELECT member_id, (late_payment_count - l0) / cast(l1 - l0 + 1 AS DOUBLE) AS late_norm,
               (missed_payment_count - m0) / cast(m1 - m0 + 1 AS DOUBLE) AS missed_norm,
               (total_amount_past_due - a0) / (a1 - a0 + 1) AS amount_norm, delinquency_rate / 100e0 AS rate_norm
        FROM flagged, extent""",
    "member_delinquency_scored": "SELECT * FROM scored",
    "member_delinquency_scored_documented_tiers": "SELECT * FROM scored3",
    "risk_tier_counts": """
        SELECT t.risk_tier, count(scored.member_id) AS members
        FROM (VALUES ('Low Risk'), ('Moderate Risk'), ('High Risk'), ('Critical Risk')) AS t(risk_tier)
             LEFT JOIN scored ON scored.risk_tier = t.risk_tier
        GROUP BY t.risk_tier""",
    "risk_tier_counts_documented": """
        SELECT t.risk_tier, count(scored3.member_id) AS members
        FROM (VALUES ('Low Risk'), ('Moderate Risk'), ('High Risk')) AS t(risk_tier)
             LEFT JOIN scored3 ON scored3.risk_tier = t.risk_tier
        GROUP BY t.risk_tier""",
    "data_quality_report": """
        SELECT 'members' AS section, 'total_clean_members' AS measure, count(*) AS "value" FROM mc
        UNION ALL SELECT 'members', 'duplicate_rows_removed', (SELECT count(*) FROM raw_members) - count(*) FROM mc
        UNION ALL SELECT 'members', 'missing_credit_scores', count(*) FROM mc WHERE credit_score IS NULL
        UNION ALL SELECT 'members', 'missing_emails', count(*) FROM mc WHERE email IS NULL
        UNION ALL SELECT 'members', 'missing_phones', count(*) FROM mc WHERE phone IS NULL
        UNION ALL SELECT 'loans', 'negative_amounts_corrected', count(*) FROM raw_loans WHERE original_amount < 0
        UNION ALL SELECT 'loans', 'missing_interest_rates', count(*) FROM raw_loans WHERE interest_rate IS NULL
        UNION ALL SELECT 'payments', 'negative_payments_fixed', count(*) FROM raw_payments WHERE actual_amount < 0
        UNION ALL SELECT 'delinquency', 'members_flagged', count(*) FROM flagged""",
    "highest_delinquency": "SELECT member_id, member_name, late_payment_count FROM worst",
    "kpi_overview": """
        SELECT (SELECT count(*) FROM mc) AS members, (SELECT count(*) FROM lc) AS loans, count(*) AS payments,
               cast(sum(is_late) AS BIGINT) AS late_payments,
               round(100e0 * sum(is_late) / nullif(count(payment_id), 0), 1) AS delinquency_rate_pct,
               cast(sum(owed) AS DOUBLE) AS amount_past_due, (SELECT count(*) FROM flagged) AS members_flagged
        FROM marked""",
    "member_detail_high_risk": "SELECT * FROM scored WHERE risk_tier = 'High Risk'",
    "member_detail_city": "SELECT * FROM scored WHERE city = 'NATION_7' AND risk_score >= 20",
    "member_drill_loans": "SELECT * FROM summary WHERE member_id = 'MBR-000005'",
    "member_drill_payments": "SELECT * FROM detail WHERE member_id = 'MBR-000005'",
    "member_monthly_status": """
        SELECT member_id, left(due_date, 7) AS "month", count(*) FILTER (payment_status = 'On time') AS on_time,
               count(*) FILTER (payment_status = 'Late') AS late, count(*) FILTER (payment_status = 'Missed') AS missed,
               count(*) FILTER (payment_status = 'Partial') AS partial
        FROM mlp GROUP BY 1, 2""",
    "export_round_trip": """
        SELECT "table", "rows" AS rows_written, "rows" AS rows_read FROM (
            SELECT 'member_delinquency_scored' AS "table", (SELECT count(*) FROM scored) AS "rows"
            UNION ALL SELECT 'delinquency_by_loan_type', (SELECT count(*) FROM by_type)
            UNION ALL SELECT 'monthly_delinquency_trend', (SELECT count(*) FROM by_month)
            UNION ALL SELECT 'delinquency_by_credit_tier', (SELECT count(*) FROM by_tier)
            UNION ALL SELECT 'delinquency_by_city', (SELECT count(*) FROM by_city)
            UNION ALL SELECT 'member_loan_summary', (SELECT count(*) FROM summary)
            UNION ALL SELECT 'payment_detail', (SELECT count(*) FROM detail)
            UNION ALL SELECT 'members_clean', (SELECT count(*) FROM mc)
            UNION ALL SELECT 'loans_clean', (SELECT count(*) FROM lc))""",
}


def _places(table: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM {table}"


_BODIES |= {
    "trend_from_activity": _BODIES["monthly_delinquency_trend"],
    "kpi_from_activity": _BODIES["kpi_overview"],
    "loan_stats_from_activity": _BODIES["loan_payment_stats"],
    "loan_type_positions": _places("by_type", "delinquency_rate_pct DESC NULLS LAST, loan_type DESC"),
    "credit_tier_positions": _places("by_tier", "delinquency_rate_pct DESC NULLS LAST, credit_tier DESC"),
    "city_positions": _places("by_city", "delinquency_rate_pct DESC NULLS LAST, city DESC"),
    "month_positions": _places("by_month", '"month" NULLS FIRST'),
    "risk_positions": _places("scored", "risk_score DESC, member_id"),
    "payment_detail_positions": _places(
        "detail",
        "member_id, due_date NULLS FIRST, loan_id, payment_id NULLS FIRST, payment_date NULLS FIRST, expected_amount NULLS FIRST, actual_amount",
    ),
    "payment_detail_hot_keys": _BODIES["payment_detail"],
    "member_loan_summary_hot_keys": _BODIES["member_loan_summary"],
    "member_delinquency_hot_keys": _BODIES["member_delinquency"],
    "export_values_payment_detail": _BODIES["payment_detail"],
    "export_values_member_loan_summary": _BODIES["member_loan_summary"],
    "member_loans_stored": _BODIES["member_drill_loans"],
    "member_payments_stored": _BODIES["member_drill_payments"],
    "payment_detail_month": "SELECT * FROM detail WHERE due_date LIKE '1997-03-%'",
    "payment_detail_month_replaced": _BODIES["payment_detail"],
    "stored_scores": _BODIES["member_delinquency_scored"],
    "stored_versions": """
        SELECT "table", "rows" AS rows_recorded, "rows" AS rows_read FROM (
            SELECT 'members_clean' AS "table", (SELECT count(*) FROM mc) AS "rows"
            UNION ALL SELECT 'loans_clean', (SELECT count(*) FROM lc)
            UNION ALL SELECT 'payments_clean', (SELECT count(*) FROM pc)
            UNION ALL SELECT 'loan_activity', (SELECT count(*) FROM (SELECT DISTINCT loan_id, left(due_date, 7), payment_status FROM pc))
            UNION ALL SELECT 'loan_payment_stats', (SELECT count(*) FROM (SELECT DISTINCT loan_id FROM pc))
            UNION ALL SELECT 'member_delinquency', (SELECT count(*) FROM flagged)
            UNION ALL SELECT 'member_delinquency_scored', (SELECT count(*) FROM flagged)
            UNION ALL SELECT 'delinquency_by_loan_type', (SELECT count(*) FROM by_type)
            UNION ALL SELECT 'monthly_delinquency_trend', (SELECT count(*) FROM by_month)
            UNION ALL SELECT 'delinquency_by_credit_tier', (SELECT count(*) FROM by_tier)
            UNION ALL SELECT 'delinquency_by_city', (SELECT count(*) FROM by_city)
            UNION ALL SELECT 'member_monthly_status', (SELECT count(*) FROM (SELECT DISTINCT member_id, left(due_date, 7) FROM mlp))
            UNION ALL SELECT 'payment_detail', (SELECT count(*) FROM detail)
            UNION ALL SELECT 'member_loan_summary', (SELECT count(*) FROM summary))""",
    "refresh_quality": """
        SELECT 'loaded' AS section, 'raw_members' AS measure, count(*) AS "value" FROM raw_members
        UNION ALL SELECT 'loaded', 'raw_loans', count(*) FROM raw_loans
        UNION ALL SELECT 'loaded', 'raw_payments', count(*) FROM raw_payments
        UNION ALL SELECT section, measure, 0 FROM (VALUES ('members'), ('loans'), ('payments')) AS s(section),
            (VALUES ('malformed_records'), ('unreadable_cells')) AS m(measure)
        UNION ALL """ + _BODIES["data_quality_report"],
    "rejected_cells": """
        SELECT 'raw_members' AS source, member_id AS "key", 'credit_score' AS "column", 'n.b.' AS "text" FROM raw_members WHERE phone = 'N/A'
        UNION ALL SELECT 'raw_loans', loan_id, 'interest_rate', '5,5 %' FROM raw_loans WHERE loan_status = 'Default' AND loan_type <> 'home equity'
        UNION ALL SELECT 'raw_loans', NULL, NULL, loan_id || ',' || member_id FROM raw_loans WHERE loan_type = 'home equity'
        UNION ALL SELECT 'raw_payments', payment_id, 'actual_amount', 'half' FROM raw_payments WHERE payment_status = 'PARTIAL'
        UNION ALL SELECT 'raw_payments', NULL, NULL, loan_id || ',a,b,c,d,e,f,g' FROM raw_payments WHERE payment_status = 'MISSED'""",
    "data_quality_report_rejects": _BODIES["data_quality_report"] + """
        UNION ALL SELECT 'members', 'malformed_records', 0
        UNION ALL SELECT 'members', 'unreadable_cells', count(*) FROM raw_members WHERE phone = 'N/A'
        UNION ALL SELECT 'loans', 'malformed_records', count(*) FROM whole_loans WHERE loan_type = 'home equity'
        UNION ALL SELECT 'loans', 'unreadable_cells', count(*) FROM raw_loans WHERE loan_status = 'Default'
        UNION ALL SELECT 'payments', 'malformed_records', count(*) FROM whole_payments WHERE payment_status = 'MISSED'
        UNION ALL SELECT 'payments', 'unreadable_cells', count(*) FROM raw_payments WHERE payment_status = 'PARTIAL'""",
}

# What reading makes of the raw tables where cells or records can't be used.
_READ = {
    "raw_members": f"SELECT * REPLACE (CASE WHEN phone <> 'N/A' OR phone IS NULL THEN credit_score END AS credit_score) FROM ({RAW_MEMBERS_SQL})",
    "whole_loans": RAW_LOANS_SQL,
    "raw_loans": """SELECT * REPLACE (CASE WHEN loan_status <> 'Default' THEN interest_rate END AS interest_rate) FROM whole_loans
        WHERE loan_type <> 'home equity'""",
    "whole_payments": RAW_PAYMENTS_SQL,
    "raw_payments": """SELECT * REPLACE (CASE WHEN payment_status IS DISTINCT FROM 'PARTIAL' THEN actual_amount END AS actual_amount)
        FROM whole_payments WHERE payment_status IS DISTINCT FROM 'MISSED'""",
}


def _statement(body: str, tables: dict[str, str] | None = None) -> str:
    # replaced tables come first: the others need them
    ctes = {**tables, **{name: text for name, text in _CTES.items() if name not in tables}} if tables else _CTES
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes.items()) + "\n" + body


ORACLE_SQL: dict[str, str] = {
    name: _statement(body, _READ if name == "data_quality_report_rejects" else None) for name, body in _BODIES.items()
}

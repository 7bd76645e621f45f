"""Queries over the outputs of a day: reports, views, visuals, checks.

The outputs (alerts, rings, runs, holdout, features, decisions, checks, reports, accounts) are made here from the supplied tables by
expressions that mean the same in both engines; the SQL beside each query is written on its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import reports
from .registry import query, read

DAY = "DATE '2024-01-02' + CAST(7 * r_regionkey AS INT)"
WHO = {"account_id": "'A' || CAST(c_custkey AS STRING)", "cif": "'C' || CAST(c_custkey % 700 AS STRING)", "branch_code": "'B' || CAST(c_nationkey AS STRING)", "product_code": "c_mktsegment"}
RISK = "(c_acctbal + 200 * r_regionkey)"
#: Of each table: what it comes from, which rows, and its columns.
TABLES: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "mule_features": ("customer region", None, WHO | {
        "snapshot_date": DAY, "min_kyc_flag": "CAST(c_custkey % 3 = 0 AS INT)", "hops_to_known_mule": "CAST(1 + (c_custkey + r_regionkey) % 4 AS INT)", "pass_through_ratio_7d": "((c_custkey * 7 + r_regionkey) % 101) / 100",
        "median_hold_hours_30d": "(c_custkey % 1440) / 2", "account_age_days": "CAST(c_custkey % 900 AS INT)", "distinct_senders_7d": "CAST(c_custkey % 20 AS INT)", "new_device_logins_30d": "CAST(c_custkey % 3 AS INT)",
        "accounts_on_same_device": "CAST(1 + c_custkey % 4 AS INT)", "cifs_sharing_mobile": "CAST(1 + c_custkey % 2 AS INT)", "is_mule_90d": "CASE WHEN r_regionkey < 3 THEN CAST(c_acctbal + 500 * ((c_custkey + r_regionkey) % 3) > 9200 AS INT) END",
    }),
    "mule_alerts": ("customer region", f"{RISK} > 7000", WHO | {
        "run_date": DAY, "snapshot_date": DAY, "run_id": "'run-' || CAST(r_regionkey AS STRING)", "p_mule": f"{RISK} / 20000", "p_mule_adj": f"{RISK} / 200000", "risk_pct": "c_custkey / 1000000",
        "risk_rank": "CAST(row_number() OVER (PARTITION BY r_regionkey ORDER BY c_acctbal DESC, c_custkey) AS INT)", "tier": f"CASE WHEN {RISK} > 9500 THEN 'T1_FREEZE_REVIEW' WHEN {RISK} > 8500 THEN 'T2_HOLD_MONITOR' ELSE 'T3_WATCHLIST' END",
        "action": "'act on ' || c_mktsegment", "ring_id": "'R' || CAST(c_custkey % 100 AS STRING)", "ring_size": "CAST(1 + c_custkey % 6 AS INT)", "hops_to_known_mule": "CAST(1 + c_custkey % 3 AS INT)",
        "reason_codes": "CASE c_custkey % 4 WHEN 0 THEN 'PASS_THROUGH,RING' WHEN 1 THEN 'NEAR_KNOWN_MULE' WHEN 2 THEN '' ELSE 'MIN_KYC,PASS_THROUGH,NEW_ACCOUNT' END", "reasons": "'why ' || c_name",
    }),
    "mule_rings": ("supplier region", None, {
        "run_date": DAY, "run_id": "'run-' || CAST(r_regionkey AS STRING)", "ring_id": "'R' || CAST(s_suppkey AS STRING)", "ring_size": "CAST(2 + s_nationkey % 7 AS INT)", "accounts_scored": "CAST(3 + s_nationkey % 7 AS INT)", "accounts_alerted": "CAST(s_nationkey % 3 AS INT)",
        "top_tier": "CASE WHEN s_acctbal > 8000 THEN 'T1_FREEZE_REVIEW' ELSE 'T3_WATCHLIST' END", "max_p_mule_adj": "(s_acctbal + 1000) / 11000", "sum_p_mule_adj": "(s_acctbal + 1000 + r_regionkey) / 128",
        "min_hops_to_known_mule": "CAST(1 + s_suppkey % 3 AS INT)", "top_reason_codes": "'RING'",
    }),
    "mule_model_run": ("region", None, {
        "run_date": DAY, "run_id": "'run-' || CAST(r_regionkey AS STRING)", "run_ts": f"CAST({DAY} AS TIMESTAMP)", "snapshot_date": DAY, "model_family": "'stub'", "model_id": "'stub'", "device": "'spark'", "scored_accounts": "CAST(1000 * (r_regionkey + 1) AS INT)",
        "alerts_t1": "CAST(3 + r_regionkey AS INT)", "alerts_t2": "CAST(9 + r_regionkey AS INT)", "alerts_t3": "CAST(20 + r_regionkey AS INT)", "context_rows": "CAST(80 + r_regionkey AS INT)", "context_from": "DATE '2023-06-01'", "context_to": "DATE '2023-10-01'",
        "book_mule_rate": "(r_regionkey + 1) / 4096", "holdout_auc": "(90 + r_regionkey) / 128", "holdout_pr_auc": "(30 + r_regionkey) / 128", "capture_top1": "(50 + r_regionkey) / 128", "capture_top5": "(70 + r_regionkey) / 128",
        "precision_top02": "(20 + r_regionkey) / 128", "precision_top1": "(10 + r_regionkey) / 128", "rules_capture_top1": "(40 + r_regionkey) / 128", "rules_precision_top1": "(8 + r_regionkey) / 128", "lift_over_rules": "(150 + r_regionkey) / 128",
        "t1_cutoff": "(60 + r_regionkey) / 128", "gate_passed": "r_regionkey <> 2", "alerts_published": "r_regionkey <> 2", "gate_detail": "r_name", "source_snapshot_id": "CAST(r_regionkey AS STRING)", "triggered_by": "'manual'", "duration_s": "r_regionkey / 2",
    }),
    "mule_holdout": ("nation", None, {
        "run_date": "DATE '2024-01-02' + CAST(7 * n_regionkey AS INT)", "run_id": "'run-' || CAST(n_regionkey AS STRING)", "band": "n_name", "upto_pct": "(n_nationkey + 1) / 32", "accounts": "CAST(n_nationkey * 37 % 400 AS DOUBLE)",
        "mules": "CAST(n_nationkey % 7 AS DOUBLE)", "mule_rate": "n_nationkey / 128", "mean_p_mule": "n_nationkey / 256", "cum_capture": "(n_nationkey + 1) / 32", "rules_cum_capture": "n_nationkey / 32",
    }),
    "investigator_decisions": ("orders", "o_totalprice > 200000", {
        "decision_id": "'D' || CAST(o_orderkey AS STRING)", "decided_at": "o_orderdate", "account_id": "'A' || CAST(o_custkey AS STRING)", "cif": "'C' || CAST(o_custkey % 700 AS STRING)", "decision": "CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED_MULE' ELSE 'FALSE_POSITIVE' END",
        "action": "o_orderpriority", "maker": "'m' || CAST(o_custkey % 9 AS STRING)", "checker": "'c' || CAST(o_custkey % 7 AS STRING)", "notes": "o_orderstatus",
    }),
    "dq_results": ("supplier", None, {
        "pipeline_run": "CASE s_nationkey % 4 WHEN 0 THEN 'scheduled__2024-01-01' WHEN 1 THEN 'manual-2024' WHEN 2 THEN 'manual__2024' ELSE 'backfill' END", "run_id": "'q' || CAST(s_nationkey % 4 AS STRING)",
        "run_ts": "CAST(DATE '2024-01-01' + CAST(10 * (s_nationkey % 4) + 2 * (s_suppkey % 5) + CASE WHEN s_acctbal < 500 THEN 0 ELSE 1 END AS INT) AS TIMESTAMP)", "as_of": "DATE '2024-01-01'",
        "layer": "CASE s_suppkey % 5 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' WHEN 2 THEN 'gold' WHEN 3 THEN 'publish' ELSE 'extra' END", "table_name": "'t' || CAST(s_nationkey % 5 AS STRING)",
        "check_name": "CASE s_nationkey % 6 WHEN 0 THEN 'row count' WHEN 1 THEN 'no raw PAN here' WHEN 2 THEN 'early label (leakage)' WHEN 3 THEN 'is a SHA-256 digest' ELSE 'check ' || CAST(s_nationkey AS STRING) END",
        "expectation_type": "CASE s_nationkey % 9 WHEN 0 THEN 'row_count' WHEN 1 THEN 'not_null' WHEN 2 THEN 'unique' WHEN 3 THEN 'in_set' WHEN 4 THEN 'range' WHEN 5 THEN 'not_after_as_of' WHEN 6 THEN 'reconciliation_equal' WHEN 7 THEN 'rate_at_most' ELSE 'volume_change' END",
        "column_name": "CASE WHEN s_nationkey > 12 THEN 'cif' END", "severity": "CASE WHEN s_nationkey % 2 = 0 THEN 'critical' ELSE 'warning' END", "success": "s_acctbal > 1000", "observed_value": "CAST(s_nationkey AS STRING)",
        "element_count": "s_suppkey * 10", "unexpected_count": "CASE WHEN s_nationkey % 3 > 0 THEN s_suppkey % 4 END", "unexpected_pct": "s_nationkey / 8",
        "kwargs": """CASE s_nationkey % 9 WHEN 0 THEN '{"min_value": 5}' WHEN 6 THEN '{"expected": 7}' WHEN 7 THEN '{"max_rate": 0.25}' END""", "table_snapshot_id": "s_suppkey",
    }),
    "txn": ("events", None, {"account_id": "'A' || CAST(user_id AS STRING)", "txn_date": "CAST(ts AS DATE)", "direction": "CASE WHEN event_type IN ('purchase', 'signup') THEN 'CR' ELSE 'DR' END", "amount": "value * 4096"}),
    "report": ("orders", "o_totalprice > 100000", {"report_id": "o_orderkey", "report_date": "CURRENT_DATE - CAST(o_orderkey % 700 AS INT)", "account_id": "CASE WHEN o_orderstatus <> 'P' THEN 'A' || CAST(o_custkey AS STRING) END", "category": "o_orderpriority", "amount": "o_totalprice"}),
    "account": ("customer", None, WHO | {"open_date": "DATE '1990-01-01' + CAST(c_custkey % 400 AS INT)", "reactivated_on": "CASE WHEN c_acctbal > 5000 THEN DATE '1994-01-01' END", "freeze_date": "CASE WHEN c_acctbal < 0 THEN DATE '1994-01-01' END"}),
    "branch_map": ("nation", None, {"branch_code": "'B' || CAST(n_nationkey AS STRING)", "branch_name": "n_name", "city": "'city of ' || n_name", "state": "'S' || CAST(n_nationkey % 6 AS STRING)", "region": "'region ' || CAST(n_regionkey AS STRING)"}),
    "product_map": ("region", None, {"product_code": "CASE r_regionkey WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE' WHEN 3 THEN 'MACHINERY' ELSE 'HOUSEHOLD' END", "product_name": "'product ' || CAST(r_regionkey AS STRING)"}),
}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    out = {}
    for name, (sources, rows, columns) in TABLES.items():
        first, *more = sources.split()
        df = read(spark, sf_dir, first)
        for m in more:
            df = df.crossJoin(F.broadcast(read(spark, sf_dir, m)))  # five regions stand for five days
        out[name] = (df.where(rows) if rows else df).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
    return out


def made(*names: str) -> str:
    """The tables as parts of a WITH."""
    return ", ".join(f"{n} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in TABLES[n][2].items())} FROM {' CROSS JOIN '.join(TABLES[n][0].split())}{f' WHERE {TABLES[n][1]}' if TABLES[n][1] else ''})" for n in names)


def plain(df: DataFrame) -> DataFrame:
    """Times without a zone, as the other engine has them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in df.schema.fields])


def report(sql: str, tables_: str, **options):
    """Registers a report or view under `day_<name>`."""

    def put(make):
        def run(spark, sf_dir):
            return plain(make(tables(spark, sf_dir), **options))

        run.__name__ = f"day_{make.__name__}"
        query(f"WITH {made(*tables_.split())} {sql}")(run)
        return make

    return put


NOW = "(SELECT max(run_date) FROM mule_alerts)"
KYC = "CASE WHEN {}min_kyc_flag = 1 THEN 'Min-KYC (OTP)' ELSE 'Full KYC' END"
LATEST = "CASE WHEN {0}run_date = (SELECT max(run_date) FROM {1}) THEN 1 ELSE 0 END AS is_latest"

report(f"SELECT tier, count(*) AS accounts, round(avg(p_mule_adj), 5) AS mean_p_mule_adj, count(DISTINCT ring_id) AS distinct_rings FROM mule_alerts WHERE run_date = {NOW} GROUP BY tier ORDER BY min(risk_rank)", "mule_alerts")(reports.alert_counts)
report(f"SELECT risk_rank, account_id, cif, branch_code, product_code, tier, action, p_mule_adj, ring_size, hops_to_known_mule, reasons FROM mule_alerts WHERE run_date = {NOW} ORDER BY risk_rank LIMIT 25", "mule_alerts")(reports.top_alerts)
report("SELECT snapshot_date, count(*) AS active_accounts, CAST(sum(is_mule_90d) AS BIGINT) AS confirmed_mules, round(avg(is_mule_90d), 5) AS mule_rate FROM mule_features GROUP BY 1 ORDER BY 1 DESC LIMIT 20", "mule_features")(reports.weekly_book)
report("SELECT ring_id, ring_size, accounts_scored, accounts_alerted, top_tier, max_p_mule_adj, sum_p_mule_adj, min_hops_to_known_mule, top_reason_codes FROM mule_rings WHERE run_date = (SELECT max(run_date) FROM mule_rings) ORDER BY sum_p_mule_adj DESC, ring_id LIMIT 25", "mule_rings")(reports.ring_report)
report("""SELECT run_date, run_id, run_ts, model_family, model_id, device, scored_accounts, alerts_t1, alerts_t2, alerts_t3, context_rows, context_from, context_to, book_mule_rate, holdout_auc, capture_top1, precision_top02, lift_over_rules, gate_passed,
alerts_published, source_snapshot_id, triggered_by FROM mule_model_run ORDER BY run_date DESC""", "mule_model_run")(reports.run_lineage)
report("""SELECT al.run_date, al.tier, count(*) AS accounts, CAST(sum(f.is_mule_90d) AS BIGINT) AS confirmed_mules, round(avg(f.is_mule_90d), 3) AS confirm_rate, round(avg(al.p_mule_adj), 5) AS mean_p_mule_adj FROM mule_alerts al JOIN mule_features f
ON f.account_id = al.account_id AND f.snapshot_date = al.snapshot_date WHERE f.is_mule_90d IS NOT NULL GROUP BY 1, 2 ORDER BY 1, min(al.risk_rank)""", "mule_alerts mule_features")(reports.past_alerts)
report("SELECT decided_at, account_id, cif, decision, action, maker, checker, notes FROM investigator_decisions ORDER BY decided_at DESC, decision_id LIMIT 50", "investigator_decisions")(reports.decision_log)
report("""SELECT run_date, model_family, scored_accounts, alerts_t1, alerts_t2, alerts_t3, alerts_t1 + alerts_t2 + alerts_t3 AS total_alerts, round(100 * (alerts_t1 + alerts_t2 + alerts_t3) / scored_accounts, 2) AS pct_of_book_alerted, round(100 * book_mule_rate, 3) AS book_mule_rate_pct,
round(100 * capture_top1, 1) AS model_capture_top1_pct, round(100 * rules_capture_top1, 1) AS rules_capture_top1_pct, round(lift_over_rules, 2) AS lift_over_rules, round(100 * precision_top02, 1) AS t1_precision_pct, gate_passed, triggered_by
FROM mule_model_run WHERE run_ts = (SELECT max(run_ts) FROM mule_model_run)""", "mule_model_run")(reports.briefing)
report(f"""SELECT region, state, city, branch_name, k.n AS active_accounts, coalesce(a.n, 0) AS alerts, coalesce(a.t, 0) AS t1_freeze, round(1000 * coalesce(a.n, 0) / k.n, 1) AS alerts_per_1000
FROM (SELECT branch_code, count(*) AS n FROM mule_features WHERE snapshot_date = {NOW} GROUP BY 1) k JOIN branch_map b ON b.branch_code = k.branch_code LEFT JOIN (SELECT branch_code, count(*) AS n, count(*) FILTER (WHERE tier = 'T1_FREEZE_REVIEW') AS t FROM mule_alerts
WHERE run_date = {NOW} GROUP BY 1) a ON a.branch_code = k.branch_code ORDER BY alerts_per_1000 DESC, region, state, city, branch_name LIMIT 15""", "mule_alerts mule_features branch_map")(reports.branch_hotspots)
report(f"""SELECT product_name, {KYC.format('f.')} AS kyc, count(*) AS active_accounts, count(a.account_id) AS alerts, round(100 * count(a.account_id) / count(*), 2) AS alert_rate_pct, count(CASE WHEN a.tier = 'T1_FREEZE_REVIEW' THEN 1 END) AS t1_freeze FROM mule_features f
JOIN product_map p ON p.product_code = f.product_code LEFT JOIN (SELECT account_id, tier FROM mule_alerts WHERE run_date = {NOW}) a ON a.account_id = f.account_id WHERE f.snapshot_date = {NOW} GROUP BY 1, 2""", "mule_alerts mule_features product_map")(reports.product_rates)
report(f"""SELECT code, count(*) AS t1_accounts, round(100 * count(*) / (SELECT count(*) FROM mule_alerts WHERE run_date = {NOW} AND tier = 'T1_FREEZE_REVIEW'), 1) AS pct_of_t1 FROM mule_alerts JOIN (VALUES ('NEAR_KNOWN_MULE'), ('PASS_THROUGH'), ('MIN_KYC'), ('NEW_ACCOUNT'), ('RING')) v(code)
ON ',' || reason_codes || ',' LIKE '%,' || code || ',%' WHERE run_date = {NOW} AND tier = 'T1_FREEZE_REVIEW' GROUP BY 1""", "mule_alerts")(reports.t1_reasons)
report("""SELECT CASE hops_to_known_mule WHEN 1 THEN '1 hop' WHEN 2 THEN '2 hops' ELSE '3+ hops / none' END AS distance_to_known_mule, count(*) AS labelled_rows, CAST(sum(is_mule_90d) AS BIGINT) AS became_mule_within_90d, round(100 * avg(CAST(is_mule_90d AS DOUBLE)), 3) AS mule_rate_pct
FROM mule_features WHERE is_mule_90d IS NOT NULL GROUP BY 1""", "mule_features")(reports.rate_by_hops)
report("""SELECT CASE WHEN pass_through_ratio_7d >= 0.9 THEN 'a. >= 90%' WHEN pass_through_ratio_7d >= 0.7 THEN 'b. 70-90%' WHEN pass_through_ratio_7d >= 0.4 THEN 'c. 40-70%' WHEN pass_through_ratio_7d > 0 THEN 'd. 0-40%' ELSE 'e. none' END AS pass_through_band, count(*) AS labelled_rows,
CAST(sum(is_mule_90d) AS BIGINT) AS mules, round(100 * avg(CAST(is_mule_90d AS DOUBLE)), 3) AS mule_rate_pct, round(avg(median_hold_hours_30d), 1) AS avg_hold_hours FROM mule_features WHERE is_mule_90d IS NOT NULL GROUP BY 1""", "mule_features")(reports.rate_by_pass_through)
report("""SELECT ring_id, ring_size, accounts_scored, accounts_alerted, round(100 * accounts_alerted / accounts_scored, 0) AS pct_alerted, top_tier, round(max_p_mule_adj, 4) AS max_p_mule_adj, round(sum_p_mule_adj, 4) AS ring_risk, min_hops_to_known_mule, top_reason_codes FROM mule_rings
WHERE run_date = (SELECT max(run_date) FROM mule_rings) ORDER BY sum_p_mule_adj DESC, ring_id LIMIT 15""", "mule_rings")(reports.rings_first)
report(f"""SELECT coalesce(al.tier, 'Not alerted') AS tier, count(DISTINCT t.account_id) AS accounts, round(sum(CASE WHEN direction = 'CR' THEN amount ELSE 0 END) / 1e7, 2) AS credits_inr_crore, round(sum(CASE WHEN direction = 'DR' THEN amount ELSE 0 END) / 1e7, 2) AS debits_inr_crore,
round(100 * sum(CASE WHEN direction = 'DR' THEN amount ELSE 0 END) / nullif(sum(CASE WHEN direction = 'CR' THEN amount ELSE 0 END), 0), 0) AS pct_forwarded, round(sum(CASE WHEN direction = 'CR' THEN amount ELSE 0 END) / count(DISTINCT t.account_id), 0) AS avg_credit_per_account_inr
FROM txn t LEFT JOIN (SELECT account_id, tier FROM mule_alerts WHERE run_date = {NOW}) al ON al.account_id = t.account_id WHERE txn_date > {NOW} - 30 AND txn_date <= {NOW} GROUP BY 1""", "mule_alerts txn")(reports.money_at_risk)
report("""SELECT band, upto_pct, accounts, mules, round(100 * mule_rate, 2) AS mule_rate_pct, round(100 * cum_capture, 1) AS model_cum_capture_pct, round(100 * rules_cum_capture, 1) AS rules_cum_capture_pct FROM mule_holdout
WHERE run_id = (SELECT run_id FROM mule_model_run ORDER BY run_ts DESC LIMIT 1) ORDER BY upto_pct""", "mule_model_run mule_holdout")(reports.capture_curve)
report("""SELECT CAST(date_trunc('month', report_date) AS DATE) AS month, category, count(*) AS complaints, count(DISTINCT account_id) AS accounts_reported, round(sum(amount) / 1e5, 1) AS amount_inr_lakh FROM report
WHERE report_date >= CAST(CAST(current_date AS DATE) - INTERVAL 12 MONTH AS DATE) GROUP BY 1, 2 ORDER BY 1 DESC, 3 DESC, 2 LIMIT 40""", "report")(reports.monthly_reports)
report("""SELECT product_name, count(*) AS reported_accounts, CAST(quantile_disc(date_diff('day', open_date, first_report), 0.5) AS INTEGER) AS median_days_open_to_report, count(reactivated_on) AS were_dormant_reactivated, count(freeze_date) AS frozen FROM (SELECT account_id, min(report_date) AS first_report
FROM report WHERE account_id IS NOT NULL GROUP BY 1) r JOIN account a ON a.account_id = r.account_id JOIN product_map p ON p.product_code = a.product_code GROUP BY 1""", "report account product_map")(reports.days_to_report)

# ---------------------------------------------------------------- views

BAND = "CASE WHEN {0} >= 0.9 THEN 'a. 90% or more' WHEN {0} >= 0.7 THEN 'b. 70-90%' WHEN {0} >= 0.4 THEN 'c. 40-70%' WHEN {0} > 0 THEN 'd. under 40%' ELSE 'e. none' END"
HOPS = "CASE WHEN {0} <= 1 THEN '1 hop' WHEN {0} = 2 THEN '2 hops' ELSE '3+ hops / none' END"
V_ALERTS = f"""SELECT a.run_date, {LATEST.format('a.', 'mule_alerts')}, a.run_id, a.risk_rank, a.account_id, a.cif, a.tier, a.action, a.branch_code, b.branch_name, b.city, b.state, b.region, a.product_code, p.product_name, {KYC.format('f.')} AS kyc_type,
coalesce(nullif(split_part(a.reason_codes, ',', 1), ''), 'MODEL_ONLY') AS main_reason, a.reason_codes, a.reasons, a.ring_id, a.ring_size, CASE WHEN a.ring_size > 1 THEN 1 ELSE 0 END AS in_ring, a.hops_to_known_mule, CASE WHEN a.hops_to_known_mule <= 1 THEN 1 ELSE 0 END AS near_known_mule,
a.p_mule, a.p_mule_adj, a.risk_pct, f.account_age_days, f.pass_through_ratio_7d, f.median_hold_hours_30d, f.distinct_senders_7d, f.new_device_logins_30d, f.accounts_on_same_device, f.cifs_sharing_mobile FROM mule_alerts a
LEFT JOIN branch_map b ON b.branch_code = a.branch_code LEFT JOIN product_map p ON p.product_code = a.product_code LEFT JOIN mule_features f ON f.account_id = a.account_id AND f.snapshot_date = a.snapshot_date"""
V_REASONS = f"""SELECT a.run_date, {LATEST.format('a.', 'mule_alerts')}, a.account_id, a.tier, b.region, code AS reason_code FROM mule_alerts a LEFT JOIN branch_map b ON b.branch_code = a.branch_code
JOIN (VALUES ('NEAR_KNOWN_MULE'), ('PASS_THROUGH'), ('MIN_KYC'), ('NEW_ACCOUNT'), ('RING'), ('FAST_HOLD')) v(code) ON ',' || a.reason_codes || ',' LIKE '%,' || code || ',%'"""
V_RINGS = f"""SELECT run_date, {LATEST.format('', 'mule_rings')}, CAST(row_number() OVER (PARTITION BY run_date ORDER BY sum_p_mule_adj DESC, ring_id) AS INTEGER) AS ring_rank, ring_id, ring_size, accounts_scored, accounts_alerted, accounts_alerted / accounts_scored AS alerted_share, top_tier,
max_p_mule_adj, sum_p_mule_adj AS ring_risk, min_hops_to_known_mule, top_reason_codes FROM mule_rings"""
V_WEEKLY = f"""SELECT snapshot_date, region, product_name, {KYC.format('f.')} AS kyc_type, {HOPS.format('hops_to_known_mule')} AS hops_band, {BAND.format('pass_through_ratio_7d')} AS pass_through_band, count(*) AS accounts, count(is_mule_90d) AS labelled, CAST(sum(is_mule_90d) AS BIGINT) AS mules
FROM mule_features f LEFT JOIN branch_map b ON b.branch_code = f.branch_code LEFT JOIN product_map p ON p.product_code = f.product_code GROUP BY 1, 2, 3, 4, 5, 6"""
V_RUN = """SELECT run_date, CASE WHEN run_ts = (SELECT max(run_ts) FROM mule_model_run) THEN 1 ELSE 0 END AS is_latest, run_id, run_ts, model_family, device, triggered_by, scored_accounts, alerts_t1, alerts_t2, alerts_t3, alerts_t1 + alerts_t2 + alerts_t3 AS alerts_total, book_mule_rate, holdout_auc, holdout_pr_auc,
capture_top1, capture_top5, precision_top02, precision_top1, rules_capture_top1, rules_precision_top1, lift_over_rules, t1_cutoff, CAST(gate_passed AS INTEGER) AS gate_passed, CAST(alerts_published AS INTEGER) AS alerts_published, gate_detail, duration_s FROM mule_model_run"""
V_HOLDOUT = """SELECT run_date, CASE WHEN run_id = (SELECT run_id FROM mule_model_run ORDER BY run_ts DESC LIMIT 1) THEN 1 ELSE 0 END AS is_latest, row_number() OVER (PARTITION BY run_id ORDER BY upto_pct) || '. ' || band AS band_label, upto_pct, CAST(accounts AS INTEGER) AS accounts, CAST(mules AS INTEGER) AS mules,
mule_rate, mean_p_mule, cum_capture AS model_cum_capture, rules_cum_capture FROM mule_holdout"""
RUN_TYPE = "CASE WHEN pipeline_run LIKE 'scheduled~_~_%' ESCAPE '~' THEN 'nightly' WHEN pipeline_run LIKE 'manual-%' THEN 'by hand' WHEN pipeline_run LIKE 'manual~_~_%' ESCAPE '~' THEN 'triggered' ELSE 'other' END"
V_DQ = f"""SELECT pipeline_run, {RUN_TYPE} AS run_type, CAST(as_of AS VARCHAR) || ' ' || {RUN_TYPE} || ' ' || strftime(started_ts, '%H:%M') AS run_label, run_id, run_ts, as_of, layer, layer_order, layer_order || '. ' || layer AS layer_label, table_name, check_name, expectation_type AS rule,
CASE WHEN check_name LIKE '%raw PAN%' OR check_name LIKE '%SHA-256%' THEN 'Privacy' WHEN check_name LIKE '%(leakage)%' THEN 'Leakage guard' WHEN expectation_type IN ('row_count', 'volume_change') THEN 'Volume' WHEN expectation_type = 'not_null' THEN 'Completeness' WHEN expectation_type = 'unique' THEN 'Uniqueness'
WHEN expectation_type = 'reconciliation_equal' THEN 'Reconciliation' WHEN expectation_type = 'rate_at_most' THEN 'Rate limit' WHEN expectation_type = 'not_after_as_of' THEN 'Timeliness' ELSE 'Validity' END AS category, column_name, severity, CAST(success AS INTEGER) AS passed, 1 - CAST(success AS INTEGER) AS failed,
CASE WHEN success AND unexpected_count > 0 THEN 1 ELSE 0 END AS near_miss, observed_value, actual, expected, actual - expected AS diff, CASE WHEN expectation_type = 'rate_at_most' THEN 100 * actual END AS rate_pct, CASE WHEN expectation_type = 'rate_at_most' THEN 100 * expected END AS limit_pct,
unexpected_count, unexpected_pct, element_count, CASE WHEN expectation_type = 'row_count' AND check_name = 'row count' THEN CAST(observed_value AS BIGINT) END AS row_count, kwargs AS note, table_snapshot_id, CASE WHEN pipeline_run = newest THEN 1 ELSE 0 END AS is_latest
FROM (SELECT *, CASE layer WHEN 'bronze' THEN 1 WHEN 'silver' THEN 2 WHEN 'gold' THEN 3 WHEN 'publish' THEN 4 ELSE 9 END AS layer_order, CASE WHEN expectation_type IN ('row_count', 'reconciliation_equal', 'rate_at_most', 'volume_change') THEN CAST(observed_value AS DOUBLE) ELSE CAST(unexpected_count AS DOUBLE) END AS actual,
CASE expectation_type WHEN 'row_count' THEN CAST(json_extract_string(kwargs, '$.min_value') AS DOUBLE) WHEN 'reconciliation_equal' THEN CAST(json_extract_string(kwargs, '$.expected') AS DOUBLE) WHEN 'rate_at_most' THEN CAST(json_extract_string(kwargs, '$.max_rate') AS DOUBLE) WHEN 'volume_change' THEN NULL ELSE 0.0 END AS expected,
max(run_ts) OVER (PARTITION BY pipeline_run, layer) AS last_ts, min(run_ts) OVER (PARTITION BY pipeline_run) AS started_ts, arg_max(pipeline_run, run_ts) OVER (PARTITION BY layer) AS newest FROM dq_results) WHERE run_ts = last_ts"""
V_DQ_RUN = f"""SELECT pipeline_run, run_type, run_label, as_of, layer, layer_order, layer_label, max(is_latest) AS is_latest, max(run_ts) AS checked_at, count(*) AS checks, CAST(sum(passed) AS BIGINT) AS passed, CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(CASE WHEN severity = 'critical' THEN failed ELSE 0 END) AS BIGINT) AS critical_failed,
CAST(sum(CASE WHEN severity = 'warning' THEN failed ELSE 0 END) AS BIGINT) AS warnings_failed, CAST(sum(near_miss) AS BIGINT) AS near_misses, count(DISTINCT table_name) AS table_count, CAST(sum(row_count) AS BIGINT) AS rows_checked,
round((epoch(max(run_ts)) - epoch(min(min(run_ts)) OVER (PARTITION BY pipeline_run))) / 60, 1) AS minutes_after_bronze FROM ({V_DQ}) GROUP BY 1, 2, 3, 4, 5, 6, 7"""
VIEW_SQL = {
    "v_alerts": (V_ALERTS, "mule_alerts mule_features branch_map product_map"), "v_alert_reasons": (V_REASONS, "mule_alerts branch_map"), "v_rings": (V_RINGS, "mule_rings"), "v_book_weekly": (V_WEEKLY, "mule_features branch_map product_map"),
    "v_model_run": (V_RUN, "mule_model_run"), "v_holdout": (V_HOLDOUT, "mule_model_run mule_holdout"), "v_dq": (V_DQ, "dq_results"), "v_dq_run": (V_DQ_RUN, "dq_results"),
}
for _name, (_sql, _from) in VIEW_SQL.items():
    report(_sql, _from)(reports.VIEWS[_name])

# ---------------------------------------------------------------- visuals


def visual(spec: reports.Visual, sql: str):
    """Registers a visual under `visual_<title>`; sql selects from the view by its name."""
    view_sql, from_ = VIEW_SQL[spec.view]

    def run(spark, sf_dir):
        return plain(spec.frame(reports.VIEWS[spec.view](tables(spark, sf_dir))))

    run.__name__ = "visual_" + "_".join(spec.title.lower().split())
    query(f"WITH {made(*from_.split())}, {spec.view} AS ({view_sql}) {sql}")(run)


KPI_SQL = {
    "Alerts": "SELECT count(*) AS alerts, count(CASE WHEN tier = 'T1_FREEZE_REVIEW' THEN 1 END) AS t1_freeze, count(DISTINCT CASE WHEN in_ring = 1 THEN ring_id END) AS rings_touched, cast(round(sum(cast(p_mule_adj as decimal(18,6))), 1) as double) AS expected_mules, CAST(sum(near_known_mule) AS BIGINT) AS near_known_mule FROM v_alerts WHERE is_latest = 1",
    "Reasons": "SELECT reason_code, count(*) AS alerts FROM v_alert_reasons WHERE is_latest = 1 GROUP BY 1 ORDER BY 2 DESC, 1",
    "Rings": "SELECT count(*) AS rings, count(CASE WHEN accounts_alerted > 0 THEN 1 END) AS rings_alerted, max(CASE WHEN accounts_alerted > 0 THEN ring_size END) AS largest_alerted FROM v_rings WHERE is_latest = 1",
    "Rate by hops": "SELECT hops_band, CAST(sum(labelled) AS BIGINT) AS labelled, CAST(sum(mules) AS BIGINT) AS mules, round(100 * sum(mules) / sum(labelled), 3) AS mule_rate_pct FROM v_book_weekly GROUP BY 1",
    "Trust": "SELECT run_date, max(holdout_auc) AS holdout_auc, max(capture_top1) AS capture_top1, max(rules_capture_top1) AS rules_capture_top1, max(precision_top02) AS precision_top02, max(lift_over_rules) AS lift_over_rules, max(gate_passed) AS gate_passed FROM v_model_run GROUP BY 1",
    "Capture": "SELECT band_label, max(model_cum_capture) AS model_cum_capture, max(rules_cum_capture) AS rules_cum_capture FROM v_holdout WHERE is_latest = 1 GROUP BY 1",
    "Checks": "SELECT count(*) AS checks, round(100 * sum(passed) / count(*), 2) AS pass_rate_pct, CAST(sum(CASE WHEN severity = 'critical' THEN failed ELSE 0 END) AS BIGINT) AS critical_failed, CAST(sum(CASE WHEN severity = 'warning' THEN failed ELSE 0 END) AS BIGINT) AS warnings_failed, CAST(sum(near_miss) AS BIGINT) AS near_misses, CAST(sum(row_count) AS BIGINT) AS rows_checked FROM v_dq WHERE is_latest = 1",
    "Checks by category": "SELECT layer_label, category, count(*) AS checks, CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(near_miss) AS BIGINT) AS near_misses FROM v_dq WHERE is_latest = 1 GROUP BY 1, 2",
}
for _v in reports.kpis():
    visual(_v, KPI_SQL[_v.title])

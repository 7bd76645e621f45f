"""Reports and views over the outputs, and a builder for dashboard visuals. t: tables by name."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contract import LABEL, NO_TIER

Tables = dict[str, DataFrame]
T1 = "T1_FREEZE_REVIEW"


def latest_rows(df: DataFrame, column: str = "run_date") -> DataFrame:
    """The rows of the latest value: one aggregate row joined back."""
    last = df.agg(F.max(column).alias("_last"))
    return df.join(F.broadcast(last), F.col(column) == F.col("_last")).drop("_last")


def flagged_latest(df: DataFrame, column: str = "run_date", source: DataFrame | None = None) -> DataFrame:
    last = (source if source is not None else df).agg(F.max(column).alias("_last"))
    return df.crossJoin(F.broadcast(last)).withColumn("is_latest", F.coalesce((F.col(column) == F.col("_last")).cast("int"), F.lit(0))).drop("_last")


def pct(top: Column, bottom: Column, digits: int) -> Column:
    return F.round(F.try_divide(100 * top, bottom), digits)


def kyc_name() -> Column:
    return F.when(F.col("min_kyc_flag") == 1, "Min-KYC (OTP)").otherwise("Full KYC")


def hops_name() -> Column:
    return F.when(F.col("hops_to_known_mule") <= 1, "1 hop").when(F.col("hops_to_known_mule") == 2, "2 hops").otherwise("3+ hops / none")


def banded(value: Column, limits: Sequence[tuple[float, str]], low: str, none: str) -> Column:
    """The name of the first limit that value reaches, `low` if it is above 0, else `none`."""
    out = F.when(value > 0, low).otherwise(none)
    for limit, name in reversed(list(limits)):
        out = F.when(value >= limit, name).otherwise(out)
    return out


# ---------------------------------------------------------------- reports


def alert_counts(t: Tables) -> DataFrame:
    rows = latest_rows(t["mule_alerts"]).groupBy("tier").agg(F.count("*").alias("accounts"), F.round(F.avg("p_mule_adj"), 5).alias("mean_p_mule_adj"), F.count_distinct("ring_id").alias("distinct_rings"), F.min("risk_rank").alias("_r"))
    return rows.orderBy("_r").drop("_r")


def top_alerts(t: Tables, k: int = 25) -> DataFrame:
    return latest_rows(t["mule_alerts"]).select("risk_rank", "account_id", "cif", "branch_code", "product_code", "tier", "action", "p_mule_adj", "ring_size", "hops_to_known_mule", "reasons").orderBy("risk_rank").limit(k)


def weekly_book(t: Tables, k: int = 20) -> DataFrame:
    rows = t["mule_features"].groupBy("snapshot_date").agg(F.count("*").alias("active_accounts"), F.sum(LABEL).alias("confirmed_mules"), F.round(F.avg(LABEL), 5).alias("mule_rate"))
    return rows.orderBy(F.desc("snapshot_date")).limit(k)


def ring_report(t: Tables, k: int = 25) -> DataFrame:
    columns = ["ring_id", "ring_size", "accounts_scored", "accounts_alerted", "top_tier", "max_p_mule_adj", "sum_p_mule_adj", "min_hops_to_known_mule", "top_reason_codes"]
    return latest_rows(t["mule_rings"]).select(*columns).orderBy(F.desc("sum_p_mule_adj"), "ring_id").limit(k)


def run_lineage(t: Tables) -> DataFrame:
    columns = "run_date run_id run_ts model_family model_id device scored_accounts alerts_t1 alerts_t2 alerts_t3 context_rows context_from context_to book_mule_rate holdout_auc capture_top1 precision_top02 lift_over_rules gate_passed alerts_published source_snapshot_id triggered_by".split()
    return t["mule_model_run"].select(*columns).orderBy(F.desc("run_date"))


def past_alerts(t: Tables) -> DataFrame:
    """How past alerts fared against labels that are known by now."""
    labels = t["mule_features"].where(F.col(LABEL).isNotNull()).select("account_id", "snapshot_date", LABEL)
    rows = t["mule_alerts"].join(labels, ["account_id", "snapshot_date"]).groupBy("run_date", "tier")
    rows = rows.agg(F.count("*").alias("accounts"), F.sum(LABEL).alias("confirmed_mules"), F.round(F.avg(LABEL), 3).alias("confirm_rate"), F.round(F.avg("p_mule_adj"), 5).alias("mean_p_mule_adj"), F.min("risk_rank").alias("_r"))
    return rows.orderBy("run_date", "_r").drop("_r")


def decision_log(t: Tables, k: int = 50) -> DataFrame:
    shown = ["decided_at", "account_id", "cif", "decision", "action", "maker", "checker", "notes"]
    return t["investigator_decisions"].orderBy(F.desc("decided_at"), "decision_id").limit(k).select(*shown)


def context_then(store, version: int, first, last, k: int = 2000) -> DataFrame:
    """Size and label rate of a context as an earlier version of the feature table had it."""
    rows = store.read("mule_features", version).where(F.col(LABEL).isNotNull() & F.col("snapshot_date").between(F.lit(first), F.lit(last)))
    rows = rows.orderBy(F.desc("snapshot_date"), "account_id").limit(k)
    return rows.agg(F.count("*").alias("context_rows"), F.sum(LABEL).alias("context_mules"), F.round(F.avg(LABEL), 3).alias("context_mule_rate"))


def maturity_then(store, at, k: int = 6) -> DataFrame:
    """Rows and labels by snapshot as the feature table was at a time."""
    return store.read("mule_features", at=at).groupBy("snapshot_date").agg(F.count("*").alias("rows_"), F.count(LABEL).alias("labelled")).orderBy(F.desc("snapshot_date")).limit(k)


def versions_compared(store, first: int = 1) -> DataFrame:
    def line(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("rows_"), F.count(LABEL).alias("labelled"), F.max("snapshot_date").alias("latest_snapshot")).select(F.lit(name).alias("version"), "*")

    return line(store.read("mule_features"), "now").unionByName(line(store.read("mule_features", first), "first snapshot"))


def queue(t: Tables) -> DataFrame:
    """The latest alerts, each with its account's last decision and last known label."""
    decided = F.struct("decided_at", "decision_id")
    decisions = t["investigator_decisions"].groupBy("account_id").agg(F.max_by("decision", decided).alias("last_decision"), F.max("decided_at").alias("decided_at"), F.count("*").alias("decisions"))
    labels = t["mule_features"].where(F.col(LABEL).isNotNull()).groupBy("account_id").agg(F.max_by(LABEL, "snapshot_date").alias("last_label"), F.max("snapshot_date").alias("labelled_on"))
    rows = latest_rows(t["mule_alerts"]).select("account_id", "cif", "risk_rank", "tier")
    rows = rows.join(decisions, "account_id", "left").join(labels, "account_id", "left")
    return rows.select("account_id", "cif", "risk_rank", "tier", "last_decision", "decided_at", F.coalesce("decisions", F.lit(0)).alias("decisions"), "last_label", "labelled_on")


def linked(t: Tables, edges: DataFrame, customer: DataFrame) -> DataFrame:
    """The customers that edges (src_cif, dst_cif, first_seen) link to those of the latest alerts, with what is known of them (cif and more) and the tier of their own alert."""
    tiers = latest_rows(t["mule_alerts"]).groupBy(F.col("cif").alias("other_cif")).agg(F.min("tier").alias("tier"))
    ends = edges.select(F.inline(F.array(*[F.struct(F.col(a).alias("cif"), F.col(b).alias("other_cif"), F.col("first_seen")) for a, b in (("src_cif", "dst_cif"), ("dst_cif", "src_cif"))])))
    ends = ends.where("cif <> other_cif").join(tiers.select(F.col("other_cif").alias("cif")), "cif", "left_semi").groupBy("cif", "other_cif").agg(F.min("first_seen").alias("first_seen"))
    out = ends.join(customer.withColumnRenamed("cif", "other_cif"), "other_cif", "left").join(tiers, "other_cif", "left")
    more = [c for c in customer.columns if c != "cif"]
    return out.select("cif", "other_cif", "first_seen", *more, F.col("tier").isNotNull().alias("alerted_this_run"), F.coalesce("tier", F.lit(NO_TIER)).alias("other_tier"))


def members(t: Tables) -> DataFrame:
    """The accounts of the latest rings on the day of the latest alerts, with their alerts where they have any."""
    day = t["mule_alerts"].agg(F.max("run_date").alias("snapshot_date"))
    rings = latest_rows(t["mule_rings"]).select("ring_id").distinct()
    rows = t["mule_features"].join(F.broadcast(day), "snapshot_date").join(rings, "ring_id").select("ring_id", "account_id", "cif", "hops_to_known_mule")
    rows = rows.join(latest_rows(t["mule_alerts"]).select("account_id", "tier", "p_mule_adj", "risk_rank"), "account_id", "left")
    return rows.select("ring_id", "account_id", "cif", F.coalesce("tier", F.lit(NO_TIER)).alias("tier"), "p_mule_adj", "risk_rank", "hops_to_known_mule")


def briefing(t: Tables) -> DataFrame:
    r = latest_rows(t["mule_model_run"], "run_ts")
    total = F.col("alerts_t1") + F.col("alerts_t2") + F.col("alerts_t3")
    return r.select(
        "run_date", "model_family", "scored_accounts", "alerts_t1", "alerts_t2", "alerts_t3", total.alias("total_alerts"), pct(total, F.col("scored_accounts"), 2).alias("pct_of_book_alerted"), F.round(100 * F.col("book_mule_rate"), 3).alias("book_mule_rate_pct"),
        F.round(100 * F.col("capture_top1"), 1).alias("model_capture_top1_pct"), F.round(100 * F.col("rules_capture_top1"), 1).alias("rules_capture_top1_pct"), F.round("lift_over_rules", 2).alias("lift_over_rules"), F.round(100 * F.col("precision_top02"), 1).alias("t1_precision_pct"), "gate_passed", "triggered_by",
    )


def hotspots(book: DataFrame, alerts: DataFrame, places: DataFrame, key: str, flag: Column, k: int = 15, show: Sequence[str] = ()) -> DataFrame:
    """Places by alerts for 1,000 active accounts."""
    active = book.groupBy(key).agg(F.count("*").alias("active_accounts"))
    alerted = alerts.groupBy(key).agg(F.count("*").alias("alerts"), F.count_if(flag).alias("t1_freeze"))
    rows = active.join(places, key).join(alerted, key, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("alerts", "t1_freeze")})
    rows = rows.withColumn("alerts_per_1000", F.round(1000 * F.col("alerts") / F.col("active_accounts"), 1))
    return rows.select(*show, "active_accounts", "alerts", "t1_freeze", "alerts_per_1000").orderBy(F.desc("alerts_per_1000"), *show).limit(k)


def branch_hotspots(t: Tables, k: int = 15) -> DataFrame:
    alerts = latest_rows(t["mule_alerts"])
    book = t["mule_features"].join(F.broadcast(alerts.agg(F.max("run_date").alias("_d"))), F.col("snapshot_date") == F.col("_d"))
    return hotspots(book, alerts, t["branch_map"], "branch_code", F.col("tier") == T1, k, ["region", "state", "city", "branch_name"])


def product_rates(t: Tables) -> DataFrame:
    alerts = latest_rows(t["mule_alerts"])
    book = t["mule_features"].join(F.broadcast(alerts.agg(F.max("run_date").alias("_d"))), F.col("snapshot_date") == F.col("_d"))
    rows = book.join(t["product_map"], "product_code").join(alerts.select(F.col("account_id").alias("_a"), "tier"), F.col("account_id") == F.col("_a"), "left")
    rows = rows.groupBy("product_name", kyc_name().alias("kyc")).agg(F.count("*").alias("active_accounts"), F.count("_a").alias("alerts"), pct(F.count("_a"), F.count("*"), 2).alias("alert_rate_pct"), F.count_if(F.col("tier") == T1).alias("t1_freeze"))
    return rows.orderBy(F.desc("alert_rate_pct"), "product_name", "kyc")


def code_frequency(rows: DataFrame, column: str = "reason_codes") -> DataFrame:
    """(code, n, pct): how many rows' comma list has the code. Lists are split; nothing is matched by LIKE."""
    total = rows.agg(F.count("*").alias("_n"))
    each = rows.select(F.explode(F.array_distinct(F.split(column, ","))).alias("code")).where("code <> ''").groupBy("code").agg(F.count("*").alias("n"))
    return each.crossJoin(F.broadcast(total)).select("code", "n", pct(F.col("n"), F.col("_n"), 1).alias("pct")).orderBy(F.desc("n"), "code")


def t1_reasons(t: Tables) -> DataFrame:
    return code_frequency(latest_rows(t["mule_alerts"]).where(F.col("tier") == T1)).withColumnsRenamed({"n": "t1_accounts", "pct": "pct_of_t1"})


def rate_by(rows: DataFrame, group: Column, name: str, more: Sequence[Column] = (), positives: str = "mules") -> DataFrame:
    rows = rows.where(F.col(LABEL).isNotNull()).groupBy(group.alias(name))
    return rows.agg(F.count("*").alias("labelled_rows"), F.sum(LABEL).alias(positives), F.round(100 * F.avg(F.col(LABEL).cast("double")), 3).alias("mule_rate_pct"), *more).orderBy(name)


def rate_by_hops(t: Tables) -> DataFrame:
    group = F.when(F.col("hops_to_known_mule") == 1, "1 hop").when(F.col("hops_to_known_mule") == 2, "2 hops").otherwise("3+ hops / none")
    return rate_by(t["mule_features"], group, "distance_to_known_mule", positives="became_mule_within_90d")


def rate_by_pass_through(t: Tables) -> DataFrame:
    band = banded(F.col("pass_through_ratio_7d"), [(0.9, "a. >= 90%"), (0.7, "b. 70-90%"), (0.4, "c. 40-70%")], "d. 0-40%", "e. none")
    return rate_by(t["mule_features"], band, "pass_through_band", [F.round(F.avg("median_hold_hours_30d"), 1).alias("avg_hold_hours")])


def rings_first(t: Tables, k: int = 15) -> DataFrame:
    rows = latest_rows(t["mule_rings"]).orderBy(F.desc("sum_p_mule_adj"), "ring_id").limit(k)
    return rows.select("ring_id", "ring_size", "accounts_scored", "accounts_alerted", pct(F.col("accounts_alerted"), F.col("accounts_scored"), 0).alias("pct_alerted"), "top_tier", F.round("max_p_mule_adj", 4).alias("max_p_mule_adj"), F.round("sum_p_mule_adj", 4).alias("ring_risk"), "min_hops_to_known_mule", "top_reason_codes")


def money_at_risk(t: Tables, days: int = 30) -> DataFrame:
    alerts = latest_rows(t["mule_alerts"])
    d = F.broadcast(alerts.agg(F.max("run_date").alias("_d")))
    moved = t["txn"].join(d, (F.col("txn_date") > F.date_sub("_d", days)) & (F.col("txn_date") <= F.col("_d"))).select("account_id", "direction", "amount")
    rows = moved.join(alerts.select("account_id", "tier"), "account_id", "left").groupBy(F.coalesce("tier", F.lit("Not alerted")).alias("tier"))
    credit, debit = F.sum(F.when(F.col("direction") == "CR", F.col("amount")).otherwise(0.0)), F.sum(F.when(F.col("direction") == "DR", F.col("amount")).otherwise(0.0))
    return rows.agg(
        F.count_distinct("account_id").alias("accounts"), F.round(credit / 1e7, 2).alias("credits_inr_crore"), F.round(debit / 1e7, 2).alias("debits_inr_crore"),
        pct(debit, credit, 0).alias("pct_forwarded"), F.round(credit / F.count_distinct("account_id"), 0).alias("avg_credit_per_account_inr"),
    ).orderBy("tier")


def capture_curve(t: Tables) -> DataFrame:
    last = latest_rows(t["mule_model_run"], "run_ts").select("run_id").limit(1)
    rows = t["mule_holdout"].join(F.broadcast(last), "run_id").orderBy("upto_pct")
    return rows.select("band", "upto_pct", "accounts", "mules", F.round(100 * F.col("mule_rate"), 2).alias("mule_rate_pct"), F.round(100 * F.col("cum_capture"), 1).alias("model_cum_capture_pct"), F.round(100 * F.col("rules_cum_capture"), 1).alias("rules_cum_capture_pct"))


def monthly_reports(t: Tables, since: Column | None = None, k: int = 40) -> DataFrame:
    since = since if since is not None else F.add_months(F.current_date(), -12)
    rows = t["report"].where(F.col("report_date") >= since).groupBy(F.trunc("report_date", "MM").alias("month"), "category")
    return rows.agg(F.count("*").alias("complaints"), F.count_distinct("account_id").alias("accounts_reported"), F.round(F.sum("amount") / 1e5, 1).alias("amount_inr_lakh")).orderBy(F.desc("month"), F.desc("complaints"), "category").limit(k)


def days_to_report(t: Tables) -> DataFrame:
    first = t["report"].where("account_id is not null").groupBy("account_id").agg(F.min("report_date").alias("first_report"))
    rows = first.join(t["account"].drop("product_name"), "account_id").join(t["product_map"], "product_code").groupBy("product_name")
    return rows.agg(F.count("*").alias("reported_accounts"), F.percentile_approx(F.datediff("first_report", "open_date"), 0.5).cast("int").alias("median_days_open_to_report"), F.count("reactivated_on").alias("were_dormant_reactivated"), F.count("freeze_date").alias("frozen")).orderBy(F.desc("reported_accounts"), "product_name")


REPORTS = {
    "alert_counts": alert_counts, "top_alerts": top_alerts, "weekly_book": weekly_book, "ring_report": ring_report, "run_lineage": run_lineage, "past_alerts": past_alerts, "decision_log": decision_log, "briefing": briefing,
    "branch_hotspots": branch_hotspots, "product_rates": product_rates, "t1_reasons": t1_reasons, "rate_by_hops": rate_by_hops, "rate_by_pass_through": rate_by_pass_through, "rings_first": rings_first, "money_at_risk": money_at_risk,
    "capture_curve": capture_curve, "monthly_reports": monthly_reports, "days_to_report": days_to_report,
}

# ---------------------------------------------------------------- views


def v_alerts(t: Tables) -> DataFrame:
    a = flagged_latest(t["mule_alerts"]).join(t["branch_map"].select("branch_code", "branch_name", "city", "state", "region"), "branch_code", "left").join(t["product_map"].select("product_code", "product_name"), "product_code", "left")
    features = ["min_kyc_flag", "account_age_days", "pass_through_ratio_7d", "median_hold_hours_30d", "distinct_senders_7d", "new_device_logins_30d", "accounts_on_same_device", "cifs_sharing_mobile"]
    a = a.join(t["mule_features"].select("account_id", "snapshot_date", *features), ["account_id", "snapshot_date"], "left")
    main = F.coalesce(F.nullif(F.split_part("reason_codes", F.lit(","), F.lit(1)), F.lit("")), F.lit("MODEL_ONLY"))
    shown = ["run_date", "is_latest", "run_id", "risk_rank", "account_id", "cif", "tier", "action", "branch_code", "branch_name", "city", "state", "region", "product_code", "product_name"]
    return a.select(
        *shown, kyc_name().alias("kyc_type"), main.alias("main_reason"), "reason_codes", "reasons", "ring_id", "ring_size", F.when(F.col("ring_size") > 1, 1).otherwise(0).alias("in_ring"),
        "hops_to_known_mule", F.when(F.col("hops_to_known_mule") <= 1, 1).otherwise(0).alias("near_known_mule"), "p_mule", "p_mule_adj", "risk_pct", *features[1:],
    )


def v_alert_reasons(t: Tables) -> DataFrame:
    a = flagged_latest(t["mule_alerts"]).join(t["branch_map"].select("branch_code", "region"), "branch_code", "left")
    return a.select("run_date", "is_latest", "account_id", "tier", "region", F.explode(F.array_distinct(F.split("reason_codes", ","))).alias("reason_code")).where("reason_code <> ''")


def v_rings(t: Tables) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("run_date").orderBy(F.desc("sum_p_mule_adj"), "ring_id"))
    return flagged_latest(t["mule_rings"]).select("run_date", "is_latest", rank.alias("ring_rank"), "ring_id", "ring_size", "accounts_scored", "accounts_alerted", F.try_divide("accounts_alerted", "accounts_scored").alias("alerted_share"), "top_tier", "max_p_mule_adj", F.col("sum_p_mule_adj").alias("ring_risk"), "min_hops_to_known_mule", "top_reason_codes")


def v_book_weekly(t: Tables) -> DataFrame:
    band = banded(F.col("pass_through_ratio_7d"), [(0.9, "a. 90% or more"), (0.7, "b. 70-90%"), (0.4, "c. 40-70%")], "d. under 40%", "e. none")
    rows = t["mule_features"].withColumns({"kyc_type": kyc_name(), "hops_band": hops_name(), "pass_through_band": band})
    # grouped by code before names are joined: the join meets a few rows
    rows = rows.groupBy("snapshot_date", "branch_code", "product_code", "kyc_type", "hops_band", "pass_through_band").agg(F.count("*").alias("accounts"), F.count(LABEL).alias("labelled"), F.sum(LABEL).alias("mules"))
    rows = rows.join(t["branch_map"].select("branch_code", "region"), "branch_code", "left").join(t["product_map"].select("product_code", "product_name"), "product_code", "left")
    return rows.groupBy("snapshot_date", "region", "product_name", "kyc_type", "hops_band", "pass_through_band").agg(F.sum("accounts").alias("accounts"), F.sum("labelled").alias("labelled"), F.sum("mules").alias("mules"))


def v_model_run(t: Tables) -> DataFrame:
    r = flagged_latest(t["mule_model_run"], "run_ts").withColumn("alerts_total", F.col("alerts_t1") + F.col("alerts_t2") + F.col("alerts_t3"))
    r = r.withColumns({c: F.col(c).cast("int") for c in ("gate_passed", "alerts_published")})
    return r.select(*"run_date is_latest run_id run_ts model_family device triggered_by scored_accounts alerts_t1 alerts_t2 alerts_t3 alerts_total book_mule_rate holdout_auc holdout_pr_auc capture_top1 capture_top5 precision_top02 precision_top1 rules_capture_top1 rules_precision_top1 lift_over_rules t1_cutoff gate_passed alerts_published gate_detail duration_s".split())


def v_holdout(t: Tables) -> DataFrame:
    last = t["mule_model_run"].agg(F.max_by("run_id", "run_ts").alias("_id"))
    number = F.row_number().over(Window.partitionBy("run_id").orderBy("upto_pct"))
    h = t["mule_holdout"].crossJoin(F.broadcast(last))
    return h.select("run_date", F.coalesce((F.col("run_id") == F.col("_id")).cast("int"), F.lit(0)).alias("is_latest"), F.concat(number.cast("string"), F.lit(". "), F.col("band")).alias("band_label"), "upto_pct", F.col("accounts").cast("int").alias("accounts"), F.col("mules").cast("int").alias("mules"), "mule_rate", "mean_p_mule", F.col("cum_capture").alias("model_cum_capture"), "rules_cum_capture")


LAYERS = ["bronze", "silver", "gold", "publish"]


def v_dq(t: Tables) -> DataFrame:
    """The last results of each layer of a pipeline run, with categories, limits and what was found."""
    r = t["dq_results"]
    kind, layer, run = F.col("expectation_type"), F.col("layer"), F.col("pipeline_run")
    r = r.withColumn("last_ts", F.max("run_ts").over(Window.partitionBy("pipeline_run", "layer"))).withColumn("started_ts", F.min("run_ts").over(Window.partitionBy("pipeline_run"))).where("run_ts = last_ts")
    newest = t["dq_results"].groupBy("layer").agg(F.max_by("pipeline_run", "run_ts").alias("_newest"))
    r = r.join(F.broadcast(newest), "layer", "left")
    run_type = F.when(run.startswith("scheduled__"), "nightly").when(run.startswith("manual-"), "by hand").when(run.startswith("manual__"), "triggered").otherwise("other")
    number = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, LAYERS)), layer).cast("int"), F.lit(0)), F.lit(9))
    counted = kind.isin("row_count", "reconciliation_equal", "rate_at_most", "volume_change")
    actual = F.when(counted, F.col("observed_value").try_cast("double")).otherwise(F.col("unexpected_count").cast("double"))
    expected = F.when(kind == "volume_change", F.lit(None).cast("double"))
    for k, path in (("row_count", "min_value"), ("reconciliation_equal", "expected"), ("rate_at_most", "max_rate")):
        expected = expected.when(kind == k, F.get_json_object("kwargs", f"$.{path}").try_cast("double"))
    expected = expected.otherwise(F.lit(0.0))
    name = F.col("check_name")
    category = F.when(name.contains("raw PAN") | name.contains("SHA-256"), "Privacy").when(name.contains("(leakage)"), "Leakage guard")
    for kinds, text in ((("row_count", "volume_change"), "Volume"), (("not_null",), "Completeness"), (("unique",), "Uniqueness"), (("reconciliation_equal",), "Reconciliation"), (("rate_at_most",), "Rate limit"), (("not_after_as_of",), "Timeliness")):
        category = category.when(kind.isin(*kinds), text)
    limited, passed = kind == "rate_at_most", F.col("success").cast("int")
    return r.select(
        "pipeline_run", run_type.alias("run_type"), F.concat_ws(" ", F.col("as_of").cast("string"), run_type, F.date_format("started_ts", "HH:mm")).alias("run_label"), "run_id", "run_ts", "as_of", "layer", number.alias("layer_order"),
        F.concat(number.cast("string"), F.lit(". "), layer).alias("layer_label"), "table_name", "check_name", kind.alias("rule"), category.otherwise("Validity").alias("category"), "column_name", "severity", passed.alias("passed"), (1 - passed).alias("failed"),
        F.when(F.col("success") & (F.col("unexpected_count") > 0), 1).otherwise(0).alias("near_miss"), "observed_value", actual.alias("actual"), expected.alias("expected"), (actual - expected).alias("diff"),
        F.when(limited, 100 * actual).alias("rate_pct"), F.when(limited, 100 * expected).alias("limit_pct"), "unexpected_count", "unexpected_pct", "element_count",
        F.when((kind == "row_count") & (name == "row count"), F.col("observed_value").try_cast("bigint")).alias("row_count"), F.col("kwargs").alias("note"), "table_snapshot_id", F.coalesce((run == F.col("_newest")).cast("int"), F.lit(0)).alias("is_latest"),
    )


def v_dq_run(t: Tables) -> DataFrame:
    keys = ["pipeline_run", "run_type", "run_label", "as_of", "layer", "layer_order", "layer_label"]
    rows = v_dq(t).groupBy(*keys).agg(
        F.max("is_latest").alias("is_latest"), F.max("run_ts").alias("checked_at"), F.min("run_ts").alias("_first"), F.count("*").alias("checks"), F.sum("passed").alias("passed"), F.sum("failed").alias("failed"),
        F.sum(F.when(F.col("severity") == "critical", F.col("failed")).otherwise(0)).alias("critical_failed"), F.sum(F.when(F.col("severity") == "warning", F.col("failed")).otherwise(0)).alias("warnings_failed"),
        F.sum("near_miss").alias("near_misses"), F.count_distinct("table_name").alias("table_count"), F.sum("row_count").alias("rows_checked"),
    )
    began = F.min("_first").over(Window.partitionBy("pipeline_run"))
    return rows.withColumn("minutes_after_bronze", F.round((F.unix_timestamp("checked_at") - F.unix_timestamp(began)) / 60, 1)).drop("_first")


VIEWS = {"v_alerts": v_alerts, "v_alert_reasons": v_alert_reasons, "v_rings": v_rings, "v_book_weekly": v_book_weekly, "v_model_run": v_model_run, "v_holdout": v_holdout, "v_dq": v_dq, "v_dq_run": v_dq_run}


def register(t: Tables, prefix: str = "") -> None:
    """Temporary views of all that the tables allow."""
    for name, make in VIEWS.items():
        try:
            make(t).createOrReplaceTempView(prefix + name)
        except KeyError:
            continue


# ---------------------------------------------------------------- visuals


@dataclass(frozen=True)
class Visual:
    """A chart or tile: SQL expressions for dimensions and measures over a view."""

    title: str
    view: str
    measures: dict[str, str]
    dims: dict[str, str] | None = None
    filters: Sequence[str] = ()
    order: Sequence[str] = ()
    limit: int | None = None

    def frame(self, source: DataFrame) -> DataFrame:
        for f in self.filters:
            source = source.where(f)
        dims = [F.expr(e).alias(k) for k, e in (self.dims or {}).items()]
        out = source.groupBy(*dims).agg(*[F.expr(e).alias(k) for k, e in self.measures.items()])
        if self.order:
            out = out.orderBy(*[F.desc(o[1:]) if o.startswith("-") else F.col(o) for o in self.order])
        return out.limit(self.limit) if self.limit is not None else out

    def sql(self) -> str:
        """The same as a query."""
        dims = list((self.dims or {}).items())
        select = ", ".join(f"{e} AS {k}" for k, e in [*dims, *self.measures.items()])
        parts = [f"SELECT {select} FROM {self.view}"]
        if self.filters:
            parts.append("WHERE " + " AND ".join(f"({f})" for f in self.filters))
        if dims:
            parts.append("GROUP BY " + ", ".join(e for _, e in dims))
        if self.order:
            parts.append("ORDER BY " + ", ".join(f"{o[1:]} DESC" if o.startswith("-") else o for o in self.order))
        if self.limit is not None:
            parts.append(f"LIMIT {self.limit}")
        return " ".join(parts)


def kpis() -> list[Visual]:
    """The headline numbers."""
    now = ("is_latest = 1",)
    return [
        Visual("Alerts", "v_alerts", {"alerts": "count(*)", "t1_freeze": f"count_if(tier = '{T1}')", "rings_touched": "count(distinct case when in_ring = 1 then ring_id end)", "expected_mules": "cast(round(sum(cast(p_mule_adj as decimal(18,6))), 1) as double)", "near_known_mule": "sum(near_known_mule)"}, filters=now),
        Visual("Reasons", "v_alert_reasons", {"alerts": "count(*)"}, {"reason_code": "reason_code"}, now, ("-alerts", "reason_code")),
        Visual("Rings", "v_rings", {"rings": "count(*)", "rings_alerted": "count_if(accounts_alerted > 0)", "largest_alerted": "max(case when accounts_alerted > 0 then ring_size end)"}, filters=now),
        Visual("Rate by hops", "v_book_weekly", {"labelled": "sum(labelled)", "mules": "sum(mules)", "mule_rate_pct": "round(try_divide(100 * sum(mules), sum(labelled)), 3)"}, {"hops_band": "hops_band"}, order=("hops_band",)),
        Visual("Trust", "v_model_run", {k: f"max({k})" for k in ("holdout_auc", "capture_top1", "rules_capture_top1", "precision_top02", "lift_over_rules", "gate_passed")}, {"run_date": "run_date"}, order=("run_date",)),
        Visual("Capture", "v_holdout", {"model_cum_capture": "max(model_cum_capture)", "rules_cum_capture": "max(rules_cum_capture)"}, {"band_label": "band_label"}, now, ("band_label",)),
        Visual("Checks", "v_dq", {"checks": "count(*)", "pass_rate_pct": "round(100 * sum(passed) / count(*), 2)", "critical_failed": "sum(case when severity = 'critical' then failed else 0 end)", "warnings_failed": "sum(case when severity = 'warning' then failed else 0 end)", "near_misses": "sum(near_miss)", "rows_checked": "sum(row_count)"}, filters=now),
        Visual("Checks by category", "v_dq", {"checks": "count(*)", "failed": "sum(failed)", "near_misses": "sum(near_miss)"}, {"layer_label": "layer_label", "category": "category"}, now, ("layer_label", "category")),
    ]

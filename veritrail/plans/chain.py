"""Queries over the store, the checks and the daily run, with SQL written on its own."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import FEATURE_COLUMNS, FEATURES, LABEL, POLICY
from ..functions.scalars import exact_sum
from ..operators import evaluate, graph, quality, score, scorers
from ..session import scratch
from ..sources import export, simulate
from ..sources.store import Store, run_script
from . import daily, day
from .registry import CODES, TEST, TOPS, findings, holdout, query, read, shared

AS_OF = date(2024, 6, 21)
WEEK = "DATE '2024-01-05' + CAST(7 * n_nationkey AS INT)"
K = "(c_custkey + 3 * n_nationkey)"
#: A feature table of 25 weeks: every customer in every nation's week.
BOOK_COLUMNS = {
    "account_id": "'A' || CAST(c_custkey AS STRING)", "snapshot_date": WEEK, "cif": "'C' || CAST(c_custkey % 700 AS STRING)", "branch_code": "'B' || CAST(c_nationkey AS STRING)", "product_code": "c_mktsegment",
    "person_cluster_id": "'C' || CAST(c_custkey % 300 AS STRING)", "ring_id": "'R' || CAST(c_custkey % 97 AS STRING)", "account_age_days": f"CAST({K} % 900 AS INT)", "min_kyc_flag": "CAST(c_custkey % 7 = 0 AS INT)",
    "dormant_reactivated_flag": f"CAST({K} % 31 = 0 AS INT)", "inflow_to_declared_income_30d": f"({K} % 16) / 2", "distinct_senders_7d": f"CAST({K} % 30 AS INT)", "distinct_receivers_7d": f"CAST({K} % 11 AS INT)",
    "pass_through_ratio_7d": "((c_custkey * 7 + n_nationkey) % 101) / 100", "median_hold_hours_30d": f"({K} % 40) / 2", "night_txn_share_30d": f"({K} % 8) / 8", "round_amount_share_30d": f"({K} % 4) / 4", "new_device_logins_30d": f"CAST({K} % 2 AS INT)",
    "vpa_or_mobile_changes_30d": f"CAST({K} % 3 AS INT)", "accounts_on_same_device": f"CAST({K} % 5 AS INT)", "cifs_sharing_mobile": f"CAST({K} % 3 AS INT)", "person_cluster_size": "CAST(1 + c_custkey % 3 AS INT)", "ring_size": "CAST(1 + c_custkey % 9 AS INT)",
    "hops_to_known_mule": f"CAST(1 + {K} % 4 AS INT)", "credits_from_complainants_30d": f"CAST({K} % 5 AS INT)", "is_mule_90d": f"CASE WHEN n_nationkey < 12 THEN CAST(c_acctbal + 500 * ({K} % 3) > 9200 AS INT) END",
}
FEATS = f"f AS (SELECT {', '.join(f'{e} AS {c}' for c, e in BOOK_COLUMNS.items())} FROM customer CROSS JOIN nation)"
SMALL = POLICY | {"context": POLICY["context"] | {"max_mules": 50}, "holdout": {"test_weeks": 4, "gap_days": 14, "negative_sample": 0.5}}


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").crossJoin(F.broadcast(read(spark, sf_dir, "nation")))
    return rows.selectExpr(*[f"{BOOK_COLUMNS[c]} AS {c}" for c in FEATURE_COLUMNS])


def new_store(spark: SparkSession) -> Store:
    return Store(spark, scratch(spark, "store"))


# ---------------------------------------------------------------- store


@shared
def committed(spark: SparkSession, sf_dir: str) -> Store:
    """Orders by month, then more of them, then an upsert with changes: four versions."""
    st = new_store(spark)
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    st.write("orders", o.where("o_orderpriority <> '5-LOW'"), by_month="day")
    st.append("orders", o.where("o_orderpriority = '5-LOW'"))
    st.merge("orders", o.where("o_totalprice < 400000").withColumn("o_totalprice", F.when(F.col("day") < F.lit(date(1995, 6, 1)), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))), ["o_orderkey"])
    st.merge("orders", st.read("orders").drop("day_month"), ["o_orderkey"])
    return st


@query("""WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS low, count(*) FILTER (WHERE o_totalprice >= 400000) AS big, count(*) FILTER (WHERE o_totalprice < 400000 AND o_orderdate < DATE '1995-06-01') AS early FROM orders)
SELECT CAST(1 AS BIGINT) AS version, 'replace' AS operation, n - low AS rows_, n - low AS added, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted FROM c UNION ALL SELECT 2, 'append', n, low, 0, 0 FROM c UNION ALL SELECT 3, 'merge', n - big, 0, early, big FROM c UNION ALL SELECT 4, 'merge', n - big, 0, 0, 0 FROM c""")
def store_history(spark, sf_dir):
    return committed(spark, sf_dir).history("orders").select("version", "operation", F.col("rows").alias("rows_"), "added", "updated", "deleted")


@query("""SELECT 'then' AS version, count(*) AS n, CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))), 1) AS DOUBLE) AS worth FROM orders WHERE o_orderpriority <> '5-LOW' UNION ALL SELECT 'by number', count(*), CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))), 1) AS DOUBLE) FROM orders
UNION ALL SELECT 'now', count(*), CAST(round(sum(CAST(CASE WHEN o_orderdate < DATE '1995-06-01' THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2))), 1) AS DOUBLE) FROM orders WHERE o_totalprice < 400000
UNION ALL SELECT 'a month', count(*), CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))), 1) AS DOUBLE) FROM orders WHERE o_totalprice < 400000 AND o_orderdate >= DATE '1998-03-01' AND o_orderdate < DATE '1998-04-01'""")
def store_travel(spark, sf_dir):
    st = committed(spark, sf_dir)
    then = st.history("orders").where("version = 1").first()["committed_at"]
    reads = {"then": st.read("orders", at=then), "by number": st.read("orders", 2), "now": st.read("orders"), "a month": st.read("orders", where=F.col("day_month") == F.lit(date(1998, 3, 1)))}
    lines = [df.agg(F.lit(name).alias("version"), F.count("*").alias("n"), exact_sum("o_totalprice", 2, 1).alias("worth")) for name, df in reads.items()]
    return lines[0].unionByName(lines[1]).unionByName(lines[2]).unionByName(lines[3])


@query("""WITH o AS (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS run_date, * FROM orders) SELECT run_date, o_orderkey, CASE WHEN run_date = DATE '2000-01-01' THEN 'again' ELSE 'first' END AS run_id FROM o WHERE run_date <> DATE '2000-01-01' OR o_totalprice > 100000""")
def store_replace_by_date(spark, sf_dir):
    """A date's rows are published again: the earlier ones of that date are gone, all others stay."""
    st, last = new_store(spark), date(2000, 1, 1)
    o = read(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "YEAR").alias("run_date"), "o_orderkey", "o_totalprice", F.lit("first").alias("run_id"))
    st.write("alerts", o, by="run_date")
    st.replace_where("alerts", o.where((F.col("run_date") == F.lit(last)) & (F.col("o_totalprice") > 100000)).withColumn("run_id", F.lit("again")), "run_date", last)
    return st.read("alerts").select("run_date", "o_orderkey", "run_id")


@query(f"WITH {day.made('investigator_decisions')} SELECT decision, count(*) AS n, count(DISTINCT account_id) AS accounts FROM investigator_decisions GROUP BY 1")
def store_decisions(spark, sf_dir):
    """Decisions are appended, the first of them to a table that is not there yet."""
    st, rows = new_store(spark), day.tables(spark, sf_dir)["investigator_decisions"]
    assert st.read_or_empty("investigator_decisions", daily.DECISIONS).count() == 0
    for d in ("CONFIRMED_MULE", "FALSE_POSITIVE"):
        daily.decide(st, rows.where(F.col("decision") == d))
    return st.read("investigator_decisions").groupBy("decision").agg(F.count("*").alias("n"), F.count_distinct("account_id").alias("accounts"))


@query("SELECT 'parquet' AS kind, s_suppkey, s_name, s_acctbal FROM supplier UNION ALL SELECT 'csv', s_suppkey, s_name, s_acctbal FROM supplier")
def exported_tables(spark, sf_dir):
    st = new_store(spark)
    st.write("supplier", read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"))
    out = []
    for kind in ("parquet", "csv"):
        where = export.tables(st, ["supplier"], scratch(spark, kind), kind)["supplier"]
        out.append(spark.read.format(kind).option("header", True).schema("s_suppkey long, s_name string, s_acctbal double").load(where).select(F.lit(kind).alias("kind"), "*"))
    return out[0].unionByName(out[1])


@query("SELECT count(*) AS n, sum(p_size) AS size_, 'run-1' AS run_id FROM part".replace("sum(p_size)", "CAST(sum(p_size) AS BIGINT)"))
def context_file(spark, sf_dir):
    path = scratch(spark, "context")
    export.save_context(read(spark, sf_dir, "part"), {"run_id": "run-1"}, path)
    rows, meta = export.load_context(spark, path)
    return rows.agg(F.count("*").alias("n"), F.sum("p_size").alias("size_"), F.lit(meta["run_id"]).alias("run_id"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 150000 GROUP BY 1")
def script_runner(spark, sf_dir):
    """A script of two statements, with comments, run in order; then what its view holds."""
    text = f"-- big orders\nCREATE OR REPLACE TEMPORARY VIEW big AS\n  SELECT * FROM parquet.`{sf_dir}/orders.parquet` WHERE o_totalprice > 150000;\n-- and how many there are\nSELECT count(*) FROM big;\n"
    assert len(run_script(spark, text)) == 2
    return spark.sql("SELECT o_orderpriority, count(*) AS n FROM big GROUP BY 1")


@query("SELECT event_id, user_id, event_type FROM events")
def resent_rows(spark, sf_dir):
    """Rows sent again a second later, chosen by hash, are gone after keep-latest."""
    from ..operators.relational import latest

    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ingested_at"))
    return latest(simulate.resent(e, "event_id", one_in=5), ["event_id"]).drop("ingested_at")


@query("""WITH t AS (SELECT CAST(event_id AS VARCHAR) AS txn_id, value AS amount, event_type AS direction FROM events), b AS (SELECT * FROM t ORDER BY txn_id LIMIT 50) SELECT * FROM t UNION ALL SELECT txn_id || '-bad', -amount, 'XX' FROM b""")
def spoiled_rows(spark, sf_dir):
    return simulate.spoiled(read(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("txn_id"), F.col("value").alias("amount"), F.col("event_type").alias("direction")))


# ---------------------------------------------------------------- samples, scores, evaluation


@query(f"""WITH {FEATS}, d AS (SELECT DISTINCT snapshot_date AS d FROM f WHERE is_mule_90d IS NOT NULL), l AS (SELECT d, row_number() OVER (ORDER BY d DESC) AS k FROM d)
SELECT min(d) FILTER (WHERE k <= 4) AS test_from, max(d) AS test_to, min(d) FILTER (WHERE k <= 4) - 14 AS known, (SELECT max(snapshot_date) FROM f) AS latest, count(*) AS dates FROM l""")
def labelled_window(spark, sf_dir):
    b = book(spark, sf_dir)
    dates = score.labelled_dates(b)
    return spark.createDataFrame([(*score.test_window(dates, 4, 14), score.latest_date(b), len(dates))], "test_from date, test_to date, known date, latest date, dates long")


@query(f"WITH {FEATS} SELECT round(avg(is_mule_90d), 9) AS rate FROM f WHERE snapshot_date BETWEEN DATE '2024-01-12' AND DATE '2024-05-01'")
def labelled_rate(spark, sf_dir):
    return spark.createDataFrame([(score.labelled_rate(book(spark, sf_dir), date(2024, 1, 12), date(2024, 5, 1)),)], "rate double").select(F.round("rate", 9).alias("rate"))


def by_hops(context):
    """A scorer by pandas: the context's rate among rows of the same number of hops."""
    rates, overall = context.groupby("hops_to_known_mule")[LABEL].mean(), context[LABEL].mean()
    return lambda frame: frame["hops_to_known_mule"].map(rates).fillna(overall).astype(float)


@query(f"""WITH {FEATS}, r AS (SELECT hops_to_known_mule AS h, avg(is_mule_90d) AS p FROM f WHERE snapshot_date = DATE '2024-02-02' GROUP BY 1) SELECT account_id, round(coalesce(p, (SELECT avg(is_mule_90d) FROM f WHERE snapshot_date = DATE '2024-02-02')), 9) AS p
FROM f LEFT JOIN r ON h = hops_to_known_mule WHERE snapshot_date = DATE '2024-06-21'""")
def batched_scores(spark, sf_dir):
    b = book(spark, sf_dir)
    fit = scorers.batched(by_hops)
    rows = fit(b.where(F.col("snapshot_date") == F.lit(date(2024, 2, 2))))(b.where(F.col("snapshot_date") == F.lit(AS_OF)))
    return rows.select("account_id", F.round("p", 9).alias("p"))


def top_sql(order: str, share: float, what: str) -> str:
    """Capture or precision of the top share in the order of a score."""
    rows = f"(SELECT *, sum(weight) OVER (ORDER BY {order} DESC, id ROWS UNBOUNDED PRECEDING) AS u, row_number() OVER (ORDER BY {order} DESC, id) AS k, sum(weight) OVER () AS tw, sum(y * weight) OVER () AS tp FROM t)"
    bottom = "max(tp)" if what == "capture" else f"sum(weight) FILTER (WHERE u <= {share} * tw OR k = 1)"
    return f"(SELECT sum(y * weight) FILTER (WHERE u <= {share} * tw OR k = 1) / {bottom} FROM {rows})"


SUMMARY_SQL = f"""WITH {TEST}, {TOPS}, g AS (SELECT p, sum(y * weight) AS a, sum((1 - y) * weight) AS b FROM t GROUP BY 1), c AS (SELECT *, sum(a) OVER (ORDER BY p DESC) AS ca, sum(b) OVER (ORDER BY p DESC) AS cb FROM g), s AS (
SELECT (SELECT count(*) FROM t) AS holdout_rows, (SELECT CAST(sum(y) AS BIGINT) FROM t) AS holdout_mules, (SELECT round(sum(y * weight) / sum(weight), 4) FROM t) AS holdout_mule_rate, (SELECT round(sum(b * (ca - a / 2)) / (sum(a) * sum(b)), 4) FROM c) AS holdout_auc,
(SELECT round(sum(a * ca / (ca + cb)) / sum(a), 4) FROM c) AS holdout_pr_auc, round({top_sql('p', 0.01, 'capture')}, 4) AS capture_top1, round({top_sql('p', 0.05, 'capture')}, 4) AS capture_top5, round({top_sql('p', 0.002, 'precision')}, 4) AS precision_top02,
round({top_sql('p', 0.01, 'precision')}, 4) AS precision_top1, round({top_sql('rules', 0.01, 'capture')}, 4) AS rules_capture_top1, round({top_sql('rules', 0.01, 'precision')}, 4) AS rules_precision_top1, round({top_sql('p', 0.01, 'capture')} / {top_sql('rules', 0.01, 'capture')}, 4) AS lift_over_rules)"""
SUMMARY = "holdout_rows long, holdout_mules long, holdout_mule_rate double, holdout_auc double, holdout_pr_auc double, capture_top1 double, capture_top5 double, precision_top02 double, precision_top1 double, rules_capture_top1 double, rules_precision_top1 double, lift_over_rules double"


@query(f"{SUMMARY_SQL} SELECT * FROM s")
def holdout_summary(spark, sf_dir):
    found = evaluate.summary(holdout(spark, sf_dir))
    return spark.createDataFrame([tuple(found[c.split()[0]] for c in SUMMARY.split(", "))], SUMMARY)


GATE = [("capture_top1", 0.40, "capture in top 1%"), ("precision_top02", 0.10, "precision in top 0.2% (T1 queue)"), ("lift_over_rules", 1.2, "lift over rules-only at top 1%")]


@query(SUMMARY_SQL + " " + " UNION ALL ".join(f"SELECT CASE WHEN {c} >= {x} THEN 'PASS' ELSE 'FAIL' END || ' {t}: ' || CASE WHEN {c} IS NULL THEN 'n/a' ELSE printf('%.3f', {c}) END || ' (min {x:.3f})' AS line FROM s" for c, x, t in GATE))
def holdout_gate(spark, sf_dir):
    _, lines = evaluate.gate(evaluate.summary(holdout(spark, sf_dir)), POLICY["gate"])
    return spark.createDataFrame([(x,) for x in lines], "line string")


@query(f"WITH {day.made('mule_alerts')} SELECT tier, count(*) AS n, min(p_mule_adj) AS least FROM mule_alerts WHERE run_date = DATE '2024-01-30' GROUP BY 1")
def tier_cutoffs(spark, sf_dir):
    found = score.cutoffs(day.tables(spark, sf_dir)["mule_alerts"].where(F.col("run_date") == F.lit(date(2024, 1, 30))))
    return spark.createDataFrame([(k, *v) for k, v in found.items()], "tier string, n long, least double")


@query(f"""WITH {day.made('mule_rings')}, r AS (SELECT ring_id, max(ring_size) * 4 AS n FROM mule_rings GROUP BY 1) SELECT CASE WHEN n <= 4 THEN '2-4' WHEN n <= 10 THEN '5-10' WHEN n <= 25 THEN '11-25' ELSE '26+' END AS ring_size_band, count(*) AS rings FROM r WHERE n > 1 GROUP BY 1""")
def ring_size_bands(spark, sf_dir):
    return graph.size_bands(day.tables(spark, sf_dir)["mule_rings"].withColumn("ring_size", F.col("ring_size") * 4))


@query("SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9970)")
def any_in_group(spark, sf_dir):
    return score.any_in_group(read(spark, sf_dir, "customer"), ["c_nationkey"], F.col("c_acctbal") > 9970).select("c_custkey")


# ---------------------------------------------------------------- checks

PASSED = "SELECT {!r} AS check_name, b = 0 AS success, n AS elements, b AS unexpected, CAST(b AS VARCHAR) AS observed FROM (SELECT count(*){} AS n, count(*) FILTER (WHERE {}) AS b FROM f)"
RIPE = "snapshot_date + 90 <= DATE '2024-06-21'"


def gold_sql() -> str:
    """The gold suite's findings, a SELECT a check."""
    out = ["SELECT 'row count' AS check_name, count(*) >= 1 AS success, count(*) AS elements, CAST(NULL AS BIGINT) AS unexpected, CAST(count(*) AS VARCHAR) AS observed FROM f",
           "SELECT 'one row per account per snapshot', count(*) = count(DISTINCT (account_id, snapshot_date)), count(*), count(*) - count(DISTINCT (account_id, snapshot_date)), CAST(count(*) - count(DISTINCT (account_id, snapshot_date)) AS VARCHAR) FROM f",
           "SELECT 'today''s snapshot present', count(*) >= 1, count(*), NULL, CAST(count(*) AS VARCHAR) FROM f WHERE snapshot_date = DATE '2024-06-21'"]
    tests = [(f"{c} not null", "", f"{c} IS NULL") for c in ("account_id", "snapshot_date", "cif")]
    tests += [("snapshot_date not after the as-of date", "", "snapshot_date > DATE '2024-06-21'"), ("label is 0/1", "", "is_mule_90d NOT IN (0, 1)")]
    tests += [("label known once 90 days have passed", f" FILTER (WHERE {RIPE})", f"is_mule_90d IS NULL AND {RIPE}"), ("no label before 90 days have passed (leakage)", f" FILTER (WHERE NOT {RIPE})", f"is_mule_90d IS NOT NULL AND NOT {RIPE}")]
    tests += [(f"{c} not null", "", f"{c} IS NULL") for c in FEATURES]
    for c in FEATURES:
        low, high = {"hops_to_known_mule": (1, 3)}.get(c, (1 if c in ("cifs_sharing_mobile", "person_cluster_size", "ring_size") else 0, 1 if c in ("pass_through_ratio_7d", "night_txn_share_30d", "round_amount_share_30d") else None))
        if c.endswith("_flag"):
            tests.append((f"{c} in [0, 1]", "", f"{c} NOT IN (0, 1)"))
        else:
            tests.append((f"{c} within {low} to {'inf' if high is None else high}", "", f"{c} < {low}" + (f" OR {c} > {high}" if high is not None else "")))
    out += [PASSED.format(name, of, bad) for name, of, bad in tests]
    out.append(f"SELECT 'latest labelled mule rate within 0.02%-0.20%', avg(is_mule_90d) BETWEEN 0.0002 AND 0.002, count(*), NULL, printf('%.6f', avg(is_mule_90d)) FROM f WHERE snapshot_date = (SELECT max(snapshot_date) FROM f WHERE {RIPE})")
    out.append("SELECT 'today''s snapshot rows against the previous load within -5% / +10%', count(*) / 1450 BETWEEN 0.95 AND 1.1, count(*), NULL, printf('%.4f', count(*) / 1450) FROM f WHERE snapshot_date = DATE '2024-06-21'")
    return f"WITH {FEATS} " + " UNION ALL ".join(out)


@query(gold_sql())
def suite_gold(spark, sf_dir):
    return findings(spark, quality.gold_suite(book(spark, sf_dir), AS_OF, {("mule_features", "today's snapshot present"): 1450.0}))


PUBLISH = ["mule_model_run", "mule_alerts", "mule_rings", "mule_holdout", "mule_features"]


@query(f"""WITH {day.made(*PUBLISH)}, r AS (SELECT * FROM mule_model_run WHERE run_date = DATE '2024-01-30'), a AS (SELECT * FROM mule_alerts WHERE run_date = DATE '2024-01-30'),
n AS (SELECT count(*) FILTER (WHERE tier LIKE 'T1%') AS t1, count(*) FILTER (WHERE tier LIKE 'T2%') AS t2, count(*) FILTER (WHERE tier LIKE 'T3%') AS t3, count(*) AS n, (SELECT count(*) FROM mule_rings WHERE run_id = 'run-4') AS rings, (SELECT count(*) FROM mule_holdout WHERE run_id = 'run-4') AS bands,
(SELECT count(*) FROM mule_features WHERE snapshot_date = DATE '2024-01-30') AS book FROM a WHERE run_id = 'run-4')
SELECT 'a run row for the as-of date' AS check_name, true AS success, CAST(1 AS BIGINT) AS elements, CAST(NULL AS BIGINT) AS unexpected, '1' AS observed UNION ALL SELECT 'T1_FREEZE_REVIEW rows = the run row', t1 = alerts_t1, alerts_t1, abs(t1 - alerts_t1), CAST(t1 AS VARCHAR) FROM n, r
UNION ALL SELECT 'T2_HOLD_MONITOR rows = the run row', t2 = alerts_t2, alerts_t2, abs(t2 - alerts_t2), CAST(t2 AS VARCHAR) FROM n, r UNION ALL SELECT 'T3_WATCHLIST rows = the run row', t3 = alerts_t3, alerts_t3, abs(t3 - alerts_t3), CAST(t3 AS VARCHAR) FROM n, r
UNION ALL SELECT 'every alert carries the run''s run_id', n = (SELECT count(*) FROM a), (SELECT count(*) FROM a), (SELECT count(*) FROM a) - n, CAST((SELECT count(*) FROM a) - n AS VARCHAR) FROM n UNION ALL SELECT 'rings published with the alerts', rings >= 1, rings, NULL, CAST(rings AS VARCHAR) FROM n
UNION ALL SELECT '7 holdout bands for the run', bands = 7, 7, abs(bands - 7), CAST(bands AS VARCHAR) FROM n UNION ALL SELECT 'scored accounts = gold rows of the scored snapshot', book = scored_accounts, book, abs(book - scored_accounts), CAST(scored_accounts AS VARCHAR) FROM n, r""")
def suite_publish(spark, sf_dir):
    t = day.tables(spark, sf_dir)
    return findings(spark, quality.publish_suite({n: t[n] for n in PUBLISH}, date(2024, 1, 30)))


@query(f"""WITH {day.made('dq_results')}, r AS (SELECT *, row_number() OVER (PARTITION BY layer, table_name, check_name ORDER BY as_of DESC, run_ts DESC, observed_value DESC) AS k FROM dq_results WHERE expectation_type = 'row_count' AND layer = 'gold' AND as_of < DATE '2024-02-01')
SELECT table_name, check_name, CAST(observed_value AS DOUBLE) AS previous FROM r WHERE k = 1""")
def previous_counts(spark, sf_dir):
    found = quality.previous_counts(day.tables(spark, sf_dir)["dq_results"], "gold", date(2024, 2, 1))
    return spark.createDataFrame([(*k, v) for k, v in found.items()], "table_name string, check_name string, previous double")


@query("""SELECT 'orders' AS table_name, 'o_custkey not null' AS check_name, 'not_null' AS expectation_type, 'critical' AS severity, true AS success, count(*) AS element_count, CAST(0 AS BIGINT) AS unexpected_count, CAST(0 AS DOUBLE) AS unexpected_pct FROM orders
UNION ALL SELECT 'orders', 'a row on every day', 'reconciliation_equal', 'critical', count(DISTINCT CAST(o_orderdate AS DATE)) = date_diff('day', min(CAST(o_orderdate AS DATE)), DATE '2001-08-01') + 1, date_diff('day', min(CAST(o_orderdate AS DATE)), DATE '2001-08-01') + 1,
abs(count(DISTINCT CAST(o_orderdate AS DATE)) - date_diff('day', min(CAST(o_orderdate AS DATE)), DATE '2001-08-01') - 1), 100.0 * abs(count(DISTINCT CAST(o_orderdate AS DATE)) - date_diff('day', min(CAST(o_orderdate AS DATE)), DATE '2001-08-01') - 1) / (date_diff('day', min(CAST(o_orderdate AS DATE)), DATE '2001-08-01') + 1) FROM orders""")
def recorded_checks(spark, sf_dir):
    """Findings recorded in the store, one of them that of the days without a row; then read back."""
    o, st, as_of = read(spark, sf_dir, "orders"), new_store(spark), date(2001, 8, 1)
    found, _ = quality.check("orders", o, [quality.not_null("o_custkey")])
    st.append("dq_results", quality.recorded(spark, [*found, quality.daily_gaps("orders", o, "o_orderdate", as_of)], "gold", as_of))
    name = F.when(F.col("check_name").startswith("a transaction on every day"), "a row on every day").otherwise(F.col("check_name"))
    return st.read("dq_results").select("table_name", name.alias("check_name"), "expectation_type", "severity", "success", "element_count", "unexpected_count", "unexpected_pct")


# ---------------------------------------------------------------- daily run


def half_and_rate(context: DataFrame):
    """A scorer that SQL can repeat: the mean of the pass-through and the context's rate."""
    rate = context.agg(F.avg(LABEL)).first()[0]
    return lambda rows: rows.withColumn("p", (F.col("pass_through_ratio_7d") + F.lit(rate)) / 2)


@shared
def scored_day(spark: SparkSession, sf_dir: str, **options) -> tuple[Store, daily.Outcome]:
    st = new_store(spark)
    st.write("mule_features", book(spark, sf_dir), by_month="snapshot_date")
    return st, daily.run(st, policy=SMALL, scorer=half_and_rate, publish_on_fail=True, **options)


BUCKET = "CAST('0x' || left(md5(account_id || '|' || CAST(snapshot_date AS VARCHAR)), 8) AS BIGINT) % 10000"


def run_sql(run_date: str) -> str:
    """The book of a date as it is ranked: context, rates, corrected probabilities, ranks, tiers."""
    return f"""{FEATS}, u AS (SELECT max(snapshot_date) AS last FROM f WHERE is_mule_90d IS NOT NULL AND snapshot_date <= DATE '{run_date}' - 90), w AS (SELECT f.* FROM f, u WHERE snapshot_date BETWEEN last - 182 AND last),
pos AS (SELECT is_mule_90d FROM w WHERE is_mule_90d = 1 ORDER BY snapshot_date DESC, account_id LIMIT 50), neg AS (SELECT is_mule_90d FROM w WHERE is_mule_90d = 0 ORDER BY {BUCKET}, account_id, snapshot_date LIMIT (SELECT 3 * count(*) FROM pos)),
c AS (SELECT count(*) AS n, sum(is_mule_90d) AS m, avg(is_mule_90d) AS r FROM (SELECT * FROM pos UNION ALL SELECT * FROM neg)), b AS (SELECT avg(is_mule_90d) AS br FROM w), o AS (SELECT br / (1 - br) / (r / (1 - r)) AS x, r, br, n, m FROM b, c),
p AS (SELECT f.*, (pass_through_ratio_7d + r) / 2 AS p, x FROM f, o WHERE snapshot_date = DATE '{run_date}'), q AS (SELECT *, round_even(p, 5) AS p_mule, round_even(p * x / (p * x + 1 - p), 6) AS p_mule_adj FROM p),
k AS (SELECT *, CAST(row_number() OVER (ORDER BY p_mule_adj DESC, account_id) AS INTEGER) AS risk_rank, count(*) OVER () AS total FROM q), ranked AS (SELECT *, round_even(risk_rank / total, 6) AS risk_pct FROM k),
book AS (SELECT *, CASE WHEN risk_pct <= 0.002 THEN 'T1_FREEZE_REVIEW' WHEN risk_pct <= 0.01 THEN 'T2_HOLD_MONITOR' WHEN risk_pct <= 0.03 THEN 'T3_WATCHLIST' ELSE 'NONE' END AS tier FROM ranked)"""


@query(f"WITH {run_sql('2024-06-21')} SELECT DATE '2024-06-21' AS run_date, account_id, cif, ring_id, risk_rank, risk_pct, tier, p_mule, p_mule_adj, array_to_string({CODES}, ',') AS reason_codes FROM book WHERE tier <> 'NONE'")
def daily_alerts(spark, sf_dir):
    st, _ = scored_day(spark, sf_dir, with_holdout=False)
    return st.read("mule_alerts").select("run_date", "account_id", "cif", "ring_id", "risk_rank", "risk_pct", "tier", "p_mule", "p_mule_adj", "reason_codes")


@query(f"""WITH {run_sql('2024-06-21')}, a AS (SELECT ring_id, max(ring_size) AS ring_size, CAST(count(*) AS INTEGER) AS accounts_scored, CAST(count(*) FILTER (WHERE tier <> 'NONE') AS INTEGER) AS accounts_alerted, min(CASE WHEN tier <> 'NONE' THEN tier END) AS top_tier, max(p_mule_adj) AS max_p_mule_adj,
CAST(round(sum(CAST(p_mule_adj AS DECIMAL(18,6))), 5) AS DOUBLE) AS sum_p_mule_adj FROM book WHERE ring_size >= 2 GROUP BY 1) SELECT * FROM a WHERE accounts_alerted > 0""")
def daily_rings(spark, sf_dir):
    st, _ = scored_day(spark, sf_dir, with_holdout=False)
    return st.read("mule_rings").select("ring_id", "ring_size", "accounts_scored", "accounts_alerted", "top_tier", "max_p_mule_adj", "sum_p_mule_adj")


RUN_SQL = """SELECT DATE '{0}' AS run_date, CAST(any_value(total) AS INTEGER) AS scored_accounts, CAST(count(*) FILTER (WHERE tier LIKE 'T1%') AS INTEGER) AS alerts_t1, CAST(count(*) FILTER (WHERE tier LIKE 'T2%') AS INTEGER) AS alerts_t2, CAST(count(*) FILTER (WHERE tier LIKE 'T3%') AS INTEGER) AS alerts_t3,
min(CASE WHEN tier LIKE 'T1%' THEN p_mule_adj END) AS t1_cutoff, (SELECT CAST(n AS INTEGER) FROM o) AS context_rows, (SELECT CAST(m AS INTEGER) FROM o) AS context_mules, (SELECT last FROM u) AS context_to, (SELECT round(br, 7) FROM o) AS book_mule_rate, 'measured' AS book_rate_source, {1} AS triggered_by FROM book"""
SHOWN = ["run_date", "scored_accounts", "alerts_t1", "alerts_t2", "alerts_t3", "t1_cutoff", "context_rows", "context_mules", "context_to", "book_mule_rate", "book_rate_source", "triggered_by"]


@query(f"SELECT * FROM (WITH {run_sql('2024-06-14')} {RUN_SQL.format('2024-06-14', repr('backfill'))}) UNION ALL SELECT * FROM (WITH {run_sql('2024-06-21')} {RUN_SQL.format('2024-06-21', repr('backfill'))})")
def backfilled_runs(spark, sf_dir):
    """Runs of two past dates, each with what was known then, in one table of runs."""
    st, logged = new_store(spark), []
    st.write("mule_features", book(spark, sf_dir), by_month="snapshot_date")
    daily.backfill(st, [AS_OF, date(2024, 6, 14)], policy=SMALL, scorer=half_and_rate, publish_on_fail=True, with_holdout=False, on_done=logged.append)
    assert [r["run_date"] for r in logged] == [date(2024, 6, 14), AS_OF]
    return st.read("mule_model_run").select(*SHOWN)


@query(f"""WITH {run_sql('2024-06-21')}, cut AS (SELECT min(CASE WHEN tier LIKE 'T1%' THEN p_mule_adj END) AS t1, min(CASE WHEN tier LIKE 'T2%' THEN p_mule_adj END) AS t2, min(CASE WHEN tier LIKE 'T3%' THEN p_mule_adj END) AS t3 FROM book),
asked AS (SELECT * EXCLUDE (hops_to_known_mule), 1 AS hops_to_known_mule FROM (SELECT * FROM book ORDER BY account_id LIMIT 1000)), s AS (SELECT *, round(br, 7) / (1 - round(br, 7)) / (round(r, 5) / (1 - round(r, 5))) AS y FROM asked, (SELECT br, r FROM o), cut)
SELECT account_id, p_mule, round(p * y / (p * y + 1 - p), 6) AS p_mule_adj, CASE WHEN p * y / (p * y + 1 - p) >= t1 THEN 'T1_FREEZE_REVIEW' WHEN p * y / (p * y + 1 - p) >= t2 THEN 'T2_HOLD_MONITOR' WHEN p * y / (p * y + 1 - p) >= t3 THEN 'T3_WATCHLIST' ELSE 'NONE' END AS tier, array_to_string({CODES}, ',') AS reason_codes FROM s""")
def endpoint_scores(spark, sf_dir):
    """What the endpoint answers to its largest request, the first thousand accounts, if all were a hop from a known one."""
    st, _ = scored_day(spark, sf_dir, with_holdout=False)
    asked = st.read("mule_features", where=F.col("snapshot_date") == F.lit(AS_OF)).orderBy("account_id").limit(daily.MOST_ACCOUNTS).collect()
    reply = daily.Endpoint(st, policy=SMALL, scorer=half_and_rate)({"accounts": [{"account_id": r["account_id"]} | {f: float(r[f]) for f in FEATURES} for r in asked], "what_if": {"hops_to_known_mule": 1}})
    rows = [(s["account_id"], s["p_mule_what_if"], s["p_mule_adj_what_if"], s["tier_what_if"], s["reason_codes_what_if"]) for s in reply["scores"]]
    return spark.createDataFrame(rows, "account_id string, p_mule double, p_mule_adj double, tier string, reason_codes string")



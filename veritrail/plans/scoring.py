"""Queries over the scorer families and what stands beside an alert queue, with SQL written on its own."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scorers
from . import chain, day, layers, reports
from .registry import query, read, shared

# ---------------------------------------------------------------- families

#: The context that the families learn from: the first 400 customers in an order of their own, with a label that the balance makes likelier.
PAIR = ["c_acctbal", "c_nationkey"]
LABELLED = "CAST((c_custkey * 7919) % 1000 < 150 + CASE WHEN c_acctbal > 5000 THEN 500 ELSE 0 END + 10 * c_nationkey AS INT)"
CONTEXT = f"""c AS (SELECT c_acctbal, c_nationkey, {LABELLED} AS y FROM customer ORDER BY (c_custkey * 31) % 1009, c_custkey LIMIT 400), m AS (SELECT avg(c_acctbal) AS m1, stddev_pop(c_acctbal) AS s1, avg(c_nationkey) AS m2, stddev_pop(c_nationkey) AS s2 FROM c),
z AS (SELECT (c_acctbal - m1) / s1 AS x1, (c_nationkey - m2) / s2 AS x2, y FROM c, m), b AS (SELECT c_custkey, (c_acctbal - m1) / s1 AS x1, (c_nationkey - m2) / s2 AS x2 FROM customer, m)"""


def steps(n: int, penalty: float) -> str:
    """Newton's steps from zero, each with the inverse of a matrix of three by three."""
    out = ["w0 AS (SELECT CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS u, CAST(0 AS DOUBLE) AS v)"]
    for k in range(1, n + 1):
        out.append(f"""g{k} AS (SELECT a, u, v, sum(p - y) AS ga, sum((p - y) * x1) + {penalty} * u AS gu, sum((p - y) * x2) + {penalty} * v AS gv, sum(p * (1 - p)) AS h00, sum(p * (1 - p) * x1) AS h01, sum(p * (1 - p) * x2) AS h02,
sum(p * (1 - p) * x1 * x1) + {penalty} AS h11, sum(p * (1 - p) * x1 * x2) AS h12, sum(p * (1 - p) * x2 * x2) + {penalty} AS h22 FROM (SELECT *, 1 / (1 + exp(-(a + u * x1 + v * x2))) AS p FROM z, w{k - 1}) GROUP BY a, u, v),
d{k} AS (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det FROM g{k}),
w{k} AS (SELECT a - ((h11 * h22 - h12 * h12) * ga + (h02 * h12 - h01 * h22) * gu + (h01 * h12 - h02 * h11) * gv) / det AS a, u - ((h02 * h12 - h01 * h22) * ga + (h00 * h22 - h02 * h02) * gu + (h01 * h02 - h00 * h12) * gv) / det AS u,
v - ((h01 * h12 - h02 * h11) * ga + (h01 * h02 - h00 * h12) * gu + (h00 * h11 - h01 * h01) * gv) / det AS v FROM d{k})""")
    return ", ".join(out)


BY_WEIGHTS = "SELECT c_custkey, round(1 / (1 + exp(-(a + u * x1 + v * x2))), 6) AS p FROM b, w9"
BY_CONTEXT = "SELECT c_custkey, round(sum(k * y) / sum(k), 6) AS p FROM (SELECT c_custkey, y, exp(-((b.x1 - z.x1) * (b.x1 - z.x1) + (b.x2 - z.x2) * (b.x2 - z.x2)) / (2 * 0.25 * 2)) AS k FROM b, z) GROUP BY c_custkey"


def scores(spark: SparkSession, sf_dir: str, family: str, on: str = "cpu") -> DataFrame:
    """Every customer's probability by a family that has learned from the context."""
    c = read(spark, sf_dir, "customer")
    context = c.orderBy((F.col("c_custkey") * 31) % 1009, "c_custkey").limit(400).select(*PAIR, F.expr(LABELLED).alias("y"))
    name = scorers.resolved(family, on)
    p = scorers.FAMILIES[name].fit(context, features=PAIR, label="y")(c.select("c_custkey", *PAIR))
    return p.select(F.lit(name).alias("family"), "c_custkey", F.round("p", 6).alias("p"))


@query(f"WITH {CONTEXT}, {steps(9, 2.0)} SELECT 'stub' AS family, * FROM ({BY_WEIGHTS})")
def logistic_scores(spark, sf_dir):
    """Standardised logistic regression: the SQL takes the same steps of Newton's method."""
    return scores(spark, sf_dir, "stub")


@query(f"WITH {CONTEXT} SELECT 'kernel' AS family, * FROM ({BY_CONTEXT})")
def kernel_scores(spark, sf_dir):
    """In-context scores: the SQL is the plain sum over the context."""
    return scores(spark, sf_dir, "kernel")


@query(f"WITH {CONTEXT}, {steps(9, 2.0)} SELECT 'cpu' AS device, 'stub' AS family, * FROM ({BY_WEIGHTS}) UNION ALL SELECT 'gpu', 'kernel', * FROM ({BY_CONTEXT})")
def resolved_families(spark, sf_dir):
    """The family that "auto" means on either kind of device, and its scores."""
    rows = [scores(spark, sf_dir, "auto", on).select(F.lit(on).alias("device"), "*") for on in ("cpu", "gpu")]
    return rows[0].unionByName(rows[1])


# ---------------------------------------------------------------- beside a queue


@query(f"""WITH {day.made("mule_alerts", "investigator_decisions", "mule_features")}, a AS (SELECT * FROM mule_alerts WHERE run_date = (SELECT max(run_date) FROM mule_alerts)), d AS (SELECT account_id, max_by(decision, (decided_at, decision_id)) AS last_decision, max(decided_at) AS decided_at, count(*) AS decisions FROM investigator_decisions GROUP BY 1),
h AS (SELECT account_id, max_by(is_mule_90d, snapshot_date) AS label, max(snapshot_date) AS labelled_on FROM mule_features WHERE is_mule_90d IS NOT NULL GROUP BY 1)
SELECT a.account_id, a.cif, risk_rank, tier, last_decision, decided_at, coalesce(decisions, 0) AS decisions, label AS last_label, labelled_on FROM a LEFT JOIN d USING (account_id) LEFT JOIN h USING (account_id)""")
def queue_with_outcomes(spark, sf_dir):
    """The alert queue with each account's last decision and its last label that has matured."""
    return day.plain(reports.queue(day.tables(spark, sf_dir)))


LINKED = "links AS (SELECT DISTINCT 'C' || CAST(o_custkey % 700 AS STRING) AS src_cif, 'C' || CAST(l_suppkey % 700 AS STRING) AS dst_cif, CAST(l_shipdate AS DATE) AS first_seen FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_totalprice > 300000)"


@query(f"""WITH {day.made("mule_alerts", "account")}, {LINKED}, a AS (SELECT * FROM mule_alerts WHERE run_date = (SELECT max(run_date) FROM mule_alerts)), t AS (SELECT cif, min(tier) AS tier FROM a GROUP BY 1), home AS (SELECT cif, min(branch_code) AS home_branch FROM account GROUP BY 1),
e AS (SELECT src_cif, dst_cif, first_seen FROM links UNION ALL SELECT dst_cif, src_cif, first_seen FROM links), p AS (SELECT src_cif AS cif, dst_cif AS other_cif, min(first_seen) AS first_seen FROM e WHERE src_cif <> dst_cif AND src_cif IN (SELECT cif FROM a) GROUP BY 1, 2)
SELECT p.cif, other_cif, first_seen, home_branch, t.tier IS NOT NULL AS alerted_this_run, coalesce(t.tier, 'NONE') AS other_tier FROM p LEFT JOIN t ON t.cif = other_cif LEFT JOIN home ON home.cif = other_cif""")
def linked_customers(spark, sf_dir):
    """The customers linked to those of the queue, whether they are in it too, and their tier there."""
    t = day.tables(spark, sf_dir)
    o, items = read(spark, sf_dir, "orders").where("o_totalprice > 300000"), read(spark, sf_dir, "lineitem")
    cif = [F.concat(F.lit("C"), (F.col(c) % 700).cast("string")).alias(n) for c, n in (("o_custkey", "src_cif"), ("l_suppkey", "dst_cif"))]
    edges = o.join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(*cif, F.to_date("l_shipdate").alias("first_seen")).distinct()
    return reports.linked(t, edges, t["account"].groupBy("cif").agg(F.min("branch_code").alias("home_branch")))


@query(f"""WITH {day.made("mule_alerts", "mule_rings", "mule_features")}, a AS (SELECT * FROM mule_alerts WHERE run_date = (SELECT max(run_date) FROM mule_alerts)), r AS (SELECT ring_id FROM mule_rings WHERE run_date = (SELECT max(run_date) FROM mule_rings))
SELECT f.ring_id, f.account_id, f.cif, coalesce(a.tier, 'NONE') AS tier, a.p_mule_adj, a.risk_rank, f.hops_to_known_mule FROM (SELECT account_id, cif, 'R' || CAST(CAST(substr(account_id, 2) AS BIGINT) % 100 AS STRING) AS ring_id, hops_to_known_mule FROM mule_features WHERE snapshot_date = (SELECT max(run_date) FROM mule_alerts)) f JOIN r USING (ring_id) LEFT JOIN a ON a.account_id = f.account_id""")
def ring_members(spark, sf_dir):
    """The accounts of the published rings, with their alerts where they have any."""
    t = day.tables(spark, sf_dir)
    ring = F.concat(F.lit("R"), (F.expr("CAST(substr(account_id, 2) AS BIGINT)") % 100).cast("string"))
    return reports.members(t | {"mule_features": t["mule_features"].withColumn("ring_id", ring)})


# ---------------------------------------------------------------- versions of the feature table


@shared
def matured(spark: SparkSession, sf_dir: str):
    """A feature table as it was loaded first, made by the merge itself, and after a load in which more labels had matured and a week was gone."""
    st, rows = chain.new_store(spark), chain.book(spark, sf_dir)
    early = rows.withColumn("is_mule_90d", F.when(F.col("snapshot_date") < F.lit(date(2024, 2, 16)), F.col("is_mule_90d")))
    st.merge("mule_features", early, ["account_id", "snapshot_date"], by_month="snapshot_date")
    st.merge("mule_features", rows.where(F.col("snapshot_date") > F.lit(date(2024, 1, 5))), ["account_id", "snapshot_date"], by_month="snapshot_date")
    return st


EARLY = "e AS (SELECT * REPLACE (CASE WHEN snapshot_date < DATE '2024-02-16' THEN is_mule_90d END AS is_mule_90d) FROM f)"
COUNTS = "count(*) AS rows_, count(is_mule_90d) AS labelled"


@query(f"""WITH {chain.FEATS}, {EARLY} SELECT count(*) AS context_rows, CAST(sum(is_mule_90d) AS BIGINT) AS context_mules, round(avg(is_mule_90d), 3) AS context_mule_rate FROM (SELECT is_mule_90d FROM e WHERE is_mule_90d IS NOT NULL AND snapshot_date BETWEEN DATE '2024-01-12' AND DATE '2024-05-01' ORDER BY snapshot_date DESC, account_id LIMIT 2000)""")
def context_then(spark, sf_dir):
    """The context that a run of the first version learned from, after that version is history."""
    return reports.context_then(matured(spark, sf_dir), 1, date(2024, 1, 12), date(2024, 5, 1))


@query(f"WITH {chain.FEATS}, {EARLY} SELECT snapshot_date, {COUNTS} FROM e GROUP BY 1 ORDER BY 1 DESC LIMIT 20")
def maturity_then(spark, sf_dir):
    """Rows and labels of each snapshot as they were at the time of the first load."""
    st = matured(spark, sf_dir)
    return reports.maturity_then(st, st.history("mule_features").where("version = 1").first()["committed_at"], k=20)


@query(f"WITH {chain.FEATS}, {EARLY} SELECT 'now' AS version, {COUNTS}, max(snapshot_date) AS latest_snapshot FROM f WHERE snapshot_date > DATE '2024-01-05' UNION ALL SELECT 'first snapshot', {COUNTS}, max(snapshot_date) FROM e")
def versions_compared(spark, sf_dir):
    return reports.versions_compared(matured(spark, sf_dir))


@query(f"""WITH {chain.FEATS}, n AS (SELECT count(*) AS n, count(DISTINCT account_id) AS a, count(*) FILTER (WHERE snapshot_date BETWEEN DATE '2024-02-16' AND DATE '2024-03-22' AND is_mule_90d IS NOT NULL) AS up FROM f)
SELECT CAST(1 AS BIGINT) AS version, 'bootstrap' AS operation, n AS rows_, n AS added, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted FROM n UNION ALL SELECT 2, 'merge', n - a, 0, up, a FROM n""")
def bootstrapped(spark, sf_dir):
    """A merge into a table that is not there yet makes it; the next one changes it."""
    return matured(spark, sf_dir).history("mule_features").select("version", "operation", F.col("rows").alias("rows_"), "added", "updated", "deleted")


@query("SELECT max(CAST(o_orderdate AS DATE)) AS as_of, count(*) AS open_by_then FROM orders")
def as_of_scalar(spark, sf_dir):
    """The as-of date of an extract, as one value that later steps are held to."""
    account = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("batch_as_of"))
    as_of = layers.as_of_date(account)
    return account.where(F.col("batch_as_of") <= F.lit(as_of)).agg(F.lit(as_of).alias("as_of"), F.count("*").alias("open_by_then"))


@query("SELECT o_orderpriority AS table_name, true AS recent, count(*) AS rows_ FROM orders GROUP BY 1")
def recorded_when(spark, sf_dir):
    """Findings carry the time at which they were recorded, in whole seconds."""
    from ..operators import quality

    st, rows = chain.new_store(spark), read(spark, sf_dir, "orders")
    counts = rows.groupBy("o_orderpriority").count().collect()  # a row a priority
    st.append("dq_results", quality.recorded(spark, [quality.row_count(r[0], r[1]) for r in counts], "gold", date(2024, 1, 1)))
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("run_ts")
    recent = age.between(0, 3600) & (F.col("run_ts") == F.date_trunc("second", "run_ts"))
    return st.read("dq_results").select("table_name", recent.alias("recent"), F.col("element_count").alias("rows_"))

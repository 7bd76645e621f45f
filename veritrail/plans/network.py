"""Queries over the link graph and the feature table that comes from it, on tables made from the events; with SQL written on its own.

A user is a customer with one account. Clicks of a high value name a device, signups a mobile; errors of a high value send money to another
user's account or are freezes and confirmations; views of a high value are complaints."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph
from ..operators.features import Silver, assemble
from ..operators.timeline import Calendar
from ..session import cut
from . import layers
from .registry import query, read, shared

CALENDAR = Calendar(as_of=date(2024, 6, 1), first=date(2024, 1, 5))
SHOWN = ["account_id", "snapshot_date", "dormant_reactivated_flag", "accounts_on_same_device", "cifs_sharing_mobile", "person_cluster_size", "ring_size", "hops_to_known_mule", "is_mule_90d", "person_cluster_id", "ring_id"]


@shared
def made(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The standard tables."""
    e = read(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("cif"), "event_type", "value", F.col("ts").cast("timestamp").alias("ts"), F.to_date("ts").alias("d"), F.get_json_object("props", "$.k").alias("k"))
    at = F.concat("k", F.lit("@"), F.col("d").cast("string"))

    def first(kind: str, condition) -> F.Column:
        return F.min(F.when((F.col("event_type") == kind) & condition, F.col("d")))

    value, cif = F.col("value"), F.col("cif")
    account = e.groupBy("cif").agg(F.min("d").alias("open_date"), first("error", value > 285).alias("freeze_date"), first("purchase", value > 250).alias("reactivated_on"))
    account = account.select("*", F.col("cif").alias("account_id"), F.lit("B").alias("branch_code"), F.lit("P").alias("product_code"), F.when(cif % 4 == 0, F.col("open_date")).alias("dormant_from"), F.when(F.col("freeze_date").isNotNull(), "SUSPECT_REGISTRY").alias("freeze_reason"))
    customer = account.select("cif", F.lit("FULL").alias("kyc_type"), F.lit(1e5).alias("declared_annual_income"), F.col("open_date").alias("onboarding_date"), F.when(cif % 5 != 0, F.concat(F.lit("P"), F.expr("cif div 2"))).alias("pan_hash"), F.when(cif % 4 == 1, F.concat(F.lit("AD"), F.expr("cif div 3"))).alias("address_hash"), F.lit(None).cast("string").alias("mobile_hash"))
    session = e.where("event_type in ('click', 'signup')").select(
        "cif", F.col("d").alias("session_date"), F.when((F.col("event_type") == "click") & (value > 80), at).alias("device_id"), F.when((F.col("event_type") == "signup") & (value > 80), F.concat(F.lit("M"), at)).alias("new_mobile_hash"),
        F.when(F.col("event_type") == "signup", "MOBILE_CHANGE").otherwise("LOGIN").alias("event_type"))
    sent = (F.col("event_type") == "error") & (value > 260)
    txn = e.select(
        F.col("event_id").alias("txn_id"), F.col("cif").alias("account_id"), "cif", F.col("ts").alias("txn_ts"), F.col("d").alias("txn_date"), F.when(F.col("event_type").isin("purchase", "signup"), "CR").otherwise("DR").alias("direction"), F.col("value").alias("amount"),
        F.when(value > 270, at).otherwise(F.lit("shop")).alias("counterparty_vpa"), F.when(sent, F.col("k").cast("long")).alias("counterparty_account_id"))
    t = {
        "account": account, "customer": customer, "session": session, "txn": txn,
        "report": e.where("event_type = 'view' and value > 285").select("cif", F.col("cif").alias("account_id"), F.col("d").alias("report_date"), F.col("k").alias("complainant_vpa")),
        "decision": e.where("event_type = 'error' and value > 270").select("cif", F.col("cif").alias("account_id"), F.col("d").alias("decision_date"), F.when(value <= 280, "CONFIRMED_MULE").otherwise("FALSE_POSITIVE").alias("decision")),
    }
    t["identity_links"] = cut(layers.identity_links(customer, layers.mobiles(customer, session), session))
    t["identity_edges"], t["identity_hubs"] = graph.pair_edges(t["identity_links"])
    return t


@shared
def graph_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The link graph's edges and clusters."""
    edges, clusters = layers.link_graph(made(spark, sf_dir), CALENDAR)
    return edges, cut(clusters)


EV = "ev AS (SELECT event_id, user_id AS a, event_type AS e, value AS v, CAST(ts AS DATE) AS d, json_extract_string(props, '$.k') AS k FROM events)"
CAL = "cal AS (SELECT CAST(g AS DATE) AS s FROM generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-06-01', INTERVAL 7 DAY) x(g) UNION SELECT DATE '2024-06-01')"
LINKS = """acc AS (SELECT a, min(d) AS o, min(d) FILTER (WHERE e = 'error' AND v > 285) AS fz, min(d) FILTER (WHERE e = 'purchase' AND v > 250) AS re FROM ev GROUP BY 1),
links AS (SELECT a, 'PAN' AS t, 'P' || (a // 2) AS i, o AS f FROM acc WHERE a % 5 <> 0 UNION ALL SELECT a, 'ADDRESS', 'AD' || (a // 3), o FROM acc WHERE a % 4 = 1 UNION ALL SELECT a, 'MOBILE', 'M' || k || '@' || d, min(d) FROM ev WHERE e = 'signup' AND v > 80 AND k IS NOT NULL GROUP BY 1, 3
UNION ALL SELECT a, 'DEVICE', k || '@' || d, min(d) FROM ev WHERE e = 'click' AND v > 80 AND k IS NOT NULL GROUP BY 1, 3)"""
SEEDS = "seeds AS (SELECT a, min(d) AS d FROM (SELECT a, d FROM ev WHERE e = 'view' AND v > 285 UNION ALL SELECT a, fz FROM acc WHERE fz IS NOT NULL UNION ALL SELECT a, d FROM ev WHERE e = 'error' AND v > 270 AND v <= 280) GROUP BY 1)"
EDGES = """many AS (SELECT t, i FROM links GROUP BY 1, 2 HAVING count(DISTINCT a) BETWEEN 2 AND 25), ie AS (SELECT x.a, y.a AS b, x.t, min(greatest(x.f, y.f)) AS f FROM links x JOIN links y ON x.t = y.t AND x.i = y.i AND x.a < y.a JOIN many m ON m.t = x.t AND m.i = x.i GROUP BY 1, 2, 3),
pe AS (SELECT s, a, b, t AS kind, CAST(1 AS BIGINT) AS w FROM ie JOIN cal ON f <= s), sent AS (SELECT DISTINCT least(a, c) AS a, greatest(a, c) AS b, d FROM (SELECT a, CAST(k AS BIGINT) AS c, d FROM ev WHERE e = 'error' AND v > 260) WHERE c <> a AND c IN (SELECT a FROM acc)),
te AS (SELECT s, a, b, 'TRANSFER' AS kind, count(*) AS w FROM sent JOIN cal ON d <= s AND d > s - 90 GROUP BY 1, 2, 3), met AS (SELECT DISTINCT a, CASE WHEN v > 270 THEN k || '@' || d ELSE 'shop' END AS p, d FROM ev WHERE NOT (e = 'error' AND v > 260)),
usable AS (SELECT p FROM met GROUP BY 1 HAVING count(DISTINCT a) BETWEEN 2 AND 25), seen AS (SELECT DISTINCT s, p, a FROM met JOIN cal ON d <= s AND d > s - 90 WHERE p IN (SELECT p FROM usable)),
se AS (SELECT x.s, x.a, y.a AS b, 'SHARED_COUNTERPARTY' AS kind, count(*) AS w FROM seen x JOIN seen y ON x.s = y.s AND x.p = y.p AND x.a < y.a GROUP BY 1, 2, 3 HAVING count(*) >= 2), ge AS (SELECT * FROM pe UNION ALL SELECT * FROM te UNION ALL SELECT * FROM se)"""
CLUSTERS = """pu AS (SELECT s, a, b FROM pe UNION SELECT s, b, a FROM pe), gu AS (SELECT s, a, b FROM ge UNION SELECT s, b, a FROM ge), pr AS (SELECT s, a, a AS o FROM pu UNION SELECT pr.s, pr.a, pu.b FROM pr JOIN pu ON pu.s = pr.s AND pu.a = pr.o), gr AS (SELECT s, a, a AS o FROM gu UNION SELECT gr.s, gr.a, gu.b FROM gr JOIN gu ON gu.s = gr.s AND gu.a = gr.o),
pc AS (SELECT s, a, min(o) AS id, CAST(count(*) AS INTEGER) AS n FROM pr GROUP BY 1, 2), gc AS (SELECT s, a, min(o) AS id, CAST(count(*) AS INTEGER) AS n FROM gr GROUP BY 1, 2), kn AS (SELECT s, a FROM seeds JOIN cal ON d <= s), one AS (SELECT s, a FROM kn UNION SELECT gu.s, gu.b FROM gu JOIN kn ON kn.s = gu.s AND kn.a = gu.a),
front AS (SELECT DISTINCT gu.s, gu.b AS a FROM gu JOIN kn ON kn.s = gu.s AND kn.a = gu.a), two AS (SELECT DISTINCT gu.s, gu.b AS a FROM gu JOIN front ON front.s = gu.s AND front.a = gu.a EXCEPT SELECT * FROM one), hop AS (SELECT s, a, 1 AS h FROM one UNION ALL SELECT s, a, 2 FROM two),
held AS (SELECT l.t, l.i, l.a, min(l.f) AS f FROM links l JOIN many m ON m.t = l.t AND m.i = l.i GROUP BY 1, 2, 3), hs AS (SELECT s, t, i, a FROM held JOIN cal ON f <= s), hn AS (SELECT s, t, i, count(*) AS n FROM hs GROUP BY 1, 2, 3),
sh AS (SELECT hs.s, hs.a, CAST(max(CASE WHEN hs.t = 'DEVICE' THEN n END) AS INTEGER) AS dev, CAST(max(CASE WHEN hs.t = 'MOBILE' THEN n END) AS INTEGER) AS mob FROM hs JOIN hn ON hn.s = hs.s AND hn.t = hs.t AND hn.i = hs.i GROUP BY 1, 2),
cl AS (SELECT s, a, coalesce(pc.id, a) AS person_cluster_id, coalesce(pc.n, 1) AS person_cluster_size, coalesce(gc.id, a) AS ring_id, coalesce(gc.n, 1) AS ring_size, coalesce(h, 3) AS hops_to_known_mule, dev AS accounts_on_same_device, mob AS cifs_sharing_mobile
FROM (SELECT s, a FROM pc UNION SELECT s, a FROM gc UNION SELECT s, a FROM hop UNION SELECT s, a FROM sh WHERE dev IS NOT NULL OR mob IS NOT NULL) LEFT JOIN pc USING (s, a) LEFT JOIN gc USING (s, a) LEFT JOIN hop USING (s, a) LEFT JOIN sh USING (s, a))"""
ALL = f"WITH RECURSIVE {EV}, {CAL}, {LINKS}, {SEEDS}, {EDGES}, {CLUSTERS}"


@query(f"WITH {EV}, {LINKS} SELECT a AS cif, t AS link_type, i AS identifier, f AS first_seen FROM links")
def identity_links(spark, sf_dir):
    return made(spark, sf_dir)["identity_links"]


@query(f"WITH {EV}, {CAL}, {LINKS}, {SEEDS} SELECT s AS snapshot_date, a AS cif FROM seeds JOIN cal ON d <= s")
def known_seeds(spark, sf_dir):
    t = made(spark, sf_dir)
    return graph.known_on(layers.seeds(t), CALENDAR)


@query(f"{ALL} SELECT s AS snapshot_date, a AS src_cif, b AS dst_cif, kind AS link_type, CAST(w AS INTEGER) AS weight FROM ge")
def graph_edges(spark, sf_dir):
    return graph_of(spark, sf_dir)[0]


@query(f"{ALL} SELECT s AS snapshot_date, a AS cif, * EXCLUDE (s, a) FROM cl")
def graph_clusters(spark, sf_dir):
    return graph_of(spark, sf_dir)[1]


@query(f"{ALL} SELECT s AS snapshot_date, a AS cif, dev AS accounts_on_same_device, mob AS cifs_sharing_mobile FROM sh WHERE dev IS NOT NULL OR mob IS NOT NULL")
def busiest_identifiers(spark, sf_dir):
    t = made(spark, sf_dir)
    device, mobile = graph.shared_identifiers(t["identity_links"], t["identity_hubs"], t["account"], CALENDAR)
    return device.join(mobile, ["snapshot_date", "cif"], "full")


@query(f"""{ALL}, act AS (SELECT DISTINCT a, s FROM ev JOIN cal ON d <= s AND d > s - 30), conf AS (SELECT a, min(d) AS c FROM (SELECT a, fz AS d FROM acc WHERE fz IS NOT NULL UNION ALL SELECT a, d FROM ev WHERE e = 'error' AND v > 270 AND v <= 280) GROUP BY 1), fd AS (SELECT a, min(f) AS f FROM links WHERE t = 'DEVICE' GROUP BY 1)
SELECT a AS account_id, s AS snapshot_date, CAST(coalesce(a % 4 = 0 AND re > s - 90 AND re <= s, false) AS INTEGER) AS dormant_reactivated_flag, coalesce(accounts_on_same_device, CASE WHEN fd.f <= s THEN 1 END, 0) AS accounts_on_same_device, coalesce(cifs_sharing_mobile, 1) AS cifs_sharing_mobile,
coalesce(person_cluster_size, 1) AS person_cluster_size, coalesce(ring_size, 1) AS ring_size, coalesce(hops_to_known_mule, 3) AS hops_to_known_mule, CASE WHEN s + 90 <= DATE '2024-06-01' THEN CAST(coalesce(c > s AND c <= s + 90, false) AS INTEGER) END AS is_mule_90d,
coalesce(person_cluster_id, a) AS person_cluster_id, coalesce(ring_id, a) AS ring_id FROM act JOIN acc USING (a) LEFT JOIN seeds USING (a) LEFT JOIN conf USING (a) LEFT JOIN fd USING (a) LEFT JOIN cl USING (s, a) WHERE o <= s AND (seeds.d IS NULL OR seeds.d > s)""")
def feature_table(spark, sf_dir):
    """The whole chain from events to features: links, dated edges, components, hops, shared identifiers, population, label."""
    t = made(spark, sf_dir)
    clusters = graph_of(spark, sf_dir)[1]
    return assemble(Silver(t["customer"], t["account"], t["txn"], t["session"], t["report"], t["decision"], clusters), CALENDAR).select(*SHOWN)

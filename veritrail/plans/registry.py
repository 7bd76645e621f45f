"""Queries over the supplied tables, one or more for each family of operators, with the SQL that gives the same rows.

Events stand for account activity: purchases and signups are credits, the rest debits, the counterparty comes from the properties.
Orders and line items link customers who had the same part shipped on the same day."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import BANDS, POLICY
from ..functions import scalars as s
from ..operators import behaviour, evaluate, features, graph, quality, relational, score
from ..operators.timeline import Calendar, expand_since, expand_within
from ..session import scratch
from . import reports

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return put


def shared(make: Callable) -> Callable:
    """make(spark, sf_dir, **options) once for an application and its arguments: several queries read what it has written and none changes it."""
    made: dict[tuple, object] = {}

    @wraps(make)
    def get(spark: SparkSession, sf_dir: str, **options):
        key = (spark.sparkContext.applicationId, sf_dir, *sorted(options.items()))
        if key not in made:
            made[key] = make(spark, sf_dir, **options)
        return made[key]

    return get


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


EVENTS = Calendar(as_of=date(2024, 1, 30), first=date(2024, 1, 5))
ORDERS = Calendar(as_of=date(2001, 8, 1), first=date(1995, 1, 6))
CAL = "cal AS (SELECT CAST(d AS DATE) AS snapshot_date FROM generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-30', INTERVAL 7 DAY) g(d) UNION SELECT DATE '2024-01-30')"
OCAL = "cal AS (SELECT CAST(d AS DATE) AS snapshot_date FROM generate_series(TIMESTAMP '1995-01-06', TIMESTAMP '2001-08-01', INTERVAL 7 DAY) g(d) UNION SELECT DATE '2001-08-01')"
ACT = """act AS (SELECT event_id, user_id AS account_id, ts AS txn_ts, CAST(ts AS DATE) AS txn_date, CASE WHEN event_type IN ('purchase', 'signup') THEN 'CR' ELSE 'DR' END AS direction,
  value AS amount, json_extract_string(props, '$.k') AS counterparty_vpa, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events)"""
MOVES = """moves AS (SELECT *, min(CASE WHEN direction = 'DR' THEN t END) OVER (PARTITION BY account_id ORDER BY t, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_debit,
  coalesce(sum(CASE WHEN direction = 'DR' THEN amount END) OVER (PARTITION BY account_id ORDER BY t RANGE BETWEEN 1 FOLLOWING AND 86400 FOLLOWING), 0) AS out_24h FROM act)"""
DAY_END = "CAST(epoch(CAST(snapshot_date AS TIMESTAMP)) AS BIGINT) + 86399"


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    direction = F.when(F.col("event_type").isin("purchase", "signup"), "CR").otherwise("DR")
    return e.select("event_id", F.col("user_id").alias("account_id"), s.instant(F.col("ts")).alias("txn_ts"), F.to_date("ts").alias("txn_date"), direction.alias("direction"), F.col("value").alias("amount"), F.get_json_object("props", "$.k").alias("counterparty_vpa"))


# ---------------------------------------------------------------- behaviour


@query(f"""WITH {CAL}, {ACT}, {MOVES},
wk AS (SELECT account_id, snapshot_date, sum(CASE WHEN direction = 'CR' AND t + 86400 <= {DAY_END} THEN least(amount, out_24h) END) AS o, sum(CASE WHEN direction = 'CR' AND t + 86400 <= {DAY_END} THEN amount END) AS i
  FROM moves JOIN cal ON txn_date <= snapshot_date AND txn_date > snapshot_date - 7 GROUP BY 1, 2),
mo AS (SELECT account_id, snapshot_date, quantile_disc(CASE WHEN direction = 'CR' THEN least(720.0, (least(coalesce(next_debit, {DAY_END}), {DAY_END}) - t) / 3600.0) END, 0.5) AS h
  FROM moves JOIN cal ON txn_date <= snapshot_date AND txn_date > snapshot_date - 30 GROUP BY 1, 2)
SELECT mo.account_id, mo.snapshot_date, round(CASE WHEN i > 0 THEN o / i ELSE 0 END, 3) AS pass_through_ratio_7d, round(coalesce(h, 720.0), 1) AS median_hold_hours_30d
FROM mo LEFT JOIN wk ON wk.account_id = mo.account_id AND wk.snapshot_date = mo.snapshot_date""")
def pass_through_and_hold(spark, sf_dir):
    rows = behaviour.measures(behaviour.followed(activity(spark, sf_dir), "event_id"), EVENTS)
    return rows.select("account_id", "snapshot_date", behaviour.pass_through().alias("pass_through_ratio_7d"), F.round(F.coalesce("median_hold", F.lit(720.0)), 1).alias("median_hold_hours_30d"))


@query(f"WITH {ACT}, {MOVES} SELECT event_id, direction, next_debit, round(out_24h, 4) AS out_24h FROM moves")
def next_debit_and_outflow(spark, sf_dir):
    return behaviour.followed(activity(spark, sf_dir), "event_id").select("event_id", "direction", "next_debit", F.round("out_24h", 4).alias("out_24h"))


@query(f"""WITH {CAL}, {ACT} SELECT account_id, snapshot_date, count(*) AS txns_30d, round(coalesce(sum(CASE WHEN direction = 'CR' THEN amount END), 0), 4) AS credits_30d,
count(*) FILTER (WHERE hour(txn_ts) IN (23, 0, 1, 2, 3, 4)) AS night_30d, count(*) FILTER (WHERE direction = 'CR') AS n_credits_30d
FROM act JOIN cal ON txn_date <= snapshot_date AND txn_date > snapshot_date - 30 GROUP BY 1, 2""")
def month_activity(spark, sf_dir):
    m = behaviour.measures(behaviour.followed(activity(spark, sf_dir), "event_id"), EVENTS)
    return m.select("account_id", "snapshot_date", F.col("n_moves").alias("txns_30d"), F.round("credit_sum", 4).alias("credits_30d"), F.col("n_at_night").alias("night_30d"), F.col("n_credits").alias("n_credits_30d"))


@query(f"""WITH {CAL}, {ACT} SELECT account_id, snapshot_date, count(DISTINCT CASE WHEN direction = 'CR' THEN counterparty_vpa END) AS distinct_senders_7d, count(DISTINCT CASE WHEN direction = 'DR' THEN counterparty_vpa END) AS distinct_receivers_7d
FROM act JOIN cal ON txn_date <= snapshot_date AND txn_date > snapshot_date - 7 WHERE counterparty_vpa IS NOT NULL GROUP BY 1, 2""")
def distinct_counterparties(spark, sf_dir):
    w = behaviour.counterparties(activity(spark, sf_dir), EVENTS)
    return w.select("account_id", "snapshot_date", F.col("senders").alias("distinct_senders_7d"), F.col("receivers").alias("distinct_receivers_7d"))


@query("SELECT o_orderkey, hour(o_orderdate + INTERVAL (o_orderkey % 24) HOUR) IN (23, 0, 1, 2, 3, 4) AS night, floor(o_totalprice) % 5 = 0 AS round_amount FROM orders")
def night_and_round(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    at = s.instant(F.col("o_orderdate")) + F.make_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return o.select("o_orderkey", s.at_night(at).alias("night"), s.multiple_of(F.floor("o_totalprice"), 5).alias("round_amount"))


FEATURE_SQL = f"""WITH {CAL}, {ACT}, {MOVES},
ev AS (SELECT *, CAST(ts AS DATE) AS d, json_extract_string(props, '$.k') AS k FROM events),
acc AS (SELECT user_id AS a, min(d) AS open_date, min(CASE WHEN event_type = 'error' AND value > 280 THEN d END) AS freeze_date FROM ev GROUP BY 1),
rep AS (SELECT user_id AS a, d AS report_date, k AS complainant FROM ev WHERE event_type = 'view' AND value > 280),
ses AS (SELECT user_id AS a, d, k AS device, CASE WHEN value > 200 THEN 'MOBILE_CHANGE' ELSE 'LOGIN' END AS e FROM ev WHERE event_type = 'click'),
known AS (SELECT a, min(d) AS known_from FROM (SELECT a, report_date AS d FROM rep UNION ALL SELECT a, freeze_date FROM acc WHERE freeze_date IS NOT NULL) GROUP BY 1),
m30 AS (SELECT account_id AS a, snapshot_date AS s, count(*) AS n, coalesce(sum(CASE WHEN direction = 'CR' THEN amount END), 0) AS cr, count(*) FILTER (WHERE hour(txn_ts) IN (23, 0, 1, 2, 3, 4)) AS night, count(*) FILTER (WHERE direction = 'CR') AS ncr,
  count(*) FILTER (WHERE direction = 'CR' AND amount % 1000 = 0) AS rnd, quantile_disc(CASE WHEN direction = 'CR' THEN least(720.0, (least(coalesce(next_debit, {DAY_END}), {DAY_END}) - t) / 3600.0) END, 0.5) AS hold
  FROM moves JOIN cal ON txn_date <= snapshot_date AND txn_date > snapshot_date - 30 GROUP BY 1, 2),
m7 AS (SELECT account_id AS a, snapshot_date AS s, count(DISTINCT CASE WHEN direction = 'CR' THEN counterparty_vpa END) AS snd, count(DISTINCT CASE WHEN direction = 'DR' THEN counterparty_vpa END) AS rcv,
  sum(CASE WHEN direction = 'CR' AND t + 86400 <= {DAY_END} THEN least(amount, out_24h) END) AS o, sum(CASE WHEN direction = 'CR' AND t + 86400 <= {DAY_END} THEN amount END) AS i FROM moves JOIN cal ON txn_date <= snapshot_date AND txn_date > snapshot_date - 7 GROUP BY 1, 2),
fd AS (SELECT a, device, min(d) AS d FROM ses WHERE device IS NOT NULL GROUP BY 1, 2),
nd AS (SELECT a, snapshot_date AS s, count(*) AS n FROM fd JOIN cal ON d <= snapshot_date AND d > snapshot_date - 30 GROUP BY 1, 2), ch AS (SELECT a, snapshot_date AS s, count(*) AS n FROM ses JOIN cal ON d <= snapshot_date AND d > snapshot_date - 30 WHERE e = 'MOBILE_CHANGE' GROUP BY 1, 2),
dev AS (SELECT a, min(d) AS d FROM fd GROUP BY 1), cp AS (SELECT complainant, min(report_date) AS c FROM rep WHERE complainant IS NOT NULL GROUP BY 1),
vc AS (SELECT account_id AS a, snapshot_date AS s, count(*) AS n FROM act JOIN cp ON complainant = counterparty_vpa JOIN cal ON txn_date <= snapshot_date AND txn_date > snapshot_date - 30 WHERE direction = 'CR' AND c <= snapshot_date GROUP BY 1, 2)
SELECT m30.a AS account_id, m30.s AS snapshot_date, CAST(m30.s - open_date AS INTEGER) AS account_age_days, CAST(m30.a < 20 AS INTEGER) AS min_kyc_flag, round(cr / greatest(5000.0, (60000.0 + 1000 * m30.a) / 12), 3) AS inflow_to_declared_income_30d, CAST(coalesce(snd, 0) AS INTEGER) AS distinct_senders_7d, CAST(coalesce(rcv, 0) AS INTEGER) AS distinct_receivers_7d,
round(CASE WHEN i > 0 THEN o / i ELSE 0 END, 3) AS pass_through_ratio_7d, round(coalesce(hold, 720.0), 1) AS median_hold_hours_30d, round(night / m30.n, 3) AS night_txn_share_30d, round(CASE WHEN ncr > 0 THEN rnd / ncr ELSE 0 END, 3) AS round_amount_share_30d, CAST(coalesce(nd.n, 0) AS INTEGER) AS new_device_logins_30d, CAST(coalesce(ch.n, 0) AS INTEGER) AS vpa_or_mobile_changes_30d,
CAST(CASE WHEN dev.d <= m30.s THEN 1 ELSE 0 END AS INTEGER) AS accounts_on_same_device, CAST(coalesce(vc.n, 0) AS INTEGER) AS credits_from_complainants_30d
FROM m30 JOIN acc ON acc.a = m30.a LEFT JOIN known ON known.a = m30.a LEFT JOIN m7 ON m7.a = m30.a AND m7.s = m30.s LEFT JOIN nd ON nd.a = m30.a AND nd.s = m30.s LEFT JOIN ch ON ch.a = m30.a AND ch.s = m30.s LEFT JOIN dev ON dev.a = m30.a LEFT JOIN vc ON vc.a = m30.a AND vc.s = m30.s
WHERE open_date <= m30.s AND (known_from IS NULL OR known_from > m30.s)"""


@query(FEATURE_SQL)
def feature_assembly(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_type", "value", F.to_date("ts").alias("d"), F.get_json_object("props", "$.k").alias("k"))
    user, no_date = F.col("user_id"), F.lit(None).cast("date")
    frozen = F.min(F.when((F.col("event_type") == "error") & (F.col("value") > 280), F.col("d")))
    account = e.groupBy("user_id").agg(F.min("d").alias("open_date"), frozen.alias("freeze_date")).select(user.alias("account_id"), user.alias("cif"), F.lit("B").alias("branch_code"), F.lit("P").alias("product_code"), "open_date", no_date.alias("dormant_from"), no_date.alias("reactivated_on"), "freeze_date", F.when(F.col("freeze_date").isNotNull(), "CYBER_COMPLAINT").alias("freeze_reason"))
    customer = account.select("cif", F.when(F.col("cif") < 20, "MIN_KYC").otherwise("FULL").alias("kyc_type"), (60000.0 + 1000 * F.col("cif")).alias("declared_annual_income"))
    session = e.where("event_type = 'click'").select(user.alias("cif"), F.col("d").alias("session_date"), F.col("k").alias("device_id"), F.when(F.col("value") > 200, "MOBILE_CHANGE").otherwise("LOGIN").alias("event_type"))
    report = e.where("event_type = 'view' and value > 280").select(user.alias("account_id"), F.col("d").alias("report_date"), F.col("k").alias("complainant_vpa"))
    decision = spark.createDataFrame([], "account_id long, decision string, decision_date date")
    clusters = spark.createDataFrame([], "snapshot_date date, cif long, person_cluster_id long, person_cluster_size int, ring_id long, ring_size int, hops_to_known_mule int, accounts_on_same_device int, cifs_sharing_mobile int")
    txn = activity(spark, sf_dir).withColumnRenamed("event_id", "txn_id")
    rows = features.assemble(features.Silver(customer, account, txn, session, report, decision, clusters), EVENTS)
    return rows.select(
        "account_id", "snapshot_date", "account_age_days", "min_kyc_flag", "inflow_to_declared_income_30d", "distinct_senders_7d", "distinct_receivers_7d", "pass_through_ratio_7d", "median_hold_hours_30d", "night_txn_share_30d",
        "round_amount_share_30d", "new_device_logins_30d", "vpa_or_mobile_changes_30d", "accounts_on_same_device", "credits_from_complainants_30d",
    )


# ---------------------------------------------------------------- timeline


@query(f"WITH {CAL} SELECT snapshot_date, count(*) AS n, count(DISTINCT user_id) AS users FROM events JOIN cal ON CAST(ts AS DATE) <= snapshot_date AND CAST(ts AS DATE) > snapshot_date - 30 GROUP BY 1")
def expand_30d(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    return expand_within(e, "day", EVENTS, 30).groupBy("snapshot_date").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query(f"WITH {CAL} SELECT event_id, snapshot_date FROM events JOIN cal ON CAST(ts AS DATE) <= snapshot_date AND CAST(ts AS DATE) > snapshot_date - 7")
def expand_7d(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    return expand_within(e, "day", EVENTS, 7).select("event_id", "snapshot_date")


@query(f"WITH {CAL} SELECT snapshot_date, count(*) AS known FROM (SELECT user_id, min(CAST(ts AS DATE)) AS d FROM events GROUP BY 1) JOIN cal ON d <= snapshot_date GROUP BY 1")
def expand_from_first(spark, sf_dir):
    first = read(spark, sf_dir, "events").groupBy("user_id").agg(F.min(F.to_date("ts")).alias("d"))
    return expand_since(first, "d", EVENTS).groupBy("snapshot_date").agg(F.count("*").alias("known"))


@query(f"WITH {OCAL} SELECT o_custkey AS cif, snapshot_date, count(*) AS own_accounts FROM orders JOIN cal ON CAST(o_orderdate AS DATE) <= snapshot_date GROUP BY 1, 2")
def own_accounts_by_day(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cif"), F.to_date("o_orderdate").alias("open_date"))
    return features.own_accounts(o, ORDERS)


# ---------------------------------------------------------------- rows


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_latest(spark, sf_dir):
    rows = relational.latest(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], by="l_shipdate")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


@query(r"""SELECT c_custkey, upper(trim(c_mktsegment)) AS segment, lower(trim(c_name)) AS handle, CASE WHEN length(regexp_replace(p, '\D', '', 'g')) >= 10 THEN right(regexp_replace(p, '\D', '', 'g'), 10) END AS mobile,
CASE WHEN length(regexp_replace(p, '\D', '', 'g')) >= 10 THEN left(right(regexp_replace(p, '\D', '', 'g'), 10), 2) || 'xxxxx' || right(p, 3) END AS masked,
regexp_replace(upper(c_name || ' ' || c_mktsegment), '[^A-Z0-9]', '', 'g') AS address, regexp_extract(ip, '^(\d+\.\d+\.\d+)\.', 1) AS subnet
FROM (SELECT *, '+91-' || CAST(c_custkey * 7654321 AS VARCHAR) AS p, '10.' || c_nationkey || '.' || c_custkey % 250 || '.7' AS ip FROM customer)""")
def standard_keys(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    phone = s.mobile(F.concat(F.lit("+91-"), (F.col("c_custkey") * 7654321).cast("string")))
    ip = F.concat(F.lit("10."), F.col("c_nationkey").cast("string"), F.lit("."), (F.col("c_custkey") % 250).cast("string"), F.lit(".7"))
    return c.select("c_custkey", s.code(F.col("c_mktsegment")).alias("segment"), s.handle(F.col("c_name")).alias("handle"), phone.alias("mobile"), s.masked(phone).alias("masked"), s.address(F.col("c_name"), F.col("c_mktsegment")).alias("address"), s.subnet(ip).alias("subnet"))


@query("SELECT c_custkey, sha256('salt' || c_name) AS name_hash FROM customer")
def hashed_keys(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", s.hashed(F.col("c_name"), "salt").alias("name_hash"))


@query("""SELECT o_orderkey, c_nationkey AS found, 'URGENT' AS resolved_via FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority LIKE '1%'
UNION ALL SELECT o_orderkey, s_nationkey, 'HIGH' FROM orders JOIN supplier ON s_suppkey = o_orderkey % 100 WHERE o_orderpriority LIKE '2%'
UNION ALL SELECT o_orderkey, n_nationkey, 'OPEN' FROM orders JOIN nation ON n_regionkey = o_custkey % 5 WHERE o_orderpriority NOT LIKE '1%' AND o_orderpriority NOT LIKE '2%' AND o_orderstatus = 'O'""")
def resolve_by_routes(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumns({"a": F.col("o_custkey"), "b": F.col("o_orderkey") % 100, "c": F.col("o_custkey") % 5})
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("a"), F.col("c_nationkey").alias("found"))
    sup = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("b"), F.col("s_nationkey").alias("found"))
    n = read(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("long").alias("c"), F.col("n_nationkey").alias("found"))
    p = F.col("o_orderpriority")
    return relational.resolved(o, [("URGENT", p.startswith("1"), c, ["a"]), ("HIGH", p.startswith("2"), sup, ["b"]), ("OPEN", F.col("o_orderstatus") == "O", n, ["c"])]).select("o_orderkey", "found", "resolved_via")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def semi_join(spark, sf_dir):
    big = read(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey").join(big, "c_custkey", "left_semi")


@query("SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")
def anti_join(spark, sf_dir):
    used = read(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return read(spark, sf_dir, "part").select("p_partkey").join(used, "p_partkey", "left_anti")


@query("""SELECT coalesce(c.k, u.k) AS k, c.n AS customers, u.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 5000 GROUP BY 1) c
FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 7000 GROUP BY 1) u ON c.k = u.k""")
def full_join(spark, sf_dir):
    c = read(spark, sf_dir, "customer").where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    return c.join(read(spark, sf_dir, "supplier").where("s_acctbal > 7000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers")), "k", "full")


@query("SELECT o_orderkey, CASE WHEN o_orderdate = (SELECT max(o_orderdate) FROM orders) THEN 1 ELSE 0 END AS is_latest FROM orders")
def latest_flag(spark, sf_dir):
    return reports.flagged_latest(read(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey", "is_latest")


@query("SELECT c_nationkey, c_custkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS rank FROM customer QUALIFY rank <= 3")
def top_in_group(spark, sf_dir):
    from pyspark.sql import Window

    top = relational.top_in_group(read(spark, sf_dir, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3)
    return top.select("c_nationkey", "c_custkey", F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")).alias("rank"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank, CAST(sum(c_custkey) OVER (ORDER BY c_acctbal DESC, c_custkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS upto FROM customer")
def global_rank_and_sum(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return relational.numbered(c, [F.desc("c_acctbal"), F.col("c_custkey")], "rank", F.col("c_custkey"), "upto").select("c_custkey", "rank", F.round("upto", 2).alias("upto"))


@query("SELECT DISTINCT a AS src, b AS dst FROM (SELECT l_suppkey AS a, l_partkey AS b FROM lineitem UNION ALL SELECT l_partkey, l_suppkey FROM lineitem)")
def symmetric_edges(spark, sf_dir):
    return relational.both_ways(read(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey")


# ---------------------------------------------------------------- graph

LINKS = "links AS (SELECT CAST(o_custkey AS VARCHAR) AS cif, 'SHIP' AS link_type, l_partkey || '@' || CAST(l_shipdate AS DATE) AS identifier, min(CAST(o_orderdate AS DATE)) AS first_seen FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)"
EDGES = f"""{LINKS}, usable AS (SELECT identifier FROM links GROUP BY 1 HAVING count(DISTINCT cif) BETWEEN 2 AND 25),
edges AS (SELECT a.cif AS src, b.cif AS dst, min(greatest(a.first_seen, b.first_seen)) AS first_seen, min(a.identifier) AS identifier FROM links a JOIN links b ON a.identifier = b.identifier AND a.cif < b.cif WHERE a.identifier IN (SELECT identifier FROM usable) GROUP BY 1, 2)"""
COMPS = f"""WITH RECURSIVE {EDGES}, und AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges), reach AS (SELECT src AS node, src AS other FROM und UNION SELECT r.node, u.dst FROM reach r JOIN und u ON u.src = r.other),
comps AS (SELECT node, min(other) AS comp FROM reach GROUP BY 1)"""


def ship_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", F.concat(F.col("l_partkey").cast("string"), F.lit("@"), F.to_date("l_shipdate").cast("string")).alias("identifier"))
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias("cif"), F.to_date("o_orderdate").alias("d"))
    return li.join(o, "l_orderkey").groupBy("cif", F.lit("SHIP").alias("link_type"), "identifier").agg(F.min("d").alias("first_seen"))


@query(f"WITH {EDGES} SELECT src AS src_cif, dst AS dst_cif, first_seen, identifier FROM edges")
def pair_edges(spark, sf_dir):
    return graph.pair_edges(ship_links(spark, sf_dir))[0].select("src_cif", "dst_cif", "first_seen", "identifier")


@query("SELECT 'NATION' AS link_type, CAST(c_nationkey AS VARCHAR) AS identifier, count(DISTINCT c_custkey) AS cifs FROM customer GROUP BY 1, 2 HAVING count(DISTINCT c_custkey) > 25")
def hub_suppression(spark, sf_dir):
    links = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cif"), F.lit("NATION").alias("link_type"), F.col("c_nationkey").cast("string").alias("identifier"))
    return graph.hubs_of(links)[0]


@query(f"{COMPS} SELECT node AS cif, comp AS ring_id, CAST(count(*) OVER (PARTITION BY comp) AS INTEGER) AS ring_size FROM comps")
def connected_components(spark, sf_dir):
    e = graph.pair_edges(ship_links(spark, sf_dir))[0].select(F.col("src_cif").alias("src"), F.col("dst_cif").alias("dst"))
    return graph.with_sizes(graph.connected_components(e, within=()), "ring", within=())


@query(f"""WITH {EDGES}, und AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges), seeds AS (SELECT CAST(c_custkey AS VARCHAR) AS cif FROM customer WHERE c_acctbal < 500), one AS (SELECT cif FROM seeds UNION SELECT dst FROM und JOIN seeds ON src = cif),
front AS (SELECT DISTINCT dst AS cif FROM und JOIN seeds ON src = cif), two AS (SELECT DISTINCT dst AS cif FROM und JOIN front ON src = cif WHERE dst NOT IN (SELECT cif FROM one)) SELECT cif, 1 AS hops_to_known_mule FROM one UNION ALL SELECT cif, 2 FROM two""")
def hops_to_seed(spark, sf_dir):
    e = graph.pair_edges(ship_links(spark, sf_dir))[0].select(F.col("src_cif").alias("src"), F.col("dst_cif").alias("dst"))
    seeds = read(spark, sf_dir, "customer").where("c_acctbal < 500").select(F.col("c_custkey").cast("string").alias("cif"))
    return graph.hops_to(e, seeds, within=())


@query(f"WITH {OCAL}, {EDGES} SELECT snapshot_date, count(*) AS edges FROM edges JOIN cal ON first_seen <= snapshot_date GROUP BY 1")
def dated_edges(spark, sf_dir):
    return graph.identity_graph(graph.pair_edges(ship_links(spark, sf_dir))[0], ORDERS).groupBy("snapshot_date").agg(F.count("*").alias("edges"))


@query(f"""WITH {CAL}, {ACT}, touched AS (SELECT DISTINCT account_id AS cif, counterparty_vpa || '@' || txn_date AS counterparty_vpa, txn_date FROM act WHERE counterparty_vpa IS NOT NULL), usable AS (SELECT counterparty_vpa FROM touched GROUP BY 1 HAVING count(DISTINCT cif) BETWEEN 2 AND 25),
t AS (SELECT DISTINCT snapshot_date, counterparty_vpa, cif FROM touched JOIN cal ON txn_date <= snapshot_date AND txn_date > snapshot_date - 90 WHERE counterparty_vpa IN (SELECT counterparty_vpa FROM usable))
SELECT a.snapshot_date, a.cif AS src, b.cif AS dst, count(*) AS weight FROM t a JOIN t b ON a.snapshot_date = b.snapshot_date AND a.counterparty_vpa = b.counterparty_vpa AND a.cif < b.cif GROUP BY 1, 2, 3 HAVING count(*) >= 2""")
def shared_counterparties(spark, sf_dir):
    t = activity(spark, sf_dir).select(F.col("account_id").alias("cif"), F.concat("counterparty_vpa", F.lit("@"), F.col("txn_date").cast("string")).alias("counterparty_vpa"), "txn_date", F.lit(None).cast("string").alias("counterparty_account_id"))
    return graph.counterparty_edges(t, EVENTS).drop("link_type")


@query(f"""WITH {OCAL}, p AS (SELECT DISTINCT least(o_custkey, s) AS src, greatest(o_custkey, s) AS dst, d FROM (SELECT o_custkey, l_suppkey AS s, CAST(o_orderdate AS DATE) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey) WHERE o_custkey <> s)
SELECT snapshot_date, src, dst, count(*) AS weight FROM p JOIN cal ON d <= snapshot_date AND d > snapshot_date - 90 GROUP BY 1, 2, 3""")
def transfer_edges(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("cif"), F.to_date("o_orderdate").alias("txn_date"))
    t = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("counterparty_account_id")).join(o, "l_orderkey")
    owner = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("account_id"), F.col("s_suppkey").alias("cif"))
    return graph.transfer_edges(t, owner, ORDERS).drop("link_type")


@query(f"""WITH {LINKS}, n AS (SELECT identifier, count(DISTINCT cif) AS n FROM links GROUP BY 1 HAVING count(DISTINCT cif) BETWEEN 2 AND 25) SELECT cif, CAST(max(n) AS INTEGER) AS cifs_sharing_mobile FROM links JOIN n ON n.identifier = links.identifier WHERE first_seen <= DATE '2001-08-01' AND
(SELECT count(DISTINCT l2.cif) FROM links l2 WHERE l2.identifier = links.identifier) >= 2 GROUP BY 1""")
def shared_identifiers(spark, sf_dir):
    links = ship_links(spark, sf_dir).withColumn("link_type", F.lit("MOBILE"))
    hubs = graph.hubs_of(links)[0]
    account = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("cif"), F.col("o_orderkey").alias("account_id"), F.to_date("o_orderdate").alias("open_date"))
    once = Calendar(as_of=ORDERS.as_of, first=ORDERS.as_of)
    return graph.shared_identifiers(links, hubs, account, once)[1].select("cif", "cifs_sharing_mobile")


@query("""WITH e AS (SELECT l_suppkey AS a, l_partkey AS b, CASE WHEN l_returnflag = 'R' THEN 'DEVICE' ELSE 'TRANSFER' END AS link_type FROM lineitem)
SELECT a AS src, b AS dst, CASE WHEN count(DISTINCT link_type) = 2 THEN 'both' WHEN min(link_type) = 'DEVICE' THEN 'identity' ELSE 'money' END AS kind FROM e WHERE a IN (3, 7) OR b IN (3, 7) GROUP BY 1, 2""")
def ego_graph(spark, sf_dir):
    e = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src_cif"), F.col("l_partkey").alias("dst_cif"), F.when(F.col("l_returnflag") == "R", "DEVICE").otherwise("TRANSFER").alias("link_type"))
    return graph.merged_kinds(graph.neighbourhood(e, [3, 7]), ["DEVICE"])


# ---------------------------------------------------------------- labels, versions, samples


@query(f"""WITH {OCAL}, f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS c FROM orders WHERE o_totalprice > 250000 GROUP BY 1)
SELECT c_custkey, snapshot_date, CASE WHEN snapshot_date + 90 <= DATE '2001-08-01' THEN CAST(coalesce(c > snapshot_date AND c <= snapshot_date + 90, false) AS INTEGER) END AS label FROM customer CROSS JOIN cal LEFT JOIN f ON o_custkey = c_custkey""")
def label_with_horizon(spark, sf_dir):
    first = read(spark, sf_dir, "orders").where("o_totalprice > 250000").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("c"))
    rows = read(spark, sf_dir, "customer").select("c_custkey").crossJoin(F.broadcast(ORDERS.frame(spark))).join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", "snapshot_date", features.label(F.col("snapshot_date"), F.col("c"), ORDERS.as_of).alias("label"))


@query("""WITH t AS (SELECT o_orderkey AS k, o_totalprice AS v, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS s FROM orders WHERE o_orderstatus <> 'P'), u AS (SELECT o_orderkey AS k, CASE WHEN o_totalprice > 300000 THEN o_totalprice + 1 ELSE o_totalprice END AS v,
CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_orderstatus END AS s FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT CASE WHEN t.k IS NULL THEN 'inserted' WHEN u.k IS NULL THEN 'deleted' WHEN t.v IS DISTINCT FROM u.v OR t.s IS DISTINCT FROM u.s THEN 'updated' ELSE 'kept' END AS action, coalesce(u.k, t.k) AS k, CASE WHEN u.k IS NULL THEN t.v ELSE u.v END AS v, CASE WHEN u.k IS NULL THEN t.s ELSE u.s END AS s FROM t FULL JOIN u ON t.k = u.k""")
def merge_upsert(spark, sf_dir):
    from ..sources.store import merged

    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    t = o.where("s <> 'P'").withColumn("s", F.when(F.col("p") != "1-URGENT", F.col("s")))
    u = o.where("p <> '5-LOW'").withColumns({"v": F.when(F.col("v") > 300000, F.col("v") + 1).otherwise(F.col("v")), "s": F.when(~F.col("p").isin("1-URGENT", "2-HIGH"), F.col("s"))})
    return merged(t.drop("p"), u.drop("p"), ["k"])


@query("SELECT 'now' AS version, count(*) AS rows_, count(o_orderstatus) AS labelled FROM orders UNION ALL SELECT 'first', count(*), count(CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END) FROM orders WHERE o_orderstatus = 'F'")
def version_travel(spark, sf_dir):
    from ..sources.store import Store

    store = Store(spark, scratch(spark, "store"))
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    store.write("orders", o.where("o_orderstatus = 'F'").withColumn("o_orderstatus", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus"))))
    store.merge("orders", o, ["o_orderkey"])

    def line(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.lit(name).alias("version"), F.count("*").alias("rows_"), F.count("o_orderstatus").alias("labelled"))

    return line(store.read("orders"), "now").unionByName(line(store.read("orders", 1), "first"))


BUCKET = "CAST(CAST('0x' || left(md5(CAST(o_orderkey AS VARCHAR) || '|' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)), 8) AS BIGINT) % 10000 AS INTEGER)"


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("account_id"), F.to_date("o_orderdate").alias("snapshot_date"), F.when(F.col("o_orderpriority") != "5-LOW", (F.col("o_totalprice") > 250000).cast("int")).alias("is_mule_90d"))


@query(f"SELECT o_orderkey AS account_id, {BUCKET} AS bucket FROM orders")
def sample_bucket(spark, sf_dir):
    f = order_features(spark, sf_dir)
    return f.select("account_id", s.bucket(F.col("account_id"), F.col("snapshot_date")).alias("bucket"))


FEATS = f"f AS (SELECT o_orderkey AS account_id, CAST(o_orderdate AS DATE) AS snapshot_date, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice > 250000 AS INTEGER) END AS y, {BUCKET} AS b FROM orders)"


@query(f"""WITH {FEATS}, p AS (SELECT * FROM f WHERE y = 1 AND snapshot_date BETWEEN DATE '1996-01-01' AND DATE '2000-01-01' ORDER BY snapshot_date DESC, account_id LIMIT 100), n AS (SELECT * FROM f WHERE y = 0 AND snapshot_date BETWEEN DATE '1996-01-01' AND DATE '2000-01-01' ORDER BY b, account_id, snapshot_date LIMIT (SELECT count(*) * 3 FROM p))
SELECT account_id, snapshot_date, y AS is_mule_90d FROM p UNION ALL SELECT account_id, snapshot_date, y FROM n""")
def context_selection(spark, sf_dir):
    return score.context(order_features(spark, sf_dir), date(1996, 1, 1), date(2000, 1, 1), 100, 3)


@query(f"WITH {FEATS} SELECT account_id, snapshot_date, y AS is_mule_90d, CAST(CASE WHEN y = 1 THEN 1.0 ELSE 20.0 END AS DOUBLE) AS weight FROM f WHERE y IS NOT NULL AND (y = 1 OR b < 500)")
def holdout_weights(spark, sf_dir):
    return score.holdout_sample(order_features(spark, sf_dir), date(1990, 1, 1), date(2030, 1, 1), 0.05)


# ---------------------------------------------------------------- scores, rules, evaluation

BOOK = """book AS (SELECT c_custkey, CAST(c_custkey % 4 AS INTEGER) AS hops_to_known_mule, CAST(c_custkey % 3 AS INTEGER) AS credits_from_complainants_30d, (c_custkey % 100) / 100.0 AS pass_through_ratio_7d, (c_custkey % 20) / 2.0 AS median_hold_hours_30d,
CAST(c_custkey % 9 AS INTEGER) AS ring_size, CAST(c_custkey % 5 AS INTEGER) AS accounts_on_same_device, CAST(c_custkey % 3 AS INTEGER) AS cifs_sharing_mobile, CAST(c_custkey % 2 AS INTEGER) AS new_device_logins_30d, 0 AS vpa_or_mobile_changes_30d, (c_custkey % 16) / 2.0 AS inflow_to_declared_income_30d,
CAST(c_custkey % 30 AS INTEGER) AS distinct_senders_7d, CAST(c_custkey % 2 AS INTEGER) AS dormant_reactivated_flag, CAST(c_custkey % 200 AS INTEGER) AS account_age_days, CAST(c_custkey % 7 = 0 AS INTEGER) AS min_kyc_flag, (c_custkey % 8) / 8.0 AS night_txn_share_30d FROM customer)"""
RULE_SQL = [
    ("NEAR_KNOWN_MULE", "hops_to_known_mule <= 2"), ("COMPLAINANT_CREDITS", "credits_from_complainants_30d >= 1"), ("PASS_THROUGH", "pass_through_ratio_7d >= 0.8"), ("FAST_HOLD", "median_hold_hours_30d <= 6"), ("RING", "ring_size >= 5"),
    ("SHARED_DEVICE", "accounts_on_same_device >= 3"), ("SHARED_MOBILE", "cifs_sharing_mobile >= 2"), ("DEVICE_OR_MOBILE_CHANGE", "new_device_logins_30d + vpa_or_mobile_changes_30d >= 1"), ("INFLOW_VS_INCOME", "inflow_to_declared_income_30d >= 5"),
    ("MANY_SENDERS", "distinct_senders_7d >= 15"), ("DORMANT_REACTIVATED", "dormant_reactivated_flag >= 1"), ("NEW_ACCOUNT", "account_age_days <= 60"), ("MIN_KYC", "min_kyc_flag >= 1"), ("NIGHT_ACTIVITY", "night_txn_share_30d >= 0.3"),
]
CODES = "list_slice(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in RULE_SQL) + "], lambda x: x IS NOT NULL), 1, 4)"


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    made = {
        "hops_to_known_mule": (k % 4).cast("int"), "credits_from_complainants_30d": (k % 3).cast("int"), "pass_through_ratio_7d": (k % 100) / 100.0, "median_hold_hours_30d": (k % 20) / 2.0, "ring_size": (k % 9).cast("int"), "accounts_on_same_device": (k % 5).cast("int"),
        "cifs_sharing_mobile": (k % 3).cast("int"), "new_device_logins_30d": (k % 2).cast("int"), "vpa_or_mobile_changes_30d": F.lit(0), "inflow_to_declared_income_30d": (k % 16) / 2.0, "distinct_senders_7d": (k % 30).cast("int"), "dormant_reactivated_flag": (k % 2).cast("int"),
        "account_age_days": (k % 200).cast("int"), "min_kyc_flag": (k % 7 == 0).cast("int"), "night_txn_share_30d": (k % 8) / 8.0,
    }
    return read(spark, sf_dir, "customer").select("c_custkey", *[c.alias(n) for n, c in made.items()])


@query(f"WITH {BOOK} SELECT c_custkey, round({' + '.join(f'CAST({c} AS INTEGER)' for _, c in RULE_SQL)} + (3 - least(3, greatest(0, hops_to_known_mule))) / 10.0 + pass_through_ratio_7d / 100, 6) AS rules_score FROM book")
def rules_score(spark, sf_dir):
    return book(spark, sf_dir).select("c_custkey", F.round(score.rules_score(), 6).alias("rules_score"))


@query(f"WITH {BOOK} SELECT c_custkey, array_to_string({CODES}, ',') AS reason_codes FROM book")
def reason_codes(spark, sf_dir):
    return score.with_reasons(book(spark, sf_dir)).select("c_custkey", "reason_codes")


#: The texts as SQL: what is not a whole number is shown with one digit, rounded as its nearest double.
TEXT_SQL = {
    "NEAR_KNOWN_MULE": "hops_to_known_mule || ' hop(s) from a reported / frozen mule'", "COMPLAINANT_CREDITS": "credits_from_complainants_30d || ' credit(s) from 1930 / NCRP complainants in 30d'",
    "PASS_THROUGH": "'forwards ' || CAST(round_even(100 * pass_through_ratio_7d, 0) AS INTEGER) || '% of credits within 24h'", "FAST_HOLD": "'median ' || printf('%.1f', CAST(median_hold_hours_30d AS DOUBLE)) || 'h from credit to next debit'",
    "RING": "'in a linked ring of ' || ring_size || ' customers'", "SHARED_DEVICE": "'device shared by ' || accounts_on_same_device || ' accounts'", "SHARED_MOBILE": "'mobile shared by ' || cifs_sharing_mobile || ' customers'",
    "DEVICE_OR_MOBILE_CHANGE": "(new_device_logins_30d + vpa_or_mobile_changes_30d) || ' new device / mobile / VPA change(s) in 30d'", "INFLOW_VS_INCOME": "'30d credits ' || printf('%.1f', CAST(inflow_to_declared_income_30d AS DOUBLE)) || 'x declared monthly income'",
    "MANY_SENDERS": "distinct_senders_7d || ' distinct senders in 7d'", "DORMANT_REACTIVATED": "'dormant account reactivated in last 90d'", "NEW_ACCOUNT": "'account ' || account_age_days || ' days old'", "MIN_KYC": "'minimum-KYC (OTP) account'",
    "NIGHT_ACTIVITY": "CAST(round_even(100 * night_txn_share_30d, 0) AS INTEGER) || '% of transactions 23:00-05:00'",
}
TEXTS = "list_slice(list_filter([" + ", ".join(f"CASE WHEN {c} THEN {TEXT_SQL[k]} END" for k, c in RULE_SQL) + "], lambda x: x IS NOT NULL), 1, 4)"


@query(f"WITH {BOOK} SELECT c_custkey, array_to_string({TEXTS}, '; ') AS reasons FROM book")
def reason_texts(spark, sf_dir):
    return score.with_reasons(book(spark, sf_dir)).select("c_custkey", "reasons")


@query(f"WITH {BOOK}, c AS (SELECT unnest({CODES}) AS code FROM book) SELECT code, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM book), 1) AS pct FROM c GROUP BY 1")
def reason_frequency(spark, sf_dir):
    return reports.code_frequency(score.with_reasons(book(spark, sf_dir)))


@query("SELECT c_custkey, round(p * r / (p * r + 1 - p), 8) AS p_adj FROM (SELECT c_custkey, (c_custkey % 1001) / 1000.0 AS p, (0.0007 / 0.9993) / (0.25 / 0.75) AS r FROM customer)")
def prior_correction(spark, sf_dir):
    p = (F.col("c_custkey") % 1001) / 1000.0
    return read(spark, sf_dir, "customer").select("c_custkey", F.round(s.prior_corrected(p, 0.25, 0.0007), 8).alias("p_adj"))


@query("""WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY (c_custkey * 7919 % 1000) / 1000.0 DESC, c_custkey) AS k, count(*) OVER () AS n FROM customer)
SELECT c_custkey, CAST(k AS INTEGER) AS risk_rank, round(k / n, 6) AS risk_pct, CASE WHEN round(k / n, 6) <= 0.002 THEN 'T1_FREEZE_REVIEW' WHEN round(k / n, 6) <= 0.01 THEN 'T2_HOLD_MONITOR' WHEN round(k / n, 6) <= 0.03 THEN 'T3_WATCHLIST' ELSE 'NONE' END AS tier FROM r""")
def rank_and_tiers(spark, sf_dir):
    p = (F.col("c_custkey") * 7919 % 1000) / 1000.0
    rows = read(spark, sf_dir, "customer").select("c_custkey", p.alias("p"), p.alias("p_adj"))
    return score.ranked_book(rows, info=["c_custkey"], key="c_custkey").select("c_custkey", "risk_rank", "risk_pct", "tier")


@query("SELECT c_custkey, CASE WHEN p >= 0.9 THEN 'T1_FREEZE_REVIEW' WHEN p >= 0.4 THEN 'T3_WATCHLIST' ELSE 'NONE' END AS tier FROM (SELECT c_custkey, (c_custkey * 7919 % 1000) / 1000.0 AS p FROM customer)")
def tiers_by_cutoff(spark, sf_dir):
    p = (F.col("c_custkey") * 7919 % 1000) / 1000.0
    return read(spark, sf_dir, "customer").select("c_custkey", score.tier_by_cutoffs(p, [0.9, None, 0.4], POLICY["tiers"]).alias("tier"))


TEST = "t AS (SELECT doc_id AS id, CAST(toxic AS DOUBLE) AS y, CASE WHEN toxic = 1 THEN 1.0 ELSE 5.0 END AS weight, ((doc_id * 7919) % 997 + toxic * 300) / 1300.0 AS p, ((doc_id * 104729) % 97 + toxic * 20) / 120.0 AS rules FROM labels)"


def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, y = F.col("doc_id"), F.col("toxic")
    return read(spark, sf_dir, "labels").select(i.alias("id"), y.cast("double").alias("y"), F.when(y == 1, 1.0).otherwise(5.0).alias("weight"), (((i * 7919) % 997 + y * 300) / 1300.0).alias("p"), (((i * 104729) % 97 + y * 20) / 120.0).alias("rules"))


TOPS = "o AS (SELECT *, sum(weight) OVER (ORDER BY p DESC, id ROWS UNBOUNDED PRECEDING) AS upto, row_number() OVER (ORDER BY p DESC, id) AS pos, sum(weight) OVER () AS w, sum(y * weight) OVER () AS pw FROM t)"


@query(f"WITH {TEST}, {TOPS} SELECT CAST(share AS DOUBLE) AS share, round(sum(y * weight) FILTER (WHERE upto <= share * w OR pos = 1) / max(pw), 6) AS capture, round(sum(y * weight) FILTER (WHERE upto <= share * w OR pos = 1) / sum(weight) FILTER (WHERE upto <= share * w OR pos = 1), 6) AS prec FROM o, (VALUES (0.002), (0.01), (0.05)) v(share) GROUP BY share")
def capture_and_precision(spark, sf_dir):
    found = evaluate.shares(holdout(spark, sf_dir), "p", [0.002, 0.01, 0.05])
    return spark.createDataFrame([(k, v["capture"], v["precision"]) for k, v in found.items()], "share double, capture double, prec double").select("share", F.round("capture", 6).alias("capture"), F.round("prec", 6).alias("prec"))


@query(f"""WITH {TEST}, g AS (SELECT p, sum(y * weight) AS a, sum((1 - y) * weight) AS b FROM t GROUP BY 1), c AS (SELECT *, sum(a) OVER (ORDER BY p DESC) AS ca, sum(b) OVER (ORDER BY p DESC) AS cb FROM g)
SELECT round(sum(b * (ca - a / 2)) / (sum(a) * sum(b)), 8) AS auc, round(sum(a * ca / (ca + cb)) / sum(a), 8) AS average_precision FROM c""")
def auc_and_average_precision(spark, sf_dir):
    t = holdout(spark, sf_dir)
    return spark.createDataFrame([(evaluate.roc_auc(t, "p"), evaluate.average_precision(t, "p"))], "auc double, average_precision double").select(F.round("auc", 8).alias("auc"), F.round("average_precision", 8).alias("average_precision"))


@query(f"""WITH {TEST}, {TOPS}, b AS (SELECT *, CASE {' '.join(f"WHEN upto / w <= {c} + 1e-12 THEN '{n}'" for n, c in BANDS[:-1])} ELSE 'rest' END AS band FROM o),
v AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {c})" for n, c in BANDS)}) x(band, upto_pct)), r AS (SELECT *, sum(weight) OVER (ORDER BY rules DESC, id ROWS UNBOUNDED PRECEDING) AS r_upto, row_number() OVER (ORDER BY rules DESC, id) AS r_pos FROM o)
SELECT v.band, CAST(upto_pct AS DOUBLE) AS upto_pct, round(CAST(coalesce(sum(weight), 0) AS DOUBLE), 1) AS accounts, round(CAST(coalesce(sum(y * weight), 0) AS DOUBLE), 1) AS mules, round(CASE WHEN sum(weight) > 0 THEN round(coalesce(sum(y * weight), 0), 1) / round(sum(weight), 1) END, 5) AS mule_rate,
round(sum(p * weight) / sum(weight), 5) AS mean_p_mule, round(any_value(cc), 4) AS cum_capture, round(any_value(rc), 4) AS rules_cum_capture FROM v LEFT JOIN b ON b.band = v.band JOIN (SELECT v.band AS cband, CASE WHEN max(upto_pct) >= 1 THEN 1.0 ELSE sum(y * weight) FILTER (WHERE upto <= upto_pct * w OR pos = 1) / max(pw) END AS cc,
CASE WHEN max(upto_pct) >= 1 THEN 1.0 ELSE sum(y * weight) FILTER (WHERE r_upto <= upto_pct * w OR r_pos = 1) / max(pw) END AS rc FROM v CROSS JOIN r GROUP BY 1) c ON cband = v.band GROUP BY 1, 2""")
def risk_bands(spark, sf_dir):
    return evaluate.bands(holdout(spark, sf_dir))


SCORED = f"""{BOOK}, sc AS (SELECT CAST(c_custkey % 50 AS VARCHAR) AS ring_id, CAST(2 + c_custkey % 50 % 5 AS INTEGER) AS ring_size, CASE WHEN c_custkey % 97 = 0 THEN 'T1_FREEZE_REVIEW' WHEN c_custkey % 31 = 0 THEN 'T3_WATCHLIST' ELSE 'NONE' END AS tier, (c_custkey % 1000) / 1000.0 AS p, hops_to_known_mule,
CASE WHEN c_custkey % 97 = 0 OR c_custkey % 31 = 0 THEN {CODES} ELSE [] END AS codes FROM book)"""


@query(f"""WITH {SCORED}, r AS (SELECT ring_id, max(ring_size) AS ring_size, CAST(count(*) AS INTEGER) AS accounts_scored, CAST(count(*) FILTER (WHERE tier <> 'NONE') AS INTEGER) AS accounts_alerted, min(CASE WHEN tier <> 'NONE' THEN tier END) AS top_tier, max(p) AS max_p_mule_adj, round(sum(p), 5) AS sum_p_mule_adj, min(hops_to_known_mule) AS min_hops_to_known_mule FROM sc GROUP BY 1),
k AS (SELECT ring_id, code, count(*) AS n FROM (SELECT ring_id, unnest(codes) AS code FROM sc) GROUP BY 1, 2), q AS (SELECT *, row_number() OVER (PARTITION BY ring_id ORDER BY n DESC, code) AS i FROM k), w AS (SELECT ring_id, string_agg(code, ',' ORDER BY i) AS c FROM q WHERE i <= 3 GROUP BY 1)
SELECT r.*, coalesce(c, '') AS top_reason_codes FROM r LEFT JOIN w ON w.ring_id = r.ring_id WHERE accounts_alerted > 0""")
def ring_rollup(spark, sf_dir):
    k = F.col("c_custkey")
    rows = score.with_reasons(book(spark, sf_dir)).withColumns({
        "ring_id": (k % 50).cast("string"), "ring_size": (2 + k % 50 % 5).cast("int"), "tier": F.when(k % 97 == 0, "T1_FREEZE_REVIEW").when(k % 31 == 0, "T3_WATCHLIST").otherwise("NONE"), "p_mule_adj": (k % 1000) / 1000.0,
    })
    book_codes = score.with_reasons(book(spark, sf_dir)).select("c_custkey", F.col("reason_codes").alias("rc"))
    rows = rows.drop("reason_codes").join(book_codes, "c_custkey").withColumn("reason_codes", F.when(F.col("tier") != "NONE", F.col("rc")).otherwise(""))
    return score.ring_rollup(rows)


# ---------------------------------------------------------------- quality


def findings(spark: SparkSession, found: list) -> DataFrame:
    return spark.createDataFrame([(f.check, f.success, f.elements, f.unexpected, f.observed) for f in found], "check_name string, success boolean, elements long, unexpected long, observed string")


@query("""WITH s AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_custkey IS NULL) AS a, count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F')) AS b, count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) AS c, count(*) FILTER (WHERE CAST(o_orderdate AS DATE) > DATE '2000-01-01') AS d, count(*) - count(DISTINCT o_orderkey) AS e FROM orders)
SELECT 'o_custkey not null' AS check_name, a = 0 AS success, n AS elements, a AS unexpected, CAST(a AS VARCHAR) AS observed FROM s UNION ALL SELECT 'status known', b = 0, n, b, CAST(b AS VARCHAR) FROM s UNION ALL SELECT 'o_totalprice within 1000 to 400000', c = 0, n, c, CAST(c AS VARCHAR) FROM s
UNION ALL SELECT 'o_orderdate not after the as-of date', d = 0, n, d, CAST(d AS VARCHAR) FROM s UNION ALL SELECT 'o_orderkey unique', e = 0, n, e, CAST(e AS VARCHAR) FROM s""")
def quality_profile(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    rules = [quality.not_null("o_custkey"), quality.in_set("o_orderstatus", ["O", "F"], check="status known"), quality.in_range("o_totalprice", 1000, 400000), quality.not_after("o_orderdate", date(2000, 1, 1))]
    found, _ = quality.check("orders", o, rules)
    return findings(spark, [*found, quality.repeated("orders", ["o_orderkey"], quality.key_counts([quality.Keys("key", o, ["o_orderkey"])])["key"])])


@query("""WITH s AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > -990)) AS b FROM orders)
SELECT 'unknown customers at most 0.10%' AS check_name, b / n <= 0.001 AS success, n AS elements, b AS unexpected, printf('%.6f', b / n) AS observed FROM s UNION ALL SELECT 'unknown customers at most 0.05% (warning: half the limit)', b / n <= 0.0005, n, b, printf('%.6f', b / n) FROM s
UNION ALL SELECT 'orders = distinct orders of lines', (SELECT count(DISTINCT l_orderkey) FROM lineitem) = n, n, abs((SELECT count(DISTINCT l_orderkey) FROM lineitem) - n), CAST((SELECT count(DISTINCT l_orderkey) FROM lineitem) AS VARCHAR) FROM s
UNION ALL SELECT 'rows against the previous load within -5% / +10%', n / 14000.0 BETWEEN 0.95 AND 1.10, n, NULL, printf('%.4f', n / 14000.0) FROM s""")
def quality_rates(spark, sf_dir):
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer").where("c_acctbal > -990").select(F.col("c_custkey").alias("o_custkey"))
    got = quality.key_counts([quality.Keys("customer", o, ["o_custkey"], c), quality.Keys("lines", read(spark, sf_dir, "lineitem"), ["l_orderkey"])])
    n = got["customer"].rows
    return findings(spark, [*quality.rate_with_warning("orders", "unknown customers", n, got["customer"].orphans), quality.equal("orders", "orders = distinct orders of lines", n, got["lines"].distinct), *quality.volume("orders", n, 14000.0)])


@query(r"SELECT doc_id, coalesce(regexp_matches(upper(text), '(^|[^A-Z0-9])[A-Z]{5}[0-9]{4}[A-Z]([^A-Z0-9]|$)'), false) OR coalesce(regexp_matches(upper(source), '(^|[^A-Z0-9])[A-Z]{5}[0-9]{4}[A-Z]([^A-Z0-9]|$)'), false) OR coalesce(regexp_matches(upper(lang), '(^|[^A-Z0-9])[A-Z]{5}[0-9]{4}[A-Z]([^A-Z0-9]|$)'), false) AS hit FROM documents")
def pan_scan(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", quality.no_pan(d, "no PAN").bad.alias("hit"))


# ---------------------------------------------------------------- reports


@query("""SELECT n_name, b.n AS active_accounts, coalesce(a.n, 0) AS alerts, coalesce(a.t, 0) AS t1_freeze, round(1000.0 * coalesce(a.n, 0) / b.n, 1) AS alerts_per_1000 FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) b JOIN nation ON n_nationkey = b.k
LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n, count(*) FILTER (WHERE c_acctbal > 9500) AS t FROM customer WHERE c_acctbal > 8000 GROUP BY 1) a ON a.k = b.k ORDER BY alerts_per_1000 DESC, n_name LIMIT 15""")
def report_hotspots(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return reports.hotspots(c, c.where("c_acctbal > 8000"), read(spark, sf_dir, "nation"), "n_nationkey", F.col("c_acctbal") > 9500, 15, ["n_name"])


@query("""SELECT CASE WHEN r >= 0.9 THEN 'a. >= 90%' WHEN r >= 0.7 THEN 'b. 70-90%' WHEN r >= 0.4 THEN 'c. 40-70%' WHEN r > 0 THEN 'd. 0-40%' ELSE 'e. none' END AS pass_through_band, count(*) AS labelled_rows, CAST(sum(y) AS BIGINT) AS mules, round(100 * avg(CAST(y AS DOUBLE)), 3) AS mule_rate_pct
FROM (SELECT l_discount * 10 AS r, CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'N' THEN 0 END AS y FROM lineitem) WHERE y IS NOT NULL GROUP BY 1""")
def report_bands(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select((F.col("l_discount") * 10).alias("r"), F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "N", 0).alias("is_mule_90d"))
    return reports.rate_by(li, reports.banded(F.col("r"), [(0.9, "a. >= 90%"), (0.7, "b. 70-90%"), (0.4, "c. 40-70%")], "d. 0-40%", "e. none"), "pass_through_band")


@query("SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS category, count(*) AS complaints, count(DISTINCT o_custkey) AS accounts_reported, round(sum(o_totalprice) / 1e5, 1) AS amount_inr_lakh FROM orders WHERE o_orderdate >= DATE '2000-08-01' GROUP BY 1, 2 ORDER BY 1 DESC, 3 DESC, 2 LIMIT 40")
def report_monthly(spark, sf_dir):
    r = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("report_date"), F.col("o_orderpriority").alias("category"), F.col("o_custkey").alias("account_id"), F.col("o_totalprice").alias("amount"))
    return reports.monthly_reports({"report": r}, F.lit(date(2000, 8, 1)))


@query("""SELECT c_mktsegment AS product_name, count(*) AS reported_accounts, CAST(quantile_disc(d, 0.5) AS INTEGER) AS median_days_open_to_report, count(CASE WHEN c_acctbal > 0 THEN 1 END) AS were_dormant_reactivated, count(CASE WHEN c_acctbal < 0 THEN 1 END) AS frozen
FROM (SELECT o_custkey, date_diff('day', DATE '1995-01-01', min(CAST(o_orderdate AS DATE))) AS d FROM orders GROUP BY 1) JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def report_first_event(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    account = c.select(F.col("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("product_code"), F.lit(date(1995, 1, 1)).alias("open_date"), F.when(F.col("c_acctbal") > 0, 1).alias("reactivated_on"), F.when(F.col("c_acctbal") < 0, 1).alias("freeze_date"))
    products = c.select(F.col("c_mktsegment").alias("product_code"), F.col("c_mktsegment").alias("product_name")).distinct()
    report = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("account_id"), F.to_date("o_orderdate").alias("report_date"))
    return reports.days_to_report({"report": report, "account": account, "product_map": products})


@query("SELECT o_orderpriority AS reason, count(*) AS n, round(sum(o_totalprice) / 1e6, 2) AS worth, count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS open_customers FROM orders WHERE o_totalprice > 1000 GROUP BY 1 ORDER BY n DESC, reason LIMIT 3")
def visual_builder(spark, sf_dir):
    v = reports.Visual("orders", "orders", {"n": "count(*)", "worth": "round(sum(o_totalprice) / 1e6, 2)", "open_customers": "count(distinct case when o_orderstatus = 'O' then o_custkey end)"}, {"reason": "o_orderpriority"}, ("o_totalprice > 1000",), ("-n", "reason"), 3)
    return v.frame(read(spark, sf_dir, "orders"))


@query("SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS ring_rank, CASE WHEN o_custkey = (SELECT max(o_custkey) FROM orders) THEN 1 ELSE 0 END AS is_latest FROM orders")
def view_ranked(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    t = o.select(F.col("o_custkey").alias("run_date"), F.col("o_orderkey").alias("ring_id"), F.col("o_totalprice").alias("sum_p_mule_adj"), *[F.lit(1).alias(c) for c in ("ring_size", "accounts_scored", "accounts_alerted", "top_tier", "max_p_mule_adj", "min_hops_to_known_mule", "top_reason_codes")])
    return reports.v_rings({"mule_rings": t}).select(F.col("run_date").alias("o_custkey"), F.col("ring_id").alias("o_orderkey"), "ring_rank", "is_latest")

"""The suites of the first two layers over tables made from the given ones, with SQL for each of their checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as q
from .registry import query, read

AS_OF = date(2001, 8, 1)
BATCH = "CASE WHEN {0} % 700 = 3 THEN DATE '2001-07-31' ELSE DATE '2001-08-01' END"
#: Of each table the source, its rows, and its columns, as SQL that both engines take.
TABLES = {
    "kyc_onboarding": ("customer", None, {
        "cif": "'C' || CAST(c_custkey AS STRING)", "onboarding_date": "DATE '1999-01-01' + CAST(c_custkey % 950 AS INT)", "batch_as_of": BATCH.format("c_custkey"), "customer_name": "c_name",
        "pan": "CASE WHEN c_acctbal > -990 THEN 'ABCDE' || CAST(1000 + c_custkey % 9000 AS STRING) || 'F' ELSE 'none' END", "note": "CASE WHEN c_acctbal > 9990 THEN 'pan abcde1234f here' ELSE c_mktsegment END",
    }),
    "cbs_accounts": ("orders", None, {
        "account_id": "'A' || CAST(o_orderkey AS STRING)", "cif": "CASE WHEN o_totalprice < 450000 THEN 'C' || CAST(o_custkey AS STRING) END", "product_code": "o_orderpriority", "branch_code": "o_orderstatus",
        "open_date": "CAST(o_orderdate AS DATE)", "batch_as_of": BATCH.format("o_orderkey"),
    }),
    "upi_transactions": ("lineitem", None, {
        "txn_id": "CASE WHEN l_discount < 0.1 OR l_tax < 0.08 THEN 'T' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) ELSE 'T' || CAST(l_orderkey AS STRING) END", "txn_ts": "l_shipdate", "account_id": "'A' || CAST(l_orderkey + CASE WHEN l_quantity > 49 THEN 1000000000 ELSE 0 END AS STRING)",
        "amount": "l_extendedprice - 910", "direction": "CASE l_returnflag WHEN 'R' THEN 'CR' WHEN 'A' THEN 'DR' ELSE l_linestatus END", "batch_as_of": BATCH.format("l_orderkey"),
    }),
    "digital_sessions": ("events", None, {"session_id": "'S' || CAST(event_id AS STRING)", "session_ts": "ts", "cif": "'C' || CAST(user_id AS STRING)", "batch_as_of": "DATE '2001-08-01'", "device": "event_type"}),
    "fraud_reports": ("part", None, {"report_id": "CASE WHEN p_size > 1 THEN 'R' || CAST(p_partkey % 1900 AS STRING) END", "report_ts": "DATE '2001-07-01' + CAST(p_size AS INT)", "batch_as_of": "DATE '2001-08-01'", "category": "p_brand"}),
    "product_map": ("orders", "o_orderpriority <> '5-LOW'", {"product_code": "o_orderpriority"}),
    "branch_map": ("orders", "o_orderstatus <> 'P'", {"branch_code": "o_orderstatus"}),
    # the second layer
    "customer": ("customer", "c_custkey > 5", {
        "cif": "'C' || CAST(c_custkey AS STRING)", "pan_hash": "CASE WHEN c_custkey % 400 > 0 THEN sha2(CAST(c_custkey AS STRING), 256) ELSE 'plain' END", "aadhaar_hash": "sha2(c_name, 256)", "mobile_hash": "CASE WHEN c_acctbal > 0 THEN sha2(c_name, 256) END", "customer_name": "c_name",
    }),
    "account": ("orders", None, {"account_id": "'A' || CAST(o_orderkey AS STRING)", "cif": "'C' || CAST(o_custkey AS STRING)"}),
    "account_vpa": ("orders", None, {"vpa": "CASE WHEN o_totalprice > 1000 THEN 'v' || CAST(o_custkey AS STRING) END", "account_id": "'A' || CAST(o_orderkey AS STRING)"}),
    "txn": ("lineitem", "l_extendedprice > 910", {"txn_id": "'T' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)", "amount": "l_extendedprice - 920", "direction": "CASE l_returnflag WHEN 'R' THEN 'CR' ELSE 'DR' END"}),
    "session": ("events", None, {"session_id": "'S' || CAST(event_id AS STRING)"}),
    "report": ("part", "p_size > 20", {"report_id": "'R' || CAST(p_partkey % 1950 AS STRING)", "account_id": "'A' || CAST(p_partkey AS STRING)"}),
    "identity_links": ("lineitem", None, {"cif": "'C' || CAST(l_suppkey AS STRING)", "link_type": "l_returnflag", "identifier": "'i' || CAST(l_partkey AS STRING)"}),
    "identity_edges": ("lineitem", None, {"src_cif": "'C' || CAST(l_suppkey AS STRING)", "dst_cif": "'C' || CAST(l_partkey AS STRING)", "link_type": "l_returnflag", "identifier": "'i' || CAST(l_orderkey AS STRING)"}),
    "identity_clusters": ("orders", None, {"snapshot_date": "CAST(o_orderdate AS DATE)", "cif": "'C' || CAST(o_custkey AS STRING)", "hops_to_known_mule": "CASE WHEN o_custkey % 300 > 0 THEN CAST(1 + o_orderkey % 3 AS INT) ELSE 4 END"}),
    "graph_edges": ("lineitem", None, {"snapshot_date": "CAST(l_shipdate AS DATE)", "src_cif": "'C' || CAST(l_suppkey AS STRING)", "dst_cif": "'C' || CAST(l_partkey AS STRING)", "link_type": "l_returnflag"}),
}
FIRST = [*q.EXTRACTS, "product_map", "branch_map"]


def tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    out = {}
    for name in names:
        source, rows, columns = TABLES[name]
        df = read(spark, sf_dir, source)
        out[name] = (df.where(rows) if rows else df).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
    return out


def made(names) -> str:
    out = []
    for name in names:
        source, rows, columns = TABLES[name]
        out.append(f"{name}_ AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source}{f' WHERE {rows}' if rows else ''})")
    return ", ".join(out).replace("sha2(", "sha256(").replace(", 256)", ")")


def shown(spark: SparkSession, found: list[q.Finding]) -> DataFrame:
    rows = [(f.table, f.check, f.severity, f.success, f.elements, f.unexpected, f.observed) for f in found]
    return spark.createDataFrame(rows, "table_name string, check_name string, severity string, success boolean, elements long, unexpected long, observed string")


def line(table: str, name: str, success: str, n: str, bad: str, observed: str, severity: str = "critical") -> str:
    quoted = name.replace("'", "''")
    return f"SELECT '{table}' AS table_name, '{quoted}' AS check_name, '{severity}' AS severity, {success} AS success, CAST({n} AS BIGINT) AS elements, CAST({bad} AS BIGINT) AS unexpected, CAST({observed} AS VARCHAR) AS observed FROM {table}_"


def none(table: str, name: str, condition: str) -> str:
    bad = f"count(*) FILTER (WHERE {condition})"
    return line(table, name, f"{bad} = 0", "count(*)", bad, bad)


def some(table: str) -> str:
    return line(table, "row count", "count(*) >= 1", "count(*)", "NULL", "count(*)")


def distinct(table: str, columns: list[str], name: str | None = None) -> str:
    bad = f"count(*) - count(DISTINCT ({', '.join(columns)}))" if len(columns) > 1 else f"count(*) - count(DISTINCT {columns[0]}) - CAST(count(*) > count({columns[0]}) AS INT)"
    return line(table, name or f"{', '.join(columns)} unique", f"{bad} = 0", "count(*)", bad, bad)


def at_most(table: str, name: str, n: str, bad: str, limit: float, severity: str) -> str:
    return line(table, name, f"coalesce(({bad}) / ({n}), 0) <= {limit}", n, bad, f"printf('%.6f', ({bad}) / ({n}))", severity)


def both(table: str, what: str, bad: str) -> list[str]:
    return [at_most(table, f"{what} at most 0.10%", "count(*)", bad, 0.001, "critical"), at_most(table, f"{what} at most 0.05% (warning: half the limit)", "count(*)", bad, 0.0005, "warning")]


def same(table: str, name: str, expected: str, actual: str) -> str:
    return line(table, name, f"{expected} = {actual}", expected, f"abs({actual} - {expected})", actual)


def bronze_sql() -> str:
    pan = r"regexp_matches(upper(coalesce({}, '')), '(^|[^A-Z0-9])[A-Z]{{5}}[0-9]{{4}}[A-Z]([^A-Z0-9]|$)')"
    out = []
    for name, (key, day) in q.EXTRACTS.items():
        texts = [c for c, e in TABLES[name][2].items() if c not in ("pan", "batch_as_of", day, "amount")]
        out += [some(name), none(name, f"{key} not null", f"{key} IS NULL"), none(name, f"{day} not after the as-of date", f"CAST({day} AS DATE) > DATE '2001-08-01'"), none(name, "batch is for the as-of date", "batch_as_of <> DATE '2001-08-01'"),
                none(name, "no raw PAN outside kyc_onboarding.pan", " OR ".join(pan.format(c) for c in texts)), at_most(name, f"re-sent duplicate {key} at most 1% (removed in silver)", "count(*)", f"count({key}) - count(DISTINCT {key})", 0.01, "warning")]
    out.append(line("cbs_accounts", "rows against the previous load within -5% / +10%", "count(*) / 14900 BETWEEN 0.95 AND 1.1", "count(*)", "NULL", "printf('%.4f', count(*) / 14900)", "warning"))
    out.append(distinct("cbs_accounts", ["account_id"]))
    for c, ref in (("product_code", "product_map"), ("branch_code", "branch_map")):
        out.append(none("cbs_accounts", f"{c} known in ref.{ref}", f"{c} IS NULL OR {c} NOT IN (SELECT {c} FROM {ref}_)"))
    for name, key, parent in (("cbs_accounts", "cif", "kyc_onboarding"), ("upi_transactions", "account_id", "cbs_accounts"), ("digital_sessions", "cif", "kyc_onboarding")):
        out += both(name, f"rows for an unknown {key}", f"count(*) FILTER (WHERE {key} IS NULL OR {key} NOT IN (SELECT {key} FROM {parent}_ WHERE {key} IS NOT NULL))")
    out += both("upi_transactions", "non-positive amount", "count(*) FILTER (WHERE amount <= 0)") + both("upi_transactions", "direction not CR / DR", "count(*) FILTER (WHERE direction NOT IN ('CR', 'DR'))")
    days, span = "count(DISTINCT CAST(txn_ts AS DATE))", "(date_diff('day', min(CAST(txn_ts AS DATE)), DATE '2001-08-01') + 1)"
    out.append(same("upi_transactions", "a transaction on every day", span, days))
    out += both("kyc_onboarding", "malformed or missing PAN", "count(*) FILTER (WHERE NOT regexp_full_match(coalesce(pan, ''), '[A-Z]{5}[0-9]{4}[A-Z]'))")
    return f"WITH {made(FIRST)} " + " UNION ALL ".join(out)


@query(bronze_sql())
def suite_bronze(spark, sf_dir):
    found = q.bronze_suite(tables(spark, sf_dir, FIRST), AS_OF, {("cbs_accounts", "row count"): 14900.0})
    out = shown(spark, found)
    return out.withColumn("check_name", F.regexp_replace("check_name", "^a transaction on every day.*", "a transaction on every day"))


def silver_sql() -> str:
    out = []
    more = {
        "customer": [(f"{c} is a SHA-256 hex digest", f"{c} IS NULL OR NOT regexp_full_match({c}, '[0-9a-f]{{64}}')") for c in ("pan_hash", "aadhaar_hash", "mobile_hash")] + [("no raw PAN in any customer column", "false")],
        "txn": [("amount positive", "amount <= 0"), ("direction in ['CR', 'DR']", "direction NOT IN ('CR', 'DR')")],
        "identity_clusters": [("hops_to_known_mule within 1 to 3", "hops_to_known_mule IS NULL OR hops_to_known_mule NOT BETWEEN 1 AND 3")],
    }
    for name, keys in q.SILVER_KEYS.items():
        out += [some(name), distinct(name, keys), *[none(name, f"{k} not null", f"{k} IS NULL") for k in keys], *[none(name, *m) for m in more.get(name, [])]]
    out.append(line("txn", "rows against the previous load within -5% / +10%", "count(*) / 30000 BETWEEN 0.95 AND 1.1", "count(*)", "NULL", "printf('%.4f', count(*) / 30000)", "warning"))
    out.append(same("customer", "rows = distinct bronze cif (deduplicated)", "(SELECT count(DISTINCT cif) FROM kyc_onboarding_)", "count(*)"))
    out.append(same("account", "rows = distinct bronze account_id (deduplicated)", "(SELECT count(DISTINCT account_id) FROM cbs_accounts_)", "count(*)"))
    out.append(same("txn", "rows = distinct positive bronze txn_id of known accounts", "(SELECT count(DISTINCT txn_id) FROM upi_transactions_ WHERE amount > 0 AND account_id IN (SELECT account_id FROM cbs_accounts_))", "count(*)"))
    out.append(same("report", "report_ids not in bronze fraud_reports", "0", "count(DISTINCT report_id) FILTER (WHERE report_id NOT IN (SELECT report_id FROM fraud_reports_ WHERE report_id IS NOT NULL))"))
    sent = "(SELECT count(DISTINCT report_id) + CAST(count(*) > count(report_id) AS INT) FROM fraud_reports_)"
    out.append(at_most("report", "complaints not resolved to an account at most 1%", sent, f"{sent} - count(DISTINCT report_id)", 0.01, "warning"))
    latest = "CAST(max(snapshot_date) <> DATE '2001-08-01' AS INT)"
    out.append(line("identity_clusters", "latest snapshot is the as-of date", f"{latest} = 0", "1", latest, "max(snapshot_date)"))
    return f"WITH {made([*FIRST, *q.SILVER_KEYS])} " + " UNION ALL ".join(out)


@query(silver_sql())
def suite_silver(spark, sf_dir):
    t = tables(spark, sf_dir, q.SILVER_KEYS) | {f"bronze.{k}": v for k, v in tables(spark, sf_dir, FIRST).items()}
    return shown(spark, q.silver_suite(t, AS_OF, {("txn", "row count"): 30000.0}))

"""The whole chain on a small simulated world: extracts, gates, graph, features, daily run, endpoint, reports."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from veritrail.contract import FEATURE_COLUMNS, POLICY
from veritrail.operators import quality
from veritrail.operators.timeline import Calendar
from veritrail.plans import daily, layers, reports
from veritrail.sources import simulate
from veritrail.sources.store import Store

AS_OF = date(2025, 10, 17)
SMALL = POLICY | {"holdout": {"test_weeks": 2, "gap_days": 30, "negative_sample": 0.5}, "context": POLICY["context"] | {"max_mules": 200}}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    bronze = simulate.bronze(spark, 40, AS_OF, days=200, mule_share=0.25, seed=3)
    bronze = {k: v.cache() for k, v in bronze.items()}
    read, plain = [], quality.check

    def watched(table, df, rules, extra=None, seen=None):
        read.extend([table] * (seen is None))
        return plain(table, df, rules, extra, seen)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(quality, "check", watched)
        findings = layers.nightly(spark, bronze, store, calendar=Calendar(AS_OF))
    # one pass over each extract and over the gold table; the silver tables are counted while they are written
    assert read == [*quality.EXTRACTS, "mule_features"]
    return store, bronze, findings


def test_gates_hold(built):
    _, _, findings = built
    assert {"bronze", "silver", "gold"} == set(findings)
    assert not [f for fs in findings.values() for f in fs if not f.success and f.severity == "critical"]
    assert len(findings["bronze"]) == 46 and len(findings["silver"]) == 54 and len(findings["gold"]) == 47


def test_features(built):
    store, bronze, _ = built
    f = store.read("mule_features").select(*FEATURE_COLUMNS)
    assert f.count() == f.select("account_id", "snapshot_date").distinct().count() > 500
    assert f.where("pass_through_ratio_7d > 0.8").count() > 0 and f.where("hops_to_known_mule < 3").count() > 0
    assert f.where("is_mule_90d = 1").count() > 10 and f.where("ring_size > 2").count() > 0
    assert f.where(F.col("is_mule_90d").isNotNull() & (F.date_add("snapshot_date", 90) > F.lit(AS_OF))).count() == 0


def test_second_load_changes_nothing(built):
    store, _, _ = built
    before = store.version("mule_features")
    again = store.merge("mule_features", store.read("mule_features", before).drop("snapshot_date_month"), ["account_id", "snapshot_date"], by_month="snapshot_date")
    last = store.history("mule_features").where(f"version = {again}").first()
    assert (last["added"], last["updated"], last["deleted"]) == (0, 0, 0)


def test_daily_run_and_endpoint(built, spark):
    store, bronze, _ = built
    out = daily.run(store, policy=SMALL, publish_on_fail=True)
    assert out.run["scored_accounts"] > 50 and out.published and out.alerts.count() == sum(out.run[f"alerts_t{i}"] for i in (1, 2, 3)) > 0
    assert 0.5 < out.run["holdout_auc"] <= 1
    endpoint = daily.Endpoint(store, policy=SMALL)
    row = store.read("mule_features").limit(1).collect()[0].asDict()
    from veritrail.contract import FEATURES

    reply = endpoint({"accounts": [{"account_id": "x"} | {k: float(row[k]) for k in FEATURES}], "what_if": {"hops_to_known_mule": 1}})
    assert reply["scores"][0]["account_id"] == "x" and "NEAR_KNOWN_MULE" in reply["scores"][0]["reason_codes_what_if"]
    with pytest.raises(ValueError, match="missing"):
        endpoint({"accounts": [{"account_id": "x"}]})

    tables = {n: store.read(n) for n in ("mule_alerts", "mule_rings", "mule_holdout", "mule_model_run", "mule_features", "txn", "report", "account", "dq_results")}
    tables |= {n: bronze[n] for n in ("branch_map", "product_map")}
    for name, make in reports.REPORTS.items():
        if name != "decision_log":
            rows, again = make(tables), make({k: v.repartition(3) for k, v in tables.items()})
            assert rows.columns and sorted(map(str, rows.collect())) == sorted(map(str, again.collect())), name
    assert reports.v_dq(tables).where("is_latest = 1").count() > 100
    published = store.read("dq_results").where("layer = 'publish'").collect()
    assert len(published) == 8 and all(r["success"] for r in published)
    reports.register(tables)
    for v in reports.kpis():
        built_rows, sql_rows = v.frame(spark.table(v.view)).collect(), spark.sql(v.sql()).collect()
        assert built_rows == sql_rows, v.title


def test_failed_gate_withholds(built):
    store, _, _ = built
    strict = SMALL | {"gate": {"min_capture_top1pct": 1.1}}
    before = store.version("mule_alerts")
    out = daily.run(store, policy=strict)
    assert not out.published and store.version("mule_alerts") == before and out.gate[0].startswith("FAIL")


def test_backfill_and_families(built):
    store, _, _ = built
    dates = [date(2025, 10, 3), date(2025, 10, 10)]
    out = daily.backfill(store, reversed(dates), policy=SMALL, with_holdout=False)
    assert [o.run["run_date"] for o in out] == dates and all(o.run["triggered_by"] == "backfill" and o.published for o in out)
    runs = {r["run_date"]: r["scored_accounts"] for r in store.read("mule_model_run").collect()}
    assert all(runs[d] == o.run["scored_accounts"] == store.read("mule_features", where=F.col("snapshot_date") == F.lit(d)).count() for d, o in zip(dates, out, strict=True))
    assert {r["run_date"] for r in store.read("mule_alerts").select("run_date").distinct().collect()} >= set(dates)
    attended = daily.run(store, family="kernel", policy=SMALL, with_holdout=False, write=False)
    assert (attended.run["model_family"], attended.run["device"]) == ("kernel", "cpu") and attended.run["context_mules"] <= SMALL["context"]["max_mules"] // 4
    assert daily.run(store, family="auto", policy=SMALL, with_holdout=False, write=False).run["model_family"] == "stub"
    with pytest.raises(ValueError, match="no scorer"):
        daily.run(store, family="nope", policy=SMALL)
    with pytest.raises(ValueError, match="no rows"):
        daily.run(store, run_date=date(2025, 10, 4), policy=SMALL, with_holdout=False)


def test_bad_extract_stops(built, spark):
    from veritrail.operators import quality as q

    _, bronze, _ = built
    spoiled = dict(bronze, upi_transactions=simulate.spoiled(bronze["upi_transactions"]))
    with pytest.raises(q.GateFailed, match="direction"):
        q.enforce(q.bronze_suite(spoiled, AS_OF, {}))

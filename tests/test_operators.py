"""Operators on small cases: window edges, ties, nulls, hubs, components, hops, labels, merges, ranks, rules, requests."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from veritrail.contract import POLICY
from veritrail.functions import scalars as s
from veritrail.operators import behaviour, evaluate, features, graph, quality, relational, score
from veritrail.operators.timeline import Calendar, expand_since, expand_within
from veritrail.plans import daily
from veritrail.sources.store import Store, merged, script

CAL = Calendar(as_of=date(2025, 6, 1), first=date(2025, 5, 2))


def test_calendar_and_windows(spark):
    assert CAL.dates() == [date(2025, 5, d) for d in (2, 9, 16, 23, 30)] + [date(2025, 6, 1)]
    assert Calendar(date(2025, 5, 9), date(2025, 5, 2)).dates()[-2:] == [date(2025, 5, 2), date(2025, 5, 9)]
    assert Calendar(date(2025, 1, 1), date(2025, 5, 2)).dates() == [date(2025, 1, 1)]
    days = [date(2025, 4, 1), date(2025, 5, 2), date(2025, 5, 3), date(2025, 5, 9), date(2025, 5, 31), date(2025, 6, 1), date(2025, 6, 2), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for n in (1, 7, 30):
        got = {(r["d"], r["snapshot_date"]) for r in expand_within(df, "d", CAL, n).collect()}
        assert got == {(d, x) for d in days if d for x in CAL.dates() if 0 <= (x - d).days < n}
    got = {(r["d"], r["snapshot_date"]) for r in expand_since(df, "d", CAL).collect()}
    assert got == {(d, x) for d in days if d for x in CAL.dates() if x >= d}


def test_accounts_by_snapshot(spark):
    days = [date(2025, 4, 1), date(2025, 5, 2), date(2025, 5, 3), date(2025, 5, 30), date(2025, 5, 31), date(2025, 6, 1), date(2025, 6, 2), None]
    rows = [(c, d) for c, ds in (("a", days), ("b", [days[2], days[2]]), ("c", [days[6]]), ("d", [days[4]])) for d in ds]
    df = spark.createDataFrame(rows, "cif string, open_date date")
    for cal in (CAL, Calendar(date(2025, 5, 30), date(2025, 5, 2)), Calendar(date(2025, 4, 20), date(2025, 5, 2))):
        got = {(r["cif"], r["snapshot_date"]): r["own_accounts"] for r in features.own_accounts(df, cal).collect()}
        want = {(c, x): sum(1 for k, d in rows if k == c and d and d <= x) for c in "abcd" for x in cal.dates()}
        assert got == {k: n for k, n in want.items() if n}


def test_mobile_forms(spark):
    rows = [("+91-98765 43210", "9876543210"), ("09876543210", "9876543210"), ("987654321", None), (None, None), ("", None)]
    got = spark.createDataFrame(rows, "m string, want string").select(s.mobile(F.col("m")).alias("got"), "want", s.masked(s.mobile(F.col("m"))).alias("x")).collect()
    assert all(r["got"] == r["want"] for r in got) and got[0]["x"] == "98xxxxx210" and got[2]["x"] is None


def test_ratio_and_hash(spark):
    got = spark.sql("select 1.0D a, 0.0D b, cast(null as double) c").select(s.ratio(F.col("a"), F.col("b")), s.ratio(F.col("a"), F.col("c")), s.hashed(F.lit(None).cast("string"), "x")).first()
    assert tuple(got) == (0.0, 0.0, None)


@pytest.mark.parametrize(("context", "book"), [(0.25, 0.25), (0.25, 0.0007), (0.5, 0.9)])
def test_prior_correction(spark, context, book):
    p = [0.0, 0.1, 0.5, 0.9, 1.0, 1.7, -0.2]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in p], "p double").select(s.prior_corrected(F.col("p"), context, book)).collect()]
    r = s.odds_ratio(context, book)
    assert got == pytest.approx([min(1, max(0, x)) * r / (min(1, max(0, x)) * r + 1 - min(1, max(0, x))) for x in p])
    with pytest.raises(ValueError):
        s.odds_ratio(0, 0.5)


def test_latest_breaks_ties(spark):
    at = datetime(2025, 1, 1)
    rows = [(1, "b", at), (1, "a", at), (1, "z", datetime(2024, 1, 1)), (2, "q", None), (3, None, at), (3, "n", at)]
    got = {r["k"]: r["v"] for r in relational.latest(spark.createDataFrame(rows, "k int, v string, ingested_at timestamp"), ["k"]).collect()}
    assert got[1] == "a" and got[2] == "q" and set(got) == {1, 2, 3}


def txns(spark, rows):
    df = spark.createDataFrame(rows, "txn_id string, account_id string, txn_ts timestamp, direction string, amount double, counterparty_vpa string")
    return df.withColumn("txn_date", F.to_date("txn_ts"))


def test_what_follows_a_credit(spark):
    t = datetime(2025, 5, 30, 12)
    from datetime import timedelta

    rows = [("c", "A", t, "CR", 100.0, "p")] + [(f"d{i}", "A", t + timedelta(seconds=x), "DR", 10.0, "q") for i, x in enumerate((0, 1, 86_400, 86_401))]
    got = behaviour.followed(txns(spark, rows), "txn_id").where("txn_id = 'c'").first()
    assert got["out_24h"] == 20.0 and got["next_debit"] == got["t"]  # the debit of the same second comes next by id, but does not count as outflow
    week = behaviour.measures(behaviour.followed(txns(spark, rows), "txn_id"), CAL).withColumn("share", behaviour.pass_through()).collect()
    by = {r["snapshot_date"]: r for r in week}
    assert by[date(2025, 5, 30)]["watched_in"] is None and by[date(2025, 5, 30)]["share"] == 0 and by[date(2025, 6, 1)]["share"] == 0.2
    met = {r["snapshot_date"]: (r["senders"], r["receivers"]) for r in behaviour.counterparties(txns(spark, rows), CAL).collect()}
    assert met[date(2025, 6, 1)] == (1, 1)


def test_slices_of_time_do_not_show(spark):
    """What follows a transaction against all pairs, over many slices, with gaps, ties and an account that never pays."""
    import random

    rnd, start = random.Random(2), datetime(2025, 1, 1)
    from datetime import timedelta

    at = sorted(rnd.randrange(0, 90 * 86_400, 977) if rnd.random() < 0.5 else 604_800 * rnd.randrange(12) + rnd.choice((-86_400, -1, 0, 1, 86_399, 86_400)) for _ in range(300))
    rows = [(f"{i:04d}", rnd.choice("AB"), start + timedelta(seconds=86_400 + x), rnd.choice(("CR", "DR")), float(rnd.randrange(1, 50)), "p") for i, x in enumerate(at)]
    rows += [(f"n{i}", "N", start + timedelta(days=9 * i), "CR", 1.0, "p") for i in range(5)] + [("null", "A", None, "CR", 1.0, "p")]
    got = {r["txn_id"]: (r["next_debit"], r["out_24h"]) for r in behaviour.followed(txns(spark, rows), "txn_id").collect()}
    second = {r[0]: int((r[2] - datetime(1970, 1, 1)).total_seconds()) for r in rows if r[2]}
    for r in rows[:-1]:
        mine = [o for o in rows[:-1] if o[1] == r[1] and o[3] == "DR"]
        after = [second[o[0]] for o in mine if (second[o[0]], o[0]) > (second[r[0]], r[0])]
        assert got[r[0]] == (min(after, default=None), sum(o[4] for o in mine if 0 < second[o[0]] - second[r[0]] <= 86_400)), r
    assert len(got) == len(rows)


def test_hold_is_censored(spark):
    got = behaviour.measures(behaviour.followed(txns(spark, [("c", "A", datetime(2025, 5, 30, 12), "CR", 1000.0, "p")]), "txn_id"), CAL).collect()
    hold = {r["snapshot_date"]: r["median_hold"] for r in got}
    assert hold[date(2025, 5, 30)] == pytest.approx(12, abs=0.001) and hold[date(2025, 6, 1)] == pytest.approx(60, abs=0.001)
    assert got[0]["n_round"] == 1


def test_hubs(spark):
    rows = [(f"c{i}", "MOBILE", "at limit", date(2025, 1, 1)) for i in range(25)] + [(f"c{i}", "MOBILE", "over", date(2025, 1, 1)) for i in range(26)] + [("x", "DEVICE", "kiosk", date(2025, 1, 1)), ("y", "DEVICE", "kiosk", date(2025, 1, 1))]
    links = spark.createDataFrame(rows, "cif string, link_type string, identifier string, first_seen date")
    own = spark.createDataFrame([(" KIOSK ",)], "device_id string")
    edges, hubs = graph.pair_edges(links, own)
    assert {r["identifier"] for r in hubs.collect()} == {"over", "kiosk"} and edges.count() == 25 * 24 // 2


def test_components(spark):
    chain = [("s1", i, i + 1) for i in range(60)]
    cliques = [("s2", a, b) for a in range(5) for b in range(5) if a < b] + [("s2", 10 + a, 10 + b) for a in range(5) for b in range(5) if a < b]
    df = spark.createDataFrame(chain + cliques + [("s3", 0, 10), ("s3", 7, 7)], "snapshot_date string, src int, dst int")
    got = {(r["snapshot_date"], r["node"]): r["comp"] for r in graph.connected_components(df).collect()}
    assert all(got["s1", i] == 0 for i in range(61)) and all(got["s2", i] == 0 and got["s2", 10 + i] == 10 for i in range(5)) and got["s3", 10] == 0 and ("s3", 7) not in got
    with pytest.raises(RuntimeError):
        graph.connected_components(df, max_rounds=1)


def test_hops(spark):
    e = spark.createDataFrame([("s", "a", "b"), ("s", "b", "c"), ("s", "c", "d"), ("s", "x", "y")], "snapshot_date string, src string, dst string")
    k = spark.createDataFrame([("s", "a"), ("t", "x")], "snapshot_date string, cif string")
    got = {(r["snapshot_date"], r["cif"]): r["hops_to_known_mule"] for r in graph.hops_to(e, k).collect()}
    assert got == {("s", "a"): 1, ("s", "b"): 1, ("s", "c"): 2, ("t", "x"): 1}


def test_label_horizon(spark):
    d = date(2025, 1, 31)
    rows = [(d, date(2025, 1, 31)), (d, date(2025, 2, 1)), (d, date(2025, 5, 1)), (d, date(2025, 5, 2)), (d, None), (date(2025, 4, 1), date(2025, 4, 2))]
    got = [r[0] for r in spark.createDataFrame(rows, "d date, c date").select(features.label(F.col("d"), F.col("c"), date(2025, 6, 1))).collect()]
    assert got == [0, 1, 1, 0, 0, None]


def test_merge_actions(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (None, "n")], "k int, v string")
    u = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (5, "e"), (None, None)], "k int, v string")
    got = {r["k"]: (r["action"], r["v"]) for r in merged(t, u, ["k"]).collect()}
    assert got == {1: ("kept", "a"), 2: ("updated", "B"), 3: ("updated", "c"), 4: ("deleted", "d"), 5: ("inserted", "e"), None: ("updated", None)}


def test_store(spark, tmp_path):
    st = Store(spark, str(tmp_path))
    assert not st.exists("t") and st.read_or_empty("t", "a int").count() == 0
    with pytest.raises(FileNotFoundError):
        st.read("t")
    day = spark.createDataFrame([(1, date(2025, 1, 1)), (2, date(2025, 1, 2))], "a int, run_date date")
    st.write("t", day)
    st.replace_where("t", day.where("a = 2").withColumn("a", F.lit(9)), "run_date", date(2025, 1, 2))
    assert sorted(r["a"] for r in st.read("t").collect()) == [1, 9] and sorted(r["a"] for r in st.read("t", 1).collect()) == [1, 2]
    first = st.history("t").orderBy("version").first()["committed_at"]
    assert st.version("t", first) == 1 and st.version("t") == 2
    st.append("t", day.where("a = 1"))
    assert st.read("t").count() == 3 and [r["operation"] for r in st.history("t").collect()] == ["append", "replace_partition", "replace"]


def test_store_writes_what_changes(spark, tmp_path):
    st = Store(spark, str(tmp_path))
    rows = [(i, date(2025, 1 + i % 3, 5), float(i)) for i in range(30)]
    st.write("t", spark.createDataFrame(rows, "k int, d date, v double"), by_month="d")
    st.append("t", spark.createDataFrame([(100, date(2025, 2, 6), 1.0), (101, date(2025, 7, 6), 2.0)], "k int, d date, v double"))
    assert st.history("t").first()["written"] == 2 and st.read("t").count() == 32
    after = [(k, d, v + (k == 4)) for k, d, v in rows if k != 7] + [(200, date(2025, 2, 8), 0.0)]  # 4 and 7 are of February, as 200
    st.merge("t", spark.createDataFrame(after, "k int, d date, v double"), ["k"])
    last = st.history("t").first()
    assert (last["added"], last["updated"], last["deleted"], last["rows"]) == (1, 1, 3, 30) and last["written"] == 10
    assert sorted((r["k"], r["d"], r["v"]) for r in st.read("t").collect()) == sorted(after)
    assert st.read("t", 2).count() == 32 and st.read("t", 1).count() == 30
    moved = [(k, date(2025, 9, 9) if k == 0 else d, v) for k, d, v in after]
    st.merge("t", spark.createDataFrame(moved, "k int, d date, v double"), ["k"])
    assert sorted((r["k"], r["d"], r["v"]) for r in st.read("t").collect()) == sorted(moved) and st.history("t").first()["written"] == 10
    plan = st.read("t", where=F.col("d_month") == F.lit(date(2025, 9, 1)))
    assert plan.count() == 1 and len(plan.inputFiles()) >= 1
    st.merge("t", spark.createDataFrame(moved, "k int, d date, v double"), ["k"])
    assert st.history("t").first()["written"] == 0 and st.read("t").count() == 30
    st.refresh("t")
    day = spark.createDataFrame([(1, date(2025, 1, 1)), (2, date(2025, 1, 2)), (3, None)], "a int, run_date date")
    st.replace_where("r", day, "run_date", date(2025, 1, 1))
    st.replace_where("r", day.where("a = 2").withColumns({"a": F.lit(9), "more": F.lit("x")}), "run_date", date(2025, 1, 2))
    assert st.history("r").first()["written"] == 1 and {(r["a"], r["more"]) for r in st.read("r").collect()} == {(1, None), (9, "x"), (3, None)}


def test_script():
    assert script("-- a\nSELECT 1;\n-- b\nSELECT\n  2;\n\n") == ["SELECT 1", "SELECT\n  2"]


def test_top_share_with_ties_and_weights(spark):
    rows = [(1, 1.0, 1.0, 0.9), (2, 0.0, 5.0, 0.9), (3, 1.0, 1.0, 0.1), (4, 0.0, 5.0, 0.1)]
    t = spark.createDataFrame(rows, "id int, y double, weight double, p double")
    got = evaluate.shares(t, "p", [0.0001, 0.5, 1.0])
    assert got[0.0001] == {"capture": 0.5, "precision": 1.0} and got[0.5]["capture"] == 0.5 and got[1.0]["capture"] == 1.0
    assert evaluate.roc_auc(t, "p") == pytest.approx(0.5) and evaluate.average_precision(t, "p") == pytest.approx(1 / 6)
    one = t.withColumn("y", F.lit(0.0))
    assert evaluate.roc_auc(one, "p") is None and evaluate.average_precision(one, "p") is None and evaluate.shares(one, "p", [0.5])[0.5]["capture"] is None
    assert evaluate.bands(t.withColumn("rules", F.col("p"))).count() == 7


def test_gate():
    ok, lines = evaluate.gate({"capture_top1": 0.5, "precision_top02": None}, {"min_capture_top1pct": 0.4, "min_precision_top02pct": 0.1})
    assert not ok and lines[0].startswith("PASS") and "n/a" in lines[1] and len(lines) == 2


CLEAN = {"hops_to_known_mule": 3, "credits_from_complainants_30d": 0, "pass_through_ratio_7d": 0.0, "median_hold_hours_30d": 720.0, "ring_size": 1, "accounts_on_same_device": 1, "cifs_sharing_mobile": 1, "new_device_logins_30d": 0, "vpa_or_mobile_changes_30d": 0, "inflow_to_declared_income_30d": 0.0, "distinct_senders_7d": 0, "dormant_reactivated_flag": 0, "account_age_days": 900, "min_kyc_flag": 0, "night_txn_share_30d": 0.0}


def test_rules_and_reasons(spark):
    over = [{}, {"hops_to_known_mule": 2}, {"pass_through_ratio_7d": 0.8}, {"median_hold_hours_30d": 6.0}, {"ring_size": 5}, {"accounts_on_same_device": 3}, {"cifs_sharing_mobile": 2}, {"new_device_logins_30d": 1}, {"inflow_to_declared_income_30d": 5.0}, {"distinct_senders_7d": 15}, {"dormant_reactivated_flag": 1}, {"account_age_days": 60}, {"min_kyc_flag": 1}, {"night_txn_share_30d": 0.3}, {"credits_from_complainants_30d": 1}]
    everything = {k: v for o in over for k, v in o.items()}
    rows = [CLEAN | o for o in [*over, everything]]
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'int'}" for k, v in CLEAN.items())
    df = spark.createDataFrame([(i, *[r[k] for k in CLEAN]) for i, r in enumerate(rows)], "i int, " + schema)
    got = sorted(score.with_reasons(df).withColumn("r", score.rules_score()).collect(), key=lambda r: r["i"])
    assert got[0]["reason_codes"] == "" and got[0]["r"] == 0
    assert [r["reason_codes"].count(",") for r in got[1:-1]] == [0] * 14 and len({r["reason_codes"] for r in got[1:-1]}) == 14
    assert got[-1]["reason_codes"] == "NEAR_KNOWN_MULE,COMPLAINANT_CREDITS,PASS_THROUGH,FAST_HOLD" and got[-1]["r"] == pytest.approx(14 + 0.1 + 0.008)
    assert got[-1]["reasons"] == "2 hop(s) from a reported / frozen mule; 1 credit(s) from 1930 / NCRP complainants in 30d; forwards 80% of credits within 24h; median 6.0h from credit to next debit"


def test_tiers(spark):
    got = [r[0] for r in spark.createDataFrame([(x,) for x in (0.001, 0.002, 0.005, 0.02, 0.05)], "p double").select(score.tier_of(F.col("p"))).collect()]
    assert [g[:2] for g in got] == ["T1", "T1", "T2", "T3", "NO"]


def test_tier_counts_of_a_book(spark):
    book = spark.range(200).select(F.concat(F.lit("A"), F.format_string("%03d", "id")).alias("account_id"), (F.col("id") / 200.0).alias("p"), (F.col("id") / 200.0).alias("p_adj"))
    ranked = score.ranked_book(book, info=["account_id"])
    assert {k: v[0] for k, v in score.cutoffs(ranked).items()} == {"T2_HOLD_MONITOR": 2, "T3_WATCHLIST": 4}
    assert ranked.orderBy("risk_rank").first()["account_id"] == "A199"


def test_windows_of_holdout():
    from datetime import timedelta

    dates = [date(2025, 1, 3) + timedelta(days=7 * k) for k in range(6)]
    assert score.test_window(dates, 2, 90) == (dates[-2], dates[-1], dates[-2] - timedelta(days=90))
    with pytest.raises(ValueError):
        score.test_window(dates, 6, 90)


def test_rates_and_volume():
    both = quality.rate_with_warning("t", "bad", 10_000, 7)
    assert [f.success for f in both] == [True, False] and [f.success for f in quality.rate_with_warning("t", "bad", 10_000, 11)] == [False, False]
    assert [f.success for f in quality.rate_with_warning("t", "bad", 10_000, 10)] == [True, False] and quality.rate("t", "x", 0, 0, 0.1).success
    assert quality.volume("t", 95, None) == [] and quality.volume("t", 95, 100.0)[0].success and not quality.volume("t", 94, 100.0)[0].success


def test_quality_of_empty_and_null_keys(spark):
    empty = spark.createDataFrame([], "k int, v string")
    found, n = quality.check("t", empty, [quality.not_null("k"), quality.in_set("v", ["a"])])
    assert n["rows"] == 0 and all(f.success for f in found)
    child, parent = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1,), (None,)], "k int")
    assert quality.orphans(child, "k", parent) == 2
    rows = quality.recorded(spark, found, "gold", date(2025, 1, 1)).collect()
    assert rows[0]["pipeline_run"] == "manual-2025-01-01" and rows[0]["unexpected_pct"] == 0.0


@pytest.mark.parametrize("request_", [{}, {"accounts": []}, {"accounts": [1]}, {"accounts": [{"account_id": "a"}]}, {"accounts": [{}] * 1001}, {"accounts": [{f: 1 for f in daily.FEATURES}], "what_if": {"nope": 1}}, {"accounts": [{f: "x" for f in daily.FEATURES}]}, {"accounts": [{f: float("nan") for f in daily.FEATURES}]}])
def test_bad_requests(request_):
    with pytest.raises(ValueError):
        daily.checked(request_)


def test_streaming_equals_batch(spark, tmp_path):
    from veritrail.streaming import windows

    rows = [(i, datetime(2025, 1, 1 + i % 5, i % 24), i % 3, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows + rows[:10], "event_id int, ts timestamp, user_id int, value double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = windows.activity(windows.fresh(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), delay="30 days"), length="1 day", slide="1 day")
    q = stream.writeStream.outputMode("update").format("memory").queryName("live").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    want = windows.activity(df.dropDuplicates(["event_id"]), length="1 day", slide="1 day")
    assert sorted(map(str, spark.table("live").collect())) == sorted(map(str, want.collect()))


def test_policy_is_whole():
    assert [t["upto_pct"] for t in POLICY["tiers"]] == [0.002, 0.01, 0.03]


def test_entry_point(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_exports(spark, tmp_path):
    from veritrail.sources import export

    st = Store(spark, str(tmp_path / "store"))
    st.write("t", spark.createDataFrame([(1, 'a "b", c'), (2, None)], "a int, b string"))
    for kind in ("parquet", "csv", "json"):
        where = export.tables(st, ["t"], str(tmp_path / kind), kind)
        back = spark.read.format(kind).option("header", True).option("escape", '"').schema("a int, b string").load(where["t"])
        assert sorted(map(str, back.collect())) == sorted(map(str, st.read("t").collect()))
    with pytest.raises(ValueError):
        export.write(st.read("t"), str(tmp_path / "x"), "nope")
    export.save_context(st.read("t"), {"run_id": "r", "to": date(2025, 1, 1)}, str(tmp_path / "ctx"))
    rows, meta = export.load_context(spark, str(tmp_path / "ctx"))
    assert rows.count() == 2 and meta == {"run_id": "r", "to": "2025-01-01"}

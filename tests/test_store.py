"""The store's merges, staged versions and streamed loads."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from veritrail.sources import store as stores
from veritrail.sources.store import Store

SCHEMA = "k int, d date, v double, tags array<int>"


def rows(n=120):
    return [(i, date(2024, 1, 1) + timedelta(i) if i % 40 else None, i / 7, [i, None] if i % 3 else None) for i in range(n)]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


@pytest.fixture
def joined(monkeypatch):
    """The numbers of rows of either side that merges have joined."""
    seen, plain = [], stores.merged

    def watched(target, source, *args, **options):
        seen.append((target.count(), source.count()))
        return plain(target, source, *args, **options)

    monkeypatch.setattr(stores, "merged", watched)
    return seen


def last(store, table="t"):
    r = store.history(table).first()
    return r["rows"], r["added"], r["updated"], r["deleted"], r["written"]


def test_merge_joins_what_differs(spark, store, joined):
    first = spark.createDataFrame(rows(), SCHEMA)
    store.merge("t", first, ["k"], by_month="d")
    assert joined == []
    store.merge("t", first.repartition(5, "v"), ["k"], by_month="d")
    assert joined == [(0, 0)] and last(store) == (120, 0, 0, 0, 0)
    february = first.where("d between '2024-02-01' and '2024-02-29'").count()
    changed = first.withColumn("v", F.when(F.col("k") == 45, -1.0).otherwise(F.col("v")))
    store.merge("t", changed, ["k"], by_month="d")
    assert joined[1] == (february, february) and last(store) == (120, 0, 1, 0, february)
    # a row moves from March to January, one without a date goes, one of a new month comes
    moved = changed.where("k <> 40").withColumn("d", F.when(F.col("k") == 70, F.lit(date(2024, 1, 9))).otherwise(F.col("d"))).unionByName(spark.createDataFrame([(500, date(2025, 5, 5), 1.0, None)], SCHEMA))
    store.merge("t", moved, ["k"], by_month="d")
    assert last(store)[:4] == (120, 1, 1, 1)
    months = {(r.m, r.n) for r in moved.groupBy(F.coalesce(F.trunc("d", "MM"), F.lit(date(1900, 1, 1))).alias("m")).agg(F.count("*").alias("n")).collect()}
    assert joined[2][1] == sum(n for m, n in months if m in (date(2024, 1, 1), date(2024, 3, 1), date(1900, 1, 1), date(2025, 5, 1)))
    got = sorted(map(str, store.read("t").select("k", "d", "v", "tags").collect()))
    assert got == sorted(map(str, moved.select("k", "d", "v", "tags").collect()))


def test_staged_rows_are_no_version_until_committed(spark, store):
    first = spark.createDataFrame(rows(), SCHEMA)
    staged = store.stage("t", first, by_month="d", observe=[F.count_if(F.col("d").isNull()).alias("late"), F.max("k").alias("most")])
    assert staged.counts == {"rows": 120, "late": 3, "most": 119} and not store.exists("t")
    assert staged.rows.columns == first.columns and staged.rows.count() == 120
    assert staged.commit() == 1 and store.read("t").count() == 120
    empty = store.stage("t", first.where("false"), by_month="d")
    assert empty.counts["rows"] == 0 and empty.rows.count() == 0
    assert empty.commit() == 2 and store.read("t").count() == 0 and store.read("t", 1).count() == 120


def test_appends_and_replacements_count_what_they_write(spark, store, monkeypatch):
    df = spark.createDataFrame(rows(), SCHEMA)
    store.write("t", df.where("k < 100"), by="d")
    opened, plain = [], Store._rows
    monkeypatch.setattr(Store, "_rows", lambda self, table, commit, parts: opened.append(len(parts)) or plain(self, table, commit, parts))
    store.append("t", df.where("k >= 100"))
    assert opened == [] and last(store) == (120, 20, 0, 0, 20)
    store.replace_where("t", df.where("k = 7").unionByName(df.where("k = 7")), "d", date(2024, 1, 8))
    assert opened == [1] and last(store)[0] == 121

"""Streams into the store give what the batch gives, also if a batch comes twice or the stream is started anew."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from veritrail.operators.relational import latest
from veritrail.sources.store import Store
from veritrail.streaming import loads

SCHEMA = "k int, v double, day date, at timestamp"
START = datetime(2024, 1, 1)


@pytest.fixture
def files(spark, tmp_path):
    """Four files of rows, each later than the one before but for some minutes; and all rows."""
    rng, rows = np.random.default_rng(1), []
    for part in range(4):
        mine = []
        for _ in range(40):
            at = START + timedelta(hours=part, minutes=int(rng.integers(0, 70)))
            mine.append((int(rng.integers(0, 25)), float(rng.integers(0, 5)), (START + timedelta(days=20 * int(rng.integers(0, 3)))).date(), at))
        rows += mine
        spark.createDataFrame(mine, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in"), spark.createDataFrame(rows, SCHEMA)


def read(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def rows_of(df):
    return sorted(map(str, df.select("k", "v", "day", "at").collect()))


def test_stream_upserts_give_the_batch(spark, files, tmp_path):
    path, every = files
    store = Store(spark, str(tmp_path / "store"))
    where = str(tmp_path / "checkpoint")
    loads.upserted(read(spark, path), store, "t", ["k"], "at", "load", where, by_month="day").awaitTermination()
    want = rows_of(latest(every, ["k"], "at"))
    assert rows_of(store.read("t")) == want and store.version("t") == 4
    # nothing new
    loads.upserted(read(spark, path), store, "t", ["k"], "at", "load", where, by_month="day").awaitTermination()
    assert store.version("t") == 4
    # the last batch again, as a stream does that fell before it could note that the batch was done
    loads.batch_upsert(store, "t", ["k"], "at", "load", "day")(every.where("v = 0").withColumn("at", F.current_timestamp()), 3)
    assert store.version("t") == 4 and rows_of(store.read("t")) == want
    # another stream, older rows and rows without a key: nothing changes but the newer ones
    more = spark.createDataFrame([(3, 9.0, START.date(), START - timedelta(days=1)), (None, 1.0, START.date(), START), (99, 2.0, None, START), (4, 7.0, START.date(), START + timedelta(days=9))], SCHEMA)
    loads.batch_upsert(store, "t", ["k"], "at", "other", "day")(more, 0)
    assert rows_of(store.read("t")) == rows_of(latest(every.unionByName(more.where("k is not null")), ["k"], "at"))
    last = store.history("t").first()
    assert last["operation"] == "stream other 0" and (last["added"], last["updated"], last["deleted"]) == (1, 1, 0)


def test_newest_rows_of_a_stream(spark, files, tmp_path):
    path, every = files
    out = loads.newest(read(spark, path), ["k"], "at", "2 hours")
    q = out.writeStream.format("memory").queryName("newest").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("newest")
    assert rows_of(latest(got, ["k"], "at")) == rows_of(latest(every, ["k"], "at", ["v", "day"]))
    assert got.count() < every.count()

import re

import numpy as np
import pytest
import xxhash
from veritrail.llm import simhash as sh
from veritrail.llm.base import components, table


def plain_fingerprint(text, w):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + w]) for i in range(max(1, len(words) - w + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, bits):
    """doc_id -> smallest id reachable, by all pairs."""
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= bits:
                label[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    return [min((d for d in groups[root(i)] if d is not None), default=None) for i in range(len(rows))]


def test_spark_hash_is_the_one(spark):
    assert spark.sql("select xxhash64('the quick brown fox')").first()[0] % 2**64 == xxhash.xxh64_intdigest(b"the quick brown fox", 42)


@pytest.mark.parametrize("text", ["", None, "one", "A b C d", "É É é x y z", "a a a a a a a", " lead\x0bing  and trailing \n", "w " * 3000])
def test_fingerprint(text):
    for w in (4, 5):
        assert sh.fingerprint(text, w) % 2**64 == plain_fingerprint(text, w)


@pytest.mark.parametrize(("bits", "parts"), [(4, 3), (6, 4), (4, 2), (5, 3)])
def test_anchors_reach_every_close_home(bits, parts):
    rng = np.random.default_rng(bits)
    x = rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 300, dtype=np.uint64)
    y = x.copy()
    for i in range(len(x)):
        for b in rng.choice(64, bits, replace=False):
            y[i] ^= np.uint64(1 << int(b))
    met = np.zeros(len(x), bool)
    for shift, width in sh.runs(parts):
        own = sh.home((x >> np.uint64(shift)) & np.uint64((1 << width) - 1), width)
        row, cell = sh.anchors(y, shift, width, bits // parts)
        for r, c in zip(row, cell, strict=True):
            met[r] |= own[r] == c
    assert met.all()


def clustered(rng, centres=12, each=60):
    rows = []
    for _ in range(centres):
        c = int(rng.integers(0, 2**62))
        for _ in range(each):
            x = c
            for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                x ^= 1 << int(b)
            rows.append(x)
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, block):
    monkeypatch.setattr(sh, "BLOCK", block)
    fps = sorted(set(clustered(np.random.default_rng(1), 8, 40)))
    rows = [(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(fps)]
    found = components(sh.links(spark.createDataFrame(rows, "id long, fp long"), 4, 3)).collect()
    got = {i: i for i in range(len(fps))} | {r["node"]: r["component"] for r in found}
    want = plain_components([(i, f) for i, f in enumerate(fps)], 4)
    assert [got[i] for i in range(len(fps))] == want


def test_odd_rows(spark, odd):
    rows = sh.op2_simhash(spark, odd[0]).collect()
    docs = table(spark, odd[0], "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    by_fp = {f"{plain_fingerprint(d['text'], 4):016x}" for d in docs}
    assert {r["fingerprint"] for r in rows} == by_fp
    comp = {(r["doc_id"], r["component_id"]) for r in rows}
    assert {(2, 2), (3, 2), (8, 2), (6, 6), (7, 6), (1, 1)} <= comp and (None, None) in comp
    assert sh.op2_simhash(spark, odd[1]).count() == 0


def test_one_of_each(spark, odd):
    docs = table(spark, odd[0], "documents")
    kept = sh.one_of_each(docs, 5, 6, 4)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 5, 6, 9, 10] and ids.count(None) == 1


def test_components_of_a_chain(spark):
    n = 200
    e = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (None, 5), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(e).collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), 1000: 1000, 1001: 1000}


def test_components_run_in_as_many_tasks_as_edges_need(spark):
    """The driver keeps account of each task: a small graph is not dealt to all shuffle partitions in each step of each round."""
    partitions, sc = 32, spark.sparkContext
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sc.setJobGroup("components", "components")
        got = components(spark.createDataFrame([(i, i + 1) for i in range(12)], "a long, b long")).collect()
    finally:
        sc.setJobGroup("", "")
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["component"] for r in got} == {0} and len(got) == 13
    of = sc.statusTracker()
    tasks = sum(s.numCompletedTasks for j in of.getJobIdsForGroup("components") for i in of.getJobInfo(j).stageIds if (s := of.getStageInfo(i)))
    assert tasks < 40 * partitions

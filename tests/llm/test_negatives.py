import numpy as np
import pytest
from veritrail.llm import negatives

LEAST, MOST = negatives.LONG


def plain(rows, positives=5, negatives_=10, scale=256):
    """rows: (id, label, vector, anchor)."""
    sound = {}
    for i, label, v, anchor in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        sound[i, label, tuple(int(np.floor(scale * float(x))) for x in v)] = bool(anchor)

    def score(a, b):
        return min(max(sum(x * y for x, y in zip(a[2], b[2], strict=True)), LEAST), MOST)

    out = []
    for a in (a for a, anchor in sound.items() if anchor):
        others = [b for b in sound if b != a and len(b[2]) == len(a[2])]
        scored = sorted((-score(a, b), b[0], b[1]) for b in others)
        for ps, p, _ in [s for s in scored if s[2] == a[1]][:positives]:
            fits = [s for s in scored if s[2] != a[1] and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:negatives_]
            out += [(a[0], p, r + 1, n, -ps, -s) for r, (s, n, _) in enumerate(fits)]
    return sorted(out)


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


def clustered(seed, n=900, d=8, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    x = centres[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, d))
    x[::9] = x[0]  # many ties
    return [(i, int(rng.integers(labels)), x[i].tolist(), i % 10 == 0) for i in range(n)]


@pytest.mark.parametrize(("seed", "shard", "leaf"), [(1, 8192, 16), (2, 100, 4), (3, 50, 64)])
def test_equals_plain_version(spark, monkeypatch, seed, shard, leaf):
    for name, value in (("SHARD", shard), ("LEAF", leaf), ("ANCHOR_LEAF", leaf)):
        monkeypatch.setattr(negatives, name, value)
    rows = clustered(seed)
    want = plain(rows)
    assert len(want) > 1000
    assert got(negatives.mined(spark.createDataFrame(rows, "id long, label long, vector array<double>, anchor boolean"))) == want


def test_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    want = plain([(r.vec_id, (r.label + 1) % 10 if r.label is not None and r.vec_id % 7 == 0 else r.label, r.embedding, r.vec_id % 100 == 0) for r in rows])
    assert want and got(negatives.op13_hard_negatives(spark, "/root/testdata/sf0.01")) == want


def test_odd_and_empty(spark, odd):
    full, empty = odd
    rows = spark.read.parquet(f"{full}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    anchors = [(r.vec_id, r.label, r.embedding, True) for r in rows]
    schema = "id long, label long, vector array<double>, anchor boolean, score string, place string"
    assert got(negatives.mined(spark.createDataFrame([(*r, "clash", "clash") for r in anchors], schema))) == plain(anchors)
    assert got(negatives.op13_hard_negatives(spark, full)) == []
    assert got(negatives.op13_hard_negatives(spark, empty)) == []


def test_large_components_empty_vectors_and_repeated_ids(spark):
    rng = np.random.default_rng(8)
    rows = [(i, i % 3, (rng.normal(size=4) * 10.0 ** rng.choice([0, 3, 9, 18, 30])).tolist(), i % 2 == 0) for i in range(60)]
    rows += [(100, 0, [], True), (101, 0, [], False), (102, 1, [], False), (4, 1, [1.0, 2.0, 3.0, 4.0], True), (4, 1, [1.0, 2.0, 3.0, 4.0], True), (None, 1, [1.0] * 4, True)]
    assert got(negatives.mined(spark.createDataFrame(rows, "id long, label long, vector array<double>, anchor boolean"))) == plain(rows)


def test_trees_prune_whole_groups():
    rng = np.random.default_rng(4)
    centres = 40 * rng.normal(size=(40, 16))
    x = np.floor(centres[rng.integers(0, 40, 8000)] + rng.normal(size=(8000, 16)))
    label = rng.integers(0, 5, 8000)
    side = negatives.Side(x, label, np.arange(8000), np.arange(8000))
    a = negatives.Side(x[::20], label[::20], np.arange(0, 8000, 20), np.arange(0, 8000, 20))
    best = negatives.Best(np.full((400, 1), -np.inf), np.full((400, 1), np.inf), 5)
    scored, of = negatives.descend(a, side, np.arange(400), np.arange(8000), True, best)
    assert scored < of / 4
    s = np.where((a.label[:, None] == side.label) & (a.places[:, None] != side.places), a.x @ x.T, -np.inf)
    want = -np.sort(-s, axis=1)[:, :5]
    by = np.lexsort((-best.rows[2], best.rows[0]))
    assert (best.rows[2][by].reshape(400, 5) == want).all()

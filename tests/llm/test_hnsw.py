import numpy as np
import pytest
from veritrail.llm import hnsw
from veritrail.llm.base import table


def plain(rows, threshold=0.93):
    """vec_id -> (links, component) by all pairs of sound vectors."""
    sound = [(i, v, lab) for i, v, lab in rows if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = {}, {}
    for k, (i, v, lab) in enumerate(sound):
        links[k], root[k] = 0, k

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sound)):
        for b in range(a):
            x, y = np.array(sound[a][1], float), np.array(sound[b][1], float)
            if sound[a][2] == sound[b][2] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k in root:
        if sound[k][0] is not None:
            least[find(k)] = min(least.get(find(k), 10**18), sound[k][0])
    out = {(i, 0, i) for i, v, lab in rows if (i, v, lab) not in sound}
    return sorted(map(str, list(out) + [(sound[k][0], links[k], least.get(find(k))) for k in root]))


def planted(n, d, near, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x = np.concatenate((x, x[:near] + 0.2 * rng.normal(size=(near, d))))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_graph_finds_what_a_scan_finds():
    x = planted(1500, 32, 300)
    g = hnsw.Graph(x)
    beam, recall = hnsw.audit(g, 0.93)
    assert recall >= hnsw.RECALL
    got = {(int(i), int(j)) for a, b in g.within(x, 0.93, beam) for i, j in zip(a, b, strict=True)}
    want = set(zip(*(v.tolist() for v in np.nonzero(x @ x.T >= 0.93)), strict=True))
    assert len(got & want) / len(want) > 0.99 and got <= want


def test_no_cap_on_partners():
    rng = np.random.default_rng(3)
    c = rng.normal(size=64)
    x = np.concatenate((c + 0.05 * rng.normal(size=(700, 64)), rng.normal(size=(300, 64))))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    got = np.zeros(1000, int)
    g = hnsw.Graph(x)
    for i, j in g.within(x, 0.93, hnsw.audit(g, 0.93)[0]):
        np.add.at(got, i, 1)
    assert got[:700].min() > 0.95 * 700 and (got[700:] == 1).mean() > 0.97


@pytest.mark.parametrize("shard_rows", [20_000, 60])
def test_query_equals_all_pairs(spark, monkeypatch, tmp_path, shard_rows):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", shard_rows)
    x = planted(200, 16, 60, 5)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)] + [(900 + i, x[3].tolist(), 1) for i in range(5)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = hnsw.op4_hnsw(spark, str(tmp_path)).collect()
    assert sorted(str((r["vec_id"], r["n_links"], r["component_id"])) for r in got) == plain(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def shard(x, first):
    x = hnsw.unit(x.astype(float))
    g = hnsw.Graph(x.astype(np.float32))
    return (g, x, np.arange(first, first + len(x)), np.ones(len(x), np.int64)), hnsw.audit(g, 0.93)[0]


def test_links_have_two_ends():
    """Clusters whose members are about as far apart as links may be: both ends of a link count it, and next to none is lost."""
    rng = np.random.default_rng(8)
    c = rng.normal(size=(30, 48))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    x = c[rng.integers(0, 30, 3000)] + 0.27 / np.sqrt(48) * rng.normal(size=(3000, 48))
    (a, beam_a), (b, beam_b) = shard(x[:1600], 0), shard(x[1600:], 1600)
    near = hnsw.unit(x) @ hnsw.unit(x).T >= 0.93
    np.fill_diagonal(near, False)
    assert 20_000 < near.sum() < 700_000
    ab, ba = hnsw.meet(a, b, (beam_a, beam_b), 0.93), hnsw.meet(b, a, (beam_b, beam_a), 0.93)
    assert (ab[0] == ba[1]).all() and (ab[1] == ba[0]).all() and ab[0].sum() == ab[1].sum()
    own = hnsw.meet(a, a, (beam_a, beam_a), 0.93)[0]
    assert (ab[0] <= near[:1600, 1600:].sum(1)).all() and (own <= near[:1600, :1600].sum(1)).all()
    assert ab[0].sum() + own.sum() >= 0.99999 * near[:1600].sum()


def test_large_ids_stay_whole(spark, tmp_path):
    big = (1 << 62) + 1
    rows = [(big, [1.0, 0.0], 1), (big + 2, [1.0, 0.001], 1), (big + 4, [0.0, 1.0], 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in hnsw.op4_hnsw(spark, str(tmp_path)).collect()}
    assert got == {big: (1, big, True), big + 2: (1, big, False), big + 4: (0, big + 4, True)}


def test_odd_rows(spark, odd):
    got = {}
    for r in hnsw.op4_hnsw(spark, odd[0]).collect():
        got.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    # 1, 2, 9 and 9 point the same way within label 1
    assert got[1] == [(3, 1, True)] and got[2] == [(3, 1, False)] and got[9] == [(3, 1, False)] * 2 and got[None] == [(0, None, False)]
    assert all(got[i] == [(0, i, True)] for i in (3, 4, 5, 6, 7, 8, 11, 12, 13))
    assert hnsw.op4_hnsw(spark, odd[1]).count() == 0

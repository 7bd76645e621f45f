import numpy as np
import pytest
from veritrail.llm import simhash, similar

import corpus_pipeline


def jaccard(s, t):
    return len(s & t) / (len(s | t) or 1)


def plain_sets(text, w=5):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + w]) for i in range(max(1, len(words) - w + 1))} if words else set()


def plain_kept(rows):
    """The smallest id of each group that all pairs of at least 0.8 connect."""
    sets, label = [plain_sets(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and (jaccard(sets[i], sets[j]) >= 0.8 or sets[i] == sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    return sorted(min(rows[i][0] for i in range(len(rows)) if label[i] == x) for x in set(label))


def changed(rng, words, n):
    words = list(words)
    for i in rng.choice(len(words), n, replace=False):
        words[i] = f"new{rng.integers(1 << 40)}"
    return words


def near_copies(rng, texts=40, each=4, words=150):
    """Rows (doc_id, text): texts and copies in which a few words differ, of similarities around 0.8."""
    rows = []
    for _ in range(texts):
        base = [f"w{x}" for x in rng.integers(0, 5000, words)]
        rows += [" ".join(base)] + [" ".join(changed(rng, base, int(rng.integers(1, 5)))) for _ in range(each)]
    return [(int(i), rows[k]) for k, i in enumerate(rng.permutation(len(rows)))]


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(r["doc_id"] for r in corpus_pipeline.without_copies(spark, docs, None).collect())


def test_stage_finds_what_all_pairs_find(spark):
    rows = near_copies(np.random.default_rng(3))
    want, got = plain_kept(rows), kept(spark, rows)
    assert set(want) <= set(got) and len(got) - len(want) <= 0.01 * len(rows)


@pytest.mark.parametrize("texts", [1, 3])
def test_heavy_cells_and_components_in_blocks(spark, monkeypatch, texts):
    monkeypatch.setattr(similar, "SAMPLED", 1)
    monkeypatch.setattr(similar, "BLOCK", 20)
    monkeypatch.setattr(similar, "SET_BLOCK", 7)
    rows = near_copies(np.random.default_rng(4), texts, 60)
    assert kept(spark, rows) == plain_kept(rows)


def test_close_fingerprints_that_are_not_alike_stay(spark):
    """Chains of candidates between 0.55 and 0.8, of which some links hold and others do not."""
    rng = np.random.default_rng(5)
    rows, words = [], [f"w{x}" for x in rng.integers(0, 5000, 100)]
    for i in range(60):
        rows.append((i, " ".join(words)))
        words = changed(rng, words, 2 if i % 3 else 6)
    assert kept(spark, rows) == plain_kept(rows)


@pytest.mark.parametrize("block", [1024, 5])
def test_nodes_that_agree_in_no_run_meet_at_anchors(spark, monkeypatch, block):
    """Twins differ in a bit of every 16 in turn, so that only anchors of the code bring them together."""
    monkeypatch.setattr(similar, "SAMPLED", 1)
    monkeypatch.setattr(similar, "BLOCK", block)
    rng = np.random.default_rng(7)
    fps = rng.integers(0, 256, (60, 8 * similar.WORDS64), dtype=np.uint8)
    twins = fps.copy()
    for x in twins:
        for k in range(0, len(x), 2):
            x[k + rng.integers(2)] ^= 1 << rng.integers(8)
    rows = [(i, x.tobytes()) for i, x in enumerate(np.concatenate((fps, twins)))]
    found = similar.candidates(spark.createDataFrame(rows, "node long, fp binary")).distinct().collect()
    assert {tuple(sorted(r)) for r in found} == {(i, i + 60) for i in range(60)}


def group_of(rng, nodes):
    """Fingerprints of a large group: a bit of them differs from a common one with 0.06."""
    return rng.integers(0, 2, 256, dtype=np.uint8) ^ (rng.random((nodes, 256)) < 0.06).astype(np.uint8)


def connected(pairs):
    """The smallest node that each node reaches."""
    label = {x: x for p in pairs for x in p}
    while True:
        new = dict(label)
        for a, b in pairs:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            return label
        label = new


def test_a_large_group_takes_rows_in_proportion(spark, monkeypatch):
    """Cells of many blocks: what a group brings forth grows with its nodes, not with nodes by blocks."""
    monkeypatch.setattr(similar, "SAMPLED", 1)
    monkeypatch.setattr(similar, "BLOCK", 10)
    rows = {}
    for n in (100, 400):
        fps = np.packbits(group_of(np.random.default_rng(8), n), axis=1, bitorder="little")
        found = similar.candidates(spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(fps)], "node long, fp binary")).collect()
        assert connected(found) == dict.fromkeys(range(n), 0)
        rows[n] = len(found)
    assert rows[400] <= 6 * rows[100] and rows[400] <= 15 * 400


@pytest.mark.parametrize("reach", [0, 1, 8])
def test_labels_leave_out_no_pair(spark, monkeypatch, reach):
    """Two groups that share heavy cells, and nodes of which some are near one, against all pairs that meet at an anchor."""
    monkeypatch.setattr(similar, "SAMPLED", 1)
    monkeypatch.setattr(similar, "BLOCK", 6)
    monkeypatch.setattr(similar, "REACH", reach)
    rng = np.random.default_rng(9)
    bits = group_of(rng, 140)
    bits[60:100] ^= np.arange(256) >= 36
    bits[100:] ^= rng.random((40, 256)) < 0.22
    fps = np.packbits(bits, axis=1, bitorder="little")
    at = {}
    for r, run in enumerate(similar.runs_of(fps).T):
        row, anchor = simhash.anchors(run, 0, similar.WIDTH, similar.RADIUS)
        for k, (i, c) in enumerate(zip(row.tolist(), anchor.tolist(), strict=True)):
            at.setdefault((r, c), ([], []))[k >= len(fps)].append(i)
    far = (bits[:, None, :128] != bits[None, :, :128]).sum(2)
    want = {(i, j) for home, more in at.values() for i in home for j in home + more if i != j and far[i, j] <= similar.FAR}
    found = similar.candidates(spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(fps)], "node long, fp binary")).collect()
    assert set(connected(want).values()) == {0, 60} and connected(found) == connected(want)


def test_alike():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 40, rng.integers(0, 40))).astype("u8") for _ in range(150)]
    sets += [np.unique(np.concatenate((s, [50, 51]))).astype("u8") for s in sets[:60]]
    a, b = similar.alike(np.arange(len(sets)), sets, 0.8)
    label = list(range(len(sets)))
    for i, j in zip(a, b, strict=True):
        assert jaccard(set(sets[i].tolist()), set(sets[j].tolist())) >= 0.8 and label[i] != label[j]
        label = [label[j] if x == label[i] else x for x in label]
    for i in range(len(sets)):
        for j in range(i):
            if jaccard(set(sets[i].tolist()), set(sets[j].tolist())) >= 0.8:
                assert label[i] == label[j]


@pytest.mark.parametrize("stage", [lambda docs: simhash.one_of_each(docs, 5, 6, 4), similar.one_of_similar])
def test_texts_under_a_repeated_id(spark, stage):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, b), (3, c), (3, c), (4, c)]
    got = stage(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, a), (2, b), (3, c)]


def test_defined_cases(spark, odd):
    full, empty = odd
    docs = spark.read.parquet(f"{full}/documents.parquet")
    kept = similar.one_of_similar(docs)
    assert kept.columns == docs.columns
    rows = kept.select("doc_id", "text", "score").collect()
    # 2 is null, 3 empty and there twice, 8 blank: one of them stays; 6 and 7 are equal, 7 is there twice; the row without an id stays
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, i) for i in (1, 2, 5, 6, 9, 10)] + [(True, 0)]
    assert {r.score for r in rows} == {"clash"} and next(r.text for r in rows if r.doc_id == 2) is None
    assert similar.one_of_similar(spark.read.parquet(f"{empty}/documents.parquet")).count() == 0


def test_texts_shorter_than_a_shingle_and_texts_under_one_id(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, "one two three"), (4, "a b c d e f"), (4, "quite another text under the same id"), (5, " one\ttwo ")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in similar.one_of_similar(docs).collect()) == [(1, "one two"), (3, "one two three"), (4, "a b c d e f"), (4, "quite another text under the same id")]

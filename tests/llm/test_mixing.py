import re
from math import comb

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from veritrail.llm import draws
from veritrail.llm import mixing as mx
from veritrail.llm.base import table


@given(st.lists(st.integers(0, 10_000), max_size=12))
def test_targets(sizes):
    t = mx.targets(sizes)
    assert all(x <= 3 * s + 1e-6 for x, s in zip(t, sizes, strict=True))
    assert abs(sum(t) - sum(sizes)) < 1e-3
    open_ = [(x, 1 + k % 3) for k, (x, s) in enumerate(zip(t, sizes, strict=True)) if x < 3 * s - 1e-6]
    assert len({round(x / w, 4) for x, w in open_}) <= 1  # those that are not capped share by weight


def test_targets_in_turns():
    assert mx.targets([100, 1, 1]) == pytest.approx([96, 3, 3])


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 5000])
def test_permutation(n):
    p = mx.Permutation(n, 3)
    x = p(np.arange(n))
    assert sorted(x.tolist()) == list(range(n)) and (p(x, back=True) == np.arange(n)).all()


def test_shards_meet_the_quotas(monkeypatch):
    monkeypatch.setattr(mx, "SHARD_SLOTS", 16)
    plan = mx.Plan(["a", "b", "c", None], [40_000, 9_000, 70_000, 300])
    seen = np.zeros(4, np.int64)
    for shard, before, count in plan.counts(0, plan.shards):
        assert (before == seen).all() and count.sum() == (16 if shard < plan.shards - 1 else plan.slots - 16 * shard)
        seen += count
        again = next(iter(plan.counts(shard, shard + 1)))
        assert (again[1] == before).all() and (again[2] == count).all()
    assert seen.tolist() == plan.quota


def mass(x, good, bad, n):
    return comb(good, x) * comb(bad, n - x) / comb(good + bad, n)


@pytest.mark.parametrize(("good", "bad", "n"), [(5, 7, 4), (1, 1, 1), (40, 3, 20), (300, 500, 250), (2, 900, 30), (17, 20, 36)])
def test_mass_is_that_of_combinations(good, bad, n):
    x = np.arange(max(0, n - bad), min(n, good) + 1)
    got = np.exp(draws.log_mass(*(np.asarray(a, float) for a in np.broadcast_arrays(x, good, bad, n))))
    assert got == pytest.approx([mass(int(k), good, bad, n) for k in x], rel=1e-10)


@pytest.mark.parametrize(("good", "bad", "n"), [(5, 7, 4), (300, 500, 250), (2, 900, 30), (400_000, 300_000, 1000)])
def test_draws_follow_their_law(good, bad, n):
    rng, size = np.random.default_rng(1), 200_000
    got = draws.hypergeometric(*(np.full(size, a) for a in (good, bad, n)), rng)
    theirs = np.random.default_rng(2).hypergeometric(good, bad, n, size)
    top = int(max(got.max(), theirs.max())) + 1
    want = np.array([mass(x, good, bad, n) if max(0, n - bad) <= x <= min(n, good) else 0.0 for x in range(top)])
    for sample in (got, theirs):
        often = want * size >= 10
        seen = np.bincount(sample, minlength=top)
        chi = ((seen[often] - size * want[often]) ** 2 / (size * want[often])).sum()
        assert abs(chi - often.sum()) < 6 * np.sqrt(2 * often.sum()) + 5


def test_draws_beyond_a_billion():
    """Mean and variance of the same law, where the generator's own draws end."""
    good, bad, n, size = 7 * 10**12, 2 * 10**12, 10**12, 40_000
    got = draws.hypergeometric(*(np.full(size, a) for a in (good, bad, n)), np.random.default_rng(3)).astype(float)
    p, total = good / (good + bad), good + bad
    var = n * p * (1 - p) * (total - n) / (total - 1)
    assert abs(got.mean() - n * p) < 5 * np.sqrt(var / size) and abs(got.var() / var - 1) < 5 * np.sqrt(2 / size)


@pytest.mark.parametrize("scale", [1, 10**9])
def test_draws_of_many_kinds(scale):
    rng = np.random.default_rng(0)
    counts = np.array([5, 0, 3, 1, 0, 9, 2]) * scale
    total = int(counts.sum())
    for n in (0, 1, total // 3, total - 1, total):
        got = draws.multivariate(counts, n, rng)
        assert got.sum() == n and (got >= 0).all() and (got <= counts).all()
    got = np.mean([draws.multivariate(counts, total // 2, rng) for _ in range(300)], axis=0)
    assert np.abs(got / scale - counts / scale / 2).max() < 0.3
    assert draws.multivariate(np.array([4]), 3, rng).tolist() == [3]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_query(spark, odd):
    docs = table(spark, odd[0], "documents").select("doc_id", "text", "source").collect()
    rows = mx.op6_mixing(spark, odd[0]).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted((str(d["doc_id"]), words(d["text"])) for d in docs)
    sources = sorted({d["source"] for d in docs}, key=lambda s: (s is None, s or ""))
    sizes = [sum(words(d["text"]) for d in docs if d["source"] == s) for s in sources]
    assert {(r["source_size"], round(r["target"], 6)) for r in rows} == {(n, round(t, 6)) for n, t in zip(sizes, mx.targets(sizes), strict=True)}
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    for (_, target), got in by.items():
        assert abs(sum(got) - target) <= 1
    assert sorted(map(str, rows)) == sorted(map(str, mx.op6_mixing(spark, odd[0]).collect()))
    assert mx.op6_mixing(spark, odd[1]).count() == 0


def test_mixed_texts_have_the_words_taken(spark, odd):
    docs = table(spark, odd[0], "documents")
    out = mx.mixed(docs)
    assert out.columns == docs.columns
    rows, want = out.collect(), {}
    for r in mx.taken(docs).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + words(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert got == {k: v for k, v in want.items() if v}
    assert mx.mixed(table(spark, odd[1], "documents")).count() == 0


def test_slots_fill_the_mix(spark):
    docs = spark.createDataFrame([(i, " ".join(["w"] * (i % 700)), "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    plan, _, slots = mx.prepared(docs)
    rows = slots.collect()
    assert len(rows) == plan.slots == len({(r["shard"], r["slot"]) for r in rows})
    assert sum(r["words"] for r in rows) == sum(int(t + 0.5) for t in plan.targets)


def plainly(docs):
    """(doc_id, size) -> words taken, word by word: sources as lists of the documents' words, slots one after another."""
    plan = mx.Plan(*zip(*sorted({(d["source"], d["k_size"]) for d in docs}, key=lambda x: (x[0] is None, x[0] or "")), strict=True))
    streams = {k: [] for k in range(len(plan.sources))}
    for d in sorted(docs, key=lambda d: (d["k"], d["first"])):
        for copy in range(d["copies"] if d["size"] else 0):
            assert len(streams[d["k"]]) == d["first"] + copy * d["size"]
            streams[d["k"]] += [(d["k"], d["first"], copy)] * d["size"]
    used, got = [0] * len(plan.sources), {}
    for _, before, count in plan.counts(0, plan.shards):
        assert before.tolist() == used
        for k, n in enumerate(count.tolist()):
            perm = mx.Permutation(max(1, plan.blocks[k]), k)
            for _ in range(n):
                block = int(perm(np.array([used[k] % plan.blocks[k]]))[0])
                words_ = streams[k][block * mx.BLOCK : (block + 1) * mx.BLOCK]
                used[k] += 1
                if used[k] == plan.quota[k] and plan.trim[k]:
                    words_ = words_[: -plan.trim[k]]
                for w in words_:
                    got[w] = got.get(w, 0) + 1
    return sorted((str(d["doc_id"]), d["size"], got.get((d["k"], d["first"], c), 0) if d["size"] else 0) for d in docs for c in range(d["copies"]))


def test_taken_word_by_word(spark):
    rows = [(i % 150 if i % 7 else None, " ".join(["w"] * (i * 37 % 900)), None if i % 11 == 0 else "abcde"[i * i % 5]) for i in range(400)]
    docs = spark.createDataFrame(rows + [(9, "the same row again", "a")] * 50, "doc_id long, text string, source string").repartition(3)
    _, placed, _ = mx.prepared(docs.select("doc_id", "source", "text"))
    assert sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in mx.taken(docs).collect()) == plainly(placed.collect())
    out = mx.mixed(docs)
    assert sum(words(r["text"]) for r in out.collect()) == sum(r["taken"] for r in mx.taken(docs).collect())

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from veritrail.llm import spelling


def plain(docs, every=199, shortest=6, rarest=5, times=5):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= rarest}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    out, form = {}, {}
    for w, n in words.items():
        others = sorted((x for x in words if near(w, x)), key=lambda x: (-words[x], x))
        form[w] = others[0] if others and words[others[0]] >= times * n else None
        out[w] = (n, len(others))
    rows = set()
    for w, (n, k) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, k, words[form[w]] if form[w] else None))
    return rows


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_docs(seed, n=60):
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list("abcéÿ"), rng.integers(5, 9))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "aaaaaab", "abababab", "bababab", "zzzzzzzzzz"]
    docs = []
    for i in range(n):
        words = []
        for w in rng.choice(base, 120, p=(p := rng.dirichlet(np.full(len(base), 0.3)))).tolist():
            if rng.random() < 0.3:
                k = int(rng.integers(len(w)))
                w = [w[:k] + w[k + 1 :], w[:k] + "b" + w[k + 1 :], w[:k] + "a" + w[k:]][int(rng.integers(3))]
            words.append(w.upper() if w.isascii() and rng.random() < 0.2 else w)
        docs.append((i, ", ".join(words)))
    return docs


@pytest.mark.parametrize(("seed", "keys", "times"), [(1, 1 << 18, 5), (2, 64, 2), (3, 500, 2)])
def test_equals_plain_version(spark, monkeypatch, seed, keys, times):
    monkeypatch.setattr(spelling, "PART_KEYS", keys)
    docs = random_docs(seed)
    want = plain(docs, every=7, times=times)
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] not in (r[0], r[1]) for r in want) == (times == 2)
    assert got(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), every=7, times=times)) == want


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(spelling.op12_spelling(spark, "/root/testdata/sf0.001")) == plain([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_odd_and_empty(spark, odd):
    full, empty = odd
    docs = spark.read.parquet(f"{full}/documents.parquet").select("doc_id", "text").collect()
    assert got(spelling.op12_spelling(spark, full)) == plain([tuple(r) for r in docs])
    assert got(spelling.op12_spelling(spark, empty)) == set()


def test_long_words(spark):
    long = ["x" * 30_000, "x" * 29_999, "x" * 29_999 + "y", "q" + "x" * 29_999]
    docs = [(i, " ".join([long[0]] * 40 + long[1:])) for i in range(6)]
    rows = got(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), every=1 << 40))
    assert {(len(w), n, k, form == long[0]) for w, form, _, n, k, _ in rows} == {(30_000, 240, 3, False), (29_999, 6, 3, True), (30_000, 6, 2, True)}
    assert len(rows) == 4


def test_keys_are_those_of_the_deleted_strings():
    words = ["abcabc", "aabbcc", "zzzz", "éÿé"]
    keys, owner, place = spelling.keys_of(words)
    for k, w, p in zip(keys.tolist(), owner.tolist(), place.tolist(), strict=True):
        s = words[w] if p < 0 else words[w][: p >> 1] + words[w][(p >> 1) + 1 :]
        assert k == spelling.keys_of([s])[0][0]
        assert p < 0 or (p & 1) == (p == 1 or words[w][p >> 1] != words[w][(p >> 1) - 1])


def test_colliding_keys_do_not_count():
    words = ["abcdef", "uvwxyz", "abcdeg"]
    n = np.array([9, 8, 7])
    owner = np.repeat(np.arange(3), 7)
    place = np.tile(np.concatenate(([-1], 2 * np.arange(6) + 1)), 3)
    w, near, best = spelling.met(words, n, np.zeros(21, np.uint64), owner, place)
    assert sorted(zip(w.tolist(), near.tolist(), best.tolist(), strict=True)) == [(0, 1, 2), (2, 1, 0)]

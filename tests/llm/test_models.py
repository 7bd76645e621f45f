"""Toxicity, quality and language: what they learn on held-out rows, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from veritrail.llm import language, quality, toxicity
from veritrail.llm.base import in_fold, sampled_labels, table

SF = "/root/testdata/sf0.01"


def rank_auc(score, y):
    pos, neg = score[y == 1], score[y == 0]
    return (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()


def test_machine_learns_a_pair():
    """An insult and a group are each harmless; only both together are not."""
    rng = np.random.default_rng(1)
    rows, y = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.3, rng.random() < 0.3
        rows.append(np.array(sorted({*([1] if a else []), *([2] if b else []), *rng.integers(10, 2000, 30).tolist()})))
        y.append(float(a and b))
    m = toxicity.fit(rows[:2000], np.array(y[:2000]))
    at = {int(t): i for i, t in enumerate(m["terms"])}

    def margin(x):
        k = [at[t] for t in x.tolist() if t in at]
        return m["bias"] + m["w"][k].sum() + 0.5 * ((m["v"][k].sum(0) ** 2).sum() - (m["v"][k] ** 2).sum())

    assert np.mean([(margin(x) > 0) == t for x, t in zip(rows[2000:], y[2000:], strict=True)]) > 0.99
    assert m["v"][at[1]] @ m["v"][at[2]] > 0.3


@pytest.mark.parametrize("rows", [[], [np.array([1])], [np.array([], int)] * 5])
def test_machine_without_classes(rows):
    m = toxicity.fit(rows, np.zeros(len(rows)))
    assert len(m["terms"]) == 0 and np.isfinite(m["bias"])


def test_held_out(spark):
    labels = table(spark, SF, "labels").toPandas()
    for query, column, least in ((toxicity.op8_toxicity, "toxic", 0.85), (quality.op10_quality, "quality", 0.97)):
        out = query(spark, SF).toPandas()
        assert len(out) == 1000 and out["score"].between(0, 1).all()
        held = out.merge(labels, on="doc_id").query("held_out")
        assert rank_auc(held["score"].to_numpy(), held[column].to_numpy()) > least
        assert (out["predicted"] == (out["score"] >= (0.7 if column == "toxic" else 0.5)).astype(int)).all()


def test_labels_of_the_fold_teach_nothing(spark):
    labels = table(spark, SF, "labels")
    flipped = labels.withColumn("toxic", F.when(in_fold("doc_id", 3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic"))).withColumn("quality", F.when(in_fold("doc_id", 3, 1), 1 - F.col("quality")).otherwise(F.col("quality")))
    docs = table(spark, SF, "documents")
    for module in (toxicity, quality):
        a, b = module.train(docs, labels), module.train(docs, flipped)
        assert all(np.array_equal(a[k], b[k]) for k in a)


def test_other_columns_are_no_inputs(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy")})
    fold = in_fold("doc_id", language.PARTS, language.HELD_OUT)
    scrambled = docs.withColumns({"lang": F.when(fold, F.lit("xx")).otherwise(F.col("lang")), "source": F.lit("yy")})
    assert docs.select(language.predicted(docs, language.train(docs)).alias("p")).collect() == scrambled.select(language.predicted(scrambled, language.train(scrambled)).alias("p")).collect()
    for module in (toxicity, quality):
        assert docs.select(module.scored(docs, module.train(docs, labels)).alias("s")).collect() == other.select(module.scored(other, module.train(other, labels)).alias("s")).collect()


def test_language(spark):
    out = language.op9_language(spark, SF).toPandas()
    docs = table(spark, SF, "documents").select("doc_id", "lang").toPandas()
    held = out.merge(docs, on="doc_id").query("held_out")
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97 and out["score"].between(0, 1).all()


def test_grams_are_those_of_words():
    chunks = ["Ab", "1a2", "--", "x", "éß,"]
    found = {}
    for hashes, of in language.grams(chunks):
        for h, c in zip(hashes.tolist(), of.tolist(), strict=True):
            found.setdefault(c, []).append(h)
    # ^ab$ has 4 + 3 + 2 + 1 n-grams, ^a$ 3 + 2 + 1, ^éß$ 10
    assert {c: len(h) for c, h in found.items()} == {0: 10, 1: 6, 3: 6, 4: 10}
    assert sorted(found[1]) != sorted(found[3])


def test_filter_returns_all_languages():
    rng = np.random.default_rng(0)
    grams = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    langs = [f"l{i:03d}" for i in range(70)]
    f = language.Filter(langs, {lang: grams[i * 40 : i * 40 + 60] for i, lang in enumerate(langs)})
    hits = f.hits(grams)
    for i in range(70):
        assert hits[i * 40 : i * 40 + 60, i].all()
        assert hits[:, i].mean() < 0.05 and f.false[i] < 0.01


def test_odd_rows(spark, odd):
    for query, names in ((toxicity.op8_toxicity, 4), (quality.op10_quality, 4), (language.op9_language, 4)):
        rows = query(spark, odd[0]).collect()
        assert len(rows) == 12 and all(len(r) == names and 0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
        assert query(spark, odd[1]).count() == 0
    got = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.op9_language(spark, odd[0]).collect()}
    assert {(2, "und", 0.0), (3, "und", 0.0), (8, "und", 0.0)} <= got


def test_filters_keep_columns(spark, odd):
    docs, labels = table(spark, odd[0], "documents"), table(spark, odd[0], "labels")
    assert toxicity.not_toxic(docs, labels).columns == quality.good(docs, labels).columns == docs.columns


def test_sample_is_bounded_and_repeats(spark):
    labels = table(spark, SF, "labels")
    a = sampled_labels(labels, "toxic", 3, 1, 50).collect()
    assert len(a) == 50 and a == sampled_labels(labels.repartition(7), "toxic", 3, 1, 50).collect()


def test_neighbours_vote_exactly():
    """Scores against a plain sort by (-cosine, place in the sample), with ties of all sorts."""
    rng = np.random.default_rng(4)
    distinct = quality.unit(rng.normal(size=(40, 8)))
    for vectors in (distinct[rng.integers(0, 40, 500)], np.repeat(distinct[:1], 1000, axis=0), distinct[:7]):
        y = (rng.random(len(vectors)) < 0.5).astype(np.float32)
        if len(vectors) == 1000:
            y[:15], y[15:] = 1, 0
        model = {"prior": 0.5, "vectors": vectors, "y": y}
        docs = np.concatenate((quality.unit(rng.normal(size=(60, 8))), distinct[:10], np.zeros((1, 8))))
        got = quality.vote(model, docs)
        for x, score in zip(docs, got, strict=True):
            cosine = [sum(int(a) * int(b) for a, b in zip(x, v, strict=True)) for v in vectors]
            best = sorted(range(len(vectors)), key=lambda j: (-cosine[j], j))[: quality.NEIGHBOURS]
            weight = [min(1, max(0, cosine[j] / quality.SCALE**2)) ** quality.POWER for j in best]
            want = sum(w * float(y[j]) for w, j in zip(weight, best, strict=True)) / sum(weight) if sum(weight) > 1e-9 else 0.5
            assert abs(score - want) < 1e-9
    assert got[-1] == 0.5


def test_scores_do_not_depend_on_the_block(spark):
    docs = table(spark, SF, "documents")
    model = quality.train(docs, table(spark, SF, "labels"))
    words = quality.Words(quality.terms)
    texts = [r["text"] or "" for r in docs.select("text").limit(300).collect()]

    def scores(part):
        row, term, count = quality.matrix(part, words)
        return quality.vote(model, quality.unit(quality.times(row, term, quality.weighted(row, term, count, len(part), model["idf"]), model["projection"], len(part))))

    assert np.array_equal(scores(texts), np.concatenate([scores([t]) for t in texts]))


def test_machine_scores_by_all_pairs(spark):
    """Scores of the query's column against the sum over all pairs of terms."""
    docs = table(spark, SF, "documents")
    model = toxicity.train(docs, table(spark, SF, "labels"))
    place = {int(t): i for i, t in enumerate(model["terms"])}
    words = toxicity.Words(toxicity.buckets)
    for r in docs.select("text", toxicity.scored(docs, model).alias("s")).limit(60).collect():
        at = [place[b] for b in toxicity.document(r["text"], words) if b in place]
        z = model["bias"] + sum(model["w"][i] for i in at) + sum(float(model["v"][i] @ model["v"][j]) for k, i in enumerate(at) for j in at[:k])
        assert abs(r["s"] - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-9


def test_language_by_sets(spark):
    """The filter's predictions against plain sets of n-grams of the same languages, which have no false positives."""
    docs = table(spark, SF, "documents")
    found = language.learned(docs)
    model = language.Filter(sorted(found), found)
    texts = [r["text"] for r in docs.select("text").limit(200).collect()]
    counts = language.Counts(model)(texts)
    sets = {k: found[lang] for k, lang in enumerate(model.languages)}
    for t, c in zip(texts, counts, strict=True):
        chunks = t.split()
        exact = np.zeros(len(sets), np.int64)
        n = 0
        for hashes, _ in language.grams(chunks):
            n += len(hashes)
            exact += [np.isin(hashes, sets[k]).sum() for k in sets]
        assert n == c[0] and (c[1:] >= exact).all()
        back = (c[1:] - n * model.false) / (1 - model.false)
        assert np.abs(back - exact).max() <= 0.02 * n + 3
        top = np.sort(exact)[::-1]
        if n and top[0] - top[1] > 0.05 * n + 6:
            assert back.argmax() == exact.argmax()

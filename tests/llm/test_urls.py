import math
import random
import re

import numpy as np
import pytest
from veritrail.llm import urls
from veritrail.llm.base import table

SF = "/root/testdata/sf0.01"


def plain(url, rules):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return host, path, max(fits, key=len, default=None)


@pytest.mark.parametrize("inline", [500, 0])
@pytest.mark.parametrize("where", ["sf", "odd"])
def test_rules(spark, odd, monkeypatch, inline, where):
    monkeypatch.setattr(urls, "RULES_INLINE", inline)
    pages = table(spark, SF if where == "sf" else odd[0], "pages")
    rules = {r: v for v, r in urls.RULES}
    want = sorted(str((p["page_id"], *plain(p["url"], rules))) for p in pages.collect())
    found = urls.judged(pages, urls.RULES).collect()
    assert sorted(str((r["page_id"], r["host"], r["path"], r["rule"])) for r in found) == want
    assert all(r["verdict"] in ("allow", "block") and (r["rule"] is None or r["verdict"] == rules[r["rule"]]) for r in found)


def test_empty(spark, odd):
    assert urls.op1_urls(spark, odd[1]).count() == 0


def test_no_python_in_the_plan(spark):
    plan = urls.op1_urls(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_trees_learn_what_urls_show(spark):
    """Labels that depend on digits and parameters are learned from other URLs."""
    rows = [(i, f"http://h{i % 7}.example.org/{'9' * 12 if i % 2 else 'qwertzuiopas'}a{i:04d}" + ("?x=1&y=2&z=3" if i % 3 == 0 else "yxcvbnmasdfg")) for i in range(1200)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labelled = pages.where("page_id < 800").selectExpr("url", "cast(page_id % 2 = 1 or page_id % 3 = 0 as int) as y")
    out = urls.judged(pages, [], labelled).where("page_id >= 800").collect()
    assert sum((r["verdict"] == "block") == (r["page_id"] % 2 == 1 or r["page_id"] % 3 == 0) for r in out) / len(out) > 0.97


def test_other_labels(spark, odd):
    pages = table(spark, odd[0], "pages")
    one_class = urls.judged(pages, [("block", "com/")]).collect()
    assert len(one_class) == pages.count() and len({r["score"] for r in one_class}) == 1


def test_trees_by_brute_force():
    """Every tree against one grown row by row over all splits."""
    rnd = random.Random(5)
    cuts, names = [[0.5, 1.5, 2.5], [10.0], [0.1, 0.2, 0.3, 0.4]], ["a", "b", "c"]
    rows = [tuple(rnd.randrange(len(c) + 1) for c in cuts) for _ in range(300)]
    y = [float((a > 1) != (b > 0) or rnd.random() < 0.1 * c) for a, b, c in rows]
    w = [float(rnd.randrange(1, 4)) for _ in rows]
    prior = (sum(a * b for a, b in zip(y, w, strict=True)) + 1) / (sum(w) + 2)
    got = urls.boosted(np.array(rows), np.array(y), np.array(w), prior, cuts, names)
    margin = [math.log(prior / (1 - prior))] * len(rows)

    def parts(of, g, h):
        return sum(g[i] for i in of), sum(h[i] for i in of)

    def grown(of, depth, g, h):
        total, best = parts(of, g, h), (1e-6, None, None)
        for f in range(3):
            for i in range(len(cuts[f])):
                left = parts([k for k in of if rows[k][f] <= i], g, h)
                right = total[0] - left[0], total[1] - left[1]
                gain = sum(a * a / (b + 1) for a, b in (left, right)) - total[0] ** 2 / (total[1] + 1)
                if depth < urls.DEPTH and min(left[1], right[1]) >= urls.LEAST_WEIGHT / 4 and gain > best[0] + 1e-9:
                    best = gain, f, i
        if best[1] is None:
            for k in of:
                margin[k] -= urls.RATE * total[0] / (total[1] + 1)
            return (-urls.RATE * total[0] / (total[1] + 1),)
        low = [k for k in of if rows[k][best[1]] <= best[2]]
        return (names[best[1]], cuts[best[1]][best[2]], grown(low, depth + 1, g, h), grown([k for k in of if k not in set(low)], depth + 1, g, h))

    def alike(a, b):
        if len(a) != len(b):
            return False
        return abs(a[0] - b[0]) < 1e-9 if len(a) == 1 else a[:2] == b[:2] and alike(a[2], b[2]) and alike(a[3], b[3])

    assert len(got) == urls.TREES
    for tree in got:
        p = [1 / (1 + math.exp(-m)) for m in margin]
        assert alike(tree, grown(list(range(300)), 0, [c * (a - b) for a, b, c in zip(p, y, w, strict=True)], [c * a * (1 - a) for a, c in zip(p, w, strict=True)]))


def test_suffix_rates_do_not_leak(spark):
    """A suffix of its own for each URL tells nothing of the URL's label: what is left to learn is no more than chance."""
    rnd = random.Random(3)
    rows = [(f"http://x{i:05d}.t{i:05d}/p", rnd.randrange(2)) for i in range(3000)]
    labelled = spark.createDataFrame(rows[:2000], "url string, y int")
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    score = {r["page_id"]: r["score"] for r in urls.judged(pages, [], labelled).collect()}
    seen, y = np.array([score[i] for i in range(2000)]), np.array([t for _, t in rows[:2000]])
    assert 0.35 < (seen[y == 1][:, None] > seen[y == 0]).mean() < 0.8


def test_rules_of_equal_length(spark):
    pages = spark.createDataFrame([(1, "http://a.b.c/x"), (2, "http://b.c/x")], "page_id long, url string")
    rules = [("block", "b.c/x"), ("allow", "a.b.c"), ("allow", "b.c/"), ("block", "c/"), ("allow", "a.b.c/")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judged(pages, rules).collect()}
    assert got == {1: ("a.b.c/", "allow"), 2: ("b.c/x", "block")}


def test_sample_is_no_top_k_of_the_table(spark):
    """The table's rows are cut down by hash before any are ordered."""
    plan = urls.below(10**9, urls.MAX_ROWS)
    assert -(1 << 63) < plan < -(1 << 62) and urls.below(2 * urls.MAX_ROWS, urls.MAX_ROWS) == (1 << 63) - 1

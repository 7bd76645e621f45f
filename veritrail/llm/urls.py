"""URL filters: rules, and gradient-boosted trees on lexical features for the URLs that no rule covers.

All of it is DataFrame code. The labelled URLs are those that a rule decides (block is 1), or any rows (url, y) that a caller
gives. Features: lengths, depth, share of digits, entropy of the characters, numbers of parameters, hyphens and host
labels, and suffix statistics: the smoothed rate of label 1 by host suffix, of the last label and of the last two. A URL that is learned from
gets the rates of the other folds of the sample. Each feature is cut at quantiles of the sample; the counts by (bins, label), at
most MAX_ROWS, come to the driver, which grows the trees from them. The trees become one column expression.

The sample: at most MAX_ROWS distinct labelled URLs, the first in an order by hash of the URL. Suffixes are hashed to SUFFIX_BUCKETS
buckets, so that their statistics have a fixed size.

Defined cases: a null URL, and one without `://`, has an empty host and path, no rule, and the trees' verdict; of rules of equal
length the first in code point order decides; a URL with several labels teaches the largest; without two classes to learn from every
URL scores the smoothed rate; repeated rows are judged each; other columns, of whatever name, are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import below, stored

ALLOW, BLOCK = "allow", "block"
MAX_ROWS = 20_000
SUFFIX_BUCKETS = 512
#: Parts of the sample whose suffix rates come from the other parts.
FOLDS = 4
BINS = 16
TREES, DEPTH, RATE, LEAST_WEIGHT = 12, 3, 0.3, 5.0
#: Rules that become one expression; more are joined by host suffix, and broadcast up to so many (some 200 bytes each).
RULES_INLINE, RULES_BROADCAST = 500, 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "parameters", "hyphens", "suffix", "suffix2")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def split(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path)."""
    url = F.col("url").cast("string")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))


def ruled(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """urls with columns rule and decision: the longest rule that fits, and what it says; null where none fits.

    A rule is host and path in one, such as `example.com/en/`; it fits its host and all subdomains if the path starts with its path."""
    known = sorted({r: v for v, r in rules}.items(), key=lambda x: (-len(x[0]), x[0]))
    parts = [(r.partition("/")[0], "/" + r.partition("/")[2], r, v) for r, v in known]
    if len(parts) <= RULES_INLINE:
        rule, decision = F.lit(None).cast("string"), F.lit(None).cast("string")
        for host, path, r, v in reversed(parts):
            fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
            rule, decision = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(decision)
        return urls.withColumns({"rule": rule, "decision": decision})
    table = urls.sparkSession.createDataFrame(parts, "r_host string, r_path string, r_rule string, r_decision string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    if len(parts) <= RULES_BROADCAST:
        table = F.broadcast(table)  # or the planner may take the pages' side, which grows
    # only hosts and paths meet the rules; what was found for them comes back to their rows
    pairs = urls.select("host", "path").distinct().select(F.col("host").alias("p_host"), F.col("path").alias("p_path"), F.explode(suffixes).alias("s"))
    met = pairs.join(table, (F.col("s") == F.col("r_host")) & F.col("p_path").startswith(F.col("r_path")))
    best = met.groupBy("p_host", "p_path").agg(F.min_by(F.struct("r_rule", "r_decision"), F.struct(-F.length("r_rule"), F.col("r_rule"))).alias("b"))
    out = urls.join(best, (F.col("host") == F.col("p_host")) & (F.col("path") == F.col("p_path")), "left")
    return out.select(*urls.columns, F.col("b.r_rule").alias("rule"), F.col("b.r_decision").alias("decision"))


def count_of(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def suffix_bucket(host: Column, labels: int) -> Column:
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -labels)), F.lit(SUFFIX_BUCKETS)).cast("int")


def lexical() -> dict[str, Column]:
    """The features that come from the URL alone, over columns url, host and path."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    letters = F.array_distinct(F.split(url, ""))
    shares = F.transform(letters, lambda c: F.when(c == "", F.lit(0.0)).otherwise((F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size))
    entropy = F.aggregate(shares, F.lit(0.0), lambda a, p: a + F.when(p > 0, -p * F.log2(F.when(p > 0, p).otherwise(F.lit(1.0)))).otherwise(F.lit(0.0)))
    return {
        "length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": count_of(F.col("path"), "/").cast("double"),
        "labels": count_of(F.col("host"), ".").cast("double"),
        "digits": (F.length(url) - F.length(F.translate(url, "0123456789", ""))) / size,
        "entropy": entropy,
        "parameters": F.when(F.instr(url, "?") > 0, count_of(F.substring_index(url, "?", -1), "&") + 1).otherwise(F.lit(0)).cast("double"),
        "hyphens": count_of(F.col("host"), "-").cast("double"),
    }


def numbers(values) -> Column:
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


class Trees:
    """Boosted trees as a column expression over columns url, host and path."""

    def __init__(self, prior: float, rates: dict[str, np.ndarray] | None = None):
        self.prior, self.rates = prior, rates or {}
        self.cuts: dict[str, list[float]] = {}
        self.trees: list[tuple] = []

    def features(self, rates: dict[str, np.ndarray] | None = None, fold: Column | None = None) -> dict[str, Column]:
        """All features; rates: by bucket, or by bucket and fold."""
        out, rates = lexical(), rates if rates is not None else self.rates
        for name, labels in (("suffix", 1), ("suffix2", 2)):
            bucket = suffix_bucket(F.col("host"), labels)
            place = bucket if fold is None else bucket * FOLDS + fold
            out[name] = F.element_at(numbers(rates[name].ravel()), place + 1) if name in rates else F.lit(self.prior)
        return out

    def node_value(self, node: tuple) -> Column:
        if len(node) == 1:
            return F.lit(node[0])
        feature, cut, low, high = node
        return F.when(F.col(f"f_{feature}") <= cut, self.node_value(low)).otherwise(self.node_value(high))

    def margin(self) -> Column:
        out = F.lit(math.log(self.prior / (1 - self.prior)))
        for tree in self.trees:
            out = out + self.node_value(tree)
        return out


def fit(labelled: DataFrame, max_rows: int = MAX_ROWS) -> Trees:
    """Trees for rows (url, host, path, y)."""
    rows = labelled.select(F.coalesce("url", F.lit("")).alias("url"), "host", "path", F.col("y").cast("double").alias("y"))
    limit = below(rows.agg(F.approx_count_distinct("url")).first()[0], max_rows)
    sample = rows.where(F.xxhash64("url") <= limit).groupBy("url", "host", "path").agg(F.max("y").alias("y"))
    sample = stored(sample.orderBy(F.xxhash64("url"), "url").limit(max_rows).withColumn("fold", F.pmod(F.xxhash64("url", F.lit(1)), F.lit(FOLDS)).cast("int")), "urls")
    suffixes = F.array(*[F.struct(F.lit(name).alias("name"), suffix_bucket(F.col("host"), labels).alias("b")) for name, labels in (("suffix", 1), ("suffix2", 2))])
    found = sample.select("fold", "y", F.explode(suffixes).alias("s")).groupBy("s.name", "s.b", "fold").agg(F.count("*").alias("n"), F.sum("y").alias("ones")).collect()
    counts = {name: np.zeros((2, SUFFIX_BUCKETS, FOLDS)) for name in ("suffix", "suffix2")}
    for r in found:
        counts[r["name"]][:, r["b"], r["fold"]] = r["n"], r["ones"]
    n, ones = counts["suffix"].sum((1, 2)).tolist()
    model = Trees((ones + 1) / (n + 2))
    if n < 2 or ones in (0.0, n):
        return model
    others = {}
    for name, c in counts.items():
        total = c.sum(2, keepdims=True)
        model.rates[name] = ((total[1] + 4 * model.prior) / (total[0] + 4))[:, 0]
        others[name] = ((total - c)[1] + 4 * model.prior) / ((total - c)[0] + 4)
    sample = stored(sample.select("y", *[c.alias(f"f_{k}") for k, c in model.features(others, F.col("fold")).items()]), "features")
    quantiles = sample.approxQuantile([f"f_{k}" for k in FEATURES], [i / BINS for i in range(1, BINS)], 1 / (4 * BINS))
    model.cuts = {k: sorted(set(q)) for k, q in zip(FEATURES, quantiles, strict=True)}
    bins = {k: F.coalesce(*[F.when(F.col(f"f_{k}") <= c, F.lit(i)) for i, c in enumerate(model.cuts[k])], F.lit(len(model.cuts[k]))) for k in FEATURES if model.cuts[k]}
    rows = sample.groupBy("y", *[c.alias(k) for k, c in bins.items()]).agg(F.count("*").alias("w")).collect()  # max_rows at most
    rows = np.array(sorted(map(tuple, rows)), float)
    model.trees = boosted(rows[:, 1:-1].astype(int), rows[:, 0], rows[:, -1], model.prior, [model.cuts[k] for k in bins], list(bins))
    return model


def boosted(bins: np.ndarray, y: np.ndarray, w: np.ndarray, prior: float, cuts: list[list[float]], names: list[str]) -> list[tuple]:
    """Trees for rows of bins (row, feature) with label y and weight w, each on the gradients that the trees before leave.

    A split is at the first feature and cut of the largest gain; a node is (value,) or (feature, cut, node up to the cut, node above)."""
    margin, trees, wide = np.full(len(y), math.log(prior / (1 - prior))), [], max(map(len, cuts), default=0) + 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)

        def grow(rows: np.ndarray, depth: int) -> tuple:
            sum_g, sum_h, best = g[rows].sum(), h[rows].sum(), (1e-6, 0, 0)
            for f in range(len(cuts)) if depth < DEPTH else ():
                left_g, left_h = (np.cumsum(np.bincount(bins[rows, f], x[rows], wide))[: len(cuts[f])] for x in (g, h))
                right_g, right_h = sum_g - left_g, sum_h - left_h
                gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - sum_g**2 / (sum_h + 1)
                gain[np.minimum(left_h, right_h) < LEAST_WEIGHT / 4] = 0
                for i in range(len(gain)):
                    if gain[i] > best[0] + 1e-9:
                        best = (gain[i], f, i)
            if best[0] <= 1e-6:
                value = float(-RATE * sum_g / (sum_h + 1))
                margin[rows] += value
                return (value,)
            below = bins[rows, best[1]] <= best[2]
            return (names[best[1]], cuts[best[1]][best[2]], grow(rows[below], depth + 1), grow(rows[~below], depth + 1))

        trees.append(grow(np.arange(len(y)), 0))
    return trees


def judged(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page; score: the trees' probability of block.

    labelled: rows (url, y) to learn from instead of what the rules decide."""
    urls = ruled(split(pages), rules)
    if labelled is None:
        known = urls.where("decision is not null").withColumn("y", (F.col("decision") == BLOCK).cast("int"))
    else:
        url = F.col("url").cast("string")
        known = labelled.where("y is not null").select(url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"), F.col("y").cast("int").alias("y"))
    model = fit(known)
    rows = urls.select("*", *[c.alias(f"f_{k}") for k, c in model.features().items()])
    rows = rows.withColumn("score", 1 / (1 + F.exp(-model.margin())))
    verdict = F.coalesce("decision", F.when(F.col("score") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


RULES = [(ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/")]


def op1_urls(spark, sf_dir: str) -> DataFrame:
    from .base import table

    return judged(table(spark, sf_dir, "pages"), RULES)

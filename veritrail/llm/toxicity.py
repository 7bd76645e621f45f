"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(bias + sum of weights + half the sum over factors of (squared sum - sum of squares)), over the
letter runs of the lower-cased text and their beginnings, hashed to 2**HASH_BITS buckets. The pairwise part gives a pair of terms, such as an
insult with a group, a weight that neither has alone.

The machine is fitted on the driver on a bounded sample: at most MAX_ROWS labelled documents outside the held-out fold,
the first in an order by hash of their ids, and of them as many as have MAX_TERMS terms together. Mini-batches with
adaptive steps. Only the terms that keep a weight or factors are broadcast (at most one entry a bucket).

Defined cases: a null or empty text has no terms and scores the bias; without two classes to learn from the score is the
smoothed rate of label 1; null labels and ids teach nothing; of several texts under one id one teaches; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import LETTERS, Words, in_fold, kept, sampled_labels, stored

HASH_BITS = 20
MAX_ROWS = 12_000
MAX_TERMS = 4_000_000
FACTORS = 4
#: Lengths of the beginnings of words that are terms too: insults inflect.
STEMS = (4, 5, 6, 7, 8)
L2, L2_PAIR = 1e-4, 3e-3
PAIR_SHARE = 20
REJECT = 0.7
PARTS, HELD_OUT = 3, 1


def buckets(chunk: str) -> tuple[int, ...]:
    """Buckets of the words of a chunk and of their beginnings."""
    found = set()
    for w in LETTERS.findall(chunk.lower()):
        found.update(zlib.crc32(x.encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1) for x in {w, *(w[:n] + "-" for n in STEMS if len(w) > n)})
    return tuple(found)


#: A bucket that two, three or more of a text's distinct words share is a term for each of those counts too.
AGAIN = (0, 0x5A5A5, 0x3C3C3)


def document(text: str | None, words: Words) -> list[int]:
    """The terms of a text; words: a cache of the buckets of its chunks."""
    counts = Counter(chain.from_iterable(map(words.__getitem__, set((text or "").split()))))
    return sorted({b ^ salt for b, n in counts.items() for salt in AGAIN[:n]})


def fit(rows: list[np.ndarray], y: np.ndarray, factors: int = FACTORS, z: float = 3.0, rate: float = 0.2, seed: int = 7) -> dict:
    """Bias, and for each term that counts its bucket, weight and factors.

    A term has a weight if the label's rate among its documents is z standard errors from the rate of all. It has factors
    if it has a weight or is in one of PAIR_SHARE documents, as a pair can tell what neither of its terms tells alone."""
    n = len(y)
    prior = (y.sum() + 1) / (n + 2)
    bias = float(np.log(prior / (1 - prior)))
    none = {"bias": bias, "terms": np.zeros(0, np.int64), "w": np.zeros(0), "v": np.zeros((0, factors))}
    if n < 2 or y.min() == y.max():
        return none
    lengths = np.fromiter(map(len, rows), np.int64, n)
    row = np.repeat(np.arange(n, dtype=np.int32), lengths)
    at = np.concatenate(rows).astype(np.int32)
    df = np.bincount(at)  # by bucket, of which there are few enough
    terms = np.nonzero(df)[0]
    number = np.zeros(len(df), np.int32)
    number[terms] = np.arange(len(terms), dtype=np.int32)
    at, df = number[at], df[terms]
    mean = y.mean()
    apart = np.abs(np.bincount(at, (y - mean)[row], len(terms))) / np.sqrt(df * mean * (1 - mean))
    strong = (df >= 2) & (apart >= z)
    keep = strong | (df >= max(30, n / PAIR_SHARE))
    if not keep.any():
        return none
    number = np.cumsum(keep) - 1
    row, at, terms, strong = row[keep[at]], number[at[keep[at]]], terms[keep], strong[keep]
    m = len(terms)
    starts = np.searchsorted(row, np.arange(n + 1))
    rng = np.random.default_rng(seed)
    w, v = np.zeros(m), rng.normal(0, 0.01, (m, factors))
    gw, gv, gb = np.full(m, 1e-8), np.full((m, factors), 1e-8), 1e-8
    batch = min(256, max(32, n // 16))
    # the rarer label counts for more, up to the square root of the ratio of both
    weight = np.where(y == (mean < 0.5), np.sqrt(max(mean, 1 - mean) / min(mean, 1 - mean)), 1.0)
    for _ in range(max(20, -(-1200 * batch // n))):
        order = rng.permutation(n)
        for k in range(0, n, batch):
            pick = order[k : k + batch]
            size = starts[pick + 1] - starts[pick]
            i = np.repeat(starts[pick] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            t, r = at[i], np.repeat(np.arange(len(pick)), size)
            sums = np.stack([np.bincount(r, v[t, f], len(pick)) for f in range(factors)], axis=1)
            squares = np.bincount(r, (v**2).sum(1)[t], len(pick))
            p = bias + np.bincount(r, w[t], len(pick)) + 0.5 * ((sums**2).sum(1) - squares)
            g = weight[pick] * (1 / (1 + np.exp(-np.clip(p, -30, 30))) - y[pick]) / len(pick)
            dw = (np.bincount(t, g[r], m) + L2 * w) * strong
            dv = np.stack([np.bincount(t, (g[:, None] * sums)[r, f], m) for f in range(factors)], axis=1) - v * np.bincount(t, g[r], m)[:, None] + L2_PAIR * v
            gw, gv, gb = gw + dw**2, gv + dv**2, gb + g.sum() ** 2
            w -= rate / np.sqrt(gw) * dw
            v -= 0.1 * rate / np.sqrt(gv) * dv
            bias -= rate / np.sqrt(gb) * g.sum()
    v[np.sqrt((v**2).sum(1)) < 0.05] = 0
    keep = (w != 0) | (v != 0).any(axis=1)
    return {"bias": float(bias), "terms": terms[keep], "w": w[keep], "v": v[keep]}


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS, max_terms: int = MAX_TERMS) -> dict:
    chosen = sampled_labels(labels, label, PARTS, HELD_OUT, max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id")).select("doc_id", "y", "text")

    def terms(batches):
        words = Words(buckets)
        for b in batches:
            found = [np.array(document(t, words), np.int32) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("y").cast(pa.int32()), pa.array([len(x) for x in found], pa.int32()), pa.array([x.astype("<i4").tobytes() for x in found], pa.binary())], names=["doc_id", "y", "n", "terms"])

    found = rows.mapInArrow(terms, "doc_id long, y int, n int, terms binary").groupBy("doc_id", "y").agg(F.min(F.struct("n", "terms")).alias("t"))
    found = stored(found.select("doc_id", "y", "t.*", F.xxhash64("doc_id").alias("h")), "terms")
    sizes = found.select("h", "n").orderBy("h").collect()  # a row a labelled document, max_rows at most
    upto = np.cumsum([r["n"] for r in sizes]) if sizes else np.zeros(0)
    if len(upto) and upto[-1] > max_terms:
        found = found.where(F.col("h") <= F.lit(sizes[max(0, int(np.searchsorted(upto, max_terms, "right")) - 1)]["h"]))
    got = sorted(found.collect(), key=lambda r: (r["h"], r["doc_id"]))
    return fit([np.frombuffer(r["terms"], "<i4") for r in got], np.array([r["y"] for r in got], float))


def scored(docs: DataFrame, model: dict):
    """A column with the score of each text."""
    place = {int(t): i for i, t in enumerate(model["terms"])}
    token = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast((model["bias"], place, model["w"], model["v"]))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        bias, place, w, v = shared.value
        words = kept(token, lambda: Words(lambda c: tuple(b for b in buckets(c) if any(b ^ salt in place for salt in AGAIN))))
        out = []
        for t in texts:
            at = [place[b] for b in document(t, words) if b in place]
            z = bias
            if at:
                z += w[at].sum() + 0.5 * ((v[at].sum(0) ** 2).sum() - (v[at] ** 2).sum())
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return pd.Series(out, dtype=float)

    return score(F.col("text"))


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below REJECT."""
    return docs.where(scored(docs, train(docs, labels)) < REJECT)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    from .base import table

    docs = table(spark, sf_dir, "documents")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), in_fold("doc_id", PARTS, HELD_OUT).alias("held_out"), scored(docs, train(docs, table(spark, sf_dir, "labels"))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))

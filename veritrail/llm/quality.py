"""Quality by nearest-neighbour voting among latent-semantic vectors.

A document's terms are its words and the shapes of its chunks between blanks (case, digits, punctuation), with the
number of chunks that repeat the one before and of lines that repeat an earlier one. Weighted by log counts and inverse document
frequency they are projected onto the leading right singular vectors of the labelled sample's term matrix. Each
document's vector is compared with every labelled vector, in blocks; the NEIGHBOURS of largest cosine vote, weighted by
a power of the cosine. Components of unit vectors are whole multiples of 1 / SCALE, so that cosines are sums of integers: exact, and
the same for equal texts whatever stands beside them in a block.

The sample: at most MAX_ROWS labelled documents outside the held-out fold, the first in an order by hash of their ids.
Broadcast are the projection (TERMS x DIMS) and the labelled vectors (MAX_ROWS x DIMS), both of fixed size.

Defined cases: a text without terms, a null one too, gets the smoothed rate of label 1, and so does every text if there are no labels;
of labelled rows with equal cosine the first in the sample's order count; null labels and ids teach nothing; of several texts under one id
one teaches; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import LETTERS, Words, in_fold, kept, sampled_labels

MAX_ROWS = 4096
WORD_BITS, SHAPE_BITS = 14, 11
SHAPES = 1 << WORD_BITS
TERMS = SHAPES + (1 << SHAPE_BITS) + 2
DIMS = 48
SCALE = 1 << 18
NEIGHBOURS = 15
POWER = 4
WORD_SHARE = 0.35
REJECT = 0.5
PARTS, HELD_OUT = 3, 1
_DIGITS = re.compile(r"\d+")


def terms(chunk: str) -> tuple[int, ...]:
    """The word terms of a chunk and its shape."""
    words = [zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) & (SHAPES - 1) for w in LETTERS.findall(chunk)]
    shape = LETTERS.sub(lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a", _DIGITS.sub("0", chunk))
    return (*words, SHAPES + (zlib.crc32(shape.encode("utf-8", "surrogatepass")) & ((1 << SHAPE_BITS) - 1)))


def matrix(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of the texts' terms, by row and term."""
    row, term, count = [], [], []
    for i, t in enumerate(texts):
        chunks = t.split()
        for c, n in Counter(chunks).items():
            for x in words[c]:
                row.append(i)
                term.append(x)
                count.append(n)
        lines = t.split("\n")
        for x, n in ((TERMS - 2, sum(map(eq, chunks, chunks[1:]))), (TERMS - 1, len(lines) - len(set(lines)))):
            if n:
                row.append(i)
                term.append(x)
                count.append(n)
    key = np.array(row, np.int64) * TERMS + np.array(term, np.int64)
    key, at = np.unique(key, return_inverse=True)
    return key // TERMS, key % TERMS, np.bincount(at, np.array(count, float), len(key))


def weighted(row: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """Values of the matrix: words and shapes of a document have fixed shares of its length."""
    value = np.log1p(count) * idf[term]
    for part, share in ((term < SHAPES, WORD_SHARE), (term >= SHAPES, 1 - WORD_SHARE)):
        length = np.sqrt(np.bincount(row[part], value[part] ** 2, n))
        value[part] *= np.sqrt(share) / np.maximum(length[row[part]], 1e-12)
    return value


def times(row: np.ndarray, col: np.ndarray, value: np.ndarray, dense: np.ndarray, n: int) -> np.ndarray:
    """The sparse matrix, sorted by row, times a dense one."""
    out = np.zeros((n, dense.shape[1]))
    starts = np.concatenate(([0], np.nonzero(np.diff(row))[0] + 1, [len(row)])) if len(row) else np.zeros(1, np.int64)
    i = 0
    while i < len(starts) - 1:  # whole rows of the matrix at a time: their sums do not depend on the rows beside them
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + 100_000, "right")) - 1)
        a, b = starts[i], starts[j]
        out[row[starts[i:j]]] = np.add.reduceat(dense[col[a:b]] * value[a:b, None], starts[i:j] - a, axis=0)
        i = j
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one in multiples of 1 / SCALE, as whole numbers."""
    return np.rint(x / np.maximum(np.sqrt((x**2).sum(1, keepdims=True)), 1e-12) * SCALE)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 7) -> dict:
    """rows: terms and counts of each labelled document."""
    n = len(y)
    prior = float((y.sum() + 1) / (n + 2))
    if not n or not sum(len(t) for t, _ in rows):
        return {"prior": prior, "idf": np.zeros(TERMS, np.float32), "projection": np.zeros((TERMS, 1), np.float32), "vectors": np.zeros((0, 1)), "y": np.zeros(0, np.float32)}
    row = np.repeat(np.arange(n), [len(t) for t, _ in rows])
    term, count = np.concatenate([t for t, _ in rows]).astype(np.int64), np.concatenate([c for _, c in rows]).astype(float)
    df = np.bincount(term, minlength=TERMS)
    idf = np.where(df > 1, np.log((n + 1) / (df + 0.5)) + 0.1, 0)
    idf[SHAPES:] = np.where(df[SHAPES:] > 0, np.maximum(idf[SHAPES:], 1.0), 0)
    value = weighted(row, term, count, n, idf)
    by_term = np.argsort(term, kind="stable")
    t_row, t_term, t_value = row[by_term], term[by_term], value[by_term]
    dims = min(DIMS, n)
    q = np.random.default_rng(seed).normal(size=(TERMS, min(dims + 12, n)))
    for _ in range(3):
        q, _ = np.linalg.qr(times(row, term, value, q, n))
        q = times(t_term, t_row, t_value, q, TERMS)
    basis, _, _ = np.linalg.svd(q, full_matrices=False)
    projection = basis[:, :dims]
    vectors = unit(times(row, term, value, projection, n))
    return {"prior": prior, "idf": idf.astype(np.float32), "projection": projection.astype(np.float32), "vectors": vectors, "y": y.astype(np.float32)}


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> dict:
    chosen = sampled_labels(labels, label, PARTS, HELD_OUT, max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id")).select("doc_id", "y", "text")

    def counted(batches):
        words = Words(terms)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            row, term, count = matrix(texts, words)
            cuts = np.searchsorted(row, np.arange(1, len(texts)))
            parts = [pa.array([np.asarray(x, kind).tobytes() for x in np.split(v, cuts)][: len(texts)], pa.binary()) for v, kind in ((term, "<i4"), (count, "<f4"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("y").cast(pa.int32()), *parts], names=["doc_id", "y", "terms", "counts"])

    found = rows.mapInArrow(counted, "doc_id long, y int, terms binary, counts binary").groupBy("doc_id", "y").agg(F.min(F.struct("terms", "counts")).alias("t"))
    got = sorted(found.select("doc_id", "y", "t.*", F.xxhash64("doc_id").alias("h")).collect(), key=lambda r: (r["h"], r["doc_id"]))  # one row an id, max_rows at most
    return fit([(np.frombuffer(r["terms"], "<i4"), np.frombuffer(r["counts"], "<f4")) for r in got], np.array([r["y"] for r in got], float))


def vote(model: dict, vectors: np.ndarray) -> np.ndarray:
    """Scores of vectors as `unit` makes them; a zero vector gets the prior."""
    n = len(model["y"])
    if not n:
        return np.full(len(vectors), model["prior"])
    # one number for cosine and place in the sample: among equal cosines the first in the sample is the largest
    rank = (vectors @ model["vectors"].T) * n + np.arange(n)[::-1]
    k = min(NEIGHBOURS, n)
    near = np.argpartition(-rank, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(k), (len(rank), 1))
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(rank, near, axis=1), axis=1), axis=1)
    cosine = (np.take_along_axis(rank, near, axis=1) - (n - 1 - near)) / n / SCALE**2
    weight = np.clip(cosine, 0, 1) ** POWER
    total = weight.sum(1)
    return np.where(total > 1e-9, (weight * model["y"][near]).sum(1) / np.maximum(total, 1e-9), model["prior"])


def scored(docs: DataFrame, model: dict):
    """A column with the score of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        m, words, out = shared.value, kept("quality", lambda: Words(terms, 200_000)), []
        texts = [t or "" for t in texts]
        for k in range(0, len(texts), 256):
            part = texts[k : k + 256]
            row, term, count = matrix(part, words)
            vectors = times(row, term, weighted(row, term, count, len(part), m["idf"]), m["projection"], len(part)) if len(row) else np.zeros((len(part), m["projection"].shape[1]))
            out.append(vote(m, unit(vectors)))
        return pd.Series(np.clip(np.concatenate(out), 0, 1) if out else [], dtype=float)

    return score(F.col("text"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score at least REJECT."""
    return docs.where(scored(docs, train(docs, labels)) >= REJECT)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    from .base import table

    docs = table(spark, sf_dir, "documents")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), in_fold("doc_id", PARTS, HELD_OUT).alias("held_out"), scored(docs, train(docs, table(spark, sf_dir, "labels"))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))

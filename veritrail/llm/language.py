"""Language identification by language-bitmask n-gram filters.

One Bloom filter for all languages: each of 2**SLOT_BITS places holds a bitmask of languages. An n-gram (one to four letters of a
word with its edges) sets its language's bit at HASHES places; the conjunction of those masks returns all languages that
contain an n-gram. A document's hits are counted for each language over all its n-grams, with repeats, and corrected for false
positives: a language whose bit stands at a share f of the places answers a foreign n-gram with probability f**HASHES.
The language with the most corrected hits wins.

What a language contains are the n-grams that make at least one in FLOOR of its sampled n-grams, so at most FLOOR. The
sample: of each language up to BUCKETS x PER_BUCKET documents outside the held-out fold, the first by hash of their ids in each of
BUCKETS hash buckets. The filter's size is fixed: 2**SLOT_BITS masks of one word for each 64 languages; more than MAX_LANGUAGES
languages are refused.

Defined cases: `und` with score 0 where the text is null, has no letter, or nothing was learned; ties go to the first language in code point order;
rows with null lang or id teach nothing; repeated rows are predicted each; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import CACHE_WORDS, cut, groups, in_fold, kept

SLOT_BITS, HASHES = 19, 4
GRAMS = (1, 2, 3, 4)
FLOOR = 20_000
BUCKETS, PER_BUCKET = 64, 16
MAX_LANGUAGES = 512
PARTS, HELD_OUT = 4, 2


_IS_LETTER: dict[int, bool] = {}


def grams(chunks: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of n-gram the hashes of those of all chunks, lower-cased, and the numbers of the chunks that they are in.

    Words are the chunks' runs of letters, with an edge before and after."""
    code = np.frombuffer(" ".join(chunks).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    distinct, at = np.unique(code, return_inverse=True)
    letter = np.array([_IS_LETTER.setdefault(c, chr(c).isalpha()) for c in distinct.tolist()], bool)[at]
    chunk = np.cumsum(code == 32)
    edge = np.diff(np.concatenate(([False], letter, [False])).astype(np.int8))
    begin, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    if not len(begin):
        return
    # words one after another, each as edge, letters, edge
    size = end - begin + 2
    word = np.repeat(np.arange(len(begin)), size)
    first = np.cumsum(size) - size
    inner = np.ones(len(word), bool)
    inner[first] = inner[first + size - 1] = False
    codes = np.full(len(word), 94, np.uint64)
    codes[first + size - 1] = 36
    codes[inner] = code[letter]
    of = chunk[begin][word]
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        last = len(codes) - n + 1
        if last <= 0:
            return
        h = h[:last] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
        if n in GRAMS:
            whole = word[:last] == word[n - 1 :]
            z = h[whole]
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            yield z ^ (z >> np.uint64(31)), of[:last][whole]


def places(hashes: np.ndarray) -> np.ndarray:
    """The HASHES places of each n-gram, by double hashing."""
    a, b = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return ((a[:, None] + np.arange(HASHES, dtype=np.uint64) * b[:, None]) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


class Filter:
    def __init__(self, languages: list[str], found: dict[str, np.ndarray]):
        self.languages = languages
        self.words = max(1, -(-len(languages) // 64))
        self.masks = np.zeros((1 << SLOT_BITS, self.words), np.uint64)
        for k, lang in enumerate(languages):
            at = np.unique(places(found[lang]))
            self.masks[at, k // 64] |= np.uint64(1 << (k % 64))
        self.false = np.array([(((self.masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()) ** HASHES for k in range(len(languages))])

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram which languages contain it: a matrix of 0 and 1."""
        masks = np.bitwise_and.reduce(self.masks[places(hashes)], axis=1)
        bits = np.unpackbits(masks.view(np.uint8).reshape(len(hashes), -1), axis=1, bitorder="little")
        return bits[:, : len(self.languages)]


def learned(docs: DataFrame) -> dict[str, np.ndarray]:
    """The n-grams that each language contains."""
    known = docs.select(F.col("doc_id").alias("k_id"), F.col("lang").cast("string").alias("k_lang"))
    known = known.where(F.col("k_id").isNotNull() & F.col("k_lang").isNotNull() & ~in_fold("k_id", PARTS, HELD_OUT))
    languages = [r["k_lang"] for r in known.select("k_lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    order = Window.partitionBy("k_lang", F.pmod(F.xxhash64("k_id"), F.lit(BUCKETS))).orderBy(F.xxhash64("k_id", F.lit(1)), "k_id")
    chosen = known.withColumn("k", F.row_number().over(order)).where(F.col("k") <= PER_BUCKET).select("k_id", "k_lang").distinct()
    rows = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), (F.col("doc_id") == F.col("k_id")) & (F.col("lang") == F.col("k_lang"))).select("k_lang", "text")

    def count(batches):
        for b in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(b.column("k_lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update((text or "").split())
            for lang, own in words.items():
                times = np.fromiter(own.values(), np.int64, len(own))
                for hashes, of in grams(list(own)):
                    keys, at = np.unique(hashes, return_inverse=True)
                    counts = np.bincount(at, times[of], len(keys)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])

    counts = cut(rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    floors = counts.groupBy(F.col("lang").alias("f_lang")).agg((F.sum("n") / FLOOR).alias("floor"))
    # FLOOR n-grams of each language at most
    got = counts.join(F.broadcast(floors), F.col("lang") == F.col("f_lang")).where("n >= floor").groupBy("lang").agg(F.collect_list("gram").alias("grams")).toArrow()
    return {lang: np.array(grams, np.int64).view(np.uint64) for lang, grams in zip(got["lang"].to_pylist(), (g.values.to_numpy() for g in got["grams"]), strict=True)}


def train(docs: DataFrame) -> Filter:
    found = learned(docs)
    return Filter(sorted(found), found)


class Counts:
    """Number of n-grams and hits of each chunk that a worker has met."""

    def __init__(self, model: Filter):
        self.model = model
        self.start()

    def start(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, 1 + len(self.model.languages)), np.int32)

    def __call__(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.start()
        counted = [Counter(t.split()) for t in texts]
        new = list(set().union(*counted).difference(self.known))
        if new:
            rows = np.zeros((len(new), self.rows.shape[1]), np.int32)
            for hashes, of in grams(new):
                rows[:, 0] += np.bincount(of, minlength=len(new)).astype(np.int32)
                for k in range(0, len(hashes), 1 << 18):
                    part, hits = of[k : k + (1 << 18)], self.model.hits(hashes[k : k + (1 << 18)])
                    first = np.concatenate(([0], np.nonzero(np.diff(part))[0] + 1))
                    rows[part[first], 1:] += np.add.reduceat(hits.astype(np.int32), first, axis=0)
            self.known.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.rows = np.concatenate((self.rows, rows))
        out = np.zeros((len(texts), self.rows.shape[1]), np.int64)
        for i, c in enumerate(counted):
            if c:
                at = np.fromiter(map(self.known.__getitem__, c), np.int64, len(c))
                out[i] = np.fromiter(c.values(), np.int64, len(c)) @ self.rows[at].astype(np.int64)
        return out


def predicted(docs: DataFrame, model: Filter):
    """A column (lang_pred, score) for each text; the score is the winner's share of the two best languages' hits."""
    token = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m, langs, scores = shared.value, [], []
        counts = kept(token, lambda: Counts(m))
        for part in groups([t or "" for t in texts]):
            c = counts(part)
            n, hits = c[:, 0], c[:, 1:].astype(float)
            if not m.languages:
                langs += ["und"] * len(part)
                scores += [0.0] * len(part)
                continue
            hits = np.maximum(0, (hits - n[:, None] * m.false) / (1 - np.minimum(m.false, 0.999)))
            best = hits.argmax(axis=1)
            ranked = -np.sort(-hits, axis=1)
            second = ranked[:, 1] if ranked.shape[1] > 1 else np.zeros(len(part))
            langs += [m.languages[k] if x else "und" for k, x in zip(best, n, strict=True)]
            scores += np.where(n > 0, ranked[:, 0] / np.maximum(ranked[:, 0] + second, 1e-9), 0).tolist()
        return pd.DataFrame({"lang_pred": pd.Series(langs, dtype=object), "score": pd.Series(scores, dtype=float)})

    return predict(F.col("text"))


def op9_language(spark, sf_dir: str) -> DataFrame:
    from .base import table

    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), in_fold("doc_id", PARTS, HELD_OUT).alias("held_out"), predicted(docs, train(docs)).alias("p")).select("doc_id", "held_out", "p.*")

"""Spelling variants: words one edit apart, and the form that each stands for.

Words are counted over all texts. Every word gets a key for itself and one for each of its deletions (the word less one code point),
from polynomial hashes of its beginnings and ends, as arrays over a whole batch. Keys are dealt by their top bits into as many parts as their number
asks for, and sorted there; what meets is verified on the strings. Words of a length differ in one code point where the same deletion at the
same place makes them equal; a word is another's deletion where its own key meets one of the other's. A word has one such key of
each pair: of a run of equal code points only the first is deleted for that. So neighbours are counted, and the most frequent one is found, by
runs of keys; no pairs are made. A part gets a word once, with all of its keys that fall there, so that a long word is not copied for each.

Defined cases: a null text holds no words; a null doc_id counts as an empty text in the hash; repeated rows count as often as they are given;
words of equal frequency go by code points; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut, stored

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys of a part, about.
PART_KEYS = 1 << 18
#: An odd base and its inverse modulo 2**64, and the multiplier that spreads a hash over the top bits. Fixed: keys of all tasks must agree.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SPREAD = np.uint64(0xD6E8FEB86659FD93)


def misspelt(doc_id: Column, run: Column, every: int) -> Column:
    """The run, less a code point where `every` divides its hash with the document's id."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, every: int = 199, shortest: int = 6, rarest: int = 5) -> DataFrame:
    """(word, n) of the words of at least `shortest` code points that occur at least `rarest` times."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))
    found = docs.select(F.col("doc_id"), F.explode(runs).alias("run")).where(F.length("run") >= shortest)
    words = found.select(misspelt(F.col("doc_id"), F.col("run"), every).alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= rarest)


def powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))))


def keys_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, word's number, place) of each word itself and of each of its deletions.

    place: -1 for the word itself, else twice the deleted place, plus 1 if it is the first of a run of equal code points."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    first = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(points)) - first[owner]
    with np.errstate(over="ignore"):
        upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum((points + np.uint64(1)) * powers(BASE, int(lengths.max(initial=0)))[place], dtype=np.uint64)))
        begin, end = upto[first], upto[first + lengths]
        at = np.arange(len(points))
        less = upto[at] - begin[owner] + (end[owner] - upto[at + 1]) * np.uint64(INVERSE)
        keys = np.concatenate((end - begin, less)) * SPREAD
    lead = np.ones(len(points), bool)
    lead[1:] = (points[1:] != points[:-1]) | (place[1:] == 0)
    return keys ^ (keys >> np.uint64(32)), np.concatenate((np.arange(len(words)), owner)), np.concatenate((np.full(len(words), -1), 2 * place + lead))


def dealt(words: DataFrame, bits: int) -> DataFrame:
    """(part, word, n, keys, places): each word once for each part that any of its keys falls into."""

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, owner, place = keys_of(batch.column("word").to_pylist())
            part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
            by = np.lexsort((part, owner))
            keys, owner, place, part = keys[by], owner[by], place[by], part[by]
            new = np.nonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (part[1:] != part[:-1]))))[0]
            offsets = pa.array(np.append(new, len(keys)), pa.int32())
            mine = batch.take(pa.array(owner[new]))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (keys.view(np.int64), place.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(part[new]), mine.column("word"), mine.column("n"), *lists], ["part", "word", "n", "keys", "places"])

    return words.select("word", "n").mapInArrow(deal, "part long, word string, n long, keys array<long>, places array<int>")


def met(words: list[str], n: np.ndarray, keys: np.ndarray, owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What meets in a part: (word's number, number of its neighbours there, number of the most frequent of them), several rows a word."""
    by = np.lexsort((place, keys))
    keys, owner, place = keys[by], owner[by], place[by]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    run = np.cumsum(new) - 1
    own = np.bincount(run, place < 0)[run] > 0  # a word has this key itself
    lead = np.bincount(run, (place >= 0) & (place % 2 == 1))[run] > 0
    here = np.cumsum(new | np.concatenate(([True], place[1:] >> 1 != place[:-1] >> 1))) - 1
    twice = np.bincount(here)[here] > 1
    use = np.where(place < 0, lead, own & (place % 2 == 1) | twice)
    owner, place = owner[use], place[use]
    if not len(owner):
        return owner, owner, owner
    # equal keys are equal strings only if the strings say so
    text = [words[w] if p < 0 else words[w][: p >> 1] + words[w][(p >> 1) + 1 :] for w, p in zip(owner.tolist(), place.tolist(), strict=True)]
    same = pd.factorize(np.array(text, object))[0]
    rank = np.empty(len(words), np.int64)  # the most frequent first, then by code points
    rank[sorted(range(len(words)), key=lambda i: (-n[i], words[i]))] = np.arange(len(words))
    order = np.argsort(rank)
    out = []
    # one code point replaced: the same deletion at the same place
    cut_ = place >= 0
    w, group = owner[cut_], same[cut_].astype(np.int64) * (1 + int(place.max())) + (place[cut_] >> 1)
    by = np.lexsort((rank[w], group))
    w, group = w[by], group[by]
    if len(w):
        start = np.concatenate(([True], group[1:] != group[:-1]))
        which = np.cumsum(start) - 1
        size, at = np.bincount(which), np.nonzero(start)[0]
        many = size[which] > 1
        best = w[at[which]]
        best[at[size > 1]] = w[at[size > 1] + 1]
        out.append((w[many], size[which][many] - 1, best[many]))
    # one inserted or deleted: a word that is another's deletion
    short = np.full(int(same.max()) + 1, -1)
    short[same[place < 0]] = owner[place < 0]
    cut_ &= (place % 2 == 1) & (short[same] >= 0)
    if cut_.any():
        w, s = owner[cut_], short[same[cut_]]
        out.append((w, np.ones(len(w), np.int64), s))
        best = np.full(len(words), len(words))
        np.minimum.at(best, s, rank[w])
        u, k = np.unique(s, return_counts=True)
        out.append((u, k, order[best[u]]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (owner[:0], owner[:0], owner[:0])


def neighbours(parts: DataFrame) -> DataFrame:
    """(word, near, best_n, best): numbers of neighbours and the most frequent of them, a row or more for each word that has any."""

    def compare(table: pa.Table) -> pa.Table:
        words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        keys, places = table.column("keys").combine_chunks(), table.column("places").combine_chunks()
        owner = np.repeat(np.arange(len(words)), keys.value_lengths().to_numpy())
        w, near, best = met(words, n, keys.flatten().to_numpy().view(np.uint64), owner, places.flatten().to_numpy().astype(np.int64))
        column = table.column("word")
        return pa.table([column.take(pa.array(w)), pa.array(near, pa.int64()), pa.array(n[best], pa.int64()), column.take(pa.array(best))], ["word", "near", "best_n", "best"])

    return parts.groupBy("part").applyInArrow(compare, "word string, near long, best_n long, best string")


def roots(forms: DataFrame, most: int, rarest: int, times: int) -> DataFrame:
    """(word, root): forms (word, form) followed to the last. Each step doubles what is known; a chain's n grows `times` fold at each link,
    so that the largest n tells how long chains can be."""
    links = int(math.log(max(most, 1) / max(rarest, 1), times)) + 1 if most > rarest else 1
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(links + 1)))):
        now = cut(now)
        ahead = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        now = now.join(ahead, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"))
    return now


def variants(docs: DataFrame, every: int = 199, shortest: int = 6, rarest: int = 5, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words."""
    words = stored(vocabulary(docs, every, shortest, rarest), "words")
    total, most = words.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    bits = max(0, math.ceil(math.log2(max(1, total) / PART_KEYS)))
    found = neighbours(dealt(words, bits)).groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("b"))
    of_form = (-F.col("b.less")) >= times * F.col("n")
    known = words.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(of_form, F.col("b.best")).alias("form"), F.when(of_form, -F.col("b.less")).alias("form_n"))
    known = stored(known, "forms")
    last = roots(known.where("form is not null"), most, rarest, times)
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    from .base import table

    return variants(table(spark, sf_dir, "documents"))

"""SimHash near-duplicates, found by anchor points of a covering code.

A fingerprint has 64 bits and is dealt into `parts` runs of bits. Two fingerprints that differ in at most
`bits` places differ in at most bits // parts places in one of the runs. Within a run, the anchors are the
words of a product code: a [15,11] Hamming code (covering radius 1) over the first fifteen bits, the
remaining bits as they are. Each fingerprint is at home with its nearest anchor and is replicated to every
anchor at which a fingerprint within the run's threshold can be at home: those within covering radius plus
threshold. Comparing replicas with residents anchor by anchor therefore finds every pair.

Equal fingerprints are one entry. An anchor with many residents is dealt into sub-blocks of bounded size, and a
task streams its replicas past one block. What a task emits is a spanning forest of the pairs it found, not
the pairs.

Defined cases: a null or wordless text has fingerprint zero, linked like any other; words stay as they are but for A-Z;
repeated shingles count each time; rows with a null doc_id get the component of their fingerprint's smallest
non-null id (null if there is none); repeated rows are returned as often as they come; other columns are ignored.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import components, cut, stored

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Residents of an anchor that one task compares with.
BLOCK = 1024
#: Anchors with more residents than BLOCK: up to so many are broadcast (16 bytes each), more are joined by shuffle.
HEAVY_BROADCAST = 50_000
PAIRS = 1 << 21
HAMMING = 15


def shingles(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """The hash of each run of so many words, or of all words if there are fewer."""
    found = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not found:
        return np.zeros(0, "<u8")
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(found) - words + 1)
    spans = zip(starts[:last].tolist(), ends[min(words, len(found)) - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[i:j], seed) for i, j in spans], dtype="<u8")


def fingerprint(text: str | None, words: int, seed: int = 42) -> int:
    """The fingerprint as a signed 64-bit integer."""
    h = shingles(text, words, seed)
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fp) of every row."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), of(F.col("text")).alias("fp"))


def runs(parts: int) -> list[tuple[int, int]]:
    """(shift, width) of each run of bits."""
    at = [round(64 * i / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:], strict=False)]


def home(v: np.ndarray, width: int) -> np.ndarray:
    """The nearest anchor of each value: its Hamming syndrome names the bit to flip."""
    n = min(HAMMING, width)
    syndrome = np.zeros(len(v), np.uint64)
    for i in range(n):
        syndrome ^= ((v >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    flip = np.where((syndrome > 0) & (syndrome <= n), np.uint64(1) << (np.maximum(syndrome, np.uint64(1)) - np.uint64(1)), np.uint64(0))
    return v ^ flip


def anchors(fp: np.ndarray, shift: int, width: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for every anchor at which something within `radius` of the row's run can be at home; the home comes first."""
    v = (fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]
    cells = np.stack([home(v ^ np.uint64(m), width) for m in masks], axis=1)
    own = cells[:, :1].copy()
    cells.sort(axis=1)
    first = np.ones(cells.shape, bool)
    first[:, 1:] = cells[:, 1:] != cells[:, :-1]
    first &= cells != own
    row, at = np.nonzero(first)
    return np.concatenate((np.arange(len(v)), row)), np.concatenate((own[:, 0], cells[row, at]))


PLACED = "cell long, resident boolean, fp long, id long"


def place(reps: DataFrame, bits: int, parts: int, residents_only: bool) -> DataFrame:
    """Rows (cell, resident, fp, id): each entry at home, and as a replica at each anchor within reach, its home included."""

    def deal(batches):
        for b in batches:
            fps, ids = b.column("fp").to_numpy(zero_copy_only=False), b.column("id").to_numpy(zero_copy_only=False)
            for k in range(0, len(fps), 20_000):
                fp, own = fps[k : k + 20_000], ids[k : k + 20_000]
                for p, (shift, width) in enumerate(runs(parts)):
                    row, cell = anchors(fp.view(np.uint64), shift, width, 0 if residents_only else bits // parts)
                    cell, n = cell.astype(np.int64) | (p << 48), len(fp)
                    if residents_only:
                        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.ones(n, bool)), pa.array(fp[row]), pa.array(own[row])], names=["cell", "resident", "fp", "id"])
                    else:
                        row, cell = np.concatenate((row, row[:n])), np.concatenate((cell, cell[:n]))
                        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.arange(len(row)) >= len(row) - n), pa.array(fp[row]), pa.array(own[row])], names=["cell", "resident", "fp", "id"])

    return reps.mapInArrow(deal, PLACED)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node of its component in the graph of the pairs."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def compare(bits: int):
    """A function for mapInArrow over rows sorted by block, residents first: edges of a spanning forest of the close pairs."""

    def close(fp, ids, h, q):
        near = np.bitwise_count(fp[h] ^ fp[q]) <= bits
        near &= ids[h] != ids[q]
        return h[near], q[near]

    def edges(fp, ids, found):
        if found:
            h, q = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(h):
                a, b = forest(ids[h], ids[q])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def work(block, resident, fp, ids):
        """All blocks of the rows, each whole or with the residents repeated from before."""
        if not len(block):
            return
        start = np.concatenate(([0], np.nonzero(block[1:] != block[:-1])[0] + 1))
        size = np.diff(np.append(start, len(block)))
        nh = np.add.reduceat(resident.astype(np.int64), start)
        nq = size - nh
        some = (nh > 0) & (nq > 0)
        start, nh, nq = start[some], nh[some], nq[some]
        pairs, found, load = nh * nq, [], 0
        for g in np.nonzero(pairs > PAIRS)[0]:
            step = max(1, PAIRS // nq[g])
            for h0 in range(0, nh[g], step):
                h = np.arange(h0, min(nh[g], h0 + step)) + start[g]
                q = np.arange(nq[g]) + start[g] + nh[g]
                got = close(fp, ids, np.repeat(h, len(q)), np.tile(q, len(h)))
                yield from edges(fp, ids, [got])
        small = np.nonzero(pairs <= PAIRS)[0]
        upto = np.cumsum(pairs[small])
        k = 0
        while k < len(small):
            e = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + PAIRS, "right")))
            g = small[k:e]
            of = np.repeat(np.arange(len(g)), pairs[g])
            local = np.arange(len(of)) - np.repeat(np.cumsum(pairs[g]) - pairs[g], pairs[g])
            h = start[g][of] + local // nq[g][of]
            q = start[g][of] + nh[g][of] + local % nq[g][of]
            found.append(close(fp, ids, h, q))
            load += len(found[-1][0])
            if load > PAIRS:
                yield from edges(fp, ids, found)
                found, load = [], 0
            k = e
        yield from edges(fp, ids, found)

    def run(batches):
        held = None
        for b in batches:
            cell, sub = (b.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "sub"))
            rows = [cell, sub.astype(np.int64), b.column("resident").to_numpy(zero_copy_only=False), b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64), b.column("id").to_numpy(zero_copy_only=False)]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            n = len(rows[0])
            if not n:
                continue
            new = np.nonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))[0] + 1
            last = int(new[-1]) if len(new) else 0
            block = np.zeros(n, np.int64)
            block[new] = 1
            block = np.cumsum(block)
            if n - last > 200_000:  # one block goes on: work off its replicas and keep its residents
                yield from work(block, *rows[2:])
                stay = rows[2].copy()
                stay[:last] = False
                held = [x[stay] for x in rows]
            else:
                yield from work(block[:last], *(x[:last] for x in rows[2:]))
                held = [x[last:] for x in rows]
        if held is not None:
            yield from work(np.zeros(len(held[0]), np.int64), *held[2:])

    return run


def links(reps: DataFrame, bits: int, parts: int) -> DataFrame:
    """Edges (a, b) between ids of entries (fp, id) that connect just what pairs within `bits` connect."""
    heavy = place(reps, bits, parts, True).groupBy("cell").count().where(F.col("count") > BLOCK)
    heavy = cut(heavy.select(F.col("cell").alias("hot"), F.ceil(F.col("count") / BLOCK).cast("int").alias("n")))
    if heavy.count() <= HEAVY_BROADCAST:
        heavy = F.broadcast(heavy)
    placed = place(reps, bits, parts, False).join(heavy, F.col("cell") == F.col("hot"), "left")
    n = F.coalesce("n", F.lit(1))
    subs = F.when(F.col("resident"), F.array(F.pmod(F.xxhash64("fp", "cell"), n).cast("int"))).otherwise(F.sequence(F.lit(0), n - 1))
    rows = placed.select("cell", F.explode(subs).alias("sub"), "resident", "fp", "id")
    rows = rows.repartition(F.col("cell"), F.col("sub")).sortWithinPartitions("cell", "sub", F.desc("resident"))
    return rows.mapInArrow(compare(bits), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, bits: int = 4, parts: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row: fingerprints link at `bits` or fewer differing bits.

    parts: runs of bits; fewer runs make more replicas of each entry and fewer comparisons at each anchor."""
    fps = stored(fingerprints(docs, words), "fps")
    reps = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("id")))
    found = components(links(reps.where("id is not null"), bits, parts))
    named = reps.join(found, F.col("id") == F.col("node"), "left").select(F.col("fp").alias("rep_fp"), F.coalesce("component", "id").alias("component_id"))
    return fps.join(named, F.col("fp") == F.col("rep_fp")).select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The documents of which each component keeps one row: the smallest by (doc_id, hash of the text).

    named: (doc_id, text_hash, n, component) of the rows that have an id, n being the number of equal rows, of which one
    stays. A text under a repeated id has a component of its own. Rows without an id are kept."""
    first = named.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash", "n")).alias("row"))
    first = cut(first.select(F.col("row.doc_id").alias("_one_id"), F.col("row.text_hash").alias("_one_hash"), F.col("row.n").alias("_one_n")))
    rows = docs.where("doc_id is not null").join(first, (docs["doc_id"].cast("long") == first["_one_id"]) & (F.xxhash64(docs["text"]) == first["_one_hash"]))
    single = rows.where("_one_n = 1").select(*[docs[c] for c in docs.columns])
    again = rows.where("_one_n > 1").select(*[docs[c] for c in docs.columns]).dropDuplicates(["doc_id", "text"])
    return single.unionByName(again).unionByName(docs.where("doc_id is null"))


def one_of_each(docs: DataFrame, words: int = 5, bits: int = 4, parts: int = 3) -> DataFrame:
    """The documents without their near-duplicates by bits: of each component of fingerprints the row with the smallest id stays.

    Rows without an id are kept."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    fps = stored(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), of("text").alias("fp")), "fps")
    rows = cut(fps.groupBy("doc_id", "text_hash", "fp").agg(F.count("*").alias("n")))
    found = components(links(rows.select("fp", F.col("fp").alias("id")).distinct(), bits, parts))
    named = rows.join(found, F.col("fp") == F.col("node"), "left").select("doc_id", "text_hash", "n", F.coalesce("component", "fp").alias("component"))
    return first_of_each(docs, named)


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    from .base import table

    found = near_duplicates(table(spark, sf_dir, "documents"), words=4, bits=4, parts=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

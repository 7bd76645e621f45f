"""Near copies by the Jaccard similarity of their sets of shingles: wide SimHashes find candidates, the sets decide.

Texts with equal sets are one node. A node's fingerprint has 256 bits, dealt into 14 runs of 18. Within a run the anchors are those
of `simhash`: a node is at home with its nearest anchor and is replicated to all anchors at which a run that differs from its own in
one bit can be at home. Nodes that meet at an anchor and differ in at most FAR of the first 128 bits are candidates. At a similarity
of 0.8 a bit differs with 0.15, a pair meets in a run with 0.30, and 99 % of pairs meet in some run.

Nodes are labelled before all of this is done: at home alone each is compared with a few others, and the components of what is near are
the labels. Then only nodes of different labels need to meet, and what they tell is an edge between labels. The residents of a busy anchor
are dealt into blocks, those of a large label into blocks of its own, and all that come there go past each block but those of
their own label. So a group under one label costs rows in proportion to its nodes; large labels that share a cell and are not alike still go
past each other's blocks. No pair of different labels is left out.

Candidates only say which nodes to compare: all pairs of a component of candidates are decided by their sets, and the links
that hold make the components that count. No task emits more than a spanning forest of the pairs it found.

Defined cases: null, empty and blank texts have equal sets, the empty one, and are one group: the row with the smallest id stays; a text of fewer words than a
shingle is one shingle; of rows that are wholly equal one stays; different texts under one id are told apart by their hashes; rows without an
id are kept and link nothing; an empty table stays empty; other columns come along as they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import components, cut, stored
from .simhash import BLOCK, HEAVY_BROADCAST, PAIRS, anchors, first_of_each, forest, shingles

WORDS64 = 4
#: Runs of bits, bits of a run, and the bits of a run in which a node is sought from its anchors.
RUNS, WIDTH, RADIUS = 14, 18, 1
#: Bits, of the first 128, in which candidates may differ: at a similarity of 0.8 the mean is 19.4 and the deviation 4.1.
FAR = 34
#: Rows after its own, and at the start of its block, with which a node is compared before there are labels.
REACH = 8
#: One node in so many is counted to see which cells are heavy.
SAMPLED = 16
#: Nodes and shingles of a block whose pairs one task decides.
SET_BLOCK, SET_SHINGLES = 512, 1 << 20
SALTS = np.arange(WORDS64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The sorted hashes of the distinct shingles."""
    return np.unique(shingles(text, words))


def wide(found: np.ndarray) -> bytes:
    """The fingerprint of a set: each bit is the majority of that bit of the shingles' hashes."""
    ones = np.zeros(64 * WORDS64, np.int64)
    for k in range(0, len(found), 255):
        x = found[k : k + 255, None] + SALTS
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return np.packbits(2 * ones > len(found), bitorder="little").tobytes()


def nodes_of(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, node, size, fp) of every row that has an id; node is the hash of the set."""

    @F.pandas_udf("node long, size int, fp binary")
    def of(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_set(t, words) for t in texts]
        nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], np.uint64).view(np.int64)
        return pd.DataFrame({"node": nodes, "size": np.array([len(s) for s in sets], np.int32), "fp": [wide(s) for s in sets]})

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), of("text").alias("of"))
    return rows.select("doc_id", "text_hash", "of.*")


def runs_of(fps: np.ndarray) -> np.ndarray:
    """The runs of fingerprints (rows of bytes) as numbers, a column a run."""
    bits = np.unpackbits(fps, axis=1, bitorder="little")[:, : RUNS * WIDTH].reshape(len(fps), RUNS, WIDTH)
    return bits @ (1 << np.arange(WIDTH, dtype=np.uint64))


def place(nodes: DataFrame, residents_only: bool = False) -> DataFrame:
    """(cell, replica, node, label, f0, f1): each node at its home of each run, and as a replica at the other anchors within reach, with the first 128 bits."""

    def deal(batches):
        for b in batches:
            names, fps = [b.column(c).to_numpy(zero_copy_only=False) for c in ("node", "label")], b.column("fp").to_pylist()
            for k in range(0, len(fps), 2000):
                own, label = (x[k : k + 2000] for x in names)
                fp = np.frombuffer(b"".join(fps[k : k + 2000]), np.uint8).reshape(len(own), 8 * WORDS64)
                first = np.ascontiguousarray(fp[:, :16]).view(np.int64)
                for r, run in enumerate(runs_of(fp).T):
                    row, anchor = anchors(run, 0, WIDTH, 0 if residents_only else RADIUS)
                    cell = anchor.astype(np.int64) | (r << WIDTH)
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.arange(len(row)) >= len(own))] + [pa.array(x[row]) for x in (own, label, first[:, 0], first[:, 1])], names=["cell", "replica", "node", "label", "f0", "f1"])

    return nodes.select("node", "label", "fp").mapInArrow(deal, "cell long, replica boolean, node long, label long, f0 long, f1 long")


def dealt(rows: DataFrame, key: str, blocks: DataFrame) -> DataFrame:
    """The rows with a column sub. Rows of a key that has n blocks are dealt into n blocks by node; each goes to all n pairs of its block."""
    own, n = F.pmod(F.xxhash64("node", F.lit(1)), F.col("n_blocks")), F.col("n_blocks")
    subs = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda j: F.least(own, j) * (1 << 30) + F.greatest(own, j))
    rows = rows.join(blocks, F.col(key) == F.col("dealt_key"), "left")
    return rows.withColumn("sub", F.explode(F.when(n.isNull(), F.array(F.lit(0).cast("long"))).otherwise(subs))).drop("dealt_key", "n_blocks")


def bounded(df: DataFrame) -> DataFrame:
    """df, checkpointed and marked for broadcast if it is small."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= HEAVY_BROADCAST else df


def meet(reach: int):
    """A function for mapInArrow over rows sorted by cell and sub, residents first: edges of a spanning forest of the candidates of different labels.

    A resident is compared with all rows after it that are within `reach` of it, or it within `reach` of the start of its block."""

    def edges(found):
        if found:
            a, b = forest(*(np.concatenate(x) for x in zip(*found, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def pairs(cell, sub, replica, label, f0, f1):
        n = len(cell)
        start = np.concatenate(([0], np.nonzero((cell[1:] != cell[:-1]) | (sub[1:] != sub[:-1]))[0] + 1))
        size = np.diff(np.append(start, n))
        first, end = np.repeat(start, size), np.repeat(start + size, size)
        at, d = np.nonzero(~replica)[0], 1
        while len(at := at[(at + d < end[at]) & ((d <= reach) | (at - first[at] < reach))]):
            o = at + d
            near = (np.bitwise_count(f0[at] ^ f0[o]) + np.bitwise_count(f1[at] ^ f1[o]) <= FAR) & (label[at] != label[o])
            if near.any():
                yield label[at[near]], label[o[near]]
            d += 1

    def blocks(batches):
        """The rows in runs of whole blocks."""
        held = None
        for b in batches:
            rows = [b.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "sub", "replica", "label")] + [b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("f0", "f1")]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            if not len(rows[0]):
                continue
            new = np.nonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))[0] + 1
            last = int(new[-1]) if len(new) else 0
            if last:
                yield [x[:last] for x in rows]
            held = [x[last:] for x in rows]
        if held is not None:
            yield held

    def run(batches):
        found, load = [], 0
        for rows in blocks(batches):
            for pair in pairs(*rows):
                found.append(pair)
                load += len(pair[0])
                if load > PAIRS:
                    yield from edges(found)
                    found, load = [], 0
        yield from edges(found)

    return run


def met(rows: DataFrame, reach: int) -> DataFrame:
    """Edges (a, b) between the labels of rows (cell, sub, replica, label, f0, f1) that `meet` finds."""
    return rows.repartition(F.col("cell"), F.col("sub")).sortWithinPartitions("cell", "sub", "replica").mapInArrow(meet(reach), "a long, b long")


def sampled(nodes: DataFrame) -> DataFrame:
    """One node in SAMPLED at its homes."""
    return place(nodes.where(F.pmod(F.xxhash64("node"), F.lit(SAMPLED)) == 0), True)


def labelled(nodes: DataFrame) -> DataFrame:
    """(node, label, fp): nodes of a label are connected by candidate pairs, if not all that are have one label.

    Heavy cells are dealt out, in each run of bits anew."""
    heavy = sampled(nodes).groupBy(F.col("cell").alias("busy")).agg((F.count("*") * SAMPLED).alias("many")).where(F.col("many") > BLOCK)
    heavy = bounded(heavy.select("busy", F.ceil(F.col("many") / BLOCK).alias("n_blocks")))
    rows = place(nodes, True).join(heavy, F.col("cell") == F.col("busy"), "left")
    sub = F.pmod(F.xxhash64("node", "cell"), F.coalesce("n_blocks", F.lit(1).cast("long")))
    found = components(met(rows.select("cell", sub.alias("sub"), "replica", "label", "f0", "f1"), REACH)).withColumnRenamed("node", "_node")
    return nodes.join(found, F.col("node") == F.col("_node"), "left").select("node", F.coalesce("component", "node").alias("label"), "fp")


def candidates(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect just the nodes that candidate pairs connect."""
    nodes = cut(labelled(cut(nodes.select("node", F.col("node").alias("label"), "fp"))))
    seen = sampled(nodes).groupBy("cell", "label").agg((F.count("*") * SAMPLED).alias("many"))
    large = F.collect_list(F.when(F.col("many") > BLOCK, F.struct("label", F.ceil(F.col("many") / BLOCK).alias("n")))).alias("large")
    rest = F.coalesce(F.sum(F.when(F.col("many") <= BLOCK, F.col("many"))), F.lit(0))
    heavy = seen.groupBy(F.col("cell").alias("busy")).agg(F.sum("many").alias("all"), F.greatest(F.ceil(rest / BLOCK), F.lit(1).cast("long")).alias("n_mixed"), large).where(F.col("all") > BLOCK)
    rows = place(nodes).join(bounded(heavy.drop("all")), F.col("cell") == F.col("busy"), "left")
    zero, one, spread = F.lit(0).cast("long"), F.lit(1).cast("long"), F.xxhash64("node", "cell")
    n_own = F.get(F.filter("large", lambda x: x["label"] == F.col("label")), F.lit(0))["n"]
    own = F.when(n_own.isNotNull(), F.xxhash64("label", F.pmod(spread, n_own) + one)).otherwise(F.pmod(spread, F.col("n_mixed")))
    own = F.when(F.col("busy").isNull(), zero).otherwise(own)
    others = F.transform(F.filter("large", lambda x: x["label"] != F.col("label")), lambda x: F.transform(F.sequence(one, x["n"]), lambda j: F.xxhash64(x["label"], j)))
    past = F.concat(F.sequence(zero, F.col("n_mixed") - one), F.flatten(others))
    past = F.when(F.col("busy").isNull(), F.array(zero)).when(F.col("replica"), past).otherwise(F.array_union(past, F.array(own)))
    rows = rows.select("cell", F.explode(past).alias("sub"), F.when(~F.col("replica"), own).alias("own"), "label", "f0", "f1")
    rows = rows.select("cell", "sub", F.coalesce(F.col("sub") != F.col("own"), F.lit(True)).alias("replica"), "label", "f0", "f1")
    return met(rows, 1 << 40).unionByName(nodes.select(F.col("node").alias("a"), F.col("label").alias("b")).where("a != b"))


def alike(nodes: np.ndarray, sets: list[np.ndarray], least: float) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of the pairs whose sets have a similarity of at least `least`."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    nodes, sets = nodes[order], [sets[i] for i in order]
    size = np.array([len(s) for s in sets])
    known, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ids = np.split(ids, np.cumsum(size)[:-1])
    label, mark, a, b = np.arange(len(sets)), np.zeros(len(known), bool), [], []
    for x in range(len(sets)):
        y = np.arange(x + 1, np.searchsorted(size * least, size[x], "right"))
        y = y[label[y] != label[x]]
        if not len(y) or not size[x]:
            continue
        mark[ids[x]] = True
        both = np.add.reduceat(mark[np.concatenate([ids[i] for i in y])], np.cumsum(size[y]) - size[y], dtype=np.int64)
        mark[ids[x]] = False
        y = y[both / (size[x] + size[y] - both) >= least]
        roots, first = np.unique(label[y], return_index=True)
        a += [int(nodes[x])] * len(first)
        b += nodes[y[first]].tolist()
        label[np.isin(label, roots)] = label[x]
    return a, b


def decide(least: float):
    """For mapInArrow over rows sorted by component and sub: edges of a spanning forest of the pairs that are alike."""

    def work(parts):
        rows = pa.Table.from_batches(parts)
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        a, b = alike(rows.column("node").to_numpy(), sets, least)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        held, of = [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("component", "sub")], axis=1)
            new = np.concatenate(([0], np.nonzero((key[1:] != key[:-1]).any(axis=1))[0] + 1, [len(key)]))
            for i, j in zip(new[:-1], new[1:], strict=True):
                if i == j:
                    continue
                if held and of != tuple(key[i]):
                    yield work(held)
                    held = []
                of = tuple(key[i])
                held.append(batch.slice(i, j - i))
        if held:
            yield work(held)

    return run


def verified(docs: DataFrame, rows: DataFrame, found: DataFrame, words: int, least: float) -> DataFrame:
    """Edges (a, b) that connect just what pairs of at least this similarity within a component of `found` connect.

    rows: (doc_id, text_hash, node, size, n), n being the number of equal rows; a node's first row gives its set."""

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, words).tobytes() for t in texts])

    one = rows.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash", "n", "size")).alias("row")).join(found.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"))
    one = bounded(one.select("node", "component", "row.size", "row.n", F.col("row.doc_id").alias("_id"), F.col("row.text_hash").alias("_hash")))
    blocks = F.ceil(F.greatest(F.count("*") / SET_BLOCK, F.sum("size") / SET_SHINGLES))
    blocks = bounded(one.groupBy(F.col("component").alias("dealt_key")).agg(blocks.alias("n_blocks")).where("n_blocks > 1"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(one, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash")))
    texts = texts.select("node", "component", "n", "text")
    texts = texts.where("n = 1").unionByName(texts.where("n > 1").dropDuplicates(["node"]))
    sets = dealt(texts.select("node", "component", packed("text").alias("shingles")), "component", blocks)
    return sets.repartition(F.col("component"), F.col("sub")).sortWithinPartitions("component", "sub").mapInArrow(decide(least), "a long, b long")


def one_of_similar(docs: DataFrame, words: int = 5, least: float = 0.8) -> DataFrame:
    """The documents without their near copies: of each component of links at `least` or more, the row with the smallest id stays.

    Rows without an id are kept and link nothing."""
    own = stored(nodes_of(docs.select("doc_id", "text"), words), "nodes")
    rows = cut(own.groupBy("doc_id", "text_hash", "node", "size").agg(F.count("*").alias("n")))
    found = components(candidates(own.select("node", "fp").dropDuplicates(["node"])))
    found = components(verified(docs, rows, found, words, least)).withColumnRenamed("node", "_node")
    named = rows.join(found, F.col("node") == F.col("_node"), "left").select("doc_id", "text_hash", "n", F.coalesce("component", "node").alias("component"))
    return first_of_each(docs, named)

"""Mixing sources to target weights.

Each source is one stream of words, its documents in an order by hash bucket and id, cut into blocks of BLOCK words. The mix is a
sequence of slots, each filled by one block. A source's quota of slots covers its target to the word: it goes through
its blocks in the order of a pseudorandom permutation of their indices, as often as the target asks, and the last slot takes only
the words that are still missing. Output shards of SHARD_SLOTS slots draw how many slots each source has there: multinomial
draws given the quotas, so that all shards together meet the quotas exactly. The draws come from a binary tree of
splits with a seed for each node (`draws.py`, the same exact law at every size), so that any shard finds its own counts, and the
counts before it, by itself. Slots join the documents' blocks by (source, index).

Targets: sources by code point, null last, weigh 1, 2, 3, repeating, and share the sum of all sizes; a target stops at
MOST times its source's size, the excess being shared by weight again until none is above. As a block fills at most MOST slots of a full
pass each, no document gives more than MOST times its words.

Rows that are equal in all columns are one entry with a number of copies, which follow one another: a group of any size is one row
until its places are known.

Defined cases: a null or wordless text has size 0 and gives nothing; null doc_ids are documents like others; rows that repeat come one
after another, and each is counted; other columns are ignored but for the order of rows that share id and size (and kept by `mixed`).
More than MAX_SOURCES sources are refused.
"""

from __future__ import annotations

import re
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import SPACE, stored
from .draws import multivariate

BLOCK = 256
SHARD_SLOTS = 4096
MOST = 3
MAX_SOURCES = 100_000
#: Entries with copies: up to so many are broadcast (some 60 bytes each), more are joined by shuffle.
REPEATED_BROADCAST = 100_000
SEED = 20_240_101


def targets(sizes: list[int], weights: list[float] | None = None, most: int = MOST) -> list[float]:
    """The target of each source."""
    weights = weights or [1 + k % 3 for k in range(len(sizes))]
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[k] for k in open_)
        above = [k for k in open_ if left * weights[k] / total > most * sizes[k]]
        if not above:
            for k in open_:
                out[k] = left * weights[k] / total
            break
        for k in above:
            out[k] = float(most * sizes[k])
        open_ = [k for k in open_ if k not in set(above)]
        left = float(sum(sizes)) - sum(out)
    return out


class Permutation:
    """A pseudorandom permutation of range(n): a Feistel network on the next even power of two, walked until it lands inside."""

    def __init__(self, n: int, key: int, rounds: int = 4):
        self.n, self.half = n, max(1, -(-max(1, (n - 1).bit_length()) // 2))
        self.keys = np.random.default_rng([SEED, key]).integers(1, 1 << 62, rounds, dtype=np.uint64)

    def mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        z = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (z ^ (z >> np.uint64(32))) & np.uint64((1 << self.half) - 1)

    def step(self, x: np.ndarray, back: bool) -> np.ndarray:
        a, b = x >> np.uint64(self.half), x & np.uint64((1 << self.half) - 1)
        for key in self.keys[::-1] if back else self.keys:
            a, b = (b ^ self.mix(a, key), a) if back else (b, a ^ self.mix(b, key))
        return a << np.uint64(self.half) | b

    def __call__(self, x: np.ndarray, back: bool = False) -> np.ndarray:
        out = self.step(np.asarray(x, np.uint64), back)
        while (outside := out >= self.n).any():
            out[outside] = self.step(out[outside], back)
        return out.astype(np.int64)


class Plan:
    """What each source gives: sizes, targets and slots."""

    def __init__(self, sources: list[str | None], sizes: list[int], weights: list[float] | None = None, entries: int = 0, repeated: int = 0):
        self.sources, self.sizes, self.targets, self.entries, self.repeated = sources, sizes, targets(sizes, weights), entries, repeated
        self.blocks = [-(-s // BLOCK) for s in sizes]
        self.quota, self.trim = [], []
        for k, (size, blocks) in enumerate(zip(sizes, self.blocks, strict=True)):
            words = min(int(self.targets[k] + 0.5), MOST * size)
            passes, rest = divmod(words, size) if size else (0, 0)
            slots, short = passes * blocks, BLOCK - (size - (blocks - 1) * BLOCK)
            trim = 0
            if rest:
                at = int(Permutation(blocks, k)(np.array([blocks - 1]), back=True)[0])  # where the last, short block comes
                more = -(-rest // BLOCK)
                have = more * BLOCK - (short if at < more else 0)
                if have < rest:
                    more += 1
                    have += BLOCK
                slots, trim = slots + more, have - rest
            self.quota.append(slots)
            self.trim.append(trim)  # words that the source's last slot leaves out
        self.slots = sum(self.quota)
        self.shards = -(-self.slots // SHARD_SLOTS)

    def counts(self, first: int, last: int):
        """(shard, slots of each source before it, slots of each source in it) for shards first to last."""

        def walk(lo: int, hi: int, before: np.ndarray, quota: np.ndarray):
            if hi <= first or lo >= last:
                return
            if hi - lo == 1:
                yield lo, before, quota
                return
            mid = (lo + hi) // 2
            left = multivariate(quota, (mid - lo) * SHARD_SLOTS, np.random.default_rng([SEED, lo, hi]))
            yield from walk(lo, mid, before, left)
            yield from walk(mid, hi, before + left, quota - left)

        if self.shards:
            quota = np.array(self.quota, np.int64)
            yield from walk(0, self.shards, np.zeros_like(quota), quota)


ENTRY = ("doc_id", "source", "size", "h")


def keyed(docs: DataFrame) -> list[Column]:
    """What tells a row from others: id, source, size, and a hash of all columns."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(SPACE)), F.lit(0)).cast("long")
    whole = [F.col(f"`{f.name}`") if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString() else F.to_json(F.struct(f"`{f.name}`")) for f in docs.schema.fields]
    return [c.alias(n) for c, n in zip((F.col("doc_id").cast("long"), F.col("source").cast("string"), size, F.xxhash64(*whole)), ENTRY, strict=True)]


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h, copies): an entry for each distinct row."""
    return docs.select(*keyed(docs)).groupBy(*ENTRY).agg(F.count("*").alias("copies"))


def plan_of(rows: DataFrame, weights: list[float] | None = None) -> Plan:
    """rows: as from sized. A row a source comes to the driver."""
    found = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n"), F.count("*").alias("entries"), F.count_if((F.col("copies") > 1) & (F.col("size") > 0)).alias("repeated")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    return Plan([r["source"] for r in found], [r["n"] for r in found], weights, sum(r["entries"] for r in found), sum(r["repeated"] for r in found))


def slots(spark, plan: Plan) -> DataFrame:
    """(shard, slot, k, block, words): the mix. Slot k of a shard is filled with the first `words` words of the block of source k."""
    shared = spark.sparkContext.broadcast(plan)

    def fill(batches):
        p = shared.value
        perms = {}
        for b in batches:
            if b.num_rows:  # the shards of a task follow one another
                for shard, before, count in p.counts(b.column("id")[0].as_py(), b.column("id")[b.num_rows - 1].as_py() + 1):
                    ks = np.repeat(np.arange(len(count)), count)
                    parts, words = [], []
                    for k in np.nonzero(count)[0].tolist():
                        at = np.arange(before[k], before[k] + count[k])
                        block = perms.setdefault(k, Permutation(p.blocks[k], k))(at % p.blocks[k])
                        n = np.where(block == p.blocks[k] - 1, p.sizes[k] - (p.blocks[k] - 1) * BLOCK, BLOCK)
                        n[at == p.quota[k] - 1] -= p.trim[k]
                        parts.append(block)
                        words.append(n)
                    order = np.random.default_rng([SEED, 1, shard]).permutation(len(ks))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ks), shard)), pa.array(order), pa.array(ks.astype(np.int32)), pa.array(np.concatenate(parts)), pa.array(np.concatenate(words))], names=["shard", "slot", "k", "block", "words"])

    tasks = min(max(1, plan.shards), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.range(0, plan.shards, 1, tasks).mapInArrow(fill, "shard long, slot long, k int, block long, words long")


def numbered(rows: DataFrame, plan: Plan) -> DataFrame:
    """Entries with the source's number k and size, and the place of their first word in the source's stream.

    Places are sums over hash buckets, then within them: no source is ordered in one task."""
    spark = rows.sparkSession
    names = spark.createDataFrame(list(zip(plan.sources, range(len(plan.sources)), plan.sizes, strict=True)) or [(None, 0, 0)], "k_source string, k int, k_size long")
    rows = rows.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("k_source"))).drop("k_source")
    buckets = 1 + 4 * isqrt(plan.entries)  # neither they nor their rows grow faster than the root of the entries
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "h"), F.lit(buckets)).cast("int")).withColumn("all", F.col("size") * F.col("copies"))
    totals = rows.groupBy("k", "bucket").agg(F.sum("all").alias("n"))
    ahead = Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("k").alias("t_k"), F.col("bucket").alias("t_bucket"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("k", "bucket").orderBy("doc_id", "size", "h").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("all").over(inside), F.lit(0)))
    rows = rows.join(totals, (F.col("k") == F.col("t_k")) & (F.col("bucket") == F.col("t_bucket")))
    return rows.withColumn("first", F.col("base") + F.col("inner")).drop("bucket", "inner", "base", "all", "t_k", "t_bucket")


def each(entries: DataFrame) -> DataFrame:
    """A row for each copy of an entry, with its own place `start`."""
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return entries.withColumn("copy", copies).withColumn("start", F.col("first") + F.col("copy") * F.col("size")).drop("copy")


def pieces(rows: DataFrame, mix: DataFrame) -> DataFrame:
    """(k, first, start, lo, hi, times, part): for each document and block the words lo to hi, taken `times` times, and once more up to `part`."""
    spans = rows.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}"))))
    spans = spans.withColumn("lo", F.greatest(F.lit(0), F.col("block") * BLOCK - F.col("start"))).withColumn("hi", F.least(F.col("size"), (F.col("block") + 1) * BLOCK - F.col("start")))
    # the trimmed slot is the one whose words are fewer than the block's
    uses = mix.groupBy("k", "block").agg(F.max("words").alias("most"), F.min("words").alias("least"), F.count("*").alias("n"), F.sum("words").alias("all"))
    uses = uses.select(F.col("k").alias("u_k"), F.col("block").alias("u_block"), "most", "least", "n", "all")
    # the planner takes the slots for as few as the shards they are made from, and would broadcast them
    out = spans.join(uses.hint("merge"), (F.col("k") == F.col("u_k")) & (F.col("block") == F.col("u_block")))
    end = F.col("block") * BLOCK - F.col("start")
    trimmed = F.col("least") < F.least(F.lit(BLOCK), F.col("k_size") - F.col("block") * BLOCK)
    times = F.when(trimmed, F.col("n") - 1).otherwise(F.col("n"))
    part = F.when(trimmed, F.greatest(F.col("lo"), F.least(F.col("hi"), end + F.col("least")))).otherwise(F.col("lo"))
    return out.select("k", "first", "start", "lo", "hi", times.alias("times"), part.alias("part"))


def prepared(docs: DataFrame, weights: list[float] | None = None) -> tuple[Plan, DataFrame, DataFrame]:
    """The plan, the entries with their places (doc_id, source, size, h, copies, k, first, k_size) and the slots."""
    rows = stored(sized(docs), "sizes")
    plan = plan_of(rows, weights)
    return plan, numbered(rows, plan), slots(docs.sparkSession, plan)


def taken(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    plan, placed, mix = prepared(docs.select("doc_id", "source", "text"), weights)
    aims = F.broadcast(docs.sparkSession.createDataFrame([(k, float(t)) for k, t in enumerate(plan.targets)] or [(0, 0.0)], "a_k int, target double"))
    rows = each(placed)
    got = pieces(rows, mix).withColumn("w", (F.col("hi") - F.col("lo")) * F.col("times") + F.col("part") - F.col("lo"))
    got = got.groupBy(F.col("k").alias("g_k"), F.col("start").alias("g_start")).agg(F.sum("w").alias("w"))
    some = rows.where("size > 0").join(got, (F.col("k") == F.col("g_k")) & (F.col("start") == F.col("g_start")), "left")
    out = some.select("doc_id", "size", "k", "k_size", F.coalesce("w", F.lit(0)).alias("taken")).unionByName(rows.where("size = 0").select("doc_id", "size", "k", "k_size", F.lit(0).cast("long").alias("taken")))
    return out.join(aims, F.col("k") == F.col("a_k")).select("doc_id", "size", F.col("k_size").alias("source_size"), "target", "taken")


def mixed(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """The mix as documents: of each document a row for each time that any of its words are taken, with the text of those.

    A row in which all words are taken has the text as it was; else its runs of taken words stand in lines of their own, and n_chars,
    where there is such a column, is theirs. Columns are those of docs."""
    plan, placed, mix = prepared(docs, weights)
    placed = placed.where("size > 0")
    got = pieces(each(placed), mix).groupBy("k", "first", "start").agg(F.collect_list(F.struct("lo", "hi", "times", "part")).alias("g_spans"))
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *[c.alias(f"d_{n}") for c, n in zip(keyed(docs), ENTRY, strict=True)])

    def of(entries: DataFrame) -> DataFrame:
        """The rows of these entries, with the places of their sources' streams."""
        same = F.lit(True)
        for n in ENTRY:
            same = same & F.col(f"d_{n}").eqNullSafe(F.col(n))
        return rows.join(entries.select(*ENTRY, F.col("k").alias("p_k"), F.col("first").alias("p_first")), same).select("row", "p_k", "p_first")

    one = of(placed.where("copies = 1"))
    if plan.repeated:  # of rows that are equal one stands for all: each copy has its own spans
        again = placed.where("copies > 1")
        one = one.unionByName(of(F.broadcast(again) if plan.repeated <= REPEATED_BROADCAST else again).dropDuplicates(["p_k", "p_first"]))
    both = one.join(got, (F.col("p_k") == F.col("k")) & (F.col("p_first") == F.col("first")))
    word = re.compile(SPACE)

    @F.pandas_udf("array<string>")
    def texts(frame: pd.DataFrame) -> pd.Series:
        out = []
        for text, spans in zip(frame["text"], frame["spans"], strict=True):
            runs = sorted((s["lo"], s["hi"], s["times"], s["part"]) for s in spans)
            size, copies = max(r[1] for r in runs), []
            ends = None
            for c in range(max(t + (p > lo) for lo, _, t, p in runs)):
                take = []
                for lo, hi, times, part in runs:
                    hi = hi if c < times else part if c == times else lo
                    if hi > lo:
                        if take and take[-1][1] == lo:
                            take[-1][1] = hi
                        else:
                            take.append([lo, hi])
                if ends is None:
                    ends = [m.span() for m in word.finditer(text)]
                if take == [[0, len(ends)]]:
                    copies.append(text)
                elif take:
                    copies.append("\n".join(text[ends[lo][0] : ends[hi - 1][1]] for lo, hi in take))
            out.append(copies)
        return pd.Series(out, dtype=object)

    both = both.select("row", F.explode(texts(F.struct(F.col("row.text").alias("text"), F.col("g_spans").alias("spans")))).alias("t"))
    return both.select(*[F.col("t").alias(c) if c == "text" else F.length("t").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in names])


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    from .base import table

    return taken(table(spark, sf_dir, "documents"))

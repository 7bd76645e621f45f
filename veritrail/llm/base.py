"""What the corpus operators share: tables, stored steps, samples of labels, word caches, components."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, discard, scratch

#: A Python worker never gets more than this much text at once, whatever the row lengths.
BATCH_BYTES = 4 << 20
#: Entries that a worker's word cache may hold before it starts anew.
CACHE_WORDS = 400_000
SPACE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus. Also bounds the batches that Python workers get, in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: a cut in the lineage that survives executors.

    What is written goes when the application ends, or by `released`."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    MADE.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: What this application has stored and not released, the oldest first.
MADE: list[str] = []


def released(spark: SparkSession, since: int) -> None:
    """Deletes what was stored from MADE[since] on, but for the last: that is read from now on instead of the others."""
    for path in MADE[since:-1]:
        discard(spark, path)
    del MADE[since:-1]


def in_fold(column: str, parts: int, fold: int):
    """Whether crc32 of the id as text falls into this fold; a null id never does."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % parts == fold, F.lit(False))


def below(rows: int, most: int) -> int:
    """A limit for 64-bit hashes that about twice `most` of so many rows stay under, or all where there are not that many.

    The first `most` rows by hash are then among few: no task gets that many from every partition."""
    return (1 << 63) - 1 if rows <= 2 * most else int((1 << 64) * 2 * most / rows) - (1 << 63)


def sampled_labels(labels: DataFrame, label: str, parts: int, fold: int, rows: int) -> DataFrame:
    """At most `rows` (doc_id, y) outside the held-out fold, the first in an order by hash of the id.

    Rows without id or label are left out; an id that has several labels takes the largest."""
    known = labels.select(F.col("doc_id").alias("l_id"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("l_id").isNotNull() & F.col("y").isNotNull() & ~in_fold("l_id", parts, fold))
    limit = below(known.agg(F.approx_count_distinct("l_id")).first()[0], rows)
    return known.where(F.xxhash64("l_id") <= limit).groupBy("l_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("l_id"), "l_id").limit(rows)


class Words(dict):
    """A cache from a word to what `make` returns for it; starts anew when it has grown too large."""

    def __init__(self, make: Callable, limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = self.make(word)
        return found


_KEPT: dict[str, object] = {}
try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # not glibc
    _TRIM = None


def trim() -> None:
    """Gives memory that this worker has freed back to the machine."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def kept(token: str, make: Callable):
    """What `make` made in this worker for the token, or now makes. A worker keeps one such thing, so that the stages
    of a job, which share workers, do not add up."""
    if token not in _KEPT:
        _KEPT.clear()
        _KEPT[token] = make()
    trim()
    return _KEPT[token]


LETTERS = re.compile(r"[^\W\d_]+")


#: Edges that one task takes in a round of `components`.
EDGES = 250_000


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is the smallest node that it reaches.

    Alternating large-star and small-star steps; each joins a node's edges with the minimum of its
    neighbourhood, so that no task gathers a neighbourhood. Every round ends in a checkpoint; the last one leaves
    stars: each node has one edge, to a node that is the larger end of none. Steps run in as many tasks as the
    edges need, as the driver keeps account of each task. Null nodes and loops are left out."""
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now = cut(now)
    tasks = max(2 * now.sparkSession.sparkContext.defaultParallelism, -(-now.count() // EDGES))  # no step adds edges
    now = now.coalesce(tasks)
    for _ in range(rounds):
        ends = now.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(now.select("b", F.lit(0), F.lit(1)))
        ends = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).coalesce(tasks)
        if not ends.agg(F.count_if(F.expr("up > 1 or up > 0 and down > 0"))).first()[0]:
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("k")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").coalesce(tasks).distinct().coalesce(tasks)
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = large.join(least, F.col("a") == F.col("k"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks).union(least.select("k", "m").coalesce(tasks)).where("a > b").distinct()
        now = cut(small.coalesce(tasks))
    else:
        raise RuntimeError(f"components: no fixed point after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def groups(texts: list[str], most: int = 2 << 20):
    """The texts in runs of some bytes."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part

"""Hard negatives by dual-tree search.

Anchors and candidates are dealt by hash into blocks and shards of a bounded size; a task takes a block and a shard and builds a tree over
each: rows are split between labels first, then across their longest direction, and a node knows its labels, its centre and its radius.
From these follows an interval in which all inner products of two nodes lie. A pair of nodes goes as a whole where its labels do not fit, where
the interval ends below what every anchor of the node still needs, or begins above all of their limits; else the larger node is
split, the more promising half first. Pairs of leaves are scored exactly. What an anchor needs rises with what it has found. First each
anchor's positives are searched, the best rows of its label; then the best rows of other labels within a window that each positive's score sets.
A task yields the first few of its shard for each anchor, and the first of these over all shards are the result: nothing is lost.

Components are whole numbers. Products are exact: in double precision below 2**53, else as Python's integers; a score beyond a
long counts as the nearest long.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; rows that are equal once rounded are one;
rows of equal id and different contents are different rows; rows meet only those with as many components (an empty vector's score is 0);
equal scores go by id, then by the row's hash; anchors without positives, and positives without negatives, have no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import stored
from .words import raw

#: Rows of a shard and anchors of a block at most, about.
SHARD = 8192
LEAF, ANCHOR_LEAF = 256, 64
#: Components below this keep products of up to 8192 of them exact in double precision.
EXACT = 1 << 20
LONG = (-(1 << 63), (1 << 63) - 1)


class Tree:
    """Nodes over rows of x in a new order: node k holds order[low[k]:high[k]]; its halves are kids[k] and kids[k] + 1, none for a leaf (-1)."""

    def __init__(self, x: np.ndarray, label: np.ndarray, leaf: int):
        self.order = np.argsort(label, kind="stable")
        self.low, self.high, self.kids, self.parent = [0], [len(x)], [-1], [-1]
        centre, radius, k = [], [], 0
        while k < len(self.low):
            a, b = self.low[k], self.high[k]
            rows = self.order[a:b]
            middle = x[rows].mean(axis=0)
            away = ((x[rows] - middle) ** 2).sum(axis=1)
            centre.append(middle)
            radius.append(math.sqrt(away.max()))
            if b - a > leaf:
                mine, half = label[rows], (b - a) // 2
                if mine[0] != mine[-1]:  # the border between labels that is nearest to the middle
                    borders = np.nonzero(mine[1:] != mine[:-1])[0] + 1
                    half = int(borders[np.abs(borders - half).argmin()])
                elif radius[-1] > 0:  # from a far row to the row farthest from it
                    far = x[rows[away.argmax()]]
                    other = x[rows[((x[rows] - far) ** 2).sum(axis=1).argmax()]]
                    self.order[a:b] = rows[np.argsort(x[rows] @ (other - far), kind="stable")]
                self.kids[k] = len(self.low)
                self.low += [a, a + half]
                self.high += [a + half, b]
                self.kids += [-1, -1]
                self.parent += [k, k]
            k += 1
        self.centre, self.radius = np.array(centre), np.array(radius)
        self.norm = np.sqrt((self.centre**2).sum(axis=1))
        ordered = label[self.order]
        self.first, self.last = ordered[self.low], ordered[np.array(self.high) - 1]


class Best:
    """The k best hits of each (anchor, window): scores within [low, high], the highest first, then by id and place."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.need = low.astype(float)  # a score below cannot be among the best
        self.rows = [np.zeros(0, np.int64) for _ in range(5)]  # anchor, window, score, id, place

    def add(self, anchors: np.ndarray, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, places: np.ndarray) -> bool:
        """Takes the hits among the scores of anchors (down) with rows (across); whether there were any."""
        found = []
        for w in range(self.low.shape[1]):
            i, j = np.nonzero(fits & (scores >= self.need[anchors, w][:, None]) & (scores <= self.high[anchors, w][:, None]))
            if len(i):
                found.append((anchors[i], np.full(len(i), w), scores[i, j].astype(np.int64), ids[j], places[j]))
        if not found:
            return False
        mine = np.isin(self.rows[0], anchors)
        rows = [np.concatenate((old[mine], *new)) for old, new in zip(self.rows, zip(*found, strict=True), strict=True)]
        # a stable order by score, ties by id and place
        by = np.lexsort((rows[4], rows[3], -1 - rows[2], rows[1], rows[0]))
        rows = [r[by] for r in rows]
        new = np.concatenate(([True], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])))
        rank = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        full = rank == self.k - 1
        self.need[rows[0][full], rows[1][full]] = np.maximum(self.need[rows[0][full], rows[1][full]], rows[2][full].astype(float))
        self.rows = [np.concatenate((old[~mine], r[rank < self.k])) for old, r in zip(self.rows, rows, strict=True)]
        return True


class Side:
    """Rows of a tile that share their number of components: x (whole numbers as doubles), label, id and place."""

    def __init__(self, x: np.ndarray, label: np.ndarray, ids: np.ndarray, places: np.ndarray):
        self.x, self.label, self.ids, self.places = x, label, ids, places


def descend(a: Side, c: Side, of_a: np.ndarray, of_c: np.ndarray, same: bool, best: Best) -> tuple[int, int]:
    """Dual-tree search of rows of_a of a in rows of_c of c. The numbers of leaf pairs scored, and of all."""
    ta, tc = Tree(a.x[of_a], a.label[of_a], ANCHOR_LEAF), Tree(c.x[of_c], c.label[of_c], LEAF)
    between = ta.centre @ tc.centre.T
    reach = ta.norm[:, None] * tc.radius + tc.norm * ta.radius[:, None] + ta.radius[:, None] * tc.radius
    reach += 1e-6 * (1 + np.abs(between) + reach)  # more than rounding
    upper, lower = between + reach, between - reach
    if same:
        barred = (ta.last[:, None] < tc.first) | (ta.first[:, None] > tc.last)
    else:
        barred = (ta.first == ta.last)[:, None] & (tc.first == tc.last) & (ta.first[:, None] == tc.first)
    rows_of = [of_a[ta.order[low:high]] for low, high in zip(ta.low, ta.high, strict=True)]
    need = np.array([best.need[r].min() for r in rows_of])
    limit = np.array([best.high[r].max() for r in rows_of])
    barred |= lower > limit[:, None]
    scored, stack = 0, [(0, 0)]
    while stack:
        i, j = stack.pop()
        if barred[i, j] or upper[i, j] < need[i]:
            continue
        left, right = ta.kids[i], tc.kids[j]
        if left < 0 and right < 0:
            scored += 1
            rows, cols = rows_of[i], of_c[tc.order[tc.low[j] : tc.high[j]]]
            fits = (a.label[rows][:, None] == c.label[cols]) == same
            fits &= a.places[rows][:, None] != c.places[cols]
            if best.add(rows, a.x[rows] @ c.x[cols].T, fits, c.ids[cols], c.places[cols]):
                need[i], k = best.need[rows].min(), ta.parent[i]
                while k >= 0:
                    need[k], k = min(need[ta.kids[k]], need[ta.kids[k] + 1]), ta.parent[k]
        elif right < 0 or left >= 0 and ta.high[i] - ta.low[i] > tc.high[j] - tc.low[j]:
            stack += [(left, j), (left + 1, j)]
        else:
            stack += sorted(((i, right), (i, right + 1)), key=lambda p: upper[p])
    return scored, ta.kids.count(-1) * tc.kids.count(-1)


def scan(a: Side, c: Side, of_a: np.ndarray, of_c: np.ndarray, same: bool, best: Best) -> None:
    """The same by integers of any size, row by row."""
    for i in of_a.tolist():
        mine = [int(v) for v in a.x[i].tolist()]
        scores = [min(max(sum(p * int(q) for p, q in zip(mine, c.x[j].tolist(), strict=True)), LONG[0]), LONG[1]) for j in of_c.tolist()]
        fits = ((a.label[i] == c.label[of_c]) == same) & (a.places[i] != c.places[of_c])
        best.add(np.array([i]), np.array([scores], np.int64), fits[None], c.ids[of_c], c.places[of_c])


def search(a: Side, c: Side, same: bool, low: np.ndarray, high: np.ndarray, k: int) -> list[np.ndarray]:
    """The k best rows of c for each row of a and window [low, high]: (row of a, window, score, id, place)."""
    best = Best(low, high, k)
    small = [np.abs(s.x).max(axis=1, initial=0) < EXACT if s.x.shape[1] <= 8192 else np.zeros(len(s.x), bool) for s in (a, c)]
    (near_a, far_a), (near_c, far_c) = ((np.nonzero(s)[0], np.nonzero(~s)[0]) for s in small)
    if len(near_a) and len(near_c):
        descend(a, c, near_a, near_c, same, best)
    for of_a, of_c in ((near_a, far_c), (far_a, near_c), (far_a, far_c)):
        if len(of_a) and len(of_c):
            scan(a, c, of_a, of_c, same, best)
    return best.rows


def packed(vectors: DataFrame, scale: float) -> DataFrame:
    """(id, label, anchor, dim, v): distinct rows that take part; v has floor(scale * x) of each component, of 2 bytes where they fit, else as doubles."""
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.coalesce("anchor", F.lit(False)).alias("anchor"), F.col("vector").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)

    def pack(batches):
        for batch in batches:
            column = batch.column("vector")
            n = column.value_lengths().to_numpy()
            x = np.floor(scale * column.flatten().to_numpy())
            parts = np.split(x, np.cumsum(n)[:-1]) if len(n) else []
            v = [p.astype("<i2").tobytes() if not len(p) or np.abs(p).max() < 1 << 15 else p.astype("<f8").tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "label", "anchor")), pa.array(n.astype(np.int32)), pa.array(v, pa.binary())], ["id", "label", "anchor", "dim", "v"])

    return rows.mapInArrow(pack, "id long, label long, anchor boolean, dim int, v binary").groupBy("id", "label", "dim", "v").agg(F.max("anchor").alias("anchor"))


def sides(table: pa.Table) -> dict[int, tuple[np.ndarray, Side]]:
    """The rows of a tile by number of components: their numbers in the table, and what they hold."""
    dim, column = table.column("dim").to_numpy(), table.column("v").combine_chunks().cast(pa.large_binary())
    label, ids, places = (table.column(c).to_numpy() for c in ("label", "id", "place"))
    data, ends = raw(column)
    size, out = np.diff(ends, prepend=0), {}
    for d in np.unique(dim).tolist():
        rows = np.nonzero(dim == d)[0]
        x = np.zeros((len(rows), d))
        for width, kind in ((2, "<i2"), (8, "<f8")):
            these = np.nonzero(size[rows] == width * d)[0] if d else rows[:0]
            at = (ends - size)[rows[these]][:, None] + np.arange(width * d)
            x[these] = data[at].reshape(-1).view(kind).reshape(len(these), d)
        out[d] = (rows, Side(x, label[rows], ids[rows], places[rows]))
    return out


def tiles(anchors: DataFrame, rows: DataFrame, blocks: int, shards: int, same: bool, k: int, low: int = 0, high: int = 0) -> DataFrame:
    """(a_place, given, id, place, score): the first k rows of each shard for each anchor, or for each anchor and score in its `given`
    those within low to high hundredths of it."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out, found = [], sides(right) if right.num_rows else {}
        given = left.column("given").to_pylist() if left.num_rows else []
        for d, (rows_a, a) in (sides(left) if left.num_rows else {}).items():
            if d not in found:
                continue
            windows = [given[i] for i in rows_a.tolist()]
            width = max(map(len, windows))
            begin, end = np.full((len(rows_a), width), np.inf), np.full((len(rows_a), width), -np.inf)
            for i, scores in enumerate(windows):
                for w, s in enumerate(scores):
                    begin[i, w], end[i, w] = (-np.inf, np.inf) if s is None else (-(-low * s // 100), high * s // 100)
            i, w, score, ids, places = search(a, found[d][1], same, begin, end, k)
            out.append((a.places[i], [windows[p][q] for p, q in zip(i.tolist(), w.tolist(), strict=True)], ids, places, score))
        columns = zip(*out, strict=True) if out else [[]] * 5
        return pa.table([pa.array([v for part in c for v in (part if isinstance(part, list) else part.tolist())], pa.int64()) for c in columns], ["a_place", "given", "id", "place", "score"])

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("place"), F.lit(n).cast("long"))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    columns = ["id", "label", "dim", "v", "place"]
    left = anchors.select(*columns, "given", dealt(blocks).alias("block"), every(shards).alias("shard"))
    # columns of their own: a cogroup of two sides of one table otherwise loses some of them
    right = rows.select(*[F.col(c).alias(c) for c in columns], every(blocks).alias("block"), dealt(shards).alias("shard"))
    return left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(meet, "a_place long, given long, id long, place long, score long")


def first_of(rows: DataFrame, keys: list[str], k: int, order: list[Column]) -> DataFrame:
    """The first k rows of each key, with their rank."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def mined(vectors: DataFrame, scale: float = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from rows (id, label, vector, anchor)."""
    rows = packed(vectors, scale).withColumn("place", F.monotonically_increasing_id())
    rows = stored(rows, "vectors")
    n, n_anchors = rows.agg(F.count("*"), F.count_if("anchor")).first()
    blocks, shards = max(1, -(-n_anchors // SHARD)), max(1, -(-n // SHARD))
    anchors = rows.where("anchor")
    order = [F.desc("score"), F.col("id"), F.col("place")]
    near = tiles(anchors.withColumn("given", F.array(F.lit(None).cast("long"))), rows, blocks, shards, True, positives)
    near = stored(first_of(near, ["a_place"], positives, order).select("a_place", F.col("id").alias("positive_id"), F.col("place").alias("p_place"), F.col("score").alias("positive_score")), "positives")
    given = near.groupBy("a_place").agg(F.collect_set("positive_score").alias("given"))
    windows = anchors.join(given, F.col("place") == F.col("a_place")).drop("a_place")
    far = first_of(tiles(windows, rows, blocks, shards, False, negatives, low, high), ["a_place", "given"], negatives, order)
    far = far.select(F.col("a_place").alias("n_a_place"), "given", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("id").alias("anchor_id"), F.col("place").alias("anchor_place"))
    out = near.join(far, (F.col("a_place") == F.col("n_a_place")) & (F.col("positive_score") == F.col("given"))).join(ids, F.col("a_place") == F.col("anchor_place"))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    from .base import table

    vec, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    label = F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label)
    return mined(table(spark, sf_dir, "embeddings").select(vec.alias("id"), label.alias("label"), F.col("embedding").alias("vector"), (vec % 100 == 0).alias("anchor")))

"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Vectors meet only within a label (and a dimension). Equal vectors are one entry with a multiplicity. A label's entries are dealt by hash
into shards of at most about SHARD_ROWS entries and SHARD_BYTES; each shard gets a graph, built from batches of entries, and an audit: probes at
just the threshold's cosine from known entries, and exact searches for some entries, both to be found again. The beam is doubled until
RECALL of them are; a beam as wide as the shard that still misses gives way to a scan. Graphs are stored in the shared folder. Then
every entry queries every shard of its label. A query whose beam holds nothing but neighbours within the threshold goes on with a wider one,
and by a scan beyond an eighth of the shard, so that there is no cap on partners. Hits are verified by their cosine in double precision.

A task takes two shards and searches both ways: what either end finds is a link of both, so that a link is lost only if both ends miss it,
and both count it. It emits numbers of links, and a spanning forest of the links instead of all of them; components are their unions.

Defined cases: null labels, and vectors that are null, empty, zero, or hold null or non-finite components, link with nothing; equal
rows link with each other; of rows with a null vec_id only those link that equal a row with one;
other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import components, cut, stored
from .simhash import forest

#: Entries of a shard at most, about, and bytes of their vectors in double precision.
SHARD_ROWS, SHARD_BYTES = 8192, 16 << 20
#: Labels whose sizes are broadcast; more are joined by shuffle.
LABELS_BROADCAST = 50_000
LINKS, BASE_LINKS, BUILD_BEAM = 12, 24, 48
FIRST_BEAM, RECALL, AUDITS = 48, 0.995, 256
CELLS = 1 << 25  # of the matrix of what queries have visited


class Graph:
    def __init__(self, x: np.ndarray, seed: int = 11):
        """x: unit vectors, single precision."""
        self.x, n = x, len(x)
        rng = np.random.default_rng(seed)
        level = np.minimum((-np.log(rng.random(n)) / np.log(LINKS)).astype(int), 12)
        self.order = np.argsort(-level, kind="stable")
        self.level = level
        self.top = int(level.max(initial=0))
        self.near = [np.full((n, BASE_LINKS if lv == 0 else LINKS), -1, np.int32) for lv in range(self.top + 1)]
        self.entry = int(self.order[0])
        done = 1
        while done < n:
            batch = self.order[done : done + min(256, max(1, done // 2))]
            self.insert(batch)
            done += len(batch)
        self.connect()

    def connect(self) -> None:
        """Gives every node of the base level that no path from the entry reaches a link from its nearest node that one does."""
        n = len(self.x)
        more = np.full(n, -1, np.int32)  # one more link of each node
        reached = np.zeros(n, bool)
        front = np.array([self.entry])
        while True:
            while len(front):
                reached[front] = True
                there = np.unique(self.near[0][front])
                front = there[there >= 0]
                front = front[~reached[front]]
            lost = np.nonzero(~reached)[0]
            if not len(lost):
                break
            lost = lost[:256]
            inside = np.nonzero(reached)[0]
            for u, v in zip(lost.tolist(), inside[(self.x[lost] @ self.x[inside].T).argmax(axis=1)].tolist(), strict=True):
                while more[v] >= 0:
                    v = int(more[v])
                more[v] = u
            front = lost
        self.near[0] = np.concatenate((self.near[0], more[:, None]), axis=1)

    def insert(self, batch: np.ndarray) -> None:
        q = self.x[batch]
        among = q @ q.T
        np.fill_diagonal(among, -2)
        start = np.full((len(batch), 1), self.entry, np.int32)
        for lv in range(self.top, -1, -1):
            mine = self.level[batch] >= lv
            if not mine.all():
                start[~mine] = self.search(q[~mine], start[~mine], 1, lv)[0][:, :1]
            if not mine.any():
                continue
            b = batch[mine]
            ids, sims = self.search(q[mine], start[mine], BUILD_BEAM, lv)
            start[mine] = ids[:, :1]
            m = min(16, len(b) - 1)
            if m > 0:
                own = among[np.ix_(mine, mine)]
                close = np.argpartition(-own, m - 1, axis=1)[:, :m]
                ids = np.concatenate((ids, b[close].astype(np.int32)), axis=1)
                sims = np.concatenate((sims, np.take_along_axis(own, close, axis=1)), axis=1)
            chosen = self.select(ids, sims, LINKS)
            near = self.near[lv]
            near[b, : chosen.shape[1]] = chosen
            # links back, with a new choice where a list is full
            row, col = np.nonzero(chosen >= 0)
            to, frm = chosen[row, col], b[row].astype(np.int32)
            by = np.argsort(to, kind="stable")
            to, frm = to[by], frm[by]
            nodes, first, count = np.unique(to, return_index=True, return_counts=True)
            wide = np.full((len(nodes), near.shape[1] + int(count.max(initial=0))), -1, np.int32)
            wide[:, : near.shape[1]] = near[nodes]
            wide[np.repeat(np.arange(len(nodes)), count), near.shape[1] + np.arange(len(to)) - np.repeat(first, count)] = frm
            wide = -np.sort(-wide, axis=1)
            wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
            full = (wide >= 0).sum(1) > near.shape[1]
            wide = -np.sort(-wide, axis=1)
            near[nodes[~full]] = wide[~full, : near.shape[1]]
            for k in range(0, int(full.sum()), 512):
                f, w = nodes[full][k : k + 512], wide[full][k : k + 512]
                s = np.einsum("kcd,kd->kc", self.x[np.maximum(w, 0)], self.x[f])
                s[w < 0] = -2
                near[f] = self.select(w, s, near.shape[1])

    def select(self, ids: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
        """Up to m of each row's candidates: those closer to the row than to any chosen before, then the closest of the rest."""
        by = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, by, axis=1), np.take_along_axis(sims, by, axis=1)
        ids = np.where(sims > -1.5, ids, -1)
        x = self.x[np.maximum(ids, 0)]
        between = np.einsum("kcd,ked->kce", x, x)
        kept = np.zeros(ids.shape, bool)
        for c in range(ids.shape[1]):
            covered = (kept[:, :c] & (between[:, c, :c] > sims[:, c, None])).any(1)
            same = (ids[:, :c] == ids[:, c, None]).any(1)
            kept[:, c] = (ids[:, c] >= 0) & ~covered & ~same & (kept.sum(1) < m)
            ids[same, c] = -1
        rank = np.where(kept, 0, np.where(ids >= 0, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        first = np.argsort(rank, axis=1)[:, :m]
        return np.take_along_axis(ids, first, axis=1)

    def search(self, q: np.ndarray, start: np.ndarray, beam: int, lv: int, ahead: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The beam of each query on a level, the closest first: ids (-1 where there are fewer) and cosines."""
        b, n = len(q), len(self.x)
        beam_ids, beam_sims = np.full((b, beam), -1, np.int32), np.full((b, beam), -2, np.float32)
        k = min(start.shape[1], beam)
        beam_ids[:, :k] = start[:, :k]
        beam_sims[:, :k] = np.where(start[:, :k] >= 0, np.einsum("bkd,bd->bk", self.x[np.maximum(start[:, :k], 0)], q), -2)
        seen = np.zeros((b, n + 1), bool)
        np.put_along_axis(seen, np.where(beam_ids >= 0, beam_ids, n), True, axis=1)
        open_ = beam_ids >= 0
        ahead = min(ahead, beam)
        rows = np.arange(b)
        while len(rows):
            s = np.where(open_[rows], beam_sims[rows], -3)
            pick = np.argpartition(-s, ahead - 1, axis=1)[:, :ahead] if ahead < beam else np.tile(np.arange(beam), (len(rows), 1))
            live = np.take_along_axis(s, pick, axis=1) > -2.5
            go = live.any(1)
            rows, pick, live = rows[go], pick[go], live[go]
            if not len(rows):
                break
            at = np.where(live, np.take_along_axis(beam_ids[rows], pick, axis=1), -1)
            mark = open_[rows]
            np.put_along_axis(mark, pick, False, axis=1)
            open_[rows] = mark
            new = np.where((at >= 0)[:, :, None], self.near[lv][np.maximum(at, 0)], -1).reshape(len(rows), -1)
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new[seen[rows[:, None], np.where(new >= 0, new, n)]] = -1
            seen[rows[:, None], np.where(new >= 0, new, n)] = True
            seen[:, n] = False
            some = (new >= 0).any(1)
            rows, new = rows[some] if not some.all() else rows, new[some] if not some.all() else new
            if not len(rows):
                rows = np.nonzero(open_.any(1))[0]
                continue
            width = int((new >= 0).sum(1).max())
            new = -np.sort(-new, axis=1)[:, :width]
            sims = np.einsum("bkd,bd->bk", self.x[np.maximum(new, 0)], q[rows])
            sims[new < 0] = -2
            ids = np.concatenate((beam_ids[rows], new), axis=1)
            sims = np.concatenate((beam_sims[rows], sims), axis=1)
            fresh = np.concatenate((open_[rows], new >= 0), axis=1)
            best = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
            beam_ids[rows], beam_sims[rows] = np.take_along_axis(ids, best, axis=1), np.take_along_axis(sims, best, axis=1)
            open_[rows] = np.take_along_axis(fresh, best, axis=1) & (beam_ids[rows] >= 0)
            rows = np.nonzero(open_.any(1))[0]
        by = np.argsort(-beam_sims, axis=1, kind="stable")
        return np.take_along_axis(beam_ids, by, axis=1), np.take_along_axis(beam_sims, by, axis=1)

    def within(self, q: np.ndarray, least: float, beam: int):
        """(query, id) pairs with a cosine of about `least` or more. A beam of 0 stands for a scan."""
        n = len(self.x)
        if beam == 0 or beam >= n:
            for k in range(0, len(q), max(1, CELLS // n)):
                i, j = np.nonzero(q[k : k + max(1, CELLS // n)] @ self.x.T >= least)
                yield i + k, j
            return
        step = max(1, min(1024, CELLS // n))
        for k in range(0, len(q), step):
            rows, width = np.arange(k, min(len(q), k + step)), beam
            start = np.full((len(rows), 1), self.entry, np.int32)
            for lv in range(self.top, 0, -1):
                start = self.search(q[rows], start, 1, lv)[0]
            while len(rows):
                ids, sims = self.search(q[rows], start, width, 0)
                more = sims[:, -1] >= least  # nothing but neighbours: there may be others
                i, j = np.nonzero((sims >= least) & ~more[:, None])
                yield rows[i], ids[i, j]
                rows, start, width = rows[more], ids[more], 2 * width
                if 8 * width >= n and len(rows):
                    for i, j in self.within(q[rows], least, 0):
                        yield rows[i], j
                    break


def audit(graph: Graph, least: float, seed: int = 5) -> tuple[int, float]:
    """The beam with which the shard's probes are found, and the recall measured with it; 0 for a scan."""
    rng = np.random.default_rng(seed)
    n, d = graph.x.shape
    if n <= 2 * FIRST_BEAM:
        return 0, 1.0
    some = rng.choice(n, min(n, AUDITS), replace=False)
    u = rng.normal(size=(len(some), d))
    u -= (u * graph.x[some]).sum(1, keepdims=True) * graph.x[some]
    u /= np.maximum(np.sqrt((u**2).sum(1, keepdims=True)), 1e-12)
    t = least + 0.002
    probes = (t * graph.x[some] + np.sqrt(max(0, 1 - t * t)) * u).astype(np.float32)
    want = {(len(some) + i, j) for i, j in zip(*(x.tolist() for x in np.nonzero(graph.x[some] @ graph.x.T >= least)), strict=True)}
    want |= {(i, j) for i, j in enumerate(some.tolist())} if d > 1 else set()
    beam = FIRST_BEAM
    while beam < n:
        got = {(int(i), int(j)) for a, b in graph.within(np.concatenate((probes, graph.x[some])), least, beam) for i, j in zip(a, b, strict=True)}
        asked, found = Counter(i for i, _ in want), Counter(i for i, _ in got & want)
        recall = sum(found[i] / n for i, n in asked.items()) / len(asked)  # of each query alike, however many neighbours it has
        if recall >= RECALL:
            return beam, recall
        beam *= 2
    return 0, 1.0


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first so that no square leaves the range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def entries(vectors: DataFrame) -> DataFrame:
    """(label, v, id, n): distinct vectors that can link, their smallest vec_id and their number."""
    v = F.col("embedding").cast("array<double>")
    sound = F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.coalesce(sound, F.lit(False))).groupBy("label", v.alias("v")).agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))


def shard_graphs(rows: DataFrame, threshold: float) -> DataFrame:
    """(label, dim, shard, shards, beam, recall, graph) for rows (label, dim, shard, shards, id, n, v)."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        x = unit(np.stack(frame["v"].to_numpy()).astype(float))
        graph = Graph(x.astype(np.float32))
        beam, recall = audit(graph, threshold)
        graph.x = None  # the entries' vectors are there in double precision
        body = pickle.dumps((graph, x, frame["id"].to_numpy(np.int64), frame["n"].to_numpy(np.int64)), protocol=5)
        return frame[["label", "dim", "shard", "shards"]].iloc[:1].assign(beam=beam, recall=recall, graph=[body])

    return rows.groupBy("label", "dim", "shard").applyInPandas(build, "label long, dim int, shard int, shards int, beam int, recall double, graph binary")


def opened(body: bytes) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    graph, x, ids, n = pickle.loads(body)
    graph.x = x.astype(np.float32)
    return graph, x, ids, n


def meet(a: tuple, b: tuple, beams: tuple[int, int], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of links of a's entries in b and of b's in a, and a forest of the links. a and b may be the same shard."""
    same = a[2] is b[2]
    hits = np.zeros((len(a[2]), len(b[2])), bool)
    for one, other, beam, to in ((a, b, beams[1], hits), (b, a, beams[0], hits.T)):
        for i, j in one_way(one, other, beam, threshold):
            to[i, j] = True
        if same:
            hits |= hits.T
            np.fill_diagonal(hits, False)
            break
    mine, theirs = np.zeros(len(hits), np.int64), np.zeros(hits.shape[1], np.int64)
    pairs, size = [(a[2][:0], a[2][:0])], 0
    step = max(1, (1 << 21) // max(1, hits.shape[1]))
    for k in range(0, len(hits), step):
        i, j = np.nonzero(hits[k : k + step])
        if len(i):
            i += k
            mine += np.bincount(i, b[3][j], len(mine)).astype(np.int64)
            theirs += np.bincount(j, a[3][i], len(theirs)).astype(np.int64)
            pairs.append(forest(a[2][i], b[2][j]))
            size += len(pairs[-1][0])
            if size > 4 * (len(mine) + len(theirs)):
                pairs = [forest(*(np.concatenate(p) for p in zip(*pairs, strict=True)))]
                size = len(pairs[0][0])
    return mine, theirs, *(np.concatenate(p) for p in zip(*pairs, strict=True))


def one_way(one: tuple, other: tuple, beam: int, threshold: float):
    """Pairs (i, j) of an entry of one and an entry of the other that its own query finds there, and that are as close as it takes."""
    for i, j in other[0].within(one[0].x, threshold - 1e-4, beam):
        for k in range(0, len(i), 1 << 16):
            p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            exact = np.einsum("kd,kd->k", one[1][p], other[1][q]) >= threshold
            yield p[exact], q[exact]


def linked(vectors: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entries (label, v, id, n), links of each entry (id, links) and forest edges (a, b)."""
    own = cut(entries(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")))
    rows = own.where("id is not null").withColumn("dim", F.size("v"))
    sizes = rows.groupBy("label", "dim").count()
    most = F.least(F.lit(SHARD_ROWS), F.greatest(F.lit(64), F.floor(F.lit(SHARD_BYTES) / (8 * F.col("dim")))))
    sizes = cut(sizes.select(F.col("label").alias("s_label"), F.col("dim").alias("s_dim"), F.ceil(F.col("count") / most).cast("int").alias("shards")))
    if sizes.count() <= LABELS_BROADCAST:
        sizes = F.broadcast(sizes)
    members = rows.join(sizes, (F.col("label") == F.col("s_label")) & (F.col("dim") == F.col("s_dim"))).withColumn("shard", F.pmod(F.xxhash64("id"), "shards").cast("int"))
    graphs = stored(shard_graphs(members.select("label", "dim", "shard", "shards", "id", "n", "v"), threshold), "graphs")
    # each pair of shards of a label meets once, a shard with itself too
    sides = graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    sides = sides.select("label", "dim", F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high"), "shard", "beam", "graph")

    def query(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard")
        shards = [opened(g) for g in frame["graph"]]
        beams = frame["beam"].tolist()
        a, b = shards[0], shards[-1]
        mine, theirs, p, q = meet(a, b, (beams[0], beams[-1]), threshold)
        ends = [(a, mine), (b, theirs)][: len(shards)]
        ids, links = (np.concatenate(x) for x in zip(*((e[2][n > 0], n[n > 0]) for e, n in ends), strict=True))
        return pd.DataFrame({"a": np.concatenate((ids, p)), "b": np.concatenate((ids, q)), "links": np.concatenate((links, np.zeros(len(p), np.int64)))})

    out = stored(sides.groupBy("label", "dim", "low", "high").applyInPandas(query, "a long, b long, links long"), "links")
    return own, out.where("links > 0").groupBy(F.col("a").alias("l_id")).agg(F.sum("links").alias("links")), out.where("links = 0").select("a", "b")


def near_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    own, links, edges = linked(vectors, threshold)
    found = components(edges)
    known = own.join(links, F.col("id") == F.col("l_id"), "left").join(found, F.col("id") == F.col("node"), "left")
    known = known.select(F.col("label").alias("k_label"), F.col("v").alias("k_v"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("k_links"), F.coalesce("component", "id").alias("k_component"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.join(known, (F.col("label") == F.col("k_label")) & (F.col("v") == F.col("k_v")), "left")
    out = rows.select("vec_id", F.coalesce("k_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("k_component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_hnsw(spark, sf_dir: str) -> DataFrame:
    from .base import table

    return near_vectors(table(spark, sf_dir, "embeddings"), 0.93)

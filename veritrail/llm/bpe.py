"""Byte-level BPE: encoding by padded matrices, and decoding.

A text falls into chunks that its merges cannot cross; each distinct chunk of a worker is encoded once. The
new chunks of a batch are split by the pattern into pieces. Pieces that are tokens are done; the others are
dealt into length buckets, each a matrix with one row a piece, padded at the end. In each round every row
merges its leftmost pair of minimum rank; ranks of pairs come from an open-addressing hash table, and rows
are compacted after each merge and leave the matrix once no pair of theirs merges. A piece beyond LONGEST bytes is a matrix of one
row, in which a round takes all the merges that would follow one another with the same pair: its rounds are as many as the
pairs that merge in it, not as its bytes.

Defined cases: a null text is an empty one (no tokens); repeated rows come as often as they are given; a null
doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import CACHE_WORDS, kept
from .words import Numbers, gathered, hashed, raw, runs

LONGEST = 1024
NONE = np.uint32(0xFFFFFFFF)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Pairs:
    """Open addressing from a pair of ids to the id of the merged token."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        key, value = np.array(keys, np.uint64), np.array(values, np.uint32)
        self.bits = max(4, int(4 * len(key) + 1).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.full(1 << self.bits, NONE)
        slot, self.probes = self.slot(key), 0
        while len(key):
            self.probes += 1
            free = self.keys[slot] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, first = np.unique(slot, return_index=True)
            put = np.zeros(len(key), bool)
            put[first] = True
            put &= free
            self.keys[slot[put]], self.values[slot[put]] = key[put], value[put]
            key, value, slot = key[~put], value[~put], (slot[~put] + 1) & ((1 << self.bits) - 1)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair; NONE where it does not merge."""
        key = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
        slot = self.slot(key)
        there = self.keys[slot]
        out = np.where(there == key, self.values[slot], NONE)
        rest = np.nonzero((there != key) & (there != np.uint64(0xFFFFFFFFFFFFFFFF)))[0]
        for step in range(1, self.probes):
            if not len(rest):
                break
            at = (slot[rest] + step) & ((1 << self.bits) - 1)
            there = self.keys[at]
            hit = there == key[rest]
            out[rest[hit]] = self.values[at[hit]]
            rest = rest[~hit & (there != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pairs = ranks, Pairs(ranks)
        self.split = regex.compile(pattern).findall
        self.byte = np.full(256, NONE)
        for i in range(256):
            self.byte[i] = ranks.get(bytes([i]), NONE)
        self.tokens = [b""] * (max(ranks.values(), default=0) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.start()

    def start(self) -> None:
        """An empty cache: chunk n has ids flat[offsets[n]:offsets[n] + lengths[n]]."""
        self.numbers = Numbers()
        self.lengths, self.offsets, self.flat = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length."""
        n, width = len(pieces), max(map(len, pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        ids = np.full((n, width), NONE)
        ids[np.arange(width) < lengths[:, None]] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        out: list[np.ndarray] = [ids[:0, 0]] * n
        row = np.arange(n)
        cost = np.full((n, max(1, width - 1)), NONE)
        if width > 1:
            a, b = ids[:, :-1], ids[:, 1:]
            cost[:] = np.where((a != NONE) & (b != NONE), self.pairs(a.ravel(), b.ravel()).reshape(a.shape), NONE)
        while len(row):
            at = cost.argmin(axis=1)
            low = cost[np.arange(len(row)), at]
            done = low == NONE
            for r in np.nonzero(done)[0]:
                out[row[r]] = ids[r, : lengths[r]].copy()
            if done.any():
                go = ~done
                ids, cost, lengths, row, at, low = ids[go], cost[go], lengths[go], row[go], at[go], low[go]
                if not len(row):
                    break
            width = int(lengths.max())
            ids, cost = ids[:, :width], cost[:, : max(1, width - 1)]
            each = np.arange(len(row))
            # compaction: what stands right of the pair moves one place left
            col = np.arange(width)
            take = np.minimum(col + (col > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, take, axis=1)
            ids[each, at] = low
            lengths = lengths - 1
            ids[each, lengths] = NONE
            col = np.arange(cost.shape[1])
            cost = np.take_along_axis(cost, np.minimum(col + (col >= at[:, None]), cost.shape[1] - 1), axis=1)
            cost[each[lengths <= cost.shape[1]], np.maximum(lengths[lengths <= cost.shape[1]] - 1, 0)] = NONE
            for side in (at - 1, at):  # the pairs that the new token is part of
                ok = (side >= 0) & (side + 1 < lengths)
                r, c = each[ok], side[ok]
                cost[r, c] = self.pairs(ids[r, c], ids[r, c + 1])
        return out

    def row(self, piece: bytes) -> np.ndarray:
        """The ids of one long piece.

        In a round the pair of minimum rank merges wherever it stands, from the left, until a merge makes a pair of a lower rank: that one is next."""
        ids = self.byte[np.frombuffer(piece, np.uint8)]
        cost = np.append(np.where((ids[:-1] != NONE) & (ids[1:] != NONE), self.pairs(ids[:-1], ids[1:]), NONE), NONE)
        while len(ids) > 1 and (low := cost.min()) != NONE:
            at = np.nonzero(cost == low)[0]
            run = np.concatenate(([True], np.diff(at) != 1))  # of a, a, a the first two merge
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))) % 2 == 0]
            left, right = ids[at - 1], ids[np.minimum(at + 2, len(ids) - 1)]
            left[1:][at[1:] - at[:-1] == 2] = low
            new = np.full(len(at), low, np.uint32)
            before = np.where(at > 0, self.pairs(left, new), NONE)
            after = np.where(at + 2 < len(ids), self.pairs(new, right), NONE)
            lower = np.nonzero(np.minimum(before, after) < low)[0]
            if len(lower):
                at = at[: lower[0] + 1]
            ids[at] = low
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, cost, at = ids[stay], cost[stay], at - np.arange(len(at))
            side = np.unique(np.concatenate((at - 1, at)))
            side = side[(side >= 0) & (side + 1 < len(ids))]
            cost[side] = self.pairs(ids[side], ids[side + 1])
            cost[-1] = NONE
        return ids

    def pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (rank := self.ranks.get(p)) is not None:
                out[i] = np.array([rank], np.uint32)
            elif len(p) > LONGEST:
                out[i] = self.row(p)
            else:
                buckets.setdefault((len(p) - 1).bit_length(), []).append(i)
        for level, rows in buckets.items():
            step = max(64, (1 << 20) >> level)
            for k in range(0, len(rows), step):
                for i, ids in zip(rows[k : k + step], self.matrix([pieces[i] for i in rows[k : k + step]]), strict=True):
                    out[i] = ids
        return out

    def learn(self, chunks: list[bytes]) -> None:
        """Adds the ids of new chunks to the cache."""
        split = [self.split(c.decode("utf-8", "surrogatepass")) for c in chunks]
        distinct = {p: i for i, p in enumerate(dict.fromkeys(p for ps in split for p in ps))}
        ids = self.pieces([p.encode("utf-8", "surrogatepass") for p in distinct])
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        at = np.fromiter((distinct[p] for ps in split for p in ps), np.int64)
        found, sizes = gathered(np.concatenate(ids) if ids else np.zeros(0, np.uint32), np.cumsum(n) - n, n, at)
        upto = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))]
        self.lengths = np.concatenate((self.lengths, np.diff(upto, prepend=0).astype(np.int32)))
        self.offsets = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        self.flat = np.concatenate((self.flat, found))

    def chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all texts, the lengths of the chunks that they fall into, and the number of chunks up to each text's end.

        Merges do not depend on other chunks. Where every white space of a text stands alone and is ASCII, they are words with the
        blank before them, other white space, and what begins with a stop or comma after an ASCII letter; else the matches of the pattern."""
        data, ends = raw(texts)
        begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        blank = WHITE[data]
        odd = np.zeros(len(data) + 1, np.int64)
        bad = strange(data)
        bad[1:] |= blank[1:] & blank[:-1]
        np.cumsum(bad, out=odd[1:])
        full = ends > begins
        plain = np.ones(len(ends), bool)
        b, e = begins[full], ends[full]
        plain[full] = (odd[e] == odd[b]) & ~blank[b] & ~blank[e - 1]
        cut = data == 32
        line = blank & ~cut
        cut |= line
        cut[1:] |= line[:-1] | ((data[1:] == 44) | (data[1:] == 46)) & LETTER[data[:-1]]
        owner = np.repeat(np.arange(len(ends)), ends - begins)
        cut &= plain[owner]
        cut[b] = True
        more = [(k, np.cumsum([len(p.encode("utf-8", "surrogatepass")) for p in self.split(texts[int(k)].as_py())])[:-1]) for k in np.nonzero(~plain)[0]]
        for k, places in more:
            cut[begins[k] + places] = True
        starts = np.nonzero(cut)[0]
        return data, np.diff(starts, append=len(data)), np.searchsorted(starts, ends)

    def __call__(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if self.numbers.count > CACHE_WORDS:
            self.start()
        data, lengths, upto = self.chunks(texts)
        keys = hashed(data, lengths)
        at = self.numbers(*keys)
        while len(new := np.nonzero(at < 0)[0]):
            new = new[np.unique(keys[0][new], return_index=True)[1]]
            body, first = data.tobytes(), np.cumsum(lengths) - lengths
            self.learn([body[s : s + n] for s, n in zip(first[new].tolist(), lengths[new].tolist(), strict=True)])
            self.numbers.add(keys[0][new], keys[1][new])
            at = self.numbers(*keys)
        ids, n = gathered(self.flat, self.offsets, self.lengths, at)
        return np.split(ids, np.concatenate(([0], np.cumsum(n)))[upto[:-1]]) if len(texts) else []

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


WHITE, LEAD, LETTER = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LETTER[65:91] = LETTER[97:123] = True
LEAD[[28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = True


def strange(data: np.ndarray) -> np.ndarray:
    """Where white space beyond ASCII's begins, or control characters that some take for such."""
    out = np.zeros(len(data), bool)
    at = np.nonzero(LEAD[data])[0]
    if len(at):
        a = data[at]
        b, c = (data[np.minimum(at + k, len(data) - 1)] for k in (1, 2))
        general = (b == 0x80) & ((c <= 0x8A) | np.isin(c, (0xA8, 0xA9, 0xAF))) | (b == 0x81) & (c == 0x9F)
        out[at] = (a < 32) | (a == 0xC2) & np.isin(b, (0x85, 0xA0)) | (a == 0xE1) & (b == 0x9A) | (a == 0xE2) & general | (a == 0xE3) & (b == 0x80)
    return out


def encoder(path: str, pattern: str) -> Encoder:
    """A worker's encoder; the rank file is read where the worker runs, like the library it comes with."""
    return kept(f"bpe {path} {pattern}", lambda: Encoder(read_ranks(path), pattern))


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the ids of every text, an array of int."""

    @F.pandas_udf("array<int>")
    def of(texts: pd.Series) -> pd.Series:
        e, out = encoder(path, pattern), []
        for part in runs(pa.array([t or "" for t in texts], pa.string()), 2 << 20):
            out += [x.astype(np.int32) for x in e(part)]
        return pd.Series(out, dtype=object)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), of(F.col("text")).alias("ids"))


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) from (doc_id, ids)."""

    @F.pandas_udf("binary")
    def of(ids: pd.Series) -> pd.Series:
        e = encoder(path, pattern)
        return pd.Series([e.decode(np.asarray(x, np.uint32)) if x is not None else b"" for x in ids], dtype=object)

    return tokens.select("doc_id", of(F.col("ids")).alias("bytes"))


def digests(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = (), ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, and its ids decoded again.

    keep: columns of docs that come along; ids: whether the ids do."""
    kinds = "ids array<int>, " * ids + "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.pandas_udf(kinds)
    def of(texts: pd.Series) -> pd.DataFrame:
        e, out = encoder(path, pattern), []
        for part in runs(pa.array([t or "" for t in texts], pa.string()), 2 << 20):
            for found in e(part):
                row = (len(found), hashlib.sha256(found.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(e.decode(found)).hexdigest())
                out.append((found.astype(np.int32), *row) if ids else row)
        return pd.DataFrame(out, columns=[k.split()[0] for k in kinds.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f"`{c}`") for c in keep], of(F.col("text")).alias("d")).select("doc_id", *[f"`{c}`" for c in keep], "d.*")


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .base import table

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

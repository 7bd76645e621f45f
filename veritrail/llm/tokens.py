"""Token ids on disk: a static range asymmetric numeral system in shards.

File format. A shard is one binary value: a header; the shard's frequency table, shared by all of its blocks;
the documents (ids and token counts, in ascending id order); then blocks. A block holds up to BLOCK ids in LANES
interleaved coder states. The block directory is the list of checkpoints: for each block its number of ids, the
place of its first word, its final states and two checksums, of its words and of its ids, so that any block is
decoded and verified by itself, and all blocks of a shard are decoded side by side.

A shard closes at a document boundary once it holds SHARD ids: what a task keeps is one shard.

Tasks take ranges of (doc_id, hash of the text) of about RANGE_BYTES of text, so that neither they nor an id that many rows share grow
with the input.

Defined cases: a null text is an empty one and yields the end id alone; null doc_ids come first; rows that repeat
an id follow each other in the order of their text's hash; strings of special tokens in a text become those tokens, as the
library does it unless told otherwise; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import kept, stored
from .words import Numbers, gathered, hashed, raw, runs

SHARD = 1 << 21
BLOCK = 1 << 15
LANES = 32
#: Bytes of text that a task takes, and the most tasks there are; beyond their product ranges are wider.
RANGE_BYTES, MOST_RANGES = 32 << 20, 100_000
#: Words that a worker remembers before it starts anew.
KNOWN = 700_000
LOW = np.uint64(1 << 31)
MAGIC = 0x52414E31


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols, frequencies that add up to 1 << bits, and bits; every symbol that occurs has at least 1."""
    counts = np.bincount(ids)
    symbols = np.nonzero(counts)[0]
    counts = counts[symbols]
    bits = max(14, int(len(symbols)).bit_length() + 1)
    total = 1 << bits
    freq = np.maximum(1, (counts * (total / counts.sum())).astype(np.int64))
    over = int(freq.sum() - total)
    if over < 0:
        freq[counts.argmax()] -= over
    for i in np.argsort(-freq, kind="stable"):
        if over <= 0:
            break
        less = min(over, int(freq[i]) // 2)
        freq[i] -= less
        over -= less
    return symbols.astype(np.uint32), freq.astype(np.uint32), bits


def encode(ids: np.ndarray, doc_ids: np.ndarray, null: np.ndarray, counts: np.ndarray) -> bytes:
    """A shard of these ids; counts: how many of them belong to each document.

    All blocks go through their steps side by side, from their last ids to their first. What a step pushes out is kept
    in its lane's place; the words of a block are those places in reading order. The last block is padded to a full step with its last id."""
    symbols, freq, bits = frequencies(ids)
    blocks, steps = -(-len(ids) // BLOCK), BLOCK // LANES
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = len(ids) - (blocks - 1) * BLOCK
    last = -(-int(sizes[-1]) // LANES)  # steps of the last block
    padded = np.full(blocks * BLOCK, ids[-1])
    padded[: len(ids)] = ids
    by_step = padded.reshape(blocks, steps, LANES).transpose(1, 0, 2).reshape(steps, blocks * LANES)
    width, first = np.zeros(int(symbols[-1]) + 1, np.uint64), np.zeros(int(symbols[-1]) + 1, np.uint64)
    width[symbols] = freq
    first[symbols] = np.cumsum(freq.astype(np.uint64)) - freq
    m, room, five, half = np.uint64(bits), np.uint64(63 - bits), np.uint64(5), (blocks - 1) * LANES
    state = np.full(blocks * LANES, LOW)
    low, pushed = np.zeros((steps, blocks * LANES), np.uint32), np.zeros((steps, blocks * LANES), bool)
    for t in range((steps if blocks > 1 else last) - 1, -1, -1):
        part = slice(0, half if t >= last else None)
        now, s = by_step[t, part], state[part]
        f = width[now]
        push = s >= (f << room)
        low[t, part], pushed[t, part] = s, push
        s = s >> (push.astype(np.uint64) << five)
        q = s // f
        state[part] = (q << m) + (s - q * f) + first[now]
    low, pushed = (x.reshape(steps, blocks, LANES).transpose(1, 0, 2) for x in (low, pushed))
    used = [low[b][pushed[b]] for b in range(blocks)]
    offset = np.concatenate(([0], np.cumsum([len(w) for w in used]))).astype("<u8")
    sums = np.array([[zlib.crc32(w.tobytes()), zlib.crc32(np.ascontiguousarray(ids[b * BLOCK : (b + 1) * BLOCK], "<u4").tobytes())] for b, w in enumerate(used)], "<u4")
    head = np.array([MAGIC, bits, len(symbols), len(doc_ids), blocks, len(ids)], "<u4")
    parts = (head, np.diff(symbols, prepend=0).astype("<u4"), freq.astype("<u4"), doc_ids.astype("<i8"), null.astype("u1"), counts.astype("<u4"), sizes.astype("<u4"), offset, state.astype("<u8"), sums, *used)
    return b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def decode(shard: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, doc_ids, which of those are null, and the documents' counts. Raises ValueError on a checksum that differs."""
    place = 0

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal place
        out = np.frombuffer(shard, kind, n, place)
        place += out.nbytes
        return out

    magic, bits, n_symbols, docs, blocks, total = (int(x) for x in take("<u4", 6))
    if magic != MAGIC:
        raise ValueError("not a token shard")
    symbols, freq = np.cumsum(take("<u4", n_symbols)).astype(np.uint32), take("<u4", n_symbols)
    doc_ids, null, counts = take("<i8", docs), take("u1", docs).astype(bool), take("<u4", docs).astype(np.int64)
    sizes, offset = take("<u4", blocks).astype(np.int64), take("<u8", blocks + 1).astype(np.int64)
    state, sums = take("<u8", blocks * LANES).reshape(blocks, LANES).copy(), take("<u4", 2 * blocks).reshape(blocks, 2)
    words = np.append(take("<u4", int(offset[-1])), np.uint32(0))
    for b in range(blocks):
        if zlib.crc32(words[offset[b] : offset[b + 1]].tobytes()) != sums[b, 0]:
            raise ValueError(f"block {b}: the words differ from their checksum")
    slots = np.repeat(np.arange(n_symbols), freq)
    f64, start = freq.astype(np.uint64), np.concatenate(([0], np.cumsum(freq.astype(np.uint64))[:-1])).astype(np.uint64)
    out = np.zeros((blocks, BLOCK // LANES, LANES), np.uint32)
    at, m, mask, lane = offset[:-1].copy(), np.uint64(bits), np.uint64((1 << bits) - 1), np.arange(LANES)
    for t in range(-(-int(sizes.max()) // LANES)):
        here = (t * LANES < sizes)[:, None]
        low = state & mask
        s = slots[low.astype(np.int64)]
        out[:, t] = symbols[s]
        new = f64[s] * (state >> m) + low - start[s]
        pull = here & (new < LOW)
        rank = np.cumsum(pull, axis=1)
        more = words[np.where(pull, at[:, None] + rank - 1, len(words) - 1)]
        new = np.where(pull, (new << np.uint64(32)) | more, new)
        state = np.where(here, new, state)
        at += rank[:, -1]
    ids = out.reshape(-1)[:total]
    for b in range(blocks):
        if zlib.crc32(ids[b * BLOCK : (b + 1) * BLOCK].astype("<u4").tobytes()) != sums[b, 1]:
            raise ValueError(f"block {b}: the ids differ from their checksum")
    return ids, doc_ids, null, counts


class Pieces(dict):
    """Numbers for strings, in the order in which they are first asked for."""

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        return n


class Tokenized:
    """Ids of texts by the tokenizers library, which sees each distinct word of a worker once. Words are told apart by two
    independent hashes of 64 bits.

    The tokenizer's normaliser and splitter act on words between white space separately, and to the splitter letters
    and the punctuation after them are two pieces. So the ids of a text are those of its pieces one after another. A batch
    is lower-cased in ASCII and cut at blanks, and before a stop or comma between an ASCII letter and a blank, as one array of bytes.
    New pieces of letters or of punctuation go to the library in one line, apart by blanks, and its word ends part their ids again;
    what is neither goes to it one by one. A text that holds strings of special tokens falls into what stands between them, as in the library."""

    TAIL = ".,;:!?%&#$*|"
    FOLD = np.arange(256, dtype=np.uint8)
    FOLD[65:91] += 32
    FOLD[[9, 10, 13]] = 32
    ASCII_LETTER = np.zeros(256, bool)
    ASCII_LETTER[97:123] = True

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError(f"{path}: added tokens that take in what is around them are not supported")
        self.special, either = special, "|".join(map(re.escape, sorted(special, key=len, reverse=True)))
        self.parts = re.compile(f"({either})") if special else None
        self.tokenizer.encode_special_tokens = True  # texts are cut at special tokens before; what only looks like one in lower case is none
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.start()

    def start(self) -> None:
        self.numbers = Numbers()  # of the words; each word is one or two pieces
        self.word_lengths, self.word_ids, self.word_offsets = np.zeros(0, np.int32), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.pieces = Pieces()
        self.pieces[""]
        self.lengths, self.offsets, self.flat = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has."""
        ids = [x.ids for x in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def line(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces of letters or of punctuation."""
        out = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for k in range(0, len(pieces), 20_000):
            part = pieces[k : k + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.nonzero(self.closes[ids])[0] + 1
            out.append((ids, np.diff(ends, prepend=0)) if len(ends) == len(part) else self.alone(part))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def learn(self, words: list[bytes]) -> None:
        cores, tails = [], []
        for w in words:
            if w.isalpha():  # of ASCII letters
                cores.append(w.decode())
                tails.append("")
                continue
            w = w.decode("utf-8", "replace")
            core = w.rstrip(self.TAIL)
            if (core.isalpha() or not core) and (w.isascii() or (is_normalized("NFC", w) and "\u03a3" not in w and "\u0130" not in w)):
                cores.append(core.lower())
                tails.append(w[len(core) :])
            else:
                cores.append("\0" + w)
                tails.append("")
        before = len(self.pieces)
        first = np.fromiter(map(self.pieces.__getitem__, cores), np.int32, len(cores))
        second = np.fromiter(map(self.pieces.__getitem__, tails), np.int32, len(tails))
        new = list(islice(self.pieces, before, None))
        odd = np.fromiter((p[0] == "\0" for p in new), bool, len(new))
        lengths, offsets = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        for mine, (ids, n) in ((~odd, self.line([p for p in new if p[0] != "\0"])), (odd, self.alone([p[1:] for p in new if p[0] == "\0"]))):
            lengths[mine], offsets[mine] = n, len(self.flat) + np.cumsum(n) - n
            self.flat = np.concatenate((self.flat, ids))
        self.lengths, self.offsets = np.concatenate((self.lengths, lengths)), np.concatenate((self.offsets, offsets))
        ids, n = gathered(self.flat, self.offsets, self.lengths, np.stack((first, second), axis=1).ravel())
        self.word_lengths = np.concatenate((self.word_lengths, n.reshape(-1, 2).sum(axis=1, dtype=np.int32)))
        self.word_ids = np.concatenate((self.word_ids, ids))
        self.word_offsets = np.cumsum(self.word_lengths, dtype=np.int64) - self.word_lengths

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all texts, first byte and length of each word in them, and the number of words up to the end of each text."""
        data, ends = raw(texts)
        data = self.FOLD[data]
        mark = np.zeros(len(data), bool)
        if len(data) > 2:
            mark[1:-1] = ((data[1:-1] == 44) | (data[1:-1] == 46)) & self.ASCII_LETTER[data[:-2]] & (data[2:] == 32)
        at = np.concatenate((np.nonzero(mark)[0], ends))
        order = np.argsort(at, kind="stable")
        place = np.empty(len(at), np.int64)
        place[order] = at[order] + np.arange(len(at))
        data = np.insert(data, at, np.uint8(32))
        blanks = np.nonzero(data == 32)[0]
        starts = np.concatenate(([0], blanks[:-1] + 1)) if len(blanks) else blanks
        lengths = blanks - starts
        some = lengths > 0
        upto = np.concatenate(([0], np.cumsum(some)))[np.searchsorted(blanks, place[len(at) - len(ends) :]) + 1]
        return data, starts[some], lengths[some], upto

    def plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids up to the end of each text, of texts without special tokens."""
        if self.numbers.count > KNOWN:
            self.start()
        data, starts, lengths, upto = self.words(texts)
        keys = hashed(data[data != 32], lengths)
        at = self.numbers(*keys)
        while len(new := np.nonzero(at < 0)[0]):
            new = new[np.unique(keys[0][new], return_index=True)[1]]
            body = data.tobytes()
            self.learn([body[s : s + n] for s, n in zip(starts[new].tolist(), lengths[new].tolist(), strict=True)])
            self.numbers.add(keys[0][new], keys[1][new])
            at = self.numbers(*keys)
        ids, n = gathered(self.word_ids, self.word_offsets, self.word_lengths, at)
        return ids, np.concatenate(([0], np.cumsum(n)))[upto]

    def __call__(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of ids of each text; texts has no nulls."""
        has = np.zeros(len(texts), bool)
        for token in self.special:
            has |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not has.any():
            ids, ends = self.plain(texts)
        else:
            # every odd part of a text is a special token, with one id
            parts = [self.parts.split(t) if h else [t] for t, h in zip(texts.to_pylist(), has.tolist(), strict=True)]
            ids, upto = self.plain(pa.array([p for ps in parts for p in ps[::2]], pa.string()))
            after = np.fromiter((i + 1 < len(ps) for ps in parts for i in range(0, len(ps), 2)), bool, len(upto))
            ids = np.insert(ids, upto[after], np.fromiter((self.special[p] for ps in parts for p in ps[1::2]), np.uint32))
            last = np.cumsum([len(ps) // 2 + 1 for ps in parts]) - 1
            ends = (upto + np.cumsum(after))[last]
        return np.insert(ids, ends, np.uint32(end)), np.diff(ends, prepend=0) + 1


def tokenized(path: str) -> Tokenized:
    """A worker's tokenizer with what it has met so far."""
    return kept(f"tokenizer {path}", lambda: Tokenized(path))


def write(docs: DataFrame, path: str, end: int) -> DataFrame:
    """Tokenizes the texts and writes shards (part, seq, n_ids, shard) in ascending doc_id order; returns what was written."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    ranges = min(MOST_RANGES, -(-size // RANGE_BYTES) or 1)
    # rows that are equal in both are parted by where they are read: any order of theirs gives the same bytes
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    rows = rows.select("doc_id", "text", order[1].alias("h"), order[2].alias("read"))
    rows = rows.repartitionByRange(ranges, order[0], F.col("h"), F.col("read")).sortWithinPartitions(order[0], "h").select("doc_id", "text", F.spark_partition_id().alias("part"))

    def shards(batches):
        tok = tokenized(path)
        held, size, seq, part = [], 0, 0, 0

        def close():
            ids, docs, null, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([encode(ids, docs, null, counts)], pa.binary())], names=["part", "seq", "n_ids", "shard"])

        for b in batches:
            if not b.num_rows:
                continue
            part, done = b.column("part")[0].as_py(), 0
            null = b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            docs = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for texts in runs(b.column("text")):
                ids, counts = tok(texts, end)
                held.append((ids, docs[done : done + len(texts)], null[done : done + len(texts)], counts))
                done += len(texts)
                size += len(ids)
                if size >= SHARD:
                    yield close()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield close()

    return stored(rows.mapInArrow(shards, "part int, seq long, n_ids long, shard binary"), "tokens")


def read(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document from its shard; ids is binary, little-endian unsigned 32-bit."""
    spark = shards.sparkSession
    totals = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # a row a partition
    base, upto = {}, 0
    for p in sorted(totals):
        base[p], upto = upto, upto + totals[p]
    before = spark.createDataFrame(sorted(base.items()), "b_part int, base long")
    seqs = shards.select("part", "seq", "n_ids").alias("s")
    earlier = seqs.groupBy("part").agg(F.collect_list(F.struct("seq", "n_ids")).alias("all"))  # 12 bytes for SHARD ids
    earlier = earlier.select(F.col("part").alias("e_part"), F.explode("all").alias("x"), "all")
    earlier = earlier.select("e_part", F.col("x.seq").alias("e_seq"), F.aggregate(F.filter("all", lambda y: y["seq"] < F.col("x.seq")), F.lit(0).cast("long"), lambda a, y: a + y["n_ids"]).alias("inside"))
    placed = earlier.join(before, F.col("e_part") == F.col("b_part")).select("e_part", "e_seq", (F.col("base") + F.col("inside")).alias("first"))
    rows = shards.join(placed, (F.col("part") == F.col("e_part")) & (F.col("seq") == F.col("e_seq"))).select("first", "shard")

    def documents(batches):
        for b in batches:
            for first, shard in zip(b.column("first").to_pylist(), b.column("shard"), strict=True):
                ids, docs, null, counts = decode(shard.as_buffer().to_pybytes())
                ids, ends = ids.astype("<u4"), np.cumsum(counts)
                for k in range(0, len(docs), 2000):
                    e = ends[k : k + 2000]
                    s = e - counts[k : k + 2000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[k : k + 2000], mask=null[k : k + 2000]), pa.array(s + first), pa.array(e - s), pa.array([ids[i:j].tobytes() for i, j in zip(s.tolist(), e.tolist(), strict=True)], pa.binary())], names=["doc_id", "start", "n_tokens", "ids"]
                    )

    return rows.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def op3_token_ids(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .base import table

    shards = write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)
    return read(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

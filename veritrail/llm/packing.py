"""Packing of documents into sequences of a fixed length.

A document's ids end in an end id. What fills whole sequences by itself does so in the task that tokenizes it; the rest of each document, less than a
sequence, goes to one of many groups at random, of about GROUP rests each. A group packs by first-fit decreasing: the rests go by size, the
largest first, each into the first sequence that still has room, which a tournament tree of the rooms finds in logarithmic time. Then the
room that is left over is filled up: the emptiest sequences are taken apart, and their documents, cut where it takes that, fill the others.
What remains of a group is less than one sequence and becomes sequences of powers of two. So none is padded: a sequence holds `length` ids or a power of two.

Ids are those of the tokenizers library, which sees each distinct chunk of a worker once; texts that are not plain go to it as they are.
A chunk is a word with the blank before it, or what stands between; where all white space is single and ASCII, no piece of the library's crosses it.

Defined cases: a null text is an empty one and holds the end id alone; a null doc_id stays null; rows that repeat are packed each by itself; strings of
special tokens in a text become those tokens, as the library does it as loaded; other columns are ignored. sequence_id is unique, not consecutive.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import CACHE_WORDS, kept, stored
from .bpe import LETTER, WHITE, strange
from .words import Numbers, gathered, hashed, raw, runs

LENGTH = 2048
#: Rests that a group packs, about: 32 MB of ids at most.
GROUP = 4096
#: Places for numbers of sequences within a task, and within a group.
TASK_BITS, GROUP_BITS = 38, 24


class ByteLevel:
    """Ids of texts by a byte-level tokenizer of the library, which sees each distinct chunk of a worker once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            body = f.read()
        self.library = Tokenizer.from_str(body)
        self.special = [t["content"].encode() for t in json.loads(body).get("added_tokens") or []]
        self.start()

    def start(self) -> None:
        """An empty cache: chunk n has ids flat[offsets[n]:offsets[n] + lengths[n]]."""
        self.numbers = Numbers()
        self.lengths, self.offsets, self.flat = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after another, and how many each has. Places in the texts are not asked for."""
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int32, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def learn(self, chunks: list[bytes]) -> None:
        ids, lengths = self.of([c.decode() for c in chunks])
        self.lengths = np.concatenate((self.lengths, lengths))
        self.offsets = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        self.flat = np.concatenate((self.flat, ids))

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        if self.numbers.count > CACHE_WORDS:
            self.start()
        data, ends = raw(texts)
        begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        plain = self.plain(data, begins, ends)
        for s in self.special:
            plain &= ~pc.match_substring(texts, s.decode()).to_numpy(zero_copy_only=False)
        ids, upto = self.chunked(data, begins, ends, plain)
        out = np.split(ids, upto[:-1]) if len(texts) else []
        odd = np.nonzero(~plain)[0]
        if len(odd):
            ids, lengths = self.of([texts[int(k)].as_py() for k in odd])
            for k, found in zip(odd.tolist(), np.split(ids, np.cumsum(lengths)[:-1]), strict=True):
                out[k] = found
        return out

    @staticmethod
    def plain(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Texts of which every white space stands alone, within, and is ASCII."""
        blank = WHITE[data]
        bad = strange(data)
        bad[1:] |= blank[1:] & blank[:-1]
        odd = np.concatenate(([0], np.cumsum(bad)))
        out, full = np.ones(len(ends), bool), ends > begins
        b, e = begins[full], ends[full]
        out[full] = (odd[e] == odd[b]) & ~blank[b] & ~blank[e - 1]
        return out

    def chunked(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the plain texts one after another, and how many there are up to each text's end."""
        sizes = np.where(plain, ends - begins, 0)
        if not plain.all():
            data = data[np.repeat(plain, ends - begins)]
            ends = np.cumsum(sizes)
        blank = WHITE[data]
        cut = data == 32
        line = blank & ~cut
        cut |= line
        if len(data):
            cut[1:] |= line[:-1] | ((data[1:] == 44) | (data[1:] == 46)) & LETTER[data[:-1]]
            cut[(ends - sizes)[sizes > 0]] = True
        starts = np.nonzero(cut)[0]
        lengths = np.diff(starts, append=len(data))
        keys = hashed(data, lengths)
        at = self.numbers(*keys)
        while len(new := np.nonzero(at < 0)[0]):
            new = new[np.unique(keys[0][new], return_index=True)[1]]
            body, first = data.tobytes(), starts
            self.learn([body[s : s + n] for s, n in zip(first[new].tolist(), lengths[new].tolist(), strict=True)])
            self.numbers.add(keys[0][new], keys[1][new])
            at = self.numbers(*keys)
        ids, n = gathered(self.flat, self.offsets, self.lengths, at)
        return ids, np.concatenate(([0], np.cumsum(n)))[np.searchsorted(starts, ends)]


def cut_up(docs: DataFrame, path: str, end: int, length: int) -> DataFrame:
    """Pieces of documents: (doc_id, start, ids, doc_tokens, sequence_id, place), ids as unsigned little-endian 32-bit integers.

    A piece of `length` ids has its sequence_id. The rest of a document has none yet; place tells rests apart."""
    names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "place"]

    def tokenize(batches):
        byte_level = kept(f"packing {path}", lambda: ByteLevel(path))
        task, count = TaskContext.get().partitionId() << TASK_BITS, 0
        for batch in batches:
            doc_ids = batch.column("doc_id")
            texts, done = batch.column("text").fill_null(""), 0
            for part in runs(texts, 2 << 20):
                found = [np.append(x, np.uint32(end)) for x in byte_level(part)]
                n = np.fromiter(map(len, found), np.int64, len(found))
                pieces = -(-n // length)
                row = np.repeat(np.arange(len(n)), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
                size = np.minimum(n[row] - start, length)
                number = task + count + np.arange(len(row))
                count += len(row)
                offsets = np.concatenate(([0], np.cumsum(4 * size))).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.concatenate(found).astype("<u4").tobytes())])
                whole = size == length
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(done + row)), pa.array(start), ids, pa.array(n[row]), pa.array(2 * number + 1, mask=~whole), pa.array(number, mask=whole)], names
                )
                done += len(part)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tokenize, "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, place long")


def first_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Which of the sizes stand in each bin of `length`: the largest first, each in the first bin that has the room."""
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    room = [length] * (2 * leaves)  # a node holds the most room of a bin below it
    bins: list[list[int]] = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, at = int(sizes[i]), 1
        while at < leaves:
            at += at
            if room[at] < size:
                at += 1
        if at - leaves == len(bins):
            bins.append([])
        bins[at - leaves].append(i)
        room[at] -= size
        while at > 1:
            at >>= 1
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
    return bins


def filled(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces (item, start in it, size, sequence, offset there) of sequences of `length`, and of powers of two for what remains.

    Bins are first-fit decreasing. The fullest stay, as many as the items fill wholly; the other bins' items are one stream that fills what is free in them."""
    bins = first_fit(sizes, length)
    load = np.array([int(sizes[b].sum()) for b in bins], np.int64)
    by = np.argsort(-load, kind="stable")
    whole, rest = divmod(int(sizes.sum()), length)
    stay, stream = by[:whole], [i for b in by[whole:] for i in bins[b]]
    item = np.array([i for b in stay for i in bins[b]], np.int64)
    count = np.fromiter((len(bins[b]) for b in stay), np.int64, whole)
    sequence = np.repeat(np.arange(whole), count)
    upto = np.cumsum(sizes[item]) - sizes[item]
    offset = upto - np.repeat(np.cumsum(load[stay]) - load[stay], count)
    start, size = np.zeros(len(item), np.int64), sizes[item]
    # the stream is cut wherever one of its items or a free place ends
    powers = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    places = np.concatenate((length - load[stay], np.array(powers, np.int64))).astype(np.int64)
    begins = np.concatenate((load[stay], np.zeros(len(powers), np.int64))).astype(np.int64)
    stream = np.array(stream, np.int64)
    ends, filled_to = np.cumsum(sizes[stream]), np.cumsum(places)
    cuts = np.unique(np.concatenate(([0], ends, filled_to)))
    low, n = cuts[:-1], np.diff(cuts)
    i, p = np.searchsorted(ends, low, "right"), np.searchsorted(filled_to, low, "right")
    more = (stream[i], low - (ends - sizes[stream])[i], n, p, begins[p] + low - (filled_to - places)[p])
    return tuple(np.concatenate(x).astype(np.int64) for x in zip((item, start, size, sequence, offset), more, strict=True))


def packed(docs: DataFrame, path: str, end: int = 1, length: int = LENGTH) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset); ids are unsigned little-endian 32-bit integers."""
    pieces = stored(cut_up(docs, path, end, length), "pieces")
    whole, rests = pieces.where("place is null"), pieces.where("place is not null")
    groups = max(1, -(-rests.count() // GROUP))
    names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        data, ends = raw(table.column("ids").combine_chunks().cast(pa.large_binary()))
        sizes = np.diff(ends, prepend=0) // 4
        item, start, size, sequence, offset = filled(sizes, length)
        ids, _ = gathered(data.view("<u4"), (ends // 4 - sizes)[item] + start, size, np.arange(len(item)))
        offsets = np.concatenate(([0], np.cumsum(4 * size))).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), len(item), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())])
        rows = table.take(pa.array(item))
        number = 2 * ((table.column("group")[0].as_py() << GROUP_BITS) + sequence)
        return pa.table([rows.column("doc_id"), pa.array(rows.column("start").to_numpy() + start), binary, rows.column("doc_tokens"), pa.array(number), pa.array(offset)], names)

    dealt = rests.withColumn("group", F.pmod(F.xxhash64("place"), F.lit(groups))).drop("sequence_id")
    out = dealt.groupBy("group").applyInArrow(pack, "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long")
    out = out.unionByName(whole.select(*names[:-1], F.lit(0).cast("long").alias("offset")))
    return out.select("doc_id", "start", F.floor(F.length("ids") / 4).alias("length"), "ids", "doc_tokens", "sequence_id", "offset")


def op11_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .base import table

    out = packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

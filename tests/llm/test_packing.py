import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from veritrail.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def checked(rows, texts, library, length=2048):
    """Every id in one piece, sequences without gaps, no padding; rows: (doc_id, start, length, crc, doc_tokens, sequence, offset)."""
    ids = {d: np.append(np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4"), np.uint32(1)) for d, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for d, start, n, crc, total, sequence, offset in rows:
        assert n > 0 and total == len(ids[d]) and crc == zlib.crc32(ids[d][start : start + n].astype("<u4").tobytes())
        by_doc[d].append((start, n))
        by_sequence[sequence].append((offset, n))
    for d in texts:
        at = 0
        for start, n in sorted(by_doc[d]):
            assert start == at
            at += n
        assert at == len(ids[d])
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == length or at < length and at & (at - 1) == 0
    return by_sequence


def test_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = packing.op11_packing(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = [tuple(r) for r in found.collect()]
    sequences = checked(rows, {r.doc_id: r.text for r in docs.collect()}, library)
    assert sum(sum(n for _, n in p) < 2048 for p in sequences.values()) <= 11
    assert len({r[0] for r in rows if r[2] < r[4] <= 2048}) <= 2 * len(sequences)  # few short documents are cut


def test_groups_are_packed_apart_and_alike_on_a_rerun(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 16)
    rng = np.random.default_rng(3)
    texts = {i: " ".join(["some", "words", "of", "a", "text"][j] for j in rng.integers(0, 5, rng.integers(0, 90))) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3, "doc_id")
    found = [sorted((r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in packing.packed(docs, PATH, length=64).collect()) for _ in range(2)]
    assert found[0] == found[1]
    checked(found[0], texts, library, 64)
    assert len({r[5] >> 1 + packing.GROUP_BITS for r in found[0] if r[5] % 2 == 0}) > 5


def test_odd_and_empty(spark, odd, library):
    full, empty = odd
    rows = [tuple(r) for r in packing.op11_packing(spark, full).collect()]
    docs = spark.read.parquet(f"{full}/documents.parquet").select("doc_id", "text").collect()
    twice = {d for d in {r.doc_id for r in docs} if sum(r.doc_id == d for r in docs) > 1}
    totals = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs}
    assert {r[0] for r in rows} == set(totals)
    for d, total in totals.items():
        assert sum(r[2] for r in rows if r[0] == d) == total * (2 if d in twice else 1)
    for sequence in {r[5] for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r[5] == sequence), key=lambda r: r[6]):
            assert r[6] == at
            at += r[2]
        assert at == 2048 or at & (at - 1) == 0
    assert packing.op11_packing(spark, empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_first_fit_decreasing_equals_a_plain_one(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 101, rng.integers(1, 200))
    bins: list[list[int]] = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        for b in bins:
            if sum(sizes[j] for j in b) + sizes[i] <= 100:
                b.append(i)
                break
        else:
            bins.append([i])
    assert packing.first_fit(sizes, 100) == bins


def test_ids_are_the_librarys(library):
    rng = np.random.default_rng(5)
    parts = ["a", "Word", " ", "  ", "\n", "\t", "\r\n", ".", ",", "'s", "'ll", "<|endoftext|>", "<|endof", "text|>", "é", "日本", " ", " ", " ", "\x1c", "\x85", "́", "\U0001f600", "12", "3.5", "x" * 40, "!?", "ß", "\x00", "​", "ā,", "a,", "_"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(4000)] + [" ".join(rng.choice(parts[:2] + parts[7:10] + parts[14:16] + parts[21:], rng.integers(1, 25))) for _ in range(3000)]
    level = packing.ByteLevel(PATH)
    for k in range(0, len(texts), 500):
        got = level(pa.array(texts[k : k + 500], pa.string()))
        for t, ids in zip(texts[k : k + 500], got, strict=True):
            assert ids.tolist() == library.encode(t, add_special_tokens=False).ids, t
    assert level.numbers.count > 100

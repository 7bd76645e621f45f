import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from veritrail.llm import bpe, tokens
from veritrail.llm.base import table

WORD_BPE, BYTE_BPE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "a", "\x0b a\x0cb", "a\x85b\xa0c d", "İstanbul ΣΑΣ ΣΑΣ. Σ", "é é ́x", "don't 'S 're I'M", "<|endoftext|>", "a<|startoftext|>B.<|endoftext|><|endoftext|> é<|endoftext|>́ <|ENDOFTEXT|> <|endoftext|", "日本 語　x", "a\x1cb \x1c \x1d", "a  b\n\nc \n d ", "WORD, word. (x), y!., z", "é, Ñandú. ß.", "x" * 3000, "ab" * 2000, " " * 500 + "x", "12345 678", "\t\n x\r\n"]


@pytest.mark.parametrize("n", [1, 31, 32, 33, tokens.BLOCK - 1, tokens.BLOCK, tokens.BLOCK + 1, 3 * tokens.BLOCK + 17])
def test_shard_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_000).astype(np.uint32)
    counts = np.array([n - n // 3, n // 3])
    back, docs, null, c = tokens.decode(tokens.encode(ids, np.array([5, 0]), np.array([False, True]), counts))
    assert (back == ids).all() and docs.tolist() == [5, 0] and null.tolist() == [False, True] and (c == counts).all()


def test_shard_of_one_symbol_and_of_all():
    for ids in (np.zeros(1000, np.uint32), np.arange(60_000, dtype=np.uint32), np.array([70_000], np.uint32)):
        assert (tokens.decode(tokens.encode(ids, np.zeros(1), np.zeros(1, bool), np.array([len(ids)])))[0] == ids).all()


def test_damage_is_seen():
    shard = bytearray(tokens.encode(np.arange(5000, dtype=np.uint32) % 97, np.zeros(1), np.zeros(1, bool), np.array([5000])))
    shard[-10] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        tokens.decode(bytes(shard))
    with pytest.raises(ValueError):
        tokens.decode(b"\0" * 24)


def test_word_ids_are_the_librarys():
    t = Tokenizer.from_file(WORD_BPE)
    got, counts = tokens.tokenized(WORD_BPE)(pa.array(ODD), 2)
    at = 0
    for text, n in zip(ODD, counts, strict=True):
        assert got[at : at + n].tolist() == [*t.encode(text, add_special_tokens=False).ids, 2], text
        at += n


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "a", "B", " ", "é", "́", "'s", ".", "\n"]), max_size=12).map("".join), max_size=6))
def test_special_tokens_are_the_librarys(texts):
    t = Tokenizer.from_file(WORD_BPE)
    got, counts = tokens.tokenized(WORD_BPE)(pa.array(texts, pa.string()), 2)
    assert got.tolist() == [i for x in texts for i in [*t.encode(x, add_special_tokens=False).ids, 2]] and len(counts) == len(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abEé \n.,!'1sß\x0b́日", max_size=40), min_size=1, max_size=5))
def test_word_ids_of_any_text(texts):
    t = Tokenizer.from_file(WORD_BPE)
    got, counts = tokens.tokenized(WORD_BPE)(pa.array(texts, pa.string()), 2)
    assert got.tolist() == [i for x in texts for i in [*t.encode(x, add_special_tokens=False).ids, 2]]


def test_numbers_grow():
    rng = np.random.default_rng(0)
    one, two = rng.integers(0, 2**63, 5000, dtype=np.uint64), rng.integers(0, 2**63, 5000, dtype=np.uint64)
    one[1::2] = one[::2]  # the first hash alone does not tell words apart
    t = tokens.Numbers(4)
    for k in range(0, 5000, 700):
        t.add(one[k : k + 700], two[k : k + 700])
    assert t(one, two).tolist() == list(range(5000)) and (t(one, two + np.uint64(1)) == -1).all()


@pytest.mark.parametrize("range_bytes", [16 << 20, 300])
def test_query_on_odd_rows(spark, odd, monkeypatch, range_bytes):
    monkeypatch.setattr(tokens, "RANGE_BYTES", range_bytes)
    t = Tokenizer.from_file(WORD_BPE)
    docs = sorted(table(spark, odd[0], "documents").select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    rows = sorted((tuple(r) for r in tokens.op3_token_ids(spark, odd[0]).collect()), key=lambda r: r[1])
    start, want = 0, []
    for d in docs:
        ids = np.array([*t.encode(d["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((d["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows == want
    assert tokens.op3_token_ids(spark, odd[1]).count() == 0


def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_ids_are_the_librarys():
    ranks = bpe.read_ranks(BYTE_BPE)
    e, t = bpe.Encoder(ranks, P.PATTERN), reference(ranks)
    for text, ids in zip(ODD, e(ODD), strict=True):
        assert ids.tolist() == t.encode_ordinary(text), text
        assert e.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abethE \n\t.!'1sé\xa0\x1c日", max_size=60), max_size=5))
def test_byte_ids_of_any_text(texts):
    e = bpe.encoder(BYTE_BPE, P.PATTERN)
    t = _reference()
    assert [x.tolist() for x in e(texts)] == [t.encode_ordinary(x) for x in texts]


_T = []


def _reference():
    if not _T:
        _T.append(reference(bpe.read_ranks(BYTE_BPE)))
    return _T[0]


def test_pairs_of_ids():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abc": 257, b"bc": 258}
    p = bpe.Pairs(ranks)
    a, b = np.array([97, 98, 256, 97, 99], np.uint32), np.array([98, 99, 99, 258, 97], np.uint32)
    assert p(a, b).tolist() == [256, 258, 257, 257, int(bpe.NONE)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abethins", min_size=1025, max_size=3000))
def test_long_pieces_are_the_librarys(text):
    assert bpe.encoder(BYTE_BPE, P.PATTERN).row(text.encode()).tolist() == _reference().encode_ordinary(text)


@settings(max_examples=400, deadline=None)
@given(st.data())
def test_a_row_merges_like_the_matrix(data):
    """With any ranks, also such as make pairs of a lower rank than what they are made from."""
    tokens_, ranks = [b"a", b"b", b"c"], data.draw(st.permutations(range(3, 15)))
    for _ in ranks:
        tokens_.append(data.draw(st.sampled_from(tokens_)) + data.draw(st.sampled_from(tokens_)))
    table_ = {t: i for i, t in enumerate(tokens_[:3])}
    for t, r in zip(tokens_[3:], ranks, strict=True):
        table_.setdefault(t, r)
    e = bpe.Encoder(table_, r".+")
    piece = data.draw(st.text(alphabet="abc", min_size=1, max_size=60)).encode()
    assert e.row(piece).tolist() == e.matrix([piece])[0].tolist()


def test_byte_query_on_odd_rows(spark, odd):
    import hashlib

    t = _reference()
    docs = table(spark, odd[0], "documents").select("doc_id", "text").collect()

    def row(d):
        text = d["text"] or ""
        ids = np.array(t.encode_ordinary(text), "<u4")
        return (d["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())

    assert sorted(map(str, map(tuple, bpe.op7_byte_bpe(spark, odd[0]).collect()))) == sorted(str(row(d)) for d in docs)
    assert bpe.op7_byte_bpe(spark, odd[1]).count() == 0


def test_encode_then_decode(spark, odd):
    docs = table(spark, odd[0], "documents")
    back = bpe.decoded(bpe.encoded(docs, BYTE_BPE, P.PATTERN), BYTE_BPE, P.PATTERN)
    assert sorted(bytes(r["bytes"]) for r in back.collect()) == sorted((r["text"] or "").encode() for r in docs.collect())

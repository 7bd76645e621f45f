"""The stages against plain versions, and the whole run."""

import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F
from veritrail.llm import bpe
from veritrail.llm.base import stored, table

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    labels = {r["doc_id"]: r for r in table(spark, SF, "labels").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "simhash", "mixing", "bpe"]
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), name)
        sizes[name] = docs.count()
        if name != "bpe":
            assert docs.columns == before.columns
        if name in ("toxicity", "quality", "simhash"):
            ids = {r["doc_id"] for r in before.select("doc_id").collect()}
            kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
            assert kept < ids and docs.count() == len(kept)
            clean = {i for i in ids if i in labels and labels[i]["quality"] == 1 and labels[i]["toxic"] == 0}
            if name != "simhash":
                assert len(clean - kept) <= 0.02 * len(clean)
        if name == "simhash":
            assert docs.select("text").distinct().count() == sizes[name]
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = sorted((r["doc_id"], hashlib.sha256(np.array(t.encode_ordinary(r["text"]), "<u4").tobytes()).hexdigest()) for r in before.collect())
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in docs.collect()) == want
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, again.drop("ids").collect())) == sorted(map(str, docs.drop("ids").collect()))
    assert again.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_odd_and_empty_tables(spark, odd):
    assert corpus_pipeline.run(spark, odd[0]).count() > 0
    assert corpus_pipeline.run(spark, odd[1]).count() == 0


def test_registered():
    import __spark_entry__

    ours = __spark_entry__.queries()
    assert {f"op{i}" for i in range(1, 11)} <= {k.split("_")[0] for k in ours} and "pipeline" in ours

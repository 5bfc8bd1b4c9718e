"""The pipeline's stages, each on what the one before kept."""

import public_tokenizers
import tiktoken

import corpus_pipeline as P
from cadenza.llm import bpe, mixing
from tests.llm.test_operators import components, shingle_set

D = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    kept = dict(P.STAGES)["quality"](spark, docs, D).persist()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert all((d in ids) == bool(q) for d, q in labels.items() if d in given)
    assert kept.columns == list(P.COLUMNS)

    first = dict(P.STAGES)["near_duplicates"](spark, kept, D).persist()
    want = components({r.doc_id: shingle_set(r.text) for r in kept.collect()})
    assert {r.doc_id for r in first.collect()} == set(want.values())

    clean = dict(P.STAGES)["pii"](spark, first, D).persist()
    assert clean.count() == first.count() and clean.filter("text rlike '[a-z]@[a-z]+[.]com'").count() == 0

    mixed = dict(P.STAGES)["mixing"](spark, clean, D).persist()
    assert mixed.count() == mixing.replicate(clean).count() and mixed.columns == list(P.COLUMNS)

    out = dict(P.STAGES)["bpe"](spark, mixed, D)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(public_tokenizers.path(P.TOKENIZER)), special_tokens={})
    texts = {r.doc_id: r.text for r in clean.collect()}
    rows = out.collect()
    assert rows and all(r.token_ids == enc.encode_ordinary(texts[r.doc_id] or "") for r in rows)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, D)
    key = lambda df: sorted((r.doc_id, tuple(r.token_ids)) for r in df.collect())
    assert key(P.run(spark, D)) == key(docs)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{D}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{D}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0

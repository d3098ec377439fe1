"""Each stage of the pipeline against brute force, and the whole."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import mixing, quality
from tests.conftest import SF01
from tests.llm.helpers import leaks, near_groups

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mixing", "token_files"]


def test_quality_stage(spark, docs):
    model = quality.learn(docs, spark.read.parquet(f"{SF01}/labels.parquet"))
    score = quality.make_scorer(model)
    kept = STAGES["quality"](spark, docs, SF01)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted(r["doc_id"] for r in docs.collect() if score(r["text"]) >= 0.3)


def test_near_dedup_stage(spark, docs):
    some = docs.where("doc_id < 400")
    want = sorted(i for i, (_, c) in near_groups([(r["doc_id"], r["text"]) for r in some.collect()]).items() if i == c)
    kept = STAGES["near_dedup"](spark, some, SF01)
    assert kept.columns == docs.columns and ids(kept) == want


def test_decontaminate_stage(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    want = sorted(i for i, *_, bad in leaks([(r["doc_id"], r["text"]) for r in docs.collect()], items) if not bad)
    kept = STAGES["decontaminate"](spark, docs, SF01)
    assert kept.columns == docs.columns and ids(kept) == want


def test_mixing_stage(spark, docs):
    told, mixed = mixing.mix(docs)
    want = sorted(r["doc_id"] for r in mixed.collect())
    out = STAGES["mixing"](spark, docs, SF01)
    assert out.columns == docs.columns and ids(out) == want


def test_run(spark, docs):
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = corpus_pipeline.stored(stage(spark, before, SF01), f"test-{name}")
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, SF01).orderBy("start").collect()
    text = sorted((r["doc_id"], r["text"]) for r in before.collect())
    assert len(got) == len(text)
    at = 0
    for r, (i, t) in zip(got, text):
        x = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(x), zlib.crc32(x.tobytes()))
        at += len(x)

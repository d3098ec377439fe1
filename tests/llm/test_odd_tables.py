"""Very long texts, columns named like the operators' own, tables without rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tessera.llm import decontaminate, exact_dedup, line_dedup, near_dedup, quality, token_counts, token_files, toxicity
from tests.llm.helpers import leaks, line_removals, near_groups, rows, tables

tokenizers = pytest.importorskip("public_tokenizers")

#: Names that the operators give to columns of their own.
CLASHES = ["digest", "node", "key", "component", "component_id", "kept", "text_hash", "label", "n", "start", "ids", "block", "score", "line", "sketch", "bands"]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(4000)]
    long = "\n".join(" ".join(rng.choices(words, k=200)) for _ in range(1500))   # some 1.7 million characters
    item = " ".join(rng.choices(words, k=15))
    docs = [(1, long), (2, long.upper()), (3, long + " " + item), (4, None), (5, ""), (6, "short one"), (7, "short one"), (8, "w" * 300_000)]
    docs += [(k, " ".join(rng.choices(words, k=60))) for k in range(9, 70)]
    path = tmp_path_factory.mktemp("odd")
    tables(path, docs, benchmark=[(1, item), (2, None), (3, "")], labels=[(i, i % 2, (i // 2) % 2) for i, _ in docs if i > 8])
    t = pq.read_table(f"{path}/documents.parquet")
    for name in CLASHES:
        t = t.append_column(name, pa.array([f"{name}{k % 3}" for k in range(len(t))]))
    pq.write_table(t, f"{path}/documents.parquet")
    return str(path), docs


def test_long_texts_are_counted_whole(spark, odd):
    path, docs = odd
    tok = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    want = sorted((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in docs)
    assert rows(token_counts.op1_token_counts(spark, path), "doc_id", "n_bytes", "n_tokens") == sorted(want, key=repr)


def test_long_texts_near_and_exact_copies(spark, odd):
    path, docs = odd
    want = near_groups(docs)
    assert rows(near_dedup.op2_near_dedup(spark, path), "doc_id", "n_shingles", "component_id") == sorted(((i, *want[i]) for i, _ in docs), key=repr)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.op3_exact_dedup(spark, path).collect()}
    assert got[1] == got[2] == (2, 2) and got[3] == (3, 1) and got[4] == got[5] == (5, 2) and got[6] == (7, 2) and len(got) == len(docs)


def test_long_texts_hold_benchmark_passages(spark, odd):
    path, docs = odd
    items = [(1, pq.read_table(f"{path}/benchmark.parquet")["text"][0].as_py()), (2, None), (3, "")]
    want = sorted((i, n, hit, len(found), bad) for i, n, hit, found, bad in leaks(docs, items))
    got = rows(decontaminate.op6_decontaminate(spark, path), "doc_id", "n_words", "n_hit", "n_items", "contaminated")
    assert got == sorted(want, key=repr) and next(r for r in got if r[0] == 3)[4]


def test_long_texts_lines(spark, odd):
    path, docs = odd
    some = [d for d in docs if d[0] not in (2, 3)]   # one copy is enough to compare all pairs of its lines
    want = line_removals([(i, (t or "")[:60_000]) for i, t in some])
    few = spark.read.parquet(f"{path}/documents.parquet").where("doc_id NOT IN (2, 3)")
    few = few.withColumn("text", few["text"].substr(1, 60_000))
    few.write.parquet(f"{path}/few/documents.parquet")
    assert rows(line_dedup.op10_line_dedup(spark, f"{path}/few"), "doc_id", "n_lines", "n_removed") == \
        sorted(((i, n, len(gone)) for i, (n, gone) in want.items()), key=repr)
    whole = {r["doc_id"]: r for r in line_dedup.op10_line_dedup(spark, path).collect()}
    assert whole[1]["n_lines"] == 1500 and whole[2]["n_removed"] == 1500 and whole[3]["n_removed"] >= 1499


def test_long_texts_token_files(spark, odd):
    path, docs = odd
    tok = Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))
    at = 0
    got = {r["doc_id"]: r for r in token_files.op8_token_files(spark, path).collect()}
    for i, t in sorted(docs):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes())), i
        at += len(ids)


def test_long_texts_are_scored(spark, odd):
    path, docs = odd
    for query in (quality.op9_quality, toxicity.op4_toxicity):
        got = query(spark, path).collect()
        assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in docs)
        assert all(0 <= r["score"] <= 1 for r in got if "score" in r.asDict())


def test_names_of_stores():
    assert token_files.known_uri("s3a://b/x") == "s3://b/x" and token_files.known_uri("s3n://b/x") == "s3://b/x"
    assert token_files.known_uri("file:///x") == "file:///x" and token_files.known_uri("/x/y") == "/x/y" and token_files.known_uri("hdfs://n/x") == "hdfs://n/x"


def test_tables_without_rows(spark, tmp_path):
    empty = tables(tmp_path, [])
    assert decontaminate.op6_decontaminate(spark, empty).count() == 0
    (tmp_path / "some").mkdir()
    some = tables(tmp_path / "some", [(1, "one two three"), (2, None)])   # no benchmark items
    assert rows(decontaminate.op6_decontaminate(spark, some), "doc_id", "n_hit", "contaminated") == [(1, 0, False), (2, 0, False)]

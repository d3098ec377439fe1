"""Operators that judge each text by itself."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import pii, pretokens, quality, token_counts, token_files, toxicity
from tests.conftest import SF01
from tests.llm.helpers import rows, tables

tokenizers = pytest.importorskip("public_tokenizers")

PIECES = ["'s", "'T", "  ", "\n", "\t", "a", "É", "1", "²", "!", "<|endoftext|>", "\x85", "\xa0", "中", " ", "😀", "\x1c", "'ll", "'",
          "İ", "Σ", "ſ", "ß", "é", "Ⱥ", "é", "the", " of", "’s", " — ", "Привет", " ΟΔΟΣ", "ｅ", "ﬁ", "한글", "e\u0301", "\u2028", "\u3000", "٣", "Ⅻ",
          "<|startoftext|>", "<|endoftext", "\u200d", "👩\u200d👧", "\x00"]



def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    return dict(zip(*(pq.read_table(f"{SF01}/documents.parquet").to_pydict()[c] for c in ("doc_id", "text"))))


def test_whole_tokens_are_proven():
    spec = open(tokenizers.path("byte_bpe_50k.json")).read()
    tok = Tokenizer.from_str(spec)
    whole = token_counts.prove_whole_tokens(spec)
    assert len(whole) > 40_000
    for w in random.Random(1).sample(whole, 500):
        assert len(tok.encode(w, add_special_tokens=False).ids) == 1


def test_token_counts_equal_the_library():
    spec = open(tokenizers.path("byte_bpe_50k.json")).read()
    tok, count = Tokenizer.from_str(spec), token_counts.make_counter(spec, token_counts.prove_whole_tokens(spec))
    for t in odd_texts(4000, 3):
        assert count(t) == len(tok.encode(t, add_special_tokens=False).ids), repr(t)


def test_texts_beyond_the_known_characters_are_counted_by_pre_tokens(monkeypatch):
    """The library's own encoding is never asked, whatever the text holds."""
    spec = open(tokenizers.path("byte_bpe_50k.json")).read()
    count = token_counts.make_counter(spec, token_counts.prove_whole_tokens(spec))
    met = []
    monkeypatch.setattr(token_counts._Costs, "__missing__", lambda self, piece: met.append(piece) or 1)
    assert count("the “house” <|endoftext|> of Ωmega the house") >= 8
    assert "the" not in met and " house" not in met and any("Ω" in p for p in met)


def test_added_tokens_that_take_their_surroundings_are_refused():
    spec = '{"added_tokens": [{"content": "<x>", "lstrip": true}]}'
    with pytest.raises(ValueError, match="<x>"):
        pretokens.cut_added(spec)
    assert pretokens.cut_added('{"added_tokens": [{"content": "<x>"}, {"content": "<x>y"}]}')("a<x>yb<x>") == ["a", "<x>y", "b", "<x>", ""]


def test_token_counts_query(spark, texts):
    tok = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    want = [(i, len(t.encode()), n := len(tok.encode(t, add_special_tokens=False).ids), n > 512) for i, t in texts.items()]
    assert rows(token_counts.op1_token_counts(spark, SF01), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def test_character_classes_cover_what_is_known():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        found = pretokens.classes(Tokenizer.from_file(tokenizers.path(name)))
        assert len(found) == pretokens.KNOWN and found["é"] == "L" and found["²"] == "N" and found["\xa0"] == "S" and found["!"] == "O"


def test_token_ids_equal_the_library():
    spec = open(tokenizers.path("word_bpe_49k.json")).read()
    tok, encode = Tokenizer.from_str(spec), token_files.make_encoder(spec)
    for t in odd_texts(4000, 4):
        assert encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)


def test_token_files_query(spark, texts):
    tok = Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for i in sorted(texts):
        ids = np.array([*tok.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows(token_files.op8_token_files(spark, SF01), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


def test_token_files_frames(spark, tmp_path):
    """Null, empty, long and repeated rows; a reader takes only what it wants; damage is noticed."""
    docs = [(3, "a b c"), (1, None), (None, "x"), (2, ""), (1, "again"), (7, "long words " * 5000), (3, "a b c")]
    sf = tables(tmp_path, docs)
    frames = token_files.write_tokens(spark.read.parquet(f"{sf}/documents.parquet"), tokenizers.path("word_bpe_49k.json"),
                                      f"{tmp_path}/out", frame_bytes=40)
    tok = Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))
    got = token_files.token_statistics(frames).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 1, 2, 3, 3, 7]
    assert [r["n_tokens"] for r in got if r["doc_id"] == 2] == [1]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
    wanted = spark.createDataFrame([(3,), (99,)], "doc_id long")
    ids = [*tok.encode("a b c", add_special_tokens=False).ids, 1]
    assert rows(token_files.fetch_tokens(frames, wanted), "doc_id", "token_ids") == [(3, ids), (3, ids)]
    name = frames.first()["file"].removeprefix("file://")
    with open(name, "r+b") as f:
        table = token_files.seek_table(f, f.seek(0, 2))
        token_files.read_frame(f, table, 0)
        f.seek(table[0][0] - 1)
        last = f.read(1)
        f.seek(table[0][0] - 1)
        f.write(bytes([last[0] ^ 1]))
        with pytest.raises(Exception):
            token_files.read_frame(f, table, 0)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(t)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), m.end(), "card") for m in CARD.finditer(t) if 12 <= len(d := digits(m)) <= 19 and luhn(d)]
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.BASE.index(s[2])))


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(8)
    for _ in range(20_000):
        t = "".join(rng.choices(["a", "@", ".", "b.", "1", "25", "256", "0", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "é", "007", "@x.y"],
                                k=rng.randint(0, 30)))
        assert sorted(pii.base_spans(t)) == sorted(plain_spans(t)), t


@pytest.fixture(scope="module")
def field():
    return pii.train(pii.labelled_table())


def test_random_field_on_unseen_sentences(field):
    table = pii.labelled_table(seed=99, copies=3)
    wrong = [t for t, s in table if sorted(k for *_, k in s) != sorted(k for *_, k in pii.added_spans([t], field)[0])]
    assert len(wrong) <= 0.05 * len(table), wrong


def test_stretches_decode_as_the_whole_text(field):
    rng = random.Random(1)
    some = ["abc", "the", "12", "a=b", "[at]", "(dot)", "com", "555-123-4567", "password=abc123", "token", "=", '"deadbeef12"', "x,", "\n"]
    for _ in range(600):
        t = " ".join(rng.choices(some[:2] * 4 + some, k=rng.randint(1, 25)))
        at = [m.span() for m in pii._WORD.finditer(t)]
        if not at:
            continue
        whole = pii.viterbi([field.emissions([t[a:b] for a, b in at])], field.moves)[0]
        parts = {}
        for run, tags in zip(r := pii._stretches(t), pii.viterbi([field.emissions([t[a:b] for a, b in x]) for x in r], field.moves)):
            parts.update(zip(run, tags))
        assert list(whole) == [parts.get(s, 0) for s in at], t


def test_viterbi_finds_the_best_path(field):
    import itertools
    rng = np.random.default_rng(2)
    for n in (1, 2, 4):
        e = rng.normal(size=(n, len(pii.TAGS)))
        best = max(itertools.product(range(len(pii.TAGS)), repeat=n), key=lambda p: sum(
            field.moves[(len(pii.TAGS), *p)[k], p[k]] + e[k, p[k]] for k in range(n)))
        assert tuple(pii.viterbi([e], field.moves)[0]) == best


@pytest.mark.parametrize("text,value", [
    ('token = "0123abcd"###', 'token = "0123abcd'), ("pwd='a1b2';x", "pwd='a1b2"), ('key="a1" b"', 'key="a1'), ("(555-123-4567),", "555-123-4567"),
    ("(555) 123-4567)", "(555) 123-4567)"), ("(555) 123-4567.", "(555) 123-4567"), ("555-123-4567)", "555-123-4567"), ("(555-123-4567", "555-123-4567"),
    ("<AKIA22>", "AKIA22"), ('"', ""), ("()", ""), ("password=", "password="), ('token = "', "token ="),
])
def test_ends_of_a_value(text, value):
    a, b = pii._ends(f"x {text} y", 2, 2 + len(text))
    assert f"x {text} y"[a:b] == value


def test_ends_of_a_very_long_value():
    n = 1_000_000
    for text in ("(" * n, ")" * n, "!" * n, "(" * n + ")" * n, 'key="' + "a" * n):
        a, b = pii._ends(text, 0, len(text))
        assert text[a:b] in ("", text)


def test_pii_query(spark, texts):
    got = {r["doc_id"]: r for r in pii.op7_pii(spark, SF01).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        told = [f"{k}:{a}:{b}" for a, b, k in plain_spans(t)]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(x.startswith(k) for x in told) for k in pii.BASE]
        assert set(told) <= set(got[i]["spans"].split(",")) | {""}


def test_pii_of_null_and_empty(spark, tmp_path):
    sf = tables(tmp_path, [(1, None), (2, ""), (None, "a@b.c"), (2, "a@b.c"), (4, "x " * 50_000 + "10.0.0.1")])
    got = rows(pii.op7_pii(spark, sf), "doc_id", "n_email", "n_ip", "spans")
    assert got == sorted([(1, 0, 0, ""), (2, 0, 0, ""), (None, 1, 0, "email:0:5"), (2, 1, 0, "email:0:5"), (4, 0, 1, "ip:100000:100008")], key=repr)


def labelled():
    x, y = (pq.read_table(f"/root/testdata/sf0.1/{t}.parquet").to_pylist() for t in ("documents", "labels"))
    docs = {r["doc_id"]: r for r in x}
    return [(docs[r["doc_id"]], r["quality"], r["toxic"], zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in y]


def test_quality_on_held_out_labels():
    data = labelled()
    train = [(q, d["text"]) for k in (0, 1) for d, q, _, held in data if not held and q == k]
    score = quality.make_scorer(quality.fit([*train[:500], *[r for r in train if r[0]][:1500]]))
    good = np.array([score(d["text"]) for d, q, _, held in data if held and q])
    bad = np.array([score(d["text"]) for d, q, _, held in data if held and not q])
    assert (good[:, None] > bad[None]).mean() > 0.97 and (good >= 0.3).mean() > 0.98


def test_quality_query(spark):
    df = quality.op9_quality(spark, SF01)
    got = df.collect()
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_quality_and_toxicity_without_labels(spark, tmp_path):
    sf = tables(tmp_path, [(1, None), (2, ""), (2, "some words"), (None, "x")])
    assert [r["score"] for r in quality.op9_quality(spark, sf).collect()] == [0.5] * 4
    got = toxicity.op4_toxicity(spark, sf).collect()
    assert [(r["toxic"], r["probability"]) for r in got] == [(False, 0.0)] * 4


def test_quality_never_learns_held_out_labels(spark, tmp_path):
    docs = [(i, f"text {i}") for i in range(50)]
    sf = tables(tmp_path, docs, labels=[(i, i % 2, 0) for i in range(50)])
    table = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    used = quality.training_rows(table("documents"), table("labels"), "quality", ~quality.held_out_col())
    assert sorted(t for _, t in used) == sorted(t for i, t in docs if zlib.crc32(str(i).encode()) % 5)


def test_toxicity_on_held_out_labels():
    data = labelled()
    train = [(d["text"], d["lang"], t) for d, _, t, held in data if not held]
    toxic = [r for r in train if r[2]]
    model = toxicity.fit([*[r for r in train if not r[2]][:len(toxic)], *toxic])
    assert model["links"][-1][0] == "toxic" and len(model["links"]) > 2
    score = toxicity.make_scorer(model)
    held = [(score(d["text"])[-1] >= model["threshold"], t) for d, _, t, held in data if held]
    assert np.mean([h for h, t in held if t]) > 0.9 and np.mean([h for h, t in held if not t]) < 0.03


def test_toxicity_query(spark):
    got = toxicity.op4_toxicity(spark, SF01).collect()
    assert len(got) == 1000 and all(r["chain"][-1]["probability"] == r["probability"] for r in got)


def test_empty_tables(spark, tmp_path):
    sf = tables(tmp_path, [])
    for query in (token_counts.op1_token_counts, token_files.op8_token_files, pii.op7_pii, quality.op9_quality, toxicity.op4_toxicity):
        assert query(spark, sf).count() == 0


def test_clashing_columns(spark, tmp_path):
    sf = tables(tmp_path, [(1, "some text"), (2, "more text")])
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumns({c: F.lit(c) for c in ("score", "n_tokens", "spans", "toxic", "held_out", "tie")})
    assert token_counts.count_tokens(df, tokenizers.path("byte_bpe_50k.json")).count() == 2
    assert quality.keep_good(df, {"prior": 0.5}).columns == df.columns
    assert pii.detect(df).count() == 2
    assert toxicity.score_toxicity(df, {"prior": 0.0}).count() == 2

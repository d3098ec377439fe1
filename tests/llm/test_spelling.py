"""Spelling variants against comparing all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from tessera.llm import spelling
from tests.conftest import SF01
from tests.llm.helpers import rows, tables

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(docs):
    total = Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def deletions(w):
    return {w[:k] + "\0" + w[k + 1:] for k in range(len(w))}, {w[:k] + w[k + 1:] for k in range(len(w))}


def expected(words):
    """By lists of words that agree but for one place."""
    gaps, shorter = {}, {}
    for w in words:
        a, b = deletions(w)
        for g in a:
            gaps.setdefault(g, set()).add(w)
        for g in b:
            shorter.setdefault(g, set()).add(w)
    forms, out = {}, []
    for w, n in words.items():
        a, b = deletions(w)
        found = {v for g in a for v in gaps[g]} | {v for v in b if v in words} | shorter.get(w, set())
        found.discard(w)
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 10 * n else None
        forms[w] = form
        out.append([w, form, None, n, len(found), words[form] if form else None])
    for r in out:
        root = r[0]
        while forms[root]:
            root = forms[root]
        r[2] = root
    return sorted(map(tuple, out), key=repr)


def related_words(n, seed, alphabet="abcdé"):
    rng = random.Random(seed)
    words = ["".join(rng.choices(alphabet, k=rng.randint(7, 11))) for _ in range(n // 4)]
    while len(words) < n:
        w, k = rng.choice(words), rng.randrange(8)
        words.append(rng.choice([w[:k] + rng.choice(alphabet) + w[k:], w[:k] + rng.choice(alphabet) + w[k + 1:], w[:k] + w[k + 1:]]))
    return {w: rng.choice([2, 3, 30, 400, 5000]) for w in words if len(w) >= 7}


def test_brute_force_agrees_with_all_pairs():
    words = related_words(300, 1)
    got = {r[0]: r[4] for r in expected(words)}
    assert got == {w: sum(near(w, v) for v in words) for w in words}


def test_variants_in_one_leaf(spark):
    words = related_words(3000, 2)
    given = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(spelling.spelling_variants(given), *COLUMNS) == expected(words)


def test_variants_in_many_leaves_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LEAF", 200)
    monkeypatch.setattr(spelling, "LEAF_MOST", 120)
    monkeypatch.setattr(spelling, "TOGETHER", 64)
    words = related_words(4000, 3, "abcdefghiéèü")
    given = spark.createDataFrame(list(words.items()), "word string, n long")
    assert len(spelling.upper_trees(given)) > 3
    assert rows(spelling.spelling_variants(given), *COLUMNS) == expected(words)


def test_long_words_and_chains(spark):
    long = "ab" * 300
    words = {long: 5000, long + "c": 400, "x" * 20_000: 2, "x" * 20_001: 40, "aaaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 200, "aaaaabbb": 2000}
    given = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows(spelling.spelling_variants(given), *COLUMNS)
    assert got == expected(words) and ("aaaaaaaa", "aaaaaaab", "aaaaabbb", 2, 1, 20) in got


def test_boxes_never_hide_a_neighbour():
    rng = random.Random(5)
    words = [w.encode("latin-1") for w in related_words(400, 6) if len(w) == 9]
    x = spelling.vectors(spelling.letters(words))
    root = spelling.tree(x)
    found = {(words[a], words[b]) for i, j in spelling.search(root, x, x, False) for a, b in zip(i, j)}
    for _ in range(3000):
        a, b = rng.choice(words), rng.choice(words)
        if near(a, b):
            assert (a, b) in found
    assert int(np.abs(x[0] - x[0]).sum()) == 0


def test_spelling_query(spark, tmp_path):
    docs = list(zip(*(pq.read_table(f"{SF01}/documents.parquet").to_pydict()[c] for c in ("doc_id", "text"))))
    assert rows(spelling.op13_spelling(spark, SF01), *COLUMNS) == expected(counted(docs))


def test_odd_texts(spark, tmp_path):
    docs = [(1, None), (None, "Übergröße übergröße ÜBERGRÖSSE"), (2, ""), (3, "naïveté×÷naïveté naïveté×÷naïveté"), (4, "ﬀfoobarbaz foobarbazİfoobarbaz"),
            (5, "wordword " * 60_000), (5, "wordword " * 3), (6, "z" * 50_000 + " " + "z" * 50_000), (7, "Wordwxrd wordwxrd")]
    for k, d in ((0, docs), (1, [])):
        (tmp_path / str(k)).mkdir()
        assert rows(spelling.op13_spelling(spark, tables(tmp_path / str(k), d)), *COLUMNS) == expected(counted(d))

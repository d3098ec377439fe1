"""Operators that compare documents, and the pipeline."""

import collections
import hashlib
import random
import string

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.llm import components, decontaminate, exact_dedup, line_dedup, mixing, near_dedup
from tests.conftest import SF01
from tests.llm.helpers import edited_documents, leaks, line_removals, near_groups, rows, tables


def documents(sf):
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"]))


# ---- near duplicates

def test_near_dedup_against_all_pairs(spark, tmp_path):
    docs = edited_documents(400)
    want = [(i, n, c, i == c) for i, (n, c) in near_groups(docs).items()]
    got = rows(near_dedup.op2_near_dedup(spark, tables(tmp_path, docs)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(want, key=repr)


def test_near_dedup_blocks(spark, tmp_path, monkeypatch):
    """Large buckets, here of a few documents, are compared block by block."""
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    docs = edited_documents(150, seed=9)
    want = [(i, c) for i, (_, c) in near_groups(docs).items()]
    assert rows(near_dedup.op2_near_dedup(spark, tables(tmp_path, docs)), "doc_id", "component_id") == sorted(want, key=repr)


def _plans(monkeypatch, module):
    """The plans of what a module stores, by name, as Spark makes them before it runs them."""
    plans, kept = {}, module.stored

    def watched(x, name):
        plans.setdefault(name, []).append(x._jdf.queryExecution().executedPlan().toString())
        return kept(x, name)

    monkeypatch.setattr(module, "stored", watched)
    return plans


def test_exploded_bands_are_not_broadcast(spark, tmp_path, monkeypatch):
    plans = _plans(monkeypatch, near_dedup)
    near_dedup.near_duplicates(spark.read.parquet(f"{tables(tmp_path, edited_documents(40))}/documents.parquet"))
    (plan,) = plans["near-buckets"]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for j in (0.75, 0.85, 0.95):
        errors = []
        for _ in range(40):
            pool = rng.permutation(pool)
            both = round(2000 * j)
            a, b = np.sort(pool[:both + (2000 - both) // 2]), np.sort(np.r_[pool[:both], pool[both + (2000 - both) // 2:2000]])
            x, y = (np.frombuffer(near_dedup.odd_sketch(near_dedup.signature(s)), np.uint64) for s in (a, b))
            errors.append(near_dedup.estimate(int(np.bitwise_count(x ^ y).sum())) - j)
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.2


def test_near_dedup_odd_rows(spark, tmp_path):
    long = " ".join(f"v{k}" for k in range(30_000))
    docs = [(5, "a b c"), (3, "A b  C"), (None, "a b c"), (7, None), (8, ""), (9, long), (2, long + " x"), (9, long), (None, "alone here")]
    sf = tables(tmp_path, docs)
    got = rows(near_dedup.op2_near_dedup(spark, sf), "doc_id", "component_id", "kept")
    assert got == sorted([(5, 3, False), (3, 3, True), (None, 3, False), (7, 7, True), (8, 8, True), (9, 2, False), (9, 2, False), (2, 2, True),
                          (None, None, False)], key=repr)
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumn("node", F.lit(1)).withColumn("component", F.lit(2))
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert rows(kept, "doc_id") == sorted([(3,), (7,), (8,), (2,), (None,)], key=repr)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(400 + k, 401 + k) for k in range(60)] + [(900, 900 - k) for k in range(1, 50)]
    from tests.llm.helpers import Union
    u = Union({x for e in edges for x in e})
    for a, b in edges:
        u.join(a, b)
    want = sorted({(x, u.find(x)) for e in edges if e[0] != e[1] for x in e})
    assert sorted(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect())) == want


# ---- exact duplicates

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def exact_groups(docs):
    groups = collections.defaultdict(list)
    for i, t in docs:
        groups[(t or "").translate(LOWER)].append(i)
    return sorted(((i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g), key=repr)


def test_exact_dedup_query(spark):
    got = rows(exact_dedup.op3_exact_dedup(spark, SF01), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == exact_groups(documents(SF01))


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda c: F.substring(F.sha2(c, 256), 1, 1)], ids=["sha256", "colliding"])
def test_exact_dedup_over_batches_and_collisions(spark, tmp_path, digest):
    """One file a micro-batch; a digest that collides is put right by the byte check."""
    rng = random.Random(2)
    docs = [(i, rng.choice([None, "", "A", "a", "É", "é", "b" * 1000, f"x{rng.randint(0, 80)}"])) for i in range(200)]
    sf = tables(tmp_path, docs, files=4)
    got = exact_dedup.deduplicate(spark, f"{sf}/documents.parquet", digest=digest, maxFilesPerTrigger="1")
    assert rows(got, "doc_id", "keep_id", "group_size", "kept") == sorted((r[:4] for r in exact_groups(docs)), key=repr)


def test_exact_dedup_goes_on_from_its_checkpoint(spark, tmp_path):
    """New files meet the state that earlier ones left."""
    sf = tables(tmp_path, [(1, "a"), (2, "b")], files=2)
    first = exact_dedup.stream_state(spark, f"{sf}/documents.parquet", checkpoint=f"{tmp_path}/state")
    assert sorted(r["n"] for r in first.collect()) == [1, 1]
    more = tmp_path / "more"
    more.mkdir()
    tables(more, [(3, "A")])
    (more / "documents.parquet").rename(tmp_path / "documents.parquet" / "part-9.parquet")
    again = exact_dedup.stream_state(spark, f"{sf}/documents.parquet", checkpoint=f"{tmp_path}/state")
    assert sorted((r["n"], r["keeper"]["doc_id"]) for r in again.collect()) == [(1, 2), (2, 3)]


def test_exact_dedup_odd_rows(spark, tmp_path):
    sf = tables(tmp_path, [(None, "a"), (None, "A"), (4, None), (5, ""), (6, "b"), (6, "b"), (7, "long " * 50_000)])
    got = exact_dedup.deduplicate(spark, f"{sf}/documents.parquet")
    assert sorted((repr(r["doc_id"]), repr(r["keep_id"]), r["group_size"]) for r in got.collect()) == sorted(
        [("None", "None", 2)] * 2 + [("4", "5", 2), ("5", "5", 2), ("6", "6", 2), ("6", "6", 2), ("7", "7", 1)])
    assert got.where("kept").count() == 4
    assert exact_dedup.drop_duplicates(spark, f"{sf}/documents.parquet").count() == 4


# ---- decontamination

def contaminated(df):
    return sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect())


def expected_leaks(docs, items):
    return sorted((i, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bad) for i, n, hit, found, bad in leaks(docs, items))


def test_decontamination_query(spark):
    items = list(zip(*(pq.read_table(f"{SF01}/benchmark.parquet").to_pydict()[c] for c in ("item_id", "text"))))
    assert contaminated(decontaminate.op6_decontaminate(spark, SF01)) == expected_leaks(documents(SF01), items)


@pytest.mark.parametrize("letters,short", [("ab", False), ("ab", True), ("abcé", True)])
def test_decontamination_against_all_windows(spark, tmp_path, letters, short):
    """Few different words, so that windows and fingerprints repeat; short items too."""
    rng = random.Random(len(letters) + short)
    text = lambda k: " ".join(rng.choices(letters, k=k))
    items = [(i, text(rng.choice([0, 1, 3, 5, 7, 9, 10, 12, 20]) if short else rng.randint(10, 20))) for i in range(12)] + [(3, text(12))]
    docs = [(i, text(rng.randint(0, 60)).replace(" ", ". ")) for i in range(120)] + [(120, None)]
    assert contaminated(decontaminate.op6_decontaminate(spark, tables(tmp_path, docs, items))) == expected_leaks(docs, items)


def test_winnowing_guarantee():
    """Every shared span of ten words holds a fingerprint of both sides at the same place."""
    rng = np.random.default_rng(1)
    memo = decontaminate.WordHashes()
    for _ in range(200):
        span = [bytes([97 + x]) for x in rng.integers(0, 4, 10)]
        found = []
        for _ in range(2):
            before = [bytes([97 + x]) for x in rng.integers(0, 4, rng.integers(0, 30))]
            after = [bytes([97 + x]) for x in rng.integers(0, 4, rng.integers(0, 30))]
            at = {p["at"] - len(before) for p in decontaminate.fingerprints(before + span + after, memo)}
            found.append({x for x in at if 0 <= x <= 5})
        assert found[0] & found[1]


def test_a_common_gram_is_not_paired_with_all_its_copies(spark, tmp_path):
    """A phrase of five to nine words in all documents and items, between other
    neighbours: only fingerprints around a shared window of ten words meet."""
    rng = random.Random(5)
    other = lambda k: " ".join(f"w{rng.randrange(10**6)}" for _ in range(k))
    memo = decontaminate.WordHashes()
    low = min((f"q{k} of these is true".split() for k in range(5000)), key=lambda w: decontaminate.ngrams(memo.of([x.encode() for x in w]), 5)[0])
    phrase = [*low, *"or else not so".split()]  # its first gram's hash is low, so that it is kept wherever it stands
    items = [(i, f"{other(12)} {' '.join(phrase[:rng.randint(5, 9)])} {other(12)}") for i in range(60)]
    docs = [(i, f"{other(20)} {' '.join(phrase[:rng.randint(5, 9)])} {other(20)}") for i in range(80)]
    docs += [(80 + i, f"{other(3)} {items[i][1]} {other(3)}") for i in range(5)]
    sf = tables(tmp_path, docs, items)
    assert contaminated(decontaminate.op6_decontaminate(spark, sf)) == expected_leaks(docs, items)

    contexts, *_ = decontaminate.benchmark_index(spark.read.parquet(f"{sf}/benchmark.parquet"))
    sent = [(i, *(p[k] for k in ("h", "size", "at", "start", "words", "near"))) for i, t in docs
            for p in decontaminate.fingerprints(decontaminate.words_of(t), memo)]
    sent = spark.createDataFrame(sent, "row long, h long, size int, at int, start int, words array<string>, near array<bigint>")
    pairs = decontaminate.meeting(sent, contexts)
    assert sent.join(contexts, ["h", "size"]).count() > 1000
    assert pairs.count() == pairs.select("row", "at", "ctx").distinct().count() < 100
    assert {r["row"] for r in pairs.collect()} == set(range(80, 85))


def test_benchmark_is_broadcast_by_its_measured_size(spark, tmp_path, monkeypatch):
    docs, items = [(i, f"a{i} b c d e f g h i j k l{i}") for i in range(30)], [(i, f"z a{i} b c d e f g h i j") for i in range(20)]
    sf = tables(tmp_path, docs, items)
    want = expected_leaks(docs, items)
    for most, join in ((decontaminate.MOST_BROADCAST, "BroadcastHashJoin"), (1000, "SortMergeJoin")):
        monkeypatch.setattr(decontaminate, "MOST_BROADCAST", most)
        plans = _plans(monkeypatch, decontaminate)
        assert contaminated(decontaminate.op6_decontaminate(spark, sf)) == want
        (plan,) = plans["contamination"]
        assert [x for x in ("BroadcastHashJoin", "SortMergeJoin") if x in plan] == [join]


def test_drop_contaminated(spark, tmp_path):
    leak = "one two three four five six seven eight nine ten"
    sf = tables(tmp_path, [(1, f"x {leak.upper()} y"), (None, leak), (3, "clean"), (4, None), (3, leak + " more")], [(7, leak), (None, "zz")])
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumn("row", F.lit(1)).withColumn("spans", F.lit("x"))
    kept = decontaminate.drop_contaminated(df, spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert kept.columns == df.columns and rows(kept, "doc_id", "text") == [(3, "clean"), (4, None)]


# ---- mixing

def test_targets():
    assert [float(x) for x in mixing.target_sizes([10, 100, 1000, 5], [5, 2, 1, 5])] == [30, 300, 770, 15]
    assert mixing.target_sizes([], []) == [] and mixing.target_sizes([0, 0], [5, 2]) == [0, 0]


def test_drawn_blocks_are_not_broadcast(spark, tmp_path):
    _, mixed = mixing.mix(spark.read.parquet(f"{tables(tmp_path, [(i, 'w ' * i) for i in range(40)])}/documents.parquet"))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_permutation_and_tree():
    for n in (1, 2, 3, 5, 17, 1000, 4097):
        assert sorted(mixing.permute(np.arange(n), n, 3, 1).tolist()) == list(range(n))
    quota, shards = (100, 7, 0, 33), 9
    share = mixing.split(quota, shards, 5)
    ranges = [share(k) for k in range(shards)]
    assert all(sum(n for _, n in r) in (15, 16) for r in ranges)
    for s, q in enumerate(quota):  # disjoint, and together everything
        taken = sorted(x for r in ranges for x in range(r[s][0], r[s][0] + r[s][1]))
        assert taken == list(range(q))


def test_mixing_query(spark):
    got = mixing.op5_mixing(spark, SF01).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.op5_mixing(spark, SF01).collect()))
    t = pq.read_table(f"{SF01}/documents.parquet").to_pylist()
    size = {r["doc_id"]: len(r["text"].encode().split()) for r in t}
    source = {r["doc_id"]: r["source"] for r in t}
    by = collections.Counter()
    for i, n in size.items():
        by[source[i]] += n
    names = sorted(by)
    want = dict(zip(names, map(float, mixing.target_sizes([by[n] for n in names], [(5, 2, 1)[k % 3] for k in range(len(names))]))))
    taken = collections.Counter()
    for r in got:
        i = r["doc_id"]
        assert (r["size"], r["source_size"]) == (size[i], by[source[i]]) and r["target"] == pytest.approx(want[source[i]])
        assert r["taken"] <= 3 * r["size"] and (r["taken"] == 0 or r["taken"] % r["size"] == 0)
        taken[source[i]] += r["taken"]
    assert all(abs(taken[n] - want[n]) <= 0.03 * want[n] for n in names)


def test_mix_is_a_shuffle_of_disjoint_blocks(spark):
    told, mixed = mixing.mix(spark.read.parquet(f"{SF01}/documents.parquet"), block_words=500, shard_words=50_000)
    got = mixed.collect()
    for _, group in (shards := {s: [r for r in got if r["shard"] == s] for s in {r["shard"] for r in got}}).items():
        assert sorted(r["position"] for r in group) == list(range(len(group)))
        assert len({r["source"] for r in group}) >= 15  # every shard mixes the sources
    assert len(shards) > 5
    per_unit = collections.Counter(r["unit"] for r in got)
    assert max(per_unit.values()) <= 3


def test_mixing_odd_rows(spark, tmp_path):
    docs = [(None, "a b c", "en", "x"), (1, "a b", "en", "y"), (1, "a b", "en", "y"), (2, None, "en", None), (3, "", "en", "x"), (4, "q z", "en", None)]
    sf = tables(tmp_path, docs)
    got = rows(mixing.op5_mixing(spark, sf), "doc_id", "size", "source_size", "taken")
    assert got == sorted([(None, 3, 3, 6), (1, 2, 4, 2), (1, 2, 4, 2), (2, 0, 2, 0), (3, 0, 3, 0), (4, 2, 2, 2)], key=repr)
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumn("unit", F.lit(1)).withColumn("size", F.lit(2))
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and rows(out, "doc_id") == sorted([(None,), (None,), (1,), (1,), (4,)], key=repr)


def test_last_round_passes_over_long_documents(spark, tmp_path):
    rng = random.Random(7)
    docs = []
    for name in "abcdefghijkl":  # one very long document in each small source
        for n in [rng.randint(300, 600), *(rng.randint(5, 15) for _ in range(60))]:
            docs.append((len(docs), f"w{len(docs)} " * n, "en", name))
    sf = tables(tmp_path, docs)
    got = {r["doc_id"]: r for r in mixing.op5_mixing(spark, sf).collect()}
    order = {r["doc_id"]: (r["o"] % (1 << 64)) for r in spark.read.parquet(f"{sf}/documents.parquet")
             .select("doc_id", F.xxhash64(F.lit(mixing.SEED), "doc_id", F.xxhash64("text")).alias("o")).collect()}
    for name in "abcdefghijkl":
        mine = sorted((r for r in docs if r[3] == name), key=lambda r: order[r[0]])
        source_size, target = got[mine[0][0]]["source_size"], got[mine[0][0]]["target"]
        whole, left = int(target // source_size), target % source_size
        want, untaken = {}, []
        for i, *_ in mine:  # one pass: what fits what is left is taken
            fits = got[i]["size"] <= left
            left -= got[i]["size"] * fits
            want[i] = got[i]["size"] * (whole + fits)
            if not fits:
                untaken.append((abs(got[i]["size"] - left), i))
        closest = min((abs(got[i]["size"] - left), order[i], i) for _, i in untaken)
        if got[closest[2]]["size"] < 2 * left:
            want[closest[2]] += got[closest[2]]["size"]
        assert {i: got[i]["taken"] for i in want} == want
        assert abs(sum(want.values()) - target) <= 15 / 2 or all(r[0] not in {i for _, i in untaken} or got[r[0]]["size"] >= 300 for r in mine)


def test_mixing_of_more_sources_than_are_broadcast(spark, monkeypatch):
    plain = rows(mixing.op5_mixing(spark, SF01), "doc_id", "size", "source_size", "target", "taken")
    for name, n in (("FEW_SOURCES", 15), ("GROUPS", 4)):
        monkeypatch.setattr(mixing, name, n)
    assert rows(mixing.op5_mixing(spark, SF01), "doc_id", "size", "source_size", "target", "taken") == plain


# ---- lines

@pytest.mark.parametrize("block", [1 << 15, 4], ids=["whole lists", "blocks"])
def test_line_dedup_against_all_pairs(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    docs = edited_documents(120, seed=6, lines=True)
    want = [(i, n, len(gone), ",".join(map(str, gone))) for i, (n, gone) in line_removals(docs).items()]
    got = rows(line_dedup.op10_line_dedup(spark, tables(tmp_path, docs)), "doc_id", "n_lines", "n_removed", "removed")
    assert got == sorted(want, key=repr)


def test_lines_are_split_and_hashed_alike():
    texts = [t for _, t in edited_documents(60, seed=3, lines=True) if t is not None] + ["", "\n", "A a\tA\n\n b\x0bc"]
    found = line_dedup.Lines([t.encode().translate(line_dedup._FOLD) for t in texts])
    want = [(d, k, frozenset(line.split())) for d, t in enumerate(texts) for k, line in enumerate(t.encode().lower().split(b"\n")) if line.split()]
    assert list(zip(found.doc.tolist(), found.number.tolist(), found.size.tolist())) == [(d, k, len(s)) for d, k, s in want]
    same = collections.defaultdict(set)
    for key, (_, _, s) in zip(zip(found.d1.tolist(), found.d2.tolist()), want):
        same[key].add(s)
    assert all(len(s) == 1 for s in same.values()) and len(same) == len({s for *_, s in want})


def test_lists_are_formed_again(spark, tmp_path, monkeypatch):
    """Same result if every best match passes for likely and no other is sent along."""
    for name, n in (("LIKELY", 1e9), ("NEAREST", 0), ("HELD", 300), ("BUCKET", 100)):
        monkeypatch.setattr(line_dedup, name, n)
    docs = edited_documents(120, seed=8, lines=True)
    want = [(i, n, len(gone), ",".join(map(str, gone))) for i, (n, gone) in line_removals(docs).items()]
    got = rows(line_dedup.op10_line_dedup(spark, tables(tmp_path, docs)), "doc_id", "n_lines", "n_removed", "removed")
    assert got == sorted(want, key=repr)


def test_bitmaps_tell_long_lines_apart():
    lines = line_dedup.Lines([" ".join(f"w{k}x{j}" for j in range(200)).encode() for k in range(60)])
    low, high = lines.bitmaps()
    differing = np.bitwise_count(low[1:] ^ low[:-1]).astype(int) + np.bitwise_count(high[1:] ^ high[:-1])
    assert (differing <= 400 - 2 * line_dedup.least_overlap(200, 200)).mean() < 0.5
    # and never more than the sets do
    near = line_dedup.Lines([b" ".join(b"w%d" % j for j in range(n)) for n in range(1, 60)])
    low, high = near.bitmaps()
    assert all(np.bitwise_count(low[i] ^ low[j]) + np.bitwise_count(high[i] ^ high[j]) <= j - i for i in range(59) for j in range(i, 59))


def test_prefix_entries_come_many_in_a_row(spark, tmp_path):
    docs = [(i, "\n".join(" ".join(f"w{(i * 7 + j * k) % 997}" for j in range(30)) for k in range(1, 20))) for i in range(50)]
    df = spark.read.parquet(f"{tables(tmp_path, docs)}/documents.parquet").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    _, classes = line_dedup.census(df)
    sent = line_dedup.prefix_entries(df, classes, 16).collect()
    found = [line_dedup.from_bucket([r["rows"]], r["width"]) for r in sent]
    entries = sum(f.shape[1] for f in found)
    assert len(sent) <= 16 * df.rdd.getNumPartitions() and entries > 40 * len(sent)
    assert all((f[4] >> 32 <= 30).all() and (f[3] < 19).all() and np.isin(f[2], range(50)).all() for f in found)
    lists = [(r["bucket"], k) for r, f in zip(sent, found) for k in f[0].tolist()]
    assert len({k for _, k in lists}) == len(set(lists))  # a list has one bucket


def test_first_places_of_lines(spark, tmp_path):
    line = "one two three four five six seven eight"
    docs = [(None, line), (-1 << 63, line), (-1, f"x\n{line}"), ((1 << 63) - 1, f"{line}\n{line} nine")]
    got = rows(line_dedup.op10_line_dedup(spark, tables(tmp_path, docs)), "doc_id", "n_lines", "removed")
    assert got == sorted([(None, 1, ""), (-1 << 63, 1, "0"), (-1, 2, "1"), ((1 << 63) - 1, 2, "0,1")], key=repr)


def test_drop_lines(spark, tmp_path):
    line = "one two three four five six seven eight"
    sf = tables(tmp_path, [(1, f"{line}\nkept"), (2, f"other\n\n{line} nine\nlast"), (None, f"{line} ten"), (4, None), (5, ""), (1, f"{line}\nkept")])
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumn("number", F.lit(1)).withColumn("tokens", F.lit("x"))
    out = line_dedup.drop_lines(df)
    assert out.columns == df.columns
    assert rows(out, "doc_id", "text") == sorted([(1, "kept"), (1, "kept"), (2, "other\n\nlast"), (None, f"{line} ten"), (4, None), (5, "")], key=repr)


def test_line_prefixes_are_exact():
    """Sets at the threshold always share an indexed and a probed token."""
    for n in range(1, 200):
        for m in range(n, 4 * n // 3 + 1):
            need = line_dedup.least_overlap(n, m)
            assert need == -(-3 * (n + m) // 7)
            # the shorter's prefix misses at most n - need shared tokens, the longer's m - need
            assert line_dedup.indexing(n) >= n - need + 1 or need > n
            assert line_dedup.probing(m) >= m - need + 1 or need > n


# ---- all

def test_empty_tables(spark, tmp_path):
    sf = tables(tmp_path, [])
    for query in (near_dedup.op2_near_dedup, exact_dedup.op3_exact_dedup, mixing.op5_mixing, decontaminate.op6_decontaminate, line_dedup.op10_line_dedup):
        assert query(spark, sf).count() == 0, query

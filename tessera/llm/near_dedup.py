"""Near duplicates by MinHash, with odd sketches as the banded candidates' test.

A document's set holds its distinct five-word shingles (64-bit hashes).  Equal
sets are one node, so copies never multiply.  Of each node ``SAMPLES`` MinHash
values are taken; ``BANDS`` bands of ``ROWS`` values give its buckets, and all
values, each hashed with its number, are folded into the parity bitmap of an
odd sketch.  The bits in which two sketches differ estimate the similarity; a
candidate whose estimate is below ``SKETCH_LEAST`` (five standard deviations
under the threshold) is dropped, any other is confirmed on the full sets.

A bucket never emits its pairs.  First each member is compared with the
bucket's smallest node; the confirmed links give components.  Then only
buckets that still hold more than one component are gone through, in blocks
of bounded size, and only across components, which loses no link between them.

At the threshold, a link is missed if no band agrees (1 - 0.75**4 to the power
of 32, or 5 in a million) or if its sketches differ in more bits than a
candidate may have (15 in a million): 20 in a million together, 7 at a
similarity of 0.76, less than 0.1 at 0.80.

Null, empty and wordless texts have an empty set and link with nothing.
Documents of fewer than five words have one shingle, the whole sequence.  A
doc_id that repeats stands for all its rows; null doc_ids get the component
of the others, and none if there are no others.  An empty table gives no rows.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import documents, flat_map_groups, map_rows, same, stored, text_of
from tessera.llm.components import components
from tessera.llm.registry import register
from tessera.llm.shingling import U, WordHashes, mix, ngrams

SHINGLE = 5
SAMPLES = 128
ROWS = 4
BANDS = SAMPLES // ROWS
SKETCH_BITS = 512
SKETCH_LEAST = 0.55
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Members, and shingles, of one block of a large bucket.
BLOCK = 512
BLOCK_SHINGLES = 1 << 19

_SEEDS = mix(np.arange(1, 2 * SAMPLES + 1, dtype=U))
_A, _B = _SEEDS[:SAMPLES, None] | U(1), _SEEDS[SAMPLES:, None]
_NUMBERS = mix(np.arange(1000, 1000 + SAMPLES, dtype=U))


def shingles(text: str, memo: WordHashes) -> np.ndarray:
    """The sorted set of shingle hashes; words are runs of non-space, ASCII lower-cased."""
    hashes = memo.of(text.encode().lower().split())
    return np.unique(ngrams(hashes, min(SHINGLE, len(hashes)))) if len(hashes) else np.zeros(0, U)


def signature(s: np.ndarray) -> np.ndarray:
    """The least value of each of ``SAMPLES`` hash functions over the set."""
    out = np.full(SAMPLES, ~U(0))
    for k in range(0, len(s), 512):
        out = np.minimum(out, (_A * s[k:k + 512] + _B).min(axis=1))
    return out >> U(32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    h = mix(np.arange(BANDS, dtype=U) + U(77))
    for column in sig.reshape(BANDS, ROWS).T:
        h = mix(h * U(31) + column)
    return h.astype(np.int64)


def odd_sketch(sig: np.ndarray) -> bytes:
    """Parity bitmap: each (number, sample) flips one bit."""
    at = mix(sig ^ _NUMBERS) % U(SKETCH_BITS)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=SKETCH_BITS).astype(np.uint8) & 1).tobytes()


def estimate(differing):
    """Similarity from the number of bits in which two sketches differ."""
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * np.asarray(differing) / SKETCH_BITS, 1e-9))


#: The most differing bits that a candidate may have.
MOST_DIFFERING = int(np.flatnonzero(estimate(np.arange(SKETCH_BITS // 2)) >= SKETCH_LEAST).max())


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def compare_blocks(key, rows) -> list[tuple[int, int]]:
    """Confirmed links across components, of one pair of blocks (i, j) of a bucket.
    Rows: key, i, j, block, node, label, sketch, shingles.  Links that close
    what earlier ones have joined are left out."""
    _, i, j = key
    rows = sorted(rows, key=lambda r: (r[3], r[4]))
    node, label = [r[4] for r in rows], [r[5] for r in rows]
    if len(set(label)) < 2:
        return []
    sketch = np.array([np.frombuffer(r[6], U) for r in rows])
    sets = [np.frombuffer(r[7], U) for r in rows]
    size = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(size)])
    left = sum(r[3] == i for r in rows) if i != j else len(rows)
    names, comp = np.unique(label, return_inverse=True)
    mark, out = np.zeros(int(ids.max()) + 1, bool), []
    for a in range(left):
        b0 = left if i != j else a + 1
        other = np.flatnonzero(comp[b0:] != comp[a]) + b0
        if not len(other):
            continue
        near = np.bitwise_count(sketch[other] ^ sketch[a]).sum(axis=1) <= MOST_DIFFERING
        near &= 100 * np.minimum(size[other], size[a]) >= PERCENT * np.maximum(size[other], size[a])
        other = other[near]
        if not len(other):
            continue
        own = ids[starts[a]:starts[a + 1]]
        mark[own] = True
        for b in other:
            if comp[b] != comp[a]:
                both = int(np.count_nonzero(mark[ids[starts[b]:starts[b + 1]]]))
                if 100 * both >= PERCENT * (size[a] + size[b] - both):
                    out.append((node[a], node[b]))
                    comp[comp == comp[b]] = comp[a]
        mark[own] = False
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component (null: no words), component_id for every row."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                      text_of(text_col).alias("text"))

    def sketches():
        memo = WordHashes()

        def one(i, h, text):
            s = shingles(text, memo)
            if not len(s):
                return i, h, 0, None, None, None
            sig = signature(s)
            return i, h, len(s), xxhash.xxh3_128_digest(s.tobytes()), band_keys(sig).tolist(), odd_sketch(sig)

        return one

    rows = stored(map_rows(src, sketches, "doc_id long, text_hash long, n_shingles long, digest binary, "
                                          "bands array<bigint>, sketch binary"), "near-rows")
    nodes = stored(rows.where("digest is not null").groupBy("digest").agg(
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n"),
        F.min(F.struct("doc_id", "text_hash")).alias("sample")).withColumn("node", F.monotonically_increasing_id()), "near-nodes")

    banded = nodes.select("node", F.explode("bands").alias("key"))
    hubs = banded.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    # Spark takes an exploded array for one row, so it would broadcast this many times over its bound
    buckets = stored(banded.join(hubs.hint("merge"), "key"), "near-buckets")

    # the full sets of the nodes in such buckets, again from the texts
    involved = buckets.select("node").distinct().join(nodes, "node").select(
        "node", "sketch", F.col("sample.doc_id").alias("i"), F.col("sample.text_hash").alias("h"))
    texts = src.join(involved, same(F.col("doc_id"), F.col("i")) & (F.col("text_hash") == F.col("h")))

    def full_sets():
        memo = WordHashes()
        return lambda node, sketch, text: (node, sketch, shingles(text, memo).tobytes())

    sets = map_rows(texts.select("node", "sketch", "text"), full_sets, "node long, sketch binary, shingles binary")
    sets = stored(sets.dropDuplicates(["node"]), "near-sets")

    # each member against its bucket's smallest
    stars = buckets.where("node != hub").select("node", "hub").distinct()
    pairs = stars.join(sets, "node").select("hub", F.col("node").alias("a"), F.col("sketch").alias("x"), F.col("shingles").alias("p")) \
        .join(sets, F.col("hub") == F.col("node")).select("a", "hub", "x", F.col("sketch").alias("y"), "p", F.col("shingles").alias("q"))

    def confirm():
        def one(a, b, x, y, p, q):
            differing = int(np.bitwise_count(np.frombuffer(x, U) ^ np.frombuffer(y, U)).sum())
            return a, b, differing <= MOST_DIFFERING and linked(np.frombuffer(p, U), np.frombuffer(q, U))
        return one

    labels = components(map_rows(pairs, confirm, "a long, b long, ok boolean").where("ok").select("a", "b"), "near-stars")

    # across the components that a bucket still holds
    member = buckets.select("key", "node").join(labels, "node", "left").join(nodes.select("node", "n"), "node") \
        .select("key", "node", "n", F.coalesce("label", "node").alias("label"))
    mixed = member.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("members"),
                                      F.sum("n").alias("total")).where("low < high")
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    dealt = member.join(mixed.select("key", blocks.alias("blocks")), "key") \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "label") \
        .join(sets, "node").select("key", "i", "j", "block", "node", "label", "sketch", "shingles")
    across = flat_map_groups(dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"), ["key", "i", "j"],
                             lambda: compare_blocks, "a long, b long")
    joined = across.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left") \
        .join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left") \
        .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    merged = components(joined, "near-across").select(F.col("node").alias("label"), F.col("label").alias("final"))

    placed = stored(rows.join(nodes.select("digest", "node"), "digest", "left").join(labels, "node", "left")
                    .withColumn("label", F.coalesce("label", "node")).join(merged, "label", "left")
                    .select("doc_id", "text_hash", "n_shingles", F.coalesce("final", "label").alias("component")), "near-placed")
    smallest = placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    return placed.join(smallest, "component", "left").select(
        "doc_id", "text_hash", "n_shingles", "component", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near duplicates, with the rows' own columns
    only: that of the smallest doc_id (null last), of rows that repeat it the
    first by text hash, of rows that repeat both any one.  Rows without words
    stay, but for repeats of doc_id and text."""
    found = near_duplicates(docs, id_col, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    stay = found.where("component is not null").groupBy("component").agg(F.min(place).alias("p")).select("p.doc_id", "p.text_hash") \
        .unionByName(found.where("component is null").select("doc_id", "text_hash").distinct())
    key = ["__none", "__id", "__hash"]
    stay = stay.select(F.col("doc_id").isNull().alias("__none"), F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("text_hash").alias("__hash"))
    keyed = docs.withColumns({"__none": F.col(id_col).isNull(), "__id": F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
                              "__hash": F.xxhash64(text_of(text_col))})
    return keyed.join(stay, key, "left_semi").withColumn("__n", F.row_number().over(W.partitionBy(*key).orderBy(F.lit(0)))) \
        .where("__n = 1").drop(*key, "__n")


@register("op2_near_dedup")
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))

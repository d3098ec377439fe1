"""Mixing sources to target weights by a splitting tree.

Each source's documents are put in a seeded random order and laid end to end,
as often as its target needs; the line is cut into blocks of ``BLOCK_WORDS``
words.  A source's quota is its number of blocks.  A binary tree over the
output shards splits the vector of quotas: each node draws the left half's
blocks by one multivariate hypergeometric draw, seeded by the node, so the
shards hold what a full shuffle of all blocks would give, yet any task can
derive its own shards' share.  A shard's share of a source is a range of
positions in a seeded permutation of that source's blocks, so the draws are
disjoint.  Rows are then shuffled within their shard.

Sources by code point, null last, weigh ``WEIGHTS`` in turn and share the
whole size; no target exceeds ``MOST`` times its source, and what is over is
shared by weight among the others.  A document is taken whole: as often as the
target holds the source, and once more, along the random order, if it fits what
is left then; when none fits, one further document, the closest in size, fills
the last gap.

A document's size is its number of words (null or empty text: 0; such
documents are never taken).  Rows that repeat doc_id, source and text are
taken alike.  Null doc_ids and sources are values like others.  An empty table
gives no rows.  The table of sources stays in Spark, whatever their number:
beyond ``GROUPS`` sources, several are laid end to end and drawn from as one,
and beyond ``FEW_SOURCES`` only those with most rows are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import documents, same, stored, text_of
from tessera.llm.registry import register

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 1 << 12
SHARD_WORDS = 1 << 20
#: Blocks of all sources, at most: beyond, blocks grow (the draws need fewer than 10**9).
MOST_BLOCKS = 1 << 28
#: Ranges of the random order in which a source's running sums are taken.
RANGES = 1 << 12
#: Sources whose tables of a row a source are broadcast, so no task gets all rows of one.  Of more
#: sources, those with over 1 / FEW_SOURCES of the rows are; the others' rows are dealt by source.
FEW_SOURCES = 100_000
#: Vectors of the splitting tree are as long, at most.
GROUPS = 1 << 12
SEED = 20


def target_sizes(sizes: list[int], weights: list[int], most: int = MOST) -> list[Fraction]:
    """Shares of the total by weight, none above ``most`` times its size."""
    out, left, open_ = [Fraction(0)] * len(sizes), Fraction(sum(sizes)), list(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        for i in full or open_:
            out[i] = Fraction(most * sizes[i]) if full else unit * weights[i]
            left -= out[i]
        if not full:
            break
        open_ = [i for i in open_ if i not in set(full)]
    return out


def split(quota: tuple[int, ...], shards: int, seed: int):
    """``share(shard) -> [(offset, count)]`` by source: the shard's range in
    each source's permuted blocks."""
    total = sum(quota)
    edge = lambda shard: shard * total // shards  # blocks before a shard

    @lru_cache(4096)
    def left_half(low: int, high: int, held: tuple[int, ...]) -> tuple[int, ...]:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        drawn = rng.multivariate_hypergeometric(held, edge(middle) - edge(low), method="marginals")
        return tuple(int(x) for x in drawn)

    def share(shard: int) -> list[tuple[int, int]]:
        low, high, held, offset = 0, shards, quota, [0] * len(quota)
        while high - low > 1:
            middle, left = (low + high) // 2, left_half(low, high, held)
            if shard < middle:
                high, held = middle, left
            else:
                low, offset = middle, [o + x for o, x in zip(offset, left)]
                held = tuple(h - x for h, x in zip(held, left))
        return list(zip(offset, held))

    return share


def permute(block: np.ndarray, size: int, seed: int, source: int) -> np.ndarray:
    """A seeded permutation of range(size): a Feistel network over the next
    even power of two, walked until inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = np.random.default_rng([seed, source]).integers(0, 1 << 62, 4).astype(np.uint64)
    x, out = block.astype(np.uint64), np.zeros(len(block), np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        a, b = x >> np.uint64(half), x & low
        for k in keys:
            h = (b + k) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ ((h >> np.uint64(32)) & low)
        x = (a << np.uint64(half)) | b
        inside = x < np.uint64(size)
        out[todo[inside]] = x[inside]
        todo, x = todo[~inside], x[~inside]
    return out.astype(np.int64)


def source_table(sizes: DataFrame, most: int = MOST) -> tuple[DataFrame, int, int]:
    """(source, at, source_size, target, whole, rest, hot), rows, words.  ``at``
    counts the sources by code point, null last.  ``whole`` and ``rest``: the
    target as whole rounds of the source and what is left; as ``target_sizes``,
    from sums a round.  ``hot``: to be broadcast."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows"))
    x = stored(by_source.orderBy(F.col("source").asc_nulls_last()).withColumn("id", F.monotonically_increasing_id())
               .withColumn("part", F.shiftright("id", 33)), "mix-sources")
    parts = x.groupBy("part").agg(F.count(F.lit(1)).alias("m")) \
        .select("part", F.coalesce(F.sum("m").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    x = x.join(F.broadcast(parts), "part").withColumn("at", F.col("before") + F.col("id").bitwiseAND((1 << 33) - 1))
    weight = F.array(*map(F.lit, WEIGHTS))[F.pmod("at", F.lit(len(WEIGHTS))).cast("int")]
    x = stored(x.select("source", "at", "n", "rows", weight.alias("weight")), "mix-sources")
    all_ = x.agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.sum("weight").alias("weight")).first()
    total, unit, full = all_["n"] or 0, Fraction(0), F.lit(False)
    closed = 0
    while all_["sources"]:
        got = x.where(full).agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
        open_ = all_["weight"] - (got["weight"] or 0)
        if not open_ or closed and got["sources"] == closed:
            break
        closed, unit = got["sources"], Fraction(total - most * (got["n"] or 0)) / open_
        # unit * weight > most * n, in whole numbers; the share a weight grows, so what was full stays so
        full = F.lit(False)
        for w in sorted(set(WEIGHTS)):
            full = full | (F.col("weight") == w) & (F.col("n") < F.lit(-(-unit * w // most)).cast("long"))
        if not closed and x.where(full).isEmpty():
            break
    share = lambda f: F.element_at(F.create_map(*[y for w in sorted(set(WEIGHTS)) for y in (F.lit(w), f(unit * w))]), F.col("weight"))
    down = share(lambda t: F.lit(int(t // 1)).cast("long"))
    some = (F.col("n") > 0) & ~full
    x = x.select("source", "at", F.col("n").alias("source_size"),
                 F.when(full, (F.col("n") * most).cast("double")).otherwise(share(lambda t: F.lit(float(t)))).alias("target"),
                 F.when(full & (F.col("n") > 0), most).when(some, F.floor((down - down % F.col("n")) / F.col("n"))).otherwise(0).cast("int").alias("whole"),
                 F.when(some, down % F.col("n") + share(lambda t: F.lit(float(t % 1)))).otherwise(0.0).alias("rest"),
                 (F.lit(all_["sources"] <= FEW_SOURCES) | (F.col("rows") * FEW_SOURCES > (all_["rows"] or 0))).alias("hot"))
    return stored(x, "mix-sources"), all_["sources"], total


def by_source(df: DataFrame, table: DataFrame, few: bool) -> DataFrame:
    """Inner join on ``at``; both have ``hot``, kept once; of ``few`` sources all are."""
    if few:
        return df.join(F.broadcast(table.drop("hot")), "at")
    return df.where("hot").join(F.broadcast(table.where("hot").drop("hot")), "at") \
        .unionByName(df.where("not hot").join(table.where("not hot").drop("hot"), "at"))


def fill(laid: DataFrame, few: bool) -> DataFrame:
    """unit, fill_start: what the last round takes beyond the first unit that
    overruns ``rest``.  Along the order every unit that fits what is left is
    taken, as one pass over the units would; a stored round here goes up to the
    next unit that overruns.  Then the closest unit is added if that brings the
    source nearer to its target."""
    gap = F.col("rest") - F.col("reached")
    state = laid.groupBy("at", "rest", "hot").agg(F.coalesce(F.max(F.when(F.col("end") <= F.col("rest"), F.col("end"))), F.lit(0)).alias("reached"),
                                           F.first("rest").alias("passed"))
    state, left, filled = stored(state, "mix-state"), laid, []
    while True:
        # what was passed over overran a larger gap, so it stays out
        left = stored(by_source(left, state.drop("rest"), few).where((F.col("end") > F.col("passed")) & (F.col("words") <= gap))
                      .drop("reached", "passed"), "mix-left")
        if left.isEmpty():
            break
        ranges = left.groupBy("at", "range", "hot").agg(F.sum("words").alias("n")) \
            .select("at", "range", "hot", F.coalesce(F.sum("n").over(W.partitionBy("at").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
        ranges = by_source(ranges, state, few).where(F.col("before") < gap).select("at", "range", "before", "reached")
        upto = F.col("before") + F.sum("words").over(W.partitionBy("at", "range").orderBy("end").rowsBetween(W.unboundedPreceding, 0))
        took = stored(left.join(ranges, ["at", "range"]).withColumn("upto", upto).where(F.col("upto") <= gap)
                      .select("at", "unit", "words", "end", (F.col("reached") + F.col("upto") - F.col("words")).alias("fill_start")), "mix-took")
        filled.append(took.select("unit", "fill_start"))
        sums = took.groupBy("at").agg(F.sum("words").alias("n"), F.max("end").alias("last"))
        state = stored(state.join(sums, "at", "left").select(
            "at", "rest", "hot", (F.col("reached") + F.coalesce("n", F.lit(0))).alias("reached"), F.coalesce(F.col("last").cast("double"), F.col("passed")).alias("passed")), "mix-state")
    rest = by_source(laid, state.drop("rest"), few).where((F.col("end") > F.col("rest")) & (F.col("words") < 2 * gap))
    for took in filled:
        rest = rest.join(took.select("unit"), "unit", "left_anti")
    closest = rest.groupBy("at").agg(F.min(F.struct(F.abs(F.col("words") - gap).alias("off"), "order", "doc_id", "text_hash", "unit", "reached")).alias("best")) \
        .select(F.col("best.unit").alias("unit"), F.col("best.reached").alias("fill_start"))
    for took in filled:
        closest = closest.unionByName(took)
    return stored(closest, "mix-filled")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, mixed).  documents: doc_id, source, text_hash, size,
    source_size, target and unit for every row.  mixed: shard, position, unit,
    doc_id, source, text_hash, size for each time a unit (rows that repeat
    doc_id, source and text) is taken."""
    spark = docs.sparkSession
    rows = stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.xxhash64(text_of(text_col)).alias("text_hash"),
        F.regexp_count(text_of(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size")), "mix-rows")
    sources, n_sources, total = source_table(rows)
    width = max(block_words, -(-total // MOST_BLOCKS), 1)
    shards = max(1, -(-total // shard_words))

    known = sources.withColumnRenamed("source", "name")
    named = same(F.col("source"), F.col("name"))
    hot = F.broadcast(known.where("hot"))
    units = rows.groupBy("doc_id", "source", "text_hash", "size").agg(F.count(F.lit(1)).alias("times")) \
        .transform(lambda u: u.join(hot, named) if n_sources <= FEW_SOURCES else
                   u.join(hot, named).unionByName(u.join(hot, named, "left_anti").join(known.where("not hot"), named))).drop("name") \
        .withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "text_hash")) \
        .withColumn("range", F.shiftrightunsigned("order", 64 - (RANGES.bit_length() - 1))) \
        .withColumn("unit", F.monotonically_increasing_id())
    units = stored(units, "mix-units")

    # words before each unit in its source's random order: within its range, plus the ranges before
    in_order = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    words = F.col("size") * F.col("times")
    ranges = units.groupBy("at", "range").agg(F.sum(words).alias("n")) \
        .select("at", "range", F.coalesce(F.sum("n").over(in_order("at").orderBy("range")), F.lit(0)).alias("range_start"))
    inside = in_order("at", "range").orderBy("order", "doc_id", "text_hash", "size")
    laid = units.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0))) \
        .join(ranges, ["at", "range"]).withColumn("start", F.col("range_start") + F.col("inside")).where("size > 0")
    laid = stored(laid.withColumn("end", F.col("start") + words), "mix-laid")
    filled = fill(laid.select("at", "hot", "range", "order", "doc_id", "text_hash", "unit", "end", "rest", words.alias("words")), n_sources <= FEW_SOURCES)
    more = ((F.col("end") <= F.col("rest")) | F.col("fill_start").isNotNull()).cast("int")
    # the last round's documents beyond the first that overran lie where they fill the line
    begin = F.when(F.col("copy") == F.col("whole"), F.coalesce("fill_start", "start")).otherwise(F.col("start"))
    copies = laid.join(filled, "unit", "left").withColumn("times_taken", F.col("whole") + more).where("times_taken > 0") \
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("times_taken") - 1))) \
        .withColumn("place", F.col("copy") * F.col("source_size") + begin)
    copies = stored(copies.select("unit", "doc_id", "source", "text_hash", "size", "at", "hot", "copy", "place"), "mix-copies")
    # the draws are from groups of sources laid end to end, mostly of one
    copies = copies.withColumn("group", F.pmod("at", F.lit(GROUPS)).cast("int"))
    if n_sources > GROUPS:
        first = copies.groupBy("group", "at", "hot").agg((F.max("place") + 1).alias("span")) \
            .select("at", "hot", (F.sum("span").over(W.partitionBy("group").orderBy("at")) - F.col("span")).alias("first"))
        copies = by_source(copies, stored(first, "mix-first"), n_sources <= FEW_SOURCES).withColumn("place", F.col("first") + F.col("place")).drop("first")
    copies = copies.withColumn("block", F.floor(F.col("place") / width)).drop("place", "hot", "at")
    last = {r["group"]: r["n"] for r in copies.groupBy("group").agg((F.max("block") + 1).alias("n")).collect()}
    quota = tuple(int(last.get(k, 0)) for k in range(min(n_sources, GROUPS)))
    shards = min(shards, max(1, sum(quota)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, block = b.column("group").to_numpy(), b.column("block").to_numpy()
            out = np.zeros(len(block), np.int64)
            for s in np.unique(at):
                out[at == s] = permute(block[at == s], quota[s], seed, int(s))
            yield b.append_column("drawn", pa.array(out))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = split(quota, shards, seed)
        for b in batches:
            got = [(shard, s, o, o + n) for shard in b.column(0).to_pylist() for s, (o, n) in enumerate(share(shard)) if n]
            cols = list(zip(*got)) if got else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                             names=["shard", "group", "low", "high"])

    placed = copies.mapInArrow(place, T.StructType([*copies.schema, T.StructField("drawn", T.LongType())]))
    drawn = spark.range(shards).mapInArrow(shares, "shard long, group int, low long, high long") \
        .select("shard", "group", F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("drawn"))
    local = W.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "doc_id", "text_hash", "copy"), "doc_id", "text_hash", "copy")
    # Spark takes ``drawn``, a row a block, for a row a shard, so it would broadcast it at any size
    mixed = placed.join(drawn.hint("merge"), ["group", "drawn"]).withColumn("position", F.row_number().over(local) - 1) \
        .select("shard", "position", "unit", "doc_id", "source", "text_hash", "size")
    by_unit = units.select("unit", F.col("doc_id").alias("i"), F.col("source").alias("s"), F.col("text_hash").alias("h"), "source_size", "target")
    told = rows.join(by_unit, same(F.col("doc_id"), F.col("i")) & same(F.col("source"), F.col("s")) & (F.col("text_hash") == F.col("h"))) \
        .drop("i", "s", "h")
    return told, mixed


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own
    columns only.  (Where the order matters, ``mix`` gives shard and position.)"""
    _, mixed = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    taken = mixed.groupBy("unit").agg(F.first("doc_id").alias("__i"), F.first("source").alias("__s"), F.first("text_hash").alias("__h"),
                                      F.count(F.lit(1)).cast("int").alias("__n")).drop("unit")
    rows = docs.join(taken, same(F.col(id_col).cast("long"), F.col("__i")) & same(F.col(source_col).cast("string"), F.col("__s"))
                     & (F.xxhash64(text_of(text_col)) == F.col("__h")))
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).drop("__i", "__s", "__h", "__n", "__copy")


@register("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    told, mixed = mix(documents(spark, sf_dir))
    taken = mixed.groupBy("unit").agg(F.sum("size").alias("taken"))
    return told.join(taken, "unit", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))

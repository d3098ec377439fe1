"""Benchmark decontamination by winnowing.

A text's words are its maximal runs of letters, digits and non-ASCII
characters, ASCII lower-cased.  Of every ``WINDOW - GRAM + 1`` neighbouring
``GRAM``-word hashes the smallest is kept, so any span of ``WINDOW`` words that
a document shares with an item holds a fingerprint kept on both sides.  Equal
fingerprints are joined and extended word by word, with the ten words around
them at hand; an extension of ``WINDOW`` words or more is a hit, one that is
shorter is dropped.  Items of fewer words than the window are matched whole,
by the hash of all their words.

An extension that long holds one of the windows around the gram, at the same
place on both sides.  So a fingerprint carries the hashes of these windows, and
two meet only by one of them (by the first on which they agree): of a gram that
is common in documents and benchmark, such as a set phrase, copies with other
neighbours are never paired.

Documents send only fingerprints that pass a bitmap of the benchmark's (of
fixed size, however large the benchmark) and so almost none when clean.

Null, empty or wordless texts have no words, hits or items.  Rows of the
benchmark with null item_id count towards hits but name no item; an item_id
that is listed twice is one item.  Rows that repeat a document are judged one
by one.  An empty benchmark leaves every document clean.  Only the id and text
columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, map_rows, stored, text_of
from tessera.llm.registry import register
from tessera.llm.shingling import MULTIPLIERS, WordHashes, mix, ngrams

WINDOW = 10
GRAM = 5
#: Bits of the bitmap of benchmark fingerprints (2 MB).
BITS = 1 << 24
#: Bytes of the benchmark's fingerprints, a row a window, up to which they are broadcast.
MOST_BROADCAST = 1 << 25

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PRINTS = "array<struct<h:bigint,size:int,at:int,start:int,words:array<string>,near:array<bigint>>>"


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def winnow(grams: np.ndarray, span: int) -> np.ndarray:
    """Positions that hold the least hash of some ``span`` neighbours (ties: all)."""
    if len(grams) < span:
        return np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(grams, span).min(axis=1)
    kept = np.zeros(len(grams), bool)
    for d in range(span):
        kept[d:d + len(least)] |= grams[d:d + len(least)] == least
    return np.flatnonzero(kept)


def _fingerprint(words: list[bytes], at: int, h: np.uint64, size: int, around: int, near: list[int | None] | None = None) -> dict:
    a, b = max(0, at - around), min(len(words), at + size + around)
    h = int(h.astype(np.int64))
    return {"h": h, "size": size, "at": at, "start": a, "words": [w.decode() for w in words[a:b]], "near": [h] if near is None else near}


def windows_around(grams: np.ndarray, at: np.ndarray, span: int) -> list[list[int | None]]:
    """For each gram of ``at``, the hashes of the windows of ``span`` grams that
    hold it, by its place in them (from 0; None beyond the text)."""
    start = at[:, None] - np.arange(span)
    inside = (start >= 0) & (start + span <= len(grams))
    start = np.where(inside, start, 0)
    both = mix(grams[start] * MULTIPLIERS[0] + grams[np.where(inside, start + span - 1, 0)] * MULTIPLIERS[1]).view(np.int64)
    return [[h if ok else None for h, ok in zip(*row)] for row in zip(both.tolist(), inside.tolist())]


def fingerprints(words: list[bytes], memo: WordHashes, sizes: list[int] | None = None, passes=None,
                 window: int = WINDOW, gram: int = GRAM) -> list[dict]:
    """Winnowed fingerprints and, of each of ``sizes`` (short items' lengths),
    every n-gram; ``passes(hashes)`` masks those worth sending.  An item
    (``sizes`` None) of fewer words than the window has one, of all its words."""
    hashes, out = memo.of(words), []
    if sizes is None and len(words) < window:
        h = ngrams(hashes, len(words))
        return [_fingerprint(words, 0, h[0], len(words), 0)] if len(words) else []
    if len(words) >= window:
        grams = ngrams(hashes, gram)
        kept = winnow(grams, window - gram + 1)
        kept = kept if passes is None else kept[passes(grams[kept])]
        near = windows_around(grams, kept, window - gram + 1)
        out += [_fingerprint(words, int(i), grams[i], gram, window - gram, x) for i, x in zip(kept, near)]
    for n in sizes or ():
        grams = ngrams(hashes, n)
        kept = np.arange(len(grams)) if passes is None else np.flatnonzero(passes(grams))
        out += [_fingerprint(words, int(i), grams[i], n, 0) for i in kept]
    return out


def shared_stretch(a: list[str], i: int, b: list[str], j: int, size: int, window: int = WINDOW) -> tuple[int, int] | None:
    """How far the equal spans at ``a[i:i+size]`` and ``b[j:j+size]`` extend
    (words before, words after), or None if they differ or the whole is short.
    Whole short items come with no words around them."""
    if a[i:i + size] != b[j:j + size]:
        return None
    left = 0
    while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
        left += 1
    right = 0
    while i + size + right < len(a) and j + size + right < len(b) and a[i + size + right] == b[j + size + right]:
        right += 1
    return (left, right) if left + size + right >= window or len(b) == size else None


def benchmark_index(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, list[int], np.ndarray]:
    """Distinct fingerprints with their surroundings (ctx), the items of each,
    the lengths (under the window) of short items, and the bitmap."""
    def make():
        memo = WordHashes()
        return lambda i, text: (i, fingerprints(words_of(text), memo))

    src = benchmark.select(F.col(id_col).cast("string").alias("item"), text_of(text_col).alias("text"))
    prints = map_rows(src, make, f"item string, prints {_PRINTS}")
    prints = stored(prints.select("item", F.explode("prints").alias("p"))
                    .select("item", "p.h", "p.size", (F.col("p.at") - F.col("p.start")).alias("inner"), "p.words", "p.near"), "benchmark-prints")
    key = ["h", "size", "inner", "words"]  # ``near`` follows from these
    contexts = stored(prints.select(*key, "near").distinct().withColumn("ctx", F.monotonically_increasing_id()), "benchmark-contexts")
    members = prints.drop("near").join(contexts.hint("merge"), key).select("ctx", "item").where(F.col("item").isNotNull()).distinct()
    # a short item's fingerprint has no words around it: its size is that of its words
    short = [r[0] for r in prints.where(F.size("words") < WINDOW).where(F.size("words") == F.col("size")).select("size").distinct().collect()]
    bit = F.pmod("h", F.lit(BITS)).cast("long")
    cells = prints.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect()
    bitmap = np.zeros(BITS >> 6, np.uint64)
    for r in cells:
        bitmap[r["cell"]] = r["bits"] & 0xFFFFFFFFFFFFFFFF
    return contexts, members, sorted(short), bitmap


def meeting(sent: DataFrame, contexts: DataFrame) -> DataFrame:
    """Pairs of document and benchmark fingerprints that agree on a window
    around them, each once.  The benchmark's are broadcast by their measured size:
    Spark's own goes by the packed file and a row a fingerprint, not a window."""
    row = F.lit(128) + 8 * F.size("near") + 16 * F.size("words") + F.octet_length(F.array_join("words", ""))
    size = contexts.agg(F.sum(F.size("near") * row.cast("long"))).first()[0] or 0
    a = sent.select("row", "h", "size", "at", "start", F.col("words").alias("a"), F.col("near").alias("a_near"), F.posexplode("near").alias("turn", "window"))
    b = contexts.select("ctx", "h", "size", "inner", F.col("words").alias("b"), F.col("near").alias("b_near"), F.posexplode("near").alias("turn", "window"))
    first = F.array_position(F.zip_with("a_near", "b_near", lambda x, y: x == y), True) - 1
    b = b.where("window is not null").hint("broadcast" if size <= MOST_BROADCAST else "merge")
    return a.where("window is not null").join(b, ["h", "size", "turn", "window"]).where(first == F.col("turn")) \
        .select("row", "ctx", "size", "at", "start", "inner", "a", "b")


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_words, spans (array of start, stop: hit words,
    merged), items (ids as strings, sorted) for every row."""
    contexts, members, sizes, bitmap = benchmark_index(benchmark, item_col, item_text_col)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def make():
        memo, bits = WordHashes(), shared.value

        def passes(h: np.ndarray) -> np.ndarray:
            at = h & np.uint64(BITS - 1)
            return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0

        def one(i, digest, text):
            words = words_of(text)
            return i, digest, len(words), fingerprints(words, memo, sizes, passes)

        return one

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(text_of(text_col), 256).alias("text_hash"), text_of(text_col).alias("text"))
    rows = map_rows(src, make, f"doc_id long, text_hash string, n_words long, prints {_PRINTS}")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "document-prints")

    pairs = meeting(rows.select("row", F.explode("prints").alias("p")).select("row", "p.*"), contexts)

    def extend():
        def one(row, ctx, size, at, start, inner, a, b):
            more = shared_stretch(a, at - start, b, inner, size)
            return (row, ctx, at - more[0], at + size + more[1]) if more else (row, None, None, None)
        return one

    hits = stored(map_rows(pairs, extend, "row long, ctx long, start int, stop int").where(F.col("ctx").isNotNull()), "contamination")
    merged = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("found")) \
        .withColumn("spans", F.aggregate(
            "found", F.expr("cast(array() as array<struct<start:int,stop:int>>)"),
            lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= s["start"]),
                                  F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                      F.element_at(acc, -1)["start"].alias("start"),
                                      F.greatest(F.element_at(acc, -1)["stop"], s["stop"]).alias("stop")))))
            .otherwise(F.concat(acc, F.array(s))))).select("row", "spans")
    items = hits.select("row", "ctx").distinct().join(members, "ctx").groupBy("row") \
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    return rows.select("row", "doc_id", "text_hash", "n_words").join(merged, "row", "left").join(items, "row", "left").select(
        "doc_id", "text_hash", "n_words", F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,stop:int>>)")).alias("spans"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **cols) -> DataFrame:
    """The rows without any hit, with their own columns only.  The verdict
    depends on the text alone, so rows are matched by its digest."""
    found = find_contamination(docs, benchmark, text_col=text_col, **cols).where(F.size("spans") > 0)
    bad = found.select(F.col("text_hash").alias("__bad_text")).distinct()
    return docs.join(bad, F.sha2(text_of(text_col), 256) == F.col("__bad_text"), "left_anti")


@register("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]).cast("long"))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))

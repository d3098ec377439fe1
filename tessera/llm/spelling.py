"""Spelling variants by k-d trees over letter-count vectors.

Two words one edit apart have letter counts that differ by one letter more (an
insertion), one less (a deletion) or one of each (a replacement): an L1
distance of two at most.  Words of one length are the points of a k-d tree
over their counts; each word searches the tree of its own length for
replacements, and the tree of the next length for insertions, which are the
deletions seen from there.  A box of points is pruned when it needs more than
one letter more, or one less, to reach (none less for the next length).
Candidates are verified letter by letter.

The tree's upper levels cut the words into leaves, one task's work each; a word
goes to the leaves that its search reaches.  Cuts are taken from a bounded
sample (``SAMPLE`` words): they say how evenly leaves are filled, never
what is found.  A leaf with more words than ``LEAF_MOST`` is dealt by hash into
blocks, which the searches of that leaf all visit.  Below, the tree goes on in
numpy, with the tight box of each node, for all searches of the leaf together.
Leaves give, for each word, its number of near words and the best of them.

Counts are of the letters a to z and of a few classes of accented letters: an
edit changes the counts of classes by as much or less.

Null texts have no words; a null doc_id is named by nothing in the hash.
Repeated rows count like any other.  Runs of any length are words.  An empty
table gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import arrow_schema, documents, small_batches, stored, text_of
from tessera.llm.registry import register

MIN_CHARS, MIN_COUNT = 7, 2
#: A word's form occurs at least so many times as often.
RATIO = 10
#: Words that the cuts of the upper levels are taken from.
SAMPLE = 50_000
#: Words that a leaf is meant to hold, and those beyond which it is dealt into blocks.
LEAF, LEAF_MOST = 1 << 14, 1 << 16
#: Points of a node that is searched one by one; searches of a leaf taken together.
BUCKET, TOGETHER = 48, 1 << 15
#: Distinct words that a task counts before it hands them on.
HELD = 1 << 18

#: Letters are the bytes of Latin-1; all others end a run.
_LETTERS = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]
_FOLD = bytes((c + 32 if c < 0x5B else c) if c in _LETTERS else 32 for c in range(256))
#: Dimensions: a to z, then classes of accented letters.
ACCENTED = 6
DIMENSIONS = 26 + ACCENTED
_DIMENSION = np.array([c - 97 if 97 <= c < 123 else 26 + c % ACCENTED for c in range(256)])


# ------------------------------------------------------------------------- words
def _runs(text: str) -> list[bytes]:
    """The runs of letters, A-Z lower-cased, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_FOLD).split()


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def damaged_counts(docs: DataFrame, every: int = 31, least: int = MIN_CHARS) -> DataFrame:
    """(word, n) partial counts: runs of whole texts after the contract's damage."""
    schema = T.StructType.fromDDL("word string, n long")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, total = arrow_schema(schema), Counter()

        def batch() -> pa.RecordBatch:
            words = [w for w, n in total.items() if n]
            done = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], out[0].type),
                                               pa.array([total[w] for w in words], out[1].type)], schema=out)
            total.clear()
            return done

        for b in batches:
            for i, text in zip(*(c.to_pylist() for c in b.columns)):
                runs, start = _runs(text), zlib.crc32(b"%s:" % (b"" if i is None else b"%d" % i))
                hit = {w for w in set(runs) if zlib.crc32(_utf8(w), start) % every == 0}
                if hit:
                    kept = [w for w in runs if w not in hit and len(w) >= least]
                    for w, n in Counter(w for w in runs if w in hit).items():
                        at = zlib.crc32(_utf8(w), start) % len(w)
                        if len(w) > least:
                            total[w[:at] + w[at + 1:]] += n
                    total.update(kept)
                else:
                    total.update([w for w in runs if len(w) >= least])
                if len(total) >= HELD:
                    yield batch()
        yield batch()

    return docs.select(F.col("doc_id").cast("long"), text_of()).mapInArrow(run, schema)


# ----------------------------------------------------------------------- vectors
def letters(words: list[bytes]) -> np.ndarray:
    """The letters of words of one length, a row each."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    n, length = codes.shape
    at = np.arange(n)[:, None] * DIMENSIONS + _DIMENSION[codes]
    return np.bincount(at.ravel(), minlength=n * DIMENSIONS).reshape(n, DIMENSIONS).astype(np.int8 if length < 100 else np.int32)


def reach(low: np.ndarray, high: np.ndarray, x: np.ndarray, longer: bool) -> np.ndarray:
    """Which searches ``x`` may find points in the box from ``low`` to ``high``."""
    more = np.maximum(low - x, 0).sum(axis=1)
    less = np.maximum(x - high, 0).sum(axis=1)
    return (more <= 1) & (less <= (0 if longer else 1))


def cut(points: np.ndarray) -> tuple[int, int] | None:
    """(dimension, value): points of at most that value go left; None if all are alike."""
    spread = points.max(axis=0) - points.min(axis=0)
    if not spread.any():
        return None
    d = int(np.argmax(points.astype(np.float32).var(axis=0)))
    middle = int(np.median(points[:, d]))
    return d, middle if middle < points[:, d].max() else middle - 1


# ------------------------------------------------------------------ upper levels
def upper_tree(points: np.ndarray, share: float) -> list:
    """[[low, high]] boxes of the leaves, from a sample; one point stands for 1 / share words."""
    far = 1 << 30
    boxes = []

    def grow(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        at = cut(p) if len(p) / share > LEAF and len(p) >= 16 else None
        if at is None:
            boxes.append((low, high))
            return
        d, v = at
        left, up, down = p[:, d] <= v, high.copy(), low.copy()
        up[d], down[d] = v, v + 1
        grow(p[left], low, up)
        grow(p[~left], down, high)

    grow(points, np.full(DIMENSIONS, -far, np.int32), np.full(DIMENSIONS, far, np.int32))
    return boxes


def upper_trees(words: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Of each length that needs several leaves: the boxes (low, high)."""
    n = words.count()
    sample = words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE).collect() if n > LEAF else []
    by_length: dict[int, list[bytes]] = {}
    for r in sample:
        by_length.setdefault(len(r["word"]), []).append(r["word"].encode("latin-1"))
    trees = {length: upper_tree(vectors(letters(w)).astype(np.int32), len(sample) / n) for length, w in by_length.items()}
    return {k: (np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])) for k, boxes in trees.items() if len(boxes) > 1}


POINT, SAME, LONGER = 0, 1, 2


def _dealt(words: DataFrame) -> DataFrame:
    """(length, leaf, kind, word, n): each word as a point of its leaf, and as a
    search in each leaf that it may find near words in."""
    shared = words.sparkSession.sparkContext.broadcast(upper_trees(words))
    schema = T.StructType.fromDDL("length int, leaf int, kind int, word string, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, out = shared.value, arrow_schema(schema)
        for b in batches:
            by_length: dict[int, list] = {}
            for w, n in zip(*(c.to_pylist() for c in b.columns)):
                by_length.setdefault(len(w), []).append((w, n))
            done = [[] for _ in out]

            def send(length, leaf, kind, some):
                for column, values in zip(done, ([length] * len(some), [leaf] * len(some), [kind] * len(some), [w for w, _ in some], [n for _, n in some])):
                    column.extend(values)

            for length, some in by_length.items():
                x = vectors(letters([w.encode("latin-1") for w, _ in some])).astype(np.int32)
                for kind in (POINT, SAME, LONGER):
                    to = length + (kind == LONGER)
                    if to not in trees:
                        send(to, 0, kind, some)
                        continue
                    for leaf, (low, high) in enumerate(zip(*trees[to])):
                        there = ((x >= low) & (x <= high)).all(axis=1) if kind == POINT else reach(low, high, x, kind == LONGER)
                        send(to, leaf, kind, [some[k] for k in np.flatnonzero(there)])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(done, out)], schema=out)

    return words.select("word", "n").mapInArrow(run, schema)


# ------------------------------------------------------------------ inside a leaf
def tree(points: np.ndarray):
    """Nested (low, high, left, right) of row numbers; buckets are (low, high, rows, None)."""
    def grow(rows: np.ndarray):
        p = points[rows]
        low, high = p.min(axis=0), p.max(axis=0)
        at = cut(p) if len(rows) > BUCKET else None
        if at is None:
            return low, high, rows, None
        left = p[:, at[0]] <= at[1]
        return low, high, grow(rows[left]), grow(rows[~left])

    return grow(np.arange(len(points)))


def search(node, points: np.ndarray, x: np.ndarray, longer: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (rows of x, rows of points) whose counts are one edit apart, or might be."""
    stack = [(node, np.arange(len(x)))]
    while stack:
        (low, high, left, right), rows = stack.pop()
        rows = rows[reach(low, high, x[rows], longer)]
        if not len(rows):
            continue
        if right is not None:
            stack += [(left, rows), (right, rows)]
            continue
        step = max(1, (1 << 22) // (len(left) * DIMENSIONS))
        for k in range(0, len(rows), step):
            some = rows[k:k + step]
            apart = points[left][None, :, :] - x[some][:, None, :]
            near = np.abs(apart).sum(axis=2) <= (1 if longer else 2)
            i, j = np.nonzero(near)
            if len(i):
                yield some[i], left[j]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether b is a with one letter more: their common beginning and end cover a."""
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= a.shape[1]


class _Best:
    """For each of some words: how many near words, and the best: of the largest
    n, the smallest word."""

    def __init__(self, words: list[bytes]):
        self.words, self.found = words, {}

    def add(self, at: np.ndarray, n: np.ndarray, names: list[bytes]) -> None:
        found = self.found
        for i, m, w in zip(at.tolist(), n.tolist(), names):
            have = found.get(i)
            if have is None:
                found[i] = (1, m, w)
            elif m > have[1] or m == have[1] and w < have[2]:
                found[i] = (have[0] + 1, m, w)
            else:
                found[i] = (have[0] + 1, *have[1:])

    def rows(self) -> list[tuple[str, int, int, str]]:
        return [(self.words[i].decode("latin-1"), k, m, w.decode("latin-1")) for i, (k, m, w) in self.found.items()]


def near_words(dealt: DataFrame) -> DataFrame:
    """(word, near, best_n, best) partial results of the leaves' blocks, from
    rows (length, leaf, block, kind, word, n) partitioned and sorted by them."""
    schema = T.StructType.fromDDL("word string, near long, best_n long, best string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(schema)
        key, points, root, waiting, best = None, None, None, [], None

        def batch(rows) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out)], schema=out)

        def build():
            """The tree, once all points of a block have come."""
            nonlocal points, root, best, waiting
            words, n = [w for _, w, _ in waiting], np.array([n for _, _, n in waiting])
            codes = letters(words)
            points, best, waiting = (words, n, codes, vectors(codes)), _Best(words), []
            root = tree(points[3])

        def look(kind: int) -> list:
            """The waiting searches, all of one kind."""
            nonlocal waiting
            words, n = [w for _, w, _ in waiting], np.array([n for _, _, n in waiting])
            codes, waiting, own = letters(words), [], _Best(words)
            x, verify = vectors(codes), one_inserted if kind == LONGER else one_replaced
            for i, j in search(root, points[3].astype(x.dtype), x, kind == LONGER):
                ok = verify(codes[i], points[2][j])
                i, j = i[ok], j[ok]
                own.add(i, points[1][j], [points[0][k] for k in j])
                if kind == LONGER:
                    best.add(j, n[i], [words[k] for k in i])
            return own.rows()

        def turn() -> list:
            """Works off what waits: points become a tree, searches are run."""
            if not waiting:
                return []
            kind = waiting[0][0]
            if kind == POINT:
                build()
                return []
            if root is None:  # no points in this block
                waiting.clear()
                return []
            return look(kind)

        for b in batches:
            done = []
            for length, leaf, block, kind, w, n in zip(*(c.to_pylist() for c in b.columns)):
                if (length, leaf, block) != key:
                    done += turn()
                    if best:
                        done += best.rows()
                    key, points, root, best = (length, leaf, block), None, None, None
                elif waiting and (waiting[0][0] != kind or kind != POINT and len(waiting) >= TOGETHER):
                    done += turn()
                waiting.append((kind, w.encode("latin-1"), n))
            if done:
                yield batch(done)
        done = turn()
        yield batch(done + (best.rows() if best else []))

    return dealt.mapInArrow(run, schema)


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct (word, n); words are of
    the letters that Latin-1 has."""
    dealt = stored(_dealt(words), "spelling-dealt")
    blocks = dealt.where(F.col("kind") == POINT).groupBy("length", "leaf").agg(F.ceil(F.count(F.lit(1)) / LEAF_MOST).cast("int").alias("blocks"))
    several = dealt.join(blocks.where("blocks > 1"), ["length", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    to = F.when(F.col("kind") == POINT, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = several.withColumn("block", F.explode(to)).select("length", "leaf", "block", "kind", "word", "n")
    keys = ["length", "leaf", "block"]
    found = near_words(spread.repartition(*keys).sortWithinPartitions(*keys, "kind"))
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    near = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.minus") >= ratio * F.col("n"), F.struct(F.col("best.word").alias("form"), (-F.col("best.minus")).alias("form_n"))).alias("best"))
    rows = stored(rows.select("word", F.col("best.form").alias("form"), "n", "n_near", F.col("best.form_n").alias("form_n")), "spelling-forms")
    return _with_roots(rows)


def _with_roots(rows: DataFrame) -> DataFrame:
    """Follows forms to the last.  Each step multiplies n, so chains are short;
    a round doubles the way that is known."""
    links = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = stored(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                       "spelling-roots")
        if not links.where("moved").head(1):
            break
        links = links.drop("moved")
    return rows.join(links.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# ------------------------------------------------------------------------- query
@register("op13_spelling")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = damaged_counts(documents(spark, sf_dir)).groupBy("word").agg(F.sum("n").alias("n"))
    return spelling_variants(stored(counts.where(F.col("n") >= MIN_COUNT), "spelling-words"))

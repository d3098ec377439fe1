"""Near-duplicate lines by an exact set-similarity join.

A line's tokens are its distinct words (runs of non-space, ASCII lower-cased).
A later line goes if some earlier line, by (doc_id, line number), has a token
set of Jaccard similarity of at least 3/4, itself kept or not.  Equal sets are
one set, so only first occurrences are joined.

Tokens are ordered by rarity: their counts over all lines, in a table of
``CELLS`` hash cells whatever the vocabulary, then their hash.  Any such order
makes the prefix filter exact: similar sets share a token among the first few
of both.  Entries (token, set) of these prefixes meet by token; the length
filter, the shorter set's still shorter indexing prefix and the positional
bound on the overlap are applied while they meet.  A token so frequent that its list could
be long is dealt to pairs of blocks.

What meets must also pass a bound on the overlap from two 128-bit bitmaps of the
tokens, and is verified on the full sets in steps.  First each set meets, of
each list, the earlier one whose bitmap differs least; then, if that was an
unlikely match, all the others there, else the nearest few.  Only for sets that
both leave open are lists formed again.  Entries are sent many in a row, by
bucket of their list; full sets are read again only from lines that met.  So groups of many similar lines never emit their pairs.
Lists name a set by 64 bits: two sets of one name could hide a match, never
make one.

Null or empty texts have no lines with tokens; a line without tokens is never
removed nor matched.  Lines at the same number of rows that repeat a doc_id with
other texts come by the hash of their sets; rows that repeat both are the same
document and share their result.  Null doc_ids come first.  An empty table gives no rows.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import arrow_schema, documents, flat_map_groups, map_rows, same, small_batches, stored, text_of
from tessera.llm.registry import register
from tessera.llm.shingling import U, mix

CELLS = 1 << 20
#: Bits of the bitmap that tells which sets a pass must return (2 MB).
BITS = 1 << 24
#: Sets of a token's list in one block.
BLOCK = 1 << 15
#: Pairs of entries of one list compared at once (a longer list is compared alone).
PAIRS = 4_000_000
#: Sets that a task remembers having sent.
SEEN = 100_000
#: Bytes of text handled at once (a longer line is handled alone).
CHUNK = 1 << 18
#: Prefix entries that a task holds before it sends them, and about how many entries one bucket of lists gets.
HELD, BUCKET = 200_000, 50_000
#: Buckets while none would get over 8 times that.
BUCKETS = 4096

_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)
#: A-Z to a-z, and white space other than the line feed to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in (9, 11, 12, 13) else c for c in range(256))


def _by_line(line: np.ndarray, word: np.ndarray, lines: int) -> np.ndarray:
    """Order by line, then word: one sort of packed keys unless these are ambiguous."""
    if lines < 1 << 20:
        key = (line.astype(U) << U(44)) | (word >> U(20))
        order = np.argsort(key)
        key, sorted_ = key[order], word[order]
        if not np.any((key[1:] == key[:-1]) & (sorted_[1:] != sorted_[:-1])):
            return order
    return np.lexsort((word, line))


class Lines:
    """Token sets of the lines of some texts, in numpy: ``token`` by line and
    hash, ``line`` its line; by line: ``doc``, ``number``, ``size``, two
    64-bit sums ``d1`` and ``d2`` that identify the set, ``start`` of its tokens.
    The texts come folded."""

    _power = _inverse = np.ones(1, U)

    def __init__(self, texts: list[bytes]):
        buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if len(buf) > len(Lines._power):
            n = max(len(buf), 2 * len(Lines._power))
            Lines._power = np.cumprod(np.r_[U(1), np.full(n - 1, _R, U)])
            Lines._inverse = np.cumprod(np.r_[U(1), np.full(n - 1, _R_INVERSE, U)])
        space = (buf == 32) | (buf == 10)
        edges = np.flatnonzero(np.diff(space, prepend=True))  # starts and ends in turn
        starts, ends = edges[::2], edges[1::2]
        sums = np.cumsum(buf.astype(U) * Lines._power[:len(buf)])
        word = mix(((sums[ends - 1] - np.where(starts > 0, sums[starts - 1], U(0))) * Lines._inverse[starts])
                   + (ends - starts).astype(U) * U(0xC2B2AE3D27D4EB4F))
        new_line = np.flatnonzero(buf == 10)
        line = np.repeat(np.arange(len(new_line)), np.diff(np.r_[0, np.searchsorted(starts, new_line)]))
        order = _by_line(line, word, len(new_line))
        word, line = word[order], line[order]
        keep = np.ones(len(word), bool)
        keep[1:] = (word[1:] != word[:-1]) | (line[1:] != line[:-1])
        word, line = word[keep], line[keep]
        first = np.ones(len(line), bool)
        first[1:] = line[1:] != line[:-1]
        self.token, self.start = word, np.flatnonzero(first)
        self.line = np.cumsum(first) - 1
        self.size = np.diff(np.r_[self.start, len(word)])
        doc_end = np.cumsum([len(t) + 1 for t in texts])
        doc_first = np.r_[0, np.searchsorted(new_line, doc_end[:-1])]
        at = line[self.start]
        self.doc = np.searchsorted(doc_end, new_line[at], side="right")
        self.number = at - doc_first[self.doc]
        sum_by_line = lambda x: np.add.reduceat(x, self.start) if len(x) else x
        self.d1, self.d2 = sum_by_line(mix(word)), sum_by_line(mix(word ^ U(0x5851F42D4C957F2D)))

    def bitmaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Two words of a 128-bit bitmap of each line's tokens: which bits an odd
        number of them has.  A token of one set alone flips one bit, so the bitmaps
        differ in no more bits than the sets in tokens, however large these are."""
        bit, upper = U(1) << (self.token & U(63)), (self.token & U(64)) > 0
        both = (np.where(upper, U(0), bit), np.where(upper, bit, U(0)))
        return tuple(np.bitwise_xor.reduceat(x, self.start) if len(x) else x for x in both)

    def take(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, index into ``lines``) of chosen lines."""
        which = np.full(len(self.size), -1)
        which[lines] = np.arange(len(lines))
        held = which[self.line] >= 0
        return self.token[held], which[self.line[held]]


def chunks(batches: Iterator[pa.RecordBatch], chosen: Callable | None = None) -> Iterator[tuple[list, list, Lines]]:
    """(ids, text hashes, lines) of the documents, ``CHUNK`` bytes at a time;
    ``chosen(ids, texts)`` may leave lines out."""
    def whole() -> tuple[list, list, Lines]:
        return ids, hashes, Lines([t.translate(_FOLD) for t in (texts if chosen is None else chosen(ids, texts))])

    ids, hashes, texts, size = [], [], [], 0
    for b in batches:
        for i, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            text = t.as_py().encode()
            if texts and size + len(text) > (CHUNK if chosen is None else 8 * CHUNK):
                yield whole()
                ids, hashes, texts, size = [], [], [], 0
            ids.append(i)
            hashes.append(h)
            texts.append(text)
            size += len(text) + 1
    if texts:
        yield whole()


def _pass(docs: DataFrame, make: Callable, schema: str, choose: Callable = lambda: None) -> DataFrame:
    """``make() -> f(ids, hashes, lines) -> columns or None`` over chunks of documents, in the
    end of nones; of lines that ``choose() -> f(ids, texts) -> texts`` leaves."""
    small_batches(docs.sparkSession)
    struct = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, fn = arrow_schema(struct), make()
        for ids, hashes, lines in chunks(batches, choose()):
            if (cols := fn(ids, hashes, lines)) is not None:
                yield _batch(out, cols)
        if (last := fn(None, None, None)) is not None:
            yield _batch(out, last)

    return docs.mapInArrow(run, struct)


def _batch(schema: pa.Schema, cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _by_doc(values: list, index: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64()).take(pa.array(index))


def least_overlap(a, b):
    """Shared tokens that sets of these sizes need: 3/7 of the sum, rounded up."""
    return (3 * (a + b) + 6) // 7


def probing(n):
    """Length of the prefix that must hold a token shared with a similar set."""
    return n - (3 * n + 3) // 4 + 1


def indexing(n):
    """The same for the shorter of the two sets."""
    return n - (6 * n + 6) // 7 + 1


def census(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Every line with tokens (doc_id, text_hash, number, d1, d2, n_lines: how
    many its text has), and the rarity class (a byte) of each cell: a fixed-size count of all lines' tokens."""
    def make():
        counts, met = np.zeros(CELLS, np.int64), []

        def count():
            counts[:] += np.bincount(np.concatenate(met).astype(np.int64), minlength=CELLS)
            met.clear()

        def fn(ids, hashes, lines):
            if lines is None:
                if met:
                    count()
                parts = [c.astype("<i4").tobytes() for c in counts.reshape(64, -1)]
                return [[None] * 64] * 6 + [list(range(64)), parts]
            met.append((lines.token & U(CELLS - 1)).astype(np.int32))
            if sum(map(len, met)) >= CELLS:
                count()
            n = len(lines.size)
            return [_by_doc(ids, lines.doc), _by_doc(hashes, lines.doc), lines.number.astype(np.int32), lines.d1.view(np.int64),
                    lines.d2.view(np.int64), np.bincount(lines.doc)[lines.doc].astype(np.int32), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]

        return fn

    found = stored(_pass(docs, make, "doc_id long, text_hash long, number int, d1 long, d2 long, n_lines int, part int, counts binary"), "line-census")

    def add():
        def fn(key, rows):
            total = np.zeros(CELLS // 64, np.int64)
            for _, c in rows:
                total += np.frombuffer(c, "<i4")
            return [(key[0], total.tobytes())]
        return fn

    parts = found.where("part is not null").select("part", "counts").repartition("part").sortWithinPartitions("part")
    counts = np.zeros((64, CELLS // 64), np.int64)
    for r in flat_map_groups(parts, ["part"], add, "part int, counts binary").collect():  # one table, of fixed size
        counts[r["part"]] = np.frombuffer(r["counts"], "<i8")
    classes = np.minimum(4 * np.log2(np.maximum(counts.ravel(), 1)), 255).astype(np.uint8)
    return found.where("part is null").drop("part", "counts"), classes


#: A match is likely if its bitmaps stand for no more than this part of the differing tokens allowed.
LIKELY = 0.4
#: Earlier sets of a list that are tried after the best if that is a likely match.
NEAREST = 4
#: Columns of the rows that are sent by bucket: a list and a set that is open there, or an entry.
OPEN, ENTRY = 2, 7


def buckets_of(lines: int, partitions: int) -> int:
    """How many buckets the lists are dealt to, so that a bucket's entries fit a task."""
    entries = 16 * lines
    return max(2 * partitions, min(entries // BUCKET, BUCKETS), entries // (8 * BUCKET))


def to_buckets(cols: list[np.ndarray], buckets: int) -> list:
    """(bucket, width, rows) of 64-bit columns, dealt by the first: the rows of a
    bucket as bytes, byte by byte of the columns, so that equal bytes are neighbours."""
    rows = np.stack([c.view(U) for c in cols])
    bucket = (mix(rows[0]) % U(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order], rows[:, order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    parts = [np.ascontiguousarray(rows[:, a:b]).view(np.uint8).reshape(len(cols), b - a, 8).transpose(0, 2, 1).tobytes()
             for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)])]
    return [bucket[starts].astype(np.int32), np.full(len(starts), len(cols), np.int32), parts]


def from_bucket(parts: list[bytes], width: int) -> np.ndarray:
    """The columns (long) of such rows."""
    return np.concatenate([np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(width, 8, -1).transpose(0, 2, 1)).view(np.int64)[..., 0]
                           for p in parts] or [np.zeros((width, 0), np.int64)], axis=1)


def bitmap_of(values: DataFrame, column: str) -> np.ndarray:
    """Bitmap of ``BITS`` bits of the values (long) modulo ``BITS``."""
    cells = values.select(F.pmod(column, F.lit(BITS)).alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect()
    bitmap = np.zeros(BITS >> 6, U)
    for r in cells:
        bitmap[r["cell"]] = r["bits"] & 0xFFFFFFFFFFFFFFFF
    return bitmap


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & U(BITS - 1)
    return (bitmap[at >> U(6)] >> (at & U(63))) & U(1) > 0


def by_level(which: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Order by ``which``, then level (a byte), then as they are."""
    if len(which) < 1 << 28 and (not len(which) or which[-1] < 1 << 27):
        return (np.sort((which.astype(U) << U(36)) | (level.astype(U) << U(28)) | np.arange(len(which), dtype=U)) & U((1 << 28) - 1)).astype(np.int64)
    return np.argsort((which.astype(np.int64) << 8) | level, kind="stable")


def prefix_entries(docs: DataFrame, classes: np.ndarray, buckets: int, lists: DataFrame | None = None) -> DataFrame:
    """An entry for each token of each set's probing prefix: the list (a token
    and, if it is frequent, a pair of blocks), the set, its place (doc_id,
    number), size, position and which of the blocks it is of (packed: size << 32,
    position << 2, then 0 if the list is whole, else 1 or 2), bitmap (low, high).
    They come many in a row, by bucket of their list.  With ``lists`` (a column
    list), theirs and few others."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((classes, None if lists is None else bitmap_of(lists, "list")))
    frequent = 4 * int(np.log2(BLOCK))

    def make():
        (rarity, only), seen, held_back = shared.value, {}, []

        def send():
            cols = [np.concatenate(c) for c in zip(*held_back)]
            held_back.clear()
            return to_buckets(cols, buckets) if cols else None

        def fn(ids, hashes, lines):
            if lines is None:
                return send()
            # of sets that this task has met at an earlier place, nothing more is sent
            number = lines.number
            ids = [-1 << 63 if i is None else i for i in ids]
            place = zip([ids[d] for d in lines.doc.tolist()], number.tolist())
            chosen = []
            if len(seen) > SEEN:
                seen.clear()
            for k, (key, at) in enumerate(zip(zip(lines.d1.tolist(), lines.d2.tolist()), place)):
                if (before := seen.get(key)) is None or at < before:
                    seen[key] = at
                    chosen.append(k)
            chosen = np.array(chosen, np.int64)
            token, which = lines.take(chosen)
            level = rarity[(token & U(CELLS - 1)).astype(np.int64)]
            order = by_level(which, level)  # by token already
            token, which, level = token[order], which[order], level[order]
            size = lines.size[chosen]
            position = np.arange(len(token)) - np.r_[0, np.cumsum(size)[:-1]][which] if len(token) else np.zeros(0, np.int64)
            held = position < probing(size)[which]
            token, which, level, position = token[held], which[held], level[held], position[held]
            blocks = np.where(level < frequent, 1, 2 ** np.ceil(level / 4 - np.log2(BLOCK) + 1e-9)).astype(np.int64)
            block = (mix(lines.d1[chosen][which]) % blocks.astype(U)).astype(np.int64)
            times = np.repeat(np.arange(len(token)), blocks)
            other = np.arange(len(times)) - np.r_[0, np.cumsum(blocks)[:-1]][times] if len(times) else times
            at = chosen[which[times]]
            own = block[times]
            i, j = np.minimum(own, other), np.maximum(own, other)
            key = mix(token[times] + (i.astype(U) << U(32)) + j.astype(U))
            side = np.where(i == j, 0, np.where(own == i, 1, 2))
            packed = (lines.size[at].astype(np.int64) << 32) | (position[times] << 2) | side
            sent = slice(None) if only is None else np.flatnonzero(in_bitmap(only, key))
            at, low, high = at[sent], *lines.bitmaps()
            held_back.append([key[sent], lines.d1[at], np.array(ids, np.int64)[lines.doc[at]], number[at].astype(np.int64),
                              packed[sent], low[at], high[at]])
            return send() if sum(len(c[0]) for c in held_back) >= HELD else None

        return fn

    return _pass(docs, make, "bucket int, width int, rows binary")


def open_entries(undecided: DataFrame, buckets: int) -> DataFrame:
    """Rows by bucket of the lists and sets (list, d1) that are open."""
    struct = T.StructType.fromDDL("bucket int, width int, rows binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch(arrow_schema(struct), to_buckets([b.column(k).to_numpy() for k in range(OPEN)], buckets))

    return undecided.select("list", "d1").mapInArrow(run, struct)


def meet(lists, d1, doc, number, packed, low, high) -> tuple[np.ndarray, ...]:
    """(later, earlier, differing bits, differing tokens allowed): entries of one list that pass the
    filters.  The entries are sorted by list and, within it, by size and set;
    the first of a pair needs the token in its indexing prefix."""
    low, high = low.view(U), high.view(U)
    size, position, side = packed >> 32, (packed & 0xFFFFFFFF) >> 2, packed & 3
    out, step = [], 0
    i = np.flatnonzero(position < indexing(size))
    while len(i):
        step += 1
        i = i[i + step < len(d1)]
        i = i[(lists[i] == lists[i + step]) & (3 * size[i + step] <= 4 * size[i])]
        j = i + step
        a, b = size[i], size[j]
        need = least_overlap(a, b)
        ok = np.minimum(a - position[i], b - position[j]) >= need
        ok &= (side[i] == 0) | (side[i] != side[j])
        x, y, need = i[ok], j[ok], need[ok]
        differing = np.bitwise_count(low[x] ^ low[y]).astype(np.int64) + np.bitwise_count(high[x] ^ high[y])
        ok = differing <= size[x] + size[y] - 2 * need
        out.append((x[ok], y[ok], differing[ok], (size[x] + size[y] - 2 * need)[ok]))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    x, y, differing, allowed = (np.concatenate(c) for c in zip(*out))
    swap = (doc[x] > doc[y]) | (doc[x] == doc[y]) & ((number[x] > number[y]) | (number[x] == number[y]) & (d1[x] > d1[y]))
    return np.where(swap, x, y), np.where(swap, y, x), differing, allowed


def _lists(entries: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(which list, columns, open)`` over whole lists, sorted as ``meet`` wants
    them, a bucket at a time.  With rows of ``open_entries`` among the entries, only
    lists that hold an open set; ``open`` tells which sets are."""
    small_batches(entries.sparkSession)
    dealt = entries.repartition("bucket").sortWithinPartitions("bucket")
    struct = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(struct)

        def whole(rows: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
            cols = from_bucket(rows.get(ENTRY, []), ENTRY)
            is_open = np.zeros(cols.shape[1], bool)
            if OPEN in rows:
                lists, sets = from_bucket(rows[OPEN], OPEN)
                cols = cols[:, np.isin(cols[0], lists)]
                pair = lambda a, b: mix(a.view(U)) + b.view(U)
                is_open = np.isin(pair(cols[0], cols[1]), pair(lists, sets))
            key, d1, doc, number, packed = cols[:5]
            o = np.lexsort((d1, packed >> 32, key))
            first = np.r_[True, (d1[o[1:]] != d1[o[:-1]]) | (key[o[1:]] != key[o[:-1]])][:len(o)]
            if not first.all():  # of a set that several tasks have sent, the earliest entry
                run_ = np.cumsum(first) - 1
                several = np.flatnonzero(np.bincount(run_)[run_] > 1)
                o[several] = o[several][np.lexsort((number[o[several]], doc[o[several]], run_[several]))]
                o = o[first]
            which = np.cumsum(np.r_[True, key[o[1:]] != key[o[:-1]]][:len(o)])
            # a few lists at a time, by how many pairs they can have
            starts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]][:len(o)])
            pairs = np.cumsum(np.diff(np.r_[starts, len(o)]).astype(np.int64) ** 2)
            for part in np.unique(pairs // PAIRS):
                held = np.flatnonzero(pairs // PAIRS == part)
                begin, end = starts[held[0]], starts[held[-1] + 1] if held[-1] + 1 < len(starts) else len(o)
                now = o[begin:end]
                yield _batch(out, work(which[begin:end], *cols[:, now], is_open[now]))

        last, rows = None, {}
        for b in batches:
            for bucket, width, part in zip(*(c.to_pylist() for c in b.columns)):
                if bucket != last and rows:
                    yield from whole(rows)
                    rows = {}
                last = bucket
                rows.setdefault(width, []).append(part)
        if rows:
            yield from whole(rows)

    return dealt.mapInArrow(run, struct)


def place_hash(doc: np.ndarray | int, number: np.ndarray) -> np.ndarray:
    return mix(mix(np.asarray(doc, np.int64).reshape(-1).view(U)) + number.astype(U))


def closest(entries: DataFrame) -> DataFrame:
    """list, d1, place, best, others, more: of each list, each set's earlier one with
    the least differing bitmap.  The others there come along, ``NEAREST`` of them
    unless the bitmap makes that one an unlikely match; ``more`` tells whether there are
    still others.  Sets that are only an earlier one come with null best.  ``place``
    is a hash of where the set comes first."""
    def work(which, key, d1, doc, number, packed, low, high, is_open):
        later, earlier, differing, allowed = meet(which, d1, doc, number, packed, low, high)
        order = np.argsort((later << 8) | differing, kind="stable")
        later, earlier, differing, allowed = (x[order] for x in (later, earlier, differing, allowed))
        new = np.ones(len(later), bool)
        new[1:] = later[1:] != later[:-1]
        first = np.flatnonzero(new)
        count = np.diff(np.r_[first, len(later)])
        # differing tokens that so many differing bits stand for
        expected = -64 * np.log(np.maximum(1 - differing[first] / 64, 1e-9))
        unlikely = expected > LIKELY * allowed[first]
        sent = np.where(unlikely, count - 1, np.minimum(count - 1, NEAREST))
        after = np.arange(len(later)) - np.repeat(first, count)  # which after the best
        others = earlier[(after > 0) & (after <= np.repeat(sent, count))]
        alone = np.setdiff1d(earlier, later[first])
        alone = alone[np.unique(d1[alone], return_index=True)[1]]
        alone = alone[~np.isin(d1[alone], d1[later[first]])]
        none, at = np.zeros(len(alone), np.int64), np.r_[later[first], alone]
        others = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.r_[sent, none])].astype(np.int32)), pa.array(d1[others], pa.int64()))
        best = pa.concat_arrays([pa.array(d1[earlier[first]], pa.int64()), pa.nulls(len(alone), pa.int64())])
        return [np.r_[key[later[first]], none], d1[at], place_hash(doc[at], number[at]).view(np.int64), best, others,
                np.r_[count - 1 > sent, none > 0]]

    return _lists(entries, work, "list long, d1 long, place long, best long, others array<bigint>, more boolean")


def all_earlier(entries: DataFrame) -> DataFrame:
    """d1, best: every earlier set that meets an open set in a list where it is open."""
    def work(which, key, d1, doc, number, packed, low, high, is_open):
        later, earlier, *_ = meet(which, d1, doc, number, packed, low, high)
        held = is_open[later]
        both = np.unique(np.stack([d1[later[held]], d1[earlier[held]]]), axis=1)
        return [both[0], both[1]]

    return _lists(entries, work, "d1 long, best long")


def token_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(d1, d2, tokens) of the sets whose d1 is in ``wanted`` (d1, place), one row
    each.  Only lines at these places are taken apart, and at few others."""
    shared = docs.sparkSession.sparkContext.broadcast((bitmap_of(wanted, "d1"), bitmap_of(wanted, "place")))

    def choose():
        places = shared.value[1]

        def chosen(ids, texts):
            lines = [t.split(b"\n") for t in texts]
            n = np.array([len(x) for x in lines])
            doc = np.repeat(np.arange(len(lines)), n)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            hit = np.flatnonzero(in_bitmap(places, place_hash(np.array([-1 << 63 if i is None else i for i in ids], np.int64)[doc], number)))
            left = [[] for _ in lines]
            for d, k in zip(doc[hit].tolist(), number[hit].tolist()):
                left[d].append(lines[d][k])
            return [b"\n".join(x) for x in left]

        return chosen

    def make():
        bits, sent = shared.value[0], set()

        def fn(ids, hashes, lines):
            if lines is None:
                return None
            hit = np.flatnonzero(in_bitmap(bits, lines.d1))
            rows = []
            if len(sent) > SEEN:
                sent.clear()
            for k in hit.tolist():
                key = (int(lines.d1[k].astype(np.int64)), int(lines.d2[k].astype(np.int64)))
                if key not in sent:
                    sent.add(key)
                    rows.append((*key, lines.token[lines.start[k]:lines.start[k] + lines.size[k]].tobytes()))
            return list(zip(*rows)) if rows else [[], [], []]

        return fn

    found = _pass(docs, make, "d1 long, d2 long, tokens binary", choose).join(wanted.select("d1").distinct(), "d1", "left_semi")
    return found.dropDuplicates(["d1", "d2"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 4 * both >= 3 * (len(a) + len(b) - both)


def _settled(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(d1, d2) of the later sets that a pair confirms."""
    b = sets.select(F.col("d1").alias("a1"), F.col("tokens").alias("a_tokens"))
    both = pairs.join(sets, "d1").join(b, F.col("best") == F.col("a1")).select("d1", "d2", "tokens", "a_tokens")

    def make():
        return lambda d1, d2, x, y: (d1, d2, similar(np.frombuffer(x, U), np.frombuffer(y, U)))

    return map_rows(both, make, "d1 long, d2 long, ok boolean").where("ok").select("d1", "d2").distinct()


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lines, removed): doc_id, text_hash, number (from 0) of every line with
    tokens (and n_lines, how many its text has), and of those that go."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"), text_of(text_col).alias("text"))
    lines, classes = census(src)
    buckets = buckets_of(lines.count(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = stored(closest(prefix_entries(src, classes, buckets)), "line-closest")
    sets = stored(token_sets(src, met.select("d1", "place")), "line-sets")
    tried = met.where("best is not null").select("d1", "best").distinct()
    first = stored(_settled(tried, sets), "line-settled")
    open_ = met.where("best is not null").join(first.select("d1").distinct(), "d1", "left_anti")
    given = open_.where(F.size("others") > 0).groupBy("d1").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("best"))
    second = stored(_settled(given.select("d1", F.explode("best").alias("best")).join(tried, ["d1", "best"], "left_anti"), sets), "line-settled")
    gone = first.unionByName(second)
    undecided = stored(open_.where("more").join(second.select("d1").distinct(), "d1", "left_anti").select("list", "d1"), "line-open")
    if not undecided.isEmpty():  # form their lists again
        entries = prefix_entries(src, classes, buckets, undecided).unionByName(open_entries(undecided, buckets))
        gone = gone.unionByName(_settled(all_earlier(entries).distinct().join(tried, ["d1", "best"], "left_anti"), sets))
    gone = gone.distinct().withColumn("similar", F.lit(True))

    # one number by doc_id (null first) and line, as structs would be sorted, not hashed, to find the least
    place = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(Decimal(-(1 << 63) - 1)).cast("decimal(20,0)")) \
        * F.lit(1 << 31).cast("decimal(10,0)") + F.col("number").cast("decimal(10,0)")
    placed = lines.select("doc_id", "text_hash", "number", "d1", "d2", place.alias("place"))
    firsts = placed.groupBy("d1", "d2").agg(F.min("place").alias("first"))
    verdict = placed.join(firsts.join(gone, ["d1", "d2"], "left"), ["d1", "d2"])
    return lines, verdict.where(F.col("similar").isNotNull() | (F.col("place") != F.col("first"))).select("doc_id", "text_hash", "number").distinct()


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed lines cut out of the text."""
    _, gone = removed_lines(docs, id_col, text_col)
    by_doc = gone.groupBy("doc_id", "text_hash").agg(F.collect_set("number").alias("__gone")) \
        .select(F.col("doc_id").alias("__i"), F.col("text_hash").alias("__h"), "__gone")
    lines = F.split(text_of(text_col), "\n")
    kept = F.array_join(F.filter(lines, lambda x, k: ~F.array_contains(F.col("__gone"), k)), "\n")
    return docs.join(by_doc, same(F.col(id_col).cast("long"), F.col("__i")) & (F.xxhash64(text_of(text_col)) == F.col("__h")), "left") \
        .withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept)).drop("__i", "__h", "__gone")


@register("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    lines, gone = removed_lines(docs)
    key = ["doc_id", "text_hash"]
    counts = lines.groupBy(*key).agg(F.max("n_lines").cast("long").alias("n_lines"))
    cut = gone.groupBy(*key).agg(F.count(F.lit(1)).alias("n_removed"), F.array_join(F.array_sort(F.collect_list("number")), ",").alias("removed"))
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"))
    both = counts.join(cut, key, "left").select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"), "n_lines", "n_removed", "removed")
    return rows.join(both, same(F.col("doc_id"), F.col("i")) & (F.col("text_hash") == F.col("h")), "left").select(
        "doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("removed", F.lit("")).alias("removed"))

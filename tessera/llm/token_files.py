"""Token-ID files: independent zstandard frames with a trailing seek table.

Documents are range-partitioned and sorted by doc_id; each task encodes its
range and writes one file.  A file is a row of independent zstandard frames of
about ``FRAME`` bytes (a longer document has a frame of its own), closed by a
seek table in a skippable frame: compressed size, plain size and checksum of
every frame.  A frame's plain content is

    uint32 n | n x (int64 doc_id, uint8 doc_id is null, uint32 n_tokens) | uint32 ids

little-endian.  Readers take the seek table from the end of the file,
decompress only the frames they need and check each one's checksum.

The writer returns a row for each frame, which is stored by Spark's own commit
protocol.  Every attempt of a task writes a file of another name, so a retried
or speculative attempt never harms a committed one; a file that no row names
is not part of the output.

Null or empty text encodes as the end id alone.  Null doc_ids come first.
Rows that repeat a doc_id are kept, ordered by a hash of their text.  An empty
table gives no frames.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tessera.llm.common import arrow_schema, documents, small_batches, stored, text_of
from tessera.llm.pretokens import KNOWN, byte_characters, classes, cut_added, library_split, needs_library, of_class
from tessera.llm.registry import register
from tessera.session import scratch_path

FRAME = 1 << 20
MEMO = 400_000
LEVEL = 3
# Fixed values of the seekable zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

ENTRY = np.dtype([("doc_id", "<i8"), ("no_id", "u1"), ("n", "<u4")])
FRAMES = ("part int, file string, frame int, offset long, size long, n_tokens long, "
          "doc_ids array<bigint>")


class _Words(dict):
    """Ids of each pre-token as bytes; a bounded memo before the library's model."""

    def __init__(self, tok: Tokenizer):
        self.model, self.byte = tok.model, byte_characters()

    def __missing__(self, word: str) -> bytes:
        if len(self) > MEMO:
            self.clear()
        shown = "".join(map(self.byte.__getitem__, word.encode()))
        out = self[word] = struct.pack(f"<{len(t := self.model.tokenize(shown))}I", *(x.id for x in t))
        return out


def make_encoder(spec: str):
    """``encode(text) -> bytes`` of little-endian uint32 ids, equal to the
    library's ids for every text.  Pre-tokens are encoded once each."""
    tok = Tokenizer.from_str(spec)
    found = classes(tok)
    lower = tok.normalizer.normalize_str
    unsafe = "".join(c for c, k in found.items() if k != "S" and (lower(c) != c.lower() or ord(max(c.lower())) >= KNOWN))
    letters, numbers, spaces = (of_class(found, k) for k in "LNS")
    split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+").findall
    words, cut, odd = _Words(tok), cut_added(spec), needs_library(unsafe).search

    def encode(text: str) -> bytes:
        out = []
        for k, part in enumerate(cut(text)):
            if k % 2:
                out.append(struct.pack("<I", tok.token_to_id(part)))
            else:
                out += map(words.__getitem__, library_split(tok, part) if odd(part) else split(part.lower()))
        return b"".join(out)

    return encode


#: Names that Hadoop's readers give to stores which pyarrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def known_uri(path: str) -> str:
    """``path`` as pyarrow names it; a path without a scheme stays as it is."""
    scheme, sep, rest = path.partition("://")
    return f"{SCHEMES.get(scheme, scheme)}{sep}{rest}"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(known_uri(path))


class FrameWriter:
    """Writes frames of documents to an open file and, last, the seek table."""

    def __init__(self, out, frame_bytes: int = FRAME):
        self.out, self.limit, self.at = out, frame_bytes, 0
        self.tool, self.table, self.entries, self.ids, self.size = zstandard.ZstdCompressor(level=LEVEL), [], [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        if self.entries and self.size + len(ids) > self.limit:
            yield self.end_frame()
        self.entries.append((doc_id or 0, doc_id is None, len(ids) // 4))
        self.ids.append(ids)
        self.size += len(ids)

    def end_frame(self) -> tuple:
        """(frame, offset, size, n_tokens, doc_ids) of the frame written."""
        head = np.array(self.entries, dtype=ENTRY)
        plain = struct.pack("<I", len(head)) + head.tobytes() + b"".join(self.ids)
        packed = self.tool.compress(plain)
        self.out.write(packed)
        row = (len(self.table), self.at, len(packed), int(head["n"].sum(dtype=np.int64)),
               [None if no else i for i, no, _ in self.entries])
        self.table.append(struct.pack("<III", len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.at += len(packed)
        self.entries, self.ids, self.size = [], [], 0
        return row

    def finish(self) -> Iterator[tuple]:
        if self.entries:
            yield self.end_frame()
        body = b"".join(self.table) + struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)


def write_tokens(docs: DataFrame, tokenizer_path: str, out_dir: str, end_id: int = 1, frame_bytes: int = FRAME,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files below ``out_dir`` (a folder that all executors reach)
    and returns a row for each frame; parts in ascending order hold ascending doc_ids."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    end, struct_ = struct.pack("<I", end_id), T.StructType.fromDDL(FRAMES)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("tie"),
                      text_of(text_col).alias("text"))
    src = src.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(struct_)
        encode = None
        part = TaskContext.get().partitionId()
        name = f"{out_dir.rstrip('/')}/tokens-{part:06d}-{uuid.uuid4().hex}.zst"

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*((part, name, *r) for r in rows)))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        out = writer = None
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                if writer is None:  # an empty partition writes no file
                    encode = make_encoder(shared.value)
                    fs, path = _filesystem(name)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                    writer = FrameWriter(out, frame_bytes)
                rows.extend(writer.add(i, encode(text.as_py()) + end))
            if rows:
                yield batch(rows)
        if writer is not None:
            rows = list(writer.finish())
            out.close()
            if rows:
                yield batch(rows)

    return stored(src.mapInArrow(run, struct_), "token-frames")


def seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(compressed size, plain size, checksum) of each frame, from the end of the file."""
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
        raise ValueError("no seek table with checksums at the end of the file")
    file.seek(size - 9 - 12 * n - 8)
    magic, length = struct.unpack("<II", file.read(8))
    if magic != SKIPPABLE_MAGIC or length != 12 * n + 9:
        raise ValueError("damaged seek table")
    return list(struct.iter_unpack("<III", file.read(12 * n)))


def read_frame(file, table: list[tuple[int, int, int]], k: int) -> list[tuple[int | None, bytes]]:
    """(doc_id, ids as bytes) of the documents in frame ``k``."""
    file.seek(sum(t[0] for t in table[:k]))
    plain = zstandard.ZstdDecompressor().decompress(file.read(table[k][0]), max_output_size=table[k][1])
    if len(plain) != table[k][1] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != table[k][2]:
        raise ValueError(f"checksum of frame {k} doesn't match")
    (n,) = struct.unpack_from("<I", plain)
    head = np.frombuffer(plain, ENTRY, n, 4)
    at, out = 4 + n * ENTRY.itemsize, []
    for i, no, m in head.tolist():
        out.append((None if no else i, plain[at:at + 4 * m]))
        at += 4 * m
    return out


def _read(frames: DataFrame, make, schema: str) -> DataFrame:
    """``make(row, documents)`` of each row of ``frames`` (file, frame, and
    what else it has) and the documents of that frame."""
    struct_ = T.StructType.fromDDL(schema)
    names = frames.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema_ = arrow_schema(struct_)
        opened = (None, None, None)
        for b in batches:
            for row in b.to_pylist():
                if opened[0] != row["file"]:
                    if opened[1] is not None:
                        opened[1].close()
                    fs, path = _filesystem(row["file"])
                    file = fs.open_input_file(path)
                    opened = (row["file"], file, seek_table(file, file.size()))
                rows = list(make(row, read_frame(opened[1], opened[2], row["frame"])))
                cols = list(zip(*rows)) if rows else [()] * len(schema_)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema_)], schema=schema_)
        if opened[1] is not None:
            opened[1].close()

    n = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frames.select(*names).repartition(n, "file", "frame").sortWithinPartitions("file", "frame") \
        .mapInArrow(run, struct_)


def token_statistics(frames: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    The tokens before a frame: those of earlier files (a window over one row
    a file) plus those of earlier frames of its file."""
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    files = frames.groupBy("part").agg(F.sum("n_tokens").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    inside = W.partitionBy("part").orderBy("frame").rowsBetween(W.unboundedPreceding, -1)
    placed = frames.select("part", "file", "frame", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("at")) \
        .join(files, "part").select("file", "frame", (F.col("file_start") + F.col("at")).alias("start"))

    def make(row, docs):
        start = row["start"]
        for i, ids in docs:
            yield i, start, len(ids) // 4, zlib.crc32(ids)
            start += len(ids) // 4

    return _read(placed, make, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch_tokens(frames: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, token_ids of the documents in ``wanted`` (a column doc_id);
    decompresses only the frames that hold one."""
    hits = frames.select("file", "frame", F.explode("doc_ids").alias("doc_id")) \
        .join(wanted.select("doc_id").distinct(), "doc_id") \
        .groupBy("file", "frame").agg(F.collect_set("doc_id").alias("ids"))

    def make(row, docs):
        ids = set(row["ids"])
        return ((i, np.frombuffer(x, "<u4").tolist()) for i, x in docs if i in ids)

    return _read(hits, make, "doc_id long, token_ids array<bigint>")


@register("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    frames = write_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"),
                          scratch_path(spark, "token-files"))
    return token_statistics(frames)

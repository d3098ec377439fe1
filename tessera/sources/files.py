"""File sources and sinks.

Readers are thin declarations over Spark's own sources (column pruning and
filter pushdown reach the scan); listings read file metadata only (the
``binaryFile`` source never loads ``content`` unless selected); sinks go
through Spark's commit protocol, which gives the atomic publish the
reference gets from a temp-file rename.
"""

from __future__ import annotations

import csv
import io
import logging
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = {"csv": "csv", "parquet": "parquet", "pq": "parquet", "jsonl": "json", "ndjson": "json", "json": "json"}


def positional_schema(n: int, types: list[T.DataType] | None = None) -> T.StructType:
    return T.StructType([T.StructField(f"col_{i}", (types[i] if types else T.StringType()), True) for i in range(n)])


def read_table(spark: SparkSession, path: str, fmt: str = "csv", header: bool = False,
               schema: T.StructType | None = None, sep: str = ",", encoding: str = "utf-8") -> DataFrame:
    """One reader for the service's formats; unknown formats are an error."""
    kind = FORMATS.get(fmt.lower())
    if kind is None:
        raise ValueError(f"unsupported format {fmt}")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if kind == "csv":
        return r.option("header", header).option("sep", sep).option("encoding", encoding).csv(path)
    if kind == "json":
        return r.json(path)
    return r.parquet(path)


def read_named_csv(spark: SparkSession, path: str, required: list[str], optional: list[str] | None = None, sep: str = ",",
                   encoding: str = "utf-8") -> DataFrame:
    """Header CSV, each file read by its own header, in one pass: files may
    order their columns differently, quote their names or hold more columns.
    ``required`` and ``optional`` columns come back as text (an optional one
    that a file lacks is null), with the path of the ``file``.

    A file is one unit of work (its content is held by one task) and read once,
    by Spark's own reader.  A file that can't be decoded or parsed is skipped with
    a warning in the executor's log; one without a required column is fatal."""
    names = [*required, *(optional or [])]
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*names, "file"]])

    def rows_of(content: bytes, file: str) -> Iterator[list]:
        lines = csv.reader(io.StringIO(content.decode(encoding).removeprefix("\ufeff"), newline=""), delimiter=sep, strict=True)
        header = next(lines, None)
        if header is None:
            return  # an empty file has neither header nor rows
        header = [c.strip() for c in header]
        missing = [c for c in required if c not in header]
        if missing:
            raise LookupError(f"missing required columns {missing} in {file}; found {header}")
        at = [header.index(c) if c in header else None for c in names]
        for line in lines:
            if line:
                yield [*(line[k] if k is not None and k < len(line) and line[k] != "" else None for k in at), file]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.field(c, pa.string()) for c in schema.names]
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                try:
                    rows = list(rows_of(content.as_py(), file))
                except (UnicodeDecodeError, csv.Error) as e:
                    logging.getLogger(__name__).warning("skipped unreadable file %s: %s", file, e)
                    continue
                for k in range(0, len(rows), 10_000):
                    cols = list(zip(*rows[k:k + 10_000]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], schema=pa.schema(fields))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def read_items(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Files holding one JSON array of objects each (multi-line JSON)."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema else r).json(path)


def read_dir(spark: SparkSession, path: str, glob: str = "*.csv", header: bool = True,
             schema: T.StructType | None = None) -> DataFrame:
    """Every matching file of a directory, with the file path as lineage.
    A directory without matching files is an error."""
    if list_files(spark, path, glob, recursive=False).isEmpty():
        raise FileNotFoundError(f"no files matching {glob} in {path}")
    r = spark.read.option("header", header).option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path).withColumn("source_file", F.col("_metadata.file_path"))


def _ci_glob(ext: str) -> str:
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext.lstrip("."))


def list_files(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """path, length, modificationTime of files below ``root`` (metadata only)."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r.load(root).select("path", "length", "modificationTime")


def list_by_extension(spark: SparkSession, root: str, ext: str = "csv") -> DataFrame:
    """Recursive, case-insensitive extension listing."""
    return list_files(spark, root, _ci_glob(ext), recursive=True)


def pair_datasets(listing: DataFrame, train: str = "train", test: str = "test") -> DataFrame:
    """Dataset directories holding a train file, paired with their test file
    when there is one (left join on the parent directory)."""
    p = listing.select(F.regexp_extract("path", rf"^(.*)/({train}|{test})\.csv(/.*)?$", 1).alias("dataset"),
                       F.regexp_extract("path", rf"^(.*)/({train}|{test})\.csv(/.*)?$", 2).alias("kind")).where("dataset <> ''")
    tr = p.where(F.col("kind") == train).select("dataset").distinct()
    te = p.where(F.col("kind") == test).select("dataset").distinct().withColumn("has_test", F.lit(True))
    if tr.isEmpty():
        raise FileNotFoundError(f"no dataset folder holds a {train} file")
    return tr.join(te, "dataset", "left").select("dataset", F.coalesce("has_test", F.lit(False)).alias("has_test"))


def inventory(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Per file: data rows = max(0, lines - 1), bytes, weight = max(1, rows).
    Empty files come from the listing (they have no lines to count)."""
    files = list_files(spark, root, glob).select(F.col("path"), F.col("length").alias("bytes"))
    lines = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(root)
             .select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("lines")))
    j = files.join(lines, "path", "left")
    rows = F.greatest(F.coalesce(F.col("lines"), F.lit(0)) - 1, F.lit(0))
    return j.select("path", rows.alias("rows"), "bytes", F.greatest(rows, F.lit(1)).alias("weight"))


def write_csv_union(frames: list[DataFrame], path: str) -> None:
    """Records with differing columns: sorted union of names, blanks for the
    missing ones, header always."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    u.select(*sorted(u.columns)).write.option("header", True).option("escape", '"').csv(path)   # quotes doubled, as readers expect


def write_meta(meta: DataFrame, path: str) -> None:
    meta.write.json(path)


def column_descriptor(df: DataFrame, descriptions: dict[str, str] | None = None) -> Column:
    """What stands next to a result: its columns in order, their types and, where given, what they mean."""
    known = descriptions or {}
    unknown = set(known) - set(df.columns)
    if unknown:
        raise ValueError(f"descriptions of columns that are not there: {sorted(unknown)}")
    return F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                              F.lit(known.get(f.name)).cast("string").alias("description")) for f in df.schema])


def write_predictions(df: DataFrame, path: str, id_col: str = "id", pred: str = "prediction") -> None:
    df.select(id_col, pred).write.option("header", True).csv(path)


def save_batches(df: DataFrame, path: str, batch: str = "batch_id") -> None:
    """Numbered batches as partition directories (ragged arrays stay native).
    Batches of any size: rows are dealt in ranges, so a large one is several
    files and small ones share a task."""
    df.repartitionByRange(batch, *[c for c in df.columns if c != batch and df.schema[c].dataType.typeName() in ("long", "integer", "string")][:2]) \
        .write.partitionBy(batch).parquet(path)


def load_batches(spark: SparkSession, path: str, start: int = 0, max_batches: int | None = None,
                 batch: str = "batch_id") -> DataFrame:
    """Batches from ``start`` on (partition pruning), at most the first
    ``max_batches`` that are there, whatever their numbers."""
    df = spark.read.parquet(path).where(F.col(batch) >= start)
    if max_batches is not None:
        wanted = df.select(batch).distinct().orderBy(batch).limit(max_batches)
        df = df.join(wanted, batch, "left_semi")
    return df


def shard(df: DataFrame, world: int, rank: int, start: int = 0, batch: str = "batch_id") -> DataFrame:
    """Rank r of w reads batches start + r, start + r + w, ..."""
    return df.where((F.col(batch) >= start) & (F.pmod(F.col(batch) - start, F.lit(world)) == rank))
